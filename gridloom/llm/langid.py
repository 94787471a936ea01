"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import give_back, materialize, utf8

PAD = b"\n\n\n"
CHUNK = 1 << 18
#: Bytes of code lengths that one pass over the texts may hold, which decides how many
#: languages it scores.
MOST_BYTES = 1 << 27


class Places:
    """Where a code lies among sorted distinct ones, by open addressing; -1 for any other."""

    def __init__(self, codes: np.ndarray):
        bits = max(10, (4 * len(codes)).bit_length())
        self.shift, self.mask = np.uint32(32 - bits), (1 << bits) - 1
        self.key, self.at = np.zeros(1 << bits, np.uint32), np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(codes), dtype=np.int32), self._slot(codes)
        while len(left):
            free = self.at[slot] < 0
            self.at[slot[free]] = left[free]
            won = self.at[slot] == left
            self.key[slot[won]] = codes[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint32(2654435761)) >> self.shift).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        slot = self._slot(codes)
        at = self.at[slot]
        other = np.flatnonzero((self.key[slot] != codes) & (at >= 0))
        while len(other):
            slot[other] = s = (slot[other] + 1) & self.mask
            at[other] = self.at[s]
            other = other[(self.key[s] != codes[other]) & (self.at[s] >= 0)]
        return at


@dataclass(frozen=True)
class Trees:
    """The byte context trees of some languages, one column each, as exact code lengths in bits.

    four, three: the 4-grams and 3-grams (or 3-byte contexts) that any of them has, sorted.
    bits: code length of a 4-gram's last byte after the first three. leave: cost of leaving a
    3-byte context. shorter: code length of a 3-gram's last byte with its own escapes.
    leave_two, pair: the same one order lower, for all pairs of bytes."""

    langs: list[str]
    four: np.ndarray
    three: np.ndarray
    bits: np.ndarray
    leave: np.ndarray
    shorter: np.ndarray
    leave_two: np.ndarray
    pair: np.ndarray

    @cached_property
    def places(self) -> tuple[Places, Places]:
        return Places(self.four), Places(self.three)


def _joined(parts: list[bytes], before: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased parts in one buffer, the three bytes ``before`` ahead of each; starts, sizes."""
    size = np.array([len(t) for t in parts], np.int64)
    start = np.cumsum(size + len(PAD)) - size
    both = b"".join(x for pair in zip(before, parts) for x in pair)
    return np.frombuffer(both.lower(), np.uint8), start, size


def _pieces(texts: list[bytes], most: int = CHUNK) -> Iterator[tuple[list[int], list[bytes], list[bytes]]]:
    """Groups of parts of about ``most`` bytes, with their row numbers and the three bytes
    before each part; only texts longer than ``most`` have several parts."""
    rows, held, before, total = [], [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t)), most):
            rows.append(i)
            held.append(t[at : at + most])
            before.append(t[at - 3 : at] if at else PAD)
            total += len(held[-1])
            if total >= most:
                yield rows, held, before
                rows, held, before, total = [], [], [], 0
    if rows:
        yield rows, held, before


def _grams(buffer: np.ndarray) -> np.ndarray:
    """The code of the 4-gram that ends at each position, from position 3 on."""
    b = buffer.astype(np.uint32)
    return (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]


def _fold(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and the sums of their counts."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, int)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def count_grams(labelled: DataFrame, most_held: int = 1 << 20) -> DataFrame:
    """``(lang, code, n)``: byte 4-grams of every row of ``labelled(text, lang)``, summed per
    task before the shuffle. A task holds about ``most_held`` of them over all languages: where
    folding leaves more, all go on and counting begins anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        waiting = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                codes, counts = _fold(*(np.concatenate(x) for x in zip(*parts)))
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(codes), "code": codes.astype(np.int64), "n": counts.astype(np.int64)})
            held.clear()

        for b in batches:
            by: dict[str, list[bytes]] = {}
            for text, lang in zip(utf8(b.column(0)), b.column(1).to_pylist()):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                for _, some, before in _pieces(texts, 16 * CHUNK):
                    buffer, start, size = _joined(some, before)
                    inside = np.ones(len(buffer), bool)
                    inside[(start[:, None] - [1, 2, 3]).ravel()] = False
                    codes = np.sort(_grams(buffer)[inside[3:]])
                    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, int)
                    held.setdefault(lang, []).append((codes[first], np.diff(np.append(first, len(codes)))))
                    waiting += len(first)
                    if waiting > 4 * most_held:
                        held.update({x: [_fold(*(np.concatenate(v) for v in zip(*parts)))] for x, parts in held.items()})
                        waiting = sum(len(parts[0][0]) for parts in held.values())
                        if waiting > most_held:
                            yield from emptied()
                            waiting = 0
        yield from emptied()
        give_back()

    counted = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counted = counted.where("text is not null and lang is not null").mapInArrow(run, "lang string, code long, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _escaped(n: np.ndarray, context: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray]:
    """Escape method C: the code length of each counted symbol in its context, and the cost of
    leaving each context, nothing where it was never met."""
    total = np.bincount(context, weights=n, minlength=contexts)
    kinds = np.bincount(context[n > 0], minlength=contexts)
    with np.errstate(divide="ignore", invalid="ignore"):
        own = np.log2((total + kinds)[context] / n)
        return own, np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)


def build_trees(langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]) -> Trees:
    """The trees of languages from their 4-gram counts ``(sorted codes, counts)``."""
    none = np.zeros(0, np.uint32)
    four = np.unique(np.concatenate([c for c, _ in counts])) if counts else none
    three = np.unique(np.concatenate([four >> 8, four & 0xFFFFFF])) if counts else none
    shape = lambda n: np.zeros((n, len(langs)), np.float32)
    out = Trees(langs, four, three, shape(len(four)), shape(len(three)), shape(len(three)), shape(1 << 16), shape(1 << 16))
    every = np.arange(1 << 16)
    for k, (codes, n) in enumerate(counts):
        n = n.astype(float)
        one = np.bincount(codes & 0xFF, weights=n, minlength=256)
        own, leave = _escaped(one, np.zeros(256, np.int64), 1)
        single = np.where(one > 0, own, leave[0] + 8)
        two = np.bincount(codes & 0xFFFF, weights=n, minlength=1 << 16)
        own, leave = _escaped(two, every >> 8, 256)
        pair = np.where(two > 0, own, leave[every >> 8] + single[every & 0xFF])
        grams, sums = _fold(codes & 0xFFFFFF, n)
        own, leave_two = _escaped(sums, grams >> 8, 1 << 16)
        shorter = leave_two[three >> 8] + pair[three & 0xFFFF]
        shorter[np.searchsorted(three, grams)] = own
        own, leave = _escaped(n, np.searchsorted(three, codes >> 8), len(three))
        bits = leave[np.searchsorted(three, four >> 8)] + shorter[np.searchsorted(three, four & 0xFFFFFF)]
        bits[np.searchsorted(four, codes)] = own
        for table, values in zip((out.bits, out.leave, out.shorter, out.leave_two, out.pair), (bits, leave, shorter, leave_two, pair)):
            table[:, k] = values
    return out


@dataclass(frozen=True)
class PpmModel:
    """Frozen order-3 statistics of all languages: every 4-gram of the training rows with its
    count, as a table in the shared folder that grows with them, and the languages that one
    pass scores together. No count is dropped."""

    grams: DataFrame
    shards: list[list[str]]

    @property
    def langs(self) -> list[str]:
        return [x for shard in self.shards for x in shard]

    def trees(self, shard: list[str]) -> Trees:
        rows = self.grams.where(F.col("lang").isin(shard)).toArrow()
        lang, code, n = (rows[c].to_numpy() for c in ("lang", "code", "n"))
        order = np.lexsort((code, lang.astype(str)))
        lang, code, n = lang[order].astype(str), code[order].astype(np.uint32), n[order]
        edges = [slice(np.searchsorted(lang, x), np.searchsorted(lang, x, side="right")) for x in shard]
        return build_trees(shard, [(code[e], n[e]) for e in edges])


def train(labelled: DataFrame, most_bytes: int = MOST_BYTES) -> PpmModel:
    """Context trees from every row of ``labelled(text, lang)`` without nulls.

    Languages are scored together as long as their code lengths take ``most_bytes`` at most, a
    bound on what a pass sends from the driver; beyond it there are more passes, each over all
    texts. A language is never split, so one whose own trees are larger is a pass by itself."""
    grams = materialize(count_grams(labelled), "grams")
    shards: list[list[str]] = []
    rows = 0
    for r in grams.groupBy("lang").count().orderBy("lang").collect():  # one row a language
        rows += r["count"]
        if not shards or 8 * rows * (len(shards[-1]) + 1) > most_bytes:
            shards.append([])
            rows = r["count"]
        shards[-1].append(r["lang"])
    return PpmModel(grams, shards)


def code_lengths(texts: list[bytes], trees: Trees) -> np.ndarray:
    """Bits that each text takes under each language's trees: every byte counts."""
    out = np.zeros((len(texts), len(trees.langs)))
    four, three = trees.places
    for rows, some, before in _pieces(texts):
        buffer, start, size = _joined(some, before)
        codes = _grams(buffer)
        if not len(codes):
            continue
        at = four.find(codes)
        bits = trees.bits[at] if len(trees.four) else np.zeros((len(at), len(trees.langs)), np.float32)
        missed = np.flatnonzero(at < 0)
        if len(missed):
            gram = codes[missed]
            context, last = three.find(gram >> 8), three.find(gram & 0xFFFFFF)
            known = last >= 0
            cost = trees.leave_two[(gram >> 8) & 0xFFFF] + trees.pair[gram & 0xFFFF]
            cost[known] = trees.shorter[last[known]]
            cost[context >= 0] += trees.leave[context[context >= 0]]
            bits[missed] = cost
        # spans: from each text's first position to its end, pads between
        edges = np.stack([start - 3, start - 3 + size], axis=1).ravel()
        full = np.append(bits, np.zeros((1, bits.shape[1]), bits.dtype), axis=0)
        sums = np.add.reduceat(full, np.minimum(edges, len(bits)), axis=0, dtype=np.float64)[::2]
        sums[size == 0] = 0
        np.add.at(out, rows, sums)
    return out


#: What passes hand on: the least bits so far, their language, and the sum of two to the power
#: of the least bits minus each language's.
CARRIED = {"__bits": "double", "__lang": "string", "__mass": "double"}


def _scored(rows: DataFrame, trees: Trees, text: Column) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(trees)
    plain = rows.columns[: -len(CARRIED)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = utf8(b.column(b.num_columns - 1))
            least, names, mass = (b.column(len(plain) + k).to_pylist() for k in range(3))
            bits = code_lengths([t or b"" for t in texts], sent.value)
            best = bits.argmin(axis=1)
            low = bits.min(axis=1)
            own = np.exp2(low[:, None] - bits).sum(axis=1)
            for k, t in enumerate(texts):
                if t is None:
                    continue
                if least[k] is None:
                    least[k], names[k], mass[k] = low[k], sent.value.langs[best[k]], own[k]
                elif low[k] < least[k]:
                    mass[k] = own[k] + mass[k] * 2.0 ** max(low[k] - least[k], -1000.0)
                    least[k], names[k] = low[k], sent.value.langs[best[k]]
                else:
                    mass[k] += own[k] * 2.0 ** max(least[k] - low[k], -1000.0)
            new = [pa.array(least, pa.float64()), pa.array(names, pa.string()), pa.array(mass, pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(plain)], *new], names=[*plain, *CARRIED])
        give_back()

    return rows.withColumn("__text", text).mapInArrow(run, rows.schema)


def identify(docs: DataFrame, model: PpmModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``: the language whose trees give the shortest
    code for the whole text, ties to the first name, and its probability under equal priors.
    A text that is null or has no letter, and any text if no language was learned, gets ``und``
    with score 0. Other columns are kept; own ones of these names are replaced. Empty tables,
    repeated rows and null ids need nothing special: each row is scored by itself."""
    base = docs.drop("lang_pred", "score")
    rows = base.select("*", *[F.lit(None).cast(t).alias(c) for c, t in CARRIED.items()])
    text = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col)).cast("string")
    for k, shard in enumerate(model.shards):
        rows = _scored(materialize(rows, "scored") if k else rows, model.trees(shard), text)
    return rows.select(*[F.col(f"`{c}`") for c in base.columns], F.coalesce("__lang", F.lit("und")).alias("lang_pred"), F.coalesce(1 / F.col("__mass"), F.lit(0.0)).alias("score"))


def held_out(id_col: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    text = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("string").cast("binary")
    return F.coalesce(F.crc32(text) % folds == fold, F.lit(False))


def learn(docs: DataFrame, most_bytes: int = MOST_BYTES) -> PpmModel:
    """A model from the documents that have a language and aren't in the held-out third."""
    return train(docs.where("doc_id is not null and text is not null and lang is not null").where(~held_out("doc_id", 3, 1)).select("text", "lang"), most_bytes)
