"""Exact removal of repeated byte strings by a prefix-free parse of the corpus.

A string of ``width`` bytes (100) is repeated if it also starts earlier in corpus order. Texts
are parsed into overlapping phrases that depend on their bytes alone: a window of ``width``
bytes is triggered by the least rolling hash among its 32-byte strings, and the windows with
one trigger, together ``width - 1`` bytes longer than they are many, make a phrase. So each
window lies in exactly one phrase, equal windows have equal triggers, and a phrase's
occurrences all have the same windows. The corpus order of suffixes then splits as usual:

* parse: of each distinct phrase only its first occurrence can hold a first window;
* dictionary: among distinct phrases that share a trigger, suffixes are ordered by their first
  ``width`` bytes, and of each class of equal ones only the first in the corpus stays.

Windows and phrases are compared by hashes of 128 bits, of two families, that mix non-linearly
at each doubling of their length: with 10^14 windows the chance that any two different ones meet
is below 10^-10.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import materialize, utf8

TRIGGER = 32
CHUNK = 1 << 21
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: A number for each byte, for either family of hashes.
_BYTE, _BYTE_2 = (np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1) for seed in (2024, 2025))


def _join_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two adjacent strings from their own hashes; order matters."""
    out = a * _M1
    out ^= out >> np.uint64(29)
    out += b
    out *= _M2
    out ^= out >> np.uint64(32)
    return out


def window_hashes(buffer: np.ndarray, width: int, byte: np.ndarray = _BYTE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 32-byte and of the ``width``-byte string that starts at each position,
    by doubling: 1, 2, 4 ... bytes, and the binary digits of ``width`` put together. ``byte``
    names the family."""
    level, size = byte[buffer], 1
    whole, taken, trigger = None, 0, None
    parts = {}
    while size <= width:
        parts[size] = level
        if size == TRIGGER:
            trigger = level
        if 2 * size > width:
            break
        level = _join_hashes(level[: len(level) - size], level[size:])
        size *= 2
    for size in sorted(parts, reverse=True):
        if width & size:
            piece = parts[size]
            if whole is None:
                whole = piece
            else:
                n = len(buffer) - taken - size + 1
                whole = _join_hashes(whole[:n], piece[taken : taken + n])
            taken += size
    return trigger, whole


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The minimum of each ``span`` values in a row, by doubling."""
    size, level = 1, values
    while 2 * size <= span:
        level = np.minimum(level[: len(level) - size], level[size:])
        size *= 2
    if size < span:
        level = np.minimum(level[: len(values) - span + 1], level[span - size :])
    return level


def parse(texts: list[bytes], width: int) -> dict[str, np.ndarray]:
    """The phrases of some texts: text number, first window's start, number of windows, hashes
    of the first and last window, and the trigger's hash. Texts shorter than ``width`` bytes
    have none. Also ``hashes``, one for each byte position, and the texts' places."""
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size)
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    n = len(buffer) - width + 1
    none = {k: np.zeros(0, np.int64) for k in ("text", "start", "windows")} | {k: np.zeros(0, np.uint64) for k in ("first", "last", "trigger")}
    begin = ends - size
    if n <= 0:
        return none | {"hashes": np.zeros(0, np.uint64), "begin": begin}
    trigger, hashes = window_hashes(buffer, width)
    # the leftmost least trigger: its hash's high bits, then its place in the buffer
    places = np.arange(len(trigger), dtype=np.uint64)
    keyed = (trigger & ~np.uint64((1 << 23) - 1)) | places
    owner = (_least(keyed, width - TRIGGER + 1) & np.uint64((1 << 23) - 1)).astype(np.int64)
    inside = np.zeros(n + 1, np.int8)
    has = size >= width
    np.add.at(inside, begin[has], 1)
    np.add.at(inside, (ends - width + 1)[has], -1)
    valid = np.cumsum(inside[:n]) > 0
    fresh = np.ones(n, bool)
    fresh[1:] = owner[1:] != owner[:-1]
    fresh[begin[has]] = True
    fresh &= valid
    start = np.flatnonzero(fresh)
    stop = np.append(start[1:], n)
    text = np.searchsorted(ends, start, side="right")
    stop = np.minimum(stop, ends[text] - width + 1)
    return {
        "text": text,
        "start": start - begin[text],
        "windows": stop - start,
        "first": hashes[start],
        "last": hashes[stop - 1],
        "trigger": trigger[owner[start]],
        "hashes": hashes,
        "begin": begin,
    }


def _groups(texts: list[bytes], width: int, most: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Parts of about ``most`` bytes: row numbers, offsets in their texts, bytes. Only texts
    longer than ``most`` are split, with ``width - 1`` bytes in common, so that every window is
    in one part; a split merely begins a new phrase."""
    rows, offsets, held, total = [], [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - width + 1), most):
            rows.append(i)
            offsets.append(at)
            held.append(t[at : at + most + width - 1])
            total += len(held[-1])
            if total >= most:
                yield np.array(rows), np.array(offsets), held
                rows, offsets, held, total = [], [], [], 0
    if rows:
        yield np.array(rows), np.array(offsets), held


#: A run of windows in one number: its start above, the number of windows below.
RUN = 32
PHRASES = "trigger long, phrase long, doc_id long, run long"


def phrases(docs: DataFrame, width: int) -> DataFrame:
    """The parse of every text: the trigger's hash, the phrase's, document and run of windows.
    Of equal phrases in one batch only the first occurrence goes on as a phrase; the others
    are known to be repeated and travel as runs with phrase 0, so that a passage in very many
    texts sends one row a batch. Trigger and phrase together are a hash of 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            out: list[dict[str, np.ndarray]] = []
            for rows, offsets, texts in _groups(utf8(b.column(1)), width):
                p = parse(texts, width)
                phrase = _join_hashes(_join_hashes(p["first"], p["last"]), p["windows"].astype(np.uint64))
                out.append(
                    {
                        "trigger": p["trigger"],
                        "phrase": np.maximum(phrase, np.uint64(1)),
                        "doc_id": ids[rows[p["text"]]].astype(np.int64),
                        "start": p["start"] + offsets[p["text"]],
                        "windows": p["windows"],
                    }
                )
            rows = {k: np.concatenate([o[k] for o in out]) for k in out[0]} if out else {}
            if not rows or not len(rows["doc_id"]):
                continue
            order = np.lexsort((rows["start"], rows["doc_id"], rows["phrase"]))
            phrase, trigger = rows["phrase"][order], rows["trigger"][order]
            again = np.zeros(len(order), bool)
            again[order[1:]] = (phrase[1:] == phrase[:-1]) & (trigger[1:] == trigger[:-1])
            new = {k: v[~again] for k, v in rows.items()}
            yield pa.RecordBatch.from_pydict(
                {"trigger": new["trigger"].view(np.int64), "phrase": new["phrase"].view(np.int64), "doc_id": new["doc_id"], "run": new["start"] << RUN | new["windows"]}
            )
            doc, start, windows = merge_ranges(*(rows[k][again] for k in ("doc_id", "start", "windows")))
            yield pa.RecordBatch.from_pydict({"trigger": _spread(doc), "phrase": np.zeros(len(doc), np.int64), "doc_id": doc, "run": start << RUN | windows})

    return docs.mapInArrow(run, PHRASES)


def _spread(doc: np.ndarray) -> np.ndarray:
    """Partitioning keys for rows that only pass through a shuffle."""
    return (doc.astype(np.int64).view(np.uint64) * _M1).view(np.int64)


def packed(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with the texts compressed one by one, for the shuffles that bring
    texts and their runs together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([squeeze(t) for t in utf8(b.column(1))], pa.binary())], names=["doc_id", "text"])

    return docs.mapInArrow(run, "doc_id long, text binary")


def unpacked(column: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(t) for t in column.to_pylist()]


def merge_ranges(doc: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjacent or overlapping runs of windows of a document as one run each."""
    if not len(doc):
        return doc, start, windows
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start + windows)[order]
    first = np.append(True, doc[1:] != doc[:-1])
    # running maximum of ends within a document: ends grow by a document-wise offset
    rank = np.cumsum(first) - 1
    big = int(end.max()) + 1
    reach = np.maximum.accumulate(end + rank * big) - rank * big
    fresh = first.copy()
    fresh[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], reach[last] - start[at]


def window_rows(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(hash, more, doc_id, run)`` for the windows of the ``wanted`` runs, ``hash`` and ``more``
    being the two halves of their hash: one row with no number of windows for the first of equal
    ones in a batch; the others, known to be repeated, as runs with their number."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list("run").alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            runs = b.column(2).to_pylist()
            found: list[np.ndarray] = []
            for rows, offsets, texts in _groups(unpacked(b.column(1)), width):
                buffer = np.frombuffer(b"".join(texts), np.uint8)
                if len(buffer) < width:
                    continue
                _, hashes = window_hashes(buffer, width)
                _, more = window_hashes(buffer, width, _BYTE_2)
                begin = np.cumsum([0, *map(len, texts)])
                for k, (r, off, t) in enumerate(zip(rows, offsets, texts)):
                    own = np.array(runs[r], np.int64)
                    lo = np.maximum(own >> RUN, off)
                    n = np.minimum((own >> RUN) + (own & ((1 << RUN) - 1)), off + len(t) - width + 1) - lo
                    lo, n = lo[n > 0], n[n > 0]
                    if len(n):
                        start = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                        at = start - off + begin[k]
                        found.append(np.stack([hashes[at].view(np.int64), more[at].view(np.int64), np.full(len(start), ids[r]), start]))
            if not found:
                continue
            value, more, doc, start = np.concatenate(found, axis=1)
            order = np.lexsort((start, doc, value))
            again = np.zeros(len(order), bool)
            again[order[1:]] = (value[order][1:] == value[order][:-1]) & (more[order][1:] == more[order][:-1])
            yield pa.RecordBatch.from_pydict({"hash": value[~again], "more": more[~again], "doc_id": doc[~again], "run": start[~again] << RUN})
            doc, start, windows = merge_ranges(doc[again], start[again], np.ones(int(again.sum()), np.int64))
            yield pa.RecordBatch.from_pydict({"hash": _spread(doc), "more": np.zeros(len(doc), np.int64), "doc_id": doc, "run": start << RUN | windows})

    return packed(docs).join(lists, "doc_id").select("doc_id", "text", "runs").mapInArrow(run, "hash long, more long, doc_id long, run long")


#: One document in so many is looked at for triggers that very many phrases share, and the
#: share of the sampled phrases from which a trigger counts as one.
LOOKED_AT, HOT = 64, 1 / 2048


def hot_triggers(docs: DataFrame, width: int) -> list[int]:
    """Triggers of very many different phrases, at most ``1 / HOT``: a line in ever other
    surroundings. They are dealt out by phrase, which changes where rows go and not what comes
    of them."""
    some = phrases(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(LOOKED_AT)) == 0), width).where("phrase <> 0")
    counts = materialize(some.groupBy("trigger").count(), "triggers")
    total = counts.agg(F.sum("count")).first()[0] or 0
    return [r["trigger"] for r in counts.where(F.col("count") >= max(64, total * HOT)).select("trigger").collect()]


def repeated_windows(docs: DataFrame, width: int = 100) -> DataFrame:
    """``(doc_id, run)``: the runs of windows of ``docs(doc_id, text)``, ids unique, that also
    start earlier in the corpus."""
    rows = phrases(docs, width)
    hot = F.col("trigger").isin(hot_triggers(docs, width)) & (F.col("phrase") != 0)
    # one shuffle by trigger orders both the occurrences of a phrase and the dictionary; a hot
    # trigger's phrases go apart, and all of them count as sharing it
    rows = rows.withColumn("hot", hot).withColumn("key", F.when(F.col("hot"), F.xxhash64("trigger", "phrase")).otherwise(F.col("trigger")))
    in_order = Window.partitionBy("key").orderBy("trigger", "phrase", "doc_id", "run")
    whole = Window.partitionBy("key")
    real = F.when(F.col("phrase") != 0, F.col("phrase"))
    same = (F.lag("phrase").over(in_order) == F.col("phrase")) & (F.lag("trigger").over(in_order) == F.col("trigger"))
    again = F.coalesce(same, F.lit(False)) | (F.col("phrase") == 0)
    marked = rows.withColumn("again", again).withColumn("shared", F.col("hot") | (F.min(real).over(whole) != F.max(real).over(whole)))
    kept = materialize(marked.where("again or shared").select("doc_id", "run", "again"), "phrases")
    windows = window_rows(docs, kept.where("not again").select("doc_id", "run"), width)
    known = F.col("run").bitwiseAND(F.lit((1 << RUN) - 1)) > 0
    place = F.row_number().over(Window.partitionBy("hash", "more").orderBy("known", "doc_id", "run"))
    later = windows.withColumn("known", known).withColumn("place", place).where("known or place > 1")
    later = materialize(later.select("doc_id", F.when(F.col("known"), F.col("run")).otherwise(F.col("run") + 1).alias("run")), "windows")
    return kept.where("again").select("doc_id", "run").union(later)


def remove_repeats(docs: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row, and the remaining
    bytes with ``with_text``: every byte under a string of ``width`` bytes that also starts
    earlier, in a smaller document or earlier in the same, is removed.

    Null and empty texts stay empty. Rows with equal ids are one after another in an order of
    their texts; rows without an id come last, in the same order. Strings never cross rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    picked = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    numbered, ids = _numbered(picked)
    runs = repeated_windows(numbered, width)
    lists = runs.groupBy("doc_id").agg(F.sort_array(F.collect_list("run")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for text, runs in zip(unpacked(b.column(1)), b.column(2).to_pylist()):
                kept, removed, spans, at = [], 0, 0, 0
                for x in runs or ():  # sorted: runs that touch or overlap are one span
                    lo = x >> RUN
                    hi = lo + (x & ((1 << RUN) - 1)) + width - 1
                    if lo > at or not spans:
                        kept.append(text[at:lo])
                        spans += 1
                        at = lo
                    if hi > at:
                        removed += hi - at
                        at = hi
                kept.append(text[at:])
                rest = b"".join(kept)
                for k, v in zip(out, (len(text), removed, spans, hashlib.sha256(rest).hexdigest(), rest)):
                    out[k].append(v)
            columns = [b.column(0), *(pa.array(out[k], pa.string() if k == "kept_sha256" else pa.int64()) for k in list(out)[:4])]
            names = ["doc_id", *list(out)[:4]]
            if with_text:
                columns.append(pa.array(out["kept"], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    done = packed(numbered).join(lists, "doc_id", "left").select("doc_id", "text", "runs").mapInArrow(run, schema)
    if ids is None:
        return done
    back = ids.withColumnRenamed("doc_id", "number")
    return done.withColumnRenamed("doc_id", "number").join(back, "number").select(F.col("id").alias("doc_id"), *done.columns[1:])


def _numbered(picked: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs(doc_id, text)`` with unique numbers in corpus order. Ids that are already unique
    and without null are the numbers; else rows are numbered by a range sort of their ids."""
    spark = picked.sparkSession
    facts = picked.groupBy("id").count().agg(F.max("count").alias("most"), F.count_if(F.col("id").isNull()).alias("nulls")).first()
    if (facts["most"] or 0) <= 1 and not facts["nulls"]:
        return picked.select(F.col("id").alias("doc_id"), "text"), None
    ordered = picked.sort(F.col("id").asc_nulls_last(), "text").withColumn("doc_id", F.monotonically_increasing_id())
    table = materialize(ordered, "numbered")
    return table.select("doc_id", "text"), table.select("doc_id", "id")
