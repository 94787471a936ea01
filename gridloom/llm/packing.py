"""Packing token streams into fixed sequences by concatenate-and-cut."""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import give_back, materialize

#: Chunks between white space that a worker remembers; about 160 bytes each.
CACHE = 1_200_000
SEPARATOR = "|"
#: A full stop or comma beside another mark; such marks may form one pre-token.
MARKS = re.compile(r"[.,](?:[^\w \n]|_)|(?:[^\w \n]|_)[.,]")


class _Index(dict):
    """Numbers unseen chunks in the order of their first use."""

    def __init__(self):
        super().__init__({"": 0})
        self.new: list[str] = []
        self.size = 1

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        self[chunk] = n = self.size
        self.size = n + 1
        return n


class ChunkEncoder:
    """Token ids of whole texts, from the ids of their white-space separated chunks.

    Valid for tokenizers whose pre-tokenizer drops white space, so that no token spans it and a
    text's ids are its chunks' ids in order. Chunks are remembered, up to a fixed number; the
    ids of a batch's new chunks come from the tokenizer."""

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = cache
        mark = self._ids([SEPARATOR, f"a {SEPARATOR} b", "a", "b"])
        alone = len(mark[0]) == 1 and [*mark[2], *mark[0], *mark[3]] == [*mark[1]]
        self.mark = int(mark[0][0]) if alone else None
        spec = json.loads(self.tokenizer.to_str())
        apart = self._ids(["ab  cd\n e", "ab", "cd", "e", " ", "\t\n"])
        if [*apart[0]] != [*apart[1], *apart[2], *apart[3]] or len(apart[4]) or len(apart[5]):
            raise ValueError(f"{path}: tokens of white space, so chunks can't be encoded one by one")
        self.lowers = "Lowercase" in json.dumps(spec["normalizer"])
        self.parts_marks = r"[^\\s\\p{L}\\p{N}]+" in json.dumps(spec["pre_tokenizer"])
        self.clear()

    def _plain(self, text: str) -> str:
        """The text in a form with the same ids and fewer different chunks: lower case, where
        the tokenizer lower-cases, and stops and commas apart from the word before, where it
        parts them."""
        text = text.replace("\n", " ")
        if self.lowers and (text.isascii() or ("Σ" not in text and unicodedata.is_normalized("NFC", text))):
            text = text.lower()
        if self.parts_marks and not MARKS.search(text):
            text = text.replace(".", " .").replace(",", " ,")
        return text

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def clear(self) -> None:
        self.index = _Index()
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(2, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        joins = self.mark is not None and not any(SEPARATOR in c for c in chunks)
        flat, size = [self.flat], [self.starts]
        for at in range(0, len(chunks), 2048):
            part = chunks[at : at + 2048]
            if joins:
                ids = self._ids([f" {SEPARATOR} ".join(part)])[0]
                inner = ids != self.mark
                ends = np.append(np.flatnonzero(~inner), len(ids))
                flat.append(ids[inner])
                size.append(size[-1][-1] + ends - np.arange(len(ends)))
            else:
                each = self._ids(part)
                flat += each
                size.append(size[-1][-1] + np.cumsum([len(x) for x in each]))
        self.flat, self.starts = np.concatenate(flat), np.concatenate(size)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and each text's number of ids."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if self.index.size > self.limit:
            self.clear()
        texts = [self._plain(t) for t in texts]
        words = np.array([t.count(" ") + 1 for t in texts])
        chunks = " ".join(texts).split(" ")
        which = np.fromiter(map(self.index.__getitem__, chunks), dtype=np.int64, count=len(chunks))
        if new := self.index.new:
            plain = [c for c in new if SEPARATOR not in c]
            if len(plain) < len(new):
                marked = [c for c in new if SEPARATOR in c]
                first = self.index.size - len(new)
                for n, c in enumerate(plain + marked, first):
                    self.index[c] = n
                self._learn(plain)
                self._learn(marked)
                which = np.fromiter(map(self.index.__getitem__, chunks), dtype=np.int64, count=len(chunks))
            else:
                self._learn(new)
            self.index.new = []
        begin, size = self.starts[which], self.starts[which + 1] - self.starts[which]
        ends = np.cumsum(size)
        take = np.arange(int(ends[-1])) + np.repeat(begin - ends + size, size)
        return self.flat[take], np.add.reduceat(size, np.cumsum(words) - words)


@lru_cache(maxsize=1)
def encoder_for(path: str) -> ChunkEncoder:
    """One encoder for all tasks that a Python worker runs."""
    return ChunkEncoder(path)


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", batch_chars: int = 4_000_000) -> DataFrame:
    """First pass: ``(part, local_start, doc_id, doc_tokens, ids binary)``.

    ``part`` is the task's partition and ``local_start`` the ids before the document in it;
    ``ids`` holds little-endian unsigned 32-bit ids, ``end_id`` last. A null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        encoder = encoder_for(tokenizer_path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            sizes = np.cumsum([len(t) for t in texts])
            cuts = [0, *np.searchsorted(sizes, np.arange(batch_chars, (sizes[-1] if len(sizes) else 0) + 1, batch_chars)), len(texts)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                flat, n = encoder.encode(texts[lo:hi])
                n = n + 1
                ends = np.cumsum(n)
                whole = np.full(int(ends[-1]), end_id, dtype="<u4")
                keep = np.ones(len(whole), dtype=bool)
                keep[ends - 1] = False
                whole[keep] = flat
                starts = seen + ends - n
                seen += int(ends[-1])
                raw = pa.py_buffer(whole.tobytes())
                offsets = pa.py_buffer(np.concatenate([[0], 4 * ends]).astype(np.int64).tobytes())
                ids = pa.Array.from_buffers(pa.large_binary(), len(n), [None, offsets, raw]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int64)), pa.array(starts), b.column(0).slice(lo, hi - lo), pa.array(n), ids],
                    names=["part", "local_start", "doc_id", "doc_tokens", "ids"],
                )
        give_back()

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "part long, local_start long, doc_id long, doc_tokens long, ids binary")


def with_global_start(tokens: DataFrame, most_sent: int = 200_000) -> DataFrame:
    """Second half of the prefix sum: one total per partition of the first pass, summed in
    partition order, gives each partition's place in the stream. The totals are one row per
    input partition; they are joined by Spark's own choice of strategy."""
    totals = tokens.groupBy("part").agg(F.max(F.col("local_start") + F.col("doc_tokens")).alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    if totals.limit(most_sent + 1).count() <= most_sent:
        bases = F.broadcast(bases)
    return tokens.join(bases, "part").withColumn("global_start", F.col("base") + F.col("local_start"))


def cut(tokens: DataFrame, length: int, with_ids: bool = False) -> DataFrame:
    """Cut the concatenated stream at every multiple of ``length``: one row per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, n = b.column(1).to_numpy(), b.column(2).to_numpy()
            ids = b.column(3).to_pylist()
            pieces = (first + n - 1) // length - first // length + 1
            row = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[row] // length + nth
            start = np.maximum(0, sequence * length - first[row])
            size = np.minimum(n[row], (sequence + 1) * length - first[row]) - start
            parts = [ids[r][4 * s : 4 * (s + k)] for r, s, k in zip(row.tolist(), start.tolist(), size.tolist())]
            out = {
                "doc_id": b.column(0).take(pa.array(row)),
                "start": start,
                "length": size,
                "ids_crc32": np.fromiter(map(zlib.crc32, parts), np.int64, len(parts)),
                "doc_tokens": n[row],
                "sequence_id": sequence,
                "offset": first[row] + start - sequence * length,
            }
            if with_ids:
                out["ids"] = pa.array(parts, pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return tokens.select("doc_id", "global_start", "doc_tokens", "ids").mapInArrow(run, schema + ", ids binary" * with_ids)


def pack(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pack every row of ``docs`` into sequences of ``length`` ids: all documents, each closed
    by ``end_id``, are one stream that is cut at multiples of ``length``, so only the last
    sequence is ever padded. One row per piece; ``with_ids`` adds the piece's ids.

    The ids are computed once and written to the shared folder, so a retried task cannot change
    the order that the prefix sums rest on; no text or ids are shuffled. Null and empty texts
    are documents of the end id alone, a null ``doc_id`` stays null, repeated rows are packed
    as often as they occur, and no rows give no pieces.
    """
    tokens = materialize(tokenize(docs, tokenizer_path, end_id, id_col, text_col), "tokens")
    return cut(with_global_start(tokens), length, with_ids)
