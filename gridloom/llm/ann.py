"""Approximate nearest neighbours by multiprobe p-stable hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import materialize

#: Values of one hash function: the outermost cells are open.
VALUES = 4
WIDTH = 1.2
MOST_FUNCTIONS = 8


@dataclass(frozen=True)
class Index:
    """Frozen parameters: ``tables`` sets of ``functions`` projections with offsets, the norm
    that vectors are scaled by, and a sample of scaled vectors with their cells and the place in
    it whose product is taken for the cosine of a query's last wanted neighbour.
    At most ``VALUES ** MOST_FUNCTIONS`` cells a table, whatever the number of vectors."""

    planes: np.ndarray  # table, function, dim + 1
    offsets: np.ndarray  # table, function
    norm: float
    sample: np.ndarray  # vector, dim
    place: int
    dim: int

    @cached_property
    def sample_cells(self) -> np.ndarray:
        return np.stack([self.cells(self.sample * self.norm, t) for t in range(len(self.planes))])

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        """The cell of each vector: floor((a.x + b) / w) of every function, in base VALUES.

        Vectors get one more component that makes all norms equal, so that the largest inner
        product is the smallest distance."""
        unit = x / self.norm
        last = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", unit, unit)))
        at = np.c_[unit, last] @ self.planes[table].T + self.offsets[table]
        value = np.clip(np.floor(at / WIDTH), -VALUES // 2, VALUES // 2 - 1).astype(np.int64) + VALUES // 2
        return value @ (VALUES ** np.arange(value.shape[1]))

    def cosines(self, q: np.ndarray) -> np.ndarray:
        """The cosine expected of each query's last wanted neighbour, from its own products
        with the sample: other queries' neighbours, however near, don't count."""
        unit = q / np.linalg.norm(q, axis=1, keepdims=True)
        products = np.sort(unit @ self.sample.T, axis=1)
        return np.clip(products[:, -min(self.place, products.shape[1])], 0.05, 0.98)

    def success(self, q: np.ndarray, cosine: np.ndarray, table: int) -> np.ndarray:
        """For each query, the probability that a neighbour at its expected cosine lies in
        each cell: products of normal masses around the query's shrunken projection."""
        unit = np.c_[q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros(len(q))]
        mean = cosine[:, None] * (unit @ self.planes[table].T)
        sd = np.sqrt(np.maximum(1e-4, 1.0 - cosine**2))[:, None, None]
        edges = (np.arange(1, VALUES) - VALUES // 2) * WIDTH - self.offsets[table][:, None]
        z = (edges[None] - mean[:, :, None]) / (sd * math.sqrt(2))
        below = 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(z))
        mass = np.diff(np.concatenate([np.zeros((*below.shape[:2], 1)), below, np.ones((*below.shape[:2], 1))], axis=2), axis=2)
        out = np.ones((len(q), 1))
        for f in range(mass.shape[1]):
            out = (mass[:, f, :, None] * out[:, None, :]).reshape(len(q), -1)
        return out


def distinct_vectors(vectors: DataFrame, most: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(key binary, ids array<long>)``: each distinct usable vector as little-endian doubles,
    with its ``most`` smallest ids. No query can return more copies of a vector than that, so
    nothing is lost. Nulls, empty or zero vectors and those with null or non-finite components
    are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[bytes, list[int]] = {}
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or not v or any(c is None for c in v):
                    continue
                x = np.array(v, dtype="<f8")
                if np.isfinite(x).all() and x.any():
                    held.setdefault(x.tobytes(), []).append(i)
            rows = [(k, i) for k, ids in held.items() for i in sorted(set(ids))[:most]]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array([i for _, i in rows], pa.int64())], names=["key", "id"])

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.mapInArrow(run, "key binary, id long").distinct()
    rank = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    kept = rows.withColumn("rank", rank).where(F.col("rank") <= most)
    return kept.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def fit(distinct: DataFrame, neighbours: int, tables: int, seed: int = 42, sample: int = 4000) -> Index | None:
    """Parameters from all vectors' number, size and norm, and from a bounded sample of
    ``sample`` vectors (those of smallest hash) for the expected cosines. In the sample a
    query's ``neighbours`` best of all vectors are few and by chance more or fewer; its place
    there lies two deviations and the query itself behind their mean number, so that a handful
    of very near vectors isn't taken for all. The common length is the most frequent one, ties
    to the longer; other lengths take no part."""
    sizes = (
        distinct.select(F.length("key").alias("bytes"), "key")
        .groupBy("bytes")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.desc("bytes"))
        .limit(1)
        .collect()
    )
    if not sizes:
        return None
    size, n = sizes[0]["bytes"], sizes[0]["n"]
    same = distinct.where(F.length("key") == size)
    picked = same.orderBy(F.xxhash64("key"), "key").limit(sample).select("key").collect()
    x = np.stack([np.frombuffer(r["key"], "<f8") for r in picked])
    norm = largest_norm(same)
    mean = neighbours * len(x) / max(1, n)
    place = math.ceil(mean + 2 * math.sqrt(mean * max(0.0, 1 - len(x) / n))) + 1
    functions = int(np.clip(round(math.log(max(n, 1) / 16, VALUES)) if n > 64 else 1, 1, MOST_FUNCTIONS))
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((tables, functions, size // 8 + 1))
    planes *= math.sqrt(size // 8) / np.linalg.norm(planes[:, :, :-1], axis=2, keepdims=True)
    return Index(planes, rng.uniform(0, WIDTH, (tables, functions)), norm, x / norm, place, size // 8)


def largest_norm(distinct: DataFrame) -> float:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = 0.0
        for b in batches:
            for k in b.column(0).to_pylist():
                x = np.frombuffer(k, "<f8")
                top = max(top, float(np.sqrt(x @ x)))
        yield pa.RecordBatch.from_pydict({"norm": [top]})

    return distinct.select("key").mapInArrow(run, "norm double").agg(F.max("norm")).first()[0] * (1 + 1e-12)


def _best(held: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """The ``k`` best rows of each query, nearest first."""
    rows = pd.concat(held, ignore_index=True)
    order = np.lexsort((rows["first"].to_numpy(), -rows["score"].to_numpy(), rows["query"].to_numpy()))
    query = rows["query"].to_numpy()[order]
    start = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, int)
    place = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
    return rows.iloc[order[place < k]]


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    tables: int = 2,
    success: float = 0.72,
    least: int = 400,
    block: int | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """The ``k`` largest inner products for every row of ``queries`` among all rows of
    ``vectors`` but the query's own id: ``(query_id, rank, vec_id, score)``.

    Every table hashes a vector to one cell. A query visits cells in the order of their
    estimated success until these add up to ``success`` (of one table; two that miss 0.28 each
    miss 0.08 together) and hold ``least`` vectors; a cell's vectors are scored exactly, in
    double precision, and the tables' candidates merge. The sampled vectors in its cells give a
    query a floor: ``k + 1`` of its candidates score that much, so what scores less is left at
    once. The index holds every usable vector; equal vectors are scored once and listed by their smallest
    ids, ties going to the smaller id. Vectors that are null, empty, zero, or hold null or
    non-finite components, or are not of the most common length, take no part on either side.

    Cells are packed into blocks of about ``block`` vectors, large cells split over several, so
    a hot cell spreads; a query is sent to a block once, with the list of its cells there. By
    default blocks grow with the root of the number of vectors, from 2048 to 500 000: then both
    the copies of a query and a task's memory grow slower than the input.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    base = materialize(distinct_vectors(vectors, k + 1, id_col, vec_col), "vectors")
    index = fit(base, k, tables)
    if index is None:
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast(index)
    size = 8 * index.dim

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0)
            x = np.frombuffer(b"".join(keys.to_pylist()), "<f8").reshape(-1, sent.value.dim)
            for t in range(tables):
                cell = sent.value.cells(x, t)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(cell), keys, b.column(1)], names=["table", "cell", "key", "first"])

    same = base.where(F.length("key") == size).select("key", F.col("ids")[0].alias("first"))
    rows = materialize(same.mapInArrow(hashed, "table int, cell long, key binary, first long"), "cells")
    counts: dict[int, dict[int, int]] = {t: {} for t in range(tables)}
    for r in rows.groupBy("table", "cell").count().collect():  # at most VALUES ** MOST_FUNCTIONS a table
        counts[r["table"]][r["cell"]] = r["count"]
    held_vectors = sum(counts[0].values())
    block = block or int(np.clip(32 * math.sqrt(held_vectors), 2048, 500_000))
    # blocks of neighbouring cells; a cell of more than one block's size gets several
    first: dict[tuple[int, int], tuple[int, int]] = {}
    used = 0
    for t in range(tables):
        filled = 0
        for cell in sorted(counts[t]):
            n = counts[t][cell]
            if n > block:
                used += 1
                parts = -(-n // block)
                first[t, cell] = (used, parts)
                used += parts
                filled = 0
                continue
            if filled + n > block:
                used, filled = used + 1, 0
            first[t, cell] = (used, 1)
            filled += n
        used += 1
    number = VALUES ** index.planes.shape[1]
    at_block, parts_of, held_in = (np.zeros((tables, number), np.int64) for _ in range(3))
    for (t, cell), (g, parts) in first.items():
        at_block[t, cell], parts_of[t, cell], held_in[t, cell] = g, parts, counts[t][cell]
    plan = spark.sparkContext.broadcast((at_block, parts_of, held_in))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, _ = plan.value
        for b in batches:
            t, cell, low = (b.column(k).to_numpy() for k in (0, 1, 3))
            yield pa.RecordBatch.from_arrays([pa.array(at[t, cell] + low % parts[t, cell]), *b.columns[1:]], names=["block", "cell", "key", "first"])

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, held = plan.value
        own = sent.value
        for b in batches:
            good = [(i, v) for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if i is not None and v and len(v) == own.dim and None not in v]
            good = [(i, x) for i, x in ((i, np.array(v, "<f8")) for i, v in good) if np.isfinite(x).all() and x.any()]
            for lo in range(0, len(good), 64):
                part = good[lo : lo + 64]
                q = np.stack([x for _, x in part])
                seen = np.zeros((len(part), len(own.sample)), bool)
                found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # query, block, cell
                cosine = own.cosines(q)
                for t in range(tables):
                    chance = own.success(q, cosine, t)
                    order = np.argsort(-chance, axis=1, kind="stable")
                    sure = np.cumsum(np.take_along_axis(chance, order, 1), axis=1)
                    reached = np.cumsum(held[t][order], axis=1)
                    for r in range(len(part)):
                        enough = max(np.searchsorted(sure[r], success), np.searchsorted(reached[r], min(least, reached[r][-1]))) + 1
                        visited = np.zeros(number, bool)
                        visited[order[r, :enough]] = True
                        seen[r] |= visited[own.sample_cells[t]]
                        cells = np.flatnonzero(visited & (held[t] > 0))
                        copies = parts[t][cells]
                        block_id = np.repeat(at[t][cells] - np.cumsum(copies) + copies, copies) + np.arange(int(copies.sum()))
                        found.append((np.full(len(block_id), r), block_id, np.repeat(cells, copies)))
                scores = np.where(seen, q @ own.sample.T * own.norm, -np.inf)
                if scores.shape[1] > k:
                    floor = np.partition(scores, -k - 1, axis=1)[:, -k - 1] - 1e-9 * own.norm * np.linalg.norm(q, axis=1)
                else:
                    floor = np.full(len(part), -np.inf)
                who, block_id, cell = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((cell, block_id, who))
                who, block_id, cell = who[order], block_id[order], cell[order]
                begin = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (block_id[1:] != block_id[:-1]))) if len(who) else np.zeros(0, int)
                lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(who)).astype(np.int32)), pa.array(cell.astype(np.int32)))
                asking = who[begin]
                columns = [
                    pa.array(block_id[begin]), pa.array(np.array([i for i, _ in part], np.int64)[asking]),
                    pa.array([part[r][1].tobytes() for r in asking], pa.binary()), lists, pa.array(floor[asking]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "query", "key", "cells", "floor"])

    def scored(block_rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": pd.Series(dtype="int64"), "first": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if block_rows.empty or asked.empty:
            return empty
        block_rows = block_rows.sort_values("cell", kind="stable").reset_index(drop=True)
        x = np.frombuffer(b"".join(block_rows["key"]), "<f8").reshape(len(block_rows), -1)
        q = np.frombuffer(b"".join(asked["key"]), "<f8").reshape(len(asked), -1)
        low, own, floor = block_rows["first"].to_numpy(), asked["query"].to_numpy(), asked["floor"].to_numpy()
        cell = block_rows["cell"].to_numpy()
        row = np.repeat(np.arange(len(asked)), asked["cells"].map(len))
        wanted = np.concatenate(asked["cells"].to_list())
        order = np.argsort(wanted, kind="stable")
        row, wanted = row[order], wanted[order]
        held, waiting = [], 0
        for c in np.unique(wanted):
            lo, hi = np.searchsorted(cell, [c, c + 1])
            if lo == hi:
                continue
            who = row[slice(*np.searchsorted(wanted, [c, c + 1]))]
            s = q[who] @ x[lo:hi].T
            bound = floor[who]
            if hi - lo > k + 1 and (free := np.isneginf(bound)).any():
                # rows tied with the last one stay, so that ties go by id
                bound[free] = np.partition(s[free], hi - lo - k - 1, axis=1)[:, hi - lo - k - 1] - 1e-12
            a, b = np.nonzero(s >= bound[:, None])
            held.append(pd.DataFrame({"query": who[a], "at": lo + b, "first": low[lo + b], "score": s[a, b]}))
            waiting += len(a)
            if waiting > 500_000:
                held = [_best(held, k + 1)]
                waiting = len(held[0])
        if not held:
            return empty
        best = _best(held, k + 1)
        a, b = best["query"].to_numpy(), best["at"].to_numpy()
        exact = np.einsum("ij,ij->i", q[a], x[b])
        return pd.DataFrame({"query": own[a], "first": low[b], "score": exact})

    left = rows.mapInArrow(placed, "block long, cell long, key binary, first long").groupBy("block")
    asked = queries.select(F.col(id_col).cast("long").alias("query"), F.col(vec_col).cast("array<double>").alias("v"))
    right = asked.mapInArrow(probed, "block long, query long, key binary, cells array<int>, floor double").groupBy("block")
    found = left.cogroup(right).applyInPandas(scored, "query long, first long, score double")
    merged = found.groupBy("query", "first").agg(F.max("score").alias("score"))
    # k + 1 vectors hold k ids besides the query's own, whatever their copies
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "first"))
    few = merged.withColumn("place", best).where(F.col("place") <= k + 1)
    listed = few.join(base.select(F.col("ids")[0].alias("first"), "ids"), "first")
    listed = listed.select("query", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    ranked = listed.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
