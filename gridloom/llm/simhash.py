"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import give_back, materialize, utf8
from gridloom.llm.components import connected_components

BITS = 64
#: Shingles hashed and counted at once, so that memory does not follow the longest text.
BLOCK = 1 << 16


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """The 64-bit SimHash of a text: words split at ASCII white space, A-Z lower-cased,
    ``width``-word shingles with repeats, XXH64 with seed 42, a bit set if it is set in over
    half the hashes. Fewer words than ``width`` make one shingle; no words give 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - width + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, BLOCK):
        part = words[at : min(at + BLOCK, n) + width - 1]
        rows = zip(*(part[k:] for k in range(width))) if len(part) >= width else [tuple(part)]
        hashes = np.fromiter((digest(b" ".join(r), 42) for r in rows), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > n, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, with_text: bool = False) -> DataFrame:
    """``(doc_id, fp long)`` for every row, the fingerprint as a signed 64-bit number, and the
    text beside it with ``with_text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, width) for t in utf8(b.column(1))], dtype=np.int64)
            more = ([b.column(1)], ["text"]) if with_text else ([], [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps), *more[0]], names=["doc_id", "fp", *more[1]])
        give_back()

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, fp long" + ", text string" * with_text)


def half_masks(half: int) -> tuple[list[int], list[int], list[int]]:
    """For one half of the word: its single bits, its pairs of bits, the other half's bits."""
    signed = lambda m: m - (1 << BITS) if m >> (BITS - 1) else m
    size = BITS // 2
    own = [1 << i for i in range(half * size, (half + 1) * size)]
    other = [1 << i for i in range((1 - half) * size, (2 - half) * size)]
    pairs = [x | y for i, x in enumerate(own) for y in own[i + 1 :]]
    return list(map(signed, own)), list(map(signed, pairs)), list(map(signed, other))


def ball_links(nodes: DataFrame) -> DataFrame:
    """Links among distinct fingerprints ``nodes(node, fp)`` at three or fewer differing bits.

    Meet in the middle: every fingerprint has as variants all words of its near ball (at most
    one bit away), and those of odd parity also words two bits away; equal variants meet. Two
    fingerprints three bits apart differ in parity, and two of the three bits lie in the same
    half of the word, so the words two bits away need only pairs within a half: 992 of 2016.

    A fingerprint at most one bit from a variant is within two bits of every other such and
    within three of every one two bits away, so a variant links all its rows to its smallest
    near one; a variant without a near row links nothing. A variant has at most 2081 rows,
    since they are distinct words of its ball: no group grows with the data.

    The variants are spelled out after the shuffle, not before: it goes by the half that is not
    flipped, so that the 496 pairs of the other half travel as one row. Each link's distance
    is verified after deduplication.
    """
    spark = nodes.sparkSession
    masks = lambda m: F.array(*[F.lit(x).cast("long") for x in m])
    odd = F.bit_count("fp") % 2 == 1
    met = None
    for half in (0, 1):
        single, pairs, across = half_masks(half)
        near = nodes if half == 0 else nodes.where(~odd)
        rows = near.select("node", "fp", F.explode(masks([0, *across])).alias("outer"), F.lit(False).alias("far"))
        rows = rows.union(nodes.where(odd).select("node", "fp", F.lit(0).cast("long"), F.lit(True)))
        word = F.col("fp").bitwiseXOR(F.col("outer"))
        key = F.shiftrightunsigned(word, 32) if half == 0 else word.bitwiseAND(F.lit((1 << 32) - 1))
        rows = rows.withColumn("key", key * 2 + half)
        met = rows if met is None else met.union(rows)
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    met = met.repartition(count, "key")
    inner = F.when(F.col("outer") != 0, masks([0]))
    for half in (0, 1):
        single, pairs, _ = half_masks(half)
        own = F.col("key") % 2 == half
        inner = inner.when(own & F.col("far"), masks(pairs)).when(own, masks([0, *single]))
    met = met.withColumn("inner", F.explode(inner))
    met = met.withColumn("variant", F.col("fp").bitwiseXOR(F.col("outer")).bitwiseXOR(F.col("inner")))
    hub = F.min(F.when(~F.col("far"), F.struct("node", "fp"))).over(Window.partitionBy("key", "variant"))
    links = met.withColumn("hub", hub).where("hub is not null and hub.node <> node").select(
        F.col("hub.node").alias("a"), F.col("node").alias("b"), F.col("hub.fp").alias("fa"), F.col("fp").alias("fb")
    )
    return links.distinct().where(F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= 3).select("a", "b")


def grouped(fps: DataFrame) -> DataFrame:
    """``fps(doc_id, fp)`` as ``(fp, group_fp, component_id)``, one row for each fingerprint:
    the least fingerprint that links reach, and the smallest ``doc_id`` of all of them.

    Fingerprints are the nodes, so copies cost one row each whatever the size of their group,
    and rows of one id with different texts aren't taken for one document."""
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("own")), "nodes")
    links = materialize(ball_links(nodes.select(F.col("fp").alias("node"), "fp")), "links")
    reach = connected_components(links).select(F.col("node").alias("fp"), F.col("component").alias("group_fp"))
    linked = nodes.join(reach, "fp")
    least = linked.groupBy("group_fp").agg(F.min("own").alias("least"))
    linked = linked.join(least, "group_fp").select("fp", "group_fp", "least")
    every = nodes.join(linked, "fp", "left")
    # a table of its own, so that a join with rows has a shuffle on either side: then the rows
    # of a fingerprint that very many texts share are split over tasks
    return materialize(every.select("fp", F.coalesce("group_fp", "fp").alias("group_fp"), F.coalesce("least", "own").alias("component_id")), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Null or empty texts have fingerprint zero and link like any other. A row without ``doc_id``
    keeps its fingerprint and gets the component of the rows that share it, null if none of
    them has an id. Repeated rows stay repeated; of one id with different texts each row has
    the component of its text.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, width), "simhash")
    out = fps.join(grouped(fps), "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Ids that are broadcast; beyond it they meet the documents by a shuffle.
MOST_SENT = 1_000_000


def _meeting(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    few = ids.limit(MOST_SENT + 1).count() <= MOST_SENT
    return docs.join(F.broadcast(ids) if few else ids.hint("merge"), "doc_id", how)


def keep_one_per_group(docs: DataFrame, width: int = 5) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, with five-word shingles by default: the
    one of smallest ``doc_id``. Where several rows of a group have that id, the one of least
    fingerprint and then least hash of all its columns stays; a group of other texts under the
    same id keeps its own row. Rows without an id stay. An empty table gives none.

    Only ids meet the documents, those that go: no text is shuffled while they are at most
    ``MOST_SENT``, which is counted."""
    named = docs.where("doc_id is not null")
    fps = materialize(fingerprints(named, width=width), "simhash")
    groups = materialize(fps.join(grouped(fps), "fp"), "groups")
    ids = groups.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("component_id").alias("kept"))
    ids = materialize(ids.where("rows > 1 or doc_id <> kept"), "ids")
    out = _meeting(named, ids.select("doc_id"), "left_anti")
    several = ids.where("rows > 1").select("doc_id")
    if not several.isEmpty():
        out = out.unionByName(_one_of_each(_meeting(named, several, "left_semi"), groups, width))
    return out.select(docs.columns).union(docs.where("doc_id is null"))


def _one_of_each(rows: DataFrame, groups: DataFrame, width: int) -> DataFrame:
    """``keep_one_per_group`` for the rows of repeated ids."""
    kinds = groups.select("doc_id", "fp", "group_fp", "component_id").distinct()
    marked = fingerprints(rows.select("doc_id", "text"), width=width, with_text=True).distinct()
    names = [f"`{c}`" for c in rows.columns]
    whole = rows.withColumn("__hash", F.xxhash64(*names))
    # the fingerprint comes back by the text's own hash, so that equal ids stay apart
    marked = marked.select("doc_id", F.xxhash64("text").alias("__text"), F.col("fp").alias("__fp")).distinct()
    whole = whole.withColumn("__text", F.xxhash64("text")).join(marked, ["doc_id", "__text"])
    whole = whole.join(kinds.select("doc_id", F.col("fp").alias("__fp"), F.col("group_fp").alias("__group"), F.col("component_id").alias("__least")), ["doc_id", "__fp"])
    best = F.row_number().over(Window.partitionBy("__group").orderBy("__fp", "__hash"))
    kept = whole.where("doc_id = __least").withColumn("__place", best).where("__place = 1")
    return kept.select(*names)
