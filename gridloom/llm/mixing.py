"""Mixing sources to target weights: tempered shares, realised as budgeted block permutations.

DataFrame functions only; the exponent is bisected inside the plan."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import materialize

#: Steps of the bisection: the interval [0, 1] ends below double precision.
STEPS = 60


def token_estimate(text: str | Column) -> Column:
    """Four UTF-8 bytes a token, rounded up; a null or empty text has none."""
    size = F.octet_length(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    return F.floor((size + 3) / 4).cast("long")


def _source(col: str) -> Column:
    """A source's name; a null source is one of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("null"))


def weights(docs: DataFrame, max_repetition: float | None = 2.0, target_entropy: float | None = None, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(source, tokens, weight, repetition, whole, rest)`` for every source.

    Weights are token shares to the power of an exponent in [0, 1], normalised. The exponent is
    bisected to the largest at which the weights' entropy (nats) is still ``target_entropy``,
    or else to the smallest at which no source repeats more than ``max_repetition`` times. The
    total budget is the least that drops nothing: the source with most tokens per weight is
    used once. ``whole`` epochs and ``rest`` tokens of one more make up a source's budget. A
    source without tokens weighs nothing and is used once. A null source is a source; null
    texts have no tokens; long texts count by their bytes; repeated rows count as often as they
    occur; no rows give no weights.
    """
    if (max_repetition is None) == (target_entropy is None):
        raise ValueError("give either max_repetition or target_entropy")
    sums = docs.select(_source(source_col).alias("source"), token_estimate(text_col).alias("tokens"))
    sums = materialize(sums.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    some = sums.where("tokens > 0")
    ends = some.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"), F.min("tokens").alias("least"), F.max("tokens").alias("most"))
    if max_repetition is not None:
        solved = _fitting_repetition(ends, max_repetition)
    else:
        solved = _fitting_entropy(some, ends, target_entropy)
    # what the sources are weighed by: a row of four numbers, whatever the sources
    total, alpha, pull_least = solved.select("total", "alpha", F.pow(F.col("most") / F.col("total"), F.col("alpha") - 1).alias("pull")).first()
    alpha = 1.0 if alpha is None else alpha
    share = F.col("tokens") / F.lit(total)
    z = some.agg(F.sum(F.pow(share, F.lit(alpha)))).first()[0]
    weighed = F.col("tokens") > 0
    rows = sums.select(
        "source",
        "tokens",
        F.when(weighed, F.pow(share, F.lit(alpha)) / F.lit(z)).otherwise(0.0).alias("weight"),
        F.when(weighed, F.pow(share, F.lit(alpha) - 1) / F.lit(pull_least)).otherwise(1.0).alias("repetition"),
    )
    whole = F.floor(F.col("repetition") + 1e-9).cast("long")
    rest = F.greatest(F.lit(0), F.floor((F.col("repetition") - whole) * F.col("tokens"))).cast("long")
    return rows.select("*", whole.alias("whole"), rest.alias("rest"))


def _fitting_repetition(ends: DataFrame, most: float) -> DataFrame:
    """``ends`` with ``alpha``, the smallest exponent at which the smallest source's share is
    pulled at most ``most`` times as far as the largest one's; all others lie between."""
    least, top = F.col("least") / F.col("total"), F.col("most") / F.col("total")
    fits = lambda a: F.pow(least, a - 1) <= F.pow(top, a - 1) * most

    def halve(s: Column, _: Column) -> Column:
        mid = (s["lo"] + s["hi"]) / 2
        ok = fits(mid)
        return F.struct(F.when(ok, s["lo"]).otherwise(mid).alias("lo"), F.when(ok, mid).otherwise(s["hi"]).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")), halve)
    return ends.withColumn("alpha", F.when(F.coalesce(fits(F.lit(0.0)), F.lit(True)), F.lit(0.0)).otherwise(found["hi"]))


def _fitting_entropy(some: DataFrame, ends: DataFrame, target: float, points: int = 31) -> DataFrame:
    """``ends`` with ``alpha``, the largest exponent at which the weights' entropy is still
    ``target``. Each aggregate over the sources tries ``points`` exponents of the interval that
    is left, so twelve bisect it sixty times."""
    total = ends.first()["total"]
    lo, width = 0.0, 1.0
    while total and width > 2.0**-STEPS:
        tried = [lo + width * (k + 1) / (points + 1) for k in range(points)]
        p = F.col("tokens") / F.lit(total)
        sums = [f for a in tried for f in (F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * F.log(p)))]
        found = some.agg(*[x.alias(f"s{k}") for k, x in enumerate(sums)]).first()
        entropy = [math.log(found[2 * k]) - a * found[2 * k + 1] / found[2 * k] for k, a in enumerate(tried)]
        width /= points + 1
        lo += width * sum(h >= target for h in entropy)  # entropy falls as the exponent grows
    return ends.withColumn("alpha", F.lit(lo))


def _joined(rows: DataFrame, per_source: DataFrame, most_sent: int = 100_000) -> DataFrame:
    """``rows`` with the columns of their source, which may hold a third of all rows: a small
    table of sources is broadcast, a larger one is copied to salts."""
    if per_source.limit(most_sent + 1).count() <= most_sent:
        return rows.join(F.broadcast(per_source), "source")
    salts = 64
    salted = per_source.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")).join(salted, ["source", "salt"]).drop("salt")


def permutation_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix(docs: DataFrame, per_source: DataFrame, block_tokens: int = 250_000, seed: int = 42, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(doc_id, source, epoch, tokens, block, before_tokens, budget_tokens)``: one row for each
    use of each document.

    An epoch of a source is a permutation of its documents by hash, cut into blocks of about
    ``block_tokens``; block totals are summed over blocks and documents within their block, so
    a hot source spreads over its blocks. Rows of one id and size are one row with a count until
    they are placed, so that an id with any share of the rows is no hot block. All documents are in the whole epochs; in the last,
    partial one they are used in order as long as they fit its rest. ``before_tokens`` is the
    source's tokens used earlier: ordering everything by ``before_tokens / budget_tokens``
    interleaves the sources in their weights from beginning to end. Null sources are a source,
    null texts have no tokens, repeated rows are used repeatedly.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _source(source_col).alias("source"), token_estimate(text_col).alias("size")
    )
    # rows of one id and size are interchangeable: one row with a count, the same in every epoch
    rows = _joined(rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies")), per_source)
    last = F.col("whole") - F.when(F.col("rest") > 0, 0).otherwise(1)
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.withColumn("key", permutation_key(seed, F.col("epoch"), F.col("doc_id")))
    blocks = F.ceil(F.greatest(F.col("tokens"), F.lit(1)) / F.lit(block_tokens))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("block", F.floor(place * blocks / F.lit(1 << 32)).cast("long"))
    keys = ["source", "epoch", "block"]
    totals = rows.groupBy(*keys).agg(F.sum(F.col("size") * F.col("copies")).alias("held"))
    bases = _block_bases(totals)
    # texts without tokens in a source without any stand at its start, wherever they lie
    nothing = (F.col("tokens") == 0) & (F.col("size") == 0)
    start = rows.where(nothing).withColumn("before", F.lit(0).cast("long"))
    columns = ["doc_id", *keys, "key", "size", "copies"]
    inner = Window.partitionBy(*keys).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.where(~nothing).select(*columns).withColumn("inner", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inner), F.lit(0)))
    inside = inside.join(bases, keys).withColumn("before", F.col("base") + F.col("inner"))
    placed = _joined(_each_copy(inside.select(*columns, "before").unionByName(start.select(*columns, "before"))), per_source)
    before = F.col("before")
    used = placed.where((F.col("epoch") < F.col("whole")) | (before + F.col("size") <= F.col("rest")))
    return used.select(
        "doc_id",
        F.when(F.col("source") != "null", F.substring("source", 2, 1 << 30)).alias("source"),
        "epoch",
        F.col("size").alias("tokens"),
        "block",
        (F.col("epoch") * F.col("tokens") + before).alias("before_tokens"),
        (F.col("whole") * F.col("tokens") + F.col("rest")).alias("budget_tokens"),
        "key",
        "whole",
    )


#: Copies of one row that a task writes out at a time.
COPIES = 65_536


def _each_copy(rows: DataFrame) -> DataFrame:
    """A row for each of ``copies``, one after the other from ``before`` on; of more than
    ``COPIES`` every stretch is a row of its own, dealt out before it is written out."""
    few = rows.where(F.col("copies") <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    first = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))
    many = rows.where(F.col("copies") > COPIES).withColumn("first", F.explode(first)).repartition("key", "first")
    last = F.least(F.col("first") + COPIES, F.col("copies")) - 1
    many = many.withColumn("copy", F.explode(F.sequence(F.col("first"), last))).drop("first")
    return few.unionByName(many).withColumn("before", F.col("before") + F.col("copy") * F.col("size"))


#: Blocks that one running sum goes over.
STRETCH = 4096


def _block_bases(totals: DataFrame) -> DataFrame:
    """``(source, epoch, block, base)``: the tokens of an epoch's earlier blocks. Running sums go
    over stretches of blocks and then over the stretches, so no task holds a large source's."""
    stretched = totals.withColumn("stretch", F.floor(F.col("block") / STRETCH))
    over = stretched.groupBy("source", "epoch", "stretch").agg(F.sum("held").alias("all_held"))
    prior = lambda *by: Window.partitionBy("source", "epoch", *by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    over = over.select("source", "epoch", "stretch", F.coalesce(F.sum("all_held").over(prior("stretch")), F.lit(0)).alias("far"))
    near = stretched.withColumn("near", F.coalesce(F.sum("held").over(prior("stretch", "block")), F.lit(0)))
    return near.join(over, ["source", "epoch", "stretch"]).select("source", "epoch", "block", (F.col("far") + F.col("near")).alias("base"))


def repeat_documents(docs: DataFrame, max_repetition: float = 2.0, block_tokens: int = 250_000, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` as often as the mixture uses them, columns unchanged, in the order of
    the mixture.

    A use's place in the mixture is the part of its source's budget before it: epoch after
    epoch, in each the documents in the order of their permutation. So all sources run from
    beginning to end side by side, in their weights, and a document's next use comes an epoch
    later. The mixture is cut into blocks of about ``block_tokens``; a partition holds whole
    blocks, each in order, and which ones follow each other is left to a hash: rows that are
    read file by file are a permutation of blocks that each hold the mixture.

    A source's partial epoch ends at one place of its permutation, so that rows are chosen where
    they lie; texts are shuffled once, to their blocks. Rows of one id share their fate in it.
    Their places come from id and text, so that an id with any share of the rows spreads over
    the blocks; only rows equal in both stand together. Null texts, sources and ids and repeated
    rows are used like others; long texts are not cut; no rows give none.
    """
    per_source = materialize(weights(docs, max_repetition), "weights")
    used = mix(docs, per_source, block_tokens, seed)
    partial = used.where(F.col("epoch") == F.col("whole"))
    cut = partial.groupBy(_source("source").alias("source")).agg(F.max(F.struct("key", "doc_id")).alias("cut"))
    budget = F.col("whole") + F.when(F.col("tokens") > 0, F.col("rest") / F.col("tokens")).otherwise(0.0)
    ends = materialize(per_source.join(cut, "source", "left").select("source", "whole", "cut", budget.alias("budget")), "cuts")
    blocks = per_source.agg(F.sum(F.col("tokens") * F.col("repetition"))).first()[0] or 0
    blocks = max(1, math.ceil(blocks / block_tokens))
    names = docs.columns
    rows = _joined(docs.select(F.struct(*[docs[c] for c in names]).alias("row"), _source("source").alias("source"), "doc_id", F.xxhash64("text").alias("of_text")), ends)
    mine = F.struct(permutation_key(seed, F.col("whole"), F.col("doc_id")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"))
    times = F.col("whole").cast("int") + F.when(mine <= F.col("cut"), 1).otherwise(0)
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), times.cast("long") - 1)))
    own = F.concat_ws("/", F.col("doc_id").cast("string"), F.col("of_text").cast("string"))
    rows = rows.withColumn("key", permutation_key(seed, F.col("epoch"), own))
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    # an unfinished epoch's documents are spread over as much of the budget as it fills
    fills = F.least(F.lit(1.0), F.col("budget") - F.col("epoch"))
    rows = rows.withColumn("at", (F.col("epoch") + part * fills) / F.greatest(F.col("budget"), F.lit(1.0)))
    rows = rows.withColumn("block", F.least(F.floor(F.col("at") * blocks), F.lit(blocks - 1)).cast("long"))
    ordered = rows.repartition("block").sortWithinPartitions("block", "at", "key", "doc_id")
    return ordered.select("row.*")
