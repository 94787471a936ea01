"""Ledgers as append-only rows; sets are their distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expected_cells(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("property").agg(F.countDistinct("cell_row", "cell_col").alias("expected"))


def union(ledger: DataFrame, more: DataFrame) -> DataFrame:
    """Set union of two ledgers of the same columns."""
    return ledger.unionByName(more.select(ledger.columns)).distinct()


def done_cells(ledger: DataFrame) -> DataFrame:
    return ledger.select("property", "cell_row", "cell_col").distinct()


def complete_properties(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Properties all of whose cells are done, derived rather than recorded: nothing is left
    over after an anti-join, whichever runs finished the cells."""
    wanted = manifest.select("property", F.col("cell_row").cast("int"), F.col("cell_col").cast("int")).distinct()
    left = wanted.join(done_cells(ledger), ["property", "cell_row", "cell_col"], "left_anti").select("property").distinct()
    return wanted.select("property").distinct().join(left, "property", "left_anti")


def coarse_fills(rows: DataFrame) -> DataFrame:
    """Pixels filled by source and depth, summed over the cells and runs that filled them."""
    return rows.groupBy("property", "source", "depth").agg(F.sum("pixels_filled").alias("pixels_filled"))


def status(expected: DataFrame, done: DataFrame, built: DataFrame, tokens: DataFrame) -> DataFrame:
    """The status matrix: cells done of those expected, the state, and the pyramid's."""
    n = done_cells(done).groupBy("property").agg(F.count("*").alias("done"))
    rows = expected.join(n, "property", "left").withColumn("done", F.coalesce("done", F.lit(0)))
    rows = rows.join(built.select("property").distinct().withColumn("built", F.lit(True)), "property", "left")
    rows = rows.join(tokens.groupBy("property").agg(F.max("done").alias("regions_done")), "property", "left")
    state = F.when(F.col("done") == 0, "empty").when(F.col("done") < F.col("expected"), "partial").otherwise("complete")
    pyramid = F.when(F.col("built"), "built").when(F.col("regions_done").isNotNull(), "in progress").otherwise("none")
    return rows.select("property", "done", "expected", state.alias("state"), pyramid.alias("overviews"))
