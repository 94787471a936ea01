"""Validation queries: each returns counts or rows of failures, over all data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.units import encode
from gridloom.operators.pyramid import reduce_level
from gridloom.spec import NODATA

PIXEL = ["property", "depth_idx", "y", "x"]


def structure(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Two catalogues ``(path, item, value)`` compared both ways."""
    both = expected.withColumnRenamed("value", "wanted").join(actual.withColumnRenamed("value", "found"), ["path", "item"], "full")
    return both.select(
        F.concat_ws(":", "path", "item").alias("check"),
        F.col("wanted").eqNullSafe(F.col("found")).alias("passed"),
        F.concat(F.lit("wanted "), F.coalesce("wanted", F.lit("nothing")), F.lit(", found "), F.coalesce("found", F.lit("nothing"))).alias("message"),
    )


def byte_exact(source: DataFrame, stored: DataFrame, divisor: int) -> DataFrame:
    """``(property, pixels, differing)``: source integers against the stored values encoded
    again; a missing row is nodata."""
    joined = source.select(*PIXEL, "raw").join(stored.select(*PIXEL, "value"), PIXEL, "left")
    again = F.coalesce(encode(F.col("value"), divisor), F.lit(NODATA).cast("smallint"))
    return joined.groupBy("property").agg(F.count("*").alias("pixels"), F.count_if(again != F.col("raw")).alias("differing"))


def coarse_holes(expanded: DataFrame, covered: DataFrame, stored: DataFrame, filled_cells: DataFrame, cell_px: int) -> DataFrame:
    """Coarse pixels with a value that nothing covers, in cells that are filled, and that are
    nevertheless missing: there must be none."""
    from gridloom.functions.lattice import div

    rows = expanded.where("not isnan(value)").withColumn("cell_row", div(F.col("y"), cell_px)).withColumn("cell_col", div(F.col("x"), cell_px))
    rows = rows.join(filled_cells, ["cell_row", "cell_col"], "left_semi")
    return rows.join(covered.select(*PIXEL), PIXEL, "left_anti").join(stored.where("not isnan(value)").select(*PIXEL), PIXEL, "left_anti")


def recompute(parent: DataFrame, level: DataFrame, stride: int, height: int, width: int, tolerance: float = 1e-6) -> DataFrame:
    """Pixels of a level that differ from the means of its parent, missing ones included."""
    again = reduce_level(parent, stride, height, width).withColumnRenamed("value", "again")
    both = again.join(level.where("not isnan(value)").select(*PIXEL, "value"), PIXEL, "full")
    close = F.abs(F.col("value").cast("double") - F.col("again").cast("double")) <= tolerance * F.abs(F.col("again").cast("double"))
    return both.where(~F.coalesce(close, F.lit(False)))


def closure(sand: DataFrame, silt: DataFrame, clay: DataFrame, tolerance: float = 1.5) -> DataFrame:
    """Pixels with all three values, their sums' range, and how many aren't 100 %."""
    part = lambda df, n: df.where("not isnan(value)").select("depth_idx", "y", "x", F.col("value").cast("double").alias(n))
    at = ["depth_idx", "y", "x"]
    total = part(sand, "a").join(part(silt, "b"), at).join(part(clay, "c"), at).select((F.col("a") + F.col("b") + F.col("c")).alias("s"))
    return total.agg(
        F.count("*").alias("pixels"), F.min("s").alias("least"), F.max("s").alias("most"), F.count_if(F.abs(F.col("s") - 100) > tolerance).alias("failed")
    )


def crs_sample(headers: DataFrame, pixel: float) -> DataFrame:
    return headers.select(
        "relpath", F.coalesce(F.lower("header.crs").contains("goode"), F.lit(False)).alias("crs_ok"),
        ((F.col("header.px") == pixel) & (F.col("header.py") == pixel)).alias("pixel_ok"),
    )


def release_gate(expected: DataFrame, complete: DataFrame, built: DataFrame) -> DataFrame:
    """Properties that keep a release from being made."""
    lacks = lambda df, why: expected.select("property").distinct().join(df.select("property"), "property", "left_anti").withColumn("reason", F.lit(why))
    return lacks(complete, "incomplete").unionByName(lacks(built, "no overviews"))


def tally(checks: DataFrame) -> DataFrame:
    return checks.agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))
