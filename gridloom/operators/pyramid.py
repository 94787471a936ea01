"""Fill-aware mean pyramid: each level from the one before, one shuffle for all levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.lattice import div
from gridloom.functions.units import valued
from gridloom.spec import FACTORS, GRID, GridSpec


def reduce_level(pixels: DataFrame, stride: int, height: int, width: int, keys: tuple[str, ...] = ("property", "depth_idx")) -> DataFrame:
    """Means over blocks of ``stride`` pixels a side, missing pixels left out, depth never
    reduced, odd edges trimmed to the level's ``height`` and ``width``. Single precision is
    restored at each level: a mean of means isn't the mean of all."""
    inside = pixels.where((F.col("y") < height * stride) & (F.col("x") < width * stride))
    at = lambda c: div(F.col(c), stride).cast("int").alias(c)
    means = inside.withColumn("value", valued(F.col("value"))).groupBy(*keys, at("y"), at("x")).agg(F.avg("value").cast("float").alias("value"))
    return means.where("value is not null")


def pyramid(pixels: DataFrame, factors: tuple[int, ...] = FACTORS, grid: GridSpec = GRID) -> dict[int, DataFrame]:
    """All levels of ``pixels(property, depth_idx, y, x, value)``.

    Every level nests in blocks of the coarsest factor, so one shuffle by that block serves the
    whole chain: the later groupings keep its partitioning. With fewer blocks than cores the
    chain shuffles level by level instead, since the blocks bound the number of tasks."""
    spark = pixels.sparkSession
    top = factors[-1]
    shapes = grid.level_shapes(factors)
    quads = (-(-grid.height // top)) * (-(-grid.width // top))
    keys: tuple[str, ...] = ("property", "depth_idx")
    if quads >= spark.sparkContext.defaultParallelism:
        keys = ("property", "depth_idx", "qy", "qx")
        pixels = pixels.withColumn("qy", div(F.col("y"), top)).withColumn("qx", div(F.col("x"), top)).repartition("qy", "qx")
    out, before = {}, 1
    for f in factors:
        pixels = reduce_level(pixels, f // before, *shapes[f], keys)
        out[f], before = pixels.select("property", "depth_idx", "y", "x", "value"), f
    return out


def regions(cells: DataFrame, factors: tuple[int, ...] = FACTORS, block: int = 450, depths: int = 1, grid: GridSpec = GRID) -> DataFrame:
    """``(factor, depth_idx, by, bx)``: the blocks of each level under the given cells only,
    clipped at the level's edge; this is what prunes a rebuild to land."""
    out = None
    n = grid.cell_px
    for f, (h, w) in grid.level_shapes(factors).items():
        lo = lambda c: div(div(F.col(c) * n, f), block)
        hi = lambda c, size: F.least(F.ceil(F.ceil((F.col(c) + 1) * n / F.lit(f)) / F.lit(block)), F.lit(-(-size // block))) - 1
        spans = cells.select(lo("cell_row").alias("y0"), hi("cell_row", h).alias("y1"), lo("cell_col").alias("x0"), hi("cell_col", w).alias("x1"))
        rows = spans.where("y0 <= y1 and x0 <= x1").select(F.explode(F.sequence("y0", "y1")).alias("by"), "x0", "x1")
        rows = rows.select(F.lit(f).alias("factor"), "by", F.explode(F.sequence("x0", "x1")).alias("bx")).distinct()
        out = rows if out is None else out.union(rows)
    every = F.explode(F.sequence(F.lit(0), F.lit(depths - 1)))
    rows = out.withColumn("depth_idx", every)
    return rows.select("factor", F.col("depth_idx").cast("smallint"), F.col("by").cast("int"), F.col("bx").cast("int"))


def plan_counts(regions_df: DataFrame) -> DataFrame:
    return regions_df.groupBy("factor").agg(F.count("*").alias("regions"))
