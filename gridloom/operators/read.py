"""Reads: profiles, windows, depths, levels. Filters reach the scan; missing pixels are NaN."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.crs import to_metres
from gridloom.functions.lattice import pixel_centre_x, pixel_centre_y
from gridloom.spec import GRID, GridSpec



def nearest_pixel(x: float, y: float, factor: int = 1, grid: GridSpec = GRID) -> tuple[int, int]:
    """(iy, ix) of the pixel whose centre is nearest, clamped to the grid."""
    size = grid.pixel * factor
    ix = int((x - grid.x_min) // size)
    iy = int((grid.y_max - y) // size)
    return min(max(iy, 0), grid.height // factor - 1), min(max(ix, 0), grid.width // factor - 1)


def _missing(value: Column) -> Column:
    return F.coalesce(value, F.lit(float("nan"))).cast("float")


def profile(pixels: DataFrame, depths: DataFrame, x: float, y: float, factor: int = 1, grid: GridSpec = GRID) -> DataFrame:
    """``(depth_idx, depth_interval, value)`` at a place, one row per depth whatever is stored."""
    iy, ix = nearest_pixel(x, y, factor, grid)
    at = pixels.where((F.col("factor") == factor) & (F.col("y") == iy) & (F.col("x") == ix)).select("depth_idx", "value")
    return depths.join(at, "depth_idx", "left").select("depth_idx", "depth_interval", _missing(F.col("value")).alias("value")).orderBy("depth_idx")


def lonlat_profiles(points: DataFrame, pixels: DataFrame, depths: DataFrame, grid: GridSpec = GRID) -> DataFrame:
    """Profiles for a table of points ``(point_id, lon, lat)``: one equi-join on the pixel."""
    x, y = to_metres(F.col("lon"), F.col("lat"))
    ix, iy = F.floor((x - grid.x_min) / grid.pixel).cast("int"), F.floor((F.lit(grid.y_max) - y) / grid.pixel).cast("int")
    wanted = points.select("point_id", iy.alias("y"), ix.alias("x")).crossJoin(F.broadcast(depths.select("depth_idx", "depth_interval")))
    found = wanted.join(pixels.where("factor = 1").select("depth_idx", "y", "x", "value"), ["depth_idx", "y", "x"], "left")
    return found.select("point_id", "depth_idx", "depth_interval", _missing(F.col("value")).alias("value"))


def window(pixels: DataFrame, x0: float, x1: float, y0: float, y1: float, factor: int = 1, grid: GridSpec = GRID) -> DataFrame:
    """Pixels whose centres lie in a closed rectangle, with the centres; y descends."""
    size = grid.pixel * factor
    lo_x, hi_x = (x0 - grid.x_min) / size - 0.5, (x1 - grid.x_min) / size - 0.5
    lo_y, hi_y = (grid.y_max - y1) / size - 0.5, (grid.y_max - y0) / size - 0.5
    # whole bounds, so that the filters reach the scan
    first, last = (lambda v: math.ceil(v - 1e-9)), (lambda v: math.floor(v + 1e-9))
    at = pixels.where(
        (F.col("factor") == factor) & F.col("x").between(first(lo_x), last(hi_x)) & F.col("y").between(first(lo_y), last(hi_y))
    )
    return at.withColumn("cx", pixel_centre_x(F.col("x"), factor, grid)).withColumn("cy", pixel_centre_y(F.col("y"), factor, grid))


def dense_window(pixels: DataFrame, y0: int, y1: int, x0: int, x1: int, depth_idx: int, factor: int = 1) -> DataFrame:
    """Every pixel of a half-open index window, NaN where nothing is stored, single precision."""
    spark = pixels.sparkSession
    index = spark.range(y0, y1).select(F.col("id").cast("int").alias("y")).withColumn("x", F.explode(F.sequence(F.lit(x0), F.lit(x1 - 1))))
    held = pixels.where((F.col("factor") == factor) & (F.col("depth_idx") == depth_idx) & F.col("y").between(y0, y1 - 1) & F.col("x").between(x0, x1 - 1))
    return index.join(held.select("y", "x", "value"), ["y", "x"], "left").select("y", "x", _missing(F.col("value")).alias("value"))


def at_depth(pixels: DataFrame, depths: DataFrame, label: str) -> DataFrame:
    return pixels.join(F.broadcast(depths.where(F.col("depth_interval") == label)), "depth_idx")


def at_level(pixels: DataFrame, factor: int) -> DataFrame:
    return pixels.where(F.col("factor") == factor)
