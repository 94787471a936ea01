"""Lattice arithmetic as column expressions: names, coordinates, pixels, cells, shards, levels.

Refusals are part of the expressions: a value off the lattice raises when it is evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.spec import GRID, EncodingSpec, GridSpec

TILE_NAME = r"^tileSG-(\d{3})-(\d{3})_(\d)-(\d)\.tif$"
SNAP = 1e-6


def guard(ok: Column, value: Column, message: Column | str) -> Column:
    """``value``, or an error where ``ok`` doesn't hold."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(ok, value).otherwise(F.raise_error(text))


def parse_tile_name(name: Column, tile_px: Column | int, grid: GridSpec = GRID) -> Column:
    """struct(cell_row, cell_col, sub_row, sub_col); sub-tiles count from 1 and must exist."""
    part = lambda i: F.regexp_extract(name, TILE_NAME, i).cast("int")
    per_side = F.floor(F.lit(grid.cell_px) / (F.lit(tile_px) if isinstance(tile_px, int) else tile_px))
    ok = F.when(name.rlike(TILE_NAME), part(3).between(1, per_side) & part(4).between(1, per_side)).otherwise(F.lit(False))
    parsed = F.struct(part(1).alias("cell_row"), part(2).alias("cell_col"), part(3).alias("sub_row"), part(4).alias("sub_col"))
    return guard(ok, parsed, F.concat(F.lit("not a tile name: "), F.coalesce(name, F.lit("null"))))


def cell_name(row: Column, col: Column) -> Column:
    return F.format_string("tileSG-%03d-%03d", row, col)


def tile_name(row: Column, col: Column, sub_row: Column, sub_col: Column) -> Column:
    return F.format_string("tileSG-%03d-%03d_%d-%d.tif", row, col, sub_row, sub_col)


def tile_relpath(row: Column, col: Column, sub_row: Column, sub_col: Column) -> Column:
    return F.concat(cell_name(row, col), F.lit("/"), tile_name(row, col, sub_row, sub_col))


def tile_origin(row: Column, col: Column, sub_row: Column, sub_col: Column, tile_px: Column | int, grid: GridSpec = GRID) -> tuple[Column, Column]:
    """x and y of a tile's upper left corner."""
    size = (F.lit(tile_px) if isinstance(tile_px, int) else tile_px) * grid.pixel
    cell = grid.cell_px * grid.pixel
    return F.lit(grid.x_min) + col * cell + (sub_col - 1) * size, F.lit(grid.y_max) - row * cell - (sub_row - 1) * size


def xy_to_pixel(x: Column, y: Column, grid: GridSpec = GRID) -> tuple[Column, Column]:
    """Pixel offsets of a lattice corner, both ends of the grid included; refuses positions
    off the lattice or outside of the grid."""
    out = []
    for value, size in (((x - grid.x_min) / grid.pixel, grid.width), ((F.lit(grid.y_max) - y) / grid.pixel, grid.height)):
        near = F.rint(value)
        ok = (F.abs(value - near) <= SNAP) & near.between(0, size)
        out.append(guard(ok, near.cast("long"), F.concat(F.lit("off the lattice: "), value.cast("string"))))
    return out[0], out[1]


def axis_ratio(px: Column, grid: GridSpec = GRID) -> Column:
    """How many grid pixels a source pixel spans; a whole number from 1 on."""
    ratio = px / grid.pixel
    near = F.rint(ratio)
    return guard((near >= 1) & (F.abs(ratio - near) <= 1e-9), near.cast("long"), F.concat(F.lit("not a whole pixel ratio: "), px.cast("string")))


def axis_offset(position: Column, ratio: Column) -> Column:
    """Strict on an axis of the grid's own pixels, rounded on a coarse one."""
    near = F.rint(position)
    ok = (ratio > 1) | (F.abs(position - near) <= SNAP)
    return guard(ok, near.cast("long"), F.concat(F.lit("off the lattice: "), position.cast("string")))


def source_window(tie_x: Column, tie_y: Column, px: Column, py: Column, width: Column, height: Column, grid: GridSpec = GRID) -> Column:
    """struct(x_off, y_off, width, height, rx, ry) of a source on the grid, axis by axis."""
    rx, ry = axis_ratio(px, grid), axis_ratio(py, grid)
    x = axis_offset((tie_x - grid.x_min) / grid.pixel, rx)
    y = axis_offset((F.lit(grid.y_max) - tie_y) / grid.pixel, ry)
    fits = (x >= 0) & (y >= 0) & (x + width * rx <= grid.width) & (y + height * ry <= grid.height)
    window = F.struct(x.alias("x_off"), y.alias("y_off"), (width * rx).alias("width"), (height * ry).alias("height"), rx.alias("rx"), ry.alias("ry"))
    return guard(fits, window, "the source window isn't inside the grid")


def mosaic_offset(geotransform: Column, grid: GridSpec = GRID) -> tuple[Column, Column]:
    """Where a mosaic's corner lies on the grid, from its six numbers; other pixels are refused."""
    ok = (geotransform[1] == grid.pixel) & (geotransform[5] == -grid.pixel)
    x, y = xy_to_pixel(geotransform[0], geotransform[3], grid)
    return guard(ok, x, "a mosaic of other pixels"), guard(ok, y, "a mosaic of other pixels")


def div(a: Column, b: Column | int) -> Column:
    """Whole-number division of non-negative numbers."""
    return F.floor(a / (F.lit(b) if isinstance(b, int) else b)).cast("long")


def cells_touching(df: DataFrame, x_off: str, y_off: str, width: str, height: str, cell_px: int = GRID.cell_px) -> DataFrame:
    """One row per cell that a rectangle touches; a degenerate rectangle touches none."""
    some = df.where((F.col(width) > 0) & (F.col(height) > 0))
    last = lambda off, size: div(F.col(off) + F.col(size) - 1, cell_px)
    rows = some.withColumn("cell_row", F.explode(F.sequence(div(F.col(y_off), cell_px), last(y_off, height))))
    return rows.withColumn("cell_col", F.explode(F.sequence(div(F.col(x_off), cell_px), last(x_off, width))))


def all_cells(spark: SparkSession, grid: GridSpec = GRID) -> DataFrame:
    """Every cell in raster order."""
    ids = spark.range(grid.cell_rows * grid.cell_cols)
    return ids.select(div(F.col("id"), grid.cell_cols).cast("int").alias("cell_row"), (F.col("id") % grid.cell_cols).cast("int").alias("cell_col"))


def cell_offset(row: Column, col: Column, grid: GridSpec = GRID) -> tuple[Column, Column]:
    """Pixel offsets (x, y) of a cell's corner."""
    return col * grid.cell_px, row * grid.cell_px


def candidate_tiles(cells: DataFrame, tile_px: int, grid: GridSpec = GRID) -> DataFrame:
    """Every tile that a cell could have, with its name and path."""
    per_side = grid.cell_px // tile_px
    each = F.sequence(F.lit(1), F.lit(per_side))
    rows = cells.withColumn("sub_row", F.explode(each)).withColumn("sub_col", F.explode(each))
    parts = [F.col(c) for c in ("cell_row", "cell_col", "sub_row", "sub_col")]
    return rows.withColumn("name", tile_name(*parts)).withColumn("relpath", tile_relpath(*parts))


def shard_windows(cells: DataFrame, encoding: EncodingSpec, grid: GridSpec = GRID) -> DataFrame:
    """The shards (y0, y1, x0, x1) that tile each cell."""
    if grid.cell_px % encoding.shard:
        raise ValueError("a cell isn't a whole number of shards")
    steps = F.sequence(F.lit(0), F.lit(grid.cell_px - encoding.shard), F.lit(encoding.shard))
    rows = cells.withColumn("dy", F.explode(steps)).withColumn("dx", F.explode(steps))
    y0 = F.col("cell_row") * grid.cell_px + F.col("dy")
    x0 = F.col("cell_col") * grid.cell_px + F.col("dx")
    return rows.select(
        "cell_row", "cell_col", y0.alias("y0"), (y0 + encoding.shard).alias("y1"), x0.alias("x0"), (x0 + encoding.shard).alias("x1")
    )


def pixel_centre_x(ix: Column, factor: Column | int = 1, grid: GridSpec = GRID) -> Column:
    return F.lit(grid.x_min) + (ix + 0.5) * grid.pixel * (F.lit(factor) if isinstance(factor, int) else factor)


def pixel_centre_y(iy: Column, factor: Column | int = 1, grid: GridSpec = GRID) -> Column:
    return F.lit(grid.y_max) - (iy + 0.5) * grid.pixel * (F.lit(factor) if isinstance(factor, int) else factor)


def levels(spark: SparkSession, factors: tuple[int, ...], grid: GridSpec = GRID) -> DataFrame:
    """(factor, height, width, pixel, geotransform) of each level; all share the origin."""
    rows = []
    for f, (h, w) in grid.level_shapes(factors).items():
        coarse = GridSpec(grid.x_min, grid.y_max, grid.pixel * f, w, h, 1)
        rows.append((f, h, w, grid.pixel * f, coarse.geotransform))
    return spark.createDataFrame(rows, "factor int, height int, width int, pixel double, geotransform string")
