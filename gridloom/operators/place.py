"""Placement: tiles to canonical pixels, ordered overwrite, coverage and gap fill.

Coverage is a relation of its own: a pixel is covered by every fine tile's rectangle, whether
the tile was read or not and whether it has a value there, and a coarse source never writes
where something covers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.crs import to_metres
from gridloom.functions.lattice import cells_touching, div, guard, source_window
from gridloom.functions.units import decode
from gridloom.spec import BLOCKS, GRID, NODATA, GridSpec, PropertySpec, SpecError

PIXEL = ["property", "depth_idx", "y", "x"]


def by_cell(manifest: DataFrame, prop: str | None = None) -> DataFrame:
    """Each property's, or one property's, tiles by cell: their number, and their rows in
    manifest order. A cell of a property has at most its sub-tiles at its depths."""
    tiles = F.sort_array(F.collect_list(F.struct("ordinal", "depth", "relpath")))
    own = manifest if prop is None else manifest.where(F.col("property") == prop)
    return own.groupBy("property", "cell_row", "cell_col").agg(F.count("*").alias("tiles"), tiles.alias("rows"))


def depth_index(rows: DataFrame, spec: PropertySpec, label: str = "depth") -> DataFrame:
    """``rows`` with ``depth_idx``; an unknown depth raises."""
    known = F.create_map(*[F.lit(x) for i, d in enumerate(spec.depths) for x in (d.label, i)])
    index = F.element_at(known, F.col(label))
    return rows.withColumn("depth_idx", guard(index.isNotNull(), index, F.concat(F.lit("unknown depth "), F.col(label))).cast("smallint"))


def tile_keys(tiles: DataFrame) -> list[str]:
    """What names a tile: its path, and property and depth where the scan tells them, since
    layers repeat each other's paths."""
    return [c for c in ("property", "depth", "relpath") if c in tiles.columns]


def check_tiles(tiles: DataFrame, manifest: DataFrame, grid: GridSpec = GRID) -> DataFrame:
    """The manifest's tiles with their decoded headers and values, after five refusals: nodata,
    pixel size, shape, tie-point, and fit into the grid. A failed read isn't refused: it stays
    a row without values. ``tiles`` has header, values, error and the columns of ``tile_keys``."""
    rows = manifest.join(tiles, tile_keys(tiles))
    h = F.col("header")
    window = source_window(h["tie_x"], h["tie_y"], h["px"], h["py"], h["width"], h["height"], grid)
    refusals = (
        (F.coalesce(h["nodata"], F.lit(NODATA)) == NODATA, "another nodata value"),
        ((h["px"] == grid.pixel) & (h["py"] == grid.pixel), "another pixel size"),
        ((h["width"] == F.col("width")) & (h["height"] == F.col("height")), "another shape than in the manifest"),
        ((window["x_off"] == F.col("x_off")) & (window["y_off"] == F.col("y_off")), "another place than in the manifest"),
    )
    ok: Column = F.lit(True)
    for holds, why in reversed(refusals):
        ok = guard(holds, ok, F.concat(F.col("relpath"), F.lit(f": {why}")))
    return rows.where(F.when(F.col("error").isNull(), ok).otherwise(F.lit(True)))


def source_pixels(rows: DataFrame) -> DataFrame:
    """One row per pixel of every read tile: its canonical place, the source's integer and the
    tile's ordinal."""
    each = rows.where("values is not null").select(
        "property", "depth_idx", "ordinal", "x_off", "y_off", F.col("header.width").alias("w"), F.posexplode("values").alias("pos", "raw")
    )
    return each.select(
        "property",
        "depth_idx",
        (F.col("y_off") + div(F.col("pos"), F.col("w"))).cast("int").alias("y"),
        (F.col("x_off") + F.col("pos") % F.col("w")).cast("int").alias("x"),
        "raw",
        "ordinal",
    )


def place(rows: DataFrame, divisor: int) -> DataFrame:
    """``source_pixels`` with the decoded value (nodata as NaN) for the integer."""
    return source_pixels(rows).select(*PIXEL, decode(F.col("raw"), divisor).alias("value"), "ordinal")


def overwrite(pixels: DataFrame, order: str | Column = "ordinal") -> DataFrame:
    """The last writer of each pixel by manifest order, nodata included: NaN takes part and
    stays NaN. A partial aggregate, so tiles that don't overlap cost no more than their rows."""
    return pixels.groupBy(*PIXEL).agg(F.max_by("value", order).alias("value"))


def covered_pixels(manifest: DataFrame) -> DataFrame:
    """Every pixel under a fine tile's rectangle, whatever became of the tile."""
    rows = manifest.where("not resampled_in_vrt").select("property", "depth_idx", "x_off", "y_off", "width", "height").distinct()
    rows = rows.withColumn("y", F.explode(F.sequence(F.col("y_off"), F.col("y_off") + F.col("height") - 1)))
    rows = rows.withColumn("x", F.explode(F.sequence(F.col("x_off"), F.col("x_off") + F.col("width") - 1)))
    return rows.select(*PIXEL).distinct()


def expand_coarse(sources: DataFrame, grid: GridSpec = GRID) -> DataFrame:
    """Nearest expansion of coarse pixels ``(property, depth_idx, source, rank, x_off, y_off,
    rx, ry, sy, sx, value)`` to grid pixels, clipped to the grid."""
    steps = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1)
    rows = sources.withColumn("dy", F.explode(steps("ry"))).withColumn("dx", F.explode(steps("rx")))
    rows = rows.withColumn("y", (F.col("y_off") + F.col("sy") * F.col("ry") + F.col("dy")).cast("int"))
    rows = rows.withColumn("x", (F.col("x_off") + F.col("sx") * F.col("rx") + F.col("dx")).cast("int"))
    inside = F.col("y").between(0, grid.height - 1) & F.col("x").between(0, grid.width - 1)
    return rows.where(inside).select(*PIXEL, "source", "rank", "value")


def resolve_coarse(rows: DataFrame, grid: GridSpec = GRID) -> DataFrame:
    """The coarse candidates of checked headers: resampled sources whose file isn't of the
    grid's own pixels on both axes, placed by the manifest, at most one pixel from where their
    tie-point lies; with their ratios and coarse pixels, ready to expand."""
    h = F.col("header")
    coarse = rows.where("resampled_in_vrt and error is null").where((h["px"] != grid.pixel) | (h["py"] != grid.pixel))
    window = source_window(h["tie_x"], h["tie_y"], h["px"], h["py"], h["width"], h["height"], grid)
    near = (F.abs(window["x_off"] - F.col("x_off")) <= 1) & (F.abs(window["y_off"] - F.col("y_off")) <= 1)
    placed = coarse.withColumn("window", guard(near, window, F.concat(F.col("relpath"), F.lit(": far from its place in the manifest"))))
    each = placed.select(
        "property", "depth_idx", F.col("relpath").alias("source"), F.col("ordinal").alias("rank"), "x_off", "y_off",
        F.col("window.rx").alias("rx"), F.col("window.ry").alias("ry"), h["width"].alias("w"), F.posexplode("values").alias("pos", "raw"),
    )
    return each.withColumn("sy", div(F.col("pos"), F.col("w"))).withColumn("sx", F.col("pos") % F.col("w"))


def gap_fill(expanded: DataFrame, covered: DataFrame) -> DataFrame:
    """The coarse pixels that are written: valued, where nothing covers, the first source in
    resolve order. Both sides meet on the pixel, never by a comparison of rectangles."""
    gaps = expanded.where("value is not null and not isnan(value)").join(covered.select(*PIXEL), PIXEL, "left_anti")
    first = F.min_by(F.struct("source", "value"), "rank").alias("first")
    return gaps.groupBy(*PIXEL).agg(first).select(*PIXEL, "first.source", "first.value")


def fill_counts(filled: DataFrame, *cell: str) -> DataFrame:
    return filled.groupBy("property", "depth_idx", "source", *cell).agg(F.count("*").alias("pixels_filled"))


def assemble(fine: DataFrame, filled: DataFrame) -> DataFrame:
    """Stored pixels: fine values and gap fills; nothing is a missing row."""
    return fine.where("not isnan(value)").select(*PIXEL, "value").unionByName(filled.select(*PIXEL, "value"))


def without_done(cells: DataFrame, ledger: DataFrame) -> DataFrame:
    """Work that the ledger doesn't have."""
    return cells.join(ledger.select("property", "cell_row", "cell_col"), ["property", "cell_row", "cell_col"], "left_anti")


def only_cells(rows: DataFrame, subset: DataFrame) -> DataFrame:
    return rows.join(subset.select("cell_row", "cell_col"), ["cell_row", "cell_col"], "left_semi")


def without_skipped(manifest: DataFrame, skip: DataFrame) -> DataFrame:
    return manifest.join(skip.select("relpath", "depth"), ["relpath", "depth"], "left_anti")


def anomalies(rows: DataFrame) -> DataFrame:
    """Tiles that failed, and tiles whose strips aren't as in the manifest: both stay in the
    run and are reported."""
    strips = F.col("error").isNull() & (F.col("header.rows_per_strip") != F.col("rows_per_strip"))
    why = F.when(F.col("error").isNotNull(), F.col("error")).when(strips, F.lit("rows per strip differ from the manifest"))
    return rows.withColumn("anomaly", why).where("anomaly is not null").select("property", "depth", "relpath", "anomaly")


def touched_cells(rows: DataFrame, grid: GridSpec = GRID) -> DataFrame:
    return cells_touching(rows, "x_off", "y_off", "width", "height", grid.cell_px)


def cells_in_bbox(spark, west: float, south: float, east: float, north: float, steps: int = 200, grid: GridSpec = GRID) -> DataFrame:
    """The cells that a longitude-latitude box touches, by a mesh of points."""
    if not (west < east and south < north):
        raise SpecError("an empty box")
    lon = spark.range(steps).select((F.lit(west) + F.col("id") * ((east - west) / (steps - 1))).alias("lon"))
    lat = F.explode(F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda k: F.lit(south) + k * ((north - south) / (steps - 1))))
    mesh = lon.withColumn("lat", lat)
    x, y = to_metres(F.col("lon"), F.col("lat"))
    ix, iy = F.floor((x - grid.x_min) / grid.pixel), F.floor((F.lit(grid.y_max) - y) / grid.pixel)
    inside = mesh.select(ix.alias("ix"), iy.alias("iy")).where(F.col("ix").between(0, grid.width - 1) & F.col("iy").between(0, grid.height - 1))
    return inside.select(div(F.col("iy"), grid.cell_px).cast("int").alias("cell_row"), div(F.col("ix"), grid.cell_px).cast("int").alias("cell_col")).distinct()


def to_blocks(pixels: DataFrame, group: str, size: int, height: int, width: int) -> DataFrame:
    """Storage form: one dense payload per non-empty block of ``size`` pixels a side. A block's
    pixels, at most ``size`` squared, are scattered into it in one pass."""
    keys = ["property", "factor", "depth_idx", "by", "bx"]
    casts = {"property": "string", "factor": "int", "depth_idx": "smallint", "y": "int", "x": "int", "value": "float"}
    rows = pixels.select(*[F.col(c).cast(t) for c, t in casts.items()])
    rows = rows.withColumn("by", div(F.col("y"), size).cast("int")).withColumn("bx", div(F.col("x"), size).cast("int"))

    def dense(held: pa.Table) -> pa.Table:
        by, bx = held["by"][0].as_py(), held["bx"][0].as_py()
        h, w = min(size, height - by * size), min(size, width - bx * size)
        payload = np.full(h * w, np.nan, np.float32)
        payload[(held["y"].to_numpy() - by * size) * w + held["x"].to_numpy() - bx * size] = held["value"].to_numpy()
        first = held.slice(0, 1).select(keys)
        more = {"h": pa.array([h], pa.int32()), "w": pa.array([w], pa.int32()), "n_valid": pa.array([len(held)], pa.int32()), "payload": pa.array([payload])}
        return pa.table({"group": pa.array([group]), **{k: first[k] for k in keys}, **more})

    return rows.groupBy(*keys).applyInArrow(dense, BLOCKS)


def from_blocks(blocks: DataFrame, size: int) -> DataFrame:
    """The pixels of stored blocks; NaN is no row."""
    rows = blocks.select("property", "factor", "depth_idx", "by", "bx", "w", F.posexplode("payload").alias("pos", "value")).where("not isnan(value)")
    return rows.select(
        "property", "factor", "depth_idx",
        (F.col("by") * size + div(F.col("pos"), F.col("w"))).cast("int").alias("y"),
        (F.col("bx") * size + F.col("pos") % F.col("w")).cast("int").alias("x"), "value",
    )
