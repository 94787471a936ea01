"""Inventory verification: manifest build, de-duplication, cross-checks and repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.lattice import cell_name, guard, parse_tile_name, tile_origin, xy_to_pixel
from gridloom.functions.units import normalise_transformation
from gridloom.spec import EXPECTED_METADATA, GRID, NODATA, GridSpec, PropertySpec


def layer_issues(headers: DataFrame, spec: PropertySpec) -> DataFrame:
    """``(property, depth, issue)``: what a mosaic header says otherwise than expected."""
    m = lambda k: F.try_element_at(F.col("metadata"), F.lit(k))
    wrong = lambda bad, text: F.when(F.coalesce(bad, F.lit(True)), F.lit(text))
    issues = [
        wrong(F.col("dtype") != "Int16", "data type"),
        wrong(F.col("nodata") != NODATA, "nodata"),
        *(wrong(m(k) != v, k) for k, v in EXPECTED_METADATA.items()),
        wrong(m("Outputs_version") != spec.run, "Outputs_version"),
        wrong(normalise_transformation(m("Transformation")) != spec.transformation, "Transformation"),
    ]
    found = F.array_compact(F.array(*issues))
    return headers.select("property", "depth", F.explode(found).alias("issue"))


def source_anomalies(sources: DataFrame) -> DataFrame:
    """Repeated paths, resampled sources, and blocks taller than their file."""
    n = F.count("*").over(Window.partitionBy("property", "depth", "relpath"))
    kinds = F.array_compact(
        F.array(
            F.when(n > 1, "listed twice"), F.when(F.col("resampled"), "resampled"), F.when(F.col("block_y") > F.col("height"), "block taller than the file")
        )
    )
    found = sources.withColumn("kinds", kinds)
    return found.select("property", "depth", "relpath", F.explode("kinds").alias("anomaly"))


def build_manifest(sources: DataFrame, offset: tuple[Column, Column], tile_px: int, base_url: Column, grid: GridSpec = GRID) -> DataFrame:
    """Manifest rows of mosaic sources: the name gives cell and sub-tile, the cell's directory
    must agree with it, the rectangle plus the mosaic's offset is the canonical place and must
    lie in the grid. ``misplaced`` marks full tiles that aren't where their name says."""
    name = F.regexp_extract("relpath", "([^/]+)$", 1)
    t = parse_tile_name(name, tile_px, grid)
    rows = sources.withColumn("t", t)
    row, col, sr, sc = (F.col(f"t.{c}") for c in ("cell_row", "cell_col", "sub_row", "sub_col"))
    cell = cell_name(row, col)
    x = (F.rint("dst_x") + offset[0]).cast("int")
    y = (F.rint("dst_y") + offset[1]).cast("int")
    w, h = F.rint("dst_width").cast("int"), F.rint("dst_height").cast("int")
    ox, oy = tile_origin(row, col, sr, sc, tile_px, grid)
    at_x, at_y = xy_to_pixel(ox, oy, grid)
    full = (F.col("width") == tile_px) & (F.col("height") == tile_px)
    rows = rows.withColumn("cell", guard(F.col("relpath").startswith(F.concat(cell, F.lit("/"))), cell, F.concat(F.lit("in the directory of another cell: "), F.col("relpath"))))
    fits = (x >= 0) & (y >= 0) & (x + w <= grid.width) & (y + h <= grid.height)
    return rows.select(
        "property", "depth", "cell", F.format_string("%d-%d", sr, sc).alias("subtile"), F.concat(base_url, F.lit("/"), F.col("relpath")).alias("url"), "relpath",
        F.when(F.col("resampled"), w).otherwise(F.col("width")).cast("int").alias("width"), F.when(F.col("resampled"), h).otherwise(F.col("height")).cast("int").alias("height"),
        guard(fits, x, F.concat(F.lit("outside of the grid: "), F.col("relpath"))).alias("x_off"), y.alias("y_off"),
        row.cast("smallint").alias("cell_row"), col.cast("smallint").alias("cell_col"), full.alias("is_full"), F.col("block_y").alias("rows_per_strip"),
        F.col("resampled").alias("resampled_in_vrt"), F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("modified"), "ordinal", (full & ((at_x != x) | (at_y != y))).alias("misplaced"),
        (full & (at_x == x) & (at_y == y)).alias("named"),
    )


def dedupe_windows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One tile per window: the one named for it, else the smaller path. The others are the
    conflicts, each with the path that was kept; the choice depends on no order of rows."""
    w = Window.partitionBy("property", "depth", "x_off", "y_off").orderBy(F.col("named").desc(), "relpath")
    ranked = rows.withColumn("rn", F.row_number().over(w)).withColumn("kept", F.first("relpath").over(w))
    return ranked.where("rn = 1").drop("rn", "kept"), ranked.where("rn > 1").drop("rn")


def verify_conflicts(conflicts: DataFrame, values: DataFrame) -> DataFrame:
    """Differing pixels of each conflicting pair: none is a note, any is fatal. ``values`` has
    relpath, depth and the decoded array."""
    other = values.select(F.col("relpath").alias("kept"), "depth", F.col("values").alias("kept_values"))
    both = conflicts.join(values.select("relpath", "depth", "values"), ["relpath", "depth"]).join(other, ["kept", "depth"])
    same_size = F.size("values") == F.size("kept_values")
    pairs = F.zip_with("values", "kept_values", lambda a, b: F.when(a.eqNullSafe(b), 0).otherwise(1))
    differing = F.when(same_size, F.aggregate(pairs, F.lit(0), lambda acc, v: acc + v)).otherwise(F.greatest(F.size("values"), F.size("kept_values")))
    return both.select("property", "depth", "relpath", "kept", differing.cast("long").alias("differing"), (differing > 0).alias("fatal"))


def cross_check(manifest: DataFrame, listing: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What only the disk has, what only the inventory has, and the manifest with sizes filled
    in. Only tiles count on the disk."""
    disk = listing.where(F.col("relpath").endswith(".tif"))
    disk_only = disk.join(manifest, keys, "left_anti").orderBy(*keys)
    vrt_only = manifest.join(disk, keys, "left_anti").select(*keys).orderBy(*keys)
    sized = manifest.drop("size").join(disk.select(*keys, "size"), keys, "left")
    return disk_only, vrt_only, sized


def repair(disk_only: DataFrame, manifest: DataFrame, grid: GridSpec = GRID) -> DataFrame:
    """Each disk-only tile's class: unreadable, off the lattice, outside of the grid, duplicate
    of an inventoried window or of an earlier recovered one, or recovered. ``disk_only`` has
    property, depth, relpath, header and error; the inventory always wins."""
    h = F.col("header")
    fx, fy = (h["tie_x"] - grid.x_min) / grid.pixel, (F.lit(grid.y_max) - h["tie_y"]) / grid.pixel
    on = (F.abs(fx - F.rint(fx)) <= 1e-6) & (F.abs(fy - F.rint(fy)) <= 1e-6) & (h["px"] == grid.pixel) & (h["py"] == grid.pixel)
    rows = disk_only.withColumn("x_off", F.rint(fx).cast("int")).withColumn("y_off", F.rint(fy).cast("int"))
    fits = F.col("x_off").between(0, F.lit(grid.width) - h["width"]) & F.col("y_off").between(0, F.lit(grid.height) - h["height"])
    taken = manifest.select("property", "depth", "x_off", "y_off").distinct().withColumn("taken", F.lit(True))
    rows = rows.join(taken, ["property", "depth", "x_off", "y_off"], "left")
    first = (
        F.when(F.col("error").isNotNull(), "unreadable").when(~on, "off the lattice").when(~fits, "outside of the grid").when(F.col("taken"), "duplicate")
    )
    rows = rows.withColumn("class", first)
    claim = F.row_number().over(Window.partitionBy("property", "depth", "x_off", "y_off", F.col("class").isNull()).orderBy("relpath"))
    return rows.withColumn("class", F.coalesce("class", F.when(claim == 1, "recovered").otherwise("duplicate"))).drop("taken")


def sample(rows: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` rows by the order of a seeded hash: the same rows for the same data and seed."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(k)


def record_etags(manifest: DataFrame, heads: DataFrame) -> DataFrame:
    joined = manifest.alias("m").join(heads.alias("h"), "url", "left")
    new = {c: F.coalesce(F.col(f"h.{c}"), F.col(f"m.{c}")).alias(c) for c in ("size", "etag", "modified")}
    return joined.select(*[new.get(c, F.col("url") if c == "url" else F.col(f"m.{c}")) for c in manifest.columns])


def layer_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("property", "depth").agg(
        F.count("*").alias("tiles"), F.count_if("is_full").alias("full"), F.count_if(~F.col("is_full")).alias("ragged"),
        F.countDistinct("cell_row", "cell_col").alias("cells"),
    )
