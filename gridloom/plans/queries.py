"""The registered queries: the engine's operators over rasters derived from the star schema,
each with the SQL that gives the same rows.

A raster 180 pixels wide is laid over ``orders`` (row by row in key order; pending orders are
nodata), tiles over ``part``, coarse sources over ``supplier``, ledgers over ``events``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom import spec
from gridloom.functions import lattice as L
from gridloom.functions import metadata, units
from gridloom.functions.crs import RADIUS, to_metres
from gridloom.operators import checks, inventory, ledger, place, read
from gridloom.operators.pyramid import plan_counts, pyramid, regions
from gridloom.plans.store import SnapshotStore
from gridloom.shared import shared_dir
from gridloom.sources import tiff
from gridloom.sources.inventory import parse_listing, parse_mosaic
from gridloom.spec import ENCODING, FACTORS, GRID, GridSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
W = 180


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---------------------------------------------------------------- derived rasters


def native(spark: SparkSession, sf: str) -> DataFrame:
    """(property, depth_idx, y, x, raw) over orders."""
    o = _table(spark, sf, "orders")
    raw = F.when(F.col("o_orderstatus") == "P", spec.NODATA).otherwise(F.floor("o_totalprice").cast("long") % 1000).cast("smallint")
    return o.select(
        F.lit("orders").alias("property"), F.lit(0).cast("smallint").alias("depth_idx"), L.div(F.col("o_orderkey"), W).cast("int").alias("y"),
        (F.col("o_orderkey") % W).cast("int").alias("x"), raw.alias("raw"), "o_orderstatus",
    )


NATIVE = f"""native AS (
  SELECT 'orders' AS property, 0 AS depth_idx, (o_orderkey // {W})::INT AS y, (o_orderkey % {W})::INT AS x, o_orderstatus,
    (CASE WHEN o_orderstatus = 'P' THEN -32768 ELSE floor(o_totalprice)::BIGINT % 1000 END)::SMALLINT AS raw FROM orders
), pixels AS (
  SELECT property, depth_idx, y, x, CAST(CAST(raw AS DOUBLE) / 10::DOUBLE AS FLOAT) AS value FROM native WHERE raw <> -32768
)"""


def valued(spark: SparkSession, sf: str) -> DataFrame:
    rows = native(spark, sf).withColumn("value", units.decode(F.col("raw"), 10)).where("not isnan(value)")
    return rows.select("property", "depth_idx", "y", "x", "value")


def order_grid(spark: SparkSession, sf: str) -> GridSpec:
    """The lattice of the orders raster; its height is one aggregate of the key column."""
    last = _table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]
    return GridSpec(GRID.x_min, GRID.y_max, GRID.pixel, W, (last or 0) // W + 1, 1)


def tiles(spark: SparkSession, sf: str) -> DataFrame:
    p = _table(spark, sf, "part")
    k, n = F.col("p_partkey"), F.col("p_size")
    row, col = (k % 33).cast("int"), (k % 89).cast("int")
    sr, sc = (n % 4 + 1).cast("int"), (k % 4 + 1).cast("int")
    return p.select(
        F.col("p_brand").alias("property"), F.lit("0_5").alias("depth"), F.lit(0).cast("smallint").alias("depth_idx"), row.alias("cell_row"), col.alias("cell_col"), sr.alias("sub_row"), sc.alias("sub_col"),
        ((k % 6) * 30).cast("int").alias("x_off"), (L.div(k, 6) % 6 * 30).cast("int").alias("y_off"), F.lit(30).alias("width"), F.lit(30).alias("height"),
        (n % 5 == 0).alias("named"), F.concat(F.lit("tile-"), F.format_string("%06d", k), F.lit("-"), F.col("p_type")).alias("relpath"),
        (n > 25).alias("is_full"), n.alias("p_size"), k.alias("ordinal"),
    )


TILES = """tiles AS (
  SELECT p_brand AS property, '0_5' AS depth, 0 AS depth_idx, (p_partkey % 33)::INT AS cell_row, (p_partkey % 89)::INT AS cell_col, (p_size % 4 + 1)::INT AS sub_row,
    (p_partkey % 4 + 1)::INT AS sub_col, ((p_partkey % 6) * 30)::INT AS x_off, ((p_partkey // 6) % 6 * 30)::INT AS y_off, p_size % 5 = 0 AS named,
    'tile-' || printf('%06d', p_partkey) || '-' || p_type AS relpath, p_size > 25 AS is_full, p_size, p_partkey AS ordinal FROM part
)"""


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """A ledger over events: (property, cell_row, cell_col, late)."""
    e = _table(spark, sf, "events")
    at = lambda n: (F.col("user_id") % n).cast("int")
    return e.select(F.col("event_type").alias("property"), at(33).alias("cell_row"), at(89).alias("cell_col"), (F.col("value") > 50).alias("late"), "user_id", "value")


CELLS = """cells AS (
  SELECT event_type AS property, (user_id % 33)::INT AS cell_row, (user_id % 89)::INT AS cell_col, value > 50 AS late, user_id, value FROM events
)"""


def coarse(spark: SparkSession, sf: str) -> DataFrame:
    """One coarse pixel per supplier, six grid pixels a side; every tenth is nodata."""
    s = _table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    value = F.when(k % 10 == 0, F.lit(float("nan"))).otherwise(F.floor(F.abs("s_acctbal")).cast("long") % 1000).cast("float")
    return s.select(
        F.lit("orders").alias("property"), F.lit(0).cast("smallint").alias("depth_idx"), k.alias("source"), k.alias("rank"), (k * 7 % 170).cast("int").alias("x_off"),
        (k * 11 % 60).cast("int").alias("y_off"), F.lit(6).alias("rx"), F.lit(6).alias("ry"), F.lit(0).alias("sy"), F.lit(0).alias("sx"), value.alias("value"),
    )


COARSE = f"""expanded AS (
  SELECT s_suppkey AS source, (s_suppkey * 11 % 60 + dy)::INT AS y, (s_suppkey * 7 % 170 + dx)::INT AS x,
    (CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE floor(abs(s_acctbal))::BIGINT % 1000 END)::FLOAT AS value
  FROM supplier, unnest(range(0, 6)) AS a(dy), unnest(range(0, 6)) AS b(dx)
  WHERE s_suppkey * 7 % 170 + dx < {W}
), covered AS (SELECT y, x FROM native WHERE o_orderstatus <> 'O'),
filled AS (
  SELECT y, x, source, value FROM (
    SELECT *, row_number() OVER (PARTITION BY y, x ORDER BY source) AS rn FROM expanded e
    WHERE value IS NOT NULL AND NOT EXISTS (SELECT 1 FROM covered c WHERE c.y = e.y AND c.x = e.x)
  ) WHERE rn = 1
)"""
COARSE_GRID = GridSpec(0.0, 0.0, 1.0, W, 1 << 20, 1)


def expanded(spark: SparkSession, sf: str) -> DataFrame:
    return place.expand_coarse(coarse(spark, sf), COARSE_GRID)


def covered(spark: SparkSession, sf: str) -> DataFrame:
    """Open orders are uncovered; pending ones are covered by nodata."""
    return native(spark, sf).where("o_orderstatus <> 'O'").select("property", "depth_idx", "y", "x")


def filled(spark: SparkSession, sf: str) -> DataFrame:
    return place.gap_fill(expanded(spark, sf), covered(spark, sf))


# ---------------------------------------------------------------- scalar functions


@query("f17_decode", f"WITH {NATIVE} SELECT y, x, value FROM pixels")
def f17(spark, sf):
    return valued(spark, sf).select("y", "x", "value")


@query("f18_encode", f"WITH {NATIVE} SELECT y, x, raw::INT AS again FROM native")
def f18(spark, sf):
    rows = native(spark, sf)
    return rows.select("y", "x", units.encode(units.decode(F.col("raw"), 10), 10).cast("int").alias("again"))


NAME = "printf('tileSG-%03d-%03d_%d-%d.tif', cell_row, cell_col, sub_row, sub_col)"


@query(
    "f01_tile_name",
    f"""WITH {TILES}, n AS (SELECT ordinal, {NAME} AS name FROM tiles)
    SELECT ordinal, name, regexp_extract(name, 'SG-([0-9]+)-', 1)::INT AS cell_row, regexp_extract(name, '-([0-9]+)_', 1)::INT AS cell_col,
      regexp_extract(name, '_([0-9])-', 1)::INT AS sub_row, regexp_extract(name, '-([0-9])[.]', 1)::INT AS sub_col FROM n""",
)
def f01(spark, sf):
    t = tiles(spark, sf).withColumn("name", L.tile_name(*map(F.col, ("cell_row", "cell_col", "sub_row", "sub_col"))))
    return t.select("ordinal", "name", L.parse_tile_name(F.col("name"), 450).alias("t")).select("ordinal", "name", "t.*")


ORIGIN = "(-20037500.0 + cell_col * 450000.0 + (sub_col - 1) * 112500.0)::DOUBLE AS ox, (8600750.0 - cell_row * 450000.0 - (sub_row - 1) * 112500.0)::DOUBLE AS oy"


def _origins(spark, sf):
    x, y = L.tile_origin(*map(F.col, ("cell_row", "cell_col", "sub_row", "sub_col")), 450)
    return tiles(spark, sf).select("ordinal", x.alias("ox"), y.alias("oy"))


@query("f03_tile_origin", f"WITH {TILES} SELECT ordinal, {ORIGIN} FROM tiles")
def f03(spark, sf):
    return _origins(spark, sf)


@query("f04_xy_to_pixel", f"WITH {TILES} SELECT ordinal, (cell_col * 1800 + (sub_col - 1) * 450)::BIGINT AS ix, (cell_row * 1800 + (sub_row - 1) * 450)::BIGINT AS iy FROM tiles")
def f04(spark, sf):
    x, y = L.xy_to_pixel(F.col("ox"), F.col("oy"))
    return _origins(spark, sf).select("ordinal", x.alias("ix"), y.alias("iy"))


@query(
    "f07_source_window",
    """SELECT s_suppkey, (s_suppkey * 7)::BIGINT AS x_off, (s_suppkey * 11)::BIGINT AS y_off, 2 * (s_suppkey % 3 + 1)::BIGINT AS width,
      3 * (s_suppkey % 5 + 1)::BIGINT AS height, (s_suppkey % 3 + 1)::BIGINT AS rx, (s_suppkey % 5 + 1)::BIGINT AS ry FROM supplier""",
)
def f07(spark, sf):
    """Windows from key 5399 on lie beyond the product's own grid, so the lattice reaches as far as the last key's."""
    k = F.col("s_suppkey")
    last = _table(spark, sf, "supplier").agg(F.max("s_suppkey")).first()[0] or 0
    grid = GridSpec(GRID.x_min, GRID.y_max, GRID.pixel, last * 7 + 2 * 3, last * 11 + 3 * 5, 1)
    window = L.source_window(
        F.lit(grid.x_min) + k * 7 * grid.pixel, F.lit(grid.y_max) - k * 11 * grid.pixel, (k % 3 + 1) * grid.pixel, (k % 5 + 1) * grid.pixel, F.lit(2), F.lit(3), grid
    )
    return _table(spark, sf, "supplier").select("s_suppkey", window.alias("w")).select("s_suppkey", "w.*")


@query(
    "f08_cells_touching",
    """SELECT s_suppkey, r AS cell_row, c AS cell_col FROM (SELECT s_suppkey, s_suppkey * 701 AS x, s_suppkey * 113 AS y, s_suppkey % 7 * 900 AS w, s_suppkey % 5 * 900 AS h FROM supplier),
      unnest(range(y // 1800, (y + h - 1) // 1800 + 1)) AS a(r), unnest(range(x // 1800, (x + w - 1) // 1800 + 1)) AS b(c) WHERE w > 0 AND h > 0""",
)
def f08(spark, sf):
    k = F.col("s_suppkey")
    rows = _table(spark, sf, "supplier").select("s_suppkey", (k * 701).alias("x"), (k * 113).alias("y"), (k % 7 * 900).alias("w"), (k % 5 * 900).alias("h"))
    return L.cells_touching(rows, "x", "y", "w", "h").select("s_suppkey", "cell_row", "cell_col")


@query("f09_all_cells", "SELECT r::INT AS cell_row, c::INT AS cell_col FROM range(33) AS a(r), range(89) AS b(c)")
def f09(spark, sf):
    return L.all_cells(spark)


@query(
    "f11_candidate_tiles",
    f"""SELECT n_nationkey, {NAME} AS name, printf('tileSG-%03d-%03d/', cell_row, cell_col) || {NAME} AS relpath
    FROM (SELECT n_nationkey, n_nationkey AS cell_row, n_nationkey * 3 AS cell_col, r AS sub_row, c AS sub_col FROM nation, range(1, 5) AS a(r), range(1, 5) AS b(c))""",
)
def f11(spark, sf):
    rows = _table(spark, sf, "nation").select("n_nationkey", F.col("n_nationkey").alias("cell_row"), (F.col("n_nationkey") * 3).alias("cell_col"))
    return L.candidate_tiles(rows, 450).select("n_nationkey", "name", "relpath")


@query(
    "f12_shard_windows",
    """SELECT n_nationkey AS cell_row, n_nationkey * 3 AS cell_col, n_nationkey * 1800 + a * 450 AS y0, n_nationkey * 1800 + a * 450 + 450 AS y1,
      n_nationkey * 5400 + b * 450 AS x0, n_nationkey * 5400 + b * 450 + 450 AS x1 FROM nation, range(4) AS p(a), range(4) AS q(b)""",
)
def f12(spark, sf):
    rows = _table(spark, sf, "nation").select(F.col("n_nationkey").alias("cell_row"), (F.col("n_nationkey") * 3).alias("cell_col"))
    out = L.shard_windows(rows, ENCODING)
    return out.select("cell_row", "cell_col", *(F.col(c).cast("long") for c in ("y0", "y1", "x0", "x1")))


@query("f13_level_shapes", "SELECT f::INT AS factor, (59400 // f)::INT AS height, (160200 // f)::INT AS width, 250.0::DOUBLE * f AS pixel FROM (SELECT unnest([2, 4, 8, 16, 32, 64, 128, 256]) AS f)")
def f13(spark, sf):
    return L.levels(spark, FACTORS).drop("geotransform")


@query("f15_pixel_centres", f"WITH {NATIVE} SELECT y, x, (-20037500.0 + (x + 0.5) * 250.0)::DOUBLE AS cx, (8600750.0 - (y + 0.5) * 250.0)::DOUBLE AS cy FROM native")
def f15(spark, sf):
    return native(spark, sf).select("y", "x", L.pixel_centre_x(F.col("x")).alias("cx"), L.pixel_centre_y(F.col("y")).alias("cy"))


@query(
    "f20_normalise",
    """WITH t AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN ' None' WHEN 3 THEN ' alr ' ELSE p_type END AS v FROM part)
    SELECT p_partkey, CASE WHEN v IS NULL OR trim(v) = '' OR lower(trim(v)) = 'none' THEN 'none' ELSE trim(v) END AS transformation FROM t""",
)
def f20(spark, sf):
    n = F.col("p_size") % 5
    v = F.when(n == 0, F.lit(None)).when(n == 1, "  ").when(n == 2, " None").when(n == 3, " alr ").otherwise(F.col("p_type"))
    return _table(spark, sf, "part").select("p_partkey", units.normalise_transformation(v).alias("transformation"))


def _centre_sql(lon: str, lat: str) -> str:
    south = f"CASE WHEN {lon} < -100 THEN -160.0 WHEN {lon} < -20 THEN -60.0 WHEN {lon} < 80 THEN 20.0 ELSE 140.0 END"
    return f"CASE WHEN {lat} >= 0 THEN CASE WHEN {lon} < -40 THEN -100.0 ELSE 30.0 END ELSE {south} END"


@query(
    "f21_projection",
    f"""WITH RECURSIVE p AS (SELECT c_custkey, ((c_custkey * 37 % 3600) / 10.0 - 180.0)::DOUBLE AS lon, ((c_custkey * 13 % 1781) / 10.0 - 89.0)::DOUBLE AS lat FROM customer),
    c AS (SELECT *, ({_centre_sql("lon", "lat")})::DOUBLE AS l0 FROM p),
    newton AS (
      SELECT c_custkey, 0 AS step, 2 * radians(lat) AS t, pi() * sin(radians(lat)) AS goal FROM c
      UNION ALL SELECT c_custkey, step + 1, t - (t + sin(t) - goal) / greatest(1 + cos(t), 1e-9), goal FROM newton WHERE step < 40
    ),
    m AS (SELECT c.*, t / 2 AS theta, abs(lat) <= 40 + 44 / 60.0::DOUBLE + 11.8 / 3600.0::DOUBLE AS flat FROM c JOIN newton USING (c_custkey) WHERE step = 40)
    SELECT c_custkey,
      round(6378137.0 * (radians(lon - l0) * CASE WHEN flat THEN cos(radians(lat)) ELSE 2 * sqrt(2) / pi() * cos(theta) END + radians(l0)))::BIGINT AS mx,
      round(6378137.0 * CASE WHEN flat THEN radians(lat) ELSE sqrt(2) * sin(theta) + sign(lat) * -0.0528035274542 END)::BIGINT AS my FROM m""",
)
def f21(spark, sf):
    """All latitudes up to 89 degrees: both projections and all six lobes."""
    k = F.col("c_custkey")
    x, y = to_metres((k * 37 % 3600) / 10.0 - 180.0, (k * 13 % 1781) / 10.0 - 89.0)
    return _table(spark, sf, "customer").select("c_custkey", F.round(x).cast("long").alias("mx"), F.round(y).cast("long").alias("my"))


@query(
    "s16_layers",
    """SELECT name AS property, d AS depth FROM (SELECT unnest(['bdod','cec','cfvo','clay','nitrogen','ocd','phh2o','sand','silt','soc']) AS name),
      (SELECT unnest(['0_5','5_15','15_30','30_60','60_100','100_200']) AS d) UNION ALL SELECT 'ocs', '0_30'""",
)
def s16(spark, sf):
    return spark.createDataFrame([(p.name, d.label) for p, d in spec.layers()], "property string, depth string")


# ---------------------------------------------------------------- sources


@query("s02_tile_decode", "SELECT p_partkey, y, x, ((p_partkey * 31 + y * 7 + x) % 2000 - 1000)::INT AS raw FROM part, range(3) AS a(y), range(2) AS b(x)")
def s02(spark, sf):
    """Tiles are written from part keys, both byte orders, and scanned."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = np.arange(3)[:, None] * 7 + np.arange(2)
        for b in batches:
            bodies = [tiff.encode((k * 31 + grid) % 2000 - 1000, (0.0, 0.0), (250.0, 250.0), 2, big_endian=k % 2 == 1) for k in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bodies, pa.binary())], names=["p_partkey", "content"])

    files = _table(spark, sf, "part").select("p_partkey").mapInArrow(build, "p_partkey bigint, content binary")
    rows = tiff.decode_tiles(files).select("p_partkey", F.col("header.width").alias("w"), F.posexplode("values").alias("pos", "raw"))
    return rows.select("p_partkey", L.div(F.col("pos"), F.col("w")).alias("y"), (F.col("pos") % F.col("w")).cast("long").alias("x"), F.col("raw").cast("int"))


@query("s11_listing_parse", "SELECT p_partkey, p_name AS name, (CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size * 1001 END)::BIGINT AS size FROM part")
def s11(spark, sf):
    size = F.when(F.col("p_size") % 3 == 0, "Directory").otherwise(F.concat(F.format_number(F.col("p_size") * 1001, 0), F.lit(" Bytes")))
    html = F.concat(
        F.lit("<table><tr><th>Name</th></tr><tr><td><a href='x'>"), F.col("p_name"), F.when(F.col("p_size") % 3 == 0, "/").otherwise(""),
        F.lit("</a></td><td>kind</td><td>"), size, F.lit("</td><td>x</td></tr></table>"),
    )
    return _table(spark, sf, "part").select("p_partkey", F.explode(parse_listing(html)).alias("name", "size"))


@query("s12_mosaic_parse", "SELECT p_partkey, 'dir/' || p_partkey || '.tif' AS relpath, 450 AS width, 400 + p_size AS height, (p_partkey * 450)::DOUBLE AS dst_x, p_size % 2 = 0 AS resampled FROM part")
def s12(spark, sf):
    n, k = F.col("p_size"), F.col("p_partkey")
    shown = F.when(n % 2 == 0, "62").otherwise("450")
    xml = F.concat(
        F.lit('<VRTDataset rasterXSize="900" rasterYSize="900"><GeoTransform>0, 250, 0, 0, 0, -250</GeoTransform><VRTRasterBand dataType="Int16"><NoDataValue>-32768</NoDataValue><ComplexSource><SourceFilename>./a/dir/'), k,
        F.lit('.tif</SourceFilename><SourceProperties RasterXSize="450" RasterYSize="'), n + 400, F.lit('" BlockYSize="9"/><SrcRect xOff="0" yOff="0" xSize="450" ySize="1"/><DstRect xOff="'), k * 450,
        F.lit('" yOff="0" xSize="'), shown, F.lit('" ySize="'), n + 400, F.lit('"/></ComplexSource></VRTRasterBand></VRTDataset>'),
    )
    _, sources = parse_mosaic(_table(spark, sf, "part").select("p_partkey", xml.alias("xml")))
    return sources.select("p_partkey", "relpath", "width", "height", "dst_x", "resampled")


# ---------------------------------------------------------------- placement


@query(
    "p01_group_by_cell",
    f"WITH {TILES} SELECT property, cell_row, cell_col, count(*) AS tiles, arg_min(relpath, ordinal) AS first_tile, sum(ordinal)::BIGINT AS ordinals FROM tiles GROUP BY ALL",
)
def p01(spark, sf):
    out = place.by_cell(tiles(spark, sf))
    ordinals = F.aggregate("rows", F.lit(0).cast("long"), lambda n, r: n + r["ordinal"])
    return out.select("property", "cell_row", "cell_col", "tiles", F.col("rows")[0]["relpath"].alias("first_tile"), ordinals.alias("ordinals"))


def _small_tiles(spark, sf, pixel: float = GRID.pixel):
    """Manifest rows and read tiles, two pixels by three, side by side over part."""
    k = F.col("p_partkey")
    grid = F.sequence(F.lit(0), F.lit(5))
    header = F.struct(
        (F.lit(GRID.x_min) + k % 80 * 500).alias("tie_x"), (F.lit(GRID.y_max) - L.div(k, 80) * 750).alias("tie_y"), F.lit(pixel).alias("px"), F.lit(pixel).alias("py"),
        F.lit(2).alias("width"), F.lit(3).alias("height"), F.lit(spec.NODATA).alias("nodata"),
    )
    p = _table(spark, sf, "part").select(F.lit("clay").alias("property"), F.lit("0_5").alias("depth"), F.concat(F.lit("t"), k).alias("relpath"), "p_partkey", "p_size")
    raw = F.transform(grid, lambda i: F.when((k + i) % 5 == 0, spec.NODATA).otherwise((k * 31 + i * 7) % 900).cast("smallint"))
    failed = F.col("p_size") == 50
    read_tiles = p.select("property", "depth", "relpath", header.alias("header"), F.when(~failed, raw).alias("values"), F.when(failed, "no answer").alias("error"))
    place_of = [(k % 80 * 2).cast("int").alias("x_off"), (L.div(k, 80) * 3).cast("int").alias("y_off")]
    rows = p.select("property", "depth", "relpath", k.alias("ordinal"), F.lit(2).alias("width"), F.lit(3).alias("height"), *place_of, F.lit(pixel > GRID.pixel).alias("resampled_in_vrt"))
    return place.depth_index(rows, spec.PROPERTIES["clay"]), read_tiles


SMALL = "SELECT p_partkey AS k, p_size, i FROM part, range(6) AS r(i) WHERE p_size <> 50"


@query(
    "p03_place_tiles",
    f"""SELECT (k // 80 * 3 + i // 2)::INT AS y, (k % 80 * 2 + i % 2)::INT AS x, k AS ordinal,
      CASE WHEN (k + i) % 5 = 0 THEN -1::FLOAT ELSE CAST(CAST((k * 31 + i * 7) % 900 AS DOUBLE) / 10 AS FLOAT) END AS value FROM ({SMALL})""",
)
def p03(spark, sf):
    rows, read_tiles = _small_tiles(spark, sf)
    out = place.place(place.check_tiles(read_tiles, rows), 10)
    return out.select("y", "x", "ordinal", F.nanvl("value", F.lit(-1.0).cast("float")).cast("float").alias("value"))


@query(
    "p06_resolve_coarse",
    f"""SELECT 't' || k AS source, k AS rank, (k % 80 * 2)::INT AS x_off, (k // 80 * 3)::INT AS y_off, 2::BIGINT AS rx, 2::BIGINT AS ry, (i // 2)::BIGINT AS sy, (i % 2)::BIGINT AS sx,
      (CASE WHEN (k + i) % 5 = 0 THEN -32768 ELSE (k * 31 + i * 7) % 900 END)::INT AS raw FROM ({SMALL})""",
)
def p06r(spark, sf):
    rows, read_tiles = _small_tiles(spark, sf, 2 * GRID.pixel)
    out = place.resolve_coarse(rows.join(read_tiles, place.tile_keys(read_tiles)))
    return out.select("source", "rank", "x_off", "y_off", "rx", "ry", "sy", F.col("sx").cast("long"), F.col("raw").cast("int"))


@query(
    "p04_ordered_overwrite",
    f"""SELECT (p // {W})::INT AS y, (p % {W})::INT AS x, value FROM (
      SELECT l_orderkey % 32400 AS p, l_extendedprice::FLOAT AS value, row_number() OVER (PARTITION BY l_orderkey % 32400
        ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def p04(spark, sf):
    at = F.col("l_orderkey") % 32400
    rows = _table(spark, sf, "lineitem").select(
        F.lit("l").alias("property"), F.lit(0).alias("depth_idx"), L.div(at, W).cast("int").alias("y"), (at % W).cast("int").alias("x"), F.col("l_extendedprice").cast("float").alias("value"),
        F.struct("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("order"),
    )
    return place.overwrite(rows, "order").select("y", "x", "value")


@query(
    "p05_coverage",
    f"""WITH {TILES}, px AS (SELECT DISTINCT property, y_off + dy AS y, x_off + dx AS x FROM (SELECT DISTINCT property, x_off, y_off FROM tiles), range(30) AS a(dy), range(30) AS b(dx))
    SELECT property, count(*) AS covered, sum(y)::BIGINT AS sum_y, sum(x)::BIGINT AS sum_x FROM px GROUP BY property""",
)
def p05(spark, sf):
    px = place.covered_pixels(tiles(spark, sf).withColumn("resampled_in_vrt", F.lit(False)))
    return px.groupBy("property").agg(F.count("*").alias("covered"), F.sum("y").alias("sum_y"), F.sum("x").alias("sum_x"))


@query("p06_coarse_expand", f"WITH {NATIVE}, {COARSE} SELECT source, y, x, value FROM expanded WHERE value IS NOT NULL")
def p06(spark, sf):
    return expanded(spark, sf).where("not isnan(value)").select("source", "y", "x", "value")


@query("p07_gap_fill", f"WITH {NATIVE}, {COARSE} SELECT y, x, source, value FROM filled")
def p07(spark, sf):
    return filled(spark, sf).select("y", "x", "source", "value")


@query("p07_pixels_filled", f"WITH {NATIVE}, {COARSE} SELECT source, count(*) AS pixels_filled FROM filled GROUP BY source")
def p07n(spark, sf):
    return place.fill_counts(filled(spark, sf)).select("source", "pixels_filled")


@query(
    "p08_skip_keys",
    f"WITH {TILES} SELECT property, relpath FROM tiles t WHERE NOT EXISTS (SELECT 1 FROM tiles s WHERE s.named AND s.relpath = t.relpath AND s.depth = t.depth)",
)
def p08(spark, sf):
    t = tiles(spark, sf)
    return place.without_skipped(t, t.where("named")).select("property", "relpath")


@query(
    "p09_assemble",
    f"WITH {NATIVE}, {COARSE} SELECT y, x, value FROM pixels WHERE (y, x) IN (SELECT (y, x) FROM covered) UNION ALL SELECT y, x, value FROM filled",
)
def p09(spark, sf):
    fine = native(spark, sf).where("o_orderstatus <> 'O'").withColumn("value", units.decode(F.col("raw"), 10))
    return place.assemble(fine, filled(spark, sf)).select("y", "x", "value")


LEFT = f"WITH {CELLS} SELECT DISTINCT property, cell_row, cell_col FROM cells EXCEPT SELECT property, cell_row, cell_col FROM cells WHERE late"


@query("p11_resume_antijoin", LEFT)
def p11(spark, sf):
    c = cells(spark, sf)
    return place.without_done(c.select("property", "cell_row", "cell_col").distinct(), c.where("late"))


@query("p13_subset_semijoin", f"WITH {CELLS} SELECT property, user_id, value FROM cells WHERE (cell_row, cell_col) IN (SELECT (n_nationkey, n_nationkey * 3) FROM nation)")
def p13(spark, sf):
    subset = _table(spark, sf, "nation").select(F.col("n_nationkey").alias("cell_row"), (F.col("n_nationkey") * 3).alias("cell_col"))
    return place.only_cells(cells(spark, sf), subset).select("property", "user_id", "value")


@query("p14_bbox_cells", "SELECT unnest([8, 8, 9, 9, 9])::INT AS cell_row, unnest([19, 20, 18, 19, 20])::INT AS cell_col")
def p14(spark, sf):
    return place.cells_in_bbox(spark, -104, 37, -95, 43)


@query("k03_blocks_round_trip", f"WITH {NATIVE} SELECT y, x, value FROM pixels")
def k03(spark, sf):
    grid = order_grid(spark, sf)
    blocks = place.to_blocks(valued(spark, sf).withColumn("factor", F.lit(1)), "g", 50, grid.height, W)
    return place.from_blocks(blocks, 50).select("y", "x", "value")


# ---------------------------------------------------------------- inventory


@query(
    "p15_duplicate_sources",
    "SELECT p_brand AS property, p_type AS relpath FROM part QUALIFY count(*) OVER (PARTITION BY p_brand, p_type) > 1",
)
def p15(spark, sf):
    p = _table(spark, sf, "part").select(F.col("p_brand").alias("property"), F.lit("0_5").alias("depth"), F.col("p_type").alias("relpath"), F.lit(False).alias("resampled"), F.lit(1).alias("block_y"), F.lit(1).alias("height"))
    return inventory.source_anomalies(p).where("anomaly = 'listed twice'").select("property", "relpath")


@query(
    "p15_layer_issues",
    """SELECT p_partkey, unnest(list_filter([CASE WHEN p_size % 4 = 0 THEN 'data type' END, CASE WHEN p_size % 3 = 0 THEN 'nodata' END, CASE WHEN p_size % 11 = 0 THEN 'WoSIS_version' END,
      CASE WHEN p_size % 5 = 0 THEN 'Outputs_version' END, CASE WHEN p_size % 7 = 0 THEN 'Transformation' END], lambda x: x IS NOT NULL)) AS issue FROM part""",
)
def p15l(spark, sf):
    n, clay = F.col("p_size"), spec.PROPERTIES["clay"]
    found = {**spec.EXPECTED_METADATA, "Outputs_version": clay.run, "Transformation": f" {clay.transformation} "}
    other = {"WoSIS_version": 11, "Outputs_version": 5, "Transformation": 7}
    held = F.create_map(*[c for k, v in found.items() for c in (F.lit(k), F.when(n % other[k] == 0, "?").otherwise(v) if k in other else F.lit(v))])
    headers = _table(spark, sf, "part").select(
        F.col("p_partkey").alias("property"), F.lit("0_5").alias("depth"), F.when(n % 4 == 0, "Float32").otherwise("Int16").alias("dtype"), F.when(n % 3 == 0, 0).otherwise(spec.NODATA).alias("nodata"), held.alias("metadata"),
    )
    return inventory.layer_issues(headers, clay).select(F.col("property").alias("p_partkey"), "issue")


@query(
    "p16_manifest",
    f"""WITH {TILES}, t AS (SELECT *, p_size % 5 = 0 AND sub_col > 1 AS moved, CASE WHEN p_size % 3 = 0 THEN 400 ELSE 450 END AS side FROM tiles)
    SELECT ordinal, cell_row, cell_col, printf('tileSG-%03d-%03d', cell_row, cell_col) AS cell, sub_row || '-' || sub_col AS subtile, side::INT AS height, side = 450 AS is_full, side = 450 AND moved AS misplaced,
      (cell_col * 1800 + (sub_col - 1) * 450 - moved::INT)::INT AS x_off, (cell_row * 1800 + (sub_row - 1) * 450)::INT AS y_off FROM t""",
)
def p16(spark, sf):
    at = ("cell_row", "cell_col", "sub_row", "sub_col")
    t = tiles(spark, sf).withColumn("side", F.when(F.col("p_size") % 3 == 0, 400).otherwise(450))
    moved = ((F.col("p_size") % 5 == 0) & (F.col("sub_col") > 1)).cast("int")
    sources = t.select(
        "property", "depth", "ordinal", F.concat(L.cell_name(F.col("cell_row"), F.col("cell_col")), F.lit("/"), L.tile_name(*map(F.col, at))).alias("relpath"), F.lit(False).alias("resampled"),
        (F.col("cell_col") * 1800 + (F.col("sub_col") - 1) * 450 - moved).cast("double").alias("dst_x"), (F.col("cell_row") * 1800 + (F.col("sub_row") - 1) * 450).cast("double").alias("dst_y"),
        F.col("side").cast("double").alias("dst_width"), F.col("side").cast("double").alias("dst_height"), F.col("side").alias("width"), F.col("side").alias("height"), F.lit(9).alias("block_y"),
    )
    out = inventory.build_manifest(sources, (F.lit(0), F.lit(0)), 450, F.lit("u"))
    return out.select("ordinal", F.col("cell_row").cast("int"), F.col("cell_col").cast("int"), "cell", "subtile", "height", "is_full", "misplaced", "x_off", "y_off")


@query(
    "p15_anomalies",
    f"WITH {TILES} SELECT property, relpath, 'resampled' AS anomaly FROM tiles WHERE named UNION ALL SELECT property, relpath, 'block taller than the file' FROM tiles WHERE p_size > 30",
)
def p15a(spark, sf):
    t = tiles(spark, sf).withColumn("resampled", F.col("named")).withColumn("block_y", F.col("p_size"))
    return inventory.source_anomalies(t).select("property", "relpath", "anomaly")


RANKED = f"{TILES}, ranked AS (SELECT *, row_number() OVER w AS rn, first_value(relpath) OVER w AS kept FROM tiles WINDOW w AS (PARTITION BY property, depth, x_off, y_off ORDER BY named DESC, relpath))"


@query("p17_window_dedupe", f"WITH {RANKED} SELECT property, x_off, y_off, relpath FROM ranked WHERE rn = 1")
def p17(spark, sf):
    return inventory.dedupe_windows(tiles(spark, sf))[0].select("property", "x_off", "y_off", "relpath")


@query("p17_conflicts", f"WITH {RANKED} SELECT property, relpath, kept FROM ranked WHERE rn > 1")
def p17c(spark, sf):
    return inventory.dedupe_windows(tiles(spark, sf))[1].select("property", "relpath", "kept")


@query(
    "p18_conflict_diff",
    f"""WITH {RANKED}, c AS (SELECT r.property, r.relpath, r.kept, r.ordinal AS a, t.ordinal AS b FROM ranked r JOIN tiles t ON t.relpath = r.kept WHERE rn > 1)
    SELECT property, relpath, kept, sum((a * i % 7 <> b * i % 7)::INT)::BIGINT AS differing, sum((a * i % 7 <> b * i % 7)::INT) > 0 AS fatal FROM c, range(1, 10) AS r(i) GROUP BY ALL""",
)
def p18(spark, sf):
    t = tiles(spark, sf)
    values = t.select("relpath", "depth", F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: (F.col("ordinal") * i % 7).cast("smallint")).alias("values"))
    return inventory.verify_conflicts(inventory.dedupe_windows(t)[1], values).select("property", "relpath", "kept", "differing", "fatal")


def _disk(spark, sf):
    t = tiles(spark, sf).withColumn("relpath", F.concat("relpath", F.lit(".tif")))
    listing = t.where("p_size <= 40").select("property", "depth", "relpath", (F.col("p_size") * 100).cast("bigint").alias("size"), "ordinal", "x_off", "y_off", "p_size")
    held = t.where("p_size >= 10").select("property", "depth", "relpath", F.lit(None).cast("bigint").alias("size"), "x_off", "y_off")
    return listing, held


DISK = f"{TILES}, named_tiles AS (SELECT * REPLACE (relpath || '.tif' AS relpath) FROM tiles)"


@query("p19_disk_only", f"WITH {DISK} SELECT property, relpath, (p_size * 100)::BIGINT AS size FROM named_tiles WHERE p_size <= 40 AND p_size < 10")
def p19(spark, sf):
    listing, held = _disk(spark, sf)
    return inventory.cross_check(held, listing, ["property", "depth", "relpath"])[0].select("property", "relpath", "size")


@query("p19_vrt_only", f"WITH {DISK} SELECT property, depth, relpath FROM named_tiles WHERE p_size >= 10 AND p_size > 40")
def p19v(spark, sf):
    listing, held = _disk(spark, sf)
    return inventory.cross_check(held, listing, ["property", "depth", "relpath"])[1]


@query("p19_sizes", f"WITH {DISK} SELECT property, relpath, (CASE WHEN p_size <= 40 THEN p_size * 100 END)::BIGINT AS size FROM named_tiles WHERE p_size >= 10")
def p19s(spark, sf):
    listing, held = _disk(spark, sf)
    return inventory.cross_check(held, listing, ["property", "depth", "relpath"])[2].select("property", "relpath", "size")


@query(
    "p20_repair_class",
    f"""WITH {DISK}, held AS (SELECT DISTINCT property, depth, x_off, y_off FROM named_tiles WHERE p_size >= 10 AND named),
    d AS (SELECT t.*, CASE WHEN p_size = 1 THEN 'unreadable' WHEN p_size = 2 THEN 'off the lattice' WHEN p_size = 3 THEN 'outside of the grid'
        WHEN EXISTS (SELECT 1 FROM held h WHERE h.property = t.property AND h.x_off = t.x_off AND h.y_off = t.y_off) THEN 'duplicate' END AS first_class FROM named_tiles t WHERE p_size < 10)
    SELECT property, relpath, coalesce(first_class, CASE WHEN row_number() OVER (PARTITION BY property, depth, x_off, y_off, first_class IS NULL ORDER BY relpath) = 1 THEN 'recovered' ELSE 'duplicate' END) AS class FROM d""",
)
def p20(spark, sf):
    listing, _ = _disk(spark, sf)
    held = tiles(spark, sf).where("p_size >= 10 and named")
    n = F.col("p_size")
    header = F.struct(
        (F.lit(GRID.x_min) + F.when(n == 3, -250.0).otherwise(F.col("x_off") * 250.0) + F.when(n == 2, 30.0).otherwise(0.0)).alias("tie_x"),
        (F.lit(GRID.y_max) - F.col("y_off") * 250.0).alias("tie_y"), F.lit(250.0).alias("px"), F.lit(250.0).alias("py"), F.lit(30).alias("width"), F.lit(30).alias("height"),
    )
    rows = listing.where("p_size < 10").select("property", "depth", "relpath", header.alias("header"), F.when(n == 1, "broken").alias("error"))
    return inventory.repair(rows, held).select("property", "relpath", "class")


@query(
    "p22_record_etag",
    "SELECT p_partkey, 'u' || p_partkey AS url, CASE WHEN p_size > 20 THEN 'e' || p_size END AS etag FROM part",
)
def p22(spark, sf):
    p = _table(spark, sf, "part").withColumn("url", F.concat(F.lit("u"), "p_partkey"))
    none = lambda t: F.lit(None).cast(t)
    manifest = p.select("p_partkey", "url", none("bigint").alias("size"), none("string").alias("etag"), none("string").alias("modified"))
    heads = p.where("p_size > 20").select("url", F.col("p_size").cast("bigint").alias("size"), F.concat(F.lit("e"), "p_size").alias("etag"), none("string").alias("modified"))
    return inventory.record_etags(manifest, heads).select("p_partkey", "url", "etag")


# ---------------------------------------------------------------- pyramid


#: From this level on the raster is drawn out to three times the width and four times the height,
#: so that its levels hold pixels.
DRAWN_OUT = 128


def _ladder_sql(factor: int) -> str:
    steps, f, before, w, h = [], 2, "pixels", W, f"max(o_orderkey) // {W} + 1"
    if factor >= DRAWN_OUT:
        steps, before, w, h = ["wide AS (SELECT y * 4 AS y, x * 3 AS x, value FROM pixels)"], "wide", 3 * W, f"4 * ({h})"
    while f <= factor:
        steps.append(
            f"l{f} AS (SELECT (y // 2)::INT AS y, (x // 2)::INT AS x, CAST(avg(value) AS FLOAT) AS value FROM {before}, size WHERE y < 2 * (h // {f}) AND x < 2 * ({w} // {f}) GROUP BY 1, 2)"
        )
        before, f = f"l{f}", f * 2
    return f"WITH {NATIVE}, size AS (SELECT {h} AS h FROM orders), {', '.join(steps)} SELECT y, x, value FROM {before}"


def _ladder(factor: int) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        chain = tuple(f for f in FACTORS if f <= factor)
        rows, grid = valued(spark, sf), order_grid(spark, sf)
        if factor >= DRAWN_OUT:
            rows = rows.withColumn("y", F.col("y") * 4).withColumn("x", F.col("x") * 3)
            grid = GridSpec(grid.x_min, grid.y_max, grid.pixel, 3 * W, 4 * grid.height, 1)
        return pyramid(rows, chain, grid)[factor].select("y", "x", "value")

    return run


for _f in FACTORS:
    query("a01_mean_2x" if _f == 2 else f"a03_ladder_{_f}x", _ladder_sql(_f))(_ladder(_f))


@query(
    "a03_sparse_ladder",
    f"""WITH {NATIVE}, size AS (SELECT max(o_orderkey) // {W} + 1 AS h FROM orders)
    SELECT (y // 4)::INT AS y, (x // 4)::INT AS x, CAST(avg(value) AS FLOAT) AS value FROM pixels, size WHERE y < 4 * (h // 4) AND x < 4 * ({W} // 4) GROUP BY 1, 2""",
)
def a03s(spark, sf):
    return pyramid(valued(spark, sf), (4,), order_grid(spark, sf))[4].select("y", "x", "value")


REGIONS = f"""{CELLS}, f AS (SELECT unnest([2, 4, 8, 16, 32, 64, 128, 256]) AS factor),
spans AS (SELECT DISTINCT factor, cell_row * 1800 // factor // 450 AS y0, least(ceil(ceil((cell_row + 1) * 1800 / factor) / 450), ceil((59400 // factor) / 450))::BIGINT AS y1,
    cell_col * 1800 // factor // 450 AS x0, least(ceil(ceil((cell_col + 1) * 1800 / factor) / 450), ceil((160200 // factor) / 450))::BIGINT AS x1 FROM cells, f),
regions AS (SELECT DISTINCT factor, b AS "by", c AS bx FROM spans, unnest(range(y0, y1)) AS p(b), unnest(range(x0, x1)) AS q(c))"""


@query("a04_regions", f"WITH {REGIONS} SELECT factor::INT AS factor, d::INT AS depth_idx, \"by\"::INT AS \"by\", bx::INT AS bx FROM regions, range(2) AS r(d)")
def a04(spark, sf):
    return regions(cells(spark, sf).select("cell_row", "cell_col").distinct(), depths=2).withColumn("depth_idx", F.col("depth_idx").cast("int"))


@query("a05_plan_counts", f"WITH {REGIONS} SELECT factor::INT AS factor, count(*) AS regions FROM regions GROUP BY factor")
def a05(spark, sf):
    return plan_counts(regions(cells(spark, sf).select("cell_row", "cell_col").distinct()))


# ---------------------------------------------------------------- ledgers and checks


@query("a07_layer_counts", f"WITH {TILES} SELECT property, depth, count(*) AS tiles, count(*) FILTER (is_full) AS \"full\", count(*) FILTER (NOT is_full) AS ragged, count(DISTINCT (cell_row, cell_col)) AS cells FROM tiles GROUP BY ALL")
def a07(spark, sf):
    return inventory.layer_counts(tiles(spark, sf))


@query("a08_expected_cells", f"WITH {CELLS} SELECT property, count(DISTINCT (cell_row, cell_col)) AS expected FROM cells GROUP BY property")
def a08(spark, sf):
    return ledger.expected_cells(cells(spark, sf))


@query("a12_ledger_union", f"WITH {CELLS} SELECT property, cell_row, cell_col FROM cells WHERE late UNION SELECT property, cell_row, cell_col FROM cells WHERE NOT late")
def a12(spark, sf):
    c = cells(spark, sf)
    keys = ["property", "cell_row", "cell_col"]
    return ledger.union(c.where("late").select(keys), c.where("not late").select(keys))


@query("a13_coarse_fills", f"WITH {CELLS} SELECT property, 's' || cell_row AS source, sum(user_id)::BIGINT AS pixels_filled FROM cells GROUP BY ALL")
def a13(spark, sf):
    rows = cells(spark, sf).select("property", F.concat(F.lit("s"), "cell_row").alias("source"), F.lit("0_5").alias("depth"), F.col("user_id").alias("pixels_filled"))
    return ledger.coarse_fills(rows).select("property", "source", "pixels_filled")


COMPLETE = f"{CELLS}, pending AS (SELECT DISTINCT property FROM (SELECT property, cell_row, cell_col FROM cells EXCEPT SELECT property, cell_row, cell_col FROM cells WHERE late OR property IN ('click', 'view')))"


def _finished(spark, sf):
    return cells(spark, sf).where("late or property in ('click', 'view')")


@query("a14_complete", f"WITH {COMPLETE} SELECT DISTINCT property FROM cells WHERE property NOT IN (SELECT property FROM pending)")
def a14(spark, sf):
    return ledger.complete_properties(cells(spark, sf), _finished(spark, sf))


@query(
    "v01_structure",
    """SELECT coalesce(a.path, b.path) || ':' || coalesce(a.item, b.item) AS "check", coalesce(a.value = b.value, a.value IS NULL AND b.value IS NULL) AS passed,
      'wanted ' || coalesce(a.value, 'nothing') || ', found ' || coalesce(b.value, 'nothing') AS message
    FROM (SELECT p_brand || '/' || p_partkey AS path, 'size' AS item, p_size::VARCHAR AS value FROM part) a
    FULL JOIN (SELECT p_brand || '/' || p_partkey AS path, 'size' AS item, (p_size % 49)::VARCHAR AS value FROM part WHERE p_size > 3) b ON a.path = b.path AND a.item = b.item""",
)
def v01(spark, sf):
    p = _table(spark, sf, "part")
    side = lambda df, v: df.select(F.concat_ws("/", "p_brand", "p_partkey").alias("path"), F.lit("size").alias("item"), v.cast("string").alias("value"))
    return checks.structure(side(p, F.col("p_size")), side(p.where("p_size > 3"), F.col("p_size") % 49))


@query(
    "v02_byte_exact",
    f"""WITH {NATIVE} SELECT property, count(*) AS pixels, count(*) FILTER (CASE WHEN y % 5 = 0 THEN -32768 ELSE raw END <> raw) AS differing FROM native GROUP BY property""",
)
def v02(spark, sf):
    stored = valued(spark, sf).where("y % 5 <> 0")
    return checks.byte_exact(native(spark, sf), stored, 10)


@query(
    "v03_coarse_holes",
    f"WITH {NATIVE}, {COARSE} SELECT DISTINCT e.source, e.y, e.x FROM expanded e JOIN filled f USING (y, x) WHERE e.value IS NOT NULL AND f.source > 50",
)
def v03(spark, sf):
    """Fills by later suppliers are taken away: those are the holes."""
    stored = filled(spark, sf).where("source <= 50")
    filled_cells = spark.createDataFrame([(0, 0), (0, 1)], "cell_row bigint, cell_col bigint")
    return checks.coarse_holes(expanded(spark, sf), covered(spark, sf), stored, filled_cells, 1800).select("source", "y", "x")


@query(
    "v04_overview_recompute",
    _ladder_sql(2).replace("SELECT y, x, value FROM l2", "SELECT count(*) FILTER (x % 7 = 0) AS differing FROM l2"),
)
def v04(spark, sf):
    grid = order_grid(spark, sf)
    level = pyramid(valued(spark, sf), (2,), grid)[2]
    broken = level.withColumn("value", F.when(F.col("x") % 7 == 0, F.col("value") + 1).otherwise(F.col("value")).cast("float"))
    return checks.recompute(valued(spark, sf), broken, 2, *grid.level_shapes((2,))[2]).agg(F.count("*").alias("differing"))


TEXTURE = """t AS (SELECT CAST(CAST(floor(o_totalprice)::BIGINT % 600 AS DOUBLE) / 10 AS FLOAT) AS a, CAST(CAST(o_orderkey * 37 % 400 AS DOUBLE) / 10 AS FLOAT) AS b,
  CAST(CAST(1000 - floor(o_totalprice)::BIGINT % 600 - o_orderkey * 37 % 400 + o_orderkey % 41 - 1 AS DOUBLE) / 10 AS FLOAT) AS c FROM orders)"""


@query(
    "v06_texture_closure",
    f"WITH {TEXTURE}, s AS (SELECT a::DOUBLE + b::DOUBLE + c::DOUBLE AS s FROM t) SELECT count(*) AS pixels, round(min(s), 3) AS least, round(max(s), 3) AS most, count(*) FILTER (abs(s - 100) > 1.5) AS failed FROM s",
)
def v06(spark, sf):
    k = F.col("o_orderkey")
    sand, silt = F.floor("o_totalprice").cast("long") % 600, k * 37 % 400
    at = _table(spark, sf, "orders").select(F.lit(0).alias("depth_idx"), L.div(k, W).alias("y"), (k % W).alias("x"), sand.alias("a"), silt.alias("b"), (1000 - sand - silt + k % 41 - 1).alias("c"))
    one = lambda c: at.select("depth_idx", "y", "x", units.decode(F.col(c), 10).alias("value"))
    out = checks.closure(one("a"), one("b"), one("c"))
    return out.select("pixels", F.round("least", 3).alias("least"), F.round("most", 3).alias("most"), "failed")


@query(
    "v09_status",
    f"""WITH {CELLS}, e AS (SELECT property, count(DISTINCT (cell_row, cell_col)) AS expected, count(DISTINCT CASE WHEN value > 90 THEN (cell_row, cell_col) END) AS done FROM cells GROUP BY property)
    SELECT property, done, expected, CASE WHEN done = 0 THEN 'empty' WHEN done < expected THEN 'partial' ELSE 'complete' END AS state,
      CASE WHEN property = 'click' THEN 'built' WHEN property = 'view' THEN 'in progress' ELSE 'none' END AS overviews FROM e""",
)
def v09(spark, sf):
    c = cells(spark, sf)
    built = spark.createDataFrame([("click",)], "property string")
    tokens = spark.createDataFrame([("view", 3)], "property string, done int")
    return ledger.status(ledger.expected_cells(c), c.where("value > 90"), built, tokens)


@query(
    "v10_release_gate",
    f"WITH {COMPLETE} SELECT property, 'incomplete' AS reason FROM pending UNION ALL SELECT DISTINCT property, 'no overviews' FROM cells WHERE property <> 'click'",
)
def v10(spark, sf):
    c = cells(spark, sf)
    built = spark.createDataFrame([("click",)], "property string")
    return checks.release_gate(ledger.expected_cells(c), ledger.complete_properties(c, _finished(spark, sf)), built)


@query("a10_tally", "SELECT count(*) FILTER (p_size > 10) AS passed, count(*) FILTER (p_size <= 10) AS failed FROM part")
def a10(spark, sf):
    return checks.tally(_table(spark, sf, "part").select((F.col("p_size") > 10).alias("passed")))


@query("v07_crs_sample", "SELECT p_name AS relpath, contains(lower(p_type), 'steel') AS crs_ok, p_size % 2 = 0 AS pixel_ok FROM part")
def v07(spark, sf):
    header = F.struct(F.regexp_replace("p_type", "(?i)steel", "Goode").alias("crs"), F.when(F.col("p_size") % 2 == 0, 250.0).otherwise(300.0).alias("px"), F.lit(250.0).alias("py"))
    return checks.crs_sample(_table(spark, sf, "part").select(F.col("p_name").alias("relpath"), header.alias("header")), 250.0)


# ---------------------------------------------------------------- reads

DEPTHS3 = "three AS (SELECT property, d AS depth_idx, y, x, CAST(CAST(raw + 7 * d AS DOUBLE) / 10 AS FLOAT) AS value FROM native, range(6) AS r(d) WHERE raw <> -32768)"


def deep(spark, sf):
    """The orders raster at six depths, as stored pixels."""
    rows = native(spark, sf).where(F.col("raw") != spec.NODATA).withColumn("depth_idx", F.explode(F.sequence(F.lit(0), F.lit(5))))
    rows = rows.withColumn("depth_idx", F.col("depth_idx").cast("smallint"))
    value = units.decode((F.col("raw") + 7 * F.col("depth_idx")).cast("smallint"), 10)
    return rows.select("property", F.lit(1).alias("factor"), "depth_idx", "y", "x", value.alias("value"))


LABELS = "depths AS (SELECT unnest(range(6)) AS depth_idx, unnest(['0_5','5_15','15_30','30_60','60_100','100_200']) AS depth_interval, unnest([0,5,15,30,60,100]) AS top, unnest([5,15,30,60,100,200]) AS bottom)"


@query(
    "q01_point_profile",
    f"WITH {NATIVE}, {DEPTHS3}, {LABELS} SELECT d.depth_idx::INT AS depth_idx, d.depth_interval, coalesce(t.value, -1::FLOAT) AS value FROM depths d LEFT JOIN three t ON t.depth_idx = d.depth_idx AND t.y = 3 AND t.x = 7",
)
def q01(spark, sf):
    depths = metadata.depth_table(spark, spec.DEPTHS)
    out = read.profile(deep(spark, sf), depths, GRID.x_min + 7.4 * 250, GRID.y_max - 3.9 * 250)
    return out.select(F.col("depth_idx").cast("int"), "depth_interval", F.nanvl("value", F.lit(-1.0).cast("float")).cast("float").alias("value"))


@query(
    "q02_window",
    f"WITH {NATIVE}, {DEPTHS3} SELECT depth_idx::INT AS depth_idx, y, x, value FROM three WHERE x BETWEEN 10 AND 59 AND y BETWEEN 2 AND 6",
)
def q02(spark, sf):
    out = read.window(deep(spark, sf), GRID.x_min + 10.5 * 250, GRID.x_min + 60 * 250, GRID.y_max - 7 * 250, GRID.y_max - 2.5 * 250)
    return out.select(F.col("depth_idx").cast("int"), "y", "x", "value")


@query("q03_depth", f"WITH {NATIVE}, {DEPTHS3} SELECT y, x, value FROM three WHERE depth_idx = 3")
def q03(spark, sf):
    return read.at_depth(deep(spark, sf), metadata.depth_table(spark, spec.DEPTHS), "30_60").select("y", "x", "value")


@query("q04_level", _ladder_sql(4))
def q04(spark, sf):
    levels = pyramid(valued(spark, sf), (2, 4), order_grid(spark, sf))
    both = levels[2].withColumn("factor", F.lit(2)).unionByName(levels[4].withColumn("factor", F.lit(4)))
    return read.at_level(both, 4).select("y", "x", "value")


@query(
    "q06_time_travel",
    "SELECT n_nationkey, n_name FROM nation",
)
def q06(spark, sf):
    """Two snapshots of a table, the first tagged; the tag still reads the first."""
    store = SnapshotStore.open(spark, f"{shared_dir(spark)}/store-{uuid4().hex}", create=True)
    nation = _table(spark, sf, "nation").select("n_nationkey", "n_name")
    for df, message in ((nation, "first"), (nation.where("n_nationkey < 5"), "second")):
        session = store.writable()
        session.write("nation", df)
        number = session.commit(message)
        if message == "first":
            store.tag("v1", number)
    return store.read("nation", "v1")


@query(
    "q08_unfilled_nan",
    f"""WITH {NATIVE} SELECT i AS y, j AS x, coalesce(p.value, -1::FLOAT) AS value, p.value IS NULL AS missing
    FROM range(4) AS a(i) CROSS JOIN range({W}) AS b(j) LEFT JOIN pixels p ON p.y = i AND p.x = j""",
)
def q08(spark, sf):
    out = read.dense_window(valued(spark, sf).withColumn("factor", F.lit(1)), 0, 4, 0, W, 0)
    return out.select(F.col("y").cast("long"), F.col("x").cast("long"), F.nanvl("value", F.lit(-1.0).cast("float")).cast("float").alias("value"), units.is_fill(F.col("value")).alias("missing"))


@query("q10_depth_bounds", f"WITH {LABELS} SELECT depth_interval, top::INT AS top_cm, bottom::INT AS bottom_cm FROM depths")
def q10(spark, sf):
    d = metadata.depth_table(spark, spec.DEPTHS)
    return d.select("depth_interval", F.col("depth_top_cm").cast("int").alias("top_cm"), F.col("depth_bottom_cm").cast("int").alias("bottom_cm"))


#: The orders raster with its corner at 30 degrees east and 5 degrees north, for reads by place.
TROPICS = GridSpec(math.radians(30) * RADIUS, math.radians(5) * RADIUS, 250.0, W, 1 << 16, 1)


@query(
    "q07_lonlat",
    f"""WITH {NATIVE}, {DEPTHS3}, {LABELS}, p AS (SELECT s_suppkey, (30.0005 + (s_suppkey % 100) / 250.0)::DOUBLE AS lon, (4.9995 - (s_suppkey % 37) / 500.0)::DOUBLE AS lat FROM supplier),
    m AS (SELECT s_suppkey, floor(6378137.0 * radians(lon - 30) * cos(radians(lat)) / 250) AS x, floor(6378137.0 * (radians(5) - radians(lat)) / 250) AS y FROM p)
    SELECT s_suppkey AS point_id, d.depth_idx::INT AS depth_idx, d.depth_interval, coalesce(t.value, -1::FLOAT) AS value
    FROM m CROSS JOIN depths d LEFT JOIN three t ON t.depth_idx = d.depth_idx AND t.y = m.y AND t.x = m.x""",
)
def q07(spark, sf):
    k = F.col("s_suppkey")
    points = _table(spark, sf, "supplier").select(k.alias("point_id"), (F.lit(30.0005) + (k % 100) / 250.0).alias("lon"), (F.lit(4.9995) - (k % 37) / 500.0).alias("lat"))
    out = read.lonlat_profiles(points, deep(spark, sf), metadata.depth_table(spark, spec.DEPTHS), TROPICS)
    return out.select("point_id", F.col("depth_idx").cast("int"), "depth_interval", F.nanvl("value", F.lit(-1.0).cast("float")).cast("float").alias("value"))


@query("v11_info", "SELECT r_regionkey + 2 AS snapshot, r_name AS message FROM region ORDER BY r_regionkey DESC LIMIT 3")
def v11(spark, sf):
    """A commit for each region; the last three of the log: a top-k report."""
    store = SnapshotStore.open(spark, f"{shared_dir(spark)}/store-{uuid4().hex}", create=True)
    for r in _table(spark, sf, "region").orderBy("r_regionkey").collect():
        session = store.writable()
        session.attribute("region", r["r_name"])
        session.commit(r["r_name"])
    return store.info(3)[2].select("snapshot", "message")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Decode, fill gaps from coarse sources, and reduce to the 2x level."""
    fine = native(spark, sf).where("o_orderstatus <> 'O'").withColumn("value", units.decode(F.col("raw"), 10))
    return pyramid(place.assemble(fine, filled(spark, sf)), (2,), order_grid(spark, sf))[2]
