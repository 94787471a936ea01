import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import lattice as L
from gridloom.functions import units
from gridloom.functions.crs import to_metres
from gridloom.operators import place
from gridloom.spec import ENCODING, GRID, EncodingSpec


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


@pytest.mark.parametrize(
    "name,px,xy",
    [
        ("tileSG-018-027_1-1.tif", 450, (-7887500, 500750)),
        ("tileSG-018-027_2-4.tif", 450, (-7550000, 388250)),
        ("tileSG-028-080_2-4.tif", 450, (16300000, -4111750)),
        ("tileSG-018-027_1-1.tif", 600, (-7887500, 500750)),
    ],
)
def test_tile_names_and_origins(spark, name, px, xy):
    t = spark.range(1).select(L.parse_tile_name(F.lit(name), px).alias("t")).select("t.*")
    parts = [F.col(c) for c in t.columns]
    row = t.select(L.tile_name(*parts).alias("name"), *L.tile_origin(*parts, px)).first()
    assert tuple(row) == (name, *xy)


@pytest.mark.parametrize("name", ["tileSG-18-027_1-1.tif", "tileSG-018-027_5-1.tif", "tileSG-018-027_1-0.tif", "x", None])
def test_bad_names(spark, name):
    with pytest.raises(Exception, match="not a tile name"):
        one(spark, L.parse_tile_name(F.lit(name), 450))


def test_pixels(spark):
    assert one(spark, *L.xy_to_pixel(F.lit(GRID.x_min), F.lit(GRID.y_max))) == (0, 0)
    assert one(spark, *L.xy_to_pixel(F.lit(GRID.x_max), F.lit(GRID.y_min))) == (GRID.width, GRID.height)
    for x in (GRID.x_min + 100.0, GRID.x_min - 250.0):
        with pytest.raises(Exception, match="off the lattice"):
            one(spark, *L.xy_to_pixel(F.lit(x), F.lit(GRID.y_max)))


def window(spark, tx, ty, px, py, w, h):
    return tuple(spark.range(1).select(L.source_window(*map(F.lit, (float(tx), float(ty), float(px), float(py), w, h))).alias("w")).select("w.*").first())


def test_source_windows(spark):
    x, y = GRID.x_min, GRID.y_max
    assert window(spark, x + 2500, y - 500, 250, 250, 4, 3) == (10, 2, 4, 3, 1, 1)
    assert window(spark, x, y, 62 * 250, 62 * 250, 1, 2) == (0, 0, 62, 124, 62, 62)
    assert window(spark, x, y, 250, 95 * 250, 28, 2) == (0, 0, 28, 190, 1, 95)
    assert window(spark, x + 125 * 3, y, 750, 250, 1, 1)[:2] == (2, 0)  # half a pixel on a coarse axis, half-even
    for bad in ((x + 100, y, 250, 250, 1, 1), (x, y, 300, 250, 1, 1), (x, y, 250, 100, 1, 1), (x - 250, y, 250, 250, 1, 1)):
        with pytest.raises(Exception):
            window(spark, *bad)


def test_cells_and_shards(spark):
    rect = spark.createDataFrame([(1, 1799, 0, 2, 1), (2, 0, 0, 1800, 1800), (3, 5, 5, 0, 9)], "id int, x int, y int, w int, h int")
    got = {(r["id"], r["cell_row"], r["cell_col"]) for r in L.cells_touching(rect, "x", "y", "w", "h").collect()}
    assert got == {(1, 0, 0), (1, 0, 1), (2, 0, 0)}
    cell = spark.createDataFrame([(2, 3)], "cell_row int, cell_col int")
    shards = L.shard_windows(cell, ENCODING).collect()
    assert len(shards) == 16 and min(r["y0"] for r in shards) == 3600 and max(r["x1"] for r in shards) == 7200
    with pytest.raises(ValueError):
        L.shard_windows(cell, EncodingSpec(50, 700))
    assert L.candidate_tiles(cell, 600).count() == 9
    assert L.all_cells(spark).count() == 2937


@pytest.mark.parametrize("divisor", [10, 100])
def test_units_round_trip_all_integers(spark, divisor):
    raw = spark.range(-32768, 32768).select(F.col("id").cast("smallint").alias("raw"))
    rows = raw.withColumn("v", units.decode(F.col("raw"), divisor)).withColumn("again", units.encode(F.col("v"), divisor))
    assert rows.where("again <> raw").count() == 0
    got = rows.orderBy("raw").toPandas()
    want = np.arange(-32768, 32768).astype(np.int16).astype(np.float32) / np.float32(divisor)
    want[0] = np.nan
    assert np.array_equal(got["v"].to_numpy(), want, equal_nan=True)


def test_text_and_fill(spark):
    rows = spark.createDataFrame([(None,), ("  ",), ("NONE",), (" alr ",)], "t string")
    assert [r[0] for r in rows.select(units.normalise_transformation(F.col("t"))).collect()] == ["none", "none", "none", "alr"]
    assert one(spark, units.is_fill(F.lit(float("nan"))), units.is_fill(F.lit(None).cast("float")), units.hms(F.lit(3725.9))) == (True, False, "01:02:05")


def test_projection(spark):
    x, y = one(spark, *to_metres(F.lit(30.0), F.lit(90.0)))
    assert abs(x - 3339584.72) < 1 and 8_600_000 < y < 8_700_000
    # both forms meet at the limit of latitude
    below, above = (one(spark, *to_metres(F.lit(10.0), F.lit(40.7366111 + d))) for d in (-1e-7, 1e-7))
    assert abs(below[0] - above[0]) < 1 and abs(below[1] - above[1]) < 1
    assert one(spark, *to_metres(F.lit(200.0), F.lit(0.0))) == (None, None)


def test_bbox(spark):
    got = {tuple(r) for r in place.cells_in_bbox(spark, -104, 37, -95, 43).collect()}
    assert got == {(8, 19), (8, 20), (9, 18), (9, 19), (9, 20)}
    assert place.cells_in_bbox(spark, -60, -85, -50, -80).count() == 0
