import numpy as np
import pytest

from gridloom.spec import BLOCKS as spec_blocks
from pyspark.sql import functions as F

from gridloom.operators import checks, inventory, ledger, place, read
from gridloom.operators.pyramid import plan_counts, pyramid, regions
from gridloom.functions import metadata
from gridloom.spec import FACTORS, GRID, DEPTHS, GridSpec, PropertySpec

SMALL = GridSpec(GRID.x_min, GRID.y_max, 250.0, 180, 180, 90)
PX = "property string, depth_idx smallint, y int, x int, value float"


def pixels(spark, array):
    rows = [("p", 0, y, x, float(array[y, x])) for y in range(array.shape[0]) for x in range(array.shape[1])]
    return spark.createDataFrame(rows, PX)


def means(a, stride=2):
    h, w = a.shape[0] // stride, a.shape[1] // stride
    blocks = a[: h * stride, : w * stride].reshape(h, stride, w, stride).swapaxes(1, 2).reshape(h, w, -1).astype(float)
    n = (~np.isnan(blocks)).sum(-1)
    return np.where(n, np.nansum(blocks, -1) / np.maximum(n, 1), np.nan).astype(np.float32)


def dense(df, h, w):
    out = np.full((h, w), np.nan, np.float32)
    for r in df.collect():
        out[r["y"], r["x"]] = r["value"]
    return out


def coastline(n=60):
    y, x = np.mgrid[:n, :n]
    land = 30 + 10 * np.sin(x / 7) + 5 * np.cos(y / 5)
    return np.where(x + y <= 30 + 9 * np.sin(x / 1.5) + 5 * np.cos(y / 2), np.nan, land).astype(np.float32)


@pytest.mark.parametrize("n,factors", [(60, (2, 4, 8)), (61, (2, 4, 8)), (60, (4, 16)), (37, (2,))])
def test_levels_equal_plain_means(spark, n, factors):
    a = coastline(n)
    grid = GridSpec(0, 0, 1, n, n, 1)
    levels, before, level = pyramid(pixels(spark, a), factors, grid), 1, a
    for f in factors:
        level = means(level, f // before)
        assert np.allclose(dense(levels[f], *level.shape), level, rtol=1e-6, atol=0, equal_nan=True)
        before = f
    mixed = np.isnan(a[:60, :60].reshape(-1)[: (n // 2) * 2]).any()
    assert mixed


def test_exact_mean_and_depths(spark):
    rows = [("p", d, y, x, v + d) for d in (0, 1) for (y, x), v in {(0, 0): 10.0, (0, 1): 20.0, (1, 0): 30.0, (1, 1): 41.0}.items()]
    got = {r["depth_idx"]: r["value"] for r in pyramid(spark.createDataFrame(rows, PX), (2,), GridSpec(0, 0, 1, 2, 2, 1))[2].collect()}
    assert got == {0: 25.25, 1: 26.25}


def test_one_shuffle_serves_all_levels(spark):
    grid = GridSpec(0, 0, 1, 2048, 2048, 1)
    df = spark.range(1000).select(F.lit("p").alias("property"), F.lit(0).cast("smallint").alias("depth_idx"), (F.col("id") % 40).cast("int").alias("y"), F.col("id").cast("int").alias("x"), F.lit(1.0).cast("float").alias("value"))
    plan = pyramid(df, FACTORS, grid)[256]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_regions(spark):
    cells = spark.createDataFrame([(0, 0), (32, 88)], "cell_row int, cell_col int")
    got = regions(cells, (2, 256), depths=2)
    assert got.where("factor = 2").count() == 2 * 2 * 4 and got.where("factor = 256").count() == 2 * 2
    assert {r["factor"]: r["regions"] for r in plan_counts(got).collect()} == {2: 16, 256: 4}


def coarse(spark, rows):
    return spark.createDataFrame([("p", 0, s, k, x, y, rx, ry, sy, sx, v) for s, k, x, y, rx, ry, sy, sx, v in rows], "property string, depth_idx smallint, source string, rank int, x_off int, y_off int, rx int, ry int, sy int, sx int, value float")


def test_overwrite_keeps_nodata(spark):
    nan = float("nan")
    rows = [("p", 0, 0, 0, 1.0, 1), ("p", 0, 0, 0, nan, 2), ("p", 0, 0, 1, nan, 1), ("p", 0, 0, 1, 5.0, 3)]
    got = {r["x"]: r["value"] for r in place.overwrite(spark.createDataFrame(rows, PX + ", ordinal int")).collect()}
    assert np.isnan(got[0]) and got[1] == 5.0


def test_coverage_not_value_stops_a_fill(spark):
    nan = float("nan")
    expanded = place.expand_coarse(coarse(spark, [("b", 2, 0, 0, 3, 1, 0, 0, 9.0), ("a", 1, 2, 0, 2, 1, 0, 0, 7.0), ("c", 0, 5, 0, 1, 1, 0, 0, nan)]), SMALL)
    covered = spark.createDataFrame([("p", 0, 0, 0)], "property string, depth_idx smallint, y int, x int")
    for rows in (expanded, expanded.orderBy(F.desc("x"))):  # the order of rows doesn't matter
        got = {r["x"]: (r["source"], r["value"]) for r in place.gap_fill(rows, covered).collect()}
        assert got == {1: ("b", 9.0), 2: ("a", 7.0), 3: ("a", 7.0)}
    counts = {r["source"]: r["pixels_filled"] for r in place.fill_counts(place.gap_fill(expanded, covered)).collect()}
    assert counts == {"a": 2, "b": 1}


def test_expansion_is_nearest_and_clipped(spark):
    got = place.expand_coarse(coarse(spark, [("a", 1, 178, 0, 3, 2, 0, 0, 1.0), ("a", 1, 10, 5, 2, 3, 1, 1, 4.0)]), SMALL).collect()
    at = {(r["y"], r["x"]): r["value"] for r in got}
    assert {k for k, v in at.items() if v == 1.0} == {(y, x) for y in (0, 1) for x in (178, 179)}
    assert {k for k, v in at.items() if v == 4.0} == {(y, x) for y in (8, 9, 10) for x in (12, 13)}


def test_unknown_depth_is_an_error(spark):
    p = PropertySpec("p", "g", "u", "m", 10, 45, 9, "R", depths=DEPTHS)
    rows = spark.createDataFrame([("0_5",), ("7_9",)], "depth string")
    with pytest.raises(Exception, match="unknown depth 7_9"):
        place.depth_index(rows, p).collect()
    assert place.depth_index(rows.where("depth = '0_5'"), p).first()["depth_idx"] == 0


def test_blocks_round_trip(spark):
    a = coastline(37)
    df = pixels(spark, a).where("not isnan(value)").withColumn("factor", F.lit(1))
    blocks = place.to_blocks(df, "g", 10, 37, 37)
    assert [f.name for f in blocks.schema.fields] == [f.name for f in spec_blocks.fields]
    assert blocks.where("n_valid = 0").count() == 0 and {r["w"] for r in blocks.collect()} == {10, 7}
    assert np.array_equal(dense(place.from_blocks(blocks, 10), 37, 37), a, equal_nan=True)


def test_dedupe_is_order_independent(spark):
    rows = [("p", "d", 0, 0, False, "b"), ("p", "d", 0, 0, True, "c"), ("p", "d", 0, 0, False, "a"), ("p", "d", 5, 0, False, "z"), ("p", "d", 5, 0, False, "y")]
    for order in (rows, rows[::-1]):
        kept, lost = inventory.dedupe_windows(spark.createDataFrame(order, "property string, depth string, x_off int, y_off int, named boolean, relpath string"))
        assert {r["relpath"] for r in kept.collect()} == {"c", "y"}
        assert {(r["relpath"], r["kept"]) for r in lost.collect()} == {("a", "c"), ("b", "c"), ("z", "y")}


def test_manifest_and_drift(spark):
    sources = [("p", "0_5", 0, "tileSG-000-001/tileSG-000-001_1-2.tif", 450, 450, 9, 2250.0, 0.0, 450.0, 450.0, False), ("p", "0_5", 1, "tileSG-000-001/tileSG-000-001_1-1.tif", 1, 2, 2, 1800.0, 0.0, 62.0, 124.0, True)]
    df = spark.createDataFrame(sources, "property string, depth string, ordinal long, relpath string, width int, height int, block_y int, dst_x double, dst_y double, dst_width double, dst_height double, resampled boolean")
    rows = {r["ordinal"]: r for r in inventory.build_manifest(df, (F.lit(0), F.lit(0)), 450, F.lit("http://h")).collect()}
    assert (rows[0]["x_off"], rows[0]["named"], rows[0]["misplaced"], rows[0]["subtile"]) == (2250, True, False, "1-2")
    assert (rows[1]["width"], rows[1]["height"], rows[1]["is_full"]) == (62, 124, False)
    moved = inventory.build_manifest(df.limit(1), (F.lit(1), F.lit(0)), 450, F.lit("u")).first()
    assert moved["misplaced"] and not moved["named"]
    with pytest.raises(Exception, match="another cell"):
        inventory.build_manifest(df.withColumn("relpath", F.regexp_replace("relpath", "^tileSG-000-001", "tileSG-000-002")), (F.lit(0), F.lit(0)), 450, F.lit("u")).collect()
    p = PropertySpec("p", "g", "u", "m", 10, 45, 9, "RUN10", "alr", DEPTHS)
    good = {"Code_version": "v2.0.0", "WoSIS_version": "Data stream 7", "Outputs_version": "RUN10", "Transformation": "alr"}
    head = lambda t, n, m: spark.createDataFrame([("p", "0_5", t, n, m)], "property string, depth string, dtype string, nodata double, metadata map<string,string>")
    assert inventory.layer_issues(head("Int16", -32768.0, good), p).count() == 0
    for t, n, m, issue in (("Float32", -32768.0, good, "data type"), ("Int16", -9999.0, good, "nodata"), ("Int16", -32768.0, good | {"Code_version": "v2.1.0"}, "Code_version"), ("Int16", -32768.0, good | {"Transformation": ""}, "Transformation"), ("Int16", -32768.0, good | {"Outputs_version": "RUN18"}, "Outputs_version")):
        assert [r["issue"] for r in inventory.layer_issues(head(t, n, m), p).collect()] == [issue]


def test_sample_is_stable(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    a = [r["k"] for r in inventory.sample(df, "k", 7, seed=1).collect()]
    assert a == [r["k"] for r in inventory.sample(df.repartition(5), "k", 7, seed=1).collect()] and len(a) == 7


def test_completion_is_derived(spark):
    manifest = spark.createDataFrame([("a", 0, 0), ("a", 0, 1), ("b", 0, 0)], "property string, cell_row int, cell_col int")
    done = spark.createDataFrame([("a", 0, 0), ("b", 0, 0)], "property string, cell_row int, cell_col int")
    assert [r["property"] for r in ledger.complete_properties(manifest, done).collect()] == ["b"]


def test_checks(spark):
    a = coastline(20)
    parent, level = pixels(spark, a), pyramid(pixels(spark, a), (2,), GridSpec(0, 0, 1, 20, 20, 1))[2]
    assert checks.recompute(parent, level, 2, 10, 10).count() == 0
    assert checks.recompute(parent, level.where("x <> 9"), 2, 10, 10).count() == level.where("x = 9").count() > 0
    one = lambda v: spark.createDataFrame([(0, 0, 0, v)], "depth_idx int, y int, x int, value float")
    assert checks.closure(one(40.0), one(30.0), one(31.6)).first()["failed"] == 1
    assert checks.closure(one(40.0), one(30.0), one(31.0)).first()["failed"] == 0


def test_reads(spark):
    depths = metadata.depth_table(spark, DEPTHS)
    df = spark.createDataFrame([("p", 1, 0, 3, 4, 1.5), ("p", 1, 2, 3, 4, 2.5)], "property string, factor int, depth_idx smallint, y int, x int, value float")
    x, y = GRID.x_min + 4.9 * 250, GRID.y_max - 3.2 * 250
    got = [r["value"] for r in read.profile(df, depths, x, y).collect()]
    assert got[0] == 1.5 and got[2] == 2.5 and sum(np.isnan(got)) == 4
    assert read.nearest_pixel(GRID.x_min - 999, GRID.y_max + 999) == (0, 0)
    w = read.dense_window(df, 2, 5, 3, 6, 0)
    assert w.count() == 9 and w.where("isnan(value)").count() == 8 and dict(w.dtypes)["value"] == "float"
    # closed on centres
    assert read.window(df, GRID.x_min + 4.5 * 250, GRID.x_min + 4.5 * 250, GRID.y_max - 3.5 * 250, GRID.y_max - 3.5 * 250).count() == 2
    points = spark.createDataFrame([(1, 10.0, 0.0)], "point_id int, lon double, lat double")
    assert read.lonlat_profiles(points, df, depths).count() == 6


def test_filters_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("p", 1, 0, 3, 4, 1.5)], "property string, factor int, depth_idx smallint, y int, x int, value float")
    df.write.parquet(str(tmp_path / "px"))
    stored = spark.read.parquet(str(tmp_path / "px"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = read.window(stored, GRID.x_min, GRID.x_min + 2500, GRID.y_max - 2500, GRID.y_max).select("value")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert "GreaterThanOrEqual(x,0)" in pushed and "LessThanOrEqual(y,9)" in pushed and "EqualTo(factor,1)" in pushed
    assert "property" not in plan[plan.index("ReadSchema") :].split(">")[0]
