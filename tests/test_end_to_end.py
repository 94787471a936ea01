import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom import spec
from gridloom.plans import commands as C
from gridloom.plans.store import LEDGER_FILLS, ConcurrentWriter, EncodingMismatch, SnapshotStore, StoreError, retried
from gridloom.sources import tiff
from gridloom.spec import DEPTHS, GRID, EncodingSpec, GridSpec, PropertySpec
from gridloom.streaming.ingest import ingest_manifests

SMALL = GridSpec(GRID.x_min, GRID.y_max, 250.0, 180, 180, 90)
ENC = EncodingSpec(chunk=5, shard=45)
CLAY = PropertySpec("clay", spec.SOIL, "%", "g/kg", 10, 45, 9, "RUN10", depths=DEPTHS[:2])
LEVELS = (2, 4)
GOODE = "Interrupted_Goode_Homolosine"


def value(y, x, depth):
    return 200 + (7 * y + 3 * x) % 500 + depth


def build(spark, folder, ocean=((0, 1),)):
    """Tiles of a 2 x 2 cell grid, one of them missing, and a coarse source over the hole."""
    rows, ordinal = [], 0
    y, x = np.mgrid[:180, :180]
    for d, depth in enumerate(CLAY.depths):
        whole = value(y, x, d).astype(np.int16)
        for r, c in ocean:
            whole[r * 90 : r * 90 + 90, c * 90 : c * 90 + 90] = -32768
        for ty in range(4):
            for tx in range(4):
                if (ty, tx) == (3, 3):
                    continue  # no fine tile here
                part = whole[ty * 45 : ty * 45 + 45, tx * 45 : tx * 45 + 45]
                rel = f"{depth.label}/t{ty}{tx}.tif"
                (folder / depth.label).mkdir(exist_ok=True)
                (folder / rel).write_bytes(tiff.encode(part, (GRID.x_min + tx * 11250, GRID.y_max - ty * 11250), (250.0, 250.0), crs=GOODE))
                rows.append(("clay", depth.label, "", "", "", rel, 45, 45, tx * 45, ty * 45, ty // 2, tx // 2, True, 9, False, None, None, None, ordinal))
                ordinal += 1
        rel = f"{depth.label}/coarse.tif"
        (folder / rel).write_bytes(tiff.encode(np.full((3, 4), 777, np.int16), (GRID.x_min + 132 * 250, GRID.y_max - 132 * 250), (12 * 250.0, 16 * 250.0), 2, crs=GOODE))
        rows.append(("clay", depth.label, "", "", "", rel, 48, 48, 132, 132, 1, 1, False, 2, True, None, None, None, ordinal))
        ordinal += 1
    manifest = spark.createDataFrame(rows, spec.MANIFEST)
    tiles = tiff.decode_tiles(tiff.scan_files(spark, str(folder))).withColumn("relpath", F.regexp_extract("path", "([^/]+/[^/]+)$", 1)).drop("path", "modificationTime", "length")
    tiles = tiles.withColumn("depth", F.regexp_extract("relpath", "^([^/]+)", 1))
    return manifest, tiles


def expected(d):
    y, x = np.mgrid[:180, :180]
    out = (value(y, x, d).astype(np.float32) / np.float32(10)).astype(np.float32)
    out[:90, 90:] = np.nan
    out[135:, 135:] = np.nan
    out[135:180, 135:180] = np.float32(77.7)
    return out


def dense(df, d, h, w):
    out = np.full((h, w), np.nan, np.float32)
    for r in df.where(F.col("depth_idx") == d).collect():
        out[r["y"], r["x"]] = r["value"]
    return out


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tiles")
    manifest, tiles = build(spark, folder)
    store = SnapshotStore.open(spark, str(tmp_path_factory.mktemp("store")), create=True)
    return store, manifest.cache(), tiles.cache()


def test_whole_run(spark, world):
    store, manifest, tiles = world
    created = C.init_store(store, [CLAY], SMALL, ENC, LEVELS)
    assert "soil_properties/clay" in created and C.init_store(store, [CLAY], SMALL, ENC, LEVELS) == []
    with pytest.raises(EncodingMismatch):
        C.init_store(store, [CLAY], SMALL, EncodingSpec(chunk=15, shard=45), LEVELS)
    with pytest.raises(StoreError, match="no cells"):
        C.build_overviews(store, CLAY, SMALL, ENC, LEVELS)
    # the first cell, then a kill before the second commit, then a resume
    C.materialize(store, CLAY, manifest, tiles, SMALL, ENC, cells=[(0, 0)], commit_every=1)
    with pytest.raises(KeyboardInterrupt):
        C.materialize(store, CLAY, manifest, tiles, SMALL, ENC, commit_every=1, checkpoint=lambda s: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(StoreError, match="clay incomplete"):
        C.release(store, manifest, "v0", [CLAY], SMALL, ENC, LEVELS)
    state = C.status(store, manifest).first()
    assert (state["done"], state["expected"], state["state"], state["overviews"]) == (1, 4, "partial", "none")
    stats = C.materialize(store, CLAY, manifest, tiles, SMALL, ENC)
    assert stats["cells"] == 3 and stats["filled"] == 2 * 45 * 45 and stats["anomalies"] == 0
    assert C.materialize(store, CLAY, manifest, tiles, SMALL, ENC)["cells"] == 0
    px = C.pixels_of(store, CLAY, ENC).cache()
    for d in (0, 1):
        assert np.array_equal(dense(px, d, 180, 180), expected(d), equal_nan=True)
    blocks = store.read(next(k for k in store.keys() if k.startswith("blocks/clay/1/")))
    assert blocks.where("n_valid = 0").count() == 0
    assert C.build_overviews(store, CLAY, SMALL, ENC, LEVELS) == 2
    assert C.build_overviews(store, CLAY, SMALL, ENC, LEVELS) == 0
    assert "progress/clay" not in store.attributes()
    level = C.pixels_of(store, CLAY, ENC, 2)
    blocks4 = expected(0).reshape(90, 2, 90, 2).swapaxes(1, 2).reshape(90, 90, 4)
    with np.errstate(invalid="ignore"):
        want = np.where(np.isnan(blocks4).all(-1), np.nan, np.nanmean(np.where(np.isnan(blocks4).all(-1, keepdims=True), 0, blocks4).astype(float), -1))
    assert np.allclose(dense(level, 0, 90, 90), want, rtol=1e-6, equal_nan=True)
    found = C.validate(store, [CLAY], SMALL, ENC, LEVELS, manifest=manifest, tiles=tiles).collect()
    assert [r for r in found if not r["passed"]] == []
    assert {f"{k}:clay" for k in ("tiles", "holes", "crs")} < {r["check"] for r in found}
    assert next(r for r in found if r["check"] == "tiles:clay")["message"] == f"0 of {2 * 15 * 45 * 45} pixels differ"
    # another source, another projection, other levels: each is found by its own check
    other = tiles.withColumn("values", F.when(F.col("relpath") == "0_5/t00.tif", F.transform("values", lambda v: (v + 1).cast("smallint"))).otherwise(F.col("values")))
    other = other.withColumn("header", F.when(F.col("relpath") == "0_5/t10.tif", F.col("header").withField("crs", F.lit("Mercator"))).otherwise(F.col("header")))
    found = {r["check"]: r for r in C.validate(store, [CLAY], SMALL, ENC, (2,), manifest=manifest, tiles=other).collect() if not r["passed"]}
    assert found["tiles:clay"]["message"].startswith("2025 of") and found["crs:clay"]["message"].startswith("1 of")
    assert any(k.startswith("structure:/:multiscales") for k in found)
    C.release(store, manifest, "v1", [CLAY], SMALL, ENC, LEVELS)
    with pytest.raises(StoreError, match="used once"):
        C.release(store, manifest, "v1", [CLAY], SMALL, ENC, LEVELS)
    levels = {f: sorted(map(tuple, C.pixels_of(store, CLAY, ENC, f).select(*spec.PIXELS.fieldNames()).collect())) for f in LEVELS}
    head = store.head()
    C.materialize(store, CLAY, manifest, tiles.withColumn("values", F.transform("values", lambda v: F.when(v > 0, v + 10).otherwise(v).cast("smallint"))), SMALL, ENC, cells=[(1, 0)], overwrite=True)
    assert C.build_overviews(store, CLAY, SMALL, ENC, LEVELS, cells=[(1, 0), (7, 7)]) == 2
    assert C.validate(store, [CLAY], SMALL, ENC, LEVELS).where("not passed").count() == 0
    for f in LEVELS:
        again = sorted(map(tuple, C.pixels_of(store, CLAY, ENC, f).select(*spec.PIXELS.fieldNames()).collect()))
        moved = {(a[3], a[4]) for a, b in zip(again, levels[f]) if a != b}
        assert len(again) == len(levels[f]) and moved == {(y, x) for y in range(90 // f, -(-180 // f)) for x in range(-(-90 // f))}
    assert store.head() > head and store.tags() == ["v1"] and C.validate(store, [CLAY], SMALL, ENC, LEVELS, ref="v1").where("not passed").count() == 0
    assert C.status(store, manifest).first()["state"] == "complete"


def test_written_again(spark, world, tmp_path):
    """A cell that is written again takes the place of what it held, also by other batches."""
    _, manifest, tiles = world
    store = SnapshotStore.open(spark, str(tmp_path), create=True)
    C.materialize(store, CLAY, manifest, tiles, SMALL, ENC, commit_every=4)
    fills = sorted(map(tuple, store.ledger("fills", LEDGER_FILLS).collect()))
    for cells, every in (([(0, 1)], 16), ([(1, 0), (1, 1)], 1), (None, 3)):
        C.materialize(store, CLAY, manifest, tiles, SMALL, ENC, cells=cells, commit_every=every, overwrite=True)
        px = C.pixels_of(store, CLAY, ENC)
        assert px.count() == px.select("depth_idx", "y", "x").distinct().count() == sum(int((~np.isnan(expected(d))).sum()) for d in (0, 1))
        assert sorted(map(tuple, store.ledger("fills", LEDGER_FILLS).collect())) == fills and fills
    # a cell whose tiles are gone holds nothing afterwards, as of now only
    before = store.head()
    none = tiles.withColumn("error", F.lit("gone")).withColumn("values", F.lit(None).cast(tiles.schema["values"].dataType))
    C.materialize(store, CLAY, manifest, none, SMALL, ENC, overwrite=True)
    assert C.pixels_of(store, CLAY, ENC).count() == 0 and C.pixels_of(store, CLAY, ENC, ref=before).count() > 0
    store.collect_garbage(time.time() + 60)  # folders of batches without a block
    assert C.pixels_of(store, CLAY, ENC, ref=before).count() > 0


def test_snapshots_appear_whole(spark, tmp_path):
    store = SnapshotStore.open(spark, str(tmp_path), create=True)
    name = store.snapshot_path(2)
    claim = tmp_path / "snapshots" / f".claim-{name.rsplit('/', 1)[1]}"
    claim.write_text("")  # a writer at work: nobody else's file appears, and readers see none
    assert not store.files.create(name, "{}") and store.head() == 1
    os.utime(claim, (0, 0))  # it has died
    assert store.files.create(name, '{"parent": 1, "message": "x", "written_at": 0}') and store.head() == 2
    assert not store.files.create(name, "other") and store.snapshot(2).message == "x"
    assert [p.name for p in (tmp_path / "snapshots").iterdir() if p.name.startswith((".claim", ".draft"))] == []


def test_failed_tile_stays_empty_and_is_reported(spark, world, tmp_path):
    _, manifest, tiles = world
    bad = tiles.withColumn("error", F.when(F.col("relpath") == "0_5/t00.tif", "gone")).withColumn("values", F.when(F.col("error").isNull(), F.col("values")))
    store = SnapshotStore.open(spark, str(tmp_path), create=True)
    stats = C.materialize(store, CLAY, manifest, bad, SMALL, ENC, cells=[(0, 0)])
    assert stats["anomalies"] == 1
    got = dense(C.pixels_of(store, CLAY, ENC), 0, 180, 180)
    assert np.isnan(got[:45, :45]).all() and not np.isnan(got[45:90, :90]).any()


@pytest.mark.parametrize("change,why", [({"px": 300.0}, "pixel"), ({"nodata": -9999}, "nodata"), ({"tie_x": GRID.x_min + 250.0}, "place"), ({"width": 44}, "shape")])
def test_refused_tiles(spark, world, tmp_path, change, why):
    _, manifest, tiles = world
    wrong = tiles.withColumn("header", F.col("header").withField(*[(k, F.lit(v)) for k, v in change.items()][0]))
    with pytest.raises(Exception, match=why if why != "pixel" else "pixel|ratio"):
        C.materialize(SnapshotStore.open(spark, str(tmp_path), create=True), CLAY, manifest, wrong, SMALL, ENC, cells=[(0, 0)])


def test_concurrent_writers(spark, tmp_path):
    store = SnapshotStore.open(spark, str(tmp_path), create=True)
    df = spark.range(3)
    a, b, c = store.writable(), store.writable(), store.writable()
    for s, key in ((a, "one"), (b, "two"), (c, "one")):
        s.write(key, df)
        s.record("cells", [(key, 0, 0)])
    a.commit("a")
    b.commit("b")  # disjoint: rebased
    with pytest.raises(ConcurrentWriter):
        c.commit("c")
    assert store.keys() == ["one", "two"]
    assert store.ledger("cells", "k string, r int, c int").count() == 2
    assert store.orphans(time.time() + 60) and store.collect_garbage(time.time() + 60) == 1 and store.orphans(time.time() + 60) == []
    assert store.collect_garbage(0) == 0 and store.read("one").count() == 3
    keys, tags, log = store.info()
    assert [r["message"] for r in log.collect()] == ["b", "a", "create"] and tags == []
    assert store.total_bytes()[0] > 3
    with pytest.raises(StoreError):
        SnapshotStore.open(spark, str(tmp_path / "none"))


def test_time_travel(spark, tmp_path):
    store = SnapshotStore.open(spark, str(tmp_path), create=True)
    for n, tag in ((3, "v1"), (5, None)):
        s = store.writable()
        s.write("t", spark.range(n))
        number = s.commit(str(n))
        if tag:
            store.tag(tag, number)
    assert (store.read("t", "v1").count(), store.read("t").count()) == (3, 5)
    with pytest.raises(StoreError, match="no tag"):
        store.read("t", "v9")


def test_retries():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("passing")
        return 7

    assert retried(flaky, sleep=lambda s: None) == 7
    for final in (ConcurrentWriter("x"), PermissionError("no")):
        with pytest.raises(type(final)):
            retried(lambda: (_ for _ in ()).throw(final), sleep=lambda s: pytest.fail("retried"))


def test_manifest_files_and_ingest(spark, world, tmp_path):
    _, manifest, _ = world
    C.write_manifest(manifest, {"b": 1, "a": 2}, str(tmp_path / "m"))
    assert C.read_manifest(spark, str(tmp_path / "m")).count() == manifest.count()
    with pytest.raises(StoreError):
        C.read_manifest(spark, str(tmp_path / "none"))
    seen = []
    for _ in range(2):
        q = ingest_manifests(spark, str(tmp_path / "m" / "manifest.parquet"), str(tmp_path / "state"), lambda df, n: seen.append(df.count()))
        q.awaitTermination(60)
    assert sum(seen) == manifest.count()
