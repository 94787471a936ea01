from pyspark.sql import functions as F

from gridloom import spec
from gridloom.plans.commands import inspect_source
from gridloom.spec import GRID, PROPERTIES

CLAY = PROPERTIES["clay"]
NAME = "tileSG-{:03d}-{:03d}/tileSG-{:03d}-{:03d}_{}-{}.tif"


def rel(r, c, a, b):
    return NAME.format(r, c, r, c, a, b)


def mosaic(tiles, run="RUN10"):
    """A mosaic whose corner is cell (2, 3): tiles are (relpath, x, y in its pixels)."""
    x, y = GRID.x_min + 3 * 450_000, GRID.y_max - 2 * 450_000
    meta = {"Code_version": "v2.0.0", "WoSIS_version": "Data stream 7", "Outputs_version": run, "Transformation": "alr"}
    body = "".join(
        f'<ComplexSource><SourceFilename>./{t}</SourceFilename><SourceProperties RasterXSize="450" RasterYSize="450" BlockYSize="9"/><SrcRect xSize="450" ySize="450"/><DstRect xOff="{dx}" yOff="{dy}" xSize="450" ySize="450"/></ComplexSource>'
        for t, dx, dy in tiles
    )
    pairs = "".join(f'<MDI key="{k}">{v}</MDI>' for k, v in meta.items())
    return f'<VRTDataset rasterXSize="1800" rasterYSize="1800"><SRS>G</SRS><GeoTransform>{x}, 250, 0, {y}, 0, -250</GeoTransform><Metadata>{pairs}</Metadata><VRTRasterBand dataType="Int16"><NoDataValue>-32768</NoDataValue>{body}</VRTRasterBand></VRTDataset>'


def test_inventory_to_manifest(spark):
    tiles = [(rel(2, 3, 1, 1), 0, 0), (rel(2, 3, 1, 2), 450, 0), (rel(2, 3, 4, 4), 450, 0), (rel(2, 3, 2, 1), 0, 450)]
    mosaics = spark.createDataFrame([("clay", "0_5", mosaic(tiles)), ("clay", "5_15", mosaic(tiles[:1], "RUN18"))], "property string, depth string, xml string")
    disk = [("clay", "0_5", t, 100 + k) for k, (t, _, _) in enumerate(tiles[:3])] + [("clay", "0_5", rel(2, 3, 3, 1), 9), ("clay", "0_5", rel(2, 3, 3, 2), 9), ("clay", "0_5", rel(2, 3, 3, 3), 9), ("clay", "0_5", "index.html", 1), ("clay", "5_15", tiles[0][0], 5)]
    listing = spark.createDataFrame(disk, "property string, depth string, relpath string, size bigint")
    x = lambda c, px: GRID.x_min + c * 450_000 + px * 250
    y = GRID.y_max - 2 * 450_000 - 900 * 250
    heads = [(rel(2, 3, 3, 1), x(3, 0), y, None), (rel(2, 3, 3, 2), x(3, 450) + 100, y, None), (rel(2, 3, 3, 3), x(3, 0), y, "broken")]
    headers = spark.createDataFrame(heads, "relpath string, tx double, ty double, error string")
    shape = F.struct(F.col("tx").alias("tie_x"), F.col("ty").alias("tie_y"), F.lit(250.0).alias("px"), F.lit(250.0).alias("py"), F.lit(450).alias("width"), F.lit(450).alias("height"), F.lit(9).alias("rows_per_strip"))
    headers = headers.select(F.lit("clay").alias("property"), F.lit("0_5").alias("depth"), "relpath", F.when(F.col("error").isNull(), shape).alias("header"), "error")
    manifest, issues, report = inspect_source(mosaics, listing, headers, [CLAY], GRID, "http://h/base/")
    assert [(f.name, f.dataType) for f in manifest.schema] == [(f.name, f.dataType) for f in spec.MANIFEST]
    rows = {(r["depth"], r["relpath"]): r for r in manifest.collect()}
    assert set(rows) == {("0_5", rel(2, 3, 1, 1)), ("0_5", rel(2, 3, 1, 2)), ("0_5", rel(2, 3, 2, 1)), ("0_5", rel(2, 3, 3, 1)), ("5_15", rel(2, 3, 1, 1))}
    first = rows["0_5", rel(2, 3, 1, 2)]
    assert (first["x_off"], first["y_off"], first["size"], first["cell"], first["is_full"]) == (5400 + 450, 3600, 101, "tileSG-002-003", True)
    assert first["url"] == f"http://h/base/clay/clay_0-5cm_mean/{rel(2, 3, 1, 2)}"
    found = rows["0_5", rel(2, 3, 3, 1)]
    assert (found["x_off"], found["y_off"], found["cell_row"], found["cell_col"], found["subtile"]) == (5400, 4500, 2, 3, "3-1")
    assert [(r["depth"], r["issue"]) for r in issues.collect()] == [("5_15", "Outputs_version")]
    assert report == {"layers": 2, "tiles": 4, "conflicts": 1, "misplaced": 0, "issues": 1, "inventory_only": 1, "disk_only": {"recovered": 1, "off the lattice": 1, "unreadable": 1}, "anomalies": 0}
