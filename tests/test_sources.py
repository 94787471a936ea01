import urllib.error

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom import spec
from gridloom.sources import tiff
from gridloom.sources.inventory import download_mosaics, mosaic_url, parse_listing, parse_mosaic
from gridloom.sources.remote import PASSING, Drifted, Pace, Unreadable, Wanted, fetch_column, pauses, read, read_urls


def field(h, w):
    return (200 + (7 * np.arange(h)[:, None] + 3 * np.arange(w)) % 500).astype(np.int16)


@pytest.mark.parametrize("h,w,rows", [(450, 450, 9), (600, 600, 6), (403, 450, 9), (179, 401, 10), (1, 2, 2)])
@pytest.mark.parametrize("big", [False, True])
def test_tiles_round_trip(h, w, rows, big):
    buf = tiff.encode(field(h, w), (1000.0, 2000.0), (250.0, 125.0), rows, crs="Goode", big_endian=big)
    head, values = tiff.decode(buf)
    assert (values == field(h, w)).all()
    assert (head["width"], head["height"], head["tie_x"], head["tie_y"], head["px"], head["py"]) == (w, h, 1000, 2000, 250, 125)
    assert head["nodata"] == -32768 and head["crs"] == "Goode" and head["contiguous"] and head["big_endian"] == big
    assert tiff.parse_header(buf[:4096])["width"] == w


def broken():
    good = tiff.encode(field(20, 30), (0.0, 0.0), (250.0, 250.0), 9)

    def tag(number, value):
        at = good.index(number.to_bytes(2, "little"), 10)
        return good[: at + 8] + value.to_bytes(4, "little") + good[at + 12 :]

    return [
        (b"XX" + good[2:], "byte-order"), (good[:2] + b"\x07\0" + good[4:], "magic"), (good[:40], "directory"), (good[:6], "truncated"),
        (tag(259, 8), "compression"), (tag(277, 2), "sample"), (tag(258, 8), "16-bit"), (tag(339, 1), "16-bit"), (tag(284, 2), "planar"), (tag(278, 4), "strips"), (b"", "byte-order"),
    ]


@pytest.mark.parametrize("buf,why", broken())
def test_broken_tiles(buf, why):
    with pytest.raises(tiff.TileError, match=why):
        tiff.decode(buf)


def test_truncated_pixels():
    with pytest.raises(tiff.TileError, match="truncated pixels"):
        tiff.decode(tiff.encode(field(20, 30), (0.0, 0.0), (250.0, 250.0))[:-5])


def test_scan(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "t.tif").write_bytes(tiff.encode(field(3, 2), (0.0, 0.0), (250.0, 250.0)))
    (tmp_path / "a" / "bad.tif").write_bytes(b"junk")
    (tmp_path / "a" / "note.txt").write_bytes(b"no")
    rows = {r["path"].rsplit("/", 1)[1]: r for r in tiff.decode_tiles(tiff.scan_files(spark, str(tmp_path))).collect()}
    assert set(rows) == {"t.tif", "bad.tif"}
    assert rows["t.tif"]["values"] == field(3, 2).ravel().tolist() and rows["t.tif"]["error"] is None
    assert rows["bad.tif"]["values"] is None and "byte-order" in rows["bad.tif"]["error"]
    assert "values" in tiff.decode_tiles(tiff.scan_files(spark, str(tmp_path)), pixels=False).columns


class Reply:
    def __init__(self, body, headers):
        self.body, self.headers = body, headers

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass

    def read(self):
        return self.body


def opener(*answers):
    left = list(answers)

    def send(request):
        a = left.pop(0)
        if isinstance(a, int):
            raise urllib.error.HTTPError(request.full_url, a, "", None, None)
        if isinstance(a, Exception):
            raise a
        return a

    send.left = left
    return send


@pytest.mark.parametrize("first", [*sorted(PASSING), urllib.error.URLError("down"), ConnectionResetError()])
def test_transient_failures_are_retried(first):
    waited = []
    got = read(Wanted("http://h/x"), opener(first, Reply(b"ok", {})), sleep=waited.append).body
    assert got == b"ok" and len(waited) == 1 and 1 <= waited[0] <= 3


def test_permanent_failures_and_drift():
    once = opener(404, Reply(b"", {}))
    with pytest.raises(Unreadable, match="404"):
        read(Wanted("http://h/x"), once, sleep=lambda s: None)
    assert len(once.left) == 1
    with pytest.raises(Unreadable, match="6 tries"):
        read(Wanted("http://h/x"), opener(*[503] * 6), sleep=lambda s: None)
    for kind in ({"etag": "b"}, {"size": 3}):
        with pytest.raises(Drifted):
            read(Wanted("http://h/x", **kind), opener(Reply(b"xx", {"ETag": "a"})))
    info = read(Wanted("http://h/x", bare=True), opener(Reply(b"", {"ETag": "a"})))
    assert (info.size, info.etag, info.modified) == (-1, "a", None)
    assert len(list(pauses())) == 5


def test_rate_limit():
    now, waited = [0.0], []
    pace = Pace(0.5, clock=lambda: now[0], sleep=lambda s: (waited.append(s), now.__setitem__(0, now[0] + s)))
    for _ in range(3):
        pace.keep()
    assert waited == [0.5, 0.5]


def test_url_source(spark, tmp_path):
    urls = []
    for i in range(5):
        (tmp_path / f"{i}.bin").write_bytes(b"abcdef"[: i + 1])
        urls.append(f"file://{tmp_path}/{i}.bin")
    urls.append(f"file://{tmp_path}/none.bin")
    rows = read_urls(spark, urls, partitions=3).orderBy("ordinal").collect()
    assert [r["url"] for r in rows] == urls and bytes(rows[4]["content"]) == b"abcde" and rows[5]["content"] is None and rows[5]["error"]
    table = spark.createDataFrame(list(enumerate(urls[:2])), "ordinal long, url string")
    assert {bytes(r["content"]) for r in fetch_column(table, "url", 2, first_bytes=1).collect()} == {b"a"}
    sized = spark.createDataFrame([(urls[0], 1), (urls[1], 2), (urls[5], 3)], "url string, size int")
    assert [r["error"] is None for r in fetch_column(sized, "url", 1, size_col="size").collect()] == [True, True, False]
    with pytest.raises(Exception, match="Drifted"):
        fetch_column(sized.withColumn("size", F.lit(7)), "url", 1, size_col="size").collect()


def test_listing(spark):
    html = "<tr><td><a>b.tif</a></td><td>File</td><td>406,513 Bytes</td><td>x</td></tr><tr><td>d/</td><td>Directory</td><td>-</td><td>x</td></tr><tr><td>b.tif</td><td>f</td><td>7 Bytes</td><td></td></tr>"
    assert spark.range(1).select(parse_listing(F.lit(html))).first()[0] == {"b.tif": 7, "d": None}


SOURCE = '<{k}><SourceFilename relativeToVRT="1">./x/tileSG-001-002/{n}.tif</SourceFilename><SourceProperties RasterXSize="1" RasterYSize="2" BlockYSize="2"/><SrcRect xSize="1" ySize="2"/><DstRect xOff="3" yOff="4.0" xSize="{w}" ySize="124"/></{k}>'
HEAD = '<VRTDataset rasterXSize="159246" rasterYSize="58034"><SRS>G</SRS><GeoTransform>-19949750, 250, 0, 8361000, 0, -250</GeoTransform><Metadata><MDI key="Code_version">v2.0.0</MDI></Metadata>'


def test_mosaic(spark):
    xml = HEAD + '<VRTRasterBand dataType="Int16"><NoDataValue>-32768</NoDataValue>' + SOURCE.format(k="ComplexSource", n="a", w=62) + SOURCE.format(k="ComplexSource", n="b", w=1) + "</VRTRasterBand></VRTDataset>"
    headers, sources = parse_mosaic(spark.createDataFrame([("clay", xml)], "property string, xml string"))
    h = headers.first()
    assert (h["width"], h["geotransform"][0], h["dtype"], h["nodata"], h["metadata"]) == (159246, -19949750.0, "Int16", -32768, {"Code_version": "v2.0.0"})
    rows = sources.orderBy("ordinal").collect()
    assert [(r["relpath"], r["dst_width"], r["resampled"]) for r in rows] == [("tileSG-001-002/a.tif", 62, True), ("tileSG-001-002/b.tif", 1, True)]


@pytest.mark.parametrize(
    "xml,why",
    [("<Other/>", "not a mosaic"), ("<VRTDataset><VRTRasterBand/></VRTDataset>", "transform"), (HEAD + "</VRTDataset>", "band"), (HEAD + '<VRTRasterBand dataType="Int16"><NoDataValue>1</NoDataValue></VRTRasterBand></VRTDataset>', "sources")],
)
def test_broken_mosaics(spark, xml, why):
    with pytest.raises(Exception, match=why):
        parse_mosaic(spark.createDataFrame([(xml,)], "xml string"))[0].collect()


def test_mosaics_are_downloaded(spark, tmp_path):
    prop = next(p for p, _ in spec.layers())
    one, two = prop.depths[:2]
    (tmp_path / prop.name).mkdir()
    (tmp_path / prop.name / f"{prop.layer_dir(one)}.vrt").write_text("<VRTDataset/>")
    got = {r["depth"]: r for r in download_mosaics(spark, f"file://{tmp_path}/", [(prop, one), (prop, two)], 2).collect()}
    assert got[one.label]["xml"] == "<VRTDataset/>" and got[one.label]["error"] is None
    assert got[two.label]["xml"] is None and got[two.label]["error"]
    assert mosaic_url("x/", prop, one) == f"x/{prop.name}/{prop.layer_dir(one)}.vrt"
