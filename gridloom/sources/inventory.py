"""Semi-structured inventories: directory listings and mosaic documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.lattice import guard
from gridloom.sources.remote import fetch_column
from gridloom.spec import DepthInterval, PropertySpec

ROW = r"(?is)<tr[^>]*>\s*<td[^>]*>(.*?)</td>\s*<td[^>]*>(.*?)</td>\s*<td[^>]*>(.*?)</td>\s*<td[^>]*>.*?</td>\s*</tr>"

MOSAIC = (
    "_rasterXSize int, _rasterYSize int, SRS string, GeoTransform string, Metadata array<struct<_domain:string, MDI:array<struct<_key:string,_VALUE:string>>>>, "
    "VRTRasterBand array<struct<_dataType:string, NoDataValue:double, "
    "ComplexSource:array<struct<SourceFilename:string, SourceProperties:struct<_RasterXSize:int,_RasterYSize:int,_BlockYSize:int>, "
    "SrcRect:struct<_xSize:double,_ySize:double>, DstRect:struct<_xOff:double,_yOff:double,_xSize:double,_ySize:double>>>, "
    "SimpleSource:array<struct<SourceFilename:string, SourceProperties:struct<_RasterXSize:int,_RasterYSize:int,_BlockYSize:int>, "
    "SrcRect:struct<_xSize:double,_ySize:double>, DstRect:struct<_xOff:double,_yOff:double,_xSize:double,_ySize:double>>>>>"
)


def parse_listing(html: Column) -> Column:
    """map(name -> size) of a directory listing of four-cell rows: tags go, ``1,234 Bytes`` is
    1234, directories and anything else have no size, a trailing slash goes. Of repeated names
    the last counts."""
    plain = lambda c: F.trim(F.regexp_replace(c, "<[^>]*>", ""))
    cell = lambda r, i: plain(F.regexp_extract(r, ROW, i))
    rows = F.regexp_extract_all(html, F.lit(ROW), F.lit(0))
    size = lambda r: F.when(
        cell(r, 3).rlike(r"^[\d,]+ Bytes$"), F.regexp_replace(cell(r, 3), "[^0-9]", "").cast("bigint")
    )
    name = lambda r: F.regexp_replace(cell(r, 1), "/+$", "")
    entries = F.transform(rows, lambda r: F.struct(name(r).alias("key"), size(r).alias("value")))
    # the last entry of a name wins
    n = F.size(entries)
    last = F.filter(
        entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(n - i - 1, F.lit(0))), lambda later: later["key"] == e["key"])
    )
    return F.map_from_entries(last)


def parse_mosaic(docs: DataFrame, xml_col: str = "xml") -> tuple[DataFrame, DataFrame]:
    """The headers and the sources of mosaic documents, other columns kept.

    A document with a wrong root, without a transform, a band or a source, or with a source
    that lacks a rectangle, raises."""
    keep = [c for c in docs.columns if c != xml_col]
    doc = F.from_xml(F.col(xml_col), MOSAIC, {"rowTag": "VRTDataset"})
    rooted = guard(F.col(xml_col).rlike(r"(?s)<VRTDataset[\s>]"), doc, "not a mosaic document")
    parsed = docs.select(*keep, rooted.alias("d"))
    band = F.col("d.VRTRasterBand")[0]
    sources = F.coalesce(band["ComplexSource"], band["SimpleSource"])
    both = F.when(band["ComplexSource"].isNotNull() & band["SimpleSource"].isNotNull(), F.concat(band["ComplexSource"], band["SimpleSource"])).otherwise(sources)
    ok = guard(F.coalesce(F.size(both) > 0, F.lit(False)), F.lit(True), "a mosaic without sources")
    ok = guard(F.col("d.VRTRasterBand").isNotNull(), ok, "a mosaic without a band")
    ok = guard(F.col("d.GeoTransform").isNotNull(), ok, "a mosaic without a transform")
    numbers = F.transform(F.split(F.col("d.GeoTransform"), ","), lambda v: F.trim(v).cast("double"))
    pairs = F.flatten(F.transform(F.col("d.Metadata"), lambda m: F.coalesce(m["MDI"], F.array().cast("array<struct<_key:string,_VALUE:string>>"))))
    headers = parsed.where(ok).select(
        *keep,
        F.col("d._rasterXSize").alias("width"),
        F.col("d._rasterYSize").alias("height"),
        numbers.alias("geotransform"),
        F.col("d.SRS").alias("srs"),
        band["_dataType"].alias("dtype"),
        band["NoDataValue"].alias("nodata"),
        F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["_key"].alias("key"), p["_VALUE"].alias("value")))).alias("metadata"),
    )
    each = parsed.where(ok).select(*keep, F.posexplode(both).alias("ordinal", "s"))
    whole = F.col("s.DstRect").isNotNull() & F.col("s.SourceProperties").isNotNull() & F.col("s.SourceFilename").isNotNull()
    each = each.where(guard(whole, F.lit(True), "a source without its rectangle"))
    width, height = F.col("s.SourceProperties._RasterXSize"), F.col("s.SourceProperties._RasterYSize")
    rows = each.select(
        *keep,
        F.col("ordinal").cast("long").alias("ordinal"),
        F.regexp_extract("s.SourceFilename", r"([^/]+/[^/]+)$", 1).alias("relpath"),
        width.alias("width"),
        height.alias("height"),
        F.col("s.SourceProperties._BlockYSize").alias("block_y"),
        F.col("s.DstRect._xOff").alias("dst_x"),
        F.col("s.DstRect._yOff").alias("dst_y"),
        F.col("s.DstRect._xSize").alias("dst_width"),
        F.col("s.DstRect._ySize").alias("dst_height"),
        ((width != F.col("s.DstRect._xSize")) | (height != F.col("s.DstRect._ySize"))).alias("resampled"),
    )
    return headers, rows


def mosaic_url(base_url: str, prop: PropertySpec, depth: DepthInterval) -> str:
    """Where a layer's mosaic document lies under the source's address."""
    return f"{base_url.rstrip('/')}/{prop.name}/{prop.layer_dir(depth)}.vrt"


def download_mosaics(spark: SparkSession, base_url: str, layers: Iterable[tuple[PropertySpec, DepthInterval]], partitions: int = 8, per_second: float | None = None) -> DataFrame:
    """``(property, depth, url, xml, error)`` for every layer, over a bounded number of
    connections; a layer that can't be read has its error instead of a document."""
    rows = [(p.name, d.label, mosaic_url(base_url, p, d)) for p, d in layers]
    wanted = spark.createDataFrame(rows, "property string, depth string, url string")
    got = fetch_column(wanted, "url", partitions, per_second=per_second)
    return got.select("property", "depth", "url", F.decode("content", "UTF-8").alias("xml"), "error")
