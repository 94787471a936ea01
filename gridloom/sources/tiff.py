"""Strict scan of binary tiles: striped, uncompressed, single-band, signed 16-bit."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Fixed values of the format.
TAGS = {
    "width": 256, "height": 257, "bits": 258, "compression": 259, "strip_offsets": 273, "samples": 277, "rows_per_strip": 278, "strip_byte_counts": 279,
    "planar": 284, "predictor": 317, "tile_width": 322, "tile_offsets": 324, "sample_format": 339, "scale": 33550, "tie": 33922, "crs": 34737, "nodata": 42113,
}
KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}


class TileError(ValueError):
    """The bytes aren't a tile of the expected form."""


class Header(dict):
    """The fields of TILE_HEADER, by name."""


def _entries(buf: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}.get(buf[:2])
    if order is None:
        raise TileError("bad byte-order mark")
    if len(buf) < 8:
        raise TileError("truncated header")
    magic = struct.unpack_from(order + "H", buf, 2)[0]
    if magic == 42:
        at, count_kind, entry, inline = struct.unpack_from(order + "I", buf, 4)[0], "H", "HHI", 4
    elif magic == 43:
        if len(buf) < 16 or struct.unpack_from(order + "HH", buf, 4) != (8, 0):
            raise TileError("bad offset size")
        at, count_kind, entry, inline = struct.unpack_from(order + "Q", buf, 8)[0], "Q", "HHQ", 8
    else:
        raise TileError(f"bad magic number {magic}")
    try:
        n = struct.unpack_from(order + count_kind, buf, at)[0]
        at += struct.calcsize(order + count_kind)
        size = struct.calcsize(order + entry) + inline
        out = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + entry, buf, at + k * size)
            if kind not in KINDS:
                continue
            per = KINDS[kind]
            form = order + (f"{count}s" if per == "s" else per * count)
            place = at + k * size + size - inline
            if struct.calcsize(form) > inline:
                place = struct.unpack_from(order + ("I" if inline == 4 else "Q"), buf, place)[0]
            if place + struct.calcsize(form) > len(buf):
                continue  # values past the buffer: a range read may still hold what is needed
            out[tag] = struct.unpack_from(form, buf, place)
    except struct.error:
        raise TileError("truncated directory") from None
    return order, out


def parse_header(buf: bytes) -> Header:
    """The first directory of a classic or big TIFF of either byte order; anything but one
    plain band of signed 16-bit strips with a tie-point and a scale is refused."""
    order, tags = _entries(buf)
    get = lambda name, default=None: tags.get(TAGS[name], default)
    one = lambda name, default=None: get(name, (default,))[0]
    for wrong, why in (
        (get("tile_width") or get("tile_offsets"), "tiled layout"),
        (one("compression", 1) != 1, f"compression {one('compression')}"),
        (one("predictor", 1) != 1, f"predictor {one('predictor')}"),
        (one("samples", 1) != 1, "more than one sample a pixel"),
        (one("planar", 1) != 1, "planar configuration"),
        (one("bits") != 16 or one("sample_format") != 2, "not signed 16-bit"),
        (not one("width") or not one("height"), "no size"),
        (get("strip_offsets") is None or get("strip_byte_counts") is None, "no strips"),
        (get("scale") is None or get("tie") is None, "no tie-point or scale"),
    ):
        if wrong:
            raise TileError(f"refused: {why}")
    width, height = one("width"), one("height")
    rows = min(one("rows_per_strip", height), height)
    offsets, counts = get("strip_offsets"), get("strip_byte_counts")
    sizes = [2 * width * min(rows, height - at) for at in range(0, height, rows)]
    if len(offsets) != len(sizes) or len(counts) != len(sizes):
        raise TileError(f"refused: {len(offsets)} strips, {len(sizes)} expected")
    if list(counts) != sizes:
        raise TileError("refused: strip sizes")
    tie, scale = get("tie"), get("scale")
    text = lambda v: v[0].split(b"\0")[0].decode("ascii", "replace").strip() if v else None
    nodata = text(get("nodata"))
    return Header(
        width=width,
        height=height,
        rows_per_strip=rows,
        strip_offsets=list(offsets),
        strip_byte_counts=list(counts),
        tie_x=tie[3] - tie[0] * scale[0],
        tie_y=tie[4] + tie[1] * scale[1],
        px=scale[0],
        py=scale[1],
        nodata=int(float(nodata)) if nodata else None,
        crs=text(get("crs")),
        big_endian=order == ">",
        contiguous=all(a + n == b for a, n, b in zip(offsets, counts, offsets[1:])),
        data_start=offsets[0],
        data_end=offsets[-1] + counts[-1],
    )


def decode(buf: bytes, header: Header | None = None) -> tuple[Header, np.ndarray]:
    h = header or parse_header(buf)
    kind = ">i2" if h["big_endian"] else "<i2"
    if h["contiguous"]:
        raw = buf[h["data_start"] : h["data_end"]]
    else:
        raw = b"".join(buf[o : o + n] for o, n in zip(h["strip_offsets"], h["strip_byte_counts"]))
    if len(raw) != 2 * h["width"] * h["height"]:
        raise TileError("truncated pixels")
    return h, np.frombuffer(raw, kind).astype(np.int16).reshape(h["height"], h["width"])


def encode(values: np.ndarray, tie: tuple[float, float], pixel: tuple[float, float], rows_per_strip: int = 9, nodata: int = -32768, crs: str = "", big_endian: bool = False) -> bytes:
    """A tile of the form that ``decode`` reads."""
    h, w = values.shape
    o = ">" if big_endian else "<"
    raw = values.astype(o + "i2").tobytes()
    sizes = [2 * w * min(rows_per_strip, h - at) for at in range(0, h, rows_per_strip)]
    text = lambda s: s.encode() + b"\0"
    fields: list[tuple[int, int, int, bytes]] = []
    number = lambda tag, kind, *v: fields.append((tag, kind, len(v), struct.pack(o + KINDS[kind][0] * len(v), *v)))
    for tag, v in ((256, w), (257, h), (258, 16), (259, 1), (262, 1), (277, 1), (278, rows_per_strip), (284, 1), (339, 2)):
        number(tag, 4 if v > 65535 else 3, v)
    number(279, 4, *sizes)
    number(TAGS["scale"], 12, *pixel, 0.0)
    number(TAGS["tie"], 12, 0.0, 0.0, 0.0, *tie, 0.0)
    for tag, s in ((TAGS["crs"], crs), (TAGS["nodata"], str(nodata))):
        fields.append((tag, 2, len(text(s)), text(s)))
    number(273, 4, *[0] * len(sizes))
    fields.sort()
    at = 8 + 2 + 12 * len(fields) + 4
    places = {}
    for tag, _, _, data in fields:
        if len(data) > 4:
            places[tag] = at
            at += len(data) + len(data) % 2
    starts = [at + sum(sizes[:k]) for k in range(len(sizes))]
    head, tail = struct.pack(o + "2sHIH", b"MM" if big_endian else b"II", 42, 8, len(fields)), b""
    for tag, kind, n, data in fields:
        if tag == 273:
            data = struct.pack(o + "I" * n, *starts)
        head += struct.pack(o + "HHI", tag, kind, n) + (struct.pack(o + "I", places[tag]) if len(data) > 4 else data.ljust(4, b"\0"))
        tail += data + b"\0" * (len(data) % 2) if len(data) > 4 else b""
    return head + struct.pack(o + "I", 0) + tail + raw


_HEADER = (
    "struct<width:int,height:int,rows_per_strip:int,strip_offsets:array<bigint>,strip_byte_counts:array<bigint>,tie_x:double,tie_y:double,"
    "px:double,py:double,nodata:int,crs:string,big_endian:boolean,contiguous:boolean,data_start:bigint,data_end:bigint>"
)
_ARROW = pa.struct(
    [
        *((n, pa.int32()) for n in ("width", "height", "rows_per_strip")),
        *((n, pa.list_(pa.int64())) for n in ("strip_offsets", "strip_byte_counts")),
        *((n, pa.float64()) for n in ("tie_x", "tie_y", "px", "py")),
        ("nodata", pa.int32()),
        ("crs", pa.string()),
        ("big_endian", pa.bool_()),
        ("contiguous", pa.bool_()),
        ("data_start", pa.int64()),
        ("data_end", pa.int64()),
    ]
)


def scan_files(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """``(path, modificationTime, length, content)`` of a tree; ``content`` is only read where
    a later step needs it."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)


def decode_tiles(files: DataFrame, pixels: bool = True, content: str = "content") -> DataFrame:
    """``files`` without the bytes, with ``header``, ``values`` (row by row; null without
    ``pixels``) and ``error``: a broken tile is a row with an error, not a failed scan."""
    keep = [c for c in files.columns if c != content]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, values, errors = [], [], []
            for buf in b.column(len(keep)).to_pylist():
                head = cells = why = None
                try:
                    head = parse_header(buf or b"")
                    if pixels:
                        cells = decode(buf, head)[1].ravel()
                except TileError as e:
                    head, why = None, str(e)
                heads.append(head)
                values.append(cells)
                errors.append(why)
            cols = [pa.array(heads, _ARROW), pa.array(values, pa.list_(pa.int16())), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *cols], names=[*keep, "header", "values", "error"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in files.select(keep).schema.fields]
    return files.select(*keep, content).mapInArrow(run, ", ".join([*kinds, f"header {_HEADER}", "values array<smallint>", "error string"]))
