"""Media columns: texts stored as lossless WebP and read back, and files decoded to pixels."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import utf8
from gridloom.llm.webp import Image, WebpError, decode
from gridloom.llm.webp_writer import WIDTH, encode_payload


def split_files(media: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(media):
        if media[at : at + 4] != b"RIFF":
            raise WebpError("not a lossless WebP file")
        end = at + 8 + struct.unpack_from("<I", media, at + 4)[0]
        out.append(media[at:end])
        at = end
    return out


def decode_payload(media: bytes) -> tuple[bytes, list[Image]]:
    images = [decode(f) for f in split_files(media)]
    return b"".join(i[..., (1, 2, 3, 0)].tobytes() for i in images), images


def features(payload: bytes, images: list[Image]) -> str:
    """Size, mean of each sample (red, green, blue, alpha) and the bytes' entropy in bits."""
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    share = counts[counts > 0] / len(payload)
    means = np.frombuffer(payload, np.uint8).reshape(-1, 4).mean(axis=0, dtype=np.float64)
    size = f"{images[0].shape[1]}x{sum(i.shape[0] for i in images)}"
    return f"{size};" + ",".join(f"{m:.4f}" for m in means) + f";{float(-(share * np.log2(share)).sum()):.4f}"


def pad(text: bytes, unit: int = 4 * WIDTH) -> bytes:
    return text + b"\xff" * (max(unit, -(-len(text) // unit) * unit) - len(text))


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_media: bool = False) -> DataFrame:
    """Every row's text as a lossless WebP file that is read back: ``(doc_id, n_bytes,
    payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature)``, and the
    file with ``with_media``. The payload is the UTF-8 text, null being empty, filled with 255
    to a positive multiple of 576; it is taken from the decoded file. Each text is one row's
    work; nothing is shuffled. Null ids and repeated rows are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: dict[str, list] = {k: [] for k in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
            files = []
            for text in utf8(b.column(1)):
                text = text or b""
                media = encode_payload(pad(text))
                payload, images = decode_payload(media)
                values = (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), features(payload, images))
                for k, v in zip(rows, values):
                    rows[k].append(v)
                if with_media:
                    files.append(media)
            out = {"doc_id": b.column(0), **rows}
            if with_media:
                out["media"] = pa.array(files, pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, schema + ", media binary" * with_media)


def decode_media(media: DataFrame, media_col: str = "media") -> DataFrame:
    """``media`` with ``width``, ``height``, ``pixels`` (binary, alpha-red-green-blue samples
    row by row) and ``media_error``; a null or broken file gets null pixels and a reason."""
    base = media.drop("width", "height", "pixels", "media_error")
    at = base.columns.index(media_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for data in b.column(at).to_pylist():
                try:
                    image = decode(data or b"")
                    out.append((image.shape[1], image.shape[0], image.tobytes(), None))
                except WebpError as e:
                    out.append((None, None, None, str(e)))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.string())
            more = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, "width", "height", "pixels", "media_error"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields), "width int, height int, pixels binary, media_error string"])
    return base.mapInArrow(run, schema)
