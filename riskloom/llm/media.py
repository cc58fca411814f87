"""Media columns: Netpbm and BMP decoded to numpy arrays, area-resized, tiled as NPY, hashed.

Null bytes give null results; bytes that are no image of these formats give an error text in
`problem` and nulls elsewhere. Repeated rows give equal values; carried columns may have any names,
but those of the result come first.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.storage import carried, made, settle, spread, table, text_slices

#: Samples in a row of a payload image.
WIDTH = 64
TILE = 32

_HEADER_FIELD = re.compile(rb"(?:\s+|#[^\r\n]*[\r\n])*([^\s#]+)")


def write_pgm(samples: bytes, width: int = WIDTH) -> bytes:
    """8-bit samples, a whole number of rows, as a binary PGM."""
    return b"P5\n%d %d\n255\n" % (width, len(samples) // width) + samples


def read_netpbm(data: bytes) -> np.ndarray:
    """PBM, PGM or PPM, plain or binary, as (height, width) or (height, width, 3)."""
    kind, at, fields = data[:2], 2, []
    if not re.fullmatch(rb"P[1-6]", kind):
        raise ValueError("no Netpbm")
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        if not (m := _HEADER_FIELD.match(data, at)):
            raise ValueError("header ends early")
        fields.append(int(m[1]))
        at = m.end()
    width, height, most = *fields[:2], (fields[2] if len(fields) > 2 else 1)
    shape = (height, width, 3) if kind in (b"P3", b"P6") else (height, width)
    if kind in (b"P1", b"P2", b"P3"):
        body = re.sub(rb"#[^\r\n]*", b"", data[at:])
        values = np.frombuffer(re.sub(rb"\s+", b"", body), np.uint8) - 48 if kind == b"P1" else np.array(body.split(), np.int64)
    elif kind == b"P4":
        row = (width + 7) // 8
        bits = np.unpackbits(np.frombuffer(data, np.uint8, row * height, at + 1).reshape(height, row), axis=1)
        values = bits[:, :width].reshape(-1)
    else:
        values = np.frombuffer(data, ">u2" if most > 255 else np.uint8, int(np.prod(shape)), at + 1)
    if kind in (b"P1", b"P4"):
        values = (1 - values) * 255  # 1 is black there
    return values[: int(np.prod(shape))].reshape(shape).astype(np.uint16 if most > 255 else np.uint8, copy=False)


def read_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits a pixel."""
    start, head, width, height, _, bits, packed = struct.unpack_from("<10xIIiiHHI", data)
    if data[:2] != b"BM" or packed not in (0, 3):
        raise ValueError("no plain BMP")
    row, rows = (width * bits + 31) // 32 * 4, abs(height)
    raw = np.frombuffer(data, np.uint8, row * rows, start).reshape(rows, row)
    raw = raw[::-1] if height > 0 else raw
    if bits >= 24:
        return raw[:, : width * bits // 8].reshape(rows, width, bits // 8)[:, :, 2::-1]
    colours = (struct.unpack_from("<I", data, 46)[0] if head >= 36 else 0) or 1 << bits
    palette = np.frombuffer(data, np.uint8, 4 * colours, 14 + head).reshape(-1, 4)[:, 2::-1]
    each = np.unpackbits(raw, axis=1).reshape(rows, -1, bits)[:, :width]
    return palette[each @ (1 << np.arange(bits - 1, -1, -1))]


def decode(data: bytes) -> np.ndarray:
    return read_bmp(data) if data[:2] == b"BM" else read_netpbm(data)


def _prefix_sums(image: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The integral image along the first axis, taken at fractional positions."""
    n = len(image)
    whole = np.minimum(edges.astype(np.int64), n)
    need = np.unique(np.concatenate(([0], whole, np.minimum(whole + 1, n))))
    cuts = need[need < n]
    parts = np.add.reduceat(image, cuts, axis=0, dtype=np.int64 if image.dtype.kind in "ui" else np.float64)
    sums = np.concatenate((np.zeros((1, *image.shape[1:]), parts.dtype), np.cumsum(parts, axis=0)))[: len(need)]
    low, high = sums[np.searchsorted(need, whole)], sums[np.searchsorted(need, np.minimum(whole + 1, n))]
    return low + (high - low) * (edges - whole).reshape(-1, *[1] * (image.ndim - 1))


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over equal boxes of the image; a box edge inside a pixel takes its share of it."""
    rows = np.diff(_prefix_sums(image, np.linspace(0, image.shape[0], height + 1)), axis=0)
    boxes = np.diff(_prefix_sums(np.moveaxis(rows, 1, 0), np.linspace(0, image.shape[1], width + 1)), axis=0)
    return np.moveaxis(boxes, 0, 1) * (height * width / (image.shape[0] * image.shape[1]))


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else image.astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def difference_hash(image: np.ndarray) -> str:
    """64 bits, as hexadecimal digits: is each of 8 x 9 box means less than its right neighbour."""
    small = np.round(area_resize(grey(image), 8, 9), 6)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def npy_tile(image: np.ndarray, side: int = TILE) -> bytes:
    out = io.BytesIO()
    np.save(out, np.clip(np.round(area_resize(image, side, side)), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def media_columns(images: DataFrame, content: str = "content", key: str = "id", side: int = TILE, carry: tuple[str, ...] = ()) -> DataFrame:
    """key, the carried columns, height, width, channels, tile (NPY bytes) and its SHA-256, dhash, problem, and size
    and digests of the samples (payload) and of the bytes (media) for each image; no shuffle."""
    names = {"height": pa.int32(), "width": pa.int32(), "channels": pa.int32(), "tile": pa.binary(), "tile_sha256": pa.string(), "dhash": pa.string()}
    names |= {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "problem": pa.string()}

    def described(data: bytes | None) -> tuple:
        if data is None:
            return (None,) * len(names)
        whole = (len(data), hashlib.sha256(data).hexdigest())
        try:
            a = decode(data)
            if not a.size:
                raise ValueError("no pixels")
            tile, payload = npy_tile(a, side), a.tobytes()
            shape = (a.shape[0], a.shape[1], a.shape[2] if a.ndim == 3 else 1)
            return (*shape, tile, hashlib.sha256(tile).hexdigest(), difference_hash(a), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *whole, None)
        except (ValueError, struct.error, IndexError) as e:
            return (*(None,) * 9, *whole, str(e)[:200])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "content"):
                rows = [described(data) for data in batch.column("content").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(names.values()))], names=["row", *names])

    keep = (key, *carry)
    given = carried(images, keep, content)
    done = given.mapInArrow(run, made(given, "height int, width int, channels int, tile binary, tile_sha256 string, dhash string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, problem string"))
    return spread(done, keep, tuple(names))


def payload_images(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_bytes and content: each text's bytes as a PGM of 64 samples a row.

    Null texts count as empty; an empty text is one row of zero bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text")]
                media = [write_pgm(b.ljust(max(WIDTH, -(-len(b) // WIDTH) * WIDTH), b"\0")) for b in texts]
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(map(len, texts), pa.int64()), pa.array(media, pa.binary())], names=["key", "n_bytes", "content"])

    kind = documents.schema[key].dataType.simpleString()
    out = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n_bytes long, content binary")
    return out.withColumnRenamed("key", key)


def payload_media(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Store each text's bytes as a PGM in a table, read the table back, describe and tile the images in it."""
    stored = settle(payload_images(documents, text, key), "media")
    out = media_columns(stored, "content", key, carry=("n_bytes",))
    return out.select(key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.col("dhash").alias("feature"), "tile", "tile_sha256", "problem")


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_media(table(spark, sf_dir, "documents"))
