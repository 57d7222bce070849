"""Media columns (operator 8): Netpbm and BMP images in binary columns.

Method: images are decoded to numpy arrays (P1 to P6 and uncompressed BMP), resized by area with integral images (an integral
image, interpolated linearly, integrates a piecewise constant image exactly, so fractional pixel edges count in full), and
written as NPY tiles with a 64-bit difference hash. A text can be stored as an image without loss: its UTF-8 bytes, padded with
blanks to whole rows, are the samples. Integral images are taken a band of output rows at a time, so that a long text needs
memory for a band.

Nulls and edges: a null or empty text is one row of blanks; other null or unreadable images give null tiles and features;
repeated rows give equal rows; columns of the input that aren't named are dropped; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import keep, map_texts

ROW_BYTES = 192
TILE = 16


def encode_pnm(samples: np.ndarray) -> bytes:
    """P6 of a height x width x 3 array of 8-bit samples, P5 of a height x width one."""
    h, w = samples.shape[:2]
    return b"P%d\n%d %d\n255\n" % (6 if samples.ndim == 3 else 5, w, h) + np.ascontiguousarray(samples, np.uint8).tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """A 24-bit BMP of a height x width x 3 array."""
    h, w = samples.shape[:2]
    rows = np.zeros((h, -(-3 * w // 4) * 4), np.uint8)
    rows[:, : 3 * w] = samples[::-1, :, ::-1].reshape(h, 3 * w)
    head = struct.pack("<2sIHHI", b"BM", 54 + rows.size, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, rows.size, 0, 0, 0, 0)
    return head + rows.tobytes()


def _pnm(raw: bytes) -> np.ndarray:
    kind, at, numbers = raw[1] - 48, 2, []
    while len(numbers) < (2 if kind in (1, 4) else 3):
        m = re.compile(rb"(?:\s|#[^\n]*\n)*(\d+)").match(raw, at)
        if not m:
            raise ValueError("a Netpbm header is cut off")
        numbers.append(int(m[1]))
        at = m.end()
    w, h, top = *numbers[:2], numbers[2] if len(numbers) > 2 else 1
    depth = 3 if kind in (3, 6) else 1
    if kind == 1:
        body = re.sub(rb"#[^\n]*|\s", b"", raw[at:])[: w * h]
        flat = 1 - (np.frombuffer(body, np.uint8) - 48)
    elif kind in (2, 3):
        flat = np.array(re.sub(rb"#[^\n]*", b"", raw[at:]).split()[: w * h * depth], np.int64)
    elif kind == 4:
        wide = -(-w // 8)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, wide * h, at + 1).reshape(h, wide), axis=1)[:, :w]
        flat = 1 - bits.reshape(-1)
    else:
        flat = np.frombuffer(raw, np.uint8 if top < 256 else ">u2", w * h * depth, at + 1)
    if flat.size != w * h * depth:
        raise ValueError("a Netpbm image is cut off")
    if top != 255:
        flat = flat.astype(np.int64) * 255 // top
    flat = flat.astype(np.uint8, copy=False)
    return flat.reshape(h, w, 3) if depth == 3 else flat.reshape(h, w)


def _bmp(raw: bytes) -> np.ndarray:
    start, size = struct.unpack_from("<II", raw, 10)
    w, h, _, depth, packed = struct.unpack_from("<iiHHI", raw, 18)
    if packed or depth not in (8, 24, 32):
        raise ValueError("only uncompressed BMP of 8, 24 or 32 bits is read")
    wide = -(-w * depth // 32) * 4
    rows = np.frombuffer(raw, np.uint8, wide * abs(h), start).reshape(abs(h), wide)
    rows = rows[::-1] if h > 0 else rows
    if depth == 8:
        table = np.frombuffer(raw, np.uint8, (struct.unpack_from("<I", raw, 46)[0] or 256) * 4, 14 + size).reshape(-1, 4)
        return table[rows[:, :w]][:, :, 2::-1]
    return rows[:, : w * depth // 8].reshape(abs(h), w, depth // 8)[:, :, 2::-1]


def decode(raw: bytes) -> np.ndarray:
    """Samples of a Netpbm or BMP image, 0 to 255: height x width x 3, or height x width of grey."""
    if raw[:2] == b"BM":
        return _bmp(raw)
    if len(raw) > 2 and raw[:1] == b"P" and raw[1:2] in b"123456":
        return _pnm(raw)
    raise ValueError("neither Netpbm nor BMP")


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else ((image @ np.array([299, 587, 114], np.int64)) // 1000).astype(np.uint8)


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Area means of a grey image on a grid of height x width."""
    h, w = image.shape
    xs = np.linspace(0, w, width + 1)
    x0 = np.minimum(xs.astype(np.int64), w - 1)
    out = np.zeros((height, width))
    for i in range(height):
        top, bottom = i * h / height, (i + 1) * h / height
        first, last = int(top), min(h, -int(-bottom // 1))
        s = np.zeros((last - first + 1, w + 1))
        np.cumsum(np.cumsum(image[first:last], axis=0, dtype=np.int64), axis=1, out=s[1:, 1:])
        s = s[:, x0] + (s[:, x0 + 1] - s[:, x0]) * (xs - x0)  # at the grid's x
        at = lambda y: s[(k := min(int(y), last - first - 1))] + (s[k + 1] - s[k]) * (y - k)  # noqa: B023, E731
        out[i] = np.diff(at(bottom - first) - at(top - first)) / ((bottom - top) * (w / width))
    return out


def difference_hash(image: np.ndarray) -> str:
    """64 bits: whether each of 8 x 8 means is below its right neighbour."""
    small = area_resize(grey(image), 8, 9)
    return np.packbits(np.diff(np.round(small, 6), axis=1) > 0).tobytes().hex()


def npy(image: np.ndarray, side: int = TILE) -> bytes:
    """A side x side grey tile as an NPY file."""
    np.save(f := io.BytesIO(), np.rint(area_resize(grey(image), side, side)).astype(np.uint8), allow_pickle=False)
    return f.getvalue()


def payload(text: bytes, row_bytes: int = ROW_BYTES) -> bytes:
    return text + b" " * (-len(text) % row_bytes if text else row_bytes)


MEDIA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])


def texts_to_media(docs: DataFrame, row_bytes: int = ROW_BYTES, form: str = "pnm") -> DataFrame:
    """doc_id, n_bytes, media: each whole text as an image of row_bytes / 3 pixels a row, as "pnm" or "bmp"."""
    encode = {"pnm": encode_pnm, "bmp": encode_bmp}[form]

    def step(rows, texts):
        media = [encode(np.frombuffer(payload(t, row_bytes), np.uint8).reshape(-1, row_bytes // 3, 3)) for t in texts]
        return {"doc_id": rows.column("doc_id"), "n_bytes": [len(t) for t in texts], "media": media}

    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), "text", MEDIA, step)


FEATURES = T.StructType([T.StructField("tile", T.BinaryType()), T.StructField("feature", T.StringType()), T.StructField("samples", T.BinaryType())])


def read_media(media: DataFrame, digests: bool = False) -> DataFrame:
    """Each image decoded: its columns, tile (NPY), feature (difference hash), and the samples, or with digests their sums."""
    passed = [f for f in media.schema.fields if f.name != "media"]
    own = [f for f in FEATURES.fields if f.name != "samples"] + ([T.StructField("payload_bytes", T.LongType()), T.StructField("payload_sha256", T.StringType()), T.StructField("tail_crc32", T.LongType()), T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType())] if digests else [FEATURES["samples"], ])

    def step(rows, blobs):
        out: dict = {f.name: rows.column(rows.schema.get_field_index(f.name)) for f in passed} | {f.name: [] for f in own}
        for raw in blobs:
            try:
                image = decode(raw)
                row = {"tile": npy(image), "feature": difference_hash(image), "samples": image.tobytes()}
            except (ValueError, struct.error, IndexError):
                row = {"tile": None, "feature": None, "samples": None}
            if digests and (x := row["samples"]) is not None:
                row |= {"payload_bytes": len(x), "payload_sha256": hashlib.sha256(x).hexdigest(), "tail_crc32": zlib.crc32(x[-16:]), "media_bytes": len(raw), "media_sha256": hashlib.sha256(raw).hexdigest()}
            for f in own:
                out[f.name].append(row.get(f.name))
        return out

    return map_texts(media, "media", T.StructType([*passed, *own]), step)


def documents_as_media(docs: DataFrame, row_bytes: int = ROW_BYTES, form: str = "pnm") -> DataFrame:
    """Stores every text as an image in the shared folder, reads the images back, and stores their NPY tiles, digests and features, which are read again."""
    stored, _ = keep(texts_to_media(docs, row_bytes, form), "media")
    tiles, _ = keep(read_media(stored, digests=True), "tiles")
    return tiles
