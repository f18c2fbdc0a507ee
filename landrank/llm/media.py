"""Media columns: Netpbm and BMP images as binary columns, decoded, area-resized and hashed in numpy."""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landrank.llm.common import small_batches, written

#: A payload is padded with this byte to a multiple of UNIT bytes.
PAD, UNIT = 255, 576
#: Pixels of a row of the stored images, and side of the tiles.
WIDTH, TILE = 24, 16

STORED = "doc_id string, n_bytes long, media binary"
FEATURES = ("doc_id string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
            "media_sha256 string, feature string, height int, width int, tile_npy binary")


def encode_netpbm(pixels: np.ndarray) -> bytes:
    """P5 of an array (h, w), P6 of an array (h, w, 3)."""
    h, w = pixels.shape[:2]
    return b"P%d\n%d %d\n255\n" % (5 if pixels.ndim == 2 else 6, w, h) + np.ascontiguousarray(pixels, np.uint8).tobytes()


def encode_bmp(pixels: np.ndarray) -> bytes:
    """Uncompressed 24-bit BMP of an array (h, w, 3): rows from below, blue first, padded to 4 bytes."""
    h, w = pixels.shape[:2]
    rows = np.zeros((h, -(-3 * w // 4) * 4), np.uint8)
    rows[:, :3 * w] = pixels[::-1, :, ::-1].reshape(h, 3 * w)
    return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + rows.size, 0, 0, 54, 40, w, h, 1, 24, 0, rows.size, 2835, 2835, 0, 0) + rows.tobytes()


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 with a maximum of 255 at most, as uint8 (h, w) or (h, w, 3); a bitmap's 1 is black."""
    kind, fields, at = data[:2], [], 2
    while len(fields) < (2 if kind in (b"P1", b"P4") else 3):
        m = re.compile(rb"(?:\s|#[^\r\n]*[\r\n])*(\d+)").match(data, at)
        if not m:
            raise ValueError("Netpbm header")
        fields.append(int(m[1]))
        at = m.end()
    w, h, most = (*fields, 1)[:3]
    if not 0 < most < 256:
        raise ValueError("Netpbm maximum")
    n = w * h * (3 if kind in (b"P3", b"P6") else 1)
    if kind == b"P4":
        bits = np.unpackbits(np.frombuffer(data, np.uint8, h * (-(-w // 8)), at + 1).reshape(h, -1), axis=1)[:, :w]
        return ((1 - bits) * 255).astype(np.uint8)
    if kind in (b"P5", b"P6"):
        out = np.frombuffer(data, np.uint8, n, at + 1)
    elif kind == b"P1":
        out = 1 - np.array([c - 48 for c in data[at:] if c in b"01"][:n], np.uint8)
    elif kind in (b"P2", b"P3"):
        out = np.array(data[at:].split()[:n], np.int64).astype(np.uint8)
    else:
        raise ValueError("no Netpbm image")
    if out.size != n:
        raise ValueError("Netpbm image is cut off")
    if most != 255:
        out = ((out.astype(np.uint16) * 255 + most // 2) // most).astype(np.uint8)
    return out.reshape((h, w, 3) if kind in (b"P3", b"P6") else (h, w))


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 8 (palette), 24 or 32 bits, as uint8 (h, w, 3)."""
    if data[:2] != b"BM":
        raise ValueError("no BMP image")
    (at,), (head, w, h, _, bits, packed) = struct.unpack_from("<I", data, 10), struct.unpack_from("<IiiHHI", data, 14)
    if packed or bits not in (8, 24, 32):
        raise ValueError("BMP kind")
    stride = -(-w * bits // 32) * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), at).reshape(abs(h), stride)[:, :w * bits // 8]
    if h > 0:
        rows = rows[::-1]
    if bits == 8:
        palette = np.frombuffer(data, np.uint8, at - 14 - head, 14 + head)
        return palette.reshape(-1, 4)[:, 2::-1][rows]
    return rows.reshape(abs(h), w, bits // 8)[:, :, 2::-1]


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def area_resized(gray: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over equal areas, exact for fractional borders: the integral image is linear between its points."""
    def between(table: np.ndarray, n: int) -> np.ndarray:
        x = np.arange(n + 1) * ((len(table) - 1) / n)
        low = np.minimum(x.astype(np.int64), len(table) - 2)
        part = (x - low).reshape(-1, *[1] * (table.ndim - 1))
        return table[low] * (1 - part) + table[low + 1] * part

    h, w = gray.shape
    integral = np.zeros((h + 1, w + 1))
    np.cumsum(np.cumsum(gray, axis=0, dtype=np.float64), axis=1, out=integral[1:, 1:])
    corners = between(between(integral, height).T, width).T
    return np.diff(np.diff(corners, axis=0), axis=1) * (height * width / (h * w))


def grey(pixels: np.ndarray) -> np.ndarray:
    return pixels.astype(np.float64) if pixels.ndim == 2 else pixels @ np.array([0.299, 0.587, 0.114])


def difference_hash(gray: np.ndarray) -> str:
    """64 bits in hex: whether each of 8 x 8 cells is darker than its right neighbour."""
    small = np.round(area_resized(gray, 8, 9), 6)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def npy(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, tile)
    return out.getvalue()


def stored_form(payload: bytes) -> bytes:
    """The padded payload as an image: grey Netpbm, colour Netpbm or BMP in turn by its length."""
    units = len(payload) // UNIT
    flat = np.frombuffer(payload, np.uint8)
    if units % 3 == 0:
        return encode_netpbm(flat.reshape(-1, WIDTH))
    pixels = flat.reshape(-1, WIDTH, 3)
    return encode_netpbm(pixels) if units % 3 == 1 else encode_bmp(pixels)


def padded(raw: bytes) -> bytes:
    return raw + bytes([PAD]) * (UNIT if not raw else -len(raw) % UNIT)


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each text's UTF-8 bytes as an image.  A null text is empty, and an empty one all padding."""
    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raw = [b"" if x is None else x.encode("utf-8", "surrogatepass") for x in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": [len(x) for x in raw], "media": [stored_form(padded(x)) for x in raw]})

    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(put, STORED)


def features(media: DataFrame) -> DataFrame:
    """What the stored images hold: digests of their samples, a difference hash, and a grey tile as NPY bytes."""
    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for data in b["media"]:
                pixels = decode(data)
                payload, gray = pixels.tobytes(), grey(pixels)
                tile = np.clip(np.rint(area_resized(gray, TILE, TILE)), 0, 255).astype(np.uint8)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data),
                             hashlib.sha256(data).hexdigest(), difference_hash(gray), *pixels.shape[:2], npy(tile)))
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "height", "width", "tile_npy"]
            yield pd.concat([b[["doc_id", "n_bytes"]].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    return media.select("doc_id", "n_bytes", "media").mapInPandas(get, FEATURES).withColumn("doc_id", F.col("doc_id").cast("long"))


def media_features(docs: DataFrame) -> DataFrame:
    """store(), written to the shared folder, then features() of what is read back.

    Equal texts give equal values; rows that repeat are kept; no rows give no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    return features(written(store(docs), "media"))
