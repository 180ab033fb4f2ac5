"""Media columns: bytes kept losslessly as PNG images, with perceptual features.

An image holds 64 RGB pixels (192 bytes) a row. The decoder walks the chunks,
tests every checksum, inflates the image data and undoes all five filter types
with numpy. The feature is a 64-bit hash of the signs of low-frequency cosine
transform coefficients.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import grown, sheltered

WIDTH = 64
ROW = 3 * WIDTH
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_SIDE, _LOW = 32, 8


class BadImage(ValueError):
    """The bytes are not an image that this module can read."""


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def encode_png(payload: bytes, level: int = 2) -> bytes:
    """An RGB image of 8-bit samples; payload is a positive multiple of ROW bytes. Each row takes the Sub filter or none, whichever leaves smaller samples."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    sub = rows.copy()
    sub[:, 3:] -= rows[:, :-3]
    cost = [np.abs(x.view(np.int8).astype(np.int16)).sum(axis=1) for x in (rows, sub)]
    kind = (cost[1] < cost[0]).astype(np.uint8)
    lines = np.empty((len(rows), ROW + 1), np.uint8)
    lines[:, 0] = kind
    lines[:, 1:] = np.where(kind[:, None] == 1, sub, rows)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 2, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def _unfilter(kinds: np.ndarray, lines: np.ndarray, bpp: int) -> np.ndarray:
    """Samples of filtered rows. Filters None and Sub are undone for all rows at once, the rest row by row."""
    out = lines.copy()
    height, width = out.shape
    as_pixels = out.reshape(height, width // bpp, bpp)
    left = kinds == 1
    if left.any():
        as_pixels[left] = np.cumsum(as_pixels[left], axis=1, dtype=np.uint8)
    zero = np.zeros(width, np.uint8)
    for y in np.flatnonzero(kinds > 1):
        up, row = out[y - 1] if y else zero, out[y]
        if kinds[y] == 2:
            row += up
            continue
        if kinds[y] not in (3, 4):
            raise BadImage(f"filter type {kinds[y]}")
        u, r = up.astype(np.int32).reshape(-1, bpp), row.reshape(-1, bpp)
        a, c = np.zeros(bpp, np.int32), np.zeros(bpp, np.int32)
        for x in range(len(r)):
            b = u[x]
            if kinds[y] == 3:
                guess = (a + b) >> 1
            else:
                p = a + b - c
                pa_, pb, pc = np.abs(p - a), np.abs(p - b), np.abs(p - c)
                guess = np.where((pa_ <= pb) & (pa_ <= pc), a, np.where(pb <= pc, b, c))
            a = (r[x] + guess) & 255
            r[x] = a
            c = b
    return out


def decode_png(data: bytes) -> np.ndarray:
    """(height, width, channels) samples of an 8-bit grey, RGB or RGBA image; BadImage if a checksum or a length is wrong."""
    if data[:8] != _SIGNATURE:
        raise BadImage("no signature")
    at, head, parts, ended = 8, None, [], False
    while at + 12 <= len(data) and not ended:
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if len(body) != size or len(data) < at + 12 + size:
            raise BadImage("a chunk is cut off")
        if struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise BadImage(f"checksum of {kind!r}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            parts.append(body)
        ended = kind == b"IEND"
        at += 12 + size
    if head is None or not ended:
        raise BadImage("no header or end")
    width, height, depth, colour, *rest = head
    bpp = {0: 1, 2: 3, 6: 4}.get(colour)
    if depth != 8 or bpp is None or any(rest):
        raise BadImage("only 8-bit grey, RGB and RGBA without interlace")
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8)
    except zlib.error as e:
        raise BadImage(str(e)) from e
    if raw.size != height * (width * bpp + 1):
        raise BadImage("wrong amount of image data")
    raw = raw.reshape(height, -1)
    return _unfilter(raw[:, 0], raw[:, 1:], bpp).reshape(height, width, bpp)


def _cosines() -> np.ndarray:
    k, n = np.arange(_LOW + 1)[:, None], np.arange(_SIDE)[None, :]
    return np.cos(np.pi * k * (2 * n + 1) / (2 * _SIDE)) * np.sqrt(2 / _SIDE)


_DCT = _cosines()


def _means(x: np.ndarray, axis: int) -> np.ndarray:
    """_SIDE means of nearly equal runs along an axis; short axes repeat their entries."""
    n = x.shape[axis]
    starts = np.arange(_SIDE) * n // _SIDE
    if n <= _SIDE:
        return np.take(x, starts, axis=axis)
    sums = np.add.reduceat(x, starts, axis=axis)
    counts = np.diff(np.append(starts, n))
    return sums / (counts[:, None] if axis == 0 else counts[None, :])


def cosine_hash(samples: np.ndarray) -> str:
    """16 hex digits: for each of 8 x 8 low frequencies but the constant ones, whether it exceeds their median."""
    grey = samples.sum(axis=2, dtype=np.float64) / samples.shape[2]
    low = (_DCT @ _means(_means(grey, 0), 1) @ _DCT.T)[1:, 1:].ravel().round(6)
    return f"{int.from_bytes(np.packbits(low > np.median(low)).tobytes(), 'big'):016x}"


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8")
    size = max(ROW, -(-len(raw) // ROW) * ROW)
    return len(raw), raw.ljust(size, b" ")


_DIGEST = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()),
    ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()),
])


def add_media(docs: DataFrame, text: str = "text", media: str = "media", n_bytes: str = "n_bytes") -> DataFrame:
    """docs with the whole text stored as a PNG in a binary column, and its length in bytes.

    Null and empty texts are stored as one row of blanks with n_bytes 0. One
    row in, one row out, whatever repeats; existing columns of these names
    are replaced.
    """
    return sheltered(docs.drop(media, n_bytes), (text,), lambda d: _stored(d, text, media, n_bytes))


def _stored(kept: DataFrame, text: str, media: str, n_bytes: str) -> DataFrame:
    at = kept.columns.index(text)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, images = [], []
            for t in b.column(at):
                n, payload = payload_of(t.as_py())
                sizes.append(n)
                images.append(encode_png(payload))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(images, pa.binary()), pa.array(sizes, pa.int64())], names=[*b.schema.names, media, n_bytes])

    return kept.mapInArrow(store, grown(kept.schema, f"{media} binary, {n_bytes} long"))


def add_features(stored: DataFrame, media: str = "media", n_bytes: str = "n_bytes", doc_id: str = "doc_id") -> DataFrame:
    """The digest of every stored image, from the bytes read back out of it; a null or broken image gives nulls."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, n, image in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                data = image.as_py()
                try:
                    samples = decode_png(data) if data is not None else None
                except BadImage:
                    samples = None
                if samples is None:
                    rows.append((key, n, *[None] * 6))
                    continue
                payload = samples.tobytes()
                rows.append((key, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), cosine_hash(samples)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _DIGEST.types, strict=True)] if rows else [pa.array([], t) for t in _DIGEST.types], schema=_DIGEST)

    kind = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return stored.select(doc_id, n_bytes, media).mapInArrow(read, kind)


def op2(docs: DataFrame) -> DataFrame:
    """Every row with the digest of its text's image, read back; null texts as empty ones, repeated rows alike, an empty table none."""
    return add_features(add_media(docs.select("doc_id", "text")))
