"""Deletion vectors: positions of deleted rows as 64-bit Roaring bitmaps.

Form: length of what follows up to the checksum (4 bytes, big-endian), magic
D1 D3 39 64, the bitmap in Roaring's portable 64-bit form, CRC-32 of magic and
bitmap (big-endian). Positions are grouped by their upper 32 bits, then by the
next 16; a group of up to 4096 is a sorted array, a larger one a bit set, and
runs are read too.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Fixed values of the form.
MAGIC = bytes.fromhex("D1D33964")
_PLAIN, _RUNS, _ARRAY_MOST = 12346, 12347, 4096


def _dumped32(low: np.ndarray) -> bytes:
    keys, starts = np.unique(low >> np.uint32(16), return_index=True)
    groups = np.split((low & np.uint32(0xFFFF)).astype("<u2"), starts[1:])
    heads = b"".join(struct.pack("<HH", int(k), len(g) - 1) for k, g in zip(keys, groups, strict=True))
    bodies = []
    for g in groups:
        if len(g) <= _ARRAY_MOST:
            bodies.append(g.tobytes())
        else:
            bits = np.zeros(1 << 16, np.uint8)
            bits[g] = 1
            bodies.append(np.packbits(bits, bitorder="little").tobytes())
    at, offsets = 8 + 8 * len(groups), []
    for b in bodies:
        offsets.append(at)
        at += len(b)
    return struct.pack("<II", _PLAIN, len(groups)) + heads + struct.pack(f"<{len(offsets)}I", *offsets) + b"".join(bodies)


def _loaded32(raw: memoryview) -> tuple[np.ndarray, int]:
    """Values of a 32-bit bitmap and its size in bytes."""
    cookie = struct.unpack_from("<I", raw)[0]
    if cookie & 0xFFFF == _RUNS:
        n, at = (cookie >> 16) + 1, 4
        flags = np.unpackbits(np.frombuffer(raw[at : at + (n + 7) // 8], np.uint8), bitorder="little")[:n]
        at += (n + 7) // 8
    elif cookie == _PLAIN:
        n, at, flags = struct.unpack_from("<I", raw, 4)[0], 8, None
    else:
        raise ValueError("no Roaring bitmap")
    heads = np.frombuffer(raw[at : at + 4 * n], "<u2").reshape(n, 2)
    at += 4 * n
    if flags is None or n >= 4:
        at += 4 * n  # offsets; groups follow one another
    out = []
    for i in range(n):
        size = int(heads[i, 1]) + 1
        if flags is not None and flags[i]:
            runs = struct.unpack_from("<H", raw, at)[0]
            pairs = np.frombuffer(raw[at + 2 : at + 2 + 4 * runs], "<u2").reshape(runs, 2).astype(np.int64)
            low = np.concatenate([np.arange(a, a + k + 1) for a, k in pairs]) if runs else np.zeros(0, np.int64)
            at += 2 + 4 * runs
        elif size <= _ARRAY_MOST:
            low = np.frombuffer(raw[at : at + 2 * size], "<u2").astype(np.int64)
            at += 2 * size
        else:
            low = np.flatnonzero(np.unpackbits(np.frombuffer(raw[at : at + 8192], np.uint8), bitorder="little"))
            at += 8192
        out.append(low + (int(heads[i, 0]) << 16))
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), at


def dump(positions: np.ndarray) -> bytes:
    """A vector of positions (any order, repeats count once)."""
    p = np.unique(np.asarray(positions, np.int64))
    if len(p) and p[0] < 0:
        raise ValueError("a position cannot be negative")
    keys, starts = np.unique(p >> 32, return_index=True)
    parts = [struct.pack("<Q", len(keys))]
    for k, g in zip(keys, np.split(p, starts[1:]) if len(p) else [], strict=True):
        parts += [struct.pack("<I", int(k)), _dumped32((g & 0xFFFFFFFF).astype(np.uint32))]
    body = MAGIC + b"".join(parts)
    return struct.pack(">I", len(body)) + body + struct.pack(">I", zlib.crc32(body))


def load(raw: bytes) -> np.ndarray:
    """Sorted positions of a vector; an error if it is damaged."""
    view = memoryview(raw)
    if len(view) < 20 or struct.unpack_from(">I", view)[0] != len(view) - 8 or bytes(view[4:8]) != MAGIC:
        raise ValueError("no deletion vector")
    if zlib.crc32(view[4:-4]) != struct.unpack_from(">I", view, len(view) - 4)[0]:
        raise ValueError("a deletion vector is damaged")
    count, at, out = struct.unpack_from("<Q", view, 8)[0], 16, []
    for _ in range(count):
        key = struct.unpack_from("<I", view, at)[0]
        low, size = _loaded32(view[at + 4 : -4])
        out.append(low + (key << 32))
        at += 4 + size
    return np.concatenate(out) if out else np.zeros(0, np.int64)


#: Positions of a file are packed in spans of so many rows, so that no task gets all deletes of a huge file at once.
_SPAN = 1 << 24
#: Positions that leave a worker as one row.
_RUN = 1 << 13


def vectors(rows: DataFrame, path: str, pos: str) -> DataFrame:
    """file_path, cardinality and vector: one for each file and span of its rows.

    Rows are dealt by file and span, sorted and packed as they come: a worker
    gets them batch by batch and keeps the positions of one span, 4 bytes each,
    instead of a frame with all rows of a span and the path in each.
    """

    def packed(key: tuple, kept: list) -> pa.RecordBatch:
        p = np.unique(np.concatenate(kept)).astype(np.int64) + key[1] * _SPAN
        return pa.RecordBatch.from_pydict({"file_path": pa.array([key[0]], pa.string()), "cardinality": pa.array([len(p)], pa.int64()), "vector": pa.array([dump(p)], pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept = None, []
        for b in batches:
            if b.column(1).null_count:
                raise ValueError("a position cannot be null")
            runs, p = pc.run_end_encode(b.column(0)), b.column(1).to_numpy()
            ends = runs.run_ends.to_numpy()
            for name, own in zip(runs.values.to_pylist(), np.split(p, ends[:-1]) if len(p) else [], strict=True):
                for part in np.split(own, np.flatnonzero(np.diff(own // _SPAN)) + 1):
                    if key != (now := (name, int(part[0]) // _SPAN)):
                        if kept:
                            yield packed(key, kept)
                        key, kept = now, []
                    kept.append((part - now[1] * _SPAN).astype(np.uint32))
        if kept:
            yield packed(key, kept)

    given = rows.select(F.col(path).alias("file_path"), F.col(pos).cast("long").alias("pos"))
    dealt = given.repartition("file_path", F.shiftright("pos", _SPAN.bit_length() - 1)).sortWithinPartitions("file_path", "pos")
    return dealt.mapInArrow(pack, "file_path string, cardinality long, vector binary")


def positions(df: DataFrame, vector: str) -> DataFrame:
    """df with a row for each position (pos) of its column vector, which goes. Workers return runs of positions; the other columns are repeated beside them by Spark."""
    names = [c for c in df.columns if c != vector]
    at = df.columns.index(vector)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                p = load(b.column(at)[i].as_py())
                same = [b.column(n).slice(i, 1) for n in range(b.num_columns) if n != at]
                for k in range(0, len(p), _RUN):
                    part = pa.array(p[k : k + _RUN], pa.int64())
                    yield pa.RecordBatch.from_arrays([*same, pa.ListArray.from_arrays([0, len(part)], part)], names=[*names, "pos"])

    kinds = StructType([*[df.schema[n] for n in names], *StructType.fromDDL("pos array<long>").fields])
    return df.mapInArrow(unpack, kinds).withColumn("pos", F.explode("pos"))
