"""Bounding boxes of shapes in well-known binary form."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _points(raw: memoryview, at: int) -> Iterator[tuple[np.ndarray, int]]:
    """Arrays of points (x and y) of the shape at an offset, with where each array ends."""
    order = "<" if raw[at] == 1 else ">"
    kind = struct.unpack_from(order + "I", raw, at + 1)[0]
    at += 5
    if kind & 0x20000000:  # a reference system's number comes first
        at += 4
    flags, kind = kind & 0xF0000000, kind & 0x0FFFFFFF
    width = 2 + (bool(flags & 0x80000000) or kind // 1000 in (1, 3)) + (bool(flags & 0x40000000) or kind // 1000 in (2, 3))
    shape = kind % 1000

    def run(at: int, n: int) -> tuple[np.ndarray, int]:
        size = 8 * width * n
        return np.frombuffer(raw[at : at + size], order + "f8").reshape(n, width)[:, :2], at + size

    if shape == 1:
        yield run(at, 1)
        return
    n, at = struct.unpack_from(order + "I", raw, at)[0], at + 4
    if shape == 2:
        yield run(at, n)
    elif shape == 3:
        for _ in range(n):
            k = struct.unpack_from(order + "I", raw, at)[0]
            xy, at = run(at + 4, k)
            yield xy, at
        if not n:
            yield np.zeros((0, 2)), at
    elif shape in (4, 5, 6, 7):
        for _ in range(n):
            for xy, at in _points(raw, at):
                yield xy, at
        if not n:
            yield np.zeros((0, 2)), at
    else:
        raise ValueError(f"unknown shape {shape}")


def box_of(raw: bytes | None) -> tuple[float, float, float, float] | None:
    """min x, min y, max x, max y; null for null, empty and unreadable shapes. NaN coordinates (empty points) do not count."""
    if not raw:
        return None
    try:
        xy = np.concatenate([p for p, _ in _points(memoryview(raw), 0)])
    except (struct.error, ValueError, IndexError):
        return None
    xy = xy[~np.isnan(xy).any(axis=1)]
    return (*map(float, xy.min(axis=0)), *map(float, xy.max(axis=0))) if len(xy) else None


def box(c: Column) -> Column:
    """The box of each shape as a struct, an Arrow batch at a time."""

    def boxes(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([box_of(bytes(v)) or (None,) * 4 if v is not None else (None,) * 4 for v in x], columns=["min_x", "min_y", "max_x", "max_y"], dtype="float64")

    return F.pandas_udf(boxes, "min_x double, min_y double, max_x double, max_y double")(c)


def bounds(df: DataFrame, column: str, *by: str) -> DataFrame:
    """The box around all shapes of a column (of each group), by one aggregation with partial boxes."""
    b = df.select(*by, box(F.col(column)).alias("_b"))
    return b.groupBy(*by).agg(F.min("_b.min_x").alias("min_x"), F.min("_b.min_y").alias("min_y"), F.max("_b.max_x").alias("max_x"), F.max("_b.max_y").alias("max_y"))
