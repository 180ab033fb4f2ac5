"""Partition transforms as Column expressions, and their values for single literals.

Nothing here depends on the session's time zone: instants are taken as UTC
microseconds, dates and local times by their calendar fields.
"""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, DateType, DecimalType, IntegerType, StringType, TimestampNTZType, TimestampType

#: hash() of this int under Spark's own seed is 0, so that hash(it, x) hashes x with seed 0.
_SEED_ZERO = -1693959553
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_TIMES = ("date", "timestamp", "timestamp_ntz")
_HOUR = 3_600_000_000
_EPOCH = dt.datetime(1970, 1, 1)


def murmur3(values: list[bytes]) -> np.ndarray:
    """32-bit Murmur3 (x86, seed 0) of each value: all values at once, four bytes a step."""
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    starts = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(values) + bytes(4), np.uint8).astype(np.uint32)
    h = np.zeros(len(values), np.uint32)
    turn = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    scramble = lambda k: turn(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
    word = lambda at: flat[at] | flat[at + 1] << np.uint32(8) | flat[at + 2] << np.uint32(16) | flat[at + 3] << np.uint32(24)
    with np.errstate(over="ignore"):
        for i in range(int(sizes.max(initial=0)) // 4):
            rows = np.flatnonzero(sizes >= 4 * i + 4)
            h[rows] = turn(h[rows] ^ scramble(word(starts[rows] + 4 * i)), 13) * np.uint32(5) + np.uint32(0xE6546B64)
        if rest := np.flatnonzero(sizes % 4).tolist():
            left = sizes[rest] % 4
            h[rest] ^= scramble(word(starts[rest] + sizes[rest] - left) & ((np.uint32(1) << (left * 8).astype(np.uint32)) - np.uint32(1)))
        h ^= sizes.astype(np.uint32)
        h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
        h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return h ^ h >> np.uint32(16)


def unscaled(v: Decimal) -> int:
    """The digits of a decimal as an integer, exact for any precision."""
    sign, digits, _ = v.as_tuple()
    n = int("".join(map(str, digits)) or "0")
    return -n if sign else n


def _packed(n: int) -> bytes:
    """Shortest big-endian two's complement."""
    return n.to_bytes((n + (n < 0)).bit_length() // 8 + 1, "big", signed=True)


def _bytes_hash(x: pd.Series) -> pd.Series:
    given = x.notna().to_numpy()
    out = pd.Series(pd.array([pd.NA] * len(x), dtype="Int64"))
    out[given] = (murmur3([bytes(v) for v in x[given]]) & np.uint32(0x7FFFFFFF)).astype(np.int64)
    return out


def _decimal_hash(x: pd.Series) -> pd.Series:
    return _bytes_hash(pd.Series([None if v is None else _packed(unscaled(v)) for v in x], dtype=object))


def _unit(c: Column, kind: DataType, per: int) -> Column:
    """Whole days (per 24) or hours (per 1) since 1970 of a date or time."""
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("long") * F.lit(24 // per)
    if isinstance(kind, TimestampNTZType):
        day = F.unix_date(c.cast("date")).cast("long")
        return day if per == 24 else day * 24 + F.hour(c)
    return F.call_function("div", F.unix_micros(c) - F.pmod(F.unix_micros(c), F.lit(_HOUR * per)), F.lit(_HOUR * per).cast("long"))


def micros(c: Column, kind: DataType) -> Column:
    """Microseconds since 1970 of a time; a local time counts as UTC."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(c)
    second = (F.extract(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long")
    return _unit(c, kind, 1) * F.lit(_HOUR) + F.minute(c).cast("long") * F.lit(60_000_000) + second


def bucket(n: int, c: Column, kind: DataType) -> Column:
    """(murmur3 & 0x7fffffff) % n of whole numbers, decimals, dates, times, strings and bytes. Numbers, dates and times are hashed as 8-byte longs in the JVM; strings, bytes and decimals need Python."""
    if n <= 0:
        raise ValueError("a bucket count must be positive")
    name = kind.simpleString()
    if isinstance(kind, (StringType, BinaryType)):
        return (F.pandas_udf(_bytes_hash, "long")(c.cast("binary")) % n).cast("int")
    if isinstance(kind, DecimalType):
        return (F.pandas_udf(_decimal_hash, "long")(c) % n).cast("int")
    if name not in _WHOLE + _TIMES:
        raise ValueError(f"no buckets of {name}")
    as_long = F.unix_date(c).cast("long") if name == "date" else micros(c, kind) if name in _TIMES else c.cast("long")
    return F.when(c.isNotNull(), F.hash(F.lit(_SEED_ZERO), as_long).bitwiseAND(F.lit(0x7FFFFFFF)) % n).cast("int")


def truncate(width: int, c: Column, kind: DataType) -> Column:
    """Whole numbers down to a multiple of width (decimals by their digits as an integer); the first width characters or bytes."""
    if width <= 0:
        raise ValueError("a width must be positive")
    if isinstance(kind, (StringType, BinaryType)):
        return F.substring(c, 1, width)
    if isinstance(kind, DecimalType):
        step = F.lit(Decimal((0, tuple(map(int, str(width))), -kind.scale)))
        return (c - F.pmod(c, step)).cast(kind)
    if kind.simpleString() not in _WHOLE:
        raise ValueError(f"no truncation of {kind.simpleString()}")
    return (c - F.pmod(c, F.lit(width))).cast(kind)


def apply(transform: str, c: Column, kind: DataType) -> Column:
    """A transform by its text form: identity, void, year, month, day, hour, bucket[N] or truncate[W]."""
    name, arg = parse(transform)
    if name == "identity":
        return c
    if name == "void":
        return F.lit(None).cast(kind)
    if name == "bucket":
        return bucket(arg, c, kind)
    if name == "truncate":
        return truncate(arg, c, kind)
    if name not in ("year", "month", "day", "hour"):
        raise ValueError(f"unknown transform {transform!r} cannot be evaluated")
    if kind.simpleString() not in _TIMES or name == "hour" and isinstance(kind, DateType):
        raise ValueError(f"no {name} of {kind.simpleString()}")
    if name == "hour":
        return _unit(c, kind, 1).cast("int")
    day = F.date_from_unix_date(_unit(c, kind, 24).cast("int"))
    return {"day": day, "year": F.year(day) - 1970, "month": (F.year(day) - 1970) * 12 + F.month(day) - 1}[name]


def result_type(transform: str, kind: DataType) -> DataType:
    name, _ = parse(transform)
    return kind if name in ("identity", "truncate", "void") else DateType() if name == "day" else StringType() if name not in ("bucket", "year", "month", "hour") else IntegerType()


def keeps_order(transform: str) -> bool:
    return parse(transform)[0] in ("identity", "truncate", "year", "month", "day", "hour")


def value_of(transform: str, v: Any, kind: DataType) -> Any:
    """The transform of one Python value, equal to what apply() gives for a row."""
    name, arg = parse(transform)
    if v is None or name == "void":
        return None
    if name == "identity":
        return v
    if name == "truncate":
        if isinstance(kind, DecimalType):
            n = unscaled(v.quantize(Decimal((0, (1,), -kind.scale))))
            n -= n % arg
            return Decimal((int(n < 0), tuple(map(int, str(abs(n)))), -kind.scale))
        return v[:arg] if isinstance(v, (str, bytes)) else v - v % arg
    if name == "bucket":
        if isinstance(kind, (StringType, BinaryType)):
            raw = v.encode() if isinstance(v, str) else bytes(v)
        elif isinstance(kind, DecimalType):
            raw = _packed(unscaled(v.quantize(Decimal((0, (1,), -kind.scale)))))
        else:
            n = int(v) if not isinstance(v, dt.date) else (_naive(v) - _EPOCH) // dt.timedelta(microseconds=1) if isinstance(v, dt.datetime) else (v - _EPOCH.date()).days
            raw = n.to_bytes(8, "little", signed=True)
        return int(murmur3([raw])[0] & 0x7FFFFFFF) % arg
    day = _naive(v).date() if isinstance(v, dt.datetime) else v
    if name == "hour":
        return (_naive(v) - _EPOCH) // dt.timedelta(hours=1)
    return {"day": day, "year": day.year - 1970, "month": (day.year - 1970) * 12 + day.month - 1}[name]


def _naive(v: dt.datetime) -> dt.datetime:
    return v.astimezone(dt.UTC).replace(tzinfo=None) if v.tzinfo else v


def readable(transform: str, v: Any) -> str:
    """A partition value as people write it: years, months, days and hours as dates, null as null, bytes as base 64."""
    import base64

    name, _ = parse(transform)
    if v is None:
        return "null"
    if name == "year":
        return f"{1970 + v:04d}"
    if name == "month":
        return f"{1970 + v // 12:04d}-{v % 12 + 1:02d}"
    if name == "hour":
        return (_EPOCH + dt.timedelta(hours=v)).strftime("%Y-%m-%d-%H")
    if isinstance(v, bool):
        return str(v).lower()
    return base64.b64encode(v).decode() if isinstance(v, bytes) else v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else str(v)


def parse(transform: str) -> tuple[str, int | None]:
    m = re.fullmatch(r"\s*([a-z]+)\s*(?:\[\s*(\d+)\s*\])?\s*", transform.lower())
    if not m or (m[1] in ("bucket", "truncate")) != (m[2] is not None):
        raise ValueError(f"not a transform: {transform!r}")
    return m[1], int(m[2]) if m[2] else None
