"""Helpers that several operators share."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_MASK = (1 << 64) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, one of this machine if Spark runs on it alone, else an error: executors elsewhere would not see it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tabulon-ckpt-"))
    return named or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df written once to the shared checkpoint folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


class Scratch:
    """Tables of one run, as Parquet in a folder of their own below the shared one; a table goes when the run no longer needs it."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, stage_path(spark, name)
        self.made = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """df, written once and read back: cut from its lineage, of known size and without a partitioning that would bind later joins to it."""
        path, self.made = f"{self.root}/{self.made}", self.made + 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes the files of tables that keep() made; nothing may read them any more."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            p = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            p.getFileSystem(conf).delete(p, True)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for a written table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grown(schema: StructType, ddl: str) -> StructType:
    """schema with further columns; StructType.add would change the frame's own."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def fresh(names: Iterable[str], *wanted: str) -> list[str]:
    """Names for internal columns that no given name equals, in any case."""
    taken, out = {n.lower() for n in names}, []
    for w in wanted:
        while w.lower() in taken:
            w += "_"
        taken.add(w.lower())
        out.append(w)
    return out


def named(names: Iterable[str]) -> list[Column]:
    """Columns of these names, dots and all."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def sheltered(df: DataFrame, needed: Sequence[str], f: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """f(df), for an f that knows only the columns named in needed: all others travel in one struct, where no internal name can clash with theirs. The result has df's columns, then those that f adds."""
    extra = [c for c in df.columns if c not in needed]
    if not extra:
        return f(df)
    out = f(df.select(*[c for c in df.columns if c in needed], F.struct(*[c.alias(n) for c, n in zip(named(extra), extra, strict=True)]).alias("_sheltered")))
    return out.select(*[F.col(c) if c in needed else F.col("_sheltered").getField(c).alias(c) for c in df.columns if c not in needed or c in out.columns], *[c for c in out.columns if c not in needed and c != "_sheltered"])


#: Most buckets of a bitmap of ids: so many bits are broadcast at most (16 MB as rows of 64 bits).
_BITMAP_MOST = 1 << 26


def in_bitmap(df: DataFrame, key: str, ids: DataFrame, count: int, flag: str) -> DataFrame:
    """df with flag: false where column key is surely none of ids (one long column, about count rows).

    A bitmap of the ids' hash buckets, eight or more buckets an id up to a
    fixed number of bits, is broadcast; so rows that no join can want stay out
    of a shuffle. Past that number of ids more and more rows pass.
    """
    bits = min(_BITMAP_MOST, 1 << max(10, math.ceil(math.log2(8 * max(count, 1)))))
    word, at, mask = fresh([*df.columns, flag], "_word", "_at", "_mask")
    of = lambda c: F.pmod(F.xxhash64(F.lit(9), c), F.lit(bits))
    one = F.expr("1L")
    bitmap = ids.select(of(F.col(ids.columns[0])).alias("b")).groupBy(F.shiftright("b", 6).alias(word)).agg(F.bit_or(F.call_function("shiftleft", one, F.col("b").bitwiseAND(F.lit(63)).cast("int"))).alias(mask))
    out = df.withColumn(at, of(F.col(key)))
    out = out.join(F.broadcast(bitmap), F.shiftright(F.col(at), 6) == F.col(word), "left")
    hit = F.call_function("shiftrightunsigned", F.coalesce(F.col(mask), F.lit(0).cast("long")), F.col(at).bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return out.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(word, at, mask)


def no_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.regexp_count(no_null(text), F.lit(WORD)).cast("long")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def permuted(df: DataFrame, x: str, n: str, key: Column, out: str, seed: int, rounds: int = 8, inverse: bool = False) -> DataFrame:
    """Adds out: a pseudorandom permutation of 0..n-1 (column n) applied to column x.

    A swap-or-not shuffle: in each round x is paired with K - x mod n, and a
    hash of the larger of the pair says whether the two swap. Each round is its
    own inverse, so the inverse runs the rounds backwards. It works for any n
    without walking cycles. key separates permutations of equal n.
    """
    size = F.col(n)

    def turn(now: Column, r: Column) -> Column:
        pair = F.pmod(F.pmod(F.xxhash64(F.lit(seed), r, key), size) - now, size)
        coin = F.xxhash64(F.greatest(now, pair), r + 1000, F.lit(seed), key).bitwiseAND(F.lit(1))
        return F.when(coin == 1, pair).otherwise(now)

    order = range(rounds - 1, -1, -1) if inverse else range(rounds)
    return df.withColumn(out, F.aggregate(F.array(*[F.lit(r) for r in order]), F.col(x), turn))


class WordHash(dict):
    """word (bytes) -> 64-bit hash, remembered; emptied when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as many as were needed so far."""

    base = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 14)
            for name, b in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                f = np.full(size, np.uint64(b))
                f[0] = 1
                setattr(self, name, np.multiply.accumulate(f))
        return self.up, self.down


_POWERS = _Powers()
_LETTER = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_LETTER[65:91] = _LETTER[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER[_SPACE] = 0


def word_hashes(text: str | None) -> np.ndarray:
    """uint64 hash of each word of a text, A-Z as a-z: differences of one running polynomial over its bytes."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64)
    up, down = _POWERS.of(n + 1)
    edge = np.ones(n + 2, bool)
    edge[1:-1] = _SPACE[raw]
    turns = np.flatnonzero(edge[1:] != edge[:-1])
    start, end = turns[::2], turns[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTER[raw] * up[:n], out=sums[1:])
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; quicker than numpy's for short arrays."""
    s = np.sort(x)
    if len(s) < 2:
        return s
    keep = np.ones(len(s), bool)
    np.not_equal(s[1:], s[:-1], out=keep[1:])
    return s[keep]


def among(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each of x is in the sorted array of."""
    if not len(of):
        return np.zeros(len(x), bool)
    return of[np.minimum(np.searchsorted(of, x), len(of) - 1)] == x


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """uint64 hash for each run of k words (hashes); one for the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    size = min(k, n)
    acc = np.full(n - size + 1, np.uint64(n if n < k else k), np.uint64)
    for i in range(size):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + words[i : n - size + 1 + i])
    return acc
