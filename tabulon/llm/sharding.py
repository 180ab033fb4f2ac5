"""Sharding by sampled splitters (DataFrame functions only).

Records are ordered by a hash of their text, then by a hash of their id, so
that equal texts lie together. A size-weighted sample of the keys gives the
quantile boundaries of many more ranges than shards; ranges that come out
overfull (one text with very many copies) are subdivided by the second hash.
The exact bytes of every range then decide which shard takes it, largest range
first. Boundaries and range totals are bounded by parameters, whatever the
input; only they reach the driver.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, no_null, sheltered

SHARDS = 40
RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 8
#: A range of over two such parts of a shard is overfull.
PARTS_PER_SHARD = 8
_PREFIX_BITS = 12


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_size", F.octet_length(no_null(F.col("text"))).cast("long") + 16).withColumn("_h1", F.xxhash64(no_null(F.col("text")))).withColumn("_h2", F.xxhash64(F.lit(7), "doc_id"))


def splitters(keys: DataFrame, total: int, ranges: int, samples: int = SAMPLES_PER_RANGE) -> list[int]:
    """Quantile boundaries of _h1 by bytes, from about ranges * samples sampled keys.

    A row is drawn as often as its share of the bytes says: the whole part of
    that, and once more with the rest as chance, by a hash of its key.
    """
    u = F.pmod(F.xxhash64(F.lit(11), "_h1", "_h2"), F.lit(1 << 30)) / float(1 << 30)
    draws = F.floor(F.col("_size") * F.lit(float(ranges * samples)) / F.lit(float(max(total, 1))) + u)
    drawn = sorted((r[0], r[1]) for r in keys.select("_h1", draws.alias("n")).where("n > 0").groupBy("_h1").agg(F.sum("n")).collect())
    out, seen = [], 0
    for h, n in drawn:
        if n >= 2 * samples:  # a hot key gets a range of its own
            out.append(h - 1)
        if (seen + n) // samples > seen // samples:
            out.append(h)
        seen += n
    return sorted({b for b in out if b >= -(1 << 63)})


def _ranged(keyed: DataFrame, bounds: list[int]) -> DataFrame:
    """Adds _cell, the number of boundaries at or below _h1, through a broadcast join of intervals by the key's leading bits."""
    spark, shift, low, high = keyed.sparkSession, 64 - _PREFIX_BITS, -(1 << 63), (1 << 63) - 1
    edges = [low, *[b + 1 for b in bounds if b < high]]
    spans = [(p, i, a, b) for i, (a, b) in enumerate(zip(edges, [*[e - 1 for e in edges[1:]], high], strict=True)) for p in range(a >> shift, (b >> shift) + 1)]
    table = spark.createDataFrame(spans, "_p long, _cell long, _low long, _high long")
    return keyed.join(F.broadcast(table), (F.shiftright("_h1", shift) == F.col("_p")) & (F.col("_h1") >= F.col("_low")) & (F.col("_h1") <= F.col("_high"))).drop("_p", "_low", "_high")


def _sub(parts: F.Column) -> F.Column:
    """Which of so many equal spans of the second hash a row is in."""
    return F.when(parts > 1, F.floor((F.pmod(F.shiftright("_h2", 1), F.lit(1 << 52)) / float(1 << 52)) * parts)).otherwise(F.lit(0)).cast("long")


def deal(cells: list[tuple[int, int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """(cell, sub, shard, first slot) for (cell, sub, bytes, rows): the largest goes to the emptiest shard."""
    load = [(0, s) for s in range(shards)]
    where = {}
    for cell, sub, size, _ in sorted(cells, key=lambda c: (-c[2], c[0], c[1])):
        least, s = load[0]
        where[cell, sub] = s
        heapq.heapreplace(load, (least + size, s))
    used, out = [0] * shards, []
    for cell, sub, _, rows in sorted(cells):
        s = where[cell, sub]
        out.append((cell, sub, s, used[s]))
        used[s] += rows
    return out


def shard(docs: DataFrame, shards: int = SHARDS, ranges_per_shard: int = RANGES_PER_SHARD) -> DataFrame:
    """docs with size, shard and slot.

    Shards are nearly equal in bytes (of text, 16 more for each row) and slots
    have no gaps. Null text counts as empty, null ids sort first, repeated
    rows are rows of their own; an empty table stays empty. Columns of docs
    named size, shard or slot are replaced, others may have any names. Equal
    texts are in one shard, except where their range is overfull; rows equal in
    both id and text always are.
    """
    return sheltered(docs.drop("size", "shard", "slot"), ("doc_id", "text"), lambda d: _sharded(d, shards, ranges_per_shard))


def _sharded(docs: DataFrame, shards: int, ranges_per_shard: int) -> DataFrame:
    keyed = _keyed(docs)
    keys = cut(keyed.select("_h1", "_h2", "_size"))
    total = keys.agg(F.sum("_size")).collect()[0][0] or 0
    ranges = shards * ranges_per_shard
    bounds = splitters(keys, total, ranges)
    placed = _ranged(keys, bounds)
    sums = placed.groupBy("_cell").agg(F.sum("_size").alias("b"), F.count("*").alias("n")).collect()
    limit = max(1, total // (shards * PARTS_PER_SHARD))
    heavy = {r["_cell"]: -(-r["b"] // limit) for r in sums if r["b"] > 2 * limit and r["n"] > 1}
    spark = docs.sparkSession
    cells = [(r["_cell"], 0, r["b"], r["n"]) for r in sums if r["_cell"] not in heavy]
    parts = F.broadcast(spark.createDataFrame([*heavy.items()], "_cell long, _parts long"))
    if heavy:
        split = placed.join(parts, "_cell").withColumn("_sub", _sub(F.col("_parts")))
        cells += [tuple(r) for r in split.groupBy("_cell", "_sub").agg(F.sum("_size"), F.count("*")).collect()]
    dealt = F.broadcast(spark.createDataFrame(deal(cells, shards), "_cell long, _sub long, shard int, _first long"))
    out = _ranged(keyed, bounds).join(parts, "_cell", "left").withColumn("_sub", _sub(F.coalesce("_parts", F.lit(1)))).join(dealt, ["_cell", "_sub"])
    row = F.row_number().over(Window.partitionBy("_cell", "_sub").orderBy("_h1", "_h2", "doc_id", "_size"))
    return out.withColumn("slot", F.col("_first") + row - 1).withColumn("size", F.col("_size")).select(*docs.columns, "size", "shard", "slot")


def op10(docs: DataFrame) -> DataFrame:
    """Every row with its shard and slot; a null text has no bytes and a row of it 16."""
    out = shard(docs.select("doc_id", "text", F.crc32(F.encode(no_null(F.col("text")), "UTF-8")).alias("text_crc32")))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
