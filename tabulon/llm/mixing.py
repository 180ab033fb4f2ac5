"""Mixing sources to target weights (DataFrame functions only).

The words of each source are laid end to end and cut into blocks of a fixed
number of words. Every output shard has the same number of slots; the slots of
all shards are dealt to sources at random, with the total of each source held
to its quota: multinomial counts per shard, conditioned on the totals. Without
that condition a source at its limit would pass it in half of all draws. A
slot's index within its source goes through a pseudorandom permutation of the
source's blocks, and blocks are joined by that index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, no_null, permuted, sheltered, word_count

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 64
SLOTS_PER_SHARD = 4096
SEED = 20
_ROWS_PER_BUCKET = 250
_BUCKETS_PER_GROUP = 1024
_CHUNK = 512


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = TOTAL_SHARE, most: float = MOST_REPEATS) -> DataFrame:
    """sizes (source, source_size) with sid, weight and target.

    Sources by code point, null last, take the weights in turn. A target is
    the smaller of most * size and weight * level, where level is the one at
    which all targets add up to share * total: what sharing the excess by
    weight, again and again, ends at. One row per source is all that the
    global windows see.
    """
    every, by_ratio = Window.partitionBy(), Window.orderBy("_ratio", "sid")
    out = (
        sizes.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_full", F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cap"))
        .withColumn("_rest", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_total", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("_level", (F.col("_total") - F.col("_full")) / F.col("_rest"))
        .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(every))
    )
    target = F.least(F.col("_cap"), F.coalesce(F.col("weight") * F.col("_level"), F.col("_cap")))
    return out.select("source", "source_size", "sid", "weight", target.alias("target"))


def layout(docs: DataFrame, carry: Sequence[str] = (), block_words: int = BLOCK_WORDS, seed: int = SEED, **how) -> DataFrame:
    """Each document with its size in words and its start in its source's stream.

    Columns: doc_id, source, tie (a hash of the text), size, start, sid,
    source_size, target, blocks (of its source), quota (blocks that the mix
    takes from the source), before (quotas of earlier sources), slots (all
    quotas), and those named in carry, with _c_ before their names.
    A source's rows are dealt to hash buckets, so that its running sum is not
    made in one task: within buckets by window, across them over bucket sums.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _tie_of(F.col("text")).alias("_tie"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    buckets = max(1, -(-docs.count() // _ROWS_PER_BUCKET))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_tie"), F.lit(buckets)))
    if not carry:
        rows = cut(rows)
    sums = cut(rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum")))
    plan = source_targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), **how)
    plan = plan.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block_words)).cast("long"))
    plan = plan.withColumn("quota", F.coalesce(F.round(F.col("target") * F.col("blocks") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0)).cast("long"))
    running = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    plan = plan.withColumn("before", F.sum("quota").over(running) - F.col("quota")).withColumn("slots", F.sum("quota").over(Window.partitionBy()))
    offsets = sums.withColumnRenamed("source", "_source").withColumnRenamed("_bucket", "_b")
    # In two levels, so that a source's bucket sums are not all in one task either: within groups of buckets, and across them over group sums.
    offsets = offsets.withColumn("_g", F.expr(f"_b div {_BUCKETS_PER_GROUP}"))
    groups = offsets.groupBy("_source", "_g").agg(F.sum("_sum").alias("_all"))
    groups = groups.withColumn("_ahead", F.sum("_all").over(Window.partitionBy("_source").orderBy("_g").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_all"))
    groups = groups.select(F.col("_source").alias("_gs"), F.col("_g").alias("_gg"), "_ahead")
    inner = F.sum("_sum").over(Window.partitionBy("_source", "_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_sum")
    offsets = offsets.withColumn("_inner", inner).join(groups, F.col("_source").eqNullSafe(F.col("_gs")) & (F.col("_g") == F.col("_gg")))
    offsets = offsets.withColumn("_offset", F.col("_ahead") + F.col("_inner")).drop("_g", "_gs", "_gg", "_ahead", "_inner")
    offsets = offsets.join(plan, F.col("_source").eqNullSafe(F.col("source"))).drop("source", "weight", "_sum")
    out = rows.join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_b")))
    within = Window.partitionBy("sid", "_bucket").orderBy("doc_id", "_tie", "size").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("start", F.col("_offset") + F.sum("size").over(within) - F.col("size"))
    return out.select("doc_id", "source", F.col("_tie").alias("tie"), "size", "start", "sid", "source_size", "target", "blocks", "quota", "before", "slots", *[f"_c_{c}" for c in carry])


def slots(placed: DataFrame, slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """Every slot of the mix: shard, slot (in its shard), sid, block, turn (0 for a block's first use)."""
    per = placed.groupBy("sid").agg(*[F.first(c).alias(c) for c in ("blocks", "quota", "before", "slots")]).where("quota > 0")
    chunks = per.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(quota - 1) div {_CHUNK}"))))
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    j = F.explode(F.sequence(F.col("_chunk") * _CHUNK, F.least(F.col("quota"), (F.col("_chunk") + 1) * _CHUNK) - 1))
    out = chunks.repartition(parts, "sid", "_chunk").withColumn("_j", j).withColumn("_u", F.col("before") + F.col("_j")).withColumn("_i", F.col("_j") % F.col("blocks"))
    out = permuted(out, "_u", "slots", F.lit(-1), "_t", seed, inverse=True)
    out = permuted(out, "_i", "blocks", F.col("sid"), "block", seed + 1)
    return out.select(F.expr(f"_t div {slots_per_shard}").alias("shard"), (F.col("_t") % slots_per_shard).alias("slot"), "sid", "block", F.expr("_j div blocks").alias("turn"))


def pieces(placed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The part of each document that lies in each block: sid, block, start (names the document in its source), first (its first word there), words."""
    size = F.lit(block_words)
    own = placed.where("size > 0").select("sid", "start", "size", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * size)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * size)
    return own.select("sid", "block", "start", (low - F.col("start")).alias("first"), (high - low).alias("words"))


def mix(placed: DataFrame, block_words: int = BLOCK_WORDS, slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """The mixed corpus: one row for each piece of each slot's block.

    Columns: shard, slot, turn, sid, block, start, first, words. A document is
    named by (sid, start). Null texts and texts without words have no pieces;
    an empty table gives no rows; repeated rows lie one after the other.
    """
    # Slots are exploded after a shuffle of few rows, from whose size Spark would take them for a table to broadcast.
    return slots(placed, slots_per_shard, seed).hint("merge").join(pieces(placed, block_words).hint("merge"), ["sid", "block"])


def taken_words(placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """placed with taken: the words that the mix takes of each document, repeats counted."""
    taken = mixed.groupBy(F.col("sid").alias("_sid"), F.col("start").alias("_start")).agg(F.sum("words").alias("_taken"))
    got = F.when(F.col("size") > 0, F.coalesce(F.col("_taken"), F.lit(0))).otherwise(F.lit(0)).cast("long")
    return placed.join(taken, (F.col("sid") == F.col("_sid")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0), "left").withColumn("taken", got).drop("_sid", "_start", "_taken")


def op1(docs: DataFrame) -> DataFrame:
    """Every row with its size, its source's size and target, and the words that the mix takes of it.

    Null and empty texts have no words and give none; null sources are a source
    of their own, the last; rows that repeat lie one after the other and are
    taken each; an empty table gives no rows.
    """
    placed = cut(layout(docs))
    return taken_words(placed, mix(placed)).select("doc_id", "size", "source_size", "target", "taken", "source")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """docs as the mix leaves them, in the columns of docs, whatever their names.

    One row for each document and turn (first use, repeat) with any block
    taken: its text is those blocks' words, in their order, with single
    spaces; a document all of whose words are taken keeps its text as it is.
    Documents without words (null and empty texts too) have nothing to mix and
    go; repeated rows are mixed each; an empty table stays empty.
    """
    # Where id and text tell rows apart, texts are shuffled once, to the blocks taken of them; else they go with the layout.
    apart = docs.groupBy("doc_id", _tie_of(F.col("text")).alias("t")).agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    return sheltered(docs, ("doc_id", "source", "text", "n_chars"), _mixed_by_key if apart else _mixed_by_row)


def _tie_of(text: Column) -> Column:
    return F.xxhash64(no_null(text))


def _parts(placed: DataFrame) -> DataFrame:
    """_sid, _start, turn, _parts (first word and number of words of each piece taken) and _n (words)."""
    got = mix(placed).groupBy(F.col("sid").alias("_sid"), F.col("start").alias("_start"), "turn")
    return got.agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("_parts"), F.sum("words").alias("_n"))


def _taken_text(text: str, size: str) -> tuple[Column, Column]:
    """Column _w, the text's words where not all are taken, and the text that the mix takes."""
    words = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    some = F.concat_ws(" ", F.flatten(F.transform("_parts", lambda p: F.slice(F.col("_w"), (p["first"] + 1).cast("int"), p["words"].cast("int")))))
    return F.when(F.col("_n") < F.col(size), words), F.when(F.col("_n") < F.col(size), some).otherwise(F.col(text))


def _mixed_by_key(docs: DataFrame) -> DataFrame:
    placed = cut(layout(docs))
    own = placed.where("size > 0").select("sid", "start", "size", F.col("doc_id").alias("_id"), F.col("tie").alias("_t"))
    taken = own.join(_parts(placed), (F.col("sid") == F.col("_sid")) & (F.col("start") == F.col("_start"))).select("_id", "_t", "size", "_parts", "_n")
    # Pieces are far smaller than texts, but Spark would take them for as large as the blocks that they come from.
    out = docs.withColumn("_tie", _tie_of(F.col("text"))).join(taken.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_t")))
    words, text = _taken_text("text", "size")
    out = out.withColumn("_w", words).withColumn("text", text)
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in docs.columns])


def _mixed_by_row(docs: DataFrame) -> DataFrame:
    names = docs.columns
    placed = cut(layout(docs, carry=[c for c in names if c not in ("doc_id", "source")]))
    out = placed.where("size > 0").join(_parts(placed), (F.col("sid") == F.col("_sid")) & (F.col("start") == F.col("_start")))
    words, text = _taken_text("_c_text", "size")
    out = out.withColumn("_w", words).withColumn("_c_text", text)
    own = {"n_chars": F.length("_c_text").cast("long")}
    return out.select(*[own.get(c, F.col(c if c in ("doc_id", "source") else f"_c_{c}")).alias(c) for c in names])
