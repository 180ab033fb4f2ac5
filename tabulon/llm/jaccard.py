"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets.

Small sets list all their subsets of the one size that a pair of sizes must
share; two sets of these sizes link exactly when they list a common subset, so
those groups need no verification. Large sets are joined by scanning inverted
lists of their prefixes, the few shingles of which any two similar sets must
share one, rare shingles first. The boundary between small and large is the
one of least estimated cost.

Links are found as a spanning structure, not pair by pair: neighbours in a
list (by size) are verified first, and after their components are known, only
sets of different components within a list, if bounds do not rule them out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, among, cut, distinct, fresh, grown, in_bitmap, mix64, named, sheltered, shingle_hashes, word_hashes

SHINGLE = 4
PERCENT = 85
#: Sets above this size are never listed by subsets.
_SMALL_MOST = 24
#: A list entry costs about so many subset rows.
_LIST_COST = 4
#: Shingles in at least _FREQUENT prefixes go last in the common order, the most frequent _FREQUENT_MOST of them at most; the order never changes a result.
_FREQUENT, _FREQUENT_MOST = 2, 1 << 19
#: Rounds of neighbours, each under so many other orders at once, before the sets of different components are compared in full; a round that links fewer than one in _ROUND_YIELD of its pairs is the last. All change cost only.
_ROUNDS, _ORDERS, _ROUND_YIELD = 2, 3, 4
#: Lists of more sets than this are dealt to several tasks when neighbours are sought.
_LONG_LIST = 512
_BIT_WORDS = 8


def needed(n: int, m: int, percent: int = PERCENT) -> int:
    """Smallest intersection at which sets of sizes n and m link."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def partner_sizes(n: int, most: int, percent: int = PERCENT) -> list[int]:
    return [m for m in range(1, most + 1) if needed(n, m, percent) <= min(n, m)]


def boundary(sizes: dict[int, int], percent: int = PERCENT) -> int:
    """The largest small size of least cost, from how many sets have each size up to _SMALL_MOST."""

    def cost(b: int) -> int:
        small = sum(sizes.get(n, 0) * comb(n, needed(n, m, percent)) for n in range(1, b + 1) for m in partner_sizes(n, b, percent))
        return small + _LIST_COST * sum(c * prefix_size(n, percent) for n, c in sizes.items() if n >= large_from(b, percent))

    return min(range(_SMALL_MOST + 1), key=lambda b: (cost(b), b))


def large_from(b: int, percent: int = PERCENT) -> int:
    """Size from which sets are in inverted lists: those of which a set larger than b can be a partner."""
    return -(-percent * (b + 1) // 100)


def set_of(words: np.ndarray, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text (its words' hashes); one hash of the whole sequence if it is shorter."""
    return distinct(shingle_hashes(words, shingle))


def parities(s: np.ndarray, bits: int) -> np.ndarray:
    """Bytes of a sketch: for each of bits places (a power of two), whether an odd number of elements falls there. The bits in which two sketches differ are no more than the elements in which the sets do."""
    odd = np.bincount((mix64(s ^ np.uint64(0x5BD1E995)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch of fewer places, size bytes, of the same set."""
    while len(sketch) > size:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def _fine(s: np.ndarray) -> bytes | None:
    """A sketch of at least a place for each element, where the bit words have fewer."""
    return parities(s, 1 << (len(s) - 1).bit_length()).tobytes() if len(s) > 64 * _BIT_WORDS else None


def _sets(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, key (of equal word sequences; null without words), n, b0.., fine, prefix under the order of hashes."""
    bits = [f"b{i}" for i in range(_BIT_WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, marks, fines, prefixes, ends = [], [], [], [], [], [0]
            for t in b.column(1):
                words = word_hashes(t.as_py())
                s = set_of(words, shingle)
                keys.append(hashlib.md5(words.tobytes()).digest() if len(words) else None)
                sizes.append(len(s))
                marks.append(parities(s, 64 * _BIT_WORDS).view(np.int64))
                fines.append(_fine(s))
                prefixes.append(s[: prefix_size(len(s), percent)] if len(s) else s)
                ends.append(ends[-1] + len(prefixes[-1]))
            marked = np.stack(marks) if marks else np.zeros((0, _BIT_WORDS), np.int64)
            flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64)
            arrays = [b.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), *[pa.array(np.ascontiguousarray(marked[:, i])) for i in range(_BIT_WORDS)], pa.array(fines, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "n", *bits, "fine", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, key binary, n long, {', '.join(f'{x} long' for x in bits)}, fine binary, prefix array<long>")


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent shingles of counts (h, c): all from the least power of two's sixteenth on that leaves _FREQUENT_MOST or fewer."""
    level = F.floor(F.log2("c") * 16).cast("int")
    many = sorted(((r["l"], r["n"]) for r in counts.groupBy(level.alias("l")).agg(F.count("*").alias("n")).collect()), reverse=True)  # a row for each level, at most 16 * 64
    least, total = 16 * 64, 0
    for at, n in many:
        if (total := total + n) > _FREQUENT_MOST:
            break
        least = at
    top = counts.where(level >= least).select("h", F.least("c", F.lit((1 << 31) - 1)).cast("int").alias("c")).toArrow()
    h, c = top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy()
    order = np.argsort(h)
    return h[order], c[order]


def _entries(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], small: int, shingle: int, percent: int) -> DataFrame:
    """doc_id, h, kind: a row for each list that a document is in (kind 0) and each subset that it lists (kind 1 from the smaller of the two sizes that the subset is for, 2 from the larger)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most _FREQUENT_MOST shingles
    start = large_from(small, percent)

    def subsets(s: np.ndarray) -> Iterator[tuple[int, int]]:
        n = len(s)
        mixed = [int(x) for x in mix64(s)]
        for m in partner_sizes(n, small, percent):
            span = 64 * min(n, m) + max(n, m)
            for c in combinations(mixed, needed(n, m, percent)):
                yield (sum(c) * 0x9E3779B97F4A7C15 + span) & ((1 << 64) - 1), 1 if n <= m else 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rank = shared.value
        for b in batches:
            hs, kinds, ends = [], [], [0]
            for t in b.column(1):
                s = set_of(word_hashes(t.as_py()), shingle)
                n, count = len(s), 0
                if n and n <= small:
                    got = list(subsets(s))
                    hs.append(np.array([g[0] for g in got], np.uint64))
                    kinds.append(np.array([g[1] for g in got], np.int8))
                    count += len(got)
                if n >= start and n:
                    p = prefix_size(n, percent)
                    if len(common):
                        late = among(s, common)
                        first = s[~late][:p]
                        if len(first) < p:
                            rest = s[late]
                            first = np.concatenate([first, rest[np.lexsort((rest, rank[np.searchsorted(common, rest)]))][: p - len(first)]])
                    else:
                        first = s[:p]
                    hs.append(first)
                    kinds.append(np.zeros(len(first), np.int8))
                    count += len(first)
                ends.append(ends[-1] + count)
            flat = np.concatenate(hs).view(np.int64) if hs else np.zeros(0, np.int64)
            tags = np.concatenate(kinds) if kinds else np.zeros(0, np.int8)
            pairs = pa.StructArray.from_arrays([pa.array(flat), pa.array(tags)], names=["h", "kind"])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)], names=["doc_id", "e"])

    rows = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "doc_id long, e array<struct<h: long, kind: tinyint>>")
    return rows.select("doc_id", F.inline("e"))


def components(edges: DataFrame) -> DataFrame:
    """node, comp for every node of edges (a, b): comp is the smallest node that it reaches.

    Alternates large-star and small-star steps, each a group-by and a join,
    until every edge leads to a node that leads nowhere; every round is
    written out. Repeated edges between the two steps are harmless: a step
    gives no more rows than it gets edges and nodes.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        ends = now.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(now.select(F.col("b").alias("node"), F.lit(0).alias("up")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("c")).where("up > 1 or up = 1 and c > 1")
        if not ends.agg(F.count("*")).first()[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("_a")).agg(F.least(F.min("b"), F.col("_a")).alias("m"))
        large = both.join(least, F.col("a") == F.col("_a")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where("m < _a").select(F.col("_a").alias("a"), F.col("m").alias("b")))
        down = large.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("m"))
        small = large.join(down, F.col("a") == F.col("_a")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(small.unionByName(down.select(F.col("_a").alias("a"), F.col("m").alias("b"))).distinct())


def _close(x: str, y: str, percent: int) -> F.Column:
    """Whether sizes and bit words leave it possible that rows x and y link."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = sum((F.bit_count(F.col(f"{x}.b{i}").bitwiseXOR(F.col(f"{y}.b{i}"))) for i in range(_BIT_WORDS)), F.lit(0))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (differ * (100 + percent) <= (n + m) * (100 - percent))


def _possible(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes, bit words and fine sketches leave possible. A sketch has an eighth of a byte for each element or less than two, a text about six."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4, 5)], strict=True):
                if x is None or y is None:
                    keep.append(True)
                    continue
                size = min(len(x), len(y))
                differ = int(np.bitwise_count(folded(np.frombuffer(x, np.uint8), size) ^ folded(np.frombuffer(y, np.uint8), size)).sum())
                keep.append(differ * (100 + percent) <= (n + m) * (100 - percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x, y = marks.alias("x"), marks.alias("y")
    near = pairs.join(x, F.col("a") == F.col("x.rep")).join(y, F.col("b") == F.col("y.rep")).where(_close("x", "y", percent))
    return near.select("a", "b", F.col("x.n").alias("n"), F.col("y.n").alias("m"), F.col("x.fine").alias("f"), F.col("y.fine").alias("g")).mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b; a kept table) whose sets link, from the texts of both. A bitmap of the wanted ids spares the shuffles most of the other texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = set_of(word_hashes(x.as_py()), shingle), set_of(word_hashes(y.as_py()), shingle)
                same = int(among(s, t).sum())
                keep.append(same > 0 and 100 * same >= percent * (len(s) + len(t) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both, count = pairs, pairs.count()
    for side, text in (("a", "x"), ("b", "y")):
        own = in_bitmap(docs.where("doc_id is not null").select(F.col("doc_id").alias(f"_{side}"), F.col("text").alias(text)), f"_{side}", pairs.select(side), count, "_in")
        both = both.join(own.where("_in").drop("_in"), F.col(side) == F.col(f"_{side}"))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _neighbours(listed: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of different components that are neighbours in a list (h, rep, comp, m) under one of _ORDERS orders.

    An order is the same in all lists, so that lists of much the same sets give
    the same pairs. Lists of more than _LONG_LIST sets are dealt at random to
    a power of two of chunks, other ones in each order, and only neighbours in
    a chunk meet: no task gets a whole long list.
    """
    order = lambda i: F.xxhash64(F.lit(_ORDERS * turn + i), "rep")
    whole = Window.partitionBy("h")
    short = listed.where(F.col("m") <= _LONG_LIST).withColumns({f"_o{i}": F.lag(F.struct("rep", "comp")).over(whole.orderBy(order(i), "rep")) for i in range(_ORDERS)})
    short = short.select("rep", "comp", F.explode(F.array(*[f"_o{i}" for i in range(_ORDERS)])).alias("o"))
    parts = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("m") / F.lit(float(_LONG_LIST))))).cast("long")
    dealt = F.array(*[F.struct(F.lit(i).alias("i"), order(i).alias("u"), F.pmod(F.xxhash64(F.lit(1000 + _ORDERS * turn + i), "rep"), parts).alias("chunk")) for i in range(_ORDERS)])
    long = listed.where(F.col("m") > _LONG_LIST).select("h", "rep", "comp", F.explode(dealt).alias("d")).select("h", "rep", "comp", "d.*").repartition("h", "i", "chunk")
    long = long.select("rep", "comp", F.lag(F.struct("rep", "comp")).over(Window.partitionBy("h", "i", "chunk").orderBy("u", "rep")).alias("o"))
    return short.unionByName(long).where("o.comp <> comp").select(F.greatest("rep", "o.rep").alias("a"), F.least("rep", "o.rep").alias("b")).distinct()


def _with_comp(listed: DataFrame, known: DataFrame | None) -> DataFrame:
    """listed with comp: that of known (node, comp), else rep itself."""
    if known is None:
        return listed.withColumn("comp", F.col("rep"))
    return listed.join(known, F.col("rep") == F.col("node"), "left").withColumn("comp", F.coalesce("comp", "rep")).drop("node")


def _merged(known: DataFrame, joined: DataFrame) -> DataFrame:
    """node and comp of known after its components have been joined further: joined (node, comp) of components."""
    joined = joined.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
    moved = known.join(joined, F.col("comp") == F.col("_n"), "left").select("node", F.coalesce("_c", "comp").alias("comp"))
    return moved.unionByName(joined.select(F.col("_n").alias("node"), F.col("_c").alias("comp"))).distinct()


def _between(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """links (a, b) between components instead of sets."""
    if known is None:
        return links
    as_comp = known.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
    for side in ("a", "b"):
        links = links.join(as_comp, F.col(side) == F.col("_n"), "left").withColumn(side, F.coalesce("_c", side)).drop("_n", "_c")
    return links


def jaccard_join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of docs (doc_id, text).

    Two documents link when their shingle sets have at least percent / 100 of
    their union in common. component_id is the smallest doc_id reachable. Null
    texts and texts without words have 0 shingles and link with nothing. Rows
    of one doc_id are one document: each row has its own set, and all of them
    one component. A row without a doc_id links only with equal texts, and has
    no component where all of these lack ids too. Repeated rows give repeated
    rows, an empty table none; other columns of docs play no part.

    Links are found between representatives, the smallest id of each class of
    equal word sequences. All that is written in between is deleted again but
    for what the result reads.
    """
    docs = docs.select("doc_id", "text")
    disk = Scratch(docs.sparkSession, "jaccard")
    bits = [f"b{i}" for i in range(_BIT_WORDS)]
    sets = disk.keep(_sets(docs, shingle, percent))
    classes = disk.keep(sets.where("key is not null").groupBy(F.col("key").alias("_key")).agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), *[F.min(x).alias(x) for x in bits], F.min("fine").alias("fine")))
    marks = classes.where("rep is not null").drop("_key")
    ranked = classes.select("_key", "rep")
    member = disk.keep(sets.select("doc_id", "key", "n").join(ranked, F.col("key") == F.col("_key"), "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")))
    sizes = {r["n"]: r["c"] for r in classes.where(f"n between 1 and {_SMALL_MOST}").groupBy("n").agg(F.count("*").alias("c")).collect()}
    small = boundary(sizes, percent)
    counts = disk.keep(sets.select(F.explode("prefix").alias("h")).groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") >= _FREQUENT))
    frequent = _most_frequent(counts)
    disk.drop(sets, counts)

    # Lists of representatives; m, the documents of a list with copies among them, is only to tell long lists.
    entries = disk.keep(_entries(docs, frequent, small, shingle, percent))
    several = entries.groupBy(F.col("h").alias("_h")).agg(F.count("*").alias("m")).where("m > 1")
    reps = marks.select(F.col("rep").alias("_r")).distinct()
    lists = entries.join(disk.keep(several), F.col("h") == F.col("_h")).join(disk.keep(reps), F.col("doc_id") == F.col("_r"))
    lists = disk.keep(lists.select("h", "kind", F.col("doc_id").alias("rep"), "m"))
    disk.drop(entries)

    # A subset that a set of the smaller size lists links all that list it; so does a document with several texts their classes.
    subsets = lists.where("kind > 0")
    heads = disk.keep(subsets.groupBy(F.col("h").alias("_h")).agg(F.min("kind").alias("k"), F.min("rep").alias("b")).where("k = 1").drop("k"))
    sure = subsets.join(heads, F.col("h") == F.col("_h")).where("rep <> b").select(F.col("rep").alias("a"), "b")
    own = member.where("n > 0 and doc_id is not null")
    apart = disk.keep(own.groupBy(F.col("doc_id").alias("_d")).agg(F.min("rep").alias("b"), F.max("rep").alias("_hi")).where("b < _hi").drop("_hi"))
    sure = sure.unionByName(own.join(apart, F.col("doc_id") == F.col("_d")).where("rep <> b").select(F.col("rep").alias("a"), "b"))
    listed, known = lists.where("kind = 0").select("h", "rep", "m"), None
    for turn in range(_ROUNDS):
        pairs = disk.keep(_possible(disk.keep(_neighbours(_with_comp(listed, known), turn)), marks, percent))
        tried = pairs.count()
        links = disk.keep(_verified(pairs, docs, shingle, percent))
        found = links.count()
        if known is None:
            known = disk.keep(components(links.unionByName(sure)))
        elif found:
            known = disk.keep(_merged(known, components(_between(known, links))))
        if found * _ROUND_YIELD < tried or not found:
            break

    # What is left: sets of different components in a list, if bounds leave it possible that they link.
    lists = _with_comp(listed, known)
    mixed = lists.groupBy(F.col("h").alias("_h")).agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo < _hi").select("_h")
    open_ = lists.join(disk.keep(mixed), F.col("h") == F.col("_h"), "left_semi").select("h", "rep", "comp")
    open_ = disk.keep(open_.join(marks.drop("fine").withColumnRenamed("rep", "_r"), F.col("rep") == F.col("_r")).drop("_r"))
    across = (F.col("x.h") == F.col("y.h")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.comp") != F.col("y.comp")) & _close("x", "y", percent)
    rest = disk.keep(open_.alias("x").join(open_.alias("y"), across).select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b")).distinct())
    last = disk.keep(_verified(disk.keep(_possible(rest, marks, percent)), docs, shingle, percent))
    if last.count():
        known = disk.keep(_merged(known, components(_between(known, last))))

    out = member.join(known, F.col("rep") == F.col("node"), "left").withColumn("component_id", F.coalesce("comp", "rep"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _keyed(docs: DataFrame, name: str) -> DataFrame:
    """docs with a hash of the word sequence in column name; null without words."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [word_hashes(t.as_py()) for t in b.column(at)]
            same = [hashlib.md5(w.tobytes()).digest() if len(w) else None for w in words]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(same, pa.binary())], names=[*b.schema.names, name])

    return docs.mapInArrow(run, grown(docs.schema, f"{name} binary"))


def _distinct_rows(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """distinct_documents where ids are missing or repeated: each text of an id is a node of its own, first texts of ids before others."""
    same, a, b = fresh(docs.columns, "_same", "_a", "_b")
    keyed = _keyed(docs, same)
    texts = keyed.where(F.col("doc_id").isNotNull() & F.col(same).isNotNull()).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col(same).alias("_key")).distinct()
    first = texts.groupBy(F.col("_id").alias("_i")).agg(F.min("_text").alias("_first"))
    texts = texts.join(first, F.col("_id") == F.col("_i")).orderBy(F.col("_text") != F.col("_first"), "_id", "_text")
    nodes = cut(texts.select(F.monotonically_increasing_id().alias("_node"), "_id", "_text", "_key"))
    found = jaccard_join(nodes.select(F.col("_node").alias("doc_id"), F.col("_text").alias("text")), shingle, percent)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone"))
    left = cut(nodes.join(gone, F.col("_node") == F.col("_gone"), "left_anti"))
    best = left.groupBy(F.col("_id").alias(a)).agg(F.min("_text").alias(b))
    over = left.join(best, F.col("_id") == F.col(a)).where(F.col("_text") != F.col(b)).select(F.col("_node").alias("_over"))
    held = nodes.join(over, F.col("_node") == F.col("_over"), "left_anti").select(F.col("_key").alias(a)).distinct()
    out = keyed.where(F.col(same).isNull())
    out = out.unionByName(keyed.where(F.col("doc_id").isNotNull() & F.col(same).isNotNull()).join(best, (F.col("doc_id") == F.col(a)) & (F.col("text") == F.col(b)), "left_semi"))
    return out.unionByName(keyed.where(F.col("doc_id").isNull() & F.col(same).isNotNull()).join(held, F.col(same) == F.col(a), "left_anti")).select(*named(docs.columns))


def distinct_documents(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each group of linked ones, that of smallest id, in the same columns.

    Rows without words stay, for they link with nothing; of rows that share a
    doc_id and are no copies of other documents, those with the text that sorts
    first stay. Rows without a doc_id stay unless a row with an id has an equal
    text, other than one left out for a text of its id that sorts first. Other
    columns may have any names; an empty table stays empty.
    """
    return sheltered(docs, ("doc_id", "text"), lambda d: _distinct(d, shingle, percent))


def _distinct(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    if not docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id is null or n > 1").isEmpty():
        return _distinct_rows(docs, shingle, percent)
    found = jaccard_join(docs, shingle, percent)
    gone = Scratch(docs.sparkSession, "copies").keep(found.where("component_id <> doc_id").select(F.col("doc_id").alias("id")))
    maybe, id_ = fresh(docs.columns, "_maybe", "_id")
    marked = in_bitmap(docs, "doc_id", gone, gone.count(), maybe)
    checked = marked.where(F.col(maybe)).join(gone.select(F.col("id").alias(id_)), F.col("doc_id") == F.col(id_), "left_anti")
    return marked.where(~F.col(maybe)).unionByName(checked).select(*named(docs.columns))


def op9(docs: DataFrame) -> DataFrame:
    """jaccard_join with the production parameters."""
    return jaccard_join(docs)
