"""Benchmark decontamination by SimHash of item-sized windows.

For each length of benchmark item, windows of that many words of a document
are fingerprinted with 128 bits, from their five-word shingles weighted by how
often they occur. The items' fingerprints lie in an index of eight 16-bit
blocks, each listed under all values within floor(RADIUS / 8) bits: a
fingerprint within RADIUS of an item's must agree with it that closely in one
block, so the index finds all of them. Candidates are then held to the exact
weighted Jaccard similarity. Windows without any shingle of an item of their
length have similarity 0 and are not fingerprinted.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, among, cut, fresh, mix64, named, sheltered, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
BITS, BLOCKS = 128, 8
RADIUS = 31
#: Items of one pass over the documents; above MAX_ITEMS in all, documents are joined with the items that can be in them instead.
ITEMS_PER_PASS = 1000
MAX_ITEMS = 10_000
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall((text or "").lower())


def _bits(hashes: np.ndarray) -> np.ndarray:
    """(n, 128) of 1 and -1."""
    both = np.stack([mix64(hashes), mix64(hashes ^ np.uint64(0xA5A5A5A5DEADBEEF))], axis=1)
    return np.unpackbits(both.view(np.uint8).reshape(len(hashes), 16), axis=1).astype(np.int32) * 2 - 1


def fingerprints(hashes: np.ndarray, width: int) -> np.ndarray:
    """(windows, 8) uint16: SimHash of each run of width shingles."""
    sums = np.zeros((len(hashes) + 1, BITS), np.int32)
    np.cumsum(_bits(hashes), axis=0, out=sums[1:])
    return np.packbits(sums[width:] - sums[:-width] > 0, axis=1).view(np.uint16)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller counts over sum of larger counts."""
    keys, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(where[: len(a)], minlength=len(keys)), np.bincount(where[len(a) :], minlength=len(keys))
    return float(np.minimum(x, y).sum() / max(1, np.maximum(x, y).sum()))


def _near(radius: int) -> np.ndarray:
    return np.array([sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(16), r)], np.uint32)


class Index:
    """Fingerprints of some benchmark items, by length in words."""

    def __init__(self, items: list[tuple[int | None, str | None]]) -> None:
        self.hash = WordHash()
        self.known: dict[str, int] = {}
        self.by_length: dict[int, list[tuple[int | None, np.ndarray]]] = defaultdict(list)
        for key, text in items:
            if words := words_of(text):
                self.known.update((w, self.hash[w.encode()]) for w in words)
                self.by_length[len(words)].append((key, self.shingles(words)))
        self.vocabulary = {n: np.unique(np.concatenate([s for _, s in own])) for n, own in self.by_length.items()}
        self.all = np.unique(np.concatenate([*self.vocabulary.values(), np.zeros(0, np.uint64)]))
        self.prints: dict[int, np.ndarray] = {}
        self.table: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        near = _near(RADIUS // BLOCKS)
        for n, own in self.by_length.items():
            p = np.concatenate([fingerprints(s, len(s)) for _, s in own])
            block = np.arange(BLOCKS, dtype=np.uint32)[None, :, None]
            codes = ((p.astype(np.uint32)[:, :, None] ^ near[None, None, :]) | (block << np.uint32(16))).reshape(len(own), -1)
            owner = np.repeat(np.arange(len(own)), codes.shape[1])
            order = np.argsort(codes.ravel(), kind="stable")
            self.prints[n], self.table[n] = p, (codes.ravel()[order], owner[order])

    def shingles(self, words: list[str]) -> np.ndarray:
        return shingle_hashes(np.fromiter((self.hash[w.encode()] for w in words), np.uint64, len(words)), SHINGLE)

    def candidates(self, n: int, prints: np.ndarray) -> set[tuple[int, int]]:
        """(window, item) within RADIUS bits: one block within RADIUS // BLOCKS, then all bits counted."""
        codes, owner = self.table[n]
        found: set[tuple[int, int]] = set()
        wanted = prints.astype(np.uint32) | (np.arange(BLOCKS, dtype=np.uint32) << np.uint32(16))[None, :]
        low, high = np.searchsorted(codes, wanted, "left"), np.searchsorted(codes, wanted, "right")
        for w, b in zip(*np.nonzero(high > low), strict=True):
            found.update((int(w), int(i)) for i in owner[low[w, b] : high[w, b]])
        return {(w, i) for w, i in found if int(np.bitwise_count(prints[w] ^ self.prints[n][i]).sum()) <= RADIUS}

    def leaks(self, text: str | None) -> list[dict]:
        """Items whose similarity to a window is SIMILARITY or more, each with its best window."""
        words = words_of(text)
        if not words or not self.by_length:
            return []
        if len(words) >= SHINGLE and min(self.by_length) >= SHINGLE:  # most documents end here, by their known words alone
            h = np.fromiter(map(self.known.get, words, repeat(0)), np.uint64, len(words))
            known = h != 0
            runs = known[: len(h) - SHINGLE + 1].copy()
            for i in range(1, SHINGLE):
                runs &= known[i : len(h) - SHINGLE + 1 + i]
            at = np.flatnonzero(runs)
            if not len(at):
                return []
            places = (at[:, None] + np.arange(SHINGLE)[None, :]).ravel()
            if not among(shingle_hashes(h[places], SHINGLE)[::SHINGLE], self.all).any():
                return []
        whole = np.fromiter((self.hash[w.encode()] for w in words), np.uint64, len(words))
        five = shingle_hashes(whole, SHINGLE)
        out = []
        for n, own in sorted(self.by_length.items()):
            size = min(n, len(words))
            hashes = five if size >= SHINGLE else self._short(whole, size)
            width = max(1, size - SHINGLE + 1)
            hits = among(hashes, self.vocabulary[n])
            if not hits.any():
                continue
            total = np.concatenate([[0], np.cumsum(hits)])
            starts = np.flatnonzero(total[width:] > total[:-width])
            best: dict[int, tuple[float, int]] = {}
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                a = int(run[0])
                for w, i in sorted(self.candidates(n, fingerprints(hashes[a : int(run[-1]) + width], width))):
                    s = weighted_jaccard(hashes[a + w : a + w + width], own[i][1])
                    if s >= SIMILARITY - 1e-12 and s > best.get(i, (0.0, 0))[0]:
                        best[i] = (s, a + w)
            out += [{"item_id": own[i][0], "similarity": s, "first_word": at, "words": size} for i, (s, at) in sorted(best.items())]
        return out

    @staticmethod
    def _short(whole: np.ndarray, size: int) -> np.ndarray:
        """One hash for each run of size words, as an item of that length has."""
        return np.concatenate([shingle_hashes(whole[i : i + size], SHINGLE) for i in range(len(whole) - size + 1)])


_LEAK = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("words", pa.int64())]))
_LEAK_SQL = "array<struct<item_id: bigint, similarity: double, first_word: bigint, words: bigint>>"


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", leaks: str = "leaks") -> DataFrame:
    """docs with an array of the benchmark items found in each whole text.

    Null, empty and wordless texts and items have no leaks; an item without an
    id is found under a null id; equal items are found each, repeated rows of
    an item once. A document with fewer words than an item is one window.
    Repeated documents fare alike; empty tables give no leaks. Up to MAX_ITEMS
    items go over the documents in blocks of ITEMS_PER_PASS; more stay in the
    cluster. A column of docs with that name is replaced, others may have any
    names.
    """
    return sheltered(docs.drop(leaks), (text,), lambda d: _with_leaks(d, items, text, leaks))


def _with_leaks(out: DataFrame, items: DataFrame, text: str, leaks: str) -> DataFrame:
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).distinct()
    known = asked.limit(MAX_ITEMS + 1).collect()
    names = out.columns
    at = names.index(text)
    out = out.withColumn(leaks, F.expr(f"cast(array() as {_LEAK_SQL})"))
    if len(known) > MAX_ITEMS:
        return _by_candidates(out, cut(asked), at, leaks)
    known = sorted(((r[0], r[1]) for r in known), key=str)
    schema = out.schema

    def search(block: list) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(block)
            for b in batches:
                found = [old + index.leaks(t.as_py()) for t, old in zip(b.column(at), b.column(len(names)).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(found, _LEAK)], names=b.schema.names)

        return out.mapInArrow(run, schema)

    for k in range(0, len(known), ITEMS_PER_PASS):
        out = search(known[k : k + ITEMS_PER_PASS])
    return out


def _shingled(df: DataFrame, key: str, text: int, needed: bool) -> DataFrame:
    """key and h: the distinct shingles of each text, hashed. needed: only as many of the least hashes as leave fewer than SIMILARITY of all, so that a window that is similar has one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for b in batches:
            rows = []
            for t in b.column(1):
                words = words_of(t.as_py())
                h = np.fromiter((hashes[w.encode()] for w in words), np.uint64, len(words))
                if needed:
                    all_ = np.sort(mix64(shingle_hashes(h, SHINGLE)))
                    rows.append(np.unique(all_[: len(all_) - int(np.ceil(SIMILARITY * len(all_) - 1e-9)) + 1]).view(np.int64))
                else:
                    short = [shingle_hashes(h[i : i + n], SHINGLE) for n in range(1, SHINGLE) for i in range(len(h) - n + 1)]
                    whole = shingle_hashes(h, SHINGLE) if len(h) >= SHINGLE else np.zeros(0, np.uint64)
                    rows.append(np.unique(mix64(np.concatenate([whole, *short]))).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int64()))], names=["key", "hs"])

    return df.select(key, df.columns[text]).mapInArrow(run, "key long, hs array<long>").select("key", F.explode("hs").alias("h"))


def _by_candidates(docs: DataFrame, items: DataFrame, at: int, leaks: str) -> DataFrame:
    """find_leaks for any number of items: a document meets the items that it shares a needed shingle with, found by a join on shingles. Fingerprints and similarity then decide as they do in an index of all items."""
    row, item, found = fresh(docs.columns, "_row", "_item", "_found")
    rows = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    numbered = cut(items.withColumn("n", F.monotonically_increasing_id()))
    # An item's shingles are few and its text is short, so documents' shingles are first held against those that items need at all.
    wanted = _shingled(numbered.select("n", "text"), "n", 1, True)
    pairs = _shingled(rows, row, at, False).alias("d").join(wanted.alias("i"), "h").select(F.col("d.key").alias("d"), F.col("i.key").alias("i")).distinct()
    texts = pairs.join(numbered, F.col("i") == F.col("n")).select("d", F.struct("item_id", "text").alias("e"))
    body = rows.select(F.col(row).alias("r"), F.col(rows.columns[at]).alias("body"))
    # A pair at a time, so that a document's items need not fit into a task.
    kind = f"r long, f {_LEAK_SQL}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [Index([(e["item_id"], e["text"])]).leaks(t) for t, e in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            keep = [i for i, g in enumerate(got) if g]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array([got[i] for i in keep], _LEAK)], names=["r", "f"])

    hits = body.join(texts, F.col("r") == F.col("d")).select("r", "body", "e").mapInArrow(run, kind)
    per = hits.groupBy(F.col("r").alias(item)).agg(F.array_sort(F.flatten(F.collect_list("f"))).alias(found))
    out = rows.join(per, F.col(row) == F.col(item), "left").withColumn(leaks, F.coalesce(found, leaks))
    return out.drop(row, item, found)


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without those that hold a benchmark item, in the same columns, whatever their names; null and empty texts stay."""
    (leaks,) = fresh(docs.columns, "_leaks")
    return find_leaks(docs, items, leaks=leaks).where(F.size(leaks) == 0).select(*named(docs.columns))


def op3(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each document and benchmark item found in it."""
    found = find_leaks(docs.select("doc_id", "text"), items)
    return found.select("doc_id", F.inline("leaks"))
