"""Toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digit substitutions) and searched with an
Aho-Corasick automaton for lexicon entries at the start of words. Matches that
lie within an exception phrase do not count. The sum of weights, normalised by
the text's length, goes through a logistic curve. Lexicon, weights and curve
are learned from labelled rows.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold_of, fresh, grown, mix64, named, sheltered, shingle_hashes, word_hashes

#: Letters of other scripts that look like Latin ones, and symbols that stand for letters.
HOMOGLYPHS = "аaеeоoрpсcхxуyіiјjѕsԁdһhвbмmтtкkнhαaοoνvρpιiτtυuκkɑaɡgıiℓl"
SUBSTITUTES = "0o1i3e4a5s7t@a$s!i|i€e£l"
#: Read as one letter, for 1 and | stand for both.
ALIKE = {"l": "i"}
#: Words that are toxic where nothing has been learned.
SEED_LEXICON = ("idiot", "moron", "stupid", "loser", "worthless", "scum", "pathetic", "disgusting")
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "clown fish", "clownfish", "sore loser rule", "idiot proof", "idiot light")
#: At most about so many labelled rows are learned from.
TRAIN_ROWS = 16_000
_LONGEST = 12
#: An entry's documents all being toxic must be a chance of less than n ** -_EVIDENCE for n documents: the more documents, the more prefixes are tried.
_EVIDENCE = 2.5


class _Folding(dict):
    """Code point -> folded letter, or a blank for what is no letter; filled as it is used."""

    def __init__(self) -> None:
        super().__init__()
        pairs = HOMOGLYPHS + SUBSTITUTES
        for a, b in zip(pairs[::2], pairs[1::2], strict=True):
            self[ord(a)] = ALIKE.get(b, b)
        for a, b in ALIKE.items():
            self[ord(a)] = b
        for c in (0x200B, 0x200C, 0x200D, 0xAD, 0xFEFF):
            self[c] = ""

    def __missing__(self, code: int) -> str:
        if unicodedata.combining(chr(code)):
            out = ""
        else:
            plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)).lower() if c.isalpha())  # full-width forms and accents
            out = "".join(dict.get(self, ord(c), c) for c in plain) or " "
        self[code] = out
        return out


_FOLDING = _Folding()


def fold(text: str | None) -> str:
    """Lower-cased, with look-alikes as Latin letters, digits and symbols as the letters they stand for, accents left out, anything else blank."""
    return (text or "").lower().translate(_FOLDING)


def folded_words(text: str | None) -> list[str]:
    """Words of the folded text; three or more single letters in a row are one word that was spelled out."""
    words = fold(text).split()
    if sum(map((1).__eq__, map(len, words))) < 3:
        return words
    out, run = [], []
    for w in [*words, ""]:
        if len(w) == 1:
            run.append(w)
            continue
        out += ["".join(run)] if len(run) >= 3 else run
        run = []
        out.append(w)
    return out[:-1]


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: score = 1 / (1 + exp(-(bias + slope * log(1 + weight / (words + floor) ** power))))
    bias: float = -2.0
    slope: float = 4.0
    power: float = 0.25
    floor: float = 20.0
    _machine: object = field(default=None, repr=False)

    def machine(self) -> ahocorasick.Automaton:
        if self._machine is None:
            a = ahocorasick.Automaton()
            for word, w in self.weights.items():
                a.add_word(" " + word, (len(word), w))
            for phrase in self.exceptions:
                p = " ".join(fold(phrase).split())
                a.add_word(f" {p} ", (len(p) + 1, None))
            a.make_automaton()
            self._machine = a
        return self._machine

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_machine": None}

    def hits(self, folded: str) -> float:
        """Sum of the weights of matches outside exception phrases. folded: words with single blanks between, one before and one after."""
        found, excused = [], []
        for end, (size, w) in self.machine().iter(folded):
            if w is None:
                excused.append((end - size + 1, end))
            else:
                found.append((end - size + 1, end, w))
        if excused:
            starts, reach = [], []  # of phrases by start, how far any so far reaches
            for a, b in sorted(excused):
                starts.append(a)
                reach.append(max(b, reach[-1] if reach else b))
            found = [m for m in found if not (k := bisect_right(starts, m[0])) or reach[k - 1] < m[1]]
        longest: dict[int, float] = {}
        for at, _, w in found:  # entries that start at one place count once
            longest[at] = max(w, longest.get(at, 0.0))
        return sum(longest.values())

    def measure(self, text: str | None) -> tuple[float, int]:
        words = folded_words(text)
        return (self.hits(f" {' '.join(words)} ") if words and self.weights else 0.0), len(words)

    def score_of(self, weight: float, words: int) -> float:
        x = math.log1p(weight / (words + self.floor) ** self.power)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.bias + self.slope * x))))

    def score(self, text: str | None) -> float:
        return self.score_of(*self.measure(text))


#: Counts that a worker holds before it passes them on.
_HELD_COUNTS = 50_000


def _prefix_counts(rows: DataFrame) -> dict[str, tuple[int, int]]:
    """entry -> documents with label 0 and 1 that have a word with that prefix (whole words end in a blank). Counted in the workers, some thousands of entries at a time; only entries that can matter come back, of a bounded sample."""

    def batch(total: Counter) -> pa.RecordBatch:
        keys = sorted(total)
        out = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([total[k] for k in keys], pa.int64())], names=["p", "y", "n"])
        total.clear()
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for t, y in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                own = set()
                for w in set(folded_words(t.as_py())):
                    own.update(w[:k] for k in range(4, min(len(w), _LONGEST) + 1))
                    own.add(w[:40] + " ")
                total.update((p, y) for p in own)
                if len(total) > _HELD_COUNTS:
                    yield batch(total)
        yield batch(total)

    counts = rows.select("text", F.col("toxic").cast("int").alias("y")).mapInArrow(count, "p string, y int, n long")
    counts = counts.groupBy("p").agg(F.sum(F.expr("if(y = 0, n, 0)")).alias("n0"), F.sum(F.expr("if(y = 1, n, 0)")).alias("n1"))
    return {r["p"]: (r["n0"], r["n1"]) for r in counts.where("n1 >= 4 and n1 > 12 * n0").collect()}


def select_entries(counts: dict[str, tuple[int, int]], rows0: int, rows1: int) -> dict[str, float]:
    """Entries with weights: a pure prefix, as long as it can be without losing a tenth of its documents; none that begins with another."""
    out: dict[str, float] = {}
    lift = math.log((rows0 + 1) / (rows1 + 1))
    surprise = math.log((rows0 + rows1 + 1) / (rows1 + 0.5))
    order = sorted(counts)
    for p in sorted((c for c in counts if c[-1] != " "), key=lambda c: (len(c), c)):
        if any(p[:k] in out for k in range(1, len(p))):
            continue
        n0, n1 = counts[p]
        longer = [c for c in order[bisect_left(order, p) : bisect_left(order, p + chr(0x10FFFF))] if len(c) > len(p)]
        same = [c for c in longer if counts[c][1] >= 0.9 * n1 and c[-1] != " "]
        own = [c for c in longer if c[-1] == " " and counts[c][1] >= 0.9 * n1]
        best = max([p, *same], key=len)
        if own and len(own[0].strip()) >= len(best):
            best = own[0].strip()
        n0, n1 = counts.get(best, counts.get(best + " ", (n0, n1)))
        weight = math.log((n1 + 0.5) / (n0 + 0.5)) + lift
        if n1 * surprise >= _EVIDENCE * math.log(rows0 + rows1) and weight >= 2.5:
            out[best] = weight
    return out


def _fit_curve(lex: Lexicon, data: list[tuple[float, int, int]]) -> None:
    """power, bias and slope of least regularised log loss over (weight, words, label). No power is 0: length always counts."""
    y = np.array([d[2] for d in data], float)
    w, n = np.array([d[0] for d in data]), np.array([d[1] for d in data], float)
    best = math.inf
    for power in (0.1, 0.25, 0.5, 0.75):
        x = np.log1p(w / (n + lex.floor) ** power)
        beta, ridge = np.zeros(2), np.array([1e-3, 1e-2])
        X = np.stack([np.ones_like(x), x], axis=1)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(X @ beta, -40, 40)))
            hess = (X * (p * (1 - p) + 1e-9)[:, None]).T @ X + np.diag(ridge)
            step = np.linalg.solve(hess, X.T @ (y - p) - ridge * beta)
            beta += np.clip(step, -2, 2)
        p = np.clip(1 / (1 + np.exp(-np.clip(X @ beta, -40, 40))), 1e-9, 1 - 1e-9)
        loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum() + (ridge * beta**2).sum() / 2
        if loss < best - 1e-9:
            best, lex.power, lex.bias, lex.slope = loss, power, float(beta[0]), float(beta[1])


#: Prints of a text; near copies of similarity 0.8 share none of them once in 600 pairs.
_PRINTS = 4


def _with_prints(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text, toxic) with near: under several orders the least hash of a text's runs of five words. Near copies mostly share one, other texts do not; texts without words have those of none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            least = []
            for t in b.column(1):
                h = shingle_hashes(word_hashes(t.as_py()), 5)
                least.append([int(mix64(h + np.uint64(k)).min(initial=(1 << 64) - 1) >> np.uint64(1)) for k in range(_PRINTS)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(least, pa.list_(pa.int64()))], names=[*b.schema.names, "near"])

    return rows.mapInArrow(run, grown(rows.schema, "near array<long>"))


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS) -> Lexicon:
    """A lexicon from labelled documents of the learning folds (crc32 of the id modulo 5 not 0).

    At most about max_rows labelled rows are used, chosen by a hash of the id.
    Of near copies with one label, which are no evidence of their own, one counts.
    Without rows of both labels the seed lexicon is taken. Null labels, ids
    and texts teach nothing; ids that repeat in labels take their largest label.
    """
    own = labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null").where(~fold_of(F.col("doc_id"), 5).isin(0, -1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = own.count()
    share = min(1.0, max_rows / max(rows, 1))
    own = cut(own.where(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))))
    # The sample is of about max_rows rows at most, so its ids can be broadcast and its texts kept.
    train = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(own), "doc_id")
    train = cut(_with_prints(train))
    prints = train.select("toxic", F.struct("doc_id", F.xxhash64("text").alias("t")).alias("d"), F.posexplode("near").alias("k", "p"))
    first = prints.groupBy("toxic", "k", "p").agg(F.min("d").alias("m"))
    copies = prints.join(first, ["toxic", "k", "p"]).where("d <> m").select("d.doc_id", "d.t").distinct()
    train = cut(train.withColumn("t", F.xxhash64("text")).join(copies, ["doc_id", "t"], "left_anti").select("doc_id", "text", "toxic"))
    size = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    plain = Lexicon({fold(w): 4.0 for w in SEED_LEXICON})
    if not size.get(0) or not size.get(1):
        return plain
    entries = select_entries(_prefix_counts(train), size[0], size[1])
    if not entries:
        return plain
    lex = Lexicon(entries)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [lex.measure(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64()), b.column(1).cast(pa.int32())], names=["w", "n", "y"])

    data = sorted(tuple(r) for r in train.select("text", F.col("toxic").cast("int")).mapInArrow(measure, "w double, n long, y int").collect())
    _fit_curve(lex, data)
    return lex


def add_score(docs: DataFrame, lex: Lexicon, text: str = "text", score: str = "score") -> DataFrame:
    """docs with the score (0 to 1) of every whole text; null counts as empty. An existing column of that name is replaced."""
    return sheltered(docs.drop(score), (text,), lambda d: _scored(d, lex, text, score))


def _scored(kept: DataFrame, lex: Lexicon, text: str, score: str) -> DataFrame:
    at = kept.columns.index(text)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([lex.score(t.as_py()) for t in b.column(at)], pa.float64())], names=[*b.schema.names, score])

    return kept.mapInArrow(rate, grown(kept.schema, f"{score} double"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that score 0.5 or more, in the same columns, whatever their names.

    Null and empty texts score as empty ones do; repeated rows fare alike; an
    empty table stays empty; labels may be empty or hold nulls.
    """
    (score,) = fresh(docs.columns, "_score")
    return add_score(docs, learn(docs, labels), score=score).where(F.col(score) < 0.5).select(*named(docs.columns))


def op5(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its score: null and empty texts as empty, null ids not held out; repeated rows give repeated rows, an empty table none."""
    lex = learn(docs, labels)
    out = add_score(docs.select("doc_id", "text"), lex)
    return out.select("doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
