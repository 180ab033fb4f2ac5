"""Language identification by nearest centroids.

A text is a normalised TF-IDF vector of hashed character 1- to 3-grams. Each
language has several centroids, found by clustering its learning vectors on
the sphere; a text takes the language of the centroid of largest cosine. Texts
farther from every centroid than nearly all learning texts are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, grown, sheltered

DIMENSIONS = 4096
CENTROIDS = 3
#: At most about so many labelled rows are learned from, shared among languages.
TRAIN_ROWS = 2400
REJECT_QUANTILE = 0.995
_CODE_POINTS = 0x110000


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(_CODE_POINTS)])


_IS_LETTER: list[np.ndarray] = []


def counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams of a lower-cased text whose runs of other characters are single blanks; None without a letter."""
    if not text:
        return None
    if not _IS_LETTER:
        _IS_LETTER.append(_letters())
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _IS_LETTER[0][c]
    if not letter.any():
        return None
    c = np.where(letter, c, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    c = np.concatenate([[np.uint32(32)], c[keep], [np.uint32(32)]]).astype(np.uint32)
    out = np.zeros(DIMENSIONS, np.float32)
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    h = c * np.uint32(0x9E3779B1)
    for k in range(3):
        if k:
            if len(h) < 2:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + c[k:]
        out += np.bincount((h * np.uint32(0xC2B2AE35)) >> shift, minlength=DIMENSIONS)
    return out


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    owner: np.ndarray  # index into langs for each centroid
    floor: np.ndarray  # cosine under which a language rejects

    def vectors(self, c: np.ndarray) -> np.ndarray:
        v = np.log1p(c) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected); und for a text without letters, or where nothing was learned."""
        found = [counts(t) for t in texts]
        out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
        at = [i for i, c in enumerate(found) if c is not None]
        if at and self.langs:
            cos = self.vectors(np.stack([found[i] for i in at])) @ self.centroids.T
            best = cos.argmax(axis=1)
            for row, (i, k) in enumerate(zip(at, best, strict=True)):
                x = float(np.clip(cos[row, k], 0.0, 1.0))
                lang = int(self.owner[k])
                out[i] = (self.langs[lang], x, x < float(self.floor[lang]))
        return out


def _cluster(v: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids of at most k clusters; starts from the row nearest the mean and then the farthest rows."""
    mean = v.mean(axis=0)
    picked = [int((v @ mean).argmax())]
    while len(picked) < min(k, len(v)):
        picked.append(int((v @ v[picked].T).max(axis=1).argmin()))
    c = v[picked]
    for _ in range(12):
        own = (v @ c.T).argmax(axis=1)
        sums = np.stack([v[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


def learn(docs: DataFrame, max_rows: int = TRAIN_ROWS, centroids: int = CENTROIDS) -> Model:
    """A model from text and lang of the learning folds (crc32 of the id modulo 4 not 2).

    About max_rows rows are used, as many of each language, chosen by a hash
    of id and text. Rows with null id, lang or text, or without letters, teach
    nothing.
    """
    own = docs.select("doc_id", "text", "lang").where("doc_id is not null and lang is not null and text is not null").where(fold_of(F.col("doc_id"), 4) != 2)
    sizes = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    empty = Model([], np.zeros(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, int), np.zeros(0))
    if not sizes:
        return empty
    each = max(1, max_rows // len(sizes))
    limit = F.lit(1 << 30)
    for lang, n in sorted(sizes.items()):
        limit = F.when(F.col("lang") == lang, F.lit(int(min(1.0, each / n) * (1 << 30)))).otherwise(limit)
    sample = own.where(F.pmod(F.xxhash64(F.lit(5), "doc_id", "text"), F.lit(1 << 30)) < limit)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(i, lang, c) for i, t, lang in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True) if (c := counts(t.as_py())) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2].tobytes() for g in got], pa.binary())], names=["doc_id", "lang", "v"])

    rows = sorted((r["lang"], r["doc_id"], bytes(r["v"])) for r in sample.mapInArrow(featurise, "doc_id long, lang string, v binary").collect())
    if not rows:
        return empty
    c = np.stack([np.frombuffer(r[2], np.float32) for r in rows])
    names = np.array([r[0] for r in rows], object)
    idf = (np.log((1 + len(c)) / (1 + (c > 0).sum(axis=0))) + 1).astype(np.float32)
    model = Model(sorted(set(names)), idf, empty.centroids, empty.owner, empty.floor)
    v = model.vectors(c).astype(np.float32)
    parts, owner, floor = [], [], []
    for i, lang in enumerate(model.langs):
        own_v = v[names == lang]
        cent = _cluster(own_v, centroids)
        parts.append(cent)
        owner += [i] * len(cent)
        floor.append(float(np.quantile((own_v @ cent.T).max(axis=1), 1 - REJECT_QUANTILE)))
    model.centroids, model.owner, model.floor = np.concatenate(parts), np.array(owner), np.array(floor)
    return model


def add_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, score (cosine to the nearest centroid) and rejected, from every whole text.

    Texts that are null or have no letter get und, 0 and true. Columns of docs
    with these names are replaced.
    """
    return sheltered(docs.drop("lang_pred", "score", "rejected"), (text,), lambda d: _predicted(d, model, text))


def _predicted(kept: DataFrame, model: Model, text: str) -> DataFrame:
    at = kept.columns.index(text)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [g for k in range(0, b.num_rows, 256) for g in model.predict(b.column(at).slice(k, 256).to_pylist())]
            new = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, "lang_pred", "score", "rejected"])

    return kept.mapInArrow(predict, grown(kept.schema, "lang_pred string, score double, rejected boolean"))


def op7(docs: DataFrame) -> DataFrame:
    """Every row with its predicted language: und for null texts and those without letters, null ids not held out; repeated rows alike, an empty table none."""
    out = add_language(docs.select("doc_id", "text"), learn(docs))
    return out.select("doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
