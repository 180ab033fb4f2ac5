from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.llm import decontam, mixing, toxicity
from tests.llm.test_llm import brute_components, words

ITEM = " ".join(f"q{j}" for j in range(30))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 300, 60)) for _ in range(40)]
    for t in texts[:10]:  # near copies and an exact one
        w = t.split()
        w[int(rng.integers(60))] = "z"
        texts += [" ".join(w), t]
    texts += [f"start {ITEM} end", f"start {ITEM.replace('q0', 'other')} end", " ".join(ITEM.split()[:12])]
    bad = len(texts)
    texts += [f"{t} you filthy grobbler grobbler grobbler" for t in texts[20:40]]
    d = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", "ab"[i % 2], len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= bad)) for i in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def leaks(text):
    w, item = decontam.words_of(text), decontam.words_of(ITEM)
    n, k = len(item), decontam.SHINGLE
    of = lambda x: {tuple(x[i : i + k]) for i in range(len(x) - k + 1)}
    b = of(item)
    return any(len((a := of(w[i : i + n])) & b) >= decontam.SIMILARITY * len(a | b) for i in range(len(w) - n + 1))


def test_stages_and_run_equal_brute_force(spark, corpus, tmp_path):
    docs, seen = spark.read.parquet(f"{corpus}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, corpus).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        ids = sorted(r.doc_id for r in after.collect())
        seen.append((name, len(before), len(ids)))
        if name == "toxicity":
            lex = toxicity.learn(docs, spark.read.parquet(f"{corpus}/labels.parquet"))
            assert ids == [r.doc_id for r in sorted(before) if lex.score(r.text) < 0.5] and ids[-1] < 63
        elif name == "near_duplicates":
            assert ids == sorted(i for i, _, c in brute_components([(r.doc_id, r.text) for r in before], 5, 80) if c == i)
        elif name == "decontamination":
            assert ids == sorted(r.doc_id for r in before if not leaks(r.text))
        elif name == "mixing":
            got = Counter()
            for r in after.collect():
                got[r.doc_id] += len(words(r.text))
            assert got == Counter({r.doc_id: r.taken for r in mixing.op1(docs).collect() if r.taken})
            text = {r.doc_id: Counter(words(r.text)) for r in before}
            assert all(Counter(words(r.text)) <= text[r.doc_id] for r in after.collect())
        else:
            assert sorted(after.select(*docs.columns).collect()) == sorted(before)
            slots = {r.shard: sorted(r.slots) for r in after.groupBy("shard").agg(F.collect_list("slot").alias("slots")).collect()}
            assert all(s == list(range(len(s))) for s in slots.values())
        docs = after
    assert all(n > m for _, n, m in seen[:3]), seen
    assert sorted(map(tuple, corpus_pipeline.run(spark, corpus).collect())) == sorted(map(tuple, docs.collect()))
