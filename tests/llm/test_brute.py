"""Operators against brute force, and inputs with odd rows and clashing names."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.llm import common, decontam, htmlextract, jaccard, langid, licenses, media, mixing, queries, sharding, toxicity, urlfilter
from tests.llm.test_llm import brute_components

SF = "/root/testdata/sf0.001"

#: Names that operators use within, and their own results' names.
CLASHING = [
    "_gone", "_maybe", "_id", "_word", "_at", "_mask", "_path", "_paths", "_host", "_h", "_h1", "_h2", "_size", "_cell", "_sub", "_parts", "_dir", "_d", "_n", "_from", "_given", "_score", "_leaks", "_row", "_item", "_found",
    "_same", "_a", "_b", "_sheltered", "_w", "_n", "_c_text", "_tie", "_bucket", "start", "sid", "quota", "slots", "comp", "node", "key", "rep", "n", "h", "m", "e", "near", "by_rule", "a.b", "found",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def clashing(df):
    extra = [c for c in dict.fromkeys(CLASHING) if c not in df.columns]
    return df.select("*", *[F.lit(f"user {i}").alias(c) for i, c in enumerate(extra)]), {c: f"user {i}" for i, c in enumerate(extra)}


def kept(out, values, but=()):
    rows = out.collect()
    assert rows and all(r[c] == v for r in rows for c, v in values.items() if c not in but)
    return rows


def test_user_columns_come_through(spark, docs):
    some = spark.createDataFrame([(i, f"{'trash idiot ' * (i % 2)}some words of text number {i} and more {i}", "en", "ab"[i % 2], 9) for i in range(12)], "doc_id long, text string, lang string, source string, n_chars long")
    d, values = clashing(some)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, "some words of text number 3 and more 3")], "item_id long, text string")
    assert len(kept(jaccard.distinct_documents(d), values)) == 12
    assert len(kept(jaccard.distinct_documents(d.unionByName(d)), values)) == 24
    assert len(kept(toxicity.reject_toxic(d, labels), values)) == 6
    assert len(kept(decontam.decontaminated(d, items), values)) == 11
    assert len(kept(sharding.shard(d), values)) == 12
    assert sharding.shard(d).columns == [*d.columns, "size", "shard", "slot"]
    assert kept(mixing.mixed_documents(d), values) and mixing.mixed_documents(d).columns == d.columns
    assert len(kept(langid.add_language(d, langid.learn(d)), values)) == 12 and len(kept(media.add_media(d), values)) == 12
    files = d.withColumn("path", F.concat(F.lit("x/"), F.col("doc_id")))
    assert len(kept(licenses.scan(files), values, ("found",))) == 12 and len(kept(licenses.scan(files.drop("found").withColumnsRenamed({"path": "p", "text": "t"}), "p", "t"), values, ("found",))) == 12
    pages = d.drop("text", "source").withColumnRenamed("doc_id", "page_id").withColumns({"url": F.lit("http://a.b.com/x"), "html": F.lit("<p>Text, it says here.</p>")})
    assert len(kept(urlfilter.filter_urls(pages), values)) == 12 and len(kept(htmlextract.extract_pages(pages), values)) == 12


@pytest.mark.parametrize("rows", [[], [(1, None, None), (1, "http://a.com/en/x", ""), (1, "http://a.com/en/x", ""), (None, "", "<p>" * 3000 + "deep, it is" + "</p>" * 10), (2, "x://", "<div>" * 5000 + "far, in there, it says" + "</div>" * 5000)]], ids=["empty", "odd"])
def test_odd_pages(spark, rows):
    p = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert urlfilter.op4(p).count() == len(rows) and htmlextract.op8(p).count() == len(rows)
    if rows:
        assert {r.text for r in htmlextract.op8(p).collect()} == {"", "deep, it is", "far, in there, it says"}


def test_bitmaps_let_all_wanted_rows_pass(spark):
    df, ids = spark.range(5000).withColumnRenamed("id", "k"), spark.range(0, 5000, 9)
    got = {r.k for r in common.in_bitmap(df, "k", ids, 556, "f").where("f").collect()}
    assert got >= set(range(0, 5000, 9)) and len(got) < 1500
    assert common.in_bitmap(df, "k", ids.limit(0), 0, "f").where("f").count() == 0 and common.in_bitmap(df.withColumn("k", F.lit(None).cast("long")), "k", ids, 556, "f").count() == 5000


# Mixing


def test_targets_equal_resharing(spark):
    rng = np.random.default_rng(0)
    for _ in range(6):
        sizes = {None if i == 3 else f"s{i}": int(rng.integers(0, 200)) for i in range(int(rng.integers(1, 7)))}
        order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
        weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
        left, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(order, 0.0), list(order)
        while left > 1e-9 and open_:  # the excess over twice a source's size goes to the others, again and again
            share = left / sum(weight[s] for s in open_)
            left = 0.0
            for s in open_:
                target[s] += share * weight[s]
            for s in list(open_):
                if target[s] >= 2 * sizes[s]:
                    left += target[s] - 2 * sizes[s]
                    target[s] = 2.0 * sizes[s]
                    open_.remove(s)
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        assert {r.source: r.target for r in mixing.source_targets(df).collect()} == pytest.approx(target)


def test_starts_are_running_sums(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_ROWS_PER_BUCKET", 3)
    monkeypatch.setattr(mixing, "_BUCKETS_PER_GROUP", 4)
    rows = [(i, " ".join(["w"] * (i % 7)), "ab"[i % 3 > 0] if i % 11 else None) for i in range(200)]
    placed = mixing.layout(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(placed) == 200
    for s in ("a", "b", None):
        at = 0
        for r in sorted((r for r in placed if r.source == s), key=lambda r: (r.start, r.size > 0)):
            assert r.start == at
            at += r.size


# Media


def test_hash_equals_the_transform():
    rng = np.random.default_rng(1)
    for shape in ((1, 64, 3), (40, 64, 3), (7, 64, 1)):
        x = rng.integers(0, 256, shape, dtype=np.uint8)
        side = media._SIDE
        grey = x.astype(float).mean(axis=2)
        for axis in (0, 1):
            n = grey.shape[axis]
            cut = [int(i * n // side) for i in range(side)] + [n]
            runs = [np.take(grey, range(a, max(a + 1, b)), axis=axis).mean(axis=axis) for a, b in zip(cut, cut[1:], strict=False)]
            grey = np.stack(runs, axis=axis)
        low = np.zeros((media._LOW, media._LOW))
        for u in range(media._LOW):
            for v in range(media._LOW):
                low[u, v] = sum(grey[i, j] * math.cos(math.pi * (u + 1) * (2 * i + 1) / (2 * side)) * math.cos(math.pi * (v + 1) * (2 * j + 1) / (2 * side)) for i in range(side) for j in range(side)) * 2 / side
        bits = (low.round(6) > np.median(low.round(6))).ravel()
        assert media.cosine_hash(x) == f"{int(''.join('01'[int(b)] for b in bits), 2):016x}"


def test_media_columns(docs):
    import hashlib

    text = {r.doc_id: r.text for r in docs.collect()}
    for r in media.op2(docs).collect():
        raw = (text[r.doc_id] or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:])) and r.media_bytes > 0


# Decontamination


def brute_leaks(text, item):
    w, b = decontam.words_of(text), decontam.words_of(item)
    k = decontam.SHINGLE
    if not w or not b:
        return 0.0
    of = lambda x: Counter(tuple(x[i : i + k]) for i in range(max(1, len(x) - k + 1)))
    size, own = min(len(b), len(w)), of(b)
    return max(sum((x & own).values()) / sum((x | own).values()) for x in (of(w[i : i + size]) for i in range(len(w) - size + 1)))


def test_windows_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(9)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 40, int(rng.integers(3, 120))))) for i in range(25)] + [(90, None), (91, " "), (None, "only one item has no id of its own")]
    texts = [None, "", "w1 w2"]
    for i in range(60):
        w = items[i % 25][1].split()
        for _ in range(int(rng.integers(0, 3))):
            w[int(rng.integers(len(w)))] = "odd"
        texts.append(" ".join([*(f"x{x}" for x in rng.integers(0, 40, int(rng.integers(0, 30)))), *w, *(f"w{x}" for x in rng.integers(0, 40, int(rng.integers(0, 30))))]))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    want = {(i, k): s for i, t in enumerate(texts) for k, x in items if (s := brute_leaks(t, x)) >= 0.8 - 1e-12}
    near = {key: s for key, s in want.items() if s < 1}
    assert len(near) > 10 and len(want) > len(near)
    for most in (decontam.MAX_ITEMS, 5):
        monkeypatch.setattr(decontam, "MAX_ITEMS", most)
        assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in decontam.op3(d, table).collect()} == want


# URL filters


def test_domains_link_their_hosts(spark):
    urls = ["http://a.x.com/bad/1", "http://a.x.com/bad/2", "http://b.x.com/ok", "http://c.y.com/ok", "http://x.com/ok", "http://10.0.0.1/ok"]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.host: r for r in urlfilter.filter_urls(pages, [("a.x.com", "bad", "block")]).collect()}
    hosts = ["a.x.com", "b.x.com", "x.com"]
    a = np.array([[0, 0, 1], [0, 0, 1], [0.5, 0.5, 0]])
    distrust = np.linalg.solve(np.eye(3) - 0.85 * (a / a.sum(0)), 0.15 * np.array([1.0, 0, 0]))
    for i, h in enumerate(hosts):
        assert got[h].distrust == pytest.approx(distrust[i], abs=1e-5)
        assert got[h].verdict == ("block" if i == 0 or distrust[i] >= 0.05 else "allow")
    assert got["c.y.com"].distrust == got["10.0.0.1"].distrust == 0 and got["c.y.com"].verdict == "allow" and got["b.x.com"].verdict == "block"


# Toxicity


def test_folding_and_exceptions():
    lex = toxicity.Lexicon({toxicity.fold(w): 4.0 for w in ("trash", "idiot")})
    assert all(lex.score(t) > 0.5 for t in ("ïdiot", "ｉｄｉｏｔ", "i.d.i.o.t", "you trash candidate", "i d 1 0 t", "IDIOT!"))
    assert all(lex.score(t) < 0.5 for t in ("the trash can", "the trash can.", "a b c", "", None))
    assert lex.score("idiot") > lex.score("idiot " + "fine words here " * 200)
    many = "trash can " * 4000 + "idiot"
    assert lex.measure(many)[0] == 4.0


def test_near_copies_are_one_piece_of_evidence(spark):
    base = "hopeless " + " ".join(f"w{i}" for i in range(40))
    rows = [(i, base + f" tail{i}") for i in range(40)] + [(100 + i, " ".join(f"v{i}_{j}" for j in range(30))) for i in range(60)] + [(200 + i, f"idiot y{i} " + " ".join(f"u{i}_{j}" for j in range(20))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100 or i >= 200)) for i, _ in rows], "doc_id long, toxic int")
    assert set(toxicity.learn(docs, labels).weights) == {"idiot"}


# HTML


def test_votes_and_paths_equal_counting(spark, monkeypatch):
    rows = []
    for i in range(90):
        box = ("main-1", "main-2", "post")[i % 3 if i % 2 else 0]
        rows.append((i, f"http://h{i % 2}.com/{i}", f"<body><div class='{box}{i}'><p>First, of page {i}, and on it goes.</p><p>Second, {i}.</p></div><div class=foot><p>x</p></div>"))
    rows.append((90, None, "<p>No host, here."))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = Counter()
    for _, url, page in rows:
        top, _ = htmlextract.best_container(htmlextract.parse(page))
        want[(url.split("/")[2] if url else ""), top.path()] += 1
    cast = htmlextract.votes(pages)
    assert {(r.host, r.path): r.votes for r in cast.collect()} == dict(want)
    hosts = {h for h, _ in want}
    for r in htmlextract.winning(cast).collect():
        own = {p: n for (h, p), n in want.items() if h == r._host}
        assert r._paths[0] in [p for p, n in own.items() if n == max(own.values())]
        assert set(r._paths) == {p for p, n in own.items() if n >= 2 and n * 100 >= 5 * sum(own.values())} | {r._paths[0]}
        hosts.discard(r._host)
    assert not hosts
    one = sorted(map(tuple, htmlextract.op8(pages).collect()))
    monkeypatch.setattr(htmlextract, "_BROADCAST_MOST", -1)
    assert sorted(map(tuple, htmlextract.op8(pages).collect())) == one and one[5][2] == "First, of page 5, and on it goes.\n\nSecond, 5."


# N-gram join


def test_join_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.execute(queries.oracle_sql()["op9_jaccard"]).fetchall())
    assert sorted(map(tuple, queries.queries()["op9_jaccard"](spark, SF).collect())) == want


@pytest.mark.parametrize("long_list", [512, 3])
def test_join_of_many_copies_and_long_texts(spark, monkeypatch, long_list):
    """Long lists dealt to chunks, sketches of long texts, and documents with several texts."""
    monkeypatch.setattr(jaccard, "_LONG_LIST", long_list)
    rng = np.random.default_rng(6)
    rows = []
    for size, copies in ((40, 60), (900, 6), (1300, 6), (6, 20)):
        base = [f"w{x}" for x in rng.integers(0, 5000, size)]
        for _ in range(copies):
            w = [*base]
            for _ in range(int(rng.integers(0, max(2, size // 12)))):
                w[int(rng.integers(len(w)))] = f"z{rng.integers(999)}"
            rows.append((len(rows), " ".join(w)))
    got = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {tuple(r) for r in got.collect()} == brute_components(rows, 4, 85)


def test_texts_of_one_document_are_one_component(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    rows = [(1, a), (2, b), (5, a), (5, b), (7, b + " "), (8, None), (None, a), (None, "x y z w v")]
    got = Counter(tuple(r) for r in jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter([(1, 2, 1), (2, 2, 1), (5, 2, 1), (5, 2, 1), (7, 2, 1), (8, 0, 8), (None, 2, 1), (None, 2, None)])


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 60, int(rng.integers(1, 3000)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 60, int(rng.integers(0, 300)), dtype=np.uint64)]))
        apart = len(np.setxor1d(a, b))
        x, y = (jaccard.parities(s, 1 << max(6, (max(len(s), 1) - 1).bit_length())) for s in (a, b))
        size = min(len(x), len(y))
        assert np.bitwise_count(jaccard.folded(x, size) ^ jaccard.folded(y, size)).sum() <= apart
        assert (jaccard.folded(x, 8) == jaccard.parities(a, 64)).all()


# Sharding


def test_overfull_ranges_are_divided(spark):
    rows = [(i, "the same text in very many documents, long enough to weigh") for i in range(4000)] + [(9000 + i, f"text {i} " * 3) for i in range(500)] + [(None, None), (None, "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shard(d, shards=8).collect()
    size = Counter()
    for r in got:
        size[r.shard] += r["size"]
    assert len(got) == len(rows) and set(size) == set(range(8)) and max(size.values()) - min(size.values()) < 0.05 * sum(size.values()) / 8
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    by_text = Counter((r.text, r.shard) for r in got)
    assert sum(t is not None and t.startswith("the same") for t, _ in by_text) == 8 and all(n == 1 for t, n in Counter(t for t, _ in by_text).items() if not (t or "").startswith("the same"))
    assert sorted((str(r.doc_id), r.shard, r.slot) for r in sharding.shard(d.repartition(2), shards=8).collect()) == sorted((str(r.doc_id), r.shard, r.slot) for r in got)
