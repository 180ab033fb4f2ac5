import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.llm import decontam, htmlextract, jaccard, langid, licenses, media, mixing, sharding, toxicity, urlfilter

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string"
ODD = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, "x"), (2, "one two", "en", "a", 7, "x"), (None, "one two", "en", None, 7, "x"), (5, "word " * 30000, "en", "a", 150000, "x"), (6, "one two", "en", "b", 7, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def words(t):
    return re.findall("[^\x20\x09-\x0d]+", t or "")


def test_mixing_meets_targets(docs):
    rows = mixing.op1(docs).collect()
    assert len(rows) == docs.count() and {r.doc_id: r.size for r in rows} == {r.doc_id: len(words(r.text)) for r in docs.collect()}
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    got = Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        got[r.source] += r.taken
    for r in rows:
        assert abs(got[r.source] - r.target) <= 64
    assert sorted(map(tuple, mixing.op1(docs).collect())) == sorted(map(tuple, rows))


def test_permutation_is_a_bijection(spark):
    from tabulon.llm.common import permuted

    df = spark.range(97).withColumn("n", F.lit(97).cast("long"))
    there = permuted(df, "id", "n", F.lit(3), "p", 1)
    back = permuted(there, "p", "n", F.lit(3), "q", 1, inverse=True).collect()
    assert sorted(r.p for r in back) == list(range(97)) and all(r.q == r.id for r in back)


def test_sharding_is_even_and_gapless(docs):
    rows = sharding.op10(docs).collect()
    by = Counter()
    for r in rows:
        by[r.shard] += r.size
    assert len(rows) == docs.count() and max(by.values()) - min(by.get(s, 0) for s in range(40)) <= max(r.size for r in rows)
    for s in by:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) for r in rows)


def test_png_round_trip_and_checksums():
    n, payload = media.payload_of("héllo " * 500)
    image = media.encode_png(payload)
    assert n == len(("héllo " * 500).encode()) and media.decode_png(image).tobytes() == payload
    broken = bytearray(image)
    broken[60] ^= 1
    with pytest.raises(media.BadImage):
        media.decode_png(bytes(broken))
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, (5, 12), dtype=np.uint8)
    lines, prior = np.zeros_like(raw), np.zeros(12, int)
    for y in range(5):  # one row of each filter type, by the definition
        for x in range(12):
            a, b, c = int(raw[y, x - 3]) if x >= 3 else 0, int(prior[x]), int(prior[x - 3]) if x >= 3 else 0
            p = a + b - c
            best = min((abs(p - v), i, v) for i, v in enumerate((a, b, c)))[2]
            lines[y, x] = (int(raw[y, x]) - (0, a, b, (a + b) // 2, best)[y]) % 256
        prior = raw[y].astype(int)
    assert (media._unfilter(np.arange(5), lines, 3) == raw).all()


def test_leaks_equal_brute_force():
    items = [(i, " ".join(f"w{i}_{j}" for j in range(20 + i))) for i in range(30)] + [(99, "short one here")]
    index = decontam.Index(items)
    for i, text in items:
        found = index.leaks("some words before " + text.upper() + ", and after that")
        assert [(x["item_id"], x["similarity"]) for x in found] == [(i, 1.0)]
    w = items[29][1].split()
    assert index.leaks(" ".join(["x", *w[1:]]))[0]["similarity"] >= 0.8 and not index.leaks(" ".join(w[:20])) and not index.leaks(None)


def test_url_rules(spark):
    rows = [(1, "https://A.example.com/en/7x?q"), (2, "http://b.com/en/1"), (3, "no scheme"), (4, None), (5, "http://example.net/de/80#x"), (6, "http://x.example.net/de/9")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.op4(spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.lit('<a href="http://b.com/">x</a>'))).collect()}
    assert got[1] == ("a.example.com", "/en/7x", "example.com/en/7", "allow") and got[2][2:] == ("com/en/", "block")
    assert got[3] == ("", "", None, "allow") and got[4] == ("", "", None, "allow")
    assert got[5][2:] == ("example.net/de/8", "block") and got[6][2:] == ("net/de/", "block")


def test_url_mass_equals_the_limit(spark):
    hosts = [f"h{i}.example" for i in range(10)]
    links = {(i, (i + 1) % 10): 1.0 for i in range(10)}  # a ring; h0 is blocked, and h2 is 8 links from it
    more = {(10, 0): 0.5, (10, 11): 0.5, (11, 10): 1.0}
    hosts += ["in.example", "good.example"]
    a = np.zeros((12, 12))
    for (i, j), share in (links | more).items():
        a[i, j] = share
    rows = [(i, f"http://{h}/{'x' if i else 'bad'}", " ".join(f'<a href="http://{hosts[j]}/">' for j in range(12) if a[i, j])) for i, h in enumerate(hosts)]
    out = urlfilter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), [(hosts[0], "bad", "block"), (hosts[11], "x", "allow")]).collect()
    eye, good, bad = np.eye(12), np.eye(12)[11], np.eye(12)[0]
    trust = np.linalg.solve(eye - 0.85 * a.T, 0.15 * good)
    distrust = np.linalg.solve(eye - 0.85 * (a / a.sum(0)), 0.15 * bad)
    for r in out:
        i = r.page_id
        assert (r.trust, r.distrust) == (pytest.approx(trust[i], abs=1e-5), pytest.approx(distrust[i], abs=1e-5))
        assert i in (0, 11) or r.verdict == ("block" if distrust[i] >= 0.05 and distrust[i] > trust[i] else "allow")
    assert len(out) == 12


@pytest.mark.parametrize(("shape", "most"), [("stars", 6), ("any", 25)])
def test_url_rounds_are_few_and_exact(spark, monkeypatch, shape, most):
    """Each write of ranks is a plan of its own, whose threads and metrics stay in the driver."""
    n, draw, made = 60, np.random.default_rng(3), []
    a = np.zeros((n, n))
    if shape == "stars":
        for i in range(3, n):
            a[i, i % 3] = a[i % 3, i] = 1
    else:  # some hosts have no links
        a[draw.integers(n - 9, size=150), draw.integers(n, size=150)] = 1
        np.fill_diagonal(a, 0)
    a /= np.maximum(a.sum(1, keepdims=True), 1)
    seeds = {"trust": draw.random(n) * (draw.random(n) < 0.3), "distrust": draw.random(n) * (draw.random(n) < 0.3)}
    graph = {"trust": a, "distrust": a.T / np.maximum(a.sum(0)[:, None], 1e-9)}
    rows = [(k, f"h{i}", float(v[i])) for k, v in seeds.items() for i in range(n)]
    edges = [(k, f"h{i}", f"h{j}", float(g[i, j])) for k, g in graph.items() for i, j in zip(*np.nonzero(g))]
    keep = urlfilter.Scratch.keep
    monkeypatch.setattr(urlfilter.Scratch, "keep", lambda self, df: made.append(1) or keep(self, df))
    out = urlfilter.propagate(spark.createDataFrame(rows, "kind string, host string, seed double"), spark.createDataFrame(edges, "kind string, src string, dst string, share double")).collect()
    got = {(r.kind, r.host): r.mass for r in out}
    off = [abs(got.get((k, f"h{i}"), 0.0) - x) for k, g in graph.items() for i, x in enumerate(np.linalg.solve(np.eye(n) - 0.85 * g.T, 0.15 * seeds[k]))]
    assert sum(off) <= 1.1e-6 and min(got.values()) >= 0 and len(got) == len(out)
    assert len(made) <= most


def test_url_seeds_weigh_all_pages(spark):
    rows = [(i, f"http://few.com/{'en/' if i == 0 else 'ok/'}{i}", "") for i in range(40)] + [(100 + i, f"http://many.com/{'en/' if i < 20 else 'ok/'}{i}", "") for i in range(40)]
    got = {r.page_id: (r.verdict, r.distrust) for r in urlfilter.op4(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == ("block", pytest.approx(0.15 / 40)) and all(got[i][0] == "allow" for i in range(1, 40)) and all(got[100 + i][0] == "block" for i in range(40))


def test_lexicon():
    lex = toxicity.Lexicon({toxicity.fold("trash"): 4.0, toxicity.fold("idiot"): 4.0})
    bad, fine = lex.score("you 1d10t there"), lex.score("put it in the trash can now")
    assert bad > 0.5 > fine and lex.score("iԁiоt") > 0.5 and lex.score(None) < 0.5 and lex.score("misidiotic") < 0.5


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.01"
    rows = toxicity.op5(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    got = rows.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").selectExpr("avg(int(predicted = toxic))").collect()[0][0]
    assert got >= 0.95


def test_language_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op7(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").selectExpr("avg(int(lang_pred = lang))").collect()[0][0]
    assert got >= 0.98


def test_letters_beyond_the_first_plane():
    assert langid.counts("\U0001f600 12 \U0001f680!") is None and langid.counts("\ud800 1") is None
    assert langid.counts("\U00020000") is not None and langid.counts("\U00010400") is not None


def test_html_main_text():
    page = "<html><body><nav><a href=/>Home</a></nav><div class='post-12'><h1>T &amp; U</h1><p>First  para, long enough.<br>More.<p>Second<script>x</script> para.</div><div class=comments><p>Reader says, this.</p></div><footer>f</footer>"
    assert htmlextract.extract(page, None) == "T & U\n\nFirst para, long enough. More.\n\nSecond para."
    assert htmlextract.extract(None, None) == "" and htmlextract.extract("<p", "html") == ""


@pytest.mark.parametrize(
    "odd", ["<svg-icon name='x'></svg-icon>", "<object-viewer>", "<template-card a=b></template-card>", "<object data=x><embed src=x>", "<select><option>A<option>B", "<svg><path d=x>", "<iframe src=x>", "<svg><g></svg>", "<svg><svg></svg><text>t</text></svg>", "<select><option>A</option></select>", "<template></div></template>"]
)
def test_html_odd_elements_cost_only_themselves(odd):
    page = f"<body><div class=content><p>One, it says here.</p>{odd}<p>Two, it says here.</p><p>Three, it says here.</p></div><svg></svg><footer>f</footer>"
    want = "One, it says here.\n\nTwo, it says here.\n\nThree, it says here."
    assert htmlextract.extract(page, None) == want
    assert htmlextract.extract(page.replace("div class=content", "article").replace("</div><svg>", "</article><svg>"), None) == want


def test_html_math_and_objects_are_prose():
    page = "<article><p>Let <math><mi>x</mi></math> be, as <object data=f>figure</object> says, one<select><option>A</select>.</p></article><script>var a"
    assert htmlextract.extract(page, None) == "Let x be, as figure says, one."


def test_html_hosts_with_several_layouts(spark):
    long = "".join(f"<p>Part {i} of the piece, which goes on for a while, and on.</p>" for i in range(6))
    one, two, three = f"<body><div class=content>{long}</div>", f"<body><div class=content><p>Teaser.</p></div><div class=story>{long}</div>", f"<body><div class=content><p>Teaser.</p></div><div class=odd>{long}</div>"
    rows = [(i, "http://h.com/", one if i < 60 else two if i < 99 else three) for i in range(100)]
    texts = {r.page_id: r.text for r in htmlextract.op8(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(texts) == 100 and all(t.count("Part") == 6 and "Teaser" not in t for t in texts.values())


def test_license_inheritance(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "code"), ("a/b/y.py", "Licensed under CC BY-NC 4.0.\n" + "code " * 20), ("z.py", None), (None, "All rights reserved.")]
    got = {r.path: (r.license, r.inherited_from) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["a/b/c/x.py"] == ("MIT", "a") and got["a/b/y.py"] == ("CC-BY-NC-4.0", None) and got["z.py"] == (None, None) and got["a/LICENSE"] == ("MIT", None)


def test_license_texts_headers_and_prose(spark):
    whole = {name: text for name, text in licenses.TEXTS}
    wrapped = "\n".join(f"# {line}" for line in textwrap.wrap(whole["BSD-3-Clause"], 60))
    rows = [(f"{n}/COPYING.txt", "Copyright (c) 2020 Foo Bar. All rights reserved.\n\n" + t, n) for n, t in whole.items()]
    rows += [(f"x/{i}", t, n) for i, (t, n) in enumerate([
        ("Copyright (c) 2020 Foo Bar. All rights reserved.", "Proprietary"), ("SPDX-License-Identifier: MIT", "MIT"), ("MIT License", "MIT"), ("GNU GENERAL PUBLIC LICENSE", "GPL-1.0-or-later"), ("Mozilla Public License Version 2.0", "MPL-2.0"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"), ("It was released under the MIT License. " + "words go on " * 30, "MIT"), (wrapped + "\nbody = 1" * 400, "BSD-3-Clause"), ("the license of a thing, and the rights of all", None)])]
    got = {r.path: r for r in licenses.scan(spark.createDataFrame(rows, "path string, text string, want string")).collect()}
    assert len(got) == len(rows)
    for path, _, want in rows:
        assert got[path].found == ([want] if want else []), path
        assert got[path].is_license_file or path.startswith("x/")


def test_runs_of_terms_equal_brute_force():
    m = licenses.Matcher({"": 1000, "the": 700, "of": 300, "license": 20})
    rng = np.random.default_rng(2)
    k = next(i for i, (n, _) in enumerate(licenses.TEMPLATES) if n == "MPL-2.0")
    own = licenses._terms(licenses.TEMPLATES[k][1])
    size = len(own)
    for _ in range(5):
        terms = [*rng.choice(["the", "of", "zzz", "source"], 40), *(w for w in own if rng.random() > 0.15), *rng.choice(["the", "of", "yyy"], 40)]
        unit = [m._unit(Counter(terms[i : i + size])) for i in range(len(terms) - size + 1)]
        best = max(sum(x * u.get(t, 0.0) for t, x in m.units[k].items()) for u in unit)
        got = m.runs(k, terms)
        assert (got[0][0] == pytest.approx(best)) if best >= licenses.SIMILARITY else not got


def brute_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = words((t or "").lower())
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and same and 100 * same >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(i, len(s), find(i)) for i, s in sets.items()}


def test_jaccard_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(0, None), (1, "  "), (2, "a b"), (3, "A B")]
    for g in range(12):
        base = [f"w{x}" for x in rng.integers(0, 50, int(rng.integers(4, 60)))]
        for _ in range(8):
            w = [*base]
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(len(w)))] = f"z{rng.integers(9)}"
            rows.append((len(rows), " ".join(w[int(rng.integers(0, 2)) :])))
    got = jaccard.op9(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {tuple(r) for r in got.collect()} == brute_components(rows, 4, 85)


def test_distinct_documents_decides_by_row(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(20)) for x in "abcde")
    near = a + " more"
    rows = [(1, a), (2, a), (2, c), (3, b), (3, d), (4, d), (5, near), (None, a.upper()), (None, e), (None, e), (None, ""), (6, ""), (6, None), (7, e + " x y z u v w q r s")]
    got = jaccard.distinct_documents(spark.createDataFrame(rows, "doc_id long, text string").withColumn("extra", F.lit(1)))
    want = [(1, a), (2, c), (3, b), (4, d), (None, e), (None, e), (None, ""), (6, ""), (6, None), rows[-1]]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want) and got.columns == ["doc_id", "text", "extra"]


def test_distinct_documents_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 90, 60)]
        for _ in range(5):
            w = [*base]
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(len(w)))] = f"z{rng.integers(9)}"
            rows.append((len(rows), " ".join(w)))
    kept = {i for i, _, comp in brute_components(rows, 5, 80) if comp == i}
    got = jaccard.distinct_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in got.collect()) == sorted(kept) and len(kept) < len(rows)


@pytest.mark.parametrize("rows", [[], ODD], ids=["empty", "odd"])
def test_odd_tables(spark, rows):
    d = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, None), (None, "one two three four five six")], "item_id long, text string")
    for got in (mixing.op1(d), media.op2(d), toxicity.op5(d, labels), licenses.op6(d), langid.op7(d), jaccard.op9(d), sharding.op10(d), sharding.shard(d)):
        assert got.count() == len(rows)
    assert decontam.op3(d, items).count() == 0 and decontam.decontaminated(d, items).columns == d.columns
    assert mixing.mixed_documents(d).columns == d.columns and jaccard.distinct_documents(d).count() >= min(1, len(rows))
