import datetime as dt
import json
import zlib
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from tabulon.functions import transforms
from tabulon.operators import vectors
from tabulon.plans.expressions import FALSE, TRUE, Expr, all_of, any_of, compare, flipped, from_json, intersects, is_in, not_in, project, starts_with, unary
from tabulon.sources import blobs, maintenance
from tabulon.sources import schema as schemas
from tabulon.sources.catalog import FolderCatalog, SqliteCatalog
from tabulon.sources.files import shortened
from tabulon.sources.table import CommitConflict, Table
from tabulon.streaming import AppendStream


def table(spark, path, ddl, rows=None, **how):
    t = Table.create(spark, str(path), StructType.fromDDL(ddl), **how)
    if rows is not None:
        t.append(spark.createDataFrame(rows, ddl).coalesce(1))
    return t


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


# Transforms


def test_transforms_do_not_follow_the_session_zone(spark):
    df = spark.sql("select timestamp_micros(1577838600000000) t, timestamp_ntz'2020-01-01 00:30:00' n, timestamp_ntz'1969-12-31 23:59:59.999999' o, date'2020-01-01' d")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        of = lambda w, c: transforms.apply(w, F.col(c), df.schema[c].dataType)
        r = df.select(*[of(w, c).alias(f"{w}_{c}") for w in ("year", "month", "day", "hour") for c in "tno"], of("bucket[100]", "t").alias("bt"), of("bucket[100]", "n").alias("bn"), of("bucket[100]", "d").alias("bd")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (r.year_t, r.year_n, r.year_o) == (50, 50, -1) and (r.month_t, r.month_n, r.month_o) == (600, 600, -1)
    assert r.day_t == r.day_n == dt.date(2020, 1, 1) and r.day_o == dt.date(1969, 12, 31)
    assert (r.hour_t, r.hour_n, r.hour_o) == (438288, 438288, -1)
    at = dt.datetime(2020, 1, 1, 0, 30)
    assert r.bt == r.bn == transforms.value_of("bucket[100]", at, df.schema["n"].dataType) and r.bd == transforms.value_of("bucket[100]", at.date(), df.schema["d"].dataType)


def test_decimals_of_any_precision(spark):
    big, small = Decimal("12345678901234567890123456789012.34"), Decimal("10.6512345678")
    df = spark.createDataFrame([(big, small, -small), (None, None, None)], "b decimal(38,2), s decimal(18,10), m decimal(18,10)")
    n = int(str(big).replace(".", ""))
    raw = n.to_bytes((n.bit_length() // 8) + 1, "big", signed=True)
    r = df.select(transforms.bucket(1_000_000, F.col("b"), DecimalType(38, 2)), transforms.truncate(50, F.col("s"), DecimalType(18, 10)), transforms.truncate(50, F.col("m"), DecimalType(18, 10))).collect()
    assert r[0][0] == int(transforms.murmur3([raw])[0] & 0x7FFFFFFF) % 1_000_000
    assert r[0][1:] == (Decimal("10.6512345650"), Decimal("-10.6512345700")) and tuple(r[1]) == (None, None, None)
    assert transforms.value_of("truncate[50]", -small, DecimalType(18, 10)) == r[0][2]


def test_transforms_reject_types(spark):
    for transform, kind in (("bucket[4]", "double"), ("bucket[4]", "boolean"), ("truncate[4]", "double"), ("hour", "date"), ("year", "int"), ("mystery", "int")):
        with pytest.raises(ValueError):
            transforms.apply(transform, F.lit(None), StructType.fromDDL(f"x {kind}")["x"].dataType)
    for text in ("bucket", "bucket[0x]", "year[3]", "1"):
        with pytest.raises(ValueError):
            transforms.parse(text)


def test_murmur_of_all_lengths():
    """Against the plain form of the hash, a value at a time."""

    def plain(data):
        mask, h = 0xFFFFFFFF, 0
        mix = lambda k: ((k * 0xCC9E2D51 & mask) << 15 | (k * 0xCC9E2D51 & mask) >> 17) * 0x1B873593 & mask
        for i in range(0, len(data) & ~3, 4):
            h ^= mix(int.from_bytes(data[i : i + 4], "little"))
            h = (((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64) & mask
        if len(data) % 4:
            h ^= mix(int.from_bytes(data[len(data) & ~3 :], "little"))
        h ^= len(data)
        h = (h ^ h >> 16) * 0x85EBCA6B & mask
        h = (h ^ h >> 13) * 0xC2B2AE35 & mask
        return h ^ h >> 16

    rng = np.random.default_rng(3)
    values = [rng.bytes(int(n)) for n in rng.integers(0, 40, 200)] + [b""]
    assert transforms.murmur3(values).tolist() == [plain(v) for v in values]


def test_readable_partitions():
    assert [transforms.readable(t, v) for t, v in (("year", 50), ("month", -1), ("day", dt.date(2020, 2, 3)), ("hour", 438288), ("identity", None), ("identity", b"a"), ("identity", True))] == ["2020", "1969-12", "2020-02-03", "2020-01-01-00", "null", "YQ==", "true"]


# Expressions


def test_literals_take_the_columns_type(spark):
    kinds = StructType.fromDDL("i int, d date, x decimal(6,2), f double, n int not null")
    b = lambda e: e.bind(kinds)
    assert b(compare("i", "<", 1 << 40)).op == "not_null" and b(compare("i", ">", 1 << 40)) == FALSE and b(compare("n", "!=", 1 << 40)) == TRUE
    assert b(compare("i", "<", 2.5)).value == 3 and b(compare("i", "<=", 2.5)).value == 2 and b(compare("i", "=", 2.5)) == FALSE
    assert b(compare("d", "=", "2020-01-02")).value == dt.date(2020, 1, 2) and b(compare("x", "=", "1.5")).value == Decimal("1.50")
    assert b(unary("n", "is_null")) == FALSE and b(unary("i", "is_nan")) == FALSE and b(not_in("i", [1.5, 2.5])).op == b(not_in("i", [1.5])).op == "not_null" and b(not_in("n", [1.5, 2.5])) == TRUE
    assert b(compare("f", "=", float("nan"))) == FALSE and b(compare("f", "!=", float("nan"))).op == "not_null"
    assert b(flipped(5, "<", "i")) == b(compare("i", ">", 5))
    for e in (compare("i", "=", "x"), starts_with("i", "a"), compare("none", "=", 1), compare("i", "=", None)):
        with pytest.raises(ValueError):
            b(e)


def test_nan_compares_like_no_number(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "i int, x double")
    ids = lambda e: sorted(r.i for r in df.where(e.bind(df.schema).column(df.schema)).collect())
    assert ids(compare("x", "=", float("nan"))) == [] and ids(compare("x", "!=", float("nan"))) == [1, 3] and ids(is_in("x", [1.0, float("nan")])) == [3]
    stats = {"x": {"rows": 3, "nulls": 1, "nan": 1, "lower": 1.0, "upper": 1.0}}
    assert unary("x", "is_nan").may_match(stats) and not unary("x", "is_nan").may_match({"x": stats["x"] | {"nan": 0}})
    assert not unary("x", "not_nan").may_match({"x": {"rows": 2, "nulls": 0, "nan": 2}})


def test_names_with_dots_and_paths(spark):
    df = spark.createDataFrame([(1, (2, 3)), (5, (6, 7))], "`a.b` int, s struct<a: int, b: int>")
    for e, want in ((compare("a.b", "=", 1), 1), (compare("s.b", ">", 3), 1), (compare("S.A", "<", 100), 2)):
        assert df.where(e.bind(df.schema, e.field != "S.A").column(df.schema)).count() == want


def test_bounds_hold_for_every_row(spark):
    """Rules against rows: a file that may not match has no matching row, one that must has no other."""
    rng = np.random.default_rng(0)
    for _ in range(60):
        xs = [None if rng.random() < 0.2 else float("nan") if rng.random() < 0.1 else float(rng.integers(0, 5)) for _ in range(int(rng.integers(0, 4)))]
        real = [x for x in xs if x is not None and x == x]
        s = {"x": {"rows": len(xs), "nulls": xs.count(None), "nan": sum(x is not None and x != x for x in xs), "lower": min(real, default=None), "upper": max(real, default=None)}}
        holds = {
            "is_null": lambda x, v: x is None, "not_null": lambda x, v: x is not None, "is_nan": lambda x, v: x is not None and x != x, "not_nan": lambda x, v: x is not None and x == x,
            "=": lambda x, v: x is not None and x == v, "!=": lambda x, v: x is not None and x != v, "<": lambda x, v: x is not None and x < v, "<=": lambda x, v: x is not None and x <= v, ">": lambda x, v: x is not None and x > v, ">=": lambda x, v: x is not None and x >= v,
            "in": lambda x, v: x in v, "not_in": lambda x, v: x is not None and x not in v,
        }
        for op, f in holds.items():
            v = (1.0, 3.0) if op.endswith("in") else float(rng.integers(0, 5))
            e = Expr(op, "x", v, kind=StructType.fromDDL("x double")["x"].dataType)
            hit = [f(x, v) for x in xs]
            assert e.may_match(s) or not any(hit), (op, v, xs)
            assert not e.must_match(s) or all(hit), (op, v, xs)


def test_prefix_bounds():
    s = {"s": {"rows": 2, "nulls": 0, "lower": "abc", "upper": "abz"}}
    assert not starts_with("s", "ac").may_match(s) and starts_with("s", "ab").must_match(s) and not (~starts_with("s", "ab")).may_match(s) and (~starts_with("s", "b")).must_match(s) and starts_with("s", "abcd").may_match(s)
    assert not intersects("g", 0, 0, 1, 1).may_match({"g": {"rows": 1, "nulls": 0, "min_x": 2.0, "min_y": 0.0, "max_x": 3.0, "max_y": 1.0}})
    assert shortened("abcdef", 3, True) == "abd" and shortened("abcdef", 3, False) == "abc" and shortened(b"\xff\xff\xff\xff", 3, True) is None and shortened("a\U0010ffffx", 2, True) == "b"


def test_expression_json():
    e = any_of(all_of(compare("a", "<", 5), ~starts_with("s", "x")), not_in("b", [1, 2]), compare("t", "=", 3, fn="bucket[8]"), unary("f", "is_nan"))
    assert from_json(e.to_json()) == e and from_json("true") == TRUE and from_json('{"type": "not", "child": {"type": "eq", "term": "a", "value": 1}}') == compare("a", "!=", 1)
    assert "secret" not in str(compare("s", "=", "secret").sanitised())
    with pytest.raises(ValueError):
        from_json('{"type": "sounds-like", "term": "a"}')


def test_projection_keeps_every_match():
    rng = np.random.default_rng(1)
    kinds = StructType.fromDDL("i int, d date, s string, x decimal(8,2), t timestamp_ntz")
    make = {
        "i": lambda: int(rng.integers(-30, 30)), "d": lambda: dt.date(1970, 1, 1) + dt.timedelta(int(rng.integers(-900, 900))), "s": lambda: "".join(rng.choice(list("abc"), int(rng.integers(1, 5)))),
        "x": lambda: Decimal(int(rng.integers(-900, 900))).scaleb(-2).quantize(Decimal("0.01")), "t": lambda: dt.datetime(1970, 1, 1) + dt.timedelta(minutes=int(rng.integers(-90000, 90000))),
    }
    for c, ts in (("i", ("identity", "bucket[4]", "truncate[7]")), ("d", ("year", "month", "day", "bucket[5]")), ("s", ("truncate[2]", "bucket[3]")), ("x", ("truncate[50]", "bucket[6]")), ("t", ("hour", "day", "month"))):
        for t in ts:
            for _ in range(40):
                op = str(rng.choice(["=", "<", "<=", ">", ">=", "!=", "in", *(["starts_with"] if c == "s" else [])]))
                v, row = (make[c](), make[c]()) if op == "in" else make[c](), make[c]()
                e = Expr(op, c, v).bind(kinds)
                hit = {"=": lambda: row == v, "<": lambda: row < v, "<=": lambda: row <= v, ">": lambda: row > v, ">=": lambda: row >= v, "!=": lambda: row != v, "in": lambda: row in v, "starts_with": lambda: row.startswith(v)}[op]()  # noqa: B023
                p = transforms.value_of(t, row, kinds[c].dataType)
                keep = project(e, t, "p", kinds[c].dataType).may_match({"p": {"rows": 1, "nulls": 0, "nan": 0, "lower": p, "upper": p}})
                assert keep or not hit, (c, t, op, v, row, p)


# Tables


def test_a_root_with_a_blank_and_names_with_dots(spark, tmp_path):
    t = table(spark, tmp_path / "a b%c", "`a.b` int, `c``d` string, p string", [(1, "x", "u v/w=%"), (2, "y", ""), (3, "z", None)], partition=["p"])
    assert got(t.scan().filter(compare("a.b", ">", 1)).to_df()) == [(2, "y", ""), (3, "z", None)]
    assert got(t.scan().filter(compare("p", "=", "u v/w=%")).to_df()) == [(1, "x", "u v/w=%")] and got(t.scan().filter(unary("p", "is_null")).to_df()) == [(3, "z", None)]
    t.delete(compare("a.b", "=", 1), mode="merge-on-read")
    assert t.scan().to_df().count() == 2 and t.scan().count() == 2


def test_lineage_that_has_expired_is_an_error(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int", [(1,)])
    t.append(spark.createDataFrame([(2,)], "id int"))
    last = t.head()["id"]
    t.expire(older_than_ms=1 << 60)
    for f in (lambda: t.changes(), lambda: t.appended(None), lambda: t.changes(7)):
        with pytest.raises(ValueError):
            f()
    t.append(spark.createDataFrame([(3,)], "id int"))
    assert got(t.appended(last)) == [(3,)] and got(t.scan().to_df()) == [(1,), (2,), (3,)]


def test_schema_changes_are_checked(spark, tmp_path):
    t = table(spark, tmp_path / "t", "a int, b string, s struct<x: int, y: string>", [(1, "u", (2, "v"))], partition=["b"])
    for change in (lambda u: u.rename("a", "b"), lambda u: u.rename("none", "x"), lambda u: u.drop("none"), lambda u: u.add("A", StructType.fromDDL("x int")["x"].dataType), lambda u: u.drop("b"), lambda u: u.change("a", StructType.fromDDL("x string")["x"].dataType), lambda u: u.add("r", StructType.fromDDL("x int")["x"].dataType, required=True), lambda u: u.move("a", after="a"), lambda u: u.identify(["a"])):
        with pytest.raises(ValueError):
            t.evolve(change)
    kind = StructType.fromDDL("x bigint, l array<struct<p: int>>")
    t.evolve(lambda u: u.change("a", kind["x"].dataType).rename(("s", "y"), "z").add(("s", "n"), kind["x"].dataType, default=9).add("l", kind["l"].dataType).move("s", first=True))
    t.append(spark.createDataFrame([((5, "w", 1), 1 << 40, "u", [(3,)])], "s struct<x: int, z: string, n: bigint>, a bigint, b string, l array<struct<p: int>>"))
    assert t.schema().fieldNames() == ["s", "a", "b", "l"]
    assert got(t.scan().to_df()) == sorted([((2, "v", 9), 1, "u", None), ((5, "w", 1), 1 << 40, "u", [(3,)])], key=str)
    t.evolve(lambda u: u.add(("l", "element", "q"), kind["x"].dataType))
    assert [r.l for r in t.scan().filter(compare("a", ">", 5)).to_df().collect()] == [[(3, None)]]
    assert len(schemas.by_id(t.full_schema())) == 9


def test_union_mapping_and_pruning():
    n = iter(range(1, 99))
    s = schemas.with_ids(StructType.fromDDL("a int, s struct<x: int>, l array<struct<y: int>>"), lambda: next(n))
    u = schemas.Update(s, 20).union(StructType.fromDDL("a bigint, s struct<x: int, z: string>, m double"))
    assert schemas.plain(u.schema).simpleString() == "struct<a:bigint,s:struct<x:int,z:string>,l:array<struct<y:int>>,m:double>"
    with pytest.raises(ValueError):
        schemas.Update(s, 20).union(StructType.fromDDL("a string"))
    assert schemas.Update(u.schema, 30).union(StructType.fromDDL("a int")).schema["a"].dataType.simpleString() == "bigint"
    m = schemas.name_mapping(s)
    renamed = schemas.Update(s, 20).rename("a", "b").schema
    m = schemas.updated_mapping(m, renamed)
    assert m[0]["names"] == ["a", "b"] and schemas.mapped(StructType.fromDDL("a int, zz int"), m)["a"].metadata["id"] == 1
    assert schemas.plain(schemas.pruned(s, {s["s"].dataType["x"].metadata["id"]})).simpleString() == "struct<s:struct<x:int>>"


def test_conflicts(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int", [(1,), (2,)])
    late = Table.load(spark, t.root)
    t.append(spark.createDataFrame([(3,)], "id int"))
    count = lambda: len(list((tmp_path / "t" / "data").rglob("*.parquet")))
    before = count()
    with pytest.raises(CommitConflict):
        late.append(spark.createDataFrame([(4,)], "id int"))
    assert count() == before and not list((tmp_path / "t" / "metadata").glob("staged-*"))
    late.append(spark.createDataFrame([(5,)], "id int"))  # the handle stands at the latest version again
    assert got(late.scan().to_df()) == [(1,), (2,), (3,), (5,)]
    late.set_properties({"commit.retry.num-retries": "2", "commit.retry.min-wait-ms": "1"})
    t.refresh()
    # A delete goes on top of rows that it would not have touched, but not of others; and never of files that are gone.
    for new, ok in ((50, True), (1, False)):
        tx = t.refresh().transaction()
        tx.delete(compare("id", "<", 3))
        Table.load(spark, t.root).append(spark.createDataFrame([(new,)], "id int"))
        if ok:
            tx.commit()
            assert got(t.scan().to_df()) == [(3,), (5,), (50,)]
        else:
            with pytest.raises(CommitConflict):
                tx.commit()
    tx = t.refresh().transaction()
    tx.delete(compare("id", "=", 3), mode="merge-on-read")
    Table.load(spark, t.root).compact()
    with pytest.raises(CommitConflict):
        tx.commit()
    tx = t.refresh().transaction()
    tx.evolve(lambda u: u.rename("id", "key"))
    Table.load(spark, t.root).add_column("x", "int")
    with pytest.raises(CommitConflict):
        tx.commit()
    t.refresh().set_properties({"write.delete.isolation-level": "snapshot"})
    tx = t.transaction()
    tx.delete(compare("id", "=", 50))
    Table.load(spark, t.root).append(spark.createDataFrame([(50, 1)], "id int, x int"))
    tx.commit()
    assert got(t.scan().filter(compare("id", "=", 50)).to_df()) == [(50, 1)]


def test_claims_are_atomic(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int")
    assert not t.files.claim("metadata/v0.json", "{}") and json.loads(t.files.read("metadata/v0.json"))["version"] == 0
    with pytest.raises(ValueError):
        table(spark, tmp_path / "t", "id int")


def test_branches_start_at_main(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int", [(1,)])
    t.append(spark.createDataFrame([(2,)], "id int"), branch="b")
    assert got(t.scan().use(ref="b").to_df()) == [(1,), (2,)] and got(t.scan().to_df()) == [(1,)]
    t.tag("v")
    with pytest.raises(ValueError):
        t.append(spark.createDataFrame([(2,)], "id int"), branch="v")
    with pytest.raises(ValueError):
        t.rollback(t.head("b")["id"])


ROWS = [(dt.date(2023, 3, n), dt.datetime(2023, 3, n, n), n, "abcdefghijkl"[n - 1]) for n in range(1, 13)]


@pytest.mark.parametrize("spec", ["ts", ("dt", "year"), ("dt", "month"), ("ts", "day"), ("ts", "hour"), ("letter", "truncate[1]"), ("number", "bucket[16]")], ids=str)
def test_partitioned_tables(spark, tmp_path, spec):
    t = table(spark, tmp_path / "t", "dt date, ts timestamp_ntz, number int, letter string", ROWS, partition=[spec])
    for e in (compare("number", ">=", 5), compare("letter", ">=", "e"), compare("dt", ">=", "2023-03-05"), compare("ts", ">=", "2023-03-05T00:00:00")):
        assert [r.number for r in t.scan().filter(e).to_df().orderBy("number").collect()] == list(range(5, 13))
    one = t.scan().filter(compare("ts", "=", ROWS[4][1]))
    assert one.to_df().count() == 1 and (spec == ("number", "bucket[16]") or one.plan_files().count() == 1)
    assert t.inspect("partitions").agg(F.sum("record_count")).first()[0] == 12
    t.overwrite(spark.createDataFrame([(dt.date(2023, 3, 5), ROWS[4][1], 99, "e")], t.schema()), compare("number", "=", 5))
    assert sorted(r.number for r in t.scan().to_df().collect()) == [1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12, 99]


def test_specs_evolve(spark, tmp_path):
    t = table(spark, tmp_path / "t", "dt date, ts timestamp_ntz, number int, letter string", ROWS, partition=[("dt", "month")])
    for add in (("dt", "day"), ("letter", "identity", "dt_month"), ("none", "identity")):
        with pytest.raises(ValueError):
            t._one(lambda x: x.repartition(add=[add]))  # noqa: B023
    t._one(lambda x: x.repartition(add=[("number", "bucket[2]")], remove=["dt_month"]))
    t.append(spark.createDataFrame(ROWS, t.schema()))
    assert t.scan().filter(compare("number", "=", 3)).to_df().count() == 2 and t.scan().filter(compare("dt", "=", "2023-04-01")).plan_files().count() == 0
    assert t.inspect("partitions").count() == 3


def test_partition_residual_of_null_and_nan(spark, tmp_path):
    rows = [(None, True), (float("nan"), True), (1.0, False), (2.0, True)]
    t = table(spark, tmp_path / "t", "id double, flag boolean not null", rows, partition=["id"])
    df = spark.createDataFrame(rows, "id double, flag boolean")
    for e in (compare("id", "=", 1.0), compare("id", "!=", 1.0), compare("id", "<", 2.0), unary("id", "is_null"), unary("id", "is_nan"), is_in("id", [1.0, 2.0]), not_in("id", [1.0, 5.0])):
        for f in (e, ~e, all_of(e, compare("flag", "=", True)), ~all_of(e, compare("flag", "=", True)), ~any_of(e, compare("flag", "=", False))):
            want = df.where(f.bind(df.schema).column(df.schema))
            assert got(t.scan().filter(f).to_df().select("flag")) == got(want.select("flag")), f


def test_bounds_of_dates_and_decimals_prune(spark, tmp_path):
    t = table(spark, tmp_path / "t", "d date, t timestamp, x decimal(10,2), s string, b binary")
    for n in (1, 2, 3):
        t.append(spark.createDataFrame([(dt.date(2020, n, 1), dt.datetime(2020, n, 1, 5), Decimal(n), "x" * 30 + str(n), bytes([n]) * 20)], t.schema()).coalesce(1))
    for e, files in ((compare("d", ">", "2020-02-01"), 1), (compare("t", "<", "2020-02-01T00:00:00"), 1), (compare("x", "=", 2), 1), (compare("s", "=", "x" * 30 + "2"), 3), (compare("b", "=", bytes([2]) * 20), 1)):
        assert t.scan().filter(e).plan_files().count() == files and t.scan().filter(e).to_df().count() == 1, e
    t.set_properties({"write.metadata.metrics.column.s": "full", "write.metadata.metrics.column.x": "none"})
    t.compact(partitions=1)
    assert t.scan().filter(compare("s", ">", "x" * 31)).plan_files().count() == 0 and t.scan().filter(compare("x", "=", 77)).plan_files().count() == 1


@pytest.mark.parametrize("version", ["2", "3"])
def test_many_deleted_positions_are_not_broadcast(spark, tmp_path, version):
    t = Table.create(spark, str(tmp_path / "t"), spark.range(1).schema, properties={"format-version": version})
    t.append(spark.range(0, 100_000, 1, 1))
    t.delete(compare("id", "<", 90_000), mode="merge-on-read")
    df = t.scan().to_df()
    assert sorted(r.id for r in df.collect()) == list(range(90_000, 100_000))
    assert [("strategy=merge" in x) for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftAnti" in x] == [True]


@pytest.mark.parametrize("version", ["2", "3"])
def test_merged_deletes(spark, tmp_path, version):
    t = table(spark, tmp_path / "t", "dt date, ts timestamp_ntz, number int, letter string", ROWS, partition=[("dt", "year")], properties={"format-version": version, "write.delete.mode": "merge-on-read"})
    t.delete(compare("number", "=", 9))
    t.delete(compare("letter", "=", "f"))
    t.delete(compare("number", "=", 9))
    assert sorted(r.number for r in t.scan().to_df().collect()) == [1, 2, 3, 4, 5, 7, 8, 10, 11, 12]
    assert t.inspect("position_deletes").count() == 2 and t.inspect("delete_files").count() == (2 if version == "2" else 1)
    t.append(spark.createDataFrame(ROWS[8:9], t.schema()))
    assert t.scan().filter(compare("number", "=", 9)).to_df().count() == 1
    maintenance.compact(t)
    assert t.inspect("delete_files").count() == 0 and t.scan().to_df().count() == 11 and t.scan().count() == 11
    t.delete(compare("number", ">", 0))
    assert t.scan().to_df().count() == 0


def test_keys_of_null_and_sequences(spark, tmp_path):
    t = table(spark, tmp_path / "t", "k int, v string, f double", [(1, "a", 1.0), (None, "b", 2.0), (2, "c", 3.0)])
    t.delete_keys(spark.createDataFrame([(1,), (None,)], "k int"))
    t.append(spark.createDataFrame([(1, "new", 0.0)], t.schema()))
    assert got(t.scan().select("k", "v").to_df()) == [(1, "new"), (2, "c")]
    before = t.meta["version"]
    t.delete_keys(spark.createDataFrame([], "k int"))
    assert t.meta["version"] == before
    for key, bad in ((1.0, "f double"), (1, "none int")):
        with pytest.raises(ValueError):
            t.delete_keys(spark.createDataFrame([(key,)], bad))
    with pytest.raises(ValueError):
        t.changes()
    t.row_delta(rows=spark.createDataFrame([(2, "d", 0.0)], t.schema()), keys=spark.createDataFrame([(2,)], "k int"))
    assert got(t.scan().select("k", "v").to_df()) == [(1, "new"), (2, "d")] and t.head()["summary"]["total-equality-deletes"] == 3


def test_vectors_round_trip():
    rng = np.random.default_rng(5)
    for p in ([], [0], [5, 1 << 33, (1 << 33) + 70000], rng.integers(0, 1 << 20, 20000), np.arange(70000)):
        raw = vectors.dump(np.array(p, np.int64))
        assert (vectors.load(raw) == np.unique(np.array(p, np.int64))).all() and raw[4:8] == bytes.fromhex("D1D33964") and int.from_bytes(raw[-4:], "big") == zlib.crc32(raw[4:-4])
    broken = bytearray(vectors.dump(np.array([1, 2, 3])))
    broken[12] ^= 1
    for bad in (bytes(broken), b"", b"x" * 40):
        with pytest.raises(ValueError):
            vectors.load(bad)
    runs = bytes.fromhex("3b300000 01 0000 0400 0100 0a00 0400".replace(" ", ""))  # one group, one run: 10 to 14
    assert vectors._loaded32(memoryview(runs))[0].tolist() == [10, 11, 12, 13, 14]


def test_vectors_are_packed_as_rows_come(spark):
    rows = spark.range(0, 60_000, 1, 3).select(F.concat(F.lit("f"), F.col("id") % 3).alias("path"), (F.col("id") * 7 % 60_000 + F.when(F.col("id") % 4 == 0, 1 << 24).otherwise(0)).alias("pos"))
    made = vectors.vectors(rows.unionByName(rows.limit(100)), "path", "pos")
    back = vectors.positions(made.withColumn("n", F.lit(None).cast("int")), "vector")
    assert back.columns == ["file_path", "cardinality", "n", "pos"] and got(back.select("file_path", "pos")) == got(rows)
    assert got(made.select("file_path", "cardinality")) == sorted([(f"f{i}", n) for i in range(3) for n in (5_000, 15_000)], key=str)
    plans = [df._jdf.queryExecution().sparkPlan().toString() for df in (made, back)]
    assert not any("InPandas" in x for x in plans) and "Generate explode" in plans[1]  # no worker gets all rows of a span at once
    assert vectors.vectors(rows.limit(0), "path", "pos").count() == 0
    for bad in (-1, None):
        with pytest.raises(Exception, match="a position cannot be"):
            vectors.vectors(spark.createDataFrame([("f", 1), ("f", bad)], "path string, pos long"), "path", "pos").collect()


def test_blobs_round_trip():
    given = [{"type": "a", "fields": [1], "data": b"xyz", "properties": {"k": "v"}}, {"type": "b", "fields": [], "data": b""}]
    for zipped in (False, True):
        raw = blobs.write_blobs(given, {"made": "here"}, zipped)
        back = blobs.read_blobs(raw)
        assert [(b["type"], b["data"]) for b in back] == [("a", b"xyz"), ("b", b"")] and blobs.read_footer(raw)["properties"] == {"made": "here"}
    for bad in (raw[:-1], b"", raw[4:], raw[:-12] + b"\xff" * 8 + raw[-4:]):
        with pytest.raises(ValueError):
            blobs.read_blobs(bad)


def test_packing():
    sizes = [5, 5, 6, 4, 9, 1, 30]
    for far, big in ((10, False), (1, False), (2, True)):
        bins = maintenance.pack(sizes, lambda x: x, 10, far, big)
        assert sorted(x for b in bins for x in b) == sorted(sizes) and all(sum(b) <= 10 or len(b) == 1 for b in bins)


def test_files_expire_and_orphans_go(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int", [(1,)])
    t.overwrite(spark.createDataFrame([(2,)], "id int").coalesce(1))
    t.append(spark.createDataFrame([(3,)], "id int").coalesce(1), branch="b")
    files = lambda: sorted(str(p) for p in (tmp_path / "t" / "data").rglob("*.parquet"))
    assert len(files()) == 3 and t.expire(older_than_ms=1 << 60) == 1 and len(files()) == 2
    assert got(t.scan().to_df()) == [(2,)] and got(t.scan().use(ref="b").to_df()) == [(2,), (3,)] and t.inspect("all_data_files").count() == 2
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "t" / "data" / "lost"))
    found = maintenance.orphans(t, older_than_ms=1 << 60)
    assert found.where("file_path like '%/lost/%'").count() == 1 and len(files()) == 3
    maintenance.orphans(t, older_than_ms=1 << 60, dry_run=False)
    assert len(files()) == 2 and got(t.scan().to_df()) == [(2,)] and got(t.scan().use(ref="b").to_df()) == [(2,), (3,)]
    t.refresh().append(spark.createDataFrame([(4,)], "id int"))
    maintenance.purge(t)
    assert not (tmp_path / "t").exists()


def test_refs_expire_by_their_own_rules(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int", [(1,)])
    t.tag("old", max_ref_age_ms=1)
    t.tag("kept")
    for n in (2, 3, 4):
        t.append(spark.createDataFrame([(n,)], "id int"))
    assert t.expire(older_than_ms=1 << 60, keep_last=2) == 1 and set(t.meta["refs"]) == {"main", "kept"} and len(t.meta["snapshots"]) == 3
    assert got(t.scan().use(ref="kept").to_df()) == [(1,)]


def test_added_files(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id bigint, p string", [(1, "a")], partition=["p"])
    spark.createDataFrame([(2, "b"), (3, "b")], "id bigint, p string").coalesce(1).write.parquet(str(tmp_path / "x"))
    paths = [str(p) for p in (tmp_path / "x").glob("*.parquet")]
    t.add_files(paths)
    assert got(t.scan().filter(compare("p", "=", "b")).to_df()) == [(2, "b"), (3, "b")] and t.inspect("partitions").count() == 2
    with pytest.raises(ValueError):
        t.add_files(paths)
    spark.createDataFrame([(2, "b"), (3, "c")], "id bigint, p string").coalesce(1).write.parquet(str(tmp_path / "y"))
    with pytest.raises(Exception, match="more than one p"):
        t.add_files([str(p) for p in (tmp_path / "y").glob("*.parquet")])
    spark.createDataFrame([("x",)], "id string").coalesce(1).write.parquet(str(tmp_path / "z"))
    with pytest.raises(ValueError):
        t.add_files([str(p) for p in (tmp_path / "z").glob("*.parquet")])


def test_defaults_required_and_sorted_writes(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int not null, s string", order=[("s", "desc", "last")])
    with pytest.raises(Exception, match="required column id"):
        t.append(spark.createDataFrame([(None, "x")], "id int, s string"))
    with pytest.raises(ValueError):
        t.append(spark.createDataFrame([(1, 2)], "id int, more int"))
    t.append(spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, s string").coalesce(1))
    t.evolve(lambda u: u.add("n", StructType.fromDDL("x int")["x"].dataType, required=True, default=7).change("n", default=8))
    t.append(spark.createDataFrame([(4,)], "id int"))
    assert got(t.scan().to_df()) == sorted([(1, "a", 7), (2, None, 7), (3, "c", 7), (4, None, 8)], key=str)
    file = t.inspect("files").where("record_count = 3").first()["file_path"]
    assert [r.s for r in spark.read.parquet(file.replace("file://", "")).collect()] == ["c", "a", None]


def test_rows_keep_their_ids(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int", [(i,) for i in range(6)], properties={"format-version": "3"})
    t.append(spark.createDataFrame([(i,) for i in range(6, 9)], "id int").coalesce(1))
    ids = lambda: {r.id: (r._row_id, r._last_updated_sequence_number) for r in t.scan().with_lineage().to_df().collect()}
    before = ids()
    assert sorted(v[0] for v in before.values()) == list(range(9))
    t.delete(compare("id", "=", 3))
    t.compact()
    assert ids() == {k: v for k, v in before.items() if k != 3}
    t.append(spark.createDataFrame([(20,)], "id int"))
    assert ids()[20][0] not in {v[0] for v in before.values()}
    old = ids()[20][0]
    t.row_delta(rows=spark.createDataFrame([(21, old), (22, None)], "id int, _row_id long"), keys=spark.createDataFrame([(20,)], "id int"))
    now = ids()
    assert 20 not in now and now[21][0] == old and now[22][0] not in {v[0] for k, v in now.items() if k != 22}
    with pytest.raises(ValueError):
        t.set_properties({"format-version": "2"})


def test_manifests_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int", [(0,)], properties={"commit.manifest-merge.enabled": "true", "commit.manifest.min-count-to-merge": "3"})
    for n in range(1, 6):
        t.append(spark.createDataFrame([(n,)], "id int").coalesce(1))
    assert t.inspect("manifests").count() <= 3 and got(t.scan().to_df()) == [(n,) for n in range(6)]
    first = t.meta["snapshots"][0]["id"]
    maintenance.rewrite_manifests(t, target=2)
    assert got(t.scan().to_df()) == [(n,) for n in range(6)] and got(t.appended(first)) == [(n,) for n in range(1, 6)] and t.inspect("manifests").count() == 3
    t.delete(compare("id", "=", 2))
    assert t.inspect("all_manifests").count() > 6 and t.inspect("all_entries").count() >= 6 and t.head()["summary"]["total-records"] == 5


def test_limits_plan_few_files(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int", [(n,) for n in range(10)])
    t.append(spark.createDataFrame([(n,) for n in range(100)], "id int").coalesce(1))
    assert t.scan().limit(5).plan_files().count() == 1 and t.scan().limit(5).to_df().count() == 5 and t.scan().limit(105).plan_files().count() == 2
    assert t.scan().limit(5).filter(compare("id", "<", 3)).plan_files().count() == 2
    schema, rows = t.scan().option("spark.sql.files.maxPartitionBytes", 1 << 20).records()
    assert schema.fieldNames() == ["id"] and sum(1 for _ in rows) == 110 and t.scan().to_arrow().num_rows == 110
    tasks = t.scan().plan_files()
    assert t.scan().read(tasks.where("record_count = 10")).count() == 10


@pytest.mark.parametrize("kind", ["folder", "sqlite"])
def test_catalogs(spark, tmp_path, kind):
    c = FolderCatalog(spark, str(tmp_path / "w")) if kind == "folder" else SqliteCatalog(spark, str(tmp_path / "c.db"), str(tmp_path / "w"))
    c.create_namespace("a", {"k": "v"})
    c.create_namespace("a.b")
    s = StructType.fromDDL("id int")
    t = c.create_table("a.t", s)
    t.append(spark.createDataFrame([(1,)], "id int"))
    assert c.list_tables("a") == [("a", "t")] and c.list_namespaces("a") == [("a", "b")] and c.list_namespaces() == [("a",)] and c.load_table("a.t").scan().to_df().count() == 1
    for bad in (lambda: c.create_table("a.t", s), lambda: c.load_table("a.none"), lambda: c.create_table("none.t", s), lambda: c.drop_namespace("a"), lambda: c.create_namespace("a"), lambda: c.load_view("a.t"), lambda: c.create_table("a.../x", s)):
        with pytest.raises(ValueError):
            bad()
    assert c.update_namespace("a", {"x": "y"}, ["k", "z"]) == {"updated": ["x"], "removed": ["k"], "missing": ["z"]} and c.namespace_properties("a") == {"x": "y"}
    v = c.create_view("a.v", "select 1 as n", StructType.fromDDL("n int"))
    v.replace({"spark": "select 2 as n", "other": "SELECT 2 n"}, StructType.fromDDL("n int"))
    stale = c.load_view("a.v")
    v.use_version(0)
    assert got(c.load_view("a.v").to_df()) == [(1,)] and len(v.doc["versions"]) == 2 and c.list_views("a") == [("a", "v")]
    with pytest.raises(CommitConflict):
        stale.set_properties(x="y")
    f = c.create_function("a.twice_it", [("x", "int")], "int", "x * 2", on_null="return-null")
    name = f.install()
    assert got(spark.sql(f"select {name}(4), {name}(null)")) == [(8, None)] and c.list_functions("a") == [("a", "twice_it")]
    c.create_function("a.up_to", [("n", "int")], "i int", "SELECT id AS i FROM range(10) WHERE id < n", kind="udtf").install()
    assert spark.sql("select * from up_to(3)").count() == 3
    with pytest.raises(ValueError):
        c.create_function("a.bad", [], "int", "1", on_null="maybe")
    u = c.create_table("a.u", s)
    tx = c.transaction()
    tx.table("a.t").append(spark.createDataFrame([(2,)], "id int"))
    tx.table("a.u").append(spark.createDataFrame([(3,)], "id int"))
    tx.commit()
    assert c.load_table("a.t").scan().to_df().count() == 2 and c.load_table("a.u").scan().to_df().count() == 1
    tx = c.transaction()
    tx.table("a.t").append(spark.createDataFrame([(9,)], "id int"))
    tx.table("a.u").append(spark.createDataFrame([(9,)], "id int"))
    u.refresh().append(spark.createDataFrame([(4,)], "id int"))
    with pytest.raises(CommitConflict):
        tx.commit()
    assert c.load_table("a.t").scan().to_df().count() == 2
    if kind == "sqlite":
        c.rename_table("a.u", "a.b.u")
        c.register_table("a.again", t.root)
        assert c.table_exists("a.b.u") and not c.table_exists("a.u") and c.load_table("a.again").scan().to_df().count() == 2
    c.drop_view("a.v")
    c.drop_function("a.twice_it")
    c.purge_table("a.t")
    assert not c.table_exists("a.t") and not c.list_views("a")


def test_streams_handle_every_append_once(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int", [(1,)])
    seen = []
    s = AppendStream(spark, t.root, str(tmp_path / "c"), max_snapshots=1)
    assert s.available(lambda df, n: seen.append((n, got(df)))) == 1
    t.append(spark.createDataFrame([(2,)], "id int"))
    t.append(spark.createDataFrame([(3,)], "id int"))

    def fails(df, n):
        raise RuntimeError("half-way")

    with pytest.raises(RuntimeError):
        AppendStream(spark, t.root, str(tmp_path / "c"), max_snapshots=1).available(fails)
    assert AppendStream(spark, t.root, str(tmp_path / "c"), max_snapshots=1).available(lambda df, n: seen.append((n, got(df)))) == 2
    assert seen == [(0, [(1,)]), (1, [(2,)]), (2, [(3,)])] and s.available(fails) == 0


def test_command_line(spark, tmp_path):
    from tabulon.cli import run

    go = lambda *a: run(spark, ["--warehouse", str(tmp_path), *a])
    go("create-namespace", "a")
    go("create", "a.t", "id int, p string", "--partition", "p", "id:bucket[4]")
    t = FolderCatalog(spark, str(tmp_path)).load_table("a.t")
    t.append(spark.createDataFrame([(1, "x")], "id int, p string"))
    go("tag", "a.t", "v1")
    go("set", "a.t", "k", "v")
    assert go("list", "--parent", "a") == ["a.t"] and go("properties", "a.t") == [{"k": "v"}] and len(go("files", "a.t")) == 1 and {r["name"] for r in go("refs", "a.t")} == {"main", "v1"}
    assert go("describe", "a.t")[0]["summary"]["total-records"] == 1 and go("snapshots", "a.t")[0]["operation"] == "append" and go("compact", "a.t", "--dry-run")[0]["files"] == 0
    go("drop", "a.t")
    assert go("list", "--parent", "a") == []


def test_statistics_files(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int, s string", [(n, "ab"[n % 2]) for n in range(50)])
    assert maintenance.distinct_counts(t, ["id", "s"]) == {"id": 50, "s": 2}
    path = t.meta["statistics"][0]["path"]
    assert [b["type"] for b in blobs.read_blobs(t.files.read_bytes(path))] == ["theta-sketch", "theta-sketch"]
    maintenance.remove_statistics(t, t.head()["id"])
    assert t.meta["statistics"] == []


def test_reports_and_tasks_as_bytes(spark, tmp_path):
    from tabulon.sources.reports import commit_report, decode_tasks, encode_tasks, reported, scan_report

    t = table(spark, tmp_path / "t", "id int, s string", [(n, "secret") for n in range(10)])
    t.append(spark.createDataFrame([(n, "b") for n in range(100, 105)], "id int, s string").coalesce(1))
    t.delete(compare("id", "=", 101), mode="merge-on-read")
    s = t.scan().filter(all_of(compare("id", ">", 50), not_in("s", ["secret", "x"])))
    r = scan_report(s)
    assert r["metrics"]["result-data-files"] == 1 and r["metrics"]["skipped-data-files"] == 1 and r["metrics"]["files-with-deletes"] == 1 and "secret" not in r["filter"]
    assert commit_report(t)["operation"] == "delete" and commit_report(t)["metrics"]["added-position-deletes"] == 1
    seen = []
    assert reported(s, seen.append).count() == 4 and len(seen) == 1
    scan, tasks = decode_tasks(spark, encode_tasks(s, s.plan_files()))
    assert got(scan.read(tasks)) == got(s.to_df()) and scan.read(tasks).count() == 4


def test_boxes_of_shapes(spark):
    import struct

    from tabulon.functions import geo

    point = lambda x, y, o="<": struct.pack(o + "BIdd", int(o == "<"), 1, x, y)
    line = struct.pack("<BII4d", 1, 2, 2, 0, 1, 5, -3)
    tall = struct.pack("<BII6d", 1, 1002, 2, 0, 1, 99, 5, -3, 99)
    area = struct.pack("<BIII6d", 1, 3, 1, 3, 0, 0, 4, 0, 0, 4)
    several = struct.pack("<BII", 1, 7, 2) + point(9, 9, ">") + area
    for raw, want in ((point(1, 2), (1, 2, 1, 2)), (point(1, 2, ">"), (1, 2, 1, 2)), (line, (0, -3, 5, 1)), (tall, (0, -3, 5, 1)), (area, (0, 0, 4, 4)), (several, (0, 0, 9, 9)), (None, None), (b"", None), (b"\1\2", None), (point(float("nan"), float("nan")), None), (struct.pack("<BII", 1, 4, 0), None)):
        assert geo.box_of(raw) == want
    df = spark.createDataFrame([("a", bytearray(line)), ("a", bytearray(point(7, 7))), ("b", None)], "k string, g binary")
    assert got(geo.bounds(df, "g", "k")) == sorted([("a", 0.0, -3.0, 7.0, 7.0), ("b", None, None, None, None)], key=str)


def test_documents_are_sealed(spark):
    from tabulon.sources.encryption import Envelope, MemoryKeyService, Plaintext

    service = MemoryKeyService(spark, {"k": b"0" * 16})
    e = Envelope(spark, service, "k")
    raw = e.encrypt(b"hello", b"about")
    assert b"hello" not in raw and e.decrypt(raw, b"about") == b"hello" and Plaintext().decrypt(b"x") == b"x"
    for bad, about in ((raw, b"other"), (raw[:-1] + bytes([raw[-1] ^ 1]), b"about"), (b"", b"")):
        with pytest.raises(ValueError):
            e.decrypt(bad, about)
    with pytest.raises(ValueError):
        Envelope(spark, service, "none").encrypt(b"x")


def test_one_row_at_a_time():
    nan = float("nan")
    row = {"a": None, "b": 3, "f": nan, "s": "abc"}
    for e, want in ((compare("a", "<", 1), True), (compare("a", "=", 1), False), (compare("a", "!=", 1), True), (compare("f", ">", 1e300), True), (compare("f", "=", nan), True), (is_in("a", [1, 2]), False), (not_in("a", [1, 2]), True), (starts_with("s", "ab"), True), (starts_with("a", "ab"), False), (unary("f", "is_nan"), True), (all_of(compare("b", ">=", 3), unary("a", "is_null")), True), (~compare("b", ">=", 3), False)):
        assert e.holds(row) is want, e
    n = iter(range(1, 9))
    s = schemas.with_ids(StructType.fromDDL("a int, s struct<x: int>, b int"), lambda: next(n))
    assert any_of(compare("s.x", "=", 1), compare("b", "<", 2)).field_ids(s) == {3, 4}
    assert [(i, x is not None, y is not None) for i, x, y in schemas.paired(s, schemas.Update(s, 8).drop("a").add("c", s["a"].dataType).schema)] == [(1, True, False), (2, True, True), (3, True, True), (4, True, True), (9, False, True)]


def test_splits_planners_and_partition_summaries(spark, tmp_path):
    t = table(spark, tmp_path / "t", "id int, p string", [(n, "ab"[n % 2]) for n in range(2000)], partition=["p", ("id", "truncate[1000]")], properties={"write.summary.partition-limit": "5", "read.split.target-size": "1"})
    s = t.head()["summary"]
    assert s["changed-partition-count"] == "4" and s["partitions.id_truncate_1000=1000/p=b"] == "added-data-files=1,added-records=500,deleted-data-files=0,deleted-records=0"
    splits = t.scan().plan_splits()
    assert splits.count() == 4 and splits.where("start < 4 or length <= 0").count() == 0
    assert t.scan().planned_by(lambda scan: scan.planned_by(None).plan_files().where("partition['p'] = 'a'")).to_df().count() == 1000
