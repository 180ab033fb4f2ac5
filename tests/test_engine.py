from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from tabulon import queries
from tabulon.functions import transforms
from tabulon.operators.deletes import equality_deletes, position_deletes
from tabulon.plans.expressions import FALSE, TRUE, compare, is_in, starts_with, unary
from tabulon.sources.table import Table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "events", "customer"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"select {', '.join(cols)} from ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.select(*cols).collect()), key=str) == sorted(want, key=str)


def test_bucket_known_values(spark):
    """Known hashes of the public Murmur3 bucket definition."""
    one = lambda b: int(transforms.murmur3([b])[0])
    assert one((34).to_bytes(8, "little")) == 2017239379
    assert one(b"hello") == 613153351 and one(b"") == 0
    df = spark.createDataFrame([(34, "hello", Decimal("14.20")), (None, None, None)], "i long, s string, d decimal(9,2)")
    n = 0x7FFFFFFF
    got = df.select(*[transforms.bucket(n, F.col(c), df.schema[c].dataType) for c in "isd"]).collect()
    assert tuple(got[0]) == (2017239379 % n, 613153351 % n, (one((1420).to_bytes(2, "big")) & n) % n)
    assert tuple(got[1]) == (None, None, None)


def test_truncate(spark):
    df = spark.createDataFrame([(-1, "harbour", Decimal("10.65")), (None, None, None)], "i int, s string, d decimal(9,2)")
    got = df.select(*[transforms.truncate(w, F.col(c), df.schema[c].dataType) for c, w in (("i", 10), ("s", 3), ("d", 50))]).collect()
    assert tuple(got[0]) == (-10, "har", Decimal("10.50")) and tuple(got[1]) == (None, None, None)


def test_filters_fold_and_negate():
    x = compare("a", "<", 5)
    assert (x & TRUE) == x and (x & FALSE) == FALSE and (x | TRUE) == TRUE and is_in("a", []) == FALSE and is_in("a", [3]).op == "="
    assert ~~x == x and (~(x & unary("b", "is_null"))).op == "or"
    stats = {"a": {"lower": 5, "upper": 9, "nulls": 0, "rows": 4}}
    assert not x.may_match(stats) and (~x).must_match(stats) and compare("a", "=", 7).may_match(stats)
    assert not starts_with("s", "z").may_match({"s": {"lower": "a", "upper": "m", "nulls": 0, "rows": 1}})


def test_nan_and_null_rows(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "i int, x float")
    types = dict(df.dtypes)
    ids = lambda e: sorted(r.i for r in df.where(e.column(types)).collect())
    assert ids(compare("x", ">", 0.0)) == [3] and ids(compare("x", "!=", 1.0)) == [1]
    assert ids(unary("x", "is_nan")) == [1] and ids(unary("x", "not_nan")) == [3] and ids(unary("x", "not_null")) == [1, 3]


def test_deletes(spark):
    data = spark.createDataFrame([(1, "a", 1), (None, "b", 1), (2, "c", 2)], "k int, v string, seq int")
    gone = spark.createDataFrame([(1, 2), (None, 2), (2, 2)], "k int, seq int")
    assert [r.v for r in equality_deletes(data, gone, ["k"], "seq").collect()] == ["c"]
    rows = spark.createDataFrame([("f", 0), ("f", 1)], "file_path string, pos long")
    assert [r.pos for r in position_deletes(rows, spark.createDataFrame([("f", 0), ("g", 1)], "file_path string, pos long")).collect()] == [1]
    plan = position_deletes(rows, spark.range(9).select(F.lit("f").alias("file_path"), F.col("id").alias("pos")))._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_table_versions(spark, tmp_path):
    t = Table.create(spark, str(tmp_path / "t"), spark.createDataFrame([], "id int, name string").schema)
    t.append(spark.createDataFrame([(i, f"n{i}") for i in range(10)], "id int, name string").coalesce(1))
    first = t.head()["id"]
    t.append(spark.createDataFrame([(i, f"n{i}") for i in range(100, 105)], "id int, name string").coalesce(1))
    t.tag("v1")
    assert t.scan().filter(compare("id", ">", 50)).plan_files().count() == 1
    assert t.scan().use(snapshot_id=first).to_df().count() == 10 and t.appended(first).count() == 5
    t.delete(compare("id", "<", 5))
    assert t.scan().to_df().count() == 10 and t.scan().use(ref="v1").to_df().count() == 15
    t.add_column("extra", "double")
    t.rename_column("name", "label")
    t.promote_column("id", "long")
    assert t.scan().select("label", "extra").to_df().columns == ["label", "extra"] and t.scan().use(ref="v1").to_df().columns == ["id", "name"]
    t.compact()
    t = Table.load(spark, t.root)
    assert t.inspect("files").count() == 1 and t.scan().to_df().count() == 10 and t.inspect("snapshots").count() == 4 and t.inspect("history").where("is_current_ancestor").count() == 4
    t.overwrite(spark.createDataFrame([(1, "x", 1.0)], "id long, label string, extra double"))
    assert t.scan().to_df().count() == 1
    t.rollback(first)
    assert t.scan().to_df().count() == 10
    with pytest.raises(ValueError):
        t.scan().use(snapshot_id=1, ref="v1")
    with pytest.raises(ValueError):
        t.scan().select("none").to_df()


def test_changes(spark, tmp_path):
    t = Table.create(spark, str(tmp_path / "c"), spark.createDataFrame([], "id int").schema)
    assert t.changes().count() == 0
    t.append(spark.createDataFrame([(1,), (2,), (None,)], "id int").coalesce(1))
    first = t.head()["id"]
    t.delete(compare("id", "=", 1))
    t.compact()
    got = sorted(((r._change_ordinal, r._change_type, r.id) for r in t.changes(first).collect()), key=str)
    assert got == sorted([(0, "DELETE", 1), (0, "DELETE", 2), (0, "DELETE", None), (0, "INSERT", 2), (0, "INSERT", None)], key=str)
    assert t.changes().where("_change_ordinal = 0").count() == 3
    with pytest.raises(ValueError):
        t.changes(5)
