"""Registered queries of the table engine. Those over versioned tables write them first, in the shared folder."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .functions import transforms
from .operators.deletes import equality_deletes
from .plans.expressions import Expr, all_of, any_of, compare, extract, from_json, is_in, not_in, starts_with, unary
from .sources import schema as schemas
from .sources.catalog import SqliteCatalog
from .sources.maintenance import compact, expire, plan_compaction, rewrite_manifests
from .sources.table import Table
from .streaming import AppendStream

FLAGSHIP = "scan_filter_project"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _filtered(df: DataFrame, where: Expr) -> DataFrame:
    return df.where(where.bind(df.schema).column(df.schema))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir; in a local one only where Spark runs on this machine alone."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tabulon-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Filters and transforms


def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = all_of(compare("l_quantity", ">=", 30), is_in("l_returnflag", ["A", "R"]))
    return _filtered(_read(spark, sf_dir, "lineitem"), where).select("l_orderkey", "l_linenumber", "l_quantity")


def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = any_of(starts_with("o_orderpriority", "1"), ~compare("o_totalprice", "<", 200000.0))
    return _filtered(_read(spark, sf_dir, "orders"), where).select("o_orderkey", "o_orderpriority", "o_totalprice")


def predicates_negated(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = all_of(~starts_with("o_orderpriority", "1"), not_in("o_orderstatus", ["F", "P"]), compare("o_custkey", "!=", 7), compare("o_orderkey", "<=", 2.5e9), unary("o_orderdate", "not_null"))
    return _filtered(_read(spark, sf_dir, "orders"), where).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def expression_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = '{"type": "not", "child": {"type": "or", "left": {"type": "lt", "term": "o_totalprice", "value": 100000}, "right": {"type": "in", "term": "o_orderstatus", "values": ["F", "P"]}}}'
    where = from_json(from_json(text).to_json())
    return _filtered(_read(spark, sf_dir, "orders"), where).select("o_orderkey", "o_orderstatus", "o_totalprice")


def transform_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = all_of(compare("ts", ">=", 648, fn="month"), compare("event_type", "!=", "c", fn="truncate[1]"))
    return _filtered(_read(spark, sf_dir, "events"), where).select("event_id", "event_type")


def nested_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "customer").select("c_custkey", F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_acctbal").alias("balance")).alias("account")).alias("who"))
    return _filtered(df, compare("who.account.balance", ">", 0)).select("c_custkey", F.col("who.name").alias("name"))


def variant_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "events").select("event_id", F.parse_json(F.to_json(F.struct("user_id", F.struct("event_type").alias("kind")))).alias("v"))
    where = all_of(compare("v", ">", 50, fn=extract("$.user_id", "bigint")), starts_with("v", "c", fn=extract("$.kind.event_type", "string")))
    return _filtered(df, where).select("event_id")


def time_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "events")
    made = [transforms.apply(t, F.col("ts"), df.schema["ts"].dataType).alias(f"ts_{t}") for t in ("year", "month", "day", "hour")]
    return df.select("event_id", *made)


def truncate_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "customer").withColumn("bal", F.col("c_acctbal").cast("decimal(18,10)"))
    cut = lambda c, w: transforms.truncate(w, F.col(c), df.schema[c].dataType)
    return df.select("c_custkey", cut("c_custkey", 10).alias("key_10"), cut("c_name", 4).alias("name_4"), (cut("bal", 50 * 10**10) * 100).cast("bigint").alias("bal_50"))


def bucket_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: DuckDB has no Murmur3; the hashes are tested against known values."""
    df = _read(spark, sf_dir, "customer")
    return df.select("c_custkey", *[transforms.bucket(16, F.col(c), df.schema[c].dataType).alias(f"{c}_16") for c in ("c_custkey", "c_name")])


def equality_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = _read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return equality_deletes(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), gone, ["l_orderkey"])


# Tables of orders


def _orders(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    df = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return df if status is None else df.where(F.col("o_orderstatus") == status)


def _orders_table(spark: SparkSession, sf_dir: str, *parts: str | None, **how) -> Table:
    """A new table, one append of orders for each part."""
    t = Table.create(spark, shared_path(spark, "orders"), _orders(spark, sf_dir).schema, **how)
    for part in parts:
        t.append(_orders(spark, sf_dir, part))
    return t


def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F")
    first = t.head()["id"]
    t.append(_orders(spark, sf_dir, "O"))
    return t.scan().use(snapshot_id=first).filter(compare("o_totalprice", ">", 150000.0)).to_df()


def as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "P")
    moment = t.head()["ms"]
    t.append(_orders(spark, sf_dir, "O"))
    t.meta["snapshots"][-1]["ms"] = t.meta["log"][-1]["ms"] = moment + 60_000
    return t.scan().use(time_ms=moment + 59_999).to_df()


def tag_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F")
    t._one(lambda x: x.tag("first"))
    t.rename_column("o_totalprice", "price")
    t.append(_orders(spark, sf_dir, "O").withColumnRenamed("o_totalprice", "price"))
    return t.scan().use(ref="first").select("o_orderkey", "o_totalprice").to_df()


def branch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F")
    t.append(_orders(spark, sf_dir, "P"), branch="work")
    t.append(_orders(spark, sf_dir, "O"))
    return t.scan().use(ref="work").to_df()


def limit_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O", "P")
    few = t.scan().limit(10)
    return few.to_df().agg(F.count("*").alias("n")).select("n", F.lit(few.plan_files().count()).cast("long").alias("files"))


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F")
    first = t.head()["id"]
    t.append(_orders(spark, sf_dir, "O"))
    t.append(_orders(spark, sf_dir, "P"))
    return t.appended(first)


def incremental_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O")
    second = t.head()["id"]
    t.delete(compare("o_orderstatus", "=", "F"))
    t.append(_orders(spark, sf_dir, "P"))
    return t.appended(second, inclusive=True)


def append_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F")
    out = shared_path(spark, "stream")
    s = AppendStream(spark, t.root, shared_path(spark, "offsets"), max_snapshots=1)
    handle = lambda rows, n: rows.withColumn("batch", F.lit(n)).write.mode("append").parquet(out)
    s.available(handle)
    t.append(_orders(spark, sf_dir, "O"))
    t.append(_orders(spark, sf_dir, "P"))
    s.available(handle)
    return spark.read.parquet(out)


def copy_on_write_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, None)
    t.delete(compare("o_totalprice", "<", 100000.0))
    return t.scan().to_df()


def mor_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O")
    t.delete(compare("o_totalprice", "<", 100000.0), mode="merge-on-read")
    t.delete(compare("o_orderkey", "<", 100), mode="merge-on-read")
    return t.scan().filter(compare("o_totalprice", "<", 300000.0)).to_df()


def vector_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, None, properties={"format-version": "3"})
    t.delete(compare("o_totalprice", "<", 100000.0), mode="merge-on-read")
    t.delete(compare("o_orderstatus", "=", "F"), mode="merge-on-read")
    return t.scan().to_df()


def position_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of rows in the table's real files are deleted by a row delta."""
    t = _orders_table(spark, sf_dir, None)
    from .sources.table import _FILE, _POS

    tx = t.transaction()
    rows = tx._located(t.live(t.head(), "data"), t.live(None, "deletes"))
    tx.row_delta(positions=rows.where("o_orderkey % 3 = 1").select(F.col(_FILE).alias("file_path"), F.col(_POS).alias("pos")))
    tx.commit()
    return t.scan().to_df()


def equality_delete_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, None)
    t.delete_keys(_orders(spark, sf_dir, "F").select("o_orderkey"))
    t.append(_orders(spark, sf_dir, "F").where("o_totalprice > 300000"))
    t.rename_column("o_orderkey", "key")
    return t.scan().to_df()


def row_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O")
    new = _orders(spark, sf_dir, "O").withColumn("o_totalprice", F.lit(0.0))
    t.row_delta(rows=new, keys=new.select("o_orderkey"))
    return t.scan().to_df()


def filtered_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O")
    t.overwrite(_orders(spark, sf_dir, "P"), compare("o_orderstatus", "=", "F"))
    return t.scan().to_df()


def staged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F")
    tx = t.transaction()
    tx.append(_orders(spark, sf_dir, "P"))
    tx.delete(compare("o_totalprice", "<", 200000.0))
    return tx.scan().to_df()


def commit_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", properties={"commit.retry.num-retries": "3"})
    late = Table.load(spark, t.root).transaction()
    late.append(_orders(spark, sf_dir, "P"))
    t.append(_orders(spark, sf_dir, "O"))
    late.commit()
    return Table.load(spark, t.root).scan().to_df()


def add_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F")
    out = shared_path(spark, "outside")
    _orders(spark, sf_dir, "P").write.parquet(out)
    t.add_files([r.path for r in spark.read.format("binaryFile").load(out).select("path").collect()])
    return t.scan().filter(compare("o_totalprice", ">", 50000)).to_df()


def evolved_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F")
    t.rename_column("o_totalprice", "price")
    t.add_column("note", "string")
    t.append(_orders(spark, sf_dir, "P").withColumnRenamed("o_totalprice", "price").withColumn("note", F.lit("late")))
    return t.scan().select("o_orderkey", "price", "note").to_df()


def evolved_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields within structs are renamed, added with a default, and widened; rows of old files follow."""
    rows = _orders(spark, sf_dir, "F").select("o_orderkey", F.struct(F.col("o_orderkey").cast("int").alias("k"), F.col("o_orderstatus").alias("s")).alias("o"))
    t = Table.create(spark, shared_path(spark, "nested"), rows.schema)
    t.append(rows)
    t.evolve(lambda u: u.rename(("o", "s"), "status").change(("o", "k"), StructType.fromDDL("x bigint")["x"].dataType).add(("o", "note"), StructType.fromDDL("x string")["x"].dataType, default="old"))
    t.append(_orders(spark, sf_dir, "P").select("o_orderkey", F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.lit("new").alias("note")).alias("o")))
    return t.scan().filter(compare("o.k", ">", 10)).to_df().select("o_orderkey", F.col("o.k").alias("k"), F.col("o.status").alias("status"), F.col("o.note").alias("note"))


def schema_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F")
    more = _orders(spark, sf_dir, "P").withColumn("extra", F.col("o_orderkey") % 7)
    t.evolve(lambda u: u.union(more.schema))
    t.append(more)
    return t.scan().to_df()


def row_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row ids are distinct, and rows keep theirs when their files are rewritten."""
    t = _orders_table(spark, sf_dir, "F", "O", properties={"format-version": "3"})
    before = t.scan().with_lineage().to_df().select(F.col("o_orderkey").alias("k"), F.col("_row_id").alias("r"), F.col("_last_updated_sequence_number").alias("s"))
    path = shared_path(spark, "ids")
    before.write.parquet(path)
    t.delete(compare("o_totalprice", "<", 100000.0))
    compact(t)
    after = t.scan().with_lineage().to_df()
    same = after.join(spark.read.parquet(path), (F.col("o_orderkey") == F.col("k")) & (F.col("_row_id") == F.col("r")) & (F.col("_last_updated_sequence_number") == F.col("s")))
    return same.select("o_orderkey", F.col("s").alias("sequence"))


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "P")
    t.delete(compare("o_orderstatus", "=", "P"))
    t.compact()
    return t.changes().drop("_commit_snapshot_id").withColumnsRenamed({"_change_type": "change_type", "_change_ordinal": "change_ordinal"})


def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O", "P")
    t.delete(compare("o_orderkey", "<", 500), mode="merge-on-read")
    compact(t)
    left = t.inspect("files").agg(F.sum("content").alias("deletes")).first()[0]
    return t.scan().to_df().withColumn("delete_files", F.lit(left).cast("long"))


def expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O")
    t.overwrite(_orders(spark, sf_dir, "P"))
    expire(t, older_than_ms=1 << 60)
    return t.scan().to_df()


def view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = SqliteCatalog(spark, ":memory:", shared_path(spark, "warehouse"))
    c.create_namespace("a")
    t = c.create_table("a.orders", _orders(spark, sf_dir).schema)
    t.append(_orders(spark, sf_dir))
    v = c.create_view("a.totals", "SELECT o_orderstatus, count(*) AS n FROM {orders} GROUP BY o_orderstatus", StructType.fromDDL("o_orderstatus string, n bigint"))
    return v.to_df(orders=c.load_table("a.orders").scan().to_df())


def function_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = SqliteCatalog(spark, ":memory:", shared_path(spark, "warehouse"))
    c.create_namespace("a")
    name = c.create_function("a.tabulon_third", [("x", "bigint"), ("y", "bigint")], "bigint", "(x + y) div 3", on_null="return-null").install()
    _orders(spark, sf_dir).createOrReplaceTempView("tabulon_orders")
    return spark.sql(f"SELECT o_orderkey, {name}(o_orderkey, nullif(o_orderkey % 5, 0)) AS third FROM tabulon_orders")


# Metadata


def snapshots_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O")
    t.delete(compare("o_orderstatus", "=", "F"))
    return t.inspect("snapshots").select("operation", F.col("summary")["total-records"].cast("long").alias("total_records"))


def history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O", "P")
    first = t.meta["snapshots"][0]["id"]
    t._one(lambda x: x.rollback(first))
    return t.inspect("history").groupBy("is_current_ancestor").agg(F.count("*").alias("n"), F.count("parent_id").alias("with_parent"))


def refs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F")
    t._one(lambda x: x.tag("v1", max_ref_age_ms=1000))
    t.append(_orders(spark, sf_dir, "P"), branch="work")
    return t.inspect("refs").select("name", "type", "max_reference_age_in_ms")


def files_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O", "P")
    t.delete_keys(_orders(spark, sf_dir, "P").select("o_orderkey"))
    return t.inspect("files").groupBy("content").agg(F.sum("record_count").alias("record_count"), F.min("readable_metrics.o_orderkey.lower_bound").alias("least"), F.max("readable_metrics.o_orderkey.upper_bound").alias("most"))


def entries_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "P")
    t.delete(compare("o_orderstatus", "=", "P"))
    return t.inspect("entries").groupBy("status", "sequence_number").agg(F.sum("data_file.record_count").alias("record_count"))


def manifests_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "P", partition=["o_orderstatus"])
    rewrite_manifests(t)
    t.append(_orders(spark, sf_dir, "O"))
    return t.inspect("manifests").select("existing_rows_count", "added_rows_count", F.col("partition_summaries")[0]["lower_bound"].alias("lower"), F.col("partition_summaries")[0]["upper_bound"].alias("upper"))


def partitions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, None, partition=["o_orderstatus"])
    t.delete(compare("o_orderkey", "<", 1000), mode="merge-on-read")
    return t.inspect("partitions").where("record_count > 0").select("partition.o_orderstatus", "record_count")


def position_deletes_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, None)
    t.delete(compare("o_orderkey", "<", 1000), mode="merge-on-read")
    return t.inspect("position_deletes").groupBy("sequence_number").agg(F.count("*").alias("n"))


def column_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the footers of the table's files, whose partitions are the return flags."""
    df = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_returnflag")
    t = Table.create(spark, shared_path(spark, "lines"), df.schema, partition=["l_returnflag"])
    t.append(df)
    m = F.col("readable_metrics.l_extendedprice")
    out = t.inspect("data_files").groupBy(F.col("partition")["l_returnflag"].alias("l_returnflag"))
    return out.agg(F.sum("record_count").alias("record_count"), F.sum(m["null_value_count"]).alias("null_count"), F.min(m["lower_bound"]).alias("lower_bound"), F.max(m["upper_bound"]).alias("upper_bound"))


# Partitioned tables


def _partitioned(partition: Sequence, where: Expr) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _read(spark, sf_dir, "events").select("event_id", "ts", F.col("ts").cast("date").alias("day"), "user_id", "event_type", F.col("value").cast("decimal(12,2)").alias("price"))
        t = Table.create(spark, shared_path(spark, "events"), df.schema, partition=partition, order=[("event_id", "asc", "first")])
        t.append(df)
        return t.scan().filter(where).select("event_id", "user_id").to_df()

    return query


_LATE = compare("ts", ">=", dt.datetime(2024, 1, 20, 12))
_PARTITIONED = {
    "partition_identity": (["event_type"], starts_with("event_type", "c"), "starts_with(event_type, 'c')"),
    "partition_year": ([("day", "year")], compare("day", "<", "2024-01-15"), "CAST(ts AS DATE) < DATE '2024-01-15'"),
    "partition_month": ([("ts", "month")], _LATE, "ts >= TIMESTAMP '2024-01-20 12:00:00'"),
    "partition_day": ([("ts", "day")], _LATE, "ts >= TIMESTAMP '2024-01-20 12:00:00'"),
    "partition_hour": ([("ts", "hour")], all_of(_LATE, compare("user_id", ">", 100)), "ts >= TIMESTAMP '2024-01-20 12:00:00' AND user_id > 100"),
    "partition_truncate": ([("event_type", "truncate[1]")], ~starts_with("event_type", "c"), "NOT starts_with(event_type, 'c')"),
    "partition_truncate_decimal": ([("price", "truncate[5000]")], compare("price", "<=", 60), "CAST(value AS DECIMAL(12,2)) <= 60"),
    "partition_bucket": ([("user_id", "bucket[8]"), ("event_type", "bucket[4]")], all_of(is_in("user_id", [3, 17, 40]), compare("event_type", "!=", "view")), "user_id IN (3, 17, 40) AND event_type <> 'view'"),
}


def partition_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two partition specs under one filter."""
    t = _orders_table(spark, sf_dir, "F", partition=["o_orderstatus"])
    t._one(lambda x: x.repartition(add=[("o_orderkey", "bucket[4]")], remove=["o_orderstatus"]))
    t.append(_orders(spark, sf_dir, "O"))
    return t.scan().filter(all_of(is_in("o_orderstatus", ["F", "O"]), compare("o_orderkey", ">", 1000))).to_df()


def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _orders_table(spark, sf_dir, "F", "O", "P", "F", "O", "P", partition=["o_orderstatus"])
    plan = plan_compaction(t, least=2)
    return plan.files.groupBy(F.col("partition")["o_orderstatus"].alias("status")).agg(F.sum("record_count").alias("record_count"), F.count_distinct("group").alias("groups"))


# Workloads of the baseline, for measurement


def planning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planning of 80,000 files in 8 manifests under a filter that bounds decide: none comes to the driver."""
    t = _orders_table(spark, sf_dir)
    tx = t.transaction()
    for m in range(8):
        n = F.col("id") + m * 10_000
        rows = spark.range(10_000).select(F.concat(F.lit(f"file:///none/{m}/"), "id").alias("file_path"), F.lit(100).alias("record_count"), F.lit(1 << 20).alias("file_size"), F.expr("cast(map() as map<string,string>)").alias("partition"))
        rows = rows.withColumn("id", F.regexp_extract("file_path", r"(\d+)$", 1).cast("long"))
        rows = rows.withColumn("null_counts", F.create_map(F.lit(1), F.lit(0).cast("long"))).withColumn("lower", F.create_map(F.lit(1), (n * 100).cast("string"))).withColumn("upper", F.create_map(F.lit(1), (n * 100 + 99).cast("string")))
        tx.commit_files(tx.view._entries(rows, 0))
    tx.commit()
    return t.scan().filter(all_of(compare("o_orderkey", ">=", 500_000), compare("o_orderkey", "<", 500_250))).plan_files().select("file_path", "record_count")


def delete_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan under ten delete files by key, each of a commit of its own."""
    t = _orders_table(spark, sf_dir, None)
    tx = t.transaction()
    for i in range(10):
        tx.delete_keys(_orders(spark, sf_dir).where(F.col("o_orderkey") % 40 == i).select("o_orderkey"))
    tx.commit()
    return t.scan().to_df()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (scan_filter_project, predicates, predicates_negated, expression_json, transform_terms, nested_paths, variant_extract, time_transforms, truncate_transform, bucket_transform, equality_delete, position_delete, column_statistics)
    made += (time_travel, as_of, tag_scan, branch_scan, limit_scan, incremental_append, incremental_inclusive, append_stream, copy_on_write_delete, mor_delete, vector_delete, equality_delete_table, row_delta, filtered_overwrite, staged_scan, commit_retry, add_files)
    made += (evolved_schema, evolved_nested, schema_union, row_lineage, changelog, compaction, compaction_plan, expired, view_query, function_query, snapshots_table, history_table, refs_table, files_table, entries_table, manifests_table, partitions_table, position_deletes_table)
    made += (partition_evolution, planning, delete_pressure)
    return {f.__name__: f for f in made} | {name: _partitioned(partition, where) for name, (partition, where, _) in _PARTITIONED.items()}


_ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"


def oracle_sql() -> dict[str, str]:
    out = {
        "scan_filter_project": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 30 AND l_returnflag IN ('A', 'R')",
        "predicates": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE starts_with(o_orderpriority, '1') OR o_totalprice >= 200000",
        "predicates_negated": "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE NOT starts_with(o_orderpriority, '1') AND o_orderstatus NOT IN ('F', 'P') AND o_custkey <> 7 AND o_orderkey <= 2500000000 AND o_orderdate IS NOT NULL",
        "expression_json": f"{_ORDERS} WHERE NOT (o_totalprice < 100000 OR o_orderstatus IN ('F', 'P'))",
        "transform_terms": "SELECT event_id, event_type FROM events WHERE (year(ts) - 1970) * 12 + month(ts) - 1 >= 648 AND event_type[1] <> 'c'",
        "nested_paths": "SELECT c_custkey, c_name AS name FROM customer WHERE c_acctbal > 0",
        "variant_extract": "SELECT event_id FROM events WHERE user_id > 50 AND starts_with(event_type, 'c')",
        "time_transforms": "SELECT event_id, CAST(year(ts) - 1970 AS INTEGER) AS ts_year, CAST((year(ts) - 1970) * 12 + month(ts) - 1 AS INTEGER) AS ts_month, CAST(ts AS DATE) AS ts_day, CAST(floor(epoch_us(ts) / 3600000000) AS INTEGER) AS ts_hour FROM events",
        "truncate_transform": "SELECT c_custkey, c_custkey - c_custkey % 10 AS key_10, substr(c_name, 1, 4) AS name_4, CAST(floor(CAST(c_acctbal AS DECIMAL(18,10)) / 50) * 5000 AS BIGINT) AS bal_50 FROM customer",
        "equality_delete": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
        "position_delete": f"{_ORDERS} WHERE o_orderkey % 3 <> 1",
        "time_travel": f"{_ORDERS} WHERE o_orderstatus = 'F' AND o_totalprice > 150000",
        "as_of": f"{_ORDERS} WHERE o_orderstatus IN ('F', 'P')",
        "tag_scan": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
        "branch_scan": f"{_ORDERS} WHERE o_orderstatus IN ('F', 'P')",
        "limit_scan": "SELECT CAST(10 AS BIGINT) AS n, CAST(1 AS BIGINT) AS files",
        "incremental_append": f"{_ORDERS} WHERE o_orderstatus IN ('O', 'P')",
        "incremental_inclusive": f"{_ORDERS} WHERE o_orderstatus IN ('O', 'P')",
        "append_stream": "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INTEGER) AS batch FROM orders",
        "copy_on_write_delete": f"{_ORDERS} WHERE (o_totalprice < 100000) IS NOT TRUE",
        "mor_delete": f"{_ORDERS} WHERE o_orderstatus IN ('F', 'O') AND o_totalprice >= 100000 AND o_totalprice < 300000 AND o_orderkey >= 100",
        "vector_delete": f"{_ORDERS} WHERE o_totalprice >= 100000 AND o_orderstatus <> 'F'",
        "equality_delete_table": "SELECT o_orderkey AS key, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice > 300000",
        "row_delta": "SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'O' THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')",
        "filtered_overwrite": f"{_ORDERS} WHERE o_orderstatus IN ('O', 'P')",
        "staged_scan": f"{_ORDERS} WHERE o_orderstatus IN ('F', 'P') AND o_totalprice >= 200000",
        "commit_retry": _ORDERS,
        "add_files": f"{_ORDERS} WHERE o_orderstatus IN ('F', 'P') AND o_totalprice > 50000",
        "evolved_schema": "SELECT o_orderkey, o_totalprice AS price, CASE WHEN o_orderstatus = 'P' THEN 'late' END AS note FROM orders WHERE o_orderstatus IN ('F', 'P')",
        "evolved_nested": "SELECT o_orderkey, o_orderkey AS k, o_orderstatus AS status, CASE WHEN o_orderstatus = 'P' THEN 'new' ELSE 'old' END AS note FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderkey > 10",
        "schema_union": "SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN o_orderkey % 7 END AS extra FROM orders WHERE o_orderstatus IN ('F', 'P')",
        "row_lineage": "SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS BIGINT) AS sequence FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice >= 100000",
        "changelog": f"SELECT o_orderkey, o_orderstatus, o_totalprice, 'INSERT' AS change_type, CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END AS change_ordinal FROM orders WHERE o_orderstatus IN ('F', 'P') UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'DELETE', 2 FROM orders WHERE o_orderstatus = 'P'",
        "compaction": "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(0 AS BIGINT) AS delete_files FROM orders WHERE o_orderkey >= 500",
        "compaction_plan": "SELECT o_orderstatus AS status, CAST(2 * count(*) AS BIGINT) AS record_count, CAST(1 AS BIGINT) AS groups FROM orders GROUP BY o_orderstatus",
        "expired": f"{_ORDERS} WHERE o_orderstatus = 'P'",
        "view_query": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
        "function_query": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey + o_orderkey % 5) // 3 END AS third FROM orders",
        "snapshots_table": "SELECT 'append' AS operation, count_if(o_orderstatus = 'F') AS total_records FROM orders UNION ALL SELECT 'append', count_if(o_orderstatus IN ('F', 'O')) FROM orders UNION ALL SELECT 'delete', count_if(o_orderstatus = 'O') FROM orders",
        "history_table": "SELECT * FROM (VALUES (true, CAST(2 AS BIGINT), CAST(0 AS BIGINT)), (false, 2, 2)) AS t(is_current_ancestor, n, with_parent)",
        "refs_table": "SELECT * FROM (VALUES ('main', 'branch', CAST(NULL AS BIGINT)), ('v1', 'tag', 1000), ('work', 'branch', NULL)) AS t(name, type, max_reference_age_in_ms)",
        "files_table": "SELECT CAST(0 AS INTEGER) AS content, count(*) AS record_count, min(o_orderkey) AS least, max(o_orderkey) AS most FROM orders UNION ALL SELECT 2, count(*), min(o_orderkey), max(o_orderkey) FROM orders WHERE o_orderstatus = 'P'",
        "entries_table": "SELECT CAST(1 AS INTEGER) AS status, CAST(1 AS BIGINT) AS sequence_number, count_if(o_orderstatus = 'F') AS record_count FROM orders UNION ALL SELECT 2, 2, count_if(o_orderstatus = 'P') FROM orders",
        "manifests_table": "SELECT count_if(o_orderstatus <> 'O') AS existing_rows_count, CAST(0 AS BIGINT) AS added_rows_count, 'F' AS lower, 'P' AS upper FROM orders UNION ALL SELECT 0, count_if(o_orderstatus = 'O'), 'O', 'O' FROM orders",
        "partitions_table": "SELECT o_orderstatus, count(*) AS record_count FROM orders GROUP BY o_orderstatus",
        "position_deletes_table": "SELECT CAST(2 AS BIGINT) AS sequence_number, count(*) AS n FROM orders WHERE o_orderkey < 1000",
        "column_statistics": "SELECT l_returnflag, count(*) AS record_count, count(*) - count(l_extendedprice) AS null_count, min(l_extendedprice) AS lower_bound, max(l_extendedprice) AS upper_bound FROM lineitem GROUP BY l_returnflag",
        "partition_evolution": f"{_ORDERS} WHERE o_orderstatus IN ('F', 'O') AND o_orderkey > 1000",
        "planning": "SELECT concat('file:///none/0/', i) AS file_path, CAST(100 AS BIGINT) AS record_count FROM range(5000, 5003) AS t(i)",
        "delete_pressure": f"{_ORDERS} WHERE o_orderkey % 40 >= 10",
    }
    return out | {name: f"SELECT event_id, user_id FROM events WHERE {sql}" for name, (_, _, sql) in _PARTITIONED.items()}
