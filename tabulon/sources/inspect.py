"""Metadata tables: what a table says of itself, as DataFrames.

Tables of files are scans of manifests; only what is in the metadata document
(snapshots, references, lists of manifests) comes from the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import schema as schemas
from .files import typed
from .table import Table, manifests_of

_TIME = "timestamp"


def _at(ms: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(ms / 1000, dt.UTC)


def _snapshots(t: Table) -> DataFrame:
    rows = [(_at(s["ms"]), s["id"], s["parent"], s["operation"], s["schema"], s.get("manifest_list"), {k: str(v) for k, v in s["summary"].items()}) for s in t.meta["snapshots"]]
    return t.spark.createDataFrame(rows, f"committed_at {_TIME}, snapshot_id long, parent_id long, operation string, schema_id int, manifest_list string, summary map<string,string>")


def _history(t: Table) -> DataFrame:
    line = {s["id"] for s in t.ancestors((t.head() or {}).get("id"))} if t.meta["refs"] else set()
    parents = {s["id"]: s["parent"] for s in t.meta["snapshots"]}
    rows = [(_at(e["ms"]), e["snapshot"], parents.get(e["snapshot"]), e["snapshot"] in line) for e in t.meta["log"]]
    return t.spark.createDataFrame(rows, f"made_current_at {_TIME}, snapshot_id long, parent_id long, is_current_ancestor boolean")


def _refs(t: Table) -> DataFrame:
    rows = [(n, r["type"], r["snapshot"], r.get("max_ref_age_ms"), r.get("min_snapshots_to_keep"), r.get("max_snapshot_age_ms")) for n, r in t.meta["refs"].items()]
    return t.spark.createDataFrame(rows, "name string, type string, snapshot_id long, max_reference_age_in_ms long, min_snapshots_to_keep int, max_snapshot_age_in_ms long")


def _log(t: Table) -> DataFrame:
    head = t.head()
    now = {"ms": t.meta["updated"], "file": f"metadata/v{t.meta['version']}.json", "snapshot": head["id"] if head else None, "schema": t.meta["current_schema"], "sequence": t.meta["sequence"]}
    rows = [(_at(e["ms"]), e["file"], e["snapshot"], e["schema"], e["sequence"]) for e in [*t.meta["metadata_log"], now]]
    return t.spark.createDataFrame(rows, f"timestamp {_TIME}, file string, latest_snapshot_id long, latest_schema_id int, latest_sequence_number long")


def _manifests(t: Table, snapshots: list[dict], tag: bool) -> DataFrame:
    rows = []
    for s in snapshots:
        for m in manifests_of(t, s):
            sums = [(n, v["nulls"] > 0, v["nan"] > 0, v["lower"], v["upper"]) for n, v in sorted(m["summaries"].items())]
            rows.append((0 if m["content"] == "data" else 1, m["path"], m["specs"], m["snapshot"], m["sequence"], *m["files"], *m["rows"], sums, s["id"]))
    kind = "content int, path string, partition_spec_ids array<int>, added_snapshot_id long, sequence_number long, existing_files_count long, added_files_count long, deleted_files_count long, existing_rows_count long, added_rows_count long, deleted_rows_count long,"
    kind += " partition_summaries array<struct<field: string, contains_null: boolean, contains_nan: boolean, lower_bound: string, upper_bound: string>>, reference_snapshot_id long"
    df = t.spark.createDataFrame(rows, kind)
    return df if tag else df.drop("reference_snapshot_id")


def _every(t: Table) -> list[dict]:
    """All manifests that any snapshot lists, once each."""
    return [*{m["path"]: m for s in t.meta["snapshots"] for m in manifests_of(t, s)}.values()]


_FILE = ("content", "file_path", "file_format", "spec_id", "partition", "record_count", "file_size", "column_sizes", "value_counts", "null_counts", "nan_counts", "lower", "upper", "split_offsets", "equality_ids", "sort_order_id", "first_row_id", "referenced_file")


def _entries(t: Table, manifests: list[dict]) -> DataFrame:
    df = t.entries(manifests)
    return df.select("status", "snapshot_id", F.col("sequence").alias("sequence_number"), F.struct(*_FILE).alias("data_file"), readable(t, df))


def readable(t: Table, df: DataFrame):
    """Statistics of every column by its name, as values of its type."""
    out = []
    for i, (path, f) in sorted(schemas.by_id(t.full_schema()).items()):
        name = ".".join(path)
        if "element" in path or "key" in path or f.dataType.typeName() in ("struct", "array", "map", "variant"):
            continue
        at = lambda m, i=i: F.try_element_at(m, F.lit(i))
        out.append(F.struct(at("column_sizes").alias("column_size"), at("value_counts").alias("value_count"), at("null_counts").alias("null_value_count"), at("nan_counts").alias("nan_value_count"), typed(at("lower"), f.dataType).alias("lower_bound"), typed(at("upper"), f.dataType).alias("upper_bound")).alias(name))
    return F.struct(*out).alias("readable_metrics")


def _files(t: Table, manifests: list[dict], content: str | None, every: bool = False) -> DataFrame:
    chosen = [m for m in manifests if content in (None, m["content"])]
    df = t.entries(chosen).where("status <> 2")
    out = df.select(*_FILE, readable(t, df))
    return out.dropDuplicates(["file_path"]) if every else out


def _partitions(t: Table) -> DataFrame:
    """Counts by partition spec and partition: one aggregation with partial sums before its shuffle."""
    df = t.live(t.head())
    moment = t.spark.createDataFrame([(s["id"], _at(s["ms"])) for s in t.meta["snapshots"]], f"_s long, _at {_TIME}")
    df = df.join(F.broadcast(moment), F.col("snapshot_id") == F.col("_s"), "left")
    key = F.to_json(F.array_sort(F.map_entries("partition")))
    of = lambda c, x: F.sum(F.when(F.col("content") == c, x).otherwise(0))
    out = df.groupBy("spec_id", key.alias("_k")).agg(
        F.any_value(F.to_json("partition")).alias("_p"), of(0, F.col("record_count")).alias("record_count"), of(0, F.lit(1)).alias("file_count"), of(0, F.col("file_size")).alias("total_data_file_size_in_bytes"),
        of(1, F.col("record_count")).alias("position_delete_record_count"), of(1, F.lit(1)).alias("position_delete_file_count"), of(2, F.col("record_count")).alias("equality_delete_record_count"), of(2, F.lit(1)).alias("equality_delete_file_count"),
        F.max("_at").alias("last_updated_at"), F.max_by("snapshot_id", "_at").alias("last_updated_snapshot_id"),
    )
    names = list(t.partition_kinds())
    texts = F.from_json("_p", "map<string,string>")
    part = F.struct(*[typed(F.try_element_at(texts, F.lit(n)), k).alias(n) for n, k in t.partition_kinds().items()]) if names else None
    return out.select(*([part.alias("partition")] if names else []), *[c for c in out.columns if c not in ("_k", "_p")])


def _position_deletes(t: Table) -> DataFrame:
    """Every deleted position, with the delete file's sequence; positions of vectors too."""
    deletes = t.live(t.head(), "deletes").where("content = 1")
    if deletes.isEmpty():
        return t.spark.createDataFrame([], "file_path string, pos long, sequence_number long")
    return t._positions(deletes).select(F.col("path").alias("file_path"), "pos", F.col("seq").alias("sequence_number"))


def inspect(t: Table, what: str) -> DataFrame:
    """snapshots, history, refs, metadata_log_entries, manifests, entries, files, data_files, delete_files, partitions, position_deletes, and all_ forms of manifests, entries and files, over every snapshot that is kept."""
    head = t.head()
    here = manifests_of(t, head)
    made = {
        "snapshots": lambda: _snapshots(t), "history": lambda: _history(t), "refs": lambda: _refs(t), "metadata_log_entries": lambda: _log(t), "partitions": lambda: _partitions(t), "position_deletes": lambda: _position_deletes(t),
        "manifests": lambda: _manifests(t, [head] if head else [], False), "all_manifests": lambda: _manifests(t, t.meta["snapshots"], True), "entries": lambda: _entries(t, here), "all_entries": lambda: _entries(t, _every(t)),
        "files": lambda: _files(t, here, None), "data_files": lambda: _files(t, here, "data"), "delete_files": lambda: _files(t, here, "deletes"),
        "all_files": lambda: _files(t, _every(t), None, True), "all_data_files": lambda: _files(t, _every(t), "data", True), "all_delete_files": lambda: _files(t, _every(t), "deletes", True),
    }
    if what not in made:
        raise ValueError(f"no metadata table {what!r}")
    return made[what]()
