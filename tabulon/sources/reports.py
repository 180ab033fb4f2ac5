"""What scans and commits cost, for whoever listens; and planned tasks as bytes, for readers elsewhere."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .table import Scan, Table, manifests_of

Reporter = Callable[[dict[str, Any]], None]


def scan_report(scan: Scan) -> dict[str, Any]:
    """Counts of a scan's planning: manifests and files in all, those that its filter leaves, and the bytes and delete files that go with them. The filter's values are masked."""
    t, began = scan.table, time.time()
    snapshot, version = scan._chosen()
    bound = scan.where.bind(t.schema(version), scan.case_sensitive)
    every = [m for m in manifests_of(t, snapshot) if m["files"][0] + m["files"][1]]
    tasks = scan.plan_files()
    r = tasks.agg(F.count("*").alias("n"), F.sum("file_size").alias("size"), F.sum("record_count").alias("rows"), F.count_if("has_deletes").alias("touched"), F.count_distinct("manifest").alias("manifests")).first()
    of = lambda content: [m for m in every if m["content"] == content]
    files = sum(m["files"][0] + m["files"][1] for m in of("data"))
    return {
        "table": t.root, "snapshot-id": snapshot["id"] if snapshot else None, "schema-id": version, "filter": bound.sanitised().to_json(), "projected-field-names": [*scan.columns],
        "metrics": {
            "total-planning-duration-ms": int((time.time() - began) * 1000), "total-data-manifests": len(of("data")), "total-delete-manifests": len(of("deletes")), "scanned-data-manifests": r["manifests"], "skipped-data-manifests": len(of("data")) - r["manifests"],
            "result-data-files": r["n"], "skipped-data-files": files - r["n"], "result-delete-files": sum(m["files"][0] + m["files"][1] for m in of("deletes")), "files-with-deletes": r["touched"], "total-file-size-in-bytes": r["size"] or 0, "total-records": r["rows"] or 0,
        },
    }


def commit_report(t: Table, snapshot_id: int | None = None, took_ms: int = 0, attempts: int = 1) -> dict[str, Any]:
    """What a commit did, from its snapshot's summary."""
    s = t.snapshot(snapshot_id) if snapshot_id is not None else t.head()
    if s is None:
        raise ValueError("the table has no commit yet")
    return {"table": t.root, "snapshot-id": s["id"], "sequence-number": s["sequence"], "operation": s["operation"], "metrics": {"total-duration-ms": took_ms, "attempts": attempts} | s["summary"]}


def reported(scan: Scan, reporter: Reporter) -> DataFrame:
    """The scan's rows; its report goes to reporter."""
    reporter(scan_report(scan))
    return scan.to_df()


def encode_tasks(scan: Scan, tasks: DataFrame) -> bytes:
    """Tasks with what a reader must know of their scan: an Arrow stream, its schema's metadata saying snapshot, columns and filter. For a part of the tasks, as a reader elsewhere takes; all of them need not fit into one."""
    snapshot, _ = scan._chosen()
    about = {"root": scan.table.root, "snapshot": snapshot["id"] if snapshot else None, "columns": [*scan.columns], "filter": scan.where.to_json(), "version": scan.table.meta["version"], "schema": tasks.schema.jsonValue()}
    rows = tasks.toArrow()
    rows = rows.replace_schema_metadata({b"scan": json.dumps(about).encode()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_table(rows)
    return sink.getvalue().to_pybytes()


def decode_tasks(spark, raw: bytes) -> tuple[Scan, DataFrame]:
    """The scan and its tasks."""
    from ..plans.expressions import from_json

    rows = pa.ipc.open_stream(raw).read_all()
    about = json.loads(rows.schema.metadata[b"scan"])
    t = Table(spark, about["root"])
    t.meta = json.loads(t.files.read(f"metadata/v{about['version']}.json"))
    scan = Scan(t, columns=tuple(about["columns"]), where=from_json(about["filter"]), snapshot_id=about["snapshot"])
    return scan, spark.createDataFrame(rows.replace_schema_metadata(None), StructType.fromJson(about["schema"]))
