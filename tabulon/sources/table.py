"""Versioned tables: Parquet files, listed by manifests, which snapshots in a metadata document point to.

A commit writes its data, a manifest of the new files (in tasks, from the
files' footers), manifests without the files that go, and claims the next
version of the document. A scan plans in Spark: partition summaries rule out
manifests, bounds rule out their entries, and what is left is read by Spark's
own reader. No list of files is in the document, so its size does not depend
on theirs.
"""

from __future__ import annotations

import copy
import json
import re
import time
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import transforms
from ..operators.deletes import equality_deletes, position_deletes
from ..plans.expressions import FALSE, TRUE, Expr, all_of, any_of, project, quoted, resolve
from . import schema as schemas
from .files import ENTRY, CommitConflict, Files, as_text, footers, listed, measured, row_path, stats_columns, typed, uri, value_from

__all__ = ["CommitConflict", "Scan", "Table", "Transaction"]

#: Defaults of table properties that the engine reads.
DEFAULTS = {
    "format-version": "2", "write.target-file-size-bytes": str(512 << 20), "write.parquet.compression-codec": "zstd", "write.parquet.row-group-size-bytes": str(128 << 20), "write.parquet.page-size-bytes": str(1 << 20),
    "write.parquet.dict-size-bytes": str(2 << 20), "write.metadata.metrics.default": "truncate(16)", "write.delete.mode": "copy-on-write", "write.delete.isolation-level": "serializable", "write.update.isolation-level": "serializable",
    "commit.retry.num-retries": "0", "commit.retry.min-wait-ms": "100", "commit.retry.max-wait-ms": "60000", "commit.manifest-merge.enabled": "false", "commit.manifest.min-count-to-merge": "100", "write.object-storage.enabled": "false",
    "history.expire.min-snapshots-to-keep": "1", "history.expire.max-snapshot-age-ms": str(5 * 24 * 3600 * 1000), "write.metadata.previous-versions-max": "100", "write.metadata.delete-after-commit.enabled": "false", "read.split.target-size": str(128 << 20), "gc.enabled": "true",
}
#: Columns that a scan adds to tell rows apart; a table cannot have them.
_FILE, _POS, _SEQ, _SPEC = "_tabulon_file", "_tabulon_pos", "_tabulon_seq", "_tabulon_spec"
_LINEAGE = {"_row_id": "bigint", "_last_updated_sequence_number": "bigint"}
#: Up to so many rows about files are broadcast, and joins with up to so many deleted positions may be; both change cost only.
_FEW_FILES, _FEW_POSITIONS = 20_000, 50_000


def manifests_of(t: Table, snapshot: dict | None) -> list[dict]:
    """What a snapshot says of its manifests: in a list of its own, read when it is first asked for."""
    if snapshot is None:
        return []
    if "manifests" in snapshot:  # staged
        return snapshot["manifests"]
    if snapshot["id"] not in t.lists:
        t.lists[snapshot["id"]] = json.loads(t.files.read(snapshot["manifest_list"]))
    return t.lists[snapshot["id"]]


@dataclass
class Change:
    """A staged snapshot: how to make it on top of any head, and what must hold for that."""

    operation: str
    branch: str = "main"
    added: list[dict] = field(default_factory=list)  # manifests
    removed: DataFrame | None = None  # file_path of files that go
    where: Expr | None = None  # rows that an overwrite or delete was meant for
    isolation: str = "serializable"
    needs: DataFrame | None = None  # file_path of data files that must still be there
    rewrites: bool = False  # removed files must have got no new deletes
    keys: bool = False  # adds deletes by key
    summary: dict = field(default_factory=dict)


class Table:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root)
        self.meta: dict = {}
        self.staged: list[str] = []  # folders of this handle's commit: what only the commit needs, and its new files
        self.folders: list[str] = []
        self.lists: dict[int, list[dict]] = {}

    # Documents

    @classmethod
    def create(cls, spark: SparkSession, root: str, schema: StructType, properties: dict | None = None, partition: Sequence[str | tuple[str, str]] = (), order: Sequence[tuple] = ()) -> Table:
        """A new table. partition: columns or (column, transform); order: (column or (column, transform), "asc" or "desc", "first" or "last")."""
        t, last = cls(spark, root), [0]
        clash = {f.name for f in schema.fields} & {_FILE, _POS, _SEQ, _SPEC, *_LINEAGE}
        if clash:
            raise ValueError(f"reserved column names: {sorted(clash)}")

        def next_id() -> int:
            last[0] += 1
            return last[0]

        made = schemas.with_ids(schemas.plain(schema), next_id)
        now = _now()
        t.meta = {"version": 0, "uuid": str(uuid.uuid4()), "updated": now, "schemas": [schemas.dumped(made) | {"identifiers": []}], "current_schema": 0, "last_id": last[0], "specs": [[]], "current_spec": 0, "orders": [[]], "current_order": 0}
        t.meta |= {"snapshots": [], "refs": {}, "log": [], "metadata_log": [], "sequence": 0, "next_row_id": 0, "properties": {k: str(v) for k, v in (properties or {}).items()}, "statistics": [], "partition_statistics": []}
        t.meta["specs"] = [[t._partition_field(p, made, []) for p in partition]]
        t.meta["orders"] = [t._sort_fields(order, made)]
        if not t.files.claim("metadata/v0.json", json.dumps(t.meta)):
            raise ValueError(f"a table is at {root} already")
        return t

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> Table:
        t = cls(spark, root)
        t.refresh()
        return t

    def refresh(self) -> Table:
        versions = [int(n[1:-5]) for n in self.files.names("metadata") if re.fullmatch(r"v\d+\.json", n)]
        if not versions:
            raise FileNotFoundError(f"no table at {self.root}")
        self.meta = json.loads(self.files.read(f"metadata/v{max(versions)}.json"))
        return self

    def property(self, name: str) -> str:
        return str(self.meta["properties"].get(name, DEFAULTS.get(name, "")))

    def _publish(self, meta: dict) -> bool:
        """Claims the version after the one that meta says."""
        before = meta["version"]
        meta = meta | {"version": before + 1, "updated": max(_now(), meta["updated"])}
        snaps = []
        for s in meta["snapshots"]:
            if "manifests" in s:
                name = f"metadata/snap-{s['id']}.json"
                self.files.write(name, json.dumps(s["manifests"]))
                self.lists[s["id"]] = s["manifests"]
                s = {k: v for k, v in s.items() if k != "manifests"} | {"manifest_list": name}
            snaps.append(s)
        meta["snapshots"] = snaps
        head = meta["refs"].get("main", {}).get("snapshot")
        log = [*meta["metadata_log"], {"ms": self.meta["updated"], "file": f"metadata/v{before}.json", "snapshot": head, "schema": meta["current_schema"], "sequence": meta["sequence"]}]
        most = int(self.property("write.metadata.previous-versions-max"))
        meta["metadata_log"], gone = log[-most:], log[:-most]
        if not self.files.claim(f"metadata/v{before + 1}.json", json.dumps(meta)):
            return False
        self.meta = meta
        if self.property("write.metadata.delete-after-commit.enabled") == "true":
            for e in gone:
                self.files.fs.delete(self.files.path(e["file"]), False)
        return True

    # Transactions

    def transaction(self, branch: str = "main") -> Transaction:
        return Transaction(self, branch)

    def _one(self, stage: Callable[[Transaction], Any], branch: str = "main") -> Any:
        t = self.transaction(branch)
        out = stage(t)
        t.commit()
        return out

    def append(self, df: DataFrame, branch: str = "main", summary: dict | None = None) -> None:
        self._one(lambda t: t.append(df, summary), branch)

    def delete(self, where: Expr, branch: str = "main", mode: str | None = None) -> None:
        self._one(lambda t: t.delete(where, mode), branch)

    def overwrite(self, df: DataFrame, where: Expr = TRUE, branch: str = "main") -> None:
        self._one(lambda t: t.overwrite(df, where), branch)

    def delete_keys(self, keys: DataFrame, branch: str = "main") -> None:
        self._one(lambda t: t.delete_keys(keys), branch)

    def row_delta(self, rows: DataFrame | None = None, keys: DataFrame | None = None, positions: DataFrame | None = None, branch: str = "main") -> None:
        self._one(lambda t: t.row_delta(rows, keys, positions), branch)

    def add_files(self, paths: Sequence[str], branch: str = "main") -> None:
        self._one(lambda t: t.add_files(paths), branch)

    def compact(self, partitions: int | None = None, **how) -> None:
        from .maintenance import compact

        compact(self, partitions, **how)

    def tag(self, name: str, snapshot_id: int | None = None, kind: str = "tag", **retention: int) -> None:
        self._one(lambda t: t.tag(name, snapshot_id, kind, **retention))

    def rollback(self, snapshot_id: int, branch: str = "main") -> None:
        self._one(lambda t: t.rollback(snapshot_id), branch)

    def expire(self, older_than_ms: int | None = None, keep_last: int | None = None, clean: bool = True) -> int:
        from .maintenance import expire

        return expire(self, older_than_ms, keep_last, clean)

    def evolve(self, change: Callable[[schemas.Update], Any]) -> None:
        self._one(lambda t: t.evolve(change))

    def add_column(self, name: str | Sequence[str], kind: str, **how) -> None:
        self.evolve(lambda u: u.add(name, StructType.fromDDL(f"v {kind}")["v"].dataType, **how))

    def rename_column(self, old: str | Sequence[str], new: str) -> None:
        self.evolve(lambda u: u.rename(old, new))

    def delete_column(self, name: str | Sequence[str]) -> None:
        self.evolve(lambda u: u.drop(name))

    def promote_column(self, name: str | Sequence[str], kind: str) -> None:
        self.evolve(lambda u: u.change(name, StructType.fromDDL(f"v {kind}")["v"].dataType))

    def set_properties(self, values: dict[str, str | None]) -> None:
        self._one(lambda t: t.set_properties(values))

    # Snapshots

    def snapshot(self, snapshot_id: int) -> dict:
        found = [s for s in self.meta["snapshots"] if s["id"] == snapshot_id]
        if not found:
            raise ValueError(f"no snapshot {snapshot_id}")
        return found[0]

    def head(self, branch: str = "main") -> dict | None:
        """The snapshot of a branch or tag; a branch that is not there yet would start at main's."""
        ref = self.meta["refs"].get(branch) or self.meta["refs"].get("main")
        return self.snapshot(ref["snapshot"]) if ref else None

    def as_of(self, ms: int) -> dict:
        """The snapshot that was current at a time: the log entry of the greatest time not after it, whatever the log's order."""
        found = [e for e in self.meta["log"] if e["ms"] <= ms]
        if not found:
            raise ValueError(f"no snapshot at or before {ms}")
        return self.snapshot(max(found, key=lambda e: e["ms"])["snapshot"])

    def ancestors(self, snapshot_id: int | None) -> list[dict]:
        """A snapshot and those before it, as far back as they are kept."""
        by_id, out = {s["id"]: s for s in self.meta["snapshots"]}, []
        if snapshot_id is not None and snapshot_id not in by_id:
            raise ValueError(f"no snapshot {snapshot_id}")
        while snapshot_id in by_id:
            out.append(by_id[snapshot_id])
            snapshot_id = out[-1]["parent"]
        return out

    def span(self, after: int | None, upto: int | None, inclusive: bool = False) -> list[dict]:
        """The snapshots after one (null: from the table's first) up to another, oldest first. An error where some of them have expired."""
        head = self.head()
        end = upto if upto is not None else head["id"] if head else None
        line = self.ancestors(end)
        ids = [s["id"] for s in line]
        if after is not None and after not in ids:
            raise ValueError(f"{after} is no ancestor of {end}")
        out = line if after is None else line[: ids.index(after) + inclusive]
        if after is None and out and out[-1]["parent"] is not None:
            raise ValueError("snapshots of this span have expired")
        return out[::-1]

    # Schemas, specs, orders

    def schema(self, version: int | None = None) -> StructType:
        return schemas.plain(self.full_schema(version))

    def full_schema(self, version: int | None = None) -> StructType:
        """With ids and defaults."""
        return schemas.loaded(self.meta["schemas"][self.meta["current_schema"] if version is None else version])

    @staticmethod
    def _partition_field(p: str | tuple[str, ...], schema: StructType, taken: Sequence[dict]) -> dict:
        column, transform, *name = (p, "identity") if isinstance(p, str) else p
        path, kind, _ = resolve(schema, column)
        what, arg = transforms.parse(transform)
        transforms.apply(transform, F.lit(None).cast(kind), kind)  # an error where the type does not allow it
        source = next(i for i, (q, _) in schemas.by_id(schema).items() if q == path)
        made = {"source": source, "transform": re.sub(r"\s", "", transform.lower()), "name": name[0] if name else column if what == "identity" else f"{column}_{what}" + (f"_{arg}" if what == "truncate" else "")}
        if any(f["name"] == made["name"] for f in taken):
            raise ValueError(f"partition field {made['name']!r} exists")
        times = ("year", "month", "day", "hour")
        if what != "void" and any(f["source"] == source and (f["transform"] == made["transform"] or what in times and f["transform"] in times) for f in taken):
            raise ValueError(f"a partition field by {transform} of {column!r} is redundant")
        return made

    @staticmethod
    def _sort_fields(order: Sequence[tuple], schema: StructType) -> list[dict]:
        out = []
        for term, direction, nulls in order:
            column, transform = (term, "identity") if isinstance(term, str) else term
            if direction not in ("asc", "desc") or nulls not in ("first", "last"):
                raise ValueError(f"no sort direction: {direction!r}, {nulls!r}")
            path, kind, _ = resolve(schema, column)
            transforms.result_type(transform, kind)
            out.append({"source": next(i for i, (q, _) in schemas.by_id(schema).items() if q == path), "transform": transform, "direction": direction, "nulls": nulls})
        return out

    def spec(self, number: int | None = None) -> list[dict]:
        return self.meta["specs"][self.meta["current_spec"] if number is None else number]

    def partition_kinds(self) -> dict[str, Any]:
        """Type of every partition field of any spec, by name."""
        ids, out = {}, {}
        for doc in self.meta["schemas"]:
            ids |= schemas.by_id(schemas.loaded(doc))
        for spec in self.meta["specs"]:
            for f in spec:
                out[f["name"]] = transforms.result_type(f["transform"], ids[f["source"]][1].dataType)
        return out

    # Writing files

    def _location(self, branch: str) -> str:
        base = (self.property("write.data.path") or f"{self.files.root_uri}/data").rstrip("/")
        name = uuid.uuid4().hex
        self.folders.append(unquote(f"{base}/{name[:4]}/{name[4:6]}/{name}" if self.property("write.object-storage.enabled") == "true" else f"{base}/{name}"))
        return self.folders[-1]

    def _options(self, writer, schema: StructType):
        p = self.property
        rows = max(1, int(p("write.target-file-size-bytes")) // max(1, sum(f.dataType.jsonValue() and _width(f.dataType) for f in schema.fields)))
        for k, v in (("compression", p("write.parquet.compression-codec")), ("parquet.block.size", p("write.parquet.row-group-size-bytes")), ("parquet.page.size", p("write.parquet.page-size-bytes")), ("parquet.dictionary.page.size", p("write.parquet.dict-size-bytes")), ("maxRecordsPerFile", str(rows))):
            writer = writer.option(k, v)
        for k, v in self.meta["properties"].items():
            if k.startswith("write.parquet.bloom-filter-enabled.column."):
                writer = writer.option(f"parquet.bloom.filter.enabled#{k.rpartition('.column.')[2]}", v)
        return writer

    def write_files(self, df: DataFrame, lineage: bool = False, branch: str = "main", partitions: int | None = None) -> DataFrame:
        """Data files of df in the current schema, partition spec and sort order, not yet part of the table: what manifests say of them, kept in a manifest's form.

        Columns are taken by name; missing ones get their default for new rows
        or null. Rows of a partition are brought together by a rebalancing
        shuffle, which splits partitions that are too large for a task.
        """
        full, spec = self.full_schema(), self.spec()
        extra = [c for c in df.columns if c not in full.fieldNames() and not (lineage and c in _LINEAGE)]
        if extra:
            raise ValueError(f"the table has no columns {extra}")
        cols = []
        for f in full.fields:
            c = F.col(quoted(f.name)).cast(f.dataType) if f.name in df.columns else schemas.default(f, "write")
            if not f.nullable:
                c = F.when(c.isNull(), F.raise_error(F.lit(f"null in required column {f.name}"))).otherwise(c)
            cols.append(c.alias(f.name))
        if lineage:
            cols += [(F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in _LINEAGE.items()]
        out, at = df.select(*cols), schemas.by_id(full)
        names, keys = [], []
        for i, f in enumerate(spec):
            path, kind, c = self._source(f, at)
            value = transforms.apply(f["transform"], c, kind)
            names.append(f"_p{i}")
            keys.append(F.coalesce(F.concat(F.lit("v"), as_text(value, transforms.result_type(f["transform"], kind))), F.lit("n")).alias(names[-1]))
        out = out.select("*", *keys)
        if partitions is not None:
            out = out.repartition(partitions, *names) if names else out.repartition(partitions)
        elif names:
            out = out.hint("rebalance", *[F.col(n) for n in names])
        order = []
        for f in self.meta["orders"][self.meta["current_order"]]:
            path, kind, c = self._source(f, at)
            c = transforms.apply(f["transform"], c, kind)
            order.append(getattr(c, f"{f['direction']}_nulls_{f['nulls']}")())
        if names or order:
            out = out.sortWithinPartitions(*names, *order)
        folder = self._location(branch)
        writer = self._options(out.write, full)
        how = [("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")]  # of the other form there are no bounds
        if self.property("write.parquet.shred-variants") == "true":
            how += [("spark.sql.variant.writeShredding.enabled", "true"), ("spark.sql.variant.inferShreddingSchema", "true")]
        with _set(self.spark, how):
            (writer.partitionBy(*names) if names else writer).parquet(folder)
        return self._entries(measured(self.spark, folder, full, [f["name"] for f in spec], self.meta["properties"]).where("record_count > 0"), 0)

    def _source(self, f: dict, at: dict) -> tuple[tuple[str, ...], Any, Column]:
        path, own = at[f["source"]]
        return path, own.dataType, reduce(lambda c, n: c.getField(n), path[1:], F.col(quoted(path[0])))

    def _entries(self, rows: DataFrame, content: int, **given: Column) -> DataFrame:
        """Rows in the form of a manifest, status added; snapshot and sequence are to be filled in."""
        fixed = {"status": F.lit(1), "content": F.lit(content), "file_format": F.lit("parquet"), "spec_id": F.lit(self.meta["current_spec"]), "schema_id": F.lit(self.meta["current_schema"]), "sort_order_id": F.lit(self.meta["current_order"])} | given
        kinds = StructType.fromDDL(ENTRY)
        out = [(fixed[f.name] if f.name in fixed else F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds.fields]
        return self._manifest_table(rows.select(*out))

    def _manifest_table(self, entries: DataFrame) -> DataFrame:
        path = self._manifest_path()
        entries.write.parquet(path)
        out = self.spark.read.schema(ENTRY).parquet(path)
        out._manifest_path = path
        return out

    def _manifest_path(self) -> str:
        return unquote(f"{(self.property('write.metadata.path') or self.files.root_uri + '/metadata').rstrip('/')}/m-{uuid.uuid4().hex}")

    def manifest(self, entries: DataFrame) -> dict:
        """What a snapshot says of a manifest: counts, and bounds of partition values."""
        kinds = self.partition_kinds()
        aggs = [F.count_if(F.col("status") == s).alias(f"files{s}") for s in (0, 1, 2)] + [F.sum(F.when(F.col("status") == s, F.col("record_count")).otherwise(0)).alias(f"rows{s}") for s in (0, 1, 2)]
        live = F.col("status") != 2
        aggs += [F.min(F.when(live, F.coalesce("sequence", F.lit(1 << 60)))).alias("least"), F.max("content").alias("content"), F.sum(F.when(F.col("status") == 1, F.col("file_size")).otherwise(0)).alias("size1"), F.sum(F.when(F.col("status") == 2, F.col("file_size")).otherwise(0)).alias("size2"), F.collect_set("spec_id").alias("specs")]
        aggs += [F.sum(F.when((F.col("status") == s) & (F.col("content") == 2), F.col("record_count")).otherwise(0)).alias(f"keys{s}") for s in (1, 2)]
        fields = list(kinds)
        for i, n in enumerate(fields):
            text = F.when(live, F.try_element_at("partition", F.lit(n)))
            has = live & F.map_contains_key("partition", n)
            v = typed(text, kinds[n])
            nan = F.isnan(v) if kinds[n].simpleString() in ("float", "double") else F.lit(False)
            aggs += [F.count_if(has & text.isNull()).alias(f"u{i}"), F.count_if(has).alias(f"c{i}"), F.count_if(nan).alias(f"x{i}"), as_text(F.min(F.when(~nan, v)), kinds[n]).alias(f"l{i}"), as_text(F.max(F.when(~nan, v)), kinds[n]).alias(f"h{i}"), F.count_if(live).alias(f"a{i}")]
        r = entries.agg(*aggs).first()
        summaries = {n: {"nulls": r[f"u{i}"], "rows": r[f"c{i}"], "nan": r[f"x{i}"], "lower": r[f"l{i}"], "upper": r[f"h{i}"]} for i, n in enumerate(fields) if r[f"c{i}"] and r[f"c{i}"] == r[f"a{i}"]}
        return {"path": entries._manifest_path, "content": "deletes" if (r["content"] or 0) > 0 else "data", "specs": sorted(r["specs"]), "files": [r["files0"], r["files1"], r["files2"]], "rows": [int(r[f"rows{s}"] or 0) for s in (0, 1, 2)], "size": [0, int(r["size1"] or 0), int(r["size2"] or 0)], "keys": [0, int(r["keys1"] or 0), int(r["keys2"] or 0)], "least": None if r["least"] in (None, 1 << 60) else r["least"], "summaries": summaries}

    # Reading manifests

    def entries(self, manifests: Sequence[dict]) -> DataFrame:
        """Entries of manifests, with what they inherit: entries that a commit added have its snapshot and sequence."""
        if not manifests:
            return self.spark.createDataFrame([], StructType.fromDDL(ENTRY + ", manifest string"))
        df = self.spark.read.schema(ENTRY).parquet(*[m["path"] for m in manifests])
        info = self.spark.createDataFrame([(m["path"].rpartition("/")[2], m["snapshot"], m["sequence"], m["path"]) for m in manifests], "_m string, _snap long, _seq long, manifest string")
        df = df.withColumn("_m", F.regexp_extract(F.col("_metadata.file_path"), r"/(m-[0-9a-f]{32})/", 1)).join(F.broadcast(info) if len(manifests) <= 100_000 else info, "_m")
        inherits = F.col("status") != 0
        df = df.withColumn("snapshot_id", F.when(inherits, F.coalesce("snapshot_id", "_snap")).otherwise(F.col("snapshot_id"))).withColumn("sequence", F.coalesce("sequence", "_seq"))
        return df.drop("_m", "_snap", "_seq")

    def live(self, snapshot: dict | None, content: str | None = None) -> DataFrame:
        chosen = [m for m in manifests_of(self, snapshot) if content in (None, m["content"]) and m["files"][0] + m["files"][1]]
        return self.entries(chosen).where("status <> 2")

    def partition_filter(self, where: Expr) -> Expr:
        """A bound filter as one of partition values that keeps every partition with a matching row, whatever its spec: for each spec, fields that it lacks say nothing."""
        return self._projected(where, [f for spec in self.meta["specs"] for f in spec])

    def _projected(self, where: Expr, fields: Sequence[dict]) -> Expr:
        full = self.full_schema()
        at = schemas.by_id(full)

        def leaf(e: Expr) -> Expr:
            if e.field is None:
                return e
            out = [project(e, f["transform"], f["name"], at[f["source"]][1].dataType) for f in fields if f["source"] in at and at[f["source"]][0] == e.path]
            return all_of(*out)

        return where.visit(leaf, lambda op, parts: (all_of if op == "and" else any_of)(*parts))

    def candidates(self, snapshot: dict | None, where: Expr, content: str = "data", version: int | None = None) -> DataFrame:
        """Live entries that the filter (bound) cannot rule out by partition summaries, partition values or bounds."""
        kinds = self.partition_kinds()
        by_partition, chosen = self.partition_filter(where), []
        for m in manifests_of(self, snapshot):
            s = {n: {k: value_from(x, kinds[n]) if k in ("lower", "upper") else x for k, x in v.items()} for n, v in m["summaries"].items()}
            if m["content"] == content and m["files"][0] + m["files"][1] and by_partition.may_match(s):
                chosen.append(m)
        df = self.entries(chosen).where("status <> 2")
        if where == TRUE:
            return df

        def part(e: Expr) -> dict[str, Column]:
            text = F.try_element_at("partition", F.lit(e.field))
            has, v = F.map_contains_key("partition", e.field), typed(text, kinds[e.field])
            return {"rows": F.when(has, F.lit(1)), "nulls": F.when(has, text.isNull().cast("int")), "lower": v, "upper": v}

        df = df.where(by_partition.may_match_column(part))
        return df.where(where.may_match_column(stats_columns(self._ids(version)))) if content == "data" else df

    def _ids(self, version: int | None = None) -> dict[str, tuple[int, Any]]:
        """Field -> id and type, for bounds: only fields whose type has never changed, for text of another type is no bound; and none with a default for old rows, which files do not know."""
        seen: dict[int, set[str]] = {}
        for doc in self.meta["schemas"]:
            for i, (_, f) in schemas.by_id(schemas.loaded(doc)).items():
                seen.setdefault(i, set()).add(f.dataType.simpleString())
        whole = ({"int", "bigint"}, {"float", "double"}, {"smallint", "int"}, {"smallint", "bigint"})
        return {".".join(p): (i, f.dataType) for i, (p, f) in schemas.by_id(self.full_schema(version)).items() if (len(seen[i]) == 1 or seen[i] in whole) and f.metadata.get("initial") is None}

    # Reading rows

    def read_entries(self, planned: DataFrame, deletes: DataFrame | None = None, version: int | None = None, lineage: bool = False, where: Expr = TRUE, tags: Sequence[str] = ()) -> DataFrame:
        """Rows of the files of planned entries in the columns of a schema version, without what deletes take away.

        Only files that a delete may touch go through the joins. Of planned,
        the paths come to the driver, as Spark's reader keeps them there too.
        """
        wanted = self.full_schema(version)
        planned = planned.select("file_path", "schema_id", "sequence", "spec_id", "partition", "first_row_id", "lower", "upper", "null_counts", "record_count", *tags)
        dirty = self._dirty(planned, deletes) if deletes is not None else None
        got = planned.join(dirty, "file_path", "left").select("file_path", "schema_id", F.coalesce("_dirty", F.lit(False)).alias("d")) if dirty is not None else planned.select("file_path", "schema_id", F.lit(False).alias("d"))
        groups: dict[tuple[int, bool], list[str]] = {}
        for r in dict.fromkeys(map(tuple, got.select("schema_id", "d", "file_path").collect())):
            groups.setdefault(r[:2], []).append(unquote(r[2]))
        parts = []
        kept = deletes is not None and any(d for _, d in groups) or lineage or bool(tags)
        for (v, d), paths in sorted(groups.items()):
            own = self.full_schema(v)
            physical = StructType([*schemas.plain(own).fields, *StructType.fromDDL("_row_id bigint, _last_updated_sequence_number bigint").fields]) if lineage else schemas.plain(own)
            df = self.spark.read.schema(physical).option("__globPaths__", "false").parquet(*sorted(paths))
            cols = schemas.reader(own, wanted)
            extra = [row_path().alias(_FILE), F.col("_metadata.row_index").alias(_POS)] if kept else []
            if lineage:
                extra += [F.col(c).alias(f"_own{c}") for c in _LINEAGE]
            df = df.select(*cols, *extra)
            if d:
                df = self._without(df, planned, deletes, sum(map(len, groups.values())))
            parts.append(df)
        if not parts:
            kinds = [*schemas.plain(wanted).fields, *(StructType.fromDDL("_row_id bigint, _last_updated_sequence_number bigint").fields if lineage else []), *[planned.schema[t] for t in tags]]
            return self.spark.createDataFrame([], StructType(kinds))
        out = reduce(DataFrame.unionByName, parts)
        if lineage or tags:
            info = planned.select(F.col("file_path").alias("_f"), F.col("first_row_id").alias("_first"), F.col("sequence").alias(_SEQ), *tags)
            out = out.join(info, F.col(_FILE) == F.col("_f"))
        made = [F.coalesce("_own_row_id", F.col("_first") + F.col(_POS)).alias("_row_id"), F.coalesce("_own_last_updated_sequence_number", _SEQ).alias("_last_updated_sequence_number")] if lineage else []
        return out.select(*[quoted(f.name) for f in wanted.fields], *made, *tags) if kept else out

    def _partition_key(self, c: str = "partition") -> Column:
        """A partition as one comparable value."""
        return F.to_json(F.array_sort(F.map_entries(c)))

    def _delete_files(self, deletes: DataFrame) -> list:
        """What the driver needs to know of delete files, whose paths it hands to readers; asked for once."""
        if not hasattr(deletes, "_files"):
            deletes._files = deletes.select("file_path", "content", "file_format", "schema_id", "sequence", "equality_ids", "spec_id", "record_count", F.when(F.size("partition") > 0, self._partition_key()).alias("scope")).collect()
        return deletes._files

    def _dirty(self, planned: DataFrame, deletes: DataFrame) -> DataFrame:
        """file_path and _dirty of the planned files that a delete may touch: named by deleted positions of the same or a later sequence, or older than deleted keys of their partition (or of all)."""
        files, out = self._delete_files(deletes), []
        if any(f["content"] == 1 for f in files):
            at = self._positions(deletes).groupBy("path").agg(F.max("seq").alias("seq"))
            out.append(planned.join(at, F.col("file_path") == F.col("path")).where(F.col("seq") >= F.col("sequence")).select("file_path"))
        everywhere = max((f["sequence"] for f in files if f["content"] == 2 and f["scope"] is None), default=None)
        if everywhere is not None:
            out.append(planned.where(F.col("sequence") < everywhere).select("file_path"))
        if any(f["content"] == 2 and f["scope"] is not None for f in files):
            own = deletes.where("content = 2 and size(partition) > 0").groupBy(F.col("spec_id").alias("_s"), self._partition_key().alias("_k")).agg(F.max("sequence").alias("_d"))
            out.append(planned.join(own, (F.col("spec_id") == F.col("_s")) & (self._partition_key() == F.col("_k"))).where(F.col("_d") > F.col("sequence")).select("file_path"))
        if not out:
            return planned.limit(0).select("file_path", F.lit(True).alias("_dirty"))
        return reduce(DataFrame.unionByName, out).distinct().withColumn("_dirty", F.lit(True))

    def _positions(self, deletes: DataFrame) -> DataFrame:
        """path, pos, seq and delete_path of all deleted positions: rows of delete files, and those of vectors."""
        rows, parts = [f for f in self._delete_files(deletes) if f["content"] == 1], []
        if plain := [unquote(f["file_path"]) for f in rows if f["file_format"] == "parquet"]:
            parts.append(self.spark.read.schema("file_path string, pos long").option("__globPaths__", "false").parquet(*plain).select(row_path().alias("_f"), F.col("file_path").alias("path"), "pos"))
        if vectors := [unquote(f["file_path"]) for f in rows if f["file_format"] != "parquet"]:
            from ..operators.vectors import positions

            df = self.spark.read.schema("file_path string, vector binary").option("__globPaths__", "false").parquet(*vectors).select(row_path().alias("_f"), F.col("file_path").alias("path"), "vector")
            parts.append(positions(df, "vector"))
        if not parts:
            return self.spark.createDataFrame([], "path string, pos long, seq long, delete_path string")
        seqs = self.spark.createDataFrame([(f["file_path"], f["sequence"]) for f in rows], "_d string, seq long")
        return reduce(DataFrame.unionByName, parts).join(_beside(seqs, len(rows)), F.col("_f") == F.col("_d")).select("path", "pos", "seq", F.col("_f").alias("delete_path"))

    def _without(self, df: DataFrame, planned: DataFrame, deletes: DataFrame, count: int) -> DataFrame:
        """Rows (with file and position) without deleted ones. count: files of planned."""
        files = self._delete_files(deletes)
        info = planned.select(F.col("file_path").alias("_f"), F.col("sequence").alias(_SEQ), F.struct("spec_id", self._partition_key().alias("p")).alias(_SPEC))
        out = df.join(_beside(info, count), F.col(_FILE) == F.col("_f")).drop("_f")
        if any(f["content"] == 1 for f in files):
            gone = self._positions(deletes).select(F.col("path").alias(_FILE), F.col("pos").alias(_POS), F.col("seq").alias(_SEQ))
            out = position_deletes(out, gone, _FILE, _POS, _SEQ, few=sum(f["record_count"] for f in files if f["content"] == 1) <= _FEW_POSITIONS)
        ids = schemas.by_id(self.full_schema())
        groups: dict[tuple, dict[int, list]] = {}
        for f in files:
            if f["content"] == 2:
                groups.setdefault((tuple(f["equality_ids"]), f["scope"] is not None), {}).setdefault(f["schema_id"], []).append(f)
        for (keys, scoped), versions in sorted(groups.items()):
            now, parts = StructType([ids[i][1] for i in keys]), []
            for v, own in versions.items():
                at = schemas.by_id(self.full_schema(v))
                then = StructType([at[i][1] for i in keys])
                rows = self.spark.read.schema(schemas.plain(then)).option("__globPaths__", "false").parquet(*[unquote(f["file_path"]) for f in own])
                parts.append(rows.select(*schemas.reader(then, now), row_path().alias("_f")))
            told = self.spark.createDataFrame([(f["file_path"], f["sequence"], f["spec_id"], f["scope"]) for own in versions.values() for f in own], "_d string, _s long, _i int, _k string")
            gone = reduce(DataFrame.unionByName, parts).join(told, F.col("_f") == F.col("_d")).select(*[quoted(f.name) for f in now.fields], F.col("_s").alias(_SEQ), F.struct(F.col("_i").alias("spec_id"), F.col("_k").alias("p")).alias(_SPEC))
            out = equality_deletes(out, gone, [*[f.name for f in now.fields], *([_SPEC] if scoped else [])], _SEQ)
        return out.drop(_SEQ, _SPEC)

    def scan(self) -> Scan:
        return Scan(self)

    def appended(self, after: int | None, upto: int | None = None, inclusive: bool = False) -> DataFrame:
        """Rows that append snapshots added after one snapshot (inclusive: from it on; null: from the first) up to another; deletes do not count."""
        ids = [s["id"] for s in self.span(after, upto, inclusive) if s["operation"] == "append"]
        return self.read_entries(self._added(ids).where("status = 1"))

    def _added(self, ids: Sequence[int]) -> DataFrame:
        """Data entries that these snapshots added or removed; every manifest is opened once."""
        wanted, found = set(ids), {}
        for s in self.meta["snapshots"]:
            if s["id"] in wanted:
                found |= {m["path"]: m for m in manifests_of(self, s) if m["snapshot"] == s["id"] and m["content"] == "data"}
        return self.entries([*found.values()]).where("status <> 0")

    def changes(self, after: int | None = None, upto: int | None = None, inclusive: bool = False) -> DataFrame:
        """Rows of the files that each snapshot after one (null: from the first) up to another added or removed, in the columns of the current schema.

        _change_type is INSERT or DELETE, _change_ordinal counts the snapshots
        from 0; compactions change no rows and are left out. Of a file that was
        rewritten, the rows that stayed show up as deleted and inserted again.
        All files are read in one pass, whatever the number of snapshots.
        Snapshots with deletes of rows within files are an error.
        """
        span = [s for s in self.span(after, upto, inclusive) if s["operation"] != "replace"]
        if any(m["content"] == "deletes" and m["snapshot"] == s["id"] for s in span for m in manifests_of(self, s)):
            raise ValueError("changes cannot tell rows that were deleted within files")
        order = self.spark.createDataFrame([(s["id"], k) for k, s in enumerate(span)], "snapshot_id long, _change_ordinal int")
        tagged = self._added([s["id"] for s in span]).join(F.broadcast(order), "snapshot_id")
        tagged = tagged.withColumn("_change_type", F.when(F.col("status") == 1, F.lit("INSERT")).otherwise(F.lit("DELETE"))).withColumn("_commit_snapshot_id", F.col("snapshot_id"))
        return self.read_entries(tagged, tags=("_change_type", "_change_ordinal", "_commit_snapshot_id"))

    def inspect(self, what: str) -> DataFrame:
        from .inspect import inspect

        return inspect(self, what)


def _beside(rows: DataFrame, count: int) -> DataFrame:
    """rows (about count, one a file) for a join with rows of the files: broadcast, so that a few large files are not shuffled to as few tasks, unless they are very many."""
    return F.broadcast(rows) if count <= _FEW_FILES else rows


def _now() -> int:
    return int(time.time() * 1000)


def _width(kind) -> int:
    """About how many bytes a value takes, for rolling files by rows."""
    return {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4, "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}.get(kind.simpleString(), 24)


class Transaction:
    """Changes of a table that are committed together; its own scans see them before that."""

    def __init__(self, table: Table, branch: str = "main") -> None:
        self.table, self.branch = table, branch
        self.view = Table(table.spark, table.root)
        self.base = copy.deepcopy(table.meta)
        self.view.meta, self.view.lists = copy.deepcopy(table.meta), table.lists
        self.steps: list[tuple[Change | None, Callable[[Table], None]]] = []
        self.done = False
        ref = table.meta["refs"].get(branch)
        if ref and ref["type"] != "branch":
            raise ValueError(f"{branch!r} is no branch")

    def scan(self) -> Scan:
        return Scan(self.view, ref=self.branch if self.branch in self.view.meta["refs"] else None)

    # Rows

    def append(self, df: DataFrame, summary: dict | None = None) -> None:
        self._stage(Change("append", self.branch, [self._own(self.view.write_files(df, branch=self.branch))], summary=summary or {}))

    def write(self, df: DataFrame) -> DataFrame:
        """Data files of df that no commit knows yet; commit_files() takes them."""
        out = self.view.write_files(df, branch=self.branch)
        self.view.folders.pop()  # stays, whatever becomes of this transaction
        return out

    def commit_files(self, *written: DataFrame, removed: DataFrame | None = None, operation: str | None = None) -> None:
        """Adds written files, and takes away those at the file_paths of removed."""
        self._stage(Change(operation or ("append" if removed is None else "overwrite"), self.branch, [self._own(w) for w in written], removed, needs=removed))

    def add_files(self, paths: Sequence[str]) -> None:
        """Takes existing Parquet files into the table as they are. Their columns are matched by name, through the table's name mapping if it has one; partition values are those that the files' bounds prove."""
        v, spark = self.view, self.view.spark
        known = v.live(v.head(self.branch), "data").select("file_path")
        files = spark.createDataFrame([(p,) for p in paths], "path string")
        files = files.join(_sized(v, paths), "path").select("file_path", "file_size")
        if files.join(known, "file_path", "left_semi").limit(1).count():
            raise ValueError("some of these files are in the table already")
        full = v.full_schema()
        mapping = json.loads(v.property("schema.name-mapping.default") or "null")
        found = schemas.plain(spark.read.option("mergeSchema", "true").parquet(*paths).schema)
        own = schemas.mapped(found, mapping or schemas.name_mapping(full))
        ids = schemas.by_id(full)
        for i, (path, f) in schemas.by_id(own).items():
            if i not in ids or not schemas.may_become(f.dataType, ids[i][1].dataType) and not isinstance(f.dataType, (StructType,)):
                raise ValueError(f"{'.'.join(path)!r} is {f.dataType.simpleString()}")
        for f in full.fields:
            if not f.nullable and f.metadata["id"] not in schemas.by_id(own):
                raise ValueError(f"required column {f.name!r} is missing")
        if schemas.dumped(own) not in [{k: x for k, x in d.items() if k != "identifiers"} for d in v.meta["schemas"]]:
            self._metadata(lambda t: t.meta["schemas"].append(schemas.dumped(own) | {"identifiers": []}))
        number = next(i for i, d in enumerate(v.meta["schemas"]) if {k: x for k, x in d.items() if k != "identifiers"} == schemas.dumped(own))
        rows = footers(files, own, [], v.meta["properties"])
        pairs = []
        for f in v.spec():
            path, kind, _ = v._source(f, ids)
            lo, hi = (typed(F.try_element_at(b, F.lit(f["source"])), kind) for b in ("lower", "upper"))
            none = F.try_element_at("null_counts", F.lit(f["source"])) == F.col("record_count")
            a, z = (transforms.apply(f["transform"], x, kind) for x in (lo, hi))
            if not transforms.keeps_order(f["transform"]):
                a, z = F.when(lo == hi, a), F.when(lo == hi, z)
            out = transforms.result_type(f["transform"], kind)
            sure = F.when(none, F.lit(None).cast("string")).when((a == z) & (F.try_element_at("null_counts", F.lit(f["source"])) == 0), as_text(a, out)).otherwise(F.raise_error(F.concat(F.lit(f"more than one {f['name']} in "), F.col("file_path"))).cast("string"))
            pairs.append(F.struct(F.lit(f["name"]), sure))
        if pairs:
            rows = rows.withColumn("partition", F.map_from_entries(F.array(*pairs)))
        self._stage(Change("append", self.branch, [self._own(v._entries(rows, 0, schema_id=F.lit(number)))]))

    def delete(self, where: Expr, mode: str | None = None) -> None:
        """Rows that match go; rows for which the filter is null stay. copy-on-write drops files that match whole and rewrites those that may match; merge-on-read writes the positions of matching rows instead of rewriting."""
        mode = mode or self.view.property("write.delete.mode")
        if mode not in ("copy-on-write", "merge-on-read"):
            raise ValueError(f"unknown delete mode {mode!r}")
        level = self.view.property("write.delete.isolation-level")
        if mode == "merge-on-read":
            return self._delete_merged(where, level)
        self._replace(where, None, "delete", level)
        return None

    def overwrite(self, df: DataFrame, where: Expr = TRUE) -> None:
        self._replace(where, df, "overwrite", self.view.property("write.update.isolation-level"))

    def _matching(self, where: Expr) -> tuple[Expr, DataFrame, DataFrame, DataFrame]:
        """The bound filter, entries that match whole, entries that may match in part, and all deletes."""
        v, head = self.view, self.view.head(self.branch)
        bound = where.bind(v.schema())
        entries = v.candidates(head, bound)
        deletes = v.live(head, "deletes")
        must = bound.must_match_column(stats_columns(v._ids()))
        return bound, entries.where(must), entries.where(~must), deletes

    def _replace(self, where: Expr, df: DataFrame | None, operation: str, level: str) -> None:
        v = self.view
        bound, whole, part, deletes = self._matching(where)
        lineage = v.property("format-version") == "3"
        own = part.select("file_path").distinct()
        removed = _kept(v, whole.select("file_path").unionByName(own))
        added = []
        if part.limit(1).count():
            rows = v.read_entries(part, deletes if v._delete_files(deletes) else None, lineage=lineage)
            added.append(self._own(v.write_files(rows.where(~F.coalesce(bound.column(v.schema()), F.lit(False))), lineage, self.branch)))
        if df is not None:
            added.append(self._own(v.write_files(df, branch=self.branch)))
        self._stage(Change(operation, self.branch, added, removed, bound, level, needs=removed, rewrites=True))

    def _delete_merged(self, where: Expr, level: str) -> None:
        v = self.view
        if v.property("format-version") == "1":
            raise ValueError("format version 1 has no deletes of rows")
        bound, whole, part, deletes = self._matching(where)
        removed = _kept(v, whole.select("file_path"))
        rows = self._located(part, deletes).where(F.coalesce(bound.column(v.schema()), F.lit(False))).select(F.col(_FILE).alias("file_path"), F.col(_POS).alias("pos"))
        self._positions_change(rows, "delete", removed, bound, level)

    def _located(self, planned: DataFrame, deletes: DataFrame) -> DataFrame:
        """Rows of entries with their file and position, deleted ones left out."""
        v = self.view
        some = bool(v._delete_files(deletes))
        groups: dict[int, list[str]] = {}
        for r in planned.select("file_path", "schema_id").collect():
            groups.setdefault(r["schema_id"], []).append(unquote(r["file_path"]))
        parts = []
        for number, paths in groups.items():
            own = v.full_schema(number)
            df = v.spark.read.schema(schemas.plain(own)).option("__globPaths__", "false").parquet(*paths)
            df = df.select(*schemas.reader(own, v.full_schema()), row_path().alias(_FILE), F.col("_metadata.row_index").alias(_POS))
            parts.append(v._without(df, planned, deletes, sum(map(len, groups.values()))) if some else df)
        if parts:
            return reduce(DataFrame.unionByName, parts)
        return v.spark.createDataFrame([], StructType([*v.schema().fields, *StructType.fromDDL(f"{_FILE} string, {_POS} long").fields]))

    def _position_files(self, rows: DataFrame, number: int | None = None) -> tuple[DataFrame, DataFrame | None]:
        """Delete files of file_path and pos: sorted, with the files that they name; as vectors in format 3, merged with those that are there, which go."""
        v = self.view
        folder = v._location(self.branch)
        if v.property("format-version") == "3":
            from ..operators.vectors import vectors

            old = v.live(v.head(self.branch), "deletes").where("content = 1 and file_format = 'vector'")
            rows, gone = rows.select("file_path", "pos"), None
            if old.limit(1).count():
                touched = rows.select(F.col("file_path").alias("_t")).distinct()
                mine = v._positions(old).join(touched, F.col("path") == F.col("_t"), "left_semi").select(F.col("path").alias("file_path"), "pos")
                paths = v.spark.read.schema("file_path string, vector binary").parquet(*[unquote(r["file_path"]) for r in old.select("file_path").collect()]).select(row_path().alias("v"), "file_path")
                whole = paths.join(touched, F.col("file_path") == F.col("_t"), "left").groupBy("v").agg(F.count_if(F.col("_t").isNull()).alias("other"))
                others = paths.join(whole.where("other > 0 and other is not null").select(F.col("v").alias("_w")), F.col("v") == F.col("_w")).join(touched, F.col("file_path") == F.col("_t"), "left_anti").select("file_path").distinct()
                hit = paths.join(touched, F.col("file_path") == F.col("_t"), "left_semi").select(F.col("v").alias("file_path")).distinct()
                moved = v._positions(old.join(hit, "file_path", "left_semi")).join(others.withColumnRenamed("file_path", "_o"), F.col("path") == F.col("_o"), "left_semi").select(F.col("path").alias("file_path"), "pos")
                rows, gone = rows.unionByName(mine).unionByName(moved), _kept(v, hit)
            made = vectors(rows, "file_path", "pos")
            made.write.parquet(folder)
            files = listed(v.spark, folder)
            per = v.spark.read.parquet(folder).groupBy(row_path().alias("f")).agg(F.sum("cardinality").alias("record_count"), F.when(F.count("*") == 1, F.max("file_path")).alias("referenced_file"))
            out = files.join(per, F.col("file_path") == F.col("f")).drop("f", "modified")
            return v._entries(out, 1, file_format=F.lit("vector"), partition=F.expr("cast(map() as map<string,string>)")), gone
        rows.select("file_path", "pos").distinct().hint("rebalance", F.col("file_path")).sortWithinPartitions("file_path", "pos").write.parquet(folder)
        files = listed(v.spark, folder)
        per = v.spark.read.schema("file_path string, pos long").parquet(folder).groupBy(row_path().alias("f")).agg(F.count("*").alias("record_count"), F.min("file_path").alias("lo"), F.max("file_path").alias("hi"))
        out = files.join(per, F.col("file_path") == F.col("f")).select("file_path", "file_size", "record_count", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("referenced_file"))
        return v._entries(out, 1, partition=F.expr("cast(map() as map<string,string>)")), None

    def _positions_change(self, rows: DataFrame, operation: str, removed: DataFrame | None, where: Expr | None, level: str) -> None:
        v = self.view
        rows = _kept(v, rows)
        added, gone = [], None
        if rows.limit(1).count():
            entries, gone = self._position_files(rows)
            added = [self._own(entries)]
        named = _kept(v, rows.select("file_path").distinct())
        out = [x for x in (removed, gone) if x is not None]
        self._stage(Change(operation, self.branch, added, reduce(DataFrame.unionByName, out) if out else None, where, level, needs=named))

    def _key_files(self, keys: DataFrame) -> DataFrame:
        v = self.view
        if v.property("format-version") == "1":
            raise ValueError("format version 1 has no deletes of rows")
        full = v.full_schema()
        ids = []
        for c in keys.columns:
            path, kind, _ = resolve(full, c)
            if kind.simpleString() in ("float", "double"):
                raise ValueError(f"a float cannot be a key: {c!r}")
            ids.append(next(i for i, (p, _) in schemas.by_id(full).items() if p == path))
        own = StructType([schemas.by_id(full)[i][1] for i in ids])
        folder = v._location(self.branch)
        keys.select(*[F.col(quoted(c)).cast(f.dataType).alias(f.name) for c, f in zip(keys.columns, own.fields, strict=True)]).distinct().write.parquet(folder)
        rows = measured(v.spark, folder, own, [], v.meta["properties"]).where("record_count > 0").withColumn("partition", F.expr("cast(map() as map<string,string>)"))
        return v._entries(rows, 2, equality_ids=F.array(*[F.lit(i) for i in ids]))

    def delete_keys(self, keys: DataFrame) -> None:
        """Rows of earlier commits whose values in the columns of keys are among its rows go; null equals null. No keys, no commit."""
        if keys.isEmpty():
            return
        self._stage(Change("delete", self.branch, [self._own(self._key_files(keys))], keys=True, isolation=self.view.property("write.delete.isolation-level")))

    def row_delta(self, rows: DataFrame | None = None, keys: DataFrame | None = None, positions: DataFrame | None = None) -> None:
        """New rows, deleted keys and deleted positions (file_path, pos) in one snapshot. Deleted keys do not touch the new rows. Rows with a _row_id (format version 3) are put back under it, as after an update; a null one gets a new id."""
        added, needs, gone = [], None, None
        if rows is not None:
            lineage = self.view.property("format-version") == "3" and "_row_id" in rows.columns
            added.append(self._own(self.view.write_files(rows, lineage, self.branch)))
        if keys is not None and not keys.isEmpty():
            added.append(self._own(self._key_files(keys)))
        if positions is not None and not positions.isEmpty():
            entries, gone = self._position_files(positions)
            added.append(self._own(entries))
            needs = _kept(self.view, positions.select("file_path").distinct())
        kind = "append" if keys is None and positions is None else "delete" if rows is None else "overwrite"
        self._stage(Change(kind, self.branch, added, gone, keys=keys is not None, needs=needs, isolation=self.view.property("write.delete.isolation-level")))

    def rewrite(self, planned: DataFrame, rows: DataFrame, dead: DataFrame | None = None, partitions: int | None = None) -> None:
        """Files of planned are replaced by files of rows, which must be the same rows; dead: file_path of deletes that touch nothing any more."""
        removed = planned.select("file_path")
        removed = _kept(self.view, removed if dead is None else removed.unionByName(dead))
        lineage = self.view.property("format-version") == "3"
        self._stage(Change("replace", self.branch, [self._own(self.view.write_files(rows, lineage, self.branch, partitions))], removed, needs=removed, rewrites=True))

    # Metadata

    def evolve(self, change: Callable[[schemas.Update], Any]) -> None:
        def step(t: Table) -> None:
            doc = t.meta["schemas"][t.meta["current_schema"]]
            u = schemas.Update(t.full_schema(), t.meta["last_id"], doc.get("identifiers", ()))
            change(u)
            used = {f["source"] for f in t.spec()} | {f["source"] for f in t.meta["orders"][t.meta["current_order"]]}
            if lost := used - set(schemas.by_id(u.schema)):
                raise ValueError(f"the partition spec or sort order uses columns {sorted(lost)}")
            t.meta["schemas"].append(schemas.dumped(u.schema) | {"identifiers": u.identifiers})
            t.meta.update(last_id=u.last_id, current_schema=len(t.meta["schemas"]) - 1)
            if mapping := t.property("schema.name-mapping.default"):
                t.meta["properties"]["schema.name-mapping.default"] = json.dumps(schemas.updated_mapping(json.loads(mapping), u.schema))

        self._metadata(step, same=("current_schema",))

    def repartition(self, add: Sequence[str | tuple] = (), remove: Sequence[str] = (), rename: dict[str, str] | None = None) -> None:
        """A new partition spec for what is written from now on; files keep theirs."""

        def step(t: Table) -> None:
            spec = [*t.spec()]
            names = [f["name"] for f in spec]
            for n in [*remove, *(rename or {})]:
                if n not in names:
                    raise ValueError(f"no partition field {n!r}")
            spec = [f | {"name": (rename or {}).get(f["name"], f["name"])} for f in spec if f["name"] not in remove]
            for p in add:
                spec.append(t._partition_field(p, t.full_schema(), spec))
            if len({f["name"] for f in spec}) < len(spec):
                raise ValueError("two partition fields of one name")
            if spec not in t.meta["specs"]:
                t.meta["specs"].append(spec)
            t.meta["current_spec"] = t.meta["specs"].index(spec)

        self._metadata(step, same=("current_spec", "current_schema"))

    def sort_by(self, *order: tuple) -> None:
        def step(t: Table) -> None:
            made = t._sort_fields(order, t.full_schema())
            if made not in t.meta["orders"]:
                t.meta["orders"].append(made)
            t.meta["current_order"] = t.meta["orders"].index(made)

        self._metadata(step, same=("current_order", "current_schema"))

    def set_properties(self, values: dict[str, str | None]) -> None:
        """Null removes a property. The format version only grows."""

        def step(t: Table) -> None:
            before = int(t.property("format-version"))
            for k, v in values.items():
                t.meta["properties"].pop(k, None) if v is None else t.meta["properties"].update({k: str(v)})
            after = int(t.property("format-version"))
            if after < before or after > 3:
                raise ValueError(f"format version {before} cannot become {after}")

        self._metadata(step)

    def tag(self, name: str, snapshot_id: int | None = None, kind: str = "tag", **retention: int) -> None:
        """A name for a snapshot (null: main's head). kind: tag or branch; retention: max_ref_age_ms, max_snapshot_age_ms, min_snapshots_to_keep."""

        def step(t: Table) -> None:
            target = t.snapshot(snapshot_id) if snapshot_id is not None else t.head()
            if target is None or kind not in ("tag", "branch") or name == "main" and kind != "branch":
                raise ValueError(f"cannot make {kind} {name!r}")
            t.meta["refs"][name] = {"type": kind, "snapshot": target["id"]} | retention

        self._metadata(step)

    def drop_ref(self, name: str) -> None:
        def step(t: Table) -> None:
            if name == "main" or name not in t.meta["refs"]:
                raise ValueError(f"cannot drop {name!r}")
            del t.meta["refs"][name]

        self._metadata(step)

    def rollback(self, snapshot_id: int) -> None:
        """The branch goes back to one of its head's ancestors."""

        def step(t: Table) -> None:
            if self.branch not in t.meta["refs"]:
                raise ValueError(f"no branch {self.branch!r}")
            if snapshot_id not in [s["id"] for s in t.ancestors(t.head(self.branch)["id"])]:
                raise ValueError(f"{snapshot_id} is no ancestor of the head of {self.branch}")
            t.meta["refs"][self.branch] = t.meta["refs"][self.branch] | {"snapshot": snapshot_id}
            if self.branch == "main":
                t.meta["log"].append({"ms": _now(), "snapshot": snapshot_id})

        self._metadata(step, same=())

    def update(self, step: Callable[[Table], None]) -> None:
        """Any other change of the metadata; replayed on a newer version if another writer is first."""
        self._metadata(step)

    # Committing

    def _own(self, entries: DataFrame) -> dict:
        return self.view.manifest(entries)

    def _metadata(self, step: Callable[[Table], None], same: Sequence[str] = ()) -> None:
        def checked(t: Table) -> None:
            if any(t.meta[k] != self.base[k] for k in same) and t is not self.view:
                raise CommitConflict(f"another commit has changed {', '.join(same)}")
            step(t)

        checked(self.view)
        self.steps.append((None, checked))

    def _stage(self, change: Change) -> None:
        self._apply(self.view, change)
        self.steps.append((change, lambda t: self._apply(t, change)))

    def _apply(self, t: Table, change: Change) -> None:
        """A snapshot of the change on top of t's head."""
        meta, parent = t.meta, t.head(change.branch)
        sid, seq = uuid.uuid4().int >> 66, meta["sequence"] + 1
        kept, gone = [], []
        rewritten = self._less(t, parent, change.removed) if change.removed is not None else {}
        for m in manifests_of(t, parent):
            if m["path"] not in rewritten:
                kept.append(m)
            elif rewritten[m["path"]] is not None:
                gone.append(rewritten[m["path"]] | {"snapshot": sid, "sequence": seq})
        added = [m | {"snapshot": sid, "sequence": seq, "least": seq} for m in change.added if m["files"][1]]
        now = max(_now(), meta["updated"])
        data, dels = [m for m in added if m["content"] == "data"], [m for m in added if m["content"] == "deletes"]
        lost = [m for m in gone if m["content"] == "data"]
        summary = {"added-data-files": sum(m["files"][1] for m in data), "added-records": sum(m["rows"][1] for m in data), "added-files-size": sum(m["size"][1] for m in data), "added-delete-files": sum(m["files"][1] for m in dels), "added-equality-deletes": sum(m["keys"][1] for m in dels)}
        summary["added-position-deletes"] = sum(m["rows"][1] for m in dels) - summary["added-equality-deletes"]
        summary |= {"deleted-data-files": sum(m["files"][2] for m in lost), "deleted-records": sum(m["rows"][2] for m in lost), "removed-files-size": sum(m["size"][2] for m in lost), "removed-delete-files": sum(m["files"][2] for m in gone if m["content"] == "deletes")}
        removed_keys = sum(m["keys"][2] for m in gone)
        removed_positions = sum(m["rows"][2] for m in gone if m["content"] == "deletes") - removed_keys
        old = parent["summary"] if parent else {}
        for total, more, less in (("data-files", "added-data-files", "deleted-data-files"), ("records", "added-records", "deleted-records"), ("files-size", "added-files-size", "removed-files-size"), ("delete-files", "added-delete-files", "removed-delete-files")):
            summary[f"total-{total}"] = int(old.get(f"total-{total}", 0)) + summary[more] - summary[less]
        summary["total-position-deletes"] = int(old.get("total-position-deletes", 0)) + summary["added-position-deletes"] - removed_positions
        summary["total-equality-deletes"] = int(old.get("total-equality-deletes", 0)) + summary["added-equality-deletes"] - removed_keys
        snap = {"id": sid, "parent": parent["id"] if parent else None, "ms": now, "sequence": seq, "operation": change.operation, "schema": meta["current_schema"], "manifests": [*kept, *gone, *added], "summary": {k: v for k, v in (summary | change.summary).items()}}
        if t.property("format-version") == "3":
            snap["first_row_id"] = meta["next_row_id"]
            for m in snap["manifests"]:
                if m["snapshot"] == sid and m["content"] == "data" and m["files"][1]:
                    m["first_row_id"] = meta["next_row_id"]
                    meta["next_row_id"] += m["rows"][1]
            self._number(t, snap)
        if (most := int(t.property("write.summary.partition-limit") or 0)) > 0:
            snap["summary"] |= self._by_partition(t, [m for m in snap["manifests"] if m["snapshot"] == sid], most)
        if t.property("commit.manifest-merge.enabled") == "true":
            from .maintenance import merged

            snap["manifests"] = merged(t, snap["manifests"], sid, seq)
        meta["sequence"] = seq
        meta["snapshots"] = [*meta["snapshots"], snap]
        meta["refs"] = meta["refs"] | {change.branch: (meta["refs"].get(change.branch) or {"type": "branch"}) | {"snapshot": sid}}
        if change.branch == "main":
            meta["log"] = [*meta["log"], {"ms": now, "snapshot": sid}]
        meta["updated"] = now

    @staticmethod
    def _by_partition(t: Table, manifests: list[dict], most: int) -> dict[str, str]:
        """Counts of each partition that a commit changes, if they are few enough."""
        df = t.entries(manifests).where("status <> 0 and content = 0 and size(partition) > 0")
        of = lambda s, x: F.sum(F.when(F.col("status") == s, x).otherwise(0))
        rows = df.groupBy(t._partition_key().alias("k")).agg(F.any_value("partition").alias("p"), of(1, F.lit(1)).alias("a"), of(1, F.col("record_count")).alias("r"), of(2, F.lit(1)).alias("d"), of(2, F.col("record_count")).alias("l")).limit(most + 1).collect()
        if len(rows) > most:
            return {}
        kinds, spec = t.partition_kinds(), {f["name"]: f["transform"] for s in t.meta["specs"] for f in s}
        name = lambda p: "/".join(f"{k}={transforms.readable(spec[k], value_from(v, kinds[k]))}" for k, v in sorted(p.items()))
        return {"changed-partition-count": str(len(rows))} | {f"partitions.{name(r['p'])}": f"added-data-files={r['a']},added-records={r['r']},deleted-data-files={r['d']},deleted-records={r['l']}" for r in rows}

    def _number(self, t: Table, snap: dict) -> None:
        """First row ids of the files that a commit adds, in the order of their paths: one running sum over its own files."""
        for m in snap["manifests"]:
            if m["snapshot"] == snap["id"] and m.get("first_row_id") is not None:
                from pyspark.sql import Window

                df = t.spark.read.schema(ENTRY).parquet(m["path"])
                mine = df.where("status = 1").select(F.col("file_path").alias("_f"), (F.lit(m["first_row_id"]) + F.sum("record_count").over(Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, 0)) - F.col("record_count")).alias("_first"))
                out = t._manifest_table(df.join(mine, F.col("file_path") == F.col("_f"), "left").withColumn("first_row_id", F.coalesce("first_row_id", "_first")).drop("_f", "_first").select(*df.columns))
                m["path"] = out._manifest_path

    def _less(self, t: Table, parent: dict | None, removed: DataFrame) -> dict[str, dict | None]:
        """Manifests that list removed files -> what takes their place: kept entries as they were, removed ones marked."""
        live = t.live(parent)
        gone = removed.select(F.col("file_path").alias("_gone")).distinct()
        hit = [r["manifest"] for r in live.join(gone, F.col("file_path") == F.col("_gone"), "left_semi").select("manifest").distinct().collect()]
        out: dict[str, dict | None] = {}
        for m in manifests_of(t, parent):
            if m["path"] in hit:
                df = t.entries([m]).where("status <> 2").join(gone, F.col("file_path") == F.col("_gone"), "left")
                df = df.withColumn("status", F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.lit(2))).withColumn("snapshot_id", F.when(F.col("_gone").isNull(), F.col("snapshot_id")))
                out[m["path"]] = t.manifest(t._manifest_table(df.select(*[f.name for f in StructType.fromDDL(ENTRY).fields])))
        return out

    def commit(self) -> Table:
        """Publishes all changes as one version; if another writer was first, they are checked against what it did and made again on top of it, as often as commit.retry.num-retries says. The table stands at the latest version afterwards, whether this fails or not."""
        if self.done:
            raise RuntimeError("this transaction is over")
        self.done = True
        if not self.steps:
            return self.table
        tries, wait = int(self.table.property("commit.retry.num-retries")), int(self.table.property("commit.retry.min-wait-ms"))
        meta = self.view.meta
        if self.table.meta["version"] != self.base["version"]:
            meta = None  # the handle has moved on
        try:
            return self._published(meta, tries, wait)
        except CommitConflict:
            self._discard()
            raise
        finally:
            for path in self.view.staged:
                self.view.files.fs.delete(self.view.files.path(path), True)

    def _discard(self) -> None:
        """Files that were written for a commit that failed go."""
        paths = [m["path"] for change, _ in self.steps if change is not None for m in change.added]
        for p in [*self.view.folders, *paths]:
            self.view.files.fs.delete(self.view.files.path(p), True)

    def _published(self, meta: dict | None, tries: int, wait: int) -> Table:
        while True:
            if meta is not None and self.table._publish(meta):
                return self.table
            self.table.refresh()
            if tries <= 0:
                raise CommitConflict(f"version {self.base['version'] + 1} was committed by another writer")
            tries -= 1
            time.sleep(min(wait, int(self.table.property("commit.retry.max-wait-ms"))) / 1000)
            wait *= 2
            again = Table(self.table.spark, self.table.root)
            again.meta, again.lists = copy.deepcopy(self.table.meta), self.table.lists
            for change, step in self.steps:
                if change is not None:
                    self._validate(again, change)
                step(again)
            meta = again.meta

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.commit()

    def _validate(self, t: Table, change: Change) -> None:
        """What other commits since the base did must leave the change right."""
        before = self.base["refs"].get(change.branch, self.base["refs"].get("main", {})).get("snapshot")
        head = t.head(change.branch)
        line = t.ancestors(head["id"] if head else None)
        ids = [s["id"] for s in line]
        if before is not None and before not in ids:
            raise CommitConflict("the branch was moved to another line of snapshots")
        since = {s["id"] for s in line[: ids.index(before)]} if before is not None else set(ids)
        fresh = [m for m in manifests_of(t, head) if m["snapshot"] in since]
        if change.needs is not None:
            live = t.live(head).select("file_path")
            if change.needs.join(live, "file_path", "left_anti").limit(1).count():
                raise CommitConflict("files that this commit counts on are gone")
        new = t.entries(fresh).where("status = 1")
        if change.rewrites and new.where("content > 0").limit(1).count():
            raise CommitConflict("files that this commit rewrites have got new deletes")
        if change.isolation == "serializable" and (change.where is not None or change.keys):
            added = new.where("content = 0")
            if change.where is not None:
                added = added.where(change.where.may_match_column(stats_columns(t._ids())))
            if added.limit(1).count():
                raise CommitConflict("rows were added that this commit would have had to look at")


def _kept(t: Table, df: DataFrame) -> DataFrame:
    """A frame that a commit may need again, written once beside the manifests."""
    path = t._manifest_path().replace("/m-", "/staged-")
    t.staged.append(path)
    df.write.parquet(path)
    return t.spark.read.schema(df.schema).parquet(path)


def _sized(t: Table, paths: Sequence[str]) -> DataFrame:
    df = t.spark.read.format("binaryFile").option("__globPaths__", "false").load([*paths])
    name = uri(F.col("path"))
    asked = t.spark.createDataFrame([(p, t.files.uri(p)) for p in paths], "path string, file_path string")
    return asked.join(df.select(name.alias("_u"), F.col("length").alias("file_size")), F.col("file_path") == F.col("_u")).drop("_u")


@dataclass(frozen=True)
class Scan:
    """An immutable scan: columns, filter, snapshot and limit."""

    table: Table
    columns: tuple[str, ...] = ("*",)
    where: Expr = TRUE
    snapshot_id: int | None = None
    time_ms: int | None = None
    ref: str | None = None
    rows: int | None = None
    case_sensitive: bool = True
    lineage: bool = False
    options: tuple[tuple[str, str], ...] = ()
    planner: Callable[[Scan], DataFrame] | None = None

    def select(self, *names: str) -> Scan:
        return replace(self, columns=names)

    def filter(self, where: Expr) -> Scan:
        """Replaces the filter."""
        return replace(self, where=where)

    def use(self, snapshot_id: int | None = None, time_ms: int | None = None, ref: str | None = None) -> Scan:
        if sum(x is not None for x in (snapshot_id, time_ms, ref)) > 1:
            raise ValueError("a scan takes one of snapshot, time and reference")
        return replace(self, snapshot_id=snapshot_id, time_ms=time_ms, ref=ref)

    def limit(self, rows: int) -> Scan:
        return replace(self, rows=rows)

    def with_lineage(self) -> Scan:
        """Adds _row_id and _last_updated_sequence_number (format version 3)."""
        if self.table.property("format-version") != "3":
            raise ValueError("rows have ids from format version 3 on")
        return replace(self, lineage=True)

    def option(self, name: str, value: str | int) -> Scan:
        """A Spark setting that holds while this scan is planned and read, such as spark.sql.files.maxPartitionBytes or spark.sql.parquet.columnarReaderBatchSize."""
        return replace(self, options=(*self.options, (name, str(value))))

    def planned_by(self, planner: Callable[[Scan], DataFrame] | None) -> Scan:
        """Tasks from another planner (such as a service); null: from this table's manifests."""
        return replace(self, planner=planner)

    def plan_splits(self) -> DataFrame:
        """Tasks cut into ranges of whole row groups (start and length) of about read.split.target-size; files of unknown row groups are one range."""
        from pyspark.sql import Window

        size = int(self.table.property("read.split.target-size"))
        tasks = self.plan_files()
        parts = tasks.select("file_path", "file_size", F.explode(F.when(F.size("split_offsets") > 0, F.array_sort("split_offsets")).otherwise(F.array(F.lit(0).cast("long")))).alias("start"))
        after = F.coalesce(F.lead("start").over(Window.partitionBy("file_path").orderBy("start")), F.col("file_size"))
        parts = parts.withColumn("end", after).withColumn("cut", F.call_function("div", F.col("start"), F.lit(size).cast("long")))
        return parts.groupBy("file_path", "cut").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length")).drop("cut")

    def _chosen(self) -> tuple[dict | None, int]:
        t = self.table
        now = t.meta["current_schema"]
        if self.snapshot_id is not None or self.time_ms is not None:
            s = t.snapshot(self.snapshot_id) if self.snapshot_id is not None else t.as_of(self.time_ms)
            return s, s["schema"]
        if self.ref is not None:
            if self.ref not in t.meta["refs"]:
                raise ValueError(f"no reference {self.ref!r}")
            s = t.head(self.ref)
            return s, s["schema"] if t.meta["refs"][self.ref]["type"] == "tag" else now
        return t.head(), now

    def schema(self) -> StructType:
        return self.table.schema(self._chosen()[1])

    def _bound(self) -> Expr:
        return self.where.bind(self.schema(), self.case_sensitive)

    def plan_files(self) -> DataFrame:
        """Tasks as rows: the entry of every data file that the filter cannot rule out, with the number of delete files that may touch it and what is left of the filter. With a limit and no filter or deletes, no more files than hold so many rows."""
        snapshot, version = self._chosen()
        bound = self._bound()
        t = self.table
        planned = t.candidates(snapshot, bound, version=version)
        deletes = t.live(snapshot, "deletes")
        some = any(m["content"] == "deletes" for m in manifests_of(t, snapshot))
        dirty = t._dirty(planned, deletes) if some else None
        out = planned.join(dirty, "file_path", "left").withColumn("has_deletes", F.coalesce("_dirty", F.lit(False))).drop("_dirty") if dirty is not None else planned.withColumn("has_deletes", F.lit(False))
        whole = bound.must_match_column(stats_columns(t._ids(version)))
        out = out.withColumn("residual", F.when(whole, F.lit("true")).otherwise(F.lit(bound.to_json())))
        if self.rows is not None and bound == TRUE and not some:
            from pyspark.sql import Window

            before = Window.orderBy(F.desc("record_count"), "file_path").rowsBetween(Window.unboundedPreceding, -1)
            few = out.orderBy(F.desc("record_count"), "file_path").limit(max(1, self.rows))  # each has a row at least
            out = few.withColumn("_b", F.coalesce(F.sum("record_count").over(before), F.lit(0))).where(F.col("_b") < self.rows).drop("_b")
        return out

    def read(self, tasks: DataFrame) -> DataFrame:
        """Rows of some planned tasks."""
        snapshot, version = self._chosen()
        t, bound = self.table, self._bound()
        some = any(m["content"] == "deletes" for m in manifests_of(t, snapshot))
        with _set(t.spark, self.options):
            out = t.read_entries(tasks, t.live(snapshot, "deletes") if some else None, version, self.lineage, bound)
        if bound != TRUE:
            out = out.where(bound.column(self.schema()))
        kinds = self.schema()
        if self.columns != ("*",):
            cols = []
            for c in self.columns:
                path, _, _ = resolve(kinds, c, self.case_sensitive)
                cols.append(reduce(lambda x, n: x.getField(n), path[1:], F.col(quoted(path[0]))).alias(path[-1]))
            out = out.select(*cols, *(_LINEAGE if self.lineage else ()))
        return out if self.rows is None else out.limit(self.rows)

    def to_df(self) -> DataFrame:
        for c in self.columns:
            if c != "*":
                resolve(self.schema(), c, self.case_sensitive)
        snapshot, version = self._chosen()
        if self.planner is not None:
            return self.read(self.planner(self))
        plain = self.rows is not None and self._bound() == TRUE
        return self.read(self.plan_files() if plain else self.table.candidates(snapshot, self._bound(), version=version))

    def to_arrow(self):
        return self.to_df().toArrow()

    def records(self):
        """Schema and an iterator over rows that fetches a partition at a time."""
        df = self.to_df()
        return df.schema, df.toLocalIterator()

    def count(self) -> int:
        """Rows of the scan: from manifests alone where nothing is left of the filter and no delete may touch a file."""
        tasks = self.plan_files()
        r = tasks.agg(F.sum("record_count").alias("n"), F.count_if((F.col("residual") != "true") | F.col("has_deletes")).alias("open")).first()
        return (r["n"] or 0) if not r["open"] and self.rows is None else self.to_df().count()


@contextmanager
def _set(spark: SparkSession, options: Sequence[tuple[str, str]]):
    before = {k: spark.conf.get(k, None) for k, _ in options}
    for k, v in options:
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
