"""Command line over a catalog of folders: python -m tabulon.cli --warehouse DIR COMMAND ..."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from .sources.catalog import FolderCatalog
from .sources.maintenance import expire, orphans, plan_compaction


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tabulon")
    p.add_argument("--warehouse", required=True)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *args: str, **options: dict) -> None:
        c = sub.add_parser(name)
        for a in args:
            c.add_argument(a)
        for o, how in options.items():
            c.add_argument(f"--{o.replace('_', '-')}", **how)

    command("list", parent={"default": ""})
    for name in ("describe", "schema", "spec", "files", "snapshots", "refs", "properties", "location", "uuid", "drop"):
        command(name, "table")
    command("create-namespace", "namespace")
    command("drop-namespace", "namespace")
    command("create", "table", "columns", partition={"nargs": "*", "default": []})
    command("set", "table", "key", "value")
    command("unset", "table", "key")
    command("compact", "table", dry_run={"action": "store_true"})
    for name in ("branch", "tag"):
        command(name, "table", "name", snapshot={"type": int})
    command("expire", "table", older_than_ms={"type": int}, keep_last={"type": int})
    command("orphans", "table", older_than_ms={"type": int}, delete={"action": "store_true"})
    command("upgrade", "table", "version")
    command("rollback", "table", "snapshot")
    return p


def run(spark: SparkSession, argv: list[str]) -> list:
    """The lines that a command prints."""
    a = _parser().parse_args(argv)
    c = FolderCatalog(spark, a.warehouse)
    if a.command == "list":
        spaces = c.list_namespaces(a.parent) if a.parent else c.list_namespaces()
        return [".".join(n) for n in [*spaces, *(c.list_tables(a.parent) if a.parent else [])]]
    if a.command in ("create-namespace", "drop-namespace"):
        (c.create_namespace if a.command[0] == "c" else c.drop_namespace)(a.namespace)
        return []
    if a.command == "create":
        parts = [tuple(x.split(":")) if ":" in x else x for x in a.partition]
        return [c.create_table(a.table, StructType.fromDDL(a.columns), partition=parts).root]
    if a.command == "drop":
        c.drop_table(a.table)
        return []
    t = c.load_table(a.table)
    if a.command == "compact":
        plan = plan_compaction(t) if a.dry_run else None
        if plan is None:
            t.compact(everything=False)
        return [] if plan is None else [{"files": plan.count, "groups": plan.groups}]
    if a.command == "expire":
        return [{"snapshots": expire(t, a.older_than_ms, a.keep_last)}]
    if a.command == "orphans":
        return [r.file_path for r in orphans(t, a.older_than_ms, not a.delete).toLocalIterator()]
    changes = {
        "set": lambda x: x.set_properties({a.key: a.value}), "unset": lambda x: x.set_properties({a.key: None}), "branch": lambda x: x.tag(a.name, a.snapshot, "branch"), "tag": lambda x: x.tag(a.name, a.snapshot),
        "upgrade": lambda x: x.set_properties({"format-version": a.version}), "rollback": lambda x: x.rollback(int(a.snapshot)),
    }
    if a.command in changes:
        t._one(changes[a.command])
        return []
    head = t.head()
    shown = {
        "describe": lambda: [{"location": t.root, "uuid": t.meta["uuid"], "version": t.meta["version"], "format": t.property("format-version"), "schema": t.schema().simpleString(), "spec": t.spec(), "snapshot": head["id"] if head else None, "summary": head["summary"] if head else {}}],
        "schema": lambda: t.schema().treeString().splitlines(), "spec": t.spec, "files": lambda: [r.file_path for r in t.inspect("files").toLocalIterator()], "snapshots": lambda: [{"id": s["id"], "ms": s["ms"], "operation": s["operation"]} for s in t.meta["snapshots"]],
        "refs": lambda: [{"name": n} | r for n, r in t.meta["refs"].items()], "properties": lambda: [t.meta["properties"]], "location": lambda: [t.root], "uuid": lambda: [t.meta["uuid"]],
    }
    return shown[a.command]()


def main() -> None:
    spark = SparkSession.builder.getOrCreate()
    try:
        for line in run(spark, sys.argv[1:]):
            print(line if isinstance(line, str) else json.dumps(line))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
