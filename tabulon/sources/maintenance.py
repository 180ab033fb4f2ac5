"""Upkeep of tables: compaction, manifest rewrites, expiry, orphans, purge, statistics files."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import ENTRY, listed
from .table import Table, manifests_of


def pack(items: Iterable[Any], size: Callable[[Any], int], target: int, lookback: int = 10, largest_first: bool = False) -> list[list[Any]]:
    """First-fit bins of at most target size (an item above it is a bin of its own), with so many bins open at once; of these the oldest, or the largest, closes first."""
    done: list[list[Any]] = []
    opened: list[tuple[int, list[Any]]] = []
    for x in items:
        n = size(x)
        for i, (used, held) in enumerate(opened):
            if used + n <= target:
                held.append(x)
                opened[i] = (used + n, held)
                break
        else:
            opened.append((n, [x]))
            if len(opened) > lookback:
                at = max(range(len(opened)), key=lambda i: opened[i][0]) if largest_first else 0
                done.append(opened.pop(at)[1])
    return done + [held for _, held in opened]


@dataclass(frozen=True)
class CompactionPlan:
    """Files to rewrite (a table of entries, with group: files that belong into one output of a partition) and how many groups and files there are."""

    files: DataFrame
    groups: int
    count: int


def plan_compaction(t: Table, target: int | None = None, small: float = 0.75, large: float = 1.8, deletes: int = 5, share: float = 0.3, least: int = 5, branch: str = "main") -> CompactionPlan:
    """Files worth rewriting, planned in Spark.

    Candidates are smaller than small or larger than large times the target
    size, may be touched by deletes delete files or more, or have lost share of
    their rows to positions. Partitions keep apart. Files of a partition are
    laid end to end in the order of their paths and cut at multiples of the
    target; a partition of fewer than least candidates, none with deletes, is
    left as it is.
    """
    target = target or int(t.property("write.target-file-size-bytes"))
    head = t.head(branch)
    files = t.live(head, "data").withColumn("_k", t._partition_key())
    gone = t.live(head, "deletes")
    if t._delete_files(gone):
        from ..operators.deletes import matching_files

        per = matching_files(files, gone).groupBy(F.col("file_path").alias("_f")).agg(F.count("*").alias("_n"))
        lost = t._positions(gone).groupBy(F.col("path").alias("_l")).agg(F.count_distinct("pos").alias("_lost")) if any(f["content"] == 1 for f in t._delete_files(gone)) else None
        files = files.join(per, F.col("file_path") == F.col("_f"), "left")
        files = files.join(lost, F.col("file_path") == F.col("_l"), "left") if lost is not None else files.withColumn("_lost", F.lit(None).cast("long"))
        files = files.withColumn("_hit", (F.coalesce("_n", F.lit(0)) >= deletes) | (F.coalesce("_lost", F.lit(0)) >= F.col("record_count") * share))
    else:
        files = files.withColumn("_hit", F.lit(False))
    wrong = F.col("_hit") | (F.col("file_size") < small * target) | (F.col("file_size") > large * target)
    files = files.where(wrong)
    whole = files.groupBy(F.col("spec_id").alias("_s"), F.col("_k").alias("_p")).agg(F.count("*").alias("_c"), F.max("_hit").alias("_h")).where((F.col("_c") >= least) | F.col("_h"))
    files = files.join(whole, (F.col("spec_id") == F.col("_s")) & (F.col("_k") == F.col("_p")), "left_semi")
    before = F.sum("file_size").over(Window.partitionBy("spec_id", "_k").orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1))
    files = files.withColumn("group", F.floor(F.coalesce(before, F.lit(0)) / F.lit(target)).cast("long"))
    r = files.agg(F.count("*").alias("n"), F.count_distinct("spec_id", "_k", "group").alias("g")).first()
    return CompactionPlan(files, r["g"], r["n"])


def compact(t: Table, partitions: int | None = None, branch: str = "main", everything: bool = True, **how) -> CompactionPlan:
    """Rewrites planned files (everything: all of them) as files of the target size; the rows stay the same. partitions: into so many tasks instead. Deletes that touch no file any more go with it."""
    plan = plan_compaction(t, small=float("inf"), least=1, branch=branch, **how) if everything else plan_compaction(t, branch=branch, **how)
    if not plan.count:
        return plan
    gone = t.live(t.head(branch), "deletes")
    some = bool(t._delete_files(gone))
    lineage = t.property("format-version") == "3"
    planned = plan.files
    rows = t.read_entries(planned, gone if some else None, lineage=lineage)
    tasks = partitions if partitions is not None else None if t.spec() else max(1, plan.groups)
    tx = t.transaction(branch)
    tx.rewrite(planned, rows, dead_deletes(t, planned, gone) if some else None, tasks)
    tx.commit()
    return plan


def dead_deletes(t: Table, rewritten: DataFrame, deletes: DataFrame) -> DataFrame:
    """file_path of delete files that touch none of the files that a rewrite leaves: an anti join with the survivors."""
    from ..operators.deletes import matching_files

    live = t.live(t.head(), "data").join(rewritten.select(F.col("file_path").alias("_f")), F.col("file_path") == F.col("_f"), "left_anti")
    used = matching_files(live, deletes.where("content = 2 or referenced_file is not null")).select(F.col("delete_path").alias("_d")).distinct()
    keys = deletes.where("content = 2 or referenced_file is not null").select("file_path").join(used, F.col("file_path") == F.col("_d"), "left_anti")
    open_ = deletes.where("content = 1 and referenced_file is null")
    if open_.limit(1).count():
        used = t._positions(open_).join(live.select(F.col("file_path").alias("_x")), F.col("path") == F.col("_x"), "left_semi").select(F.col("delete_path").alias("_u")).distinct()
        keys = keys.unionByName(open_.select("file_path").join(used, F.col("file_path") == F.col("_u"), "left_anti"))
    return keys


def rewrite_manifests(t: Table, target: int = 100_000, where: Callable[[dict], bool] | None = None, by: Sequence[str] = (), branch: str = "main") -> int:
    """Manifests of the head (where: only those) are written anew, as many as target entries each make, clustered by partition fields; what they list stays the same. Returns how many were written."""
    written = [0]

    def step(v: Table) -> None:
        head = v.head(branch)
        if head is None:
            return
        for content in ("data", "deletes"):
            old = [m for m in manifests_of(v, head) if m["content"] == content and (where is None or where(m))]
            if len(old) < 2 and not by:
                continue
            count = sum(m["files"][0] + m["files"][1] for m in old)
            parts = max(1, -(-count // target))
            made = _merge(v, old, parts, by)
            written[0] += len(made)
            _replace_head(v, branch, old, made)

    tx = t.transaction(branch)
    tx.update(step)
    tx.commit()
    return written[0]


def _merge(v: Table, old: list[dict], parts: int, by: Sequence[str] = ()) -> list[dict]:
    names = [f.name for f in StructType.fromDDL(ENTRY).fields]
    df = v.entries(old).where("status <> 2").withColumn("status", F.lit(0)).select(*names)
    if parts == 1:
        return [v.manifest(v._manifest_table(df))]
    keys = [F.try_element_at("partition", F.lit(n)) for n in by] or [v._partition_key()]
    kept = v._manifest_table(df.repartitionByRange(parts, *keys, "file_path").withColumn("_part", F.spark_partition_id()).select(*names, "_part"))
    whole = v.spark.read.parquet(kept._manifest_path)
    return [v.manifest(v._manifest_table(whole.where(F.col("_part") == i).select(*names))) for i in range(parts)]


def _replace_head(v: Table, branch: str, old: list[dict], made: list[dict]) -> None:
    head = v.head(branch)
    sid, seq = uuid.uuid4().int >> 66, v.meta["sequence"] + 1
    gone = {m["path"] for m in old}
    snap = {k: x for k, x in head.items() if k != "manifest_list"} | {"id": sid, "parent": head["id"], "ms": max(int(time.time() * 1000), v.meta["updated"]), "sequence": seq, "operation": "replace", "manifests": [m for m in manifests_of(v, head) if m["path"] not in gone] + [m | {"snapshot": sid, "sequence": seq} for m in made]}
    totals = {k: x for k, x in head["summary"].items() if k.startswith("total-")}
    snap["summary"] = totals | {"manifests-created": len(made), "manifests-replaced": len(old), "entries-processed": sum(m["files"][0] for m in made)}
    v.meta["snapshots"] = [*v.meta["snapshots"], snap]
    v.meta["refs"] = v.meta["refs"] | {branch: v.meta["refs"][branch] | {"snapshot": sid}}
    if branch == "main":
        v.meta["log"] = [*v.meta["log"], {"ms": snap["ms"], "snapshot": sid}]
    v.meta["sequence"] = seq


def merged(v: Table, manifests: list[dict], sid: int, seq: int) -> list[dict]:
    """Small manifests of a new snapshot put together, once there are enough of them."""
    out = []
    for content in ("data", "deletes"):
        own = [m for m in manifests if m["content"] == content]
        old = [m for m in own if m["snapshot"] != sid]
        if len(old) < int(v.property("commit.manifest.min-count-to-merge")):
            out += own
            continue
        out += [m | {"snapshot": sid, "sequence": seq} for m in _merge(v, old, max(1, sum(m["files"][0] + m["files"][1] for m in old) // 100_000))] + [m for m in own if m["snapshot"] == sid]
    return out


# Expiry and orphans


def expire(t: Table, older_than_ms: int | None = None, keep_last: int | None = None, clean: bool = True) -> int:
    """Snapshots that no reference holds go, and files that only they had. Heads stay; of each branch its last few (min-snapshots-to-keep) and those younger than the age stay; other references than main go when they are too old themselves. Returns how many snapshots went."""
    now = int(time.time() * 1000)
    dropped: list[dict] = []

    def step(v: Table) -> None:
        dropped.clear()
        refs = {n: r for n, r in v.meta["refs"].items() if n == "main" or r.get("max_ref_age_ms") is None or now - v.snapshot(r["snapshot"])["ms"] <= r["max_ref_age_ms"]}
        stay = {r["snapshot"] for r in refs.values()}
        held = set()
        for r in refs.values():
            line = v.ancestors(r["snapshot"])
            held |= {s["id"] for s in line}
            if r["type"] == "branch":
                most = r.get("min_snapshots_to_keep") or keep_last or int(v.property("history.expire.min-snapshots-to-keep"))
                since = older_than_ms if older_than_ms is not None else now - (r.get("max_snapshot_age_ms") or int(v.property("history.expire.max-snapshot-age-ms")))
                stay |= {s["id"] for i, s in enumerate(line) if i < most or s["ms"] >= since}
        since = older_than_ms if older_than_ms is not None else now - int(v.property("history.expire.max-snapshot-age-ms"))
        stay |= {s["id"] for s in v.meta["snapshots"] if s["id"] not in held and s["ms"] >= since}
        dropped.extend(s for s in v.meta["snapshots"] if s["id"] not in stay)
        v.meta["snapshots"] = [s for s in v.meta["snapshots"] if s["id"] in stay]
        v.meta["refs"] = refs
        cut = max((i for i, e in enumerate(v.meta["log"]) if e["snapshot"] not in stay), default=-1)
        v.meta["log"] = v.meta["log"][cut + 1 :]

    tx = t.transaction()
    tx.update(step)
    tx.commit()
    if clean and dropped and t.property("gc.enabled") == "true":
        lost = {m["path"]: m for s in dropped for m in manifests_of(t, s)}
        kept = {m["path"]: m for s in t.meta["snapshots"] for m in manifests_of(t, s)}
        gone = t.entries([m for p, m in lost.items() if p not in kept]).select("file_path").distinct()
        alive = t.entries([*kept.values()]).where("status <> 2").select(F.col("file_path").alias("_f")).distinct()
        _delete(t, gone.join(alive, F.col("file_path") == F.col("_f"), "left_anti"))
        for p in [*(p for p in lost if p not in kept), *(s["manifest_list"] for s in dropped)]:
            t.files.fs.delete(t.files.path(p), True)
    return len(dropped)


def _delete(t: Table, paths: DataFrame) -> int:
    """Deletes files a batch at a time: the driver holds one partition of paths at once."""
    n = 0
    for r in paths.select("file_path").toLocalIterator():
        n += bool(t.files.delete(r["file_path"]))
    return n


def orphans(t: Table, older_than_ms: int | None = None, dry_run: bool = True) -> DataFrame:
    """Files below the table that nothing refers to and that are older than a time (three days by default): an anti join of Spark's listing with all manifests. dry_run: they are only listed."""
    cut = older_than_ms if older_than_ms is not None else int(time.time() * 1000) - 3 * 24 * 3600 * 1000
    every = [*{m["path"]: m for s in t.meta["snapshots"] for m in manifests_of(t, s)}.values()]
    used = t.entries(every).select(F.col("file_path").alias("_f")).distinct()
    own = t.spark.createDataFrame([(m["path"].rpartition("/")[2],) for m in every], "_m string")
    found = listed(t.spark, t.files.root_uri).where(F.unix_millis("modified") < cut)
    found = found.where(~F.col("file_path").rlike(r"/metadata/v\d+\.json$"))
    found = found.join(used, F.col("file_path") == F.col("_f"), "left_anti")
    found = found.withColumn("_n", F.regexp_extract("file_path", r"/(m-[0-9a-f]{32})/", 1)).join(F.broadcast(own), F.col("_n") == F.col("_m"), "left_anti").drop("_n")
    named = [s["path"] for s in [*t.meta["statistics"], *t.meta["partition_statistics"]]] + [f"{t.files.root_uri}/{s['manifest_list']}" for s in t.meta["snapshots"]]
    if named:
        known = t.spark.createDataFrame([(p,) for p in named], "_o string")
        found = found.join(F.broadcast(known), F.col("file_path") == F.col("_o"), "left_anti")
    if not dry_run:
        if t.property("gc.enabled") != "true":
            raise ValueError("gc.enabled is false: files may belong to other tables")
        path = t._manifest_path().replace("/m-", "/orphans-")
        found.write.parquet(path)
        found = t.spark.read.parquet(path)
        _delete(t, found)
    return found


def purge(t: Table) -> None:
    """The table and all its files go."""
    if t.property("gc.enabled") != "true":
        raise ValueError("gc.enabled is false: files may belong to other tables")
    every = [*{m["path"]: m for s in t.meta["snapshots"] for m in manifests_of(t, s)}.values()]
    outside = t.entries(every).where(~F.col("file_path").startswith(t.files.root_uri)).select("file_path").distinct()
    _delete(t, outside)
    t.files.fs.delete(t.files.path(""), True)


# Statistics files


def set_statistics(t: Table, snapshot_id: int, path: str, blobs: Sequence[dict] = (), partition: bool = False) -> None:
    """Names a statistics file of a snapshot; one for each snapshot, and one of partitions."""

    def step(v: Table) -> None:
        v.snapshot(snapshot_id)
        key = "partition_statistics" if partition else "statistics"
        v.meta[key] = [s for s in v.meta[key] if s["snapshot"] != snapshot_id] + [{"snapshot": snapshot_id, "path": path, "blobs": [*blobs]}]

    tx = t.transaction()
    tx.update(step)
    tx.commit()


def remove_statistics(t: Table, snapshot_id: int, partition: bool = False) -> None:
    def step(v: Table) -> None:
        key = "partition_statistics" if partition else "statistics"
        v.meta[key] = [s for s in v.meta[key] if s["snapshot"] != snapshot_id]

    tx = t.transaction()
    tx.update(step)
    tx.commit()


def distinct_counts(t: Table, columns: Sequence[str]) -> dict[str, int]:
    """Computes theta sketches of columns over the head, in one aggregation with partial sketches, keeps them in a statistics file of the head, and returns the counts that they estimate."""
    from .blobs import write_blobs

    head = t.head()
    if head is None:
        raise ValueError("the table has no rows yet")
    df = t.scan().to_df()
    r = df.agg(*[F.theta_sketch_agg(F.col(f"`{c}`").cast("string")).alias(f"s{i}") for i, c in enumerate(columns)]).select(*[x for i in range(len(columns)) for x in (F.col(f"s{i}"), F.theta_sketch_estimate(f"s{i}").alias(f"n{i}"))]).first()
    path = f"metadata/{head['id']}.stats"
    full = t.full_schema()
    blobs = [{"type": "theta-sketch", "fields": [full[c].metadata["id"]], "snapshot-id": head["id"], "sequence-number": head["sequence"], "properties": {"ndv": str(r[f"n{i}"])}, "data": bytes(r[f"s{i}"])} for i, c in enumerate(columns)]
    t.files.write(path, write_blobs(blobs))
    set_statistics(t, head["id"], f"{t.files.root_uri}/{path}", [{k: v for k, v in b.items() if k != "data"} for b in blobs])
    return {c: r[f"n{i}"] for i, c in enumerate(columns)}
