"""Row-level deletes as anti joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.expressions import quoted


def equality_deletes(data: DataFrame, deletes: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """data without rows whose keys are among the deleted ones; null equals null.

    With a sequence column in both, only deletes of a greater sequence apply.
    They are reduced to the greatest per key before the join, so that a key
    that is deleted again and again stays one row.
    """
    names = {k: f"_tabulon_d{i}" for i, k in enumerate(keys)}
    if sequence is None:
        gone = deletes.select(*[F.col(quoted(k)).alias(n) for k, n in names.items()]).distinct()
        later: list[Column] = []
    else:
        gone = deletes.groupBy(*[F.col(quoted(k)).alias(n) for k, n in names.items()]).agg(F.max(quoted(sequence)).alias("_tabulon_dseq"))
        later = [F.col("_tabulon_dseq") > F.col(quoted(sequence))]
    return data.join(gone, reduce(Column.__and__, [*[F.col(quoted(k)).eqNullSafe(F.col(n)) for k, n in names.items()], *later]), "left_anti")


def position_deletes(data: DataFrame, deletes: DataFrame, path: str = "file_path", pos: str = "pos", sequence: str | None = None, few: bool = False) -> DataFrame:
    """data (with path and pos columns) without the rows at deleted (path, pos). With a sequence column in both, only deletes of the same or a greater sequence apply.

    Files of positions and vectors are far smaller than their rows, so Spark
    would broadcast millions of them through the driver: both sides are sorted
    and merged instead, unless the caller knows that the deletes are few.
    """
    how = (lambda gone: gone) if few else (lambda gone: gone.hint("merge"))
    at = (F.col(path) == F.col("_tabulon_dpath")) & (F.col(pos) == F.col("_tabulon_dpos"))
    keys = [F.col(path).alias("_tabulon_dpath"), F.col(pos).alias("_tabulon_dpos")]
    if sequence is None:
        return data.join(how(deletes.select(*keys).distinct()), at, "left_anti")
    return data.join(how(deletes.groupBy(*keys).agg(F.max(sequence).alias("_tabulon_dseq"))), at & (F.col("_tabulon_dseq") >= F.col(sequence)), "left_anti")


def matching_files(files: DataFrame, deletes: DataFrame) -> DataFrame:
    """file_path and delete_path of data files (file_path, sequence, spec_id, partition) and the delete files (with content and referenced_file) whose sequence, partition and reference let them apply."""
    d = deletes.select(F.col("file_path").alias("delete_path"), F.col("sequence").alias("_s"), F.col("spec_id").alias("_spec"), F.to_json(F.array_sort(F.map_entries("partition"))).alias("_p"), F.size("partition").alias("_n"), F.col("content").alias("_c"), F.col("referenced_file").alias("_r"))
    part = (F.col("spec_id") == F.col("_spec")) & (F.to_json(F.array_sort(F.map_entries("partition"))) == F.col("_p"))
    later = F.when(F.col("_c") == 2, F.col("_s") > F.col("sequence")).otherwise(F.col("_s") >= F.col("sequence"))
    named = files.join(d.where("_r is not null"), F.col("file_path") == F.col("_r")).where(later)
    scoped = files.join(d.where("_r is null and _n > 0"), part).where(later)
    everywhere = files.join(F.broadcast(d.where("_r is null and _n <= 0")), later)
    return named.select("file_path", "delete_path").unionByName(scoped.select("file_path", "delete_path")).unionByName(everywhere.select("file_path", "delete_path"))
