"""Files of a table: Hadoop's FileSystem for small documents, Spark for listings, Parquet footers for statistics.

Paths of data files are URIs as Spark's _metadata.file_path gives them (blanks
and the like percent-encoded), so that rows can be matched with files.
"""

from __future__ import annotations

import datetime as dt
import math
import re
import uuid
from collections.abc import Iterator
from decimal import Decimal
from typing import Any
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..plans.expressions import leaves, quoted

#: A row of a manifest. status: 0 was there before, 1 added, 2 removed by the snapshot; content: 0 data, 1 positions of deleted rows, 2 keys of deleted rows.
ENTRY = (
    "status int, snapshot_id long, sequence long, content int, file_path string, file_format string, spec_id int, schema_id int, partition map<string,string>, record_count long, file_size long,"
    " column_sizes map<int,long>, value_counts map<int,long>, null_counts map<int,long>, nan_counts map<int,long>, lower map<int,string>, upper map<int,string>,"
    " equality_ids array<int>, sort_order_id int, referenced_file string, first_row_id long, split_offsets array<long>"
)
_MEASURED = "file_path string, partition map<string,string>, record_count long, file_size long, column_sizes map<int,long>, value_counts map<int,long>, null_counts map<int,long>, nan_counts map<int,long>, lower map<int,string>, upper map<int,string>, split_offsets array<long>"


class CommitConflict(RuntimeError):
    """Another writer committed first, and what it did does not go with this commit."""


class Files:
    """Documents below a root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.jvm, self.root = spark, spark.sparkContext._jvm, root.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)
        self.root_uri = self.uri("")

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name if "://" in name or name.startswith(("/", "file:")) else f"{self.root}/{name}" if name else self.root)

    def uri(self, name: str) -> str:
        return re.sub("^file:/+", "file:///", self.fs.makeQualified(self.path(name)).toUri().toString())

    def uri_path(self, uri: str):
        return self.jvm.org.apache.hadoop.fs.Path(unquote(uri))

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        return self.read_bytes(name).decode()

    def read_bytes(self, name: str) -> bytes:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, name: str, data: str | bytes) -> None:
        out = self.fs.create(self.path(name), True)
        out.write(bytearray(data.encode() if isinstance(data, str) else data))
        out.close()

    def claim(self, name: str, text: str) -> bool:
        """Writes a document that must not exist yet; False if another writer was first. The claim is one step: a hard link on local disks, a rename that never replaces elsewhere."""
        part = f"{name}.{uuid.uuid4().hex}.part"
        self.write(part, text)
        try:
            if self.fs.getScheme() == "file":
                of = lambda p: self.jvm.java.io.File(self.path(p).toUri().getPath()).toPath()
                self.jvm.java.nio.file.Files.createLink(of(name), of(part))
                return True
            none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf).rename(self.path(part), self.path(name), none)
            return True
        except Exception as e:
            if "AlreadyExists" in str(e):
                return False
            raise
        finally:
            self.fs.delete(self.path(part), False)

    def delete(self, uri: str, recursive: bool = False) -> bool:
        return self.uri_path(uri).getFileSystem(self.conf).delete(self.uri_path(uri), recursive)


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """file_path, file_size and modified of all files below a folder, from Spark's own listing; none is opened."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return df.select(uri(F.col("path")).alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified"))


def row_path() -> Column:
    """The file of a row that Spark reads, in the form of manifests: local paths with three slashes."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")


def uri(path: Column) -> Column:
    """A path as Spark writes it in _metadata.file_path: the characters that a URI's path must not hold, percent-encoded."""
    out = F.regexp_replace(path, "^file:/+", "file:///")
    for c in "% \"<>[]^`{|}\\#?":  # % first
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return out


def text_of(v: Any) -> str | None:
    """A bound or partition value as text that typed() reads back."""
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, dt.datetime):
        return (v.astimezone(dt.UTC).replace(tzinfo=None).isoformat(" ") + "Z") if v.tzinfo else v.isoformat(" ")
    return v.isoformat() if isinstance(v, dt.date) else bytes(v).hex() if isinstance(v, (bytes, bytearray)) else repr(v) if isinstance(v, float) else str(v)


def typed(c: Column, kind: DataType) -> Column:
    """Text of text_of() as a value of its type."""
    return F.unhex(c) if kind.simpleString() == "binary" else c.cast(kind)


def value_from(text: str | None, kind: DataType) -> Any:
    """The same for one Python value."""
    name = kind.simpleString()
    if text is None:
        return None
    if name in ("tinyint", "smallint", "int", "bigint"):
        return int(text)
    if name in ("float", "double"):
        return float(text)
    if name.startswith("decimal"):
        return Decimal(text)
    if name == "date":
        return dt.date.fromisoformat(text)
    if name.startswith("timestamp"):
        return dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    return text == "true" if name == "boolean" else bytes.fromhex(text) if name == "binary" else text


def as_text(c: Column, kind: DataType) -> Column:
    """A column as text_of() would write its values."""
    name = kind.simpleString()
    if name == "timestamp":
        local = F.timestamp_micros(F.unix_micros(c))
        return F.concat(F.convert_timezone(F.current_timezone(), F.lit("UTC"), local.cast("timestamp_ntz")).cast("string"), F.lit("Z"))
    return F.lower(F.hex(c)) if name == "binary" else c.cast("string")


def shortened(v: Any, width: int, up: bool) -> Any:
    """A bound of at most width characters or bytes; the upper one rounded up, or None where that cannot be."""
    if not isinstance(v, (str, bytes)) or len(v) <= width:
        return v
    head = v[:width]
    if not up:
        return head
    most = 0x10FFFF if isinstance(v, str) else 0xFF
    for i in range(len(head) - 1, -1, -1):
        at = ord(head[i]) if isinstance(head, str) else head[i]
        if at < most:
            after = at + 1 if at + 1 != 0xD800 else 0xE000
            return head[:i] + (chr(after) if isinstance(head, str) else bytes([after]))
    return None


def modes(properties: dict, schema: StructType) -> dict[str, tuple[str, int]]:
    """How each column's statistics are kept: none, counts, truncate (to so many characters) or full."""
    out = {}
    for path, _, _ in leaves(schema):
        name = ".".join(path)
        said = properties.get(f"write.metadata.metrics.column.{name}", properties.get("write.metadata.metrics.default", "truncate(16)"))
        m = re.fullmatch(r"(none|counts|full|truncate)(?:\((\d+)\))?", str(said).strip().lower())
        if not m or (m[1] == "truncate") != (m[2] is not None) or m[2] is not None and int(m[2]) == 0:
            raise ValueError(f"no metrics mode: {said!r}")
        out[name] = (m[1], int(m[2] or 0))
    return out


def _partition_of(path: str, fields: list[str]) -> list[tuple[str, str | None]]:
    """The values that the folders of a path name: v and the text of a value, n for null."""
    got = dict(re.findall(r"/_p(\d+)=([^/]*)(?=/)", unquote(path)))
    said = [unquote(got[str(i)]) if str(i) in got else "n" for i in range(len(fields))]
    return [(f, s[1:] if s[0] == "v" else None) for f, s in zip(fields, said, strict=True)]


def measured(spark: SparkSession, folder: str, schema: StructType, fields: list[str], properties: dict) -> DataFrame:
    """A row (ENTRY's columns as far as files tell them) for each Parquet file below a folder.

    Row counts, sizes, null counts and bounds come from the footers, read in
    tasks; no data is read again. Footers do not count NaN, so of floats
    nothing is said that holds only without NaN. Stores that Python cannot
    open are measured by one aggregation over their columns instead.
    """
    files = listed(spark, folder)
    if not re.match(r"(file:|/)", folder):
        return _aggregated(spark, folder, schema, fields, properties, files)
    return footers(files, schema, fields, properties)


def footers(files: DataFrame, schema: StructType, fields: list[str], properties: dict) -> DataFrame:
    """files (file_path, file_size) with what their footers say."""
    wanted = {".".join(p): (m["id"], *modes(properties, schema)[".".join(p)], t.simpleString()) for p, t, m in leaves(schema) if "id" in m}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for b in batches:
            rows = []
            for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                foot = pq.read_metadata(unquote(urlparse(path).path))
                sizes, values, nulls, low, high, unknown = {}, {}, {}, {}, {}, set()
                for g in range(foot.num_row_groups):
                    group = foot.row_group(g)
                    for i in range(group.num_columns):
                        c = group.column(i)
                        if (own := wanted.get(c.path_in_schema)) is None or own[1] == "none":
                            continue
                        k, mode, width, kind = own
                        sizes[k] = sizes.get(k, 0) + c.total_compressed_size
                        values[k] = values.get(k, 0) + group.num_rows
                        s = c.statistics
                        if s is None or not s.has_null_count or c.physical_type == "INT96":
                            unknown.add(k)
                            continue
                        nulls[k] = nulls.get(k, 0) + s.null_count
                        if mode == "counts" or s.null_count == group.num_rows:
                            continue
                        a, z = (s.min, s.max) if s.has_min_max else (None, None)
                        if a is None or isinstance(a, float) and (math.isnan(a) or math.isnan(z)):
                            low[k] = high[k] = None
                            continue
                        low[k] = a if k not in low else None if low[k] is None else min(low[k], a)
                        high[k] = z if k not in high else None if high[k] is None else max(high[k], z)
                cut = {own[0]: own[2] for own in wanted.values() if own[1] == "truncate"}
                local = {own[0] for own in wanted.values() if own[3] == "timestamp_ntz"}
                ends = []
                for bounds, up in ((low, False), (high, True)):
                    got = [(k, shortened(v, cut[k], up) if k in cut else v) for k, v in sorted(bounds.items()) if v is not None]
                    ends.append([(k, text_of(v.replace(tzinfo=None) if k in local and isinstance(v, dt.datetime) else v)) for k, v in got if v is not None])
                offsets = [foot.row_group(g).column(0).dictionary_page_offset or foot.row_group(g).column(0).data_page_offset for g in range(foot.num_row_groups)] if foot.num_columns else []
                rows.append((path, _partition_of(path, fields), foot.num_rows, size, sorted(sizes.items()), sorted(values.items()), sorted((k, n) for k, n in nulls.items() if k not in unknown), [], ends[0], ends[1], offsets))
            yield _batch(rows)

    return files.select("file_path", "file_size").mapInArrow(run, _MEASURED)


_COUNTS, _BOUNDS = pa.map_(pa.int32(), pa.int64()), pa.map_(pa.int32(), pa.string())
_BATCH = pa.schema([("file_path", pa.string()), ("partition", pa.map_(pa.string(), pa.string())), ("record_count", pa.int64()), ("file_size", pa.int64()), *[(n, _COUNTS) for n in ("column_sizes", "value_counts", "null_counts", "nan_counts")], ("lower", _BOUNDS), ("upper", _BOUNDS), ("split_offsets", pa.list_(pa.int64()))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_BATCH)], schema=_BATCH)


def _aggregated(spark: SparkSession, folder: str, schema: StructType, fields: list[str], properties: dict, files: DataFrame) -> DataFrame:
    """What footers would say, by one aggregation; with counts of NaN."""
    from .schema import plain

    df = spark.read.schema(plain(schema)).option("recursiveFileLookup", "true").parquet(folder).withColumn("_file", row_path())
    aggs, counts, nulls, nans, low, high = [F.count("*").alias("record_count")], [], [], [], [], []
    how = modes(properties, schema)
    for i, (path, kind, meta) in enumerate((p, t, m) for p, t, m in leaves(schema) if "id" in m):
        mode, width = how[".".join(path)]
        if mode == "none" or len(path) > 1:
            continue
        c, k = F.col(quoted(path[0])), F.lit(meta["id"])
        aggs.append(F.count_if(c.isNull()).alias(f"n{i}"))
        counts += [k, F.col("record_count")]
        nulls += [k, F.col(f"n{i}")]
        if kind.simpleString() in ("float", "double"):
            aggs.append(F.count_if(F.isnan(c)).alias(f"x{i}"))
            nans += [k, F.col(f"x{i}")]
            c = F.when(~F.isnan(c), c)
        if mode != "counts" and kind.typeName() not in ("variant", "interval") and kind.simpleString() != "void":
            aggs += [F.min(c).alias(f"l{i}"), F.max(c).alias(f"u{i}")]
            exact = kind.simpleString() not in ("string", "binary") or mode == "full"
            short = lambda e: exact | (F.length(e) <= width)  # noqa: B023, E731
            low += [k, as_text(F.col(f"l{i}") if exact else F.substring(f"l{i}", 1, width), kind)]
            high += [k, F.when(F.lit(True) if exact else short(F.col(f"u{i}")), as_text(F.col(f"u{i}"), kind))]
    made = lambda kv, t: F.map_filter(F.create_map(*kv), lambda _, v: v.isNotNull()) if kv else F.expr(f"cast(map() as {t})")
    per = df.groupBy("_file").agg(*aggs)
    part = F.map_from_entries(F.array(*[F.struct(F.lit(f), _folder_value(F.col("_file"), i)) for i, f in enumerate(fields)])) if fields else F.expr("cast(map() as map<string,string>)")
    out = per.join(files.select(F.col("file_path").alias("_f"), "file_size"), F.col("_file") == F.col("_f"))
    return out.select(F.col("_file").alias("file_path"), part.alias("partition"), "record_count", "file_size", F.expr("cast(map() as map<int,long>)").alias("column_sizes"), made(counts, "map<int,long>").alias("value_counts"), made(nulls, "map<int,long>").alias("null_counts"), made(nans, "map<int,long>").alias("nan_counts"), made(low, "map<int,string>").alias("lower"), made(high, "map<int,string>").alias("upper"), F.expr("cast(array() as array<long>)").alias("split_offsets"))


def _folder_value(path: Column, i: int) -> Column:
    said = F.url_decode(F.replace(F.url_decode(F.replace(F.regexp_extract(path, f"/_p{i}=([^/]*)/", 1), F.lit("+"), F.lit("%2B"))), F.lit("+"), F.lit("%2B")))
    return F.when(said.startswith("v"), F.substring(said, 2, 1 << 30))


def stats_columns(ids: dict[str, tuple[int, DataType]]):
    """For may_match_column: the Columns of a manifest that tell about a leaf's field. ids: field -> id and type."""

    def of(e) -> dict[str, Column] | None:
        if e.field not in ids:
            return None
        k, kind = ids[e.field]
        at = lambda m: F.try_element_at(F.col(m), F.lit(k))
        out = {"rows": F.col("record_count"), "nulls": at("null_counts"), "nan": at("nan_counts")}
        if e.kind is not None and kind.simpleString() == e.kind.simpleString():
            out |= {"lower": typed(at("lower"), kind), "upper": typed(at("upper"), kind)}
        for c in ("min_x", "min_y"):
            out[c] = F.split(at("lower"), ",")[int(c == "min_y")].try_cast("double")
        for c in ("max_x", "max_y"):
            out[c] = F.split(at("upper"), ",")[int(c == "max_y")].try_cast("double")
        return out

    return of
