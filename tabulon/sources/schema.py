"""Schemas whose fields have ids: evolution, unions, name mappings, and Columns that read files of one schema in another.

A schema is a StructType; the id of a field is in its metadata, with its
documentation and defaults. Ids last for a table's life, names need not.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, MapType, StructField, StructType

from ..plans.expressions import quoted

#: Which types may become which. Decimals may gain precision.
PROMOTIONS = {("int", "bigint"), ("float", "double"), ("string", "binary"), ("binary", "string"), ("date", "timestamp_ntz"), ("tinyint", "smallint"), ("tinyint", "int"), ("smallint", "int"), ("tinyint", "bigint"), ("smallint", "bigint"), ("void", "*")}


def may_become(a: DataType, b: DataType) -> bool:
    x, y = a.simpleString(), b.simpleString()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        return a.scale == b.scale and a.precision <= b.precision
    return x == y or (x, y) in PROMOTIONS or x == "void"


def with_ids(schema: StructType, next_id: Callable[[], int], keep: bool = False) -> StructType:
    """schema with an id for every field, parents before their parts; keep: ids that are there stay."""

    def of(t: DataType) -> DataType:
        if isinstance(t, StructType):
            made = []
            for f in t.fields:
                meta = dict(f.metadata or {})
                if not keep or "id" not in meta:
                    meta["id"] = next_id()
                made.append((f, meta))
            return StructType([StructField(f.name, of(f.dataType), f.nullable, m) for f, m in made])
        if isinstance(t, ArrayType):
            return ArrayType(of(t.elementType), t.containsNull)
        if isinstance(t, MapType):
            return MapType(of(t.keyType), of(t.valueType), t.valueContainsNull)
        return t

    return of(schema)


def plain(schema: StructType) -> StructType:
    """Without ids and other metadata."""

    def of(t: DataType) -> DataType:
        if isinstance(t, StructType):
            return StructType([StructField(f.name, of(f.dataType), f.nullable) for f in t.fields])
        if isinstance(t, ArrayType):
            return ArrayType(of(t.elementType), t.containsNull)
        return MapType(of(t.keyType), of(t.valueType), t.valueContainsNull) if isinstance(t, MapType) else t

    return of(schema)


def by_id(schema: StructType) -> dict[int, tuple[tuple[str, ...], StructField]]:
    """id -> path and field, for fields at any depth of structs, lists and maps (element, key and value as steps)."""
    out: dict[int, tuple[tuple[str, ...], StructField]] = {}

    def walk(t: DataType, before: tuple[str, ...]) -> None:
        if isinstance(t, StructType):
            for f in t.fields:
                if "id" in f.metadata:
                    out[f.metadata["id"]] = ((*before, f.name), f)
                walk(f.dataType, (*before, f.name))
        elif isinstance(t, ArrayType):
            walk(t.elementType, (*before, "element"))
        elif isinstance(t, MapType):
            walk(t.keyType, (*before, "key"))
            walk(t.valueType, (*before, "value"))

    walk(schema, ())
    return out


def paired(a: StructType, b: StructType) -> list[tuple[int, StructField | None, StructField | None]]:
    """Fields of two schemas by id: those of both, of the first only and of the second only."""
    x, y = by_id(a), by_id(b)
    return [(i, x[i][1] if i in x else None, y[i][1] if i in y else None) for i in sorted(x.keys() | y.keys())]


def pruned(schema: StructType, ids: set[int]) -> StructType:
    """Only the fields with these ids and what leads to them."""

    def of(t: DataType) -> DataType | None:
        if isinstance(t, StructType):
            kept = [f if f.metadata.get("id") in ids and not isinstance(f.dataType, StructType) else StructField(f.name, sub, f.nullable, f.metadata) for f in t.fields if (sub := of(f.dataType)) is not None or f.metadata.get("id") in ids and (sub := f.dataType) is not None]
            return StructType(kept) if kept else None
        if isinstance(t, ArrayType):
            return ArrayType(sub, t.containsNull) if (sub := of(t.elementType)) is not None else None
        if isinstance(t, MapType):
            return MapType(t.keyType, sub, t.valueContainsNull) if (sub := of(t.valueType)) is not None else None
        return None

    return of(schema) or StructType([])


def default(f: StructField, which: str) -> Column:
    """A field's default (initial for rows of older files, write for new rows), else null."""
    value = f.metadata.get(which)
    return F.lit(value).cast(f.dataType) if value is not None else F.lit(None).cast(f.dataType)


def reader(own: StructType, wanted: StructType) -> list[Column]:
    """Columns that give rows of files with schema own in the schema wanted: fields are matched by id, others take their initial default or null."""

    def read(c: Column, a: DataType, b: DataType) -> Column:
        if isinstance(b, StructType) and isinstance(a, StructType):
            if a == b:
                return c
            made = F.struct(*[part.alias(f.name) for part, f in zip(fields(lambda n: c.getField(n), a, b), b.fields, strict=True)])
            return F.when(c.isNotNull(), made)
        if isinstance(b, ArrayType) and isinstance(a, ArrayType) and a != b:
            return F.transform(c, lambda x: read(x, a.elementType, b.elementType))
        if isinstance(b, MapType) and isinstance(a, MapType) and a != b:
            return F.transform_values(c, lambda _, x: read(x, a.valueType, b.valueType))
        return c if a.simpleString() == b.simpleString() else c.cast(b)

    def fields(get: Callable[[str], Column], a: StructType, b: StructType) -> list[Column]:
        have, out = {f.metadata.get("id"): f for f in a.fields}, []
        for f in b.fields:
            mine = have.get(f.metadata.get("id"))
            if mine is None and not f.nullable and f.metadata.get("initial") is None:
                raise ValueError(f"required field {f.name!r} is in no older file and has no default")
            out.append(read(get(mine.name), mine.dataType, f.dataType) if mine is not None else default(f, "initial"))
        return out

    return [c.alias(f.name) for c, f in zip(fields(lambda n: F.col(quoted(n)), own, wanted), wanted.fields, strict=True)]


class Update:
    """Changes of a schema, checked one by one; paths lead through structs, and "element" or "value" through lists and maps."""

    def __init__(self, schema: StructType, last_id: int, identifiers: Sequence[int] = ()) -> None:
        self.schema, self.last_id, self.identifiers = copy.deepcopy(schema), last_id, list(identifiers)

    def _next(self) -> int:
        self.last_id += 1
        return self.last_id

    def _parent(self, path: tuple[str, ...]) -> StructType:
        t: DataType = self.schema
        for step in path:
            if isinstance(t, StructType):
                t = self._field(t, step).dataType
            elif isinstance(t, ArrayType) and step == "element":
                t = t.elementType
            elif isinstance(t, MapType) and step == "value":
                t = t.valueType
            else:
                raise ValueError(f"no field {'.'.join(path)!r}")
        while isinstance(t, (ArrayType, MapType)):
            t = t.elementType if isinstance(t, ArrayType) else t.valueType
        if not isinstance(t, StructType):
            raise ValueError(f"{'.'.join(path)!r} has no fields")
        return t

    @staticmethod
    def _field(t: StructType, name: str) -> StructField:
        found = [f for f in t.fields if f.name == name]
        if not found:
            raise ValueError(f"no column {name!r}")
        return found[0]

    @staticmethod
    def _path(path: str | Sequence[str]) -> tuple[str, ...]:
        return (path,) if isinstance(path, str) else tuple(path)

    def _set(self, t: StructType, fields: list[StructField]) -> None:
        t.fields, t.names = fields, [f.name for f in fields]

    def add(self, path: str | Sequence[str], kind: DataType, doc: str | None = None, required: bool = False, default: Any = None) -> Update:
        *up, name = self._path(path)
        t = self._parent(tuple(up))
        if any(f.name.lower() == name.lower() for f in t.fields):
            raise ValueError(f"column {name!r} exists")
        if required and default is None:
            raise ValueError(f"a new required column {name!r} needs a default")
        meta = {"id": self._next()} | ({"doc": doc} if doc else {}) | ({"initial": default, "write": default} if default is not None else {})
        made = with_ids(StructType([StructField(name, kind)]), self._next).fields[0].dataType if isinstance(kind, (StructType, ArrayType, MapType)) else kind
        self._set(t, [*t.fields, StructField(name, made, not required, meta)])
        return self

    def drop(self, path: str | Sequence[str]) -> Update:
        *up, name = self._path(path)
        t = self._parent(tuple(up))
        f = self._field(t, name)
        if f.metadata.get("id") in self.identifiers:
            raise ValueError(f"{name!r} is an identifier field")
        self._set(t, [x for x in t.fields if x is not f])
        return self

    def rename(self, path: str | Sequence[str], new: str) -> Update:
        *up, name = self._path(path)
        t = self._parent(tuple(up))
        f = self._field(t, name)
        if any(x is not f and x.name.lower() == new.lower() for x in t.fields):
            raise ValueError(f"column {new!r} exists")
        f.name = new
        self._set(t, t.fields)
        return self

    def change(self, path: str | Sequence[str], kind: DataType | None = None, required: bool | None = None, doc: str | None = None, default: Any = None) -> Update:
        *up, name = self._path(path)
        f = self._field(self._parent(tuple(up)), name)
        if kind is not None:
            if not may_become(f.dataType, kind):
                raise ValueError(f"{f.dataType.simpleString()} cannot become {kind.simpleString()}")
            f.dataType = kind
        if required is not None:
            if required and f.nullable:
                raise ValueError(f"{name!r} may hold nulls already; it cannot become required")
            f.nullable = not required
        f.metadata = dict(f.metadata) | ({"doc": doc} if doc is not None else {}) | ({"write": default} if default is not None else {})
        return self

    def move(self, path: str | Sequence[str], first: bool = False, before: str | None = None, after: str | None = None) -> Update:
        *up, name = self._path(path)
        t = self._parent(tuple(up))
        f = self._field(t, name)
        rest = [x for x in t.fields if x is not f]
        if (before or after) == name:
            raise ValueError("a column cannot move next to itself")
        at = 0 if first else rest.index(self._field(t, before or after)) + (after is not None)
        self._set(t, [*rest[:at], f, *rest[at:]])
        return self

    def identify(self, names: Sequence[str]) -> Update:
        """The columns that tell rows apart; they must be required and no floats."""
        ids = []
        for n in names:
            f = self._field(self.schema, n)
            if f.nullable or f.dataType.simpleString() in ("float", "double"):
                raise ValueError(f"{n!r} cannot identify rows: it may be null or is a float")
            ids.append(f.metadata["id"])
        self.identifiers = ids
        return self

    def union(self, other: StructType) -> Update:
        """Fields of another schema by name: missing ones are added as optional, wider types adopted, narrower ones passed over, nulls allowed where the other allows them."""

        def meet(path: tuple[str, ...], mine: StructType, theirs: StructType) -> None:
            for f in theirs.fields:
                own = next((x for x in mine.fields if x.name == f.name), None)
                if own is None:
                    self.add((*path, f.name), f.dataType, f.metadata.get("doc"))
                    continue
                a, b = own.dataType, f.dataType
                own.nullable = own.nullable or f.nullable
                if "write" in f.metadata:
                    own.metadata = dict(own.metadata) | {"write": f.metadata["write"]}
                if type(a) is type(b) and isinstance(a, (StructType, ArrayType, MapType)):
                    x, y = a, b
                    while not isinstance(x, StructType) and type(x) is type(y) and isinstance(x, (ArrayType, MapType)):
                        x, y = (x.elementType, y.elementType) if isinstance(x, ArrayType) else (x.valueType, y.valueType)
                    if isinstance(x, StructType) and isinstance(y, StructType):
                        meet((*path, f.name), x, y)
                elif may_become(a, b):
                    own.dataType = b
                elif not may_become(b, a):
                    raise ValueError(f"{'.'.join((*path, f.name))!r}: {a.simpleString()} and {b.simpleString()} do not meet")

        meet((), self.schema, other)
        return self


def name_mapping(schema: StructType) -> list[dict]:
    """The ids of fields by name, with all names that they may have in files without ids."""

    def of(t: DataType) -> list[dict]:
        while isinstance(t, (ArrayType, MapType)):
            t = t.elementType if isinstance(t, ArrayType) else t.valueType
        return [{"field-id": f.metadata["id"], "names": [f.name]} | ({"fields": sub} if (sub := of(f.dataType)) else {}) for f in t.fields] if isinstance(t, StructType) else []

    return of(schema)


def updated_mapping(mapping: list[dict], schema: StructType) -> list[dict]:
    """A mapping after the schema has changed: new names are added to those that files may have, fields that are new are listed; a name that another field has now leaves the old one."""
    old = {m["field-id"]: m for m in mapping}
    fresh = name_mapping(schema)
    for m in fresh:
        if (was := old.get(m["field-id"])) is not None:
            others = {n for x in fresh if x is not m for n in x["names"]}
            m["names"] = [*dict.fromkeys([*(n for n in was["names"] if n not in others), *m["names"]])]
    return fresh


def mapped(schema: StructType, mapping: list[dict]) -> StructType:
    """A file's schema with the ids that a mapping gives its names; fields that it does not name keep none."""
    ids = {n: m for m in mapping for n in m["names"]}

    def sub(t: DataType, m: dict) -> DataType:
        if isinstance(t, StructType):
            return mapped(t, m.get("fields", []))
        if isinstance(t, ArrayType):
            return ArrayType(sub(t.elementType, m), t.containsNull)
        return MapType(t.keyType, sub(t.valueType, m), t.valueContainsNull) if isinstance(t, MapType) else t

    return StructType([StructField(f.name, sub(f.dataType, ids[f.name]), f.nullable, {"id": ids[f.name]["field-id"]}) if f.name in ids else StructField(f.name, f.dataType, f.nullable) for f in schema.fields])


def dumped(schema: StructType) -> dict:
    return json.loads(schema.json())


def loaded(doc: dict) -> StructType:
    return StructType.fromJson(doc)
