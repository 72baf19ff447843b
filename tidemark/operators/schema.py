"""Schemas of sources and targets: merge, compatibility, evolution, inference.

A schema is catalog metadata, so these walk plain lists on the driver; only inference reads rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.metadata import NULLABLE_KINDS
from tidemark.functions.names import fold_names
from tidemark.functions.types import spark_type, storage_type, widens, widest


class IncompatibleSchema(ValueError):
    """A source does not fit its target, or two sources do not fit each other."""


@dataclass(frozen=True)
class Field:
    """A column. ``spellings`` are the source names it is read under, which may differ in case."""

    name: str
    dtype: T.DataType
    nullable: bool = True
    source_type: str = ""
    comment: str | None = None
    spellings: tuple[str, ...] = ()

    @property
    def names(self) -> tuple[str, ...]:
        return self.spellings or (self.name,)


@dataclass
class TableSchema:
    fields: list[Field] = field(default_factory=list)
    primary_key: list[str] = field(default_factory=list)
    options: dict[str, str] = field(default_factory=dict)
    comment: str | None = None

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def get(self, name: str) -> Field | None:
        return next((f for f in self.fields if f.name == name), None)

    def struct(self) -> T.StructType:
        """C-16: as a Spark schema; comments and character lengths go to field metadata."""
        out = []
        for f in self.fields:
            meta: dict[str, object] = {}
            if f.comment:
                meta["comment"] = f.comment
            if isinstance(f.dtype, (T.CharType, T.VarcharType)):
                meta["length"] = f.dtype.length
            out.append(T.StructField(f.name, storage_type(f.dtype), f.nullable, meta))
        return T.StructType(out)


def merge(a: TableSchema, b: TableSchema, what: str = "") -> TableSchema:
    """C-01: union of the columns in first-seen order, wider type each; the key stays only if both have it."""
    fields = {f.name: f for f in a.fields}
    for new in b.fields:
        old = fields.get(new.name)
        if old is None:
            fields[new.name] = new
            continue
        dtype = widest(old.dtype, new.dtype)
        if dtype is None:
            raise IncompatibleSchema(f"column {new.name} has types {old.dtype} and {new.dtype} when merging {what}")
        wide = new if dtype != old.dtype else old
        fields[new.name] = replace(
            old, dtype=dtype, source_type=wide.source_type, nullable=old.nullable or new.nullable,
            spellings=_spellings(old, new),
        )
    key = a.primary_key if a.primary_key == b.primary_key else []
    return TableSchema(list(fields.values()), list(key), dict(a.options), a.comment)


def _spellings(old: Field, new: Field) -> tuple[str, ...]:
    both = tuple(dict.fromkeys(old.names + new.names))
    return old.spellings if both == old.names else both


def merge_all(schemas: Iterable[TableSchema], what: str = "") -> TableSchema:
    """C-01 over any number of sources."""
    merged: TableSchema | None = None
    for s in schemas:
        merged = s if merged is None else merge(merged, s, what)
    if merged is None:
        raise IncompatibleSchema(f"no source table for {what}")
    return merged


def with_primary_key(schemas: Mapping[tuple[str, str], TableSchema]) -> dict[tuple[str, str], TableSchema]:
    """F-14: the tables that have a primary key."""
    return {name: s for name, s in schemas.items() if s.primary_key}


def merge_keyed(schemas: Mapping[tuple[str, str], TableSchema]) -> TableSchema:
    """C-02: all tables that have a primary key, as one schema."""
    return merge_all(with_primary_key(schemas).values(), "all tables")


def merge_shards(schemas: Mapping[tuple[str, str], TableSchema]) -> dict[str, TableSchema]:
    """C-03: tables of one name across databases as one schema, keyed tables only."""
    out: dict[str, TableSchema] = {}
    for (db, tbl), s in sorted(with_primary_key(schemas).items()):
        out[tbl] = merge(out[tbl], s, f"{db}.{tbl}") if tbl in out else s
    return out


def union_shards(shards: Sequence[DataFrame], schema: TableSchema) -> DataFrame:
    """C-03, data side: rows of all shards under the merged schema; columns a shard lacks are NULL."""
    parts = []
    for df in shards:
        have = set(df.columns)
        parts.append(df.select(*[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(storage_type(f.dtype)).alias(f.name)
            for f in schema.fields
        ]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def problems(source: Sequence[Field], target: TableSchema) -> list[str]:
    """C-04: why the source does not fit the target, one line per column."""
    out = []
    for f in source:
        have = target.get(f.name)
        if have is None:
            out.append(f"no column {f.name} in the target")
        elif not widens(f.dtype, have.dtype):
            out.append(f"column {f.name}: {f.dtype.simpleString()} does not fit {have.dtype.simpleString()}")
    return out


def assert_compatible(source: Sequence[Field], target: TableSchema) -> None:
    """C-05."""
    found = problems(source, target)
    if found:
        raise IncompatibleSchema(
            f"source and target schemas do not fit: {'; '.join(found)}."
            f" Target: {target.struct().simpleString()}. Source: {TableSchema(list(source)).struct().simpleString()}"
        )


def accept(source: Sequence[Field], target: TableSchema, ignore_incompatible: bool = False) -> bool:
    """C-06: False leaves the table out with a warning in the report; by default a misfit is an error."""
    if not problems(source, target):
        return True
    if ignore_incompatible:
        return False
    assert_compatible(source, target)
    return False


def build_target(
    source: TableSchema,
    computed: Sequence[tuple[str, T.DataType]] = (),
    metadata: Mapping[str, str] | None = None,
    primary_key: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    case_sensitive: bool = True,
    table: str = "UNKNOWN",
    require_primary_key: bool = True,
) -> TableSchema:
    """S-15, C-07: source columns, then computed, then metadata columns, and the primary key.

    A given key must exist in source or computed columns; without one the source key holds.
    """
    fields = list(source.fields)
    fields += [Field(name, dtype) for name, dtype in computed]
    fields += [
        Field(name, T.StringType(), kind in NULLABLE_KINDS) for kind, name in (metadata or {}).items()
    ]
    folded = fold_names([f.name for f in fields], case_sensitive, table)
    fields = [replace(f, name=n, spellings=f.names) for f, n in zip(fields, folded)]
    if primary_key:
        known = set(source.names) | {name for name, _ in computed}
        missing = [k for k in primary_key if k not in known]
        if missing:
            raise ValueError(f"primary key {missing} is not among source or computed columns {sorted(known)}")
        key = list(primary_key)
    elif source.primary_key:
        key = list(source.primary_key)
    elif require_primary_key:
        raise ValueError(f"{table}: no primary key given, and the sources have none or differ in it")
    else:
        key = []
    key = key if case_sensitive else [k.lower() for k in key]
    return TableSchema(fields, key, {**(options or {}), **source.options}, source.comment)


def evolve(target: TableSchema, changed: Sequence[Field]) -> TableSchema:
    """C-09, C-10: append columns that are new, widen types; repeating a change does nothing.

    A narrower type from a lagging shard is ignored. A type of another family is an error.
    """
    fields = {f.name: f for f in target.fields}
    for new in changed:
        old = fields.get(new.name)
        if old is None:
            fields[new.name] = replace(new, nullable=True)
            continue
        dtype = widest(old.dtype, new.dtype)
        if dtype is None:
            raise IncompatibleSchema(f"column {new.name}: cannot change {old.dtype} to {new.dtype}")
        source_type = new.source_type if dtype != old.dtype else old.source_type
        fields[new.name] = replace(old, dtype=dtype, source_type=source_type, spellings=_spellings(old, new))
    return replace(target, fields=list(fields.values()))


def changed_fields(rows: Iterable, case_sensitive: bool = True, tinyint1_not_bool: bool = False) -> list[Field]:
    """Rows of decoded schema changes (one table's columns, in log order) as fields."""
    out = []
    for r in rows:
        dtype = spark_type(r["type"], r["length"], r["scale"], tinyint1_not_bool)
        name = r["column"] if case_sensitive else r["column"].lower()
        text = r["type"] if "(" in r["type"] or r["length"] is None else f"{r['type']}({r['length']})"
        out.append(Field(name, dtype, True, text, r["comment"], (r["column"],)))
    return out


class TypeRegistry:
    """C-12: types gathered batch by batch, a stored table that batches are merged into.

    For each ``(db, tbl, column)`` it keeps the distinct types seen, each with one value of it. The merged type is
    taken over these examples, so it equals one pass over all rows, while the table grows with the catalog only. A batch
    adds what it has not seen; adding it again does nothing.
    """

    KEY = ("db", "tbl", "column")

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def seen(self) -> DataFrame:
        schema = "db STRING, tbl STRING, column STRING, type STRING, example VARIANT"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def add(self, changes: DataFrame, image: str = "after") -> DataFrame:
        """Merge a batch in; gives the columns whose merged type it changed, with the type before (NULL if new)."""
        fields = F.explode(F.try_variant_get(F.col(image), "$", "map<string,variant>")).alias("column", "v")
        each = changes.select("db", "tbl", fields)
        found = each.groupBy(*self.KEY, F.schema_of_variant("v").alias("type")).agg(F.any_value("v").alias("example"))
        seen = self.seen()
        new = found.join(F.broadcast(seen.select(*self.KEY, "type")), [*self.KEY, "type"], "left_anti")  # of catalog size
        before = self.types().withColumnRenamed("type", "old_type").collect()
        new.select(*seen.columns).write.mode("append").parquet(self.path)
        old = self.spark.createDataFrame(before, "db STRING, tbl STRING, column STRING, old_type STRING")
        merged = self.types().join(old, list(self.KEY), "left")
        return merged.where(~F.col("type").eqNullSafe(F.col("old_type")))

    def types(self) -> DataFrame:
        """The merged type of every column."""
        return self.seen().groupBy(*self.KEY).agg(F.schema_of_variant_agg("example").alias("type"))


#: Type names of row images that differ from those of Spark's schema text.
VARIANT_TYPES = {"VOID": None, "VARIANT": T.StringType()}


def inferred_dtype(text: str) -> T.DataType | None:
    """A column type for an inferred one; None while only nulls were seen. Mixed and nested values are kept as text."""
    if text in VARIANT_TYPES:
        return VARIANT_TYPES[text]
    if text.startswith(("OBJECT", "ARRAY")):
        return T.StringType()
    return T.DataType.fromDDL(text)


def infer_fields(changes: DataFrame, image: str = "after") -> DataFrame:
    """C-12: columns and types seen in the row images, one row per ``(db, tbl, column)``.

    Types merge map-side, so the shuffle carries one short type text per column and task.
    """
    fields = F.explode(F.try_variant_get(F.col(image), "$", "map<string,variant>")).alias("column", "v")
    return (
        changes.select("db", "tbl", fields)
        .groupBy("db", "tbl", "column")
        .agg(F.schema_of_variant_agg("v").alias("type"))
    )
