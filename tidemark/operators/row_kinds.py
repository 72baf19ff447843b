"""Row kinds of changes, their order, and the latest change of each key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import DEFAULT_DAY, day_bucket
from tidemark.functions.metadata import metadata_columns
from tidemark.functions.types import decode_text, is_encoded, present, raw_value, stored_value
from tidemark.operators.schema import Field, TableSchema

UPSERT, DELETE = "U", "D"
KIND = "_kind"
ORDER = ("_file_no", "_pos", "_row", "_seq")


@dataclass(frozen=True)
class DayColumn:
    """S-01, S-06: the one derived day column of a target."""

    source: str
    name: str = "dt"
    default: str = DEFAULT_DAY
    extended: bool = False


@dataclass(frozen=True)
class Projection:
    """How changes become rows of one target. The target's own columns and key decide."""

    schema: TableSchema
    day: DayColumn | None = None
    metadata: Mapping[str, str] = field(default_factory=dict)
    strict: bool = True

    def day_field(self) -> Field:
        """The source field that the day is taken from, under all its spellings."""
        return self.schema.get(self.day.source) or Field(self.day.source, None)

    def image_fields(self) -> list[Field]:
        derived = set(self.metadata.values()) | ({self.day.name} if self.day else set())
        return [f for f in self.schema.fields if f.name not in derived]


def to_row_kinds(changes: DataFrame, p: Projection) -> DataFrame:
    """S-05, W-07: typed rows of a target with kind and position.

    ``c`` and ``r`` upsert the after image, ``d`` deletes the before image, ``u`` does both. Derived columns
    are computed on each image, so a delete finds the day partition that the old row went to. The delete
    half of an update is left out when its key and day are those of the after image: the upsert
    that follows replaces that row anyway, and half the shuffle is saved.
    """
    key_fields = [f for f in p.image_fields() if f.name in p.schema.primary_key]
    if p.day:
        key_fields.append(p.day_field())
    moved = F.lit(False)
    for f in key_fields:
        moved = moved | ~raw_value("before", *f.names).eqNullSafe(raw_value("after", *f.names))
    op = F.col("op")
    gone = present("before") & ((op == "d") | ((op == "u") & moved))
    now = present("after") & op.isin("c", "r", "u")
    image_of = [
        F.when(gone, F.struct(F.lit(DELETE).alias(KIND), F.lit(0).alias("_seq"), F.col("before").alias("_image"))),
        F.when(now, F.struct(F.lit(UPSERT).alias(KIND), F.lit(1).alias("_seq"), F.col("after").alias("_image"))),
    ]
    halves = changes.select(
        "db", "tbl", "src_schema", "ts_ms",
        F.col("file_no").alias("_file_no"), F.col("pos").alias("_pos"), F.col("row").alias("_row"),
        F.inline(F.array(*image_of)),
    ).where(F.col(KIND).isNotNull())
    return project_image(halves, p, "_image", [KIND, *ORDER])


def project_image(changes: DataFrame, p: Projection, image: str, keep: Sequence[str] = ()) -> DataFrame:
    """S-05, S-15: the target's columns from one row image, in the target's order.

    Two steps, so that a field which takes several looks (a loose time, an encoded date) is read from the image
    once.
    """
    first = [
        stored_value(image, f.names, f.dtype, f.source_type, p.strict).alias(f.name) for f in p.image_fields()
    ]
    derived = {}
    for column, name in zip(metadata_columns(p.metadata), p.metadata.values()):
        first.append(column)
        derived[name] = F.col(name)
    if p.day:
        first.append(raw_value(image, *p.day_field().names).alias("_day_text"))
        derived[p.day.name] = day_of(F.col("_day_text"), p).alias(p.day.name)
    step = changes.select(*first, *keep)

    def final(f: Field) -> Column:
        if f.name in derived:
            return derived[f.name]
        if is_encoded(f.dtype, f.source_type):
            return decode_text(F.col(f.name), f.dtype, f.source_type, p.strict).alias(f.name)
        return F.col(f.name)

    return step.select(*[final(f) for f in p.schema.fields], *keep)


def day_of(text: Column, p: Projection) -> Column:
    """S-01: the day of the target's day source.

    A date or a time of a typed source column is decoded first and its own day taken; an instant falls on a day of
    the session zone. Text and integers go by the rules of loose time text.
    """
    source = p.day_field()
    if isinstance(source.dtype, (T.DateType, T.TimestampNTZType)):
        value = decode_text(text, source.dtype, source.source_type, strict=False)
    elif isinstance(source.dtype, T.TimestampType):
        value = text.try_cast("timestamp")
    else:
        return day_bucket(text, p.day.default, p.day.extended)
    return F.coalesce(value.cast("date").cast("string"), F.lit(p.day.default))


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """The last change of each key by log position.

    Spark keeps one row per key and task before the shuffle (WindowGroupLimit), so a key that holds a large
    share of all changes does not end up as one large group.
    """
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def current_state(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """W-13: the rows that are alive after all changes, straight from the log."""
    return latest_per_key(rows, key).where(F.col(KIND) == UPSERT).drop(KIND, *ORDER)
