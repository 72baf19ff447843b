"""A change log derived from the ``events`` table, and its SQL twin.

Each event is one change of the row whose key is its user. Users are spread over source tables
``test_d_0 .. test_d_3`` and ``other_0 .. other_2`` of database ``ods_test``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.row_kinds import DayColumn, Projection
from tidemark.operators.routing import Route
from tidemark.operators.schema import Field, TableSchema
from tidemark.queries.registry import table

SERVER = "3e11fa47-71ca-11e1-9e33-c80aa9429562"
EVENTS_PER_FILE = 4000
# Event ids per slice of a key's history; see previous_image.
SLICE = 1 << 16

ROUTES = [
    Route("ods_test", "test_d_1", "lake.pt1"),
    Route("ods_test", r"test_d_(\d+)$", "lake.pt_all"),
    Route("ods_test", r"test_d_(\d+)$", "lake.pt_all_dt"),
]

# The log as SQL: one row per event, with what a decoded change holds.
LOG = f"""log AS (
  SELECT event_id, ts, user_id AS k, event_type AS v1, value AS val, 'ods_test' AS db,
    CASE WHEN user_id % 5 = 4 THEN 'other_' || (user_id % 3) ELSE 'test_d_' || (user_id % 5) END AS tbl,
    event_id % 11 = 0 AS gone,
    1 + event_id // {EVENTS_PER_FILE} AS file_no,
    4 + (event_id % {EVENTS_PER_FILE}) // 2 AS pos,
    event_id % 2 AS row,
    epoch_us(ts) // 1000 AS ts_ms,
    1 + event_id // 2 AS txn,
    CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN '1970-01-01' ELSE strftime(ts, '%Y-%m-%d') END AS dt
  FROM events)"""

# Live rows per key after the whole log.
LIVE = """live AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY event_id DESC) AS rn FROM log)
  WHERE rn = 1 AND NOT gone)"""


def source_table(user: Column) -> Column:
    other = F.concat(F.lit("other_"), (user % 3).cast("string"))
    return F.when(user % 5 == 4, other).otherwise(F.concat(F.lit("test_d_"), (user % 5).cast("string")))


def loose_time(event: Column, at: Column) -> Column:
    """The event time written in one of the nine accepted forms, and NULL or junk now and then."""
    instant = at.cast("timestamp")
    form = event % 9
    text = (
        F.when(form == 0, F.unix_seconds(instant).cast("string"))
        .when(form == 1, F.unix_millis(instant).cast("string"))
        .when(form == 2, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(form == 3, F.date_format(at, "yyyy-MM-dd HH:mm"))
        .when(form == 4, F.date_format(at, "yyyy-MM-dd HH"))
        .when(form == 5, F.date_format(at, "yyyy-MM-dd"))
        .when(form == 6, F.date_format(at, "yyyyMMdd"))
        .when(form == 7, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss,SSS"))
    )
    return F.when(event % 101 == 0, F.lit(None)).when(event % 103 == 0, "garbage").otherwise(text)


def loose_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their loosely typed time text."""
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("add_time", loose_time(F.col("event_id"), F.col("ts")))


def previous_image(images: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """Add ``before``: the image of the key's previous change, NULL if that was a delete.

    A key may own a third of all events, so its history is not sorted in one piece: windows run over slices
    of the id range, and only the first and last row of each slice meet in a second window.
    """
    sliced = images.withColumn("_slice", F.floor(F.col("event_id") / slice_size))
    state = F.struct(F.lit(True).alias("known"), F.when(F.col("event_id") % 11 != 0, F.col("after")).alias("image"))
    inner = Window.partitionBy("k", "_slice").orderBy("event_id")
    marked = sliced.withColumns({
        "_prev": F.lag(state).over(inner), "_last": F.lead("event_id").over(inner).isNull(),
    })
    within = marked.where(F.col("_prev").isNotNull())
    edges = marked.where(F.col("_prev").isNull() | F.col("_last"))
    first = F.col("_prev").isNull()
    outer = Window.partitionBy("k").orderBy("event_id")
    across = (
        edges.withColumns({"_first": first, "_prev": F.lag(state).over(outer)}).where("_first").drop("_first")
    )
    return within.unionByName(across).withColumn("before", F.col("_prev.image")).drop("_prev", "_slice", "_last")


def shard(user: Column, shards: int) -> Column:
    """The database of a user's rows: one, or several that hold tables of the same names."""
    return F.lit("ods_test") if shards == 1 else F.concat(F.lit("ods_"), (F.floor(user / 5) % shards).cast("string"))


def event_log(spark: SparkSession, sf_dir: str, before: str = "key", value: str = "value", shards: int = 1) -> DataFrame:
    """The log as JSON text in ``value``, with ``event_id`` beside it for slicing.

    ``before='key'`` puts only the key into before images, ``'full'`` the whole previous row.
    """
    ev = loose_events(spark, sf_dir)
    image = F.struct(
        F.col("user_id").alias("k"), F.col("event_type").alias("v1"), F.col("value").alias("val"), F.col("add_time")
    )
    images = ev.select("event_id", "ts", F.col("user_id").alias("k"), image.alias("after"))
    deletes = F.col("event_id") % 11 == 0
    if before == "full":
        images = previous_image(images)
        op = F.when(deletes, "d").when(F.col("before").isNull(), "c").otherwise("u")
    else:
        images = images.withColumn("before", F.struct("k"))
        op = F.when(deletes, "d").otherwise("u")
    payload = F.struct(
        op.alias("op"),
        F.col("before"),
        F.when(~deletes, F.col("after")).alias("after"),
        source_struct(F.col("event_id"), F.col("k"), F.col("ts"), shards).alias("source"),
    )
    text = F.to_json(F.struct(payload.alias("payload")), {"ignoreNullFields": "false"})
    return images.select("event_id", text.alias(value))


def source_struct(event: Column, user: Column, at: Column, shards: int = 1) -> Column:
    return F.struct(
        F.unix_millis(at.cast("timestamp")).alias("ts_ms"),
        F.lit("false").alias("snapshot"),
        shard(user, shards).alias("db"),
        source_table(user).alias("table"),
        F.concat(F.lit(SERVER + ":"), (1 + F.floor(event / 2)).cast("string")).alias("gtid"),
        F.format_string("mysql-bin.%06d", 1 + F.floor(event / EVENTS_PER_FILE)).alias("file"),
        (4 + F.floor((event % EVENTS_PER_FILE) / 2)).cast("bigint").alias("pos"),
        (event % 2).cast("int").alias("row"),
    )


def ddl_log(spark: SparkSession, sf_dir: str, shards: int = 1) -> DataFrame:
    """Schema change entries: each signup alters its table, with a changing length and a new column."""
    ev = table(spark, sf_dir, "events").where("event_type = 'signup'")
    event = F.col("event_id")

    def column(name: Column | str, kind: str, position: int, length: Column | None = None) -> Column:
        return F.struct(
            (F.lit(name) if isinstance(name, str) else name).alias("name"),
            F.lit(kind).alias("typeName"),
            F.lit(kind).alias("typeExpression"),
            (F.lit(None).cast("int") if length is None else length.cast("int")).alias("length"),
            F.lit(position).alias("position"),
            F.lit(position > 1).alias("optional"),
        )

    columns = F.array(
        column("k", "BIGINT", 1),
        column("v1", "VARCHAR", 2, 10 + F.floor(event / 50) % 20),
        column("val", "DOUBLE", 3),
        column("add_time", "VARCHAR", 4, F.lit(30)),
        column(F.concat(F.lit("extra_"), (event % 7).cast("string")), "INT", 5),
    )
    source = source_struct(event, F.col("user_id"), F.col("ts"), shards)
    db = shard(F.col("user_id"), shards)
    name = source_table(F.col("user_id"))
    history = F.struct(
        db.alias("databaseName"),
        F.concat(F.lit("ALTER TABLE "), name).alias("ddl"),
        F.array(F.struct(
            F.lit("ALTER").alias("type"),
            F.concat(F.lit('"'), db, F.lit('"."'), name, F.lit('"')).alias("id"),
            F.struct(F.array(F.lit("k")).alias("primaryKeyColumnNames"), columns.alias("columns")).alias("table"),
        )).alias("tableChanges"),
    )
    payload = F.struct(source.alias("source"), F.to_json(history).alias("historyRecord"))
    return ev.select("event_id", F.to_json(F.struct(payload.alias("payload"))).alias("value"))


FIELDS = [
    Field("k", T.LongType(), False, "bigint"),
    Field("v1", T.VarcharType(20), True, "varchar(20)"),
    Field("val", T.DoubleType(), True, "double"),
    Field("add_time", T.VarcharType(30), True, "varchar(30)"),
]


def schema(day: bool = False) -> TableSchema:
    """Source columns, and the day column with its place in the key where asked for."""
    fields = list(FIELDS)
    if day:
        return TableSchema([*fields, Field("dt", T.StringType(), False)], ["dt", "k"])
    return TableSchema(fields, ["k"])


def projection(day: bool = False) -> Projection:
    return Projection(schema(day), DayColumn("add_time") if day else None)
