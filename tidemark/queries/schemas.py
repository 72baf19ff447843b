"""Schema operators over schemas and rows that come from the tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import storage_type, typed_value
from tidemark.operators.history import column_changes, schema_history, with_schema
from tidemark.operators.schema import (
    Field, TableSchema, TypeRegistry, build_target, changed_fields, evolve, infer_fields, inferred_dtype, merge_all, merge_keyed, merge_shards,
    problems, union_shards, with_primary_key,
)
from tidemark.queries.eventlog import LOG, ddl_log, event_log, schema
from tidemark.queries.log import changes
from tidemark.queries.registry import query, table
from tidemark.session import work_dir
from tidemark.sources.changelog import decode, row_changes, schema_changes


def _schema_of(df: DataFrame, key: list[str]) -> TableSchema:
    return TableSchema([Field(f.name, f.dataType, f.nullable) for f in df.schema.fields], key)


def _shards(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    first = orders.where("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").cast("int").alias("k"), F.col("o_orderpriority").alias("v1")
    )
    second = orders.where("o_orderkey % 2 = 1").select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v2"), F.col("o_orderpriority").alias("v1")
    )
    return first, second


@query("c01_merge_sources", """SELECT o_orderkey AS k, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
      CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS price, CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS customer
    FROM orders""")
def c01_merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources of one target: types and columns differ, the target takes them all."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    parts = [
        orders.where("o_orderstatus = 'F'").select(key.cast("int").alias("k"), F.col("o_orderpriority").alias("priority")),
        orders.where("o_orderstatus = 'O'").select(
            key.alias("k"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price")
        ),
        orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("customer"), key.cast("int").alias("k")),
    ]
    merged = merge_all([_schema_of(p, ["k"]) for p in parts], "lake.orders")
    return union_shards(parts, merged)


@query("c02_merge_keyed", """SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS v1,
      CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS v2 FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def c02_merge_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables that have a primary key as one; a table without one is left out, with its columns."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    parts = {
        ("s1", "a"): orders.where("o_orderstatus = 'F'").select(key.cast("int").alias("k"), F.col("o_orderpriority").alias("v1")),
        ("s1", "b"): orders.where("o_orderstatus = 'O'").select(key.alias("k"), F.col("o_totalprice").alias("v2")),
        ("s2", "a"): orders.where("o_orderstatus = 'P'").select(key.alias("k"), F.col("o_custkey").alias("v3")),
    }
    schemas = {name: _schema_of(df, ["k"] if name[0] == "s1" else []) for name, df in parts.items()}
    return union_shards([parts[name] for name in with_primary_key(schemas)], merge_keyed(schemas))


@query("c03_merge_shards", """SELECT CAST(o_orderkey AS BIGINT) AS k, o_orderpriority AS v1,
      CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS v2 FROM orders""")
def c03_merge_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shards of one table: the key is INT in one and BIGINT in the other, a column is in one only."""
    first, second = _shards(spark, sf_dir)
    merged = merge_shards({("s1", "t"): _schema_of(first, ["k"]), ("s2", "t"): _schema_of(second, ["k"])})["t"]
    return union_shards([first, second], merged)


@query("c04_fit_report", f"""WITH {LOG} SELECT tbl, 'note' AS "column", true AS misfit, count(*) AS images
    FROM log WHERE NOT gone AND tbl = 'test_d_0' GROUP BY tbl
    UNION ALL SELECT tbl, c."column", false, count(*) FROM log,
      (VALUES ('k'), ('v1'), ('val'), ('add_time')) c("column") WHERE NOT gone AND (c."column" <> 'add_time' OR event_id % 101 <> 0)
    GROUP BY tbl, c."column" """)
def c04_fit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that the row images carry, checked against the target of all tables. One table has a column
    more than the target knows."""
    c = changes(spark, sf_dir).where("op <> 'd'")
    extra = F.when(F.col("tbl") == "test_d_0", F.array(F.lit("note"))).otherwise(F.array().cast("array<string>"))
    names = F.concat(F.map_keys(F.try_variant_get("after", "$", "map<string,variant>")), extra)
    value = F.try_variant_get("after", "$.add_time", "string")
    found = c.select("tbl", F.explode(names).alias("column"), value.isNull().alias("empty"))
    found = found.where(~((F.col("column") == "add_time") & F.col("empty")))
    counted = found.groupBy("tbl", "column").agg(F.count(F.lit(1)).alias("images"))
    target = schema()
    bad = [
        f.name for f in [*target.fields, Field("note", T.StringType())] if problems([f], target)
    ]
    return counted.select("tbl", "column", F.col("column").isin(bad).alias("misfit"), "images")


@query("c08_schema_after_changes", f"""WITH {LOG}, alters AS (SELECT * FROM log WHERE v1 = 'signup')
    SELECT 'v1' AS "column", 'varchar(' || max(greatest(20, 10 + (event_id // 50) % 20)) || ')' AS type FROM alters
    UNION ALL SELECT DISTINCT 'extra_' || (event_id % 7), 'int' FROM alters
    UNION ALL SELECT * FROM (VALUES ('k', 'bigint'), ('val', 'double'), ('add_time', 'varchar(30)')) v""")
def c08_schema_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All schema changes of the log folded into the target's schema: columns added, types widened, lagging
    shards ignored."""
    columns = (
        schema_changes(decode(ddl_log(spark, sf_dir)))
        .groupBy("column", "type", "length", "scale")
        .agg(F.min(F.struct("file_no", "pos", "position")).alias("at"), F.max("comment").alias("comment"))
        .sort("at")
        .collect()
    )
    final = evolve(schema(), changed_fields(columns))
    rows = [(f.name, f.dtype.simpleString()) for f in final.fields]
    return spark.createDataFrame(rows, "column string, type string")


# The exact type of a column of decimals: as many digits before and after the point as any value has.
EXACT = f"""WITH {LOG}, digits AS (SELECT tbl, regexp_replace(CAST(val AS VARCHAR), '^0\\.', '.') AS t FROM log WHERE NOT gone),
    sized AS (SELECT tbl, length(split_part(t, '.', 1)) AS whole, length(regexp_replace(split_part(t, '.', 2), '0+$', '')) AS scale FROM digits),
    types AS (SELECT tbl, 'val' AS "column", 'DECIMAL(' || (max(whole) + max(scale)) || ',' || max(scale) || ')' AS type FROM sized GROUP BY tbl
      UNION ALL SELECT DISTINCT tbl, c."column", c.type FROM log, (VALUES ('k', 'BIGINT'), ('v1', 'STRING'), ('add_time', 'STRING')) c("column", type) WHERE NOT gone)"""


@query("c12_incremental", EXACT + """ SELECT tbl, "column", type FROM types""")
def c12_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact types, gathered in four batches, one of them twice: the same as in one pass over the log."""
    registry = TypeRegistry(spark, work_dir(spark, "c12"))
    images = changes(spark, sf_dir).where("op <> 'd'")
    for part in (0, 1, 2, 1, 3):
        registry.add(images.where(F.col("pos") % 4 == part))
    return registry.types().select("tbl", "column", "type")


@query("c04_fit_of_inferred_types", EXACT + """ SELECT tbl, "column", type, "column" = 'val' AS misfit FROM types""")
def c04_fit_of_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types that rows really have against a target that holds ``val`` with one digit behind the point. Types are of
    catalog size, so they are compared on the driver."""
    target = replace(schema(), fields=[replace(f, dtype=T.DecimalType(20, 1)) if f.name == "val" else replace(f, dtype=storage_type(f.dtype)) for f in schema().fields])
    found = infer_fields(changes(spark, sf_dir).where("op <> 'd'")).collect()
    rows = [(r["tbl"], r["column"], r["type"], bool(problems([Field(r["column"], inferred_dtype(r["type"]))], target))) for r in found]
    return spark.createDataFrame(rows, "tbl string, column string, type string, misfit boolean")


# Tables of the same names in three databases. Each signup alters its own table; repeating a definition changes nothing.
SHARDS = 3
VERSIONS = f"""WITH {LOG}, named AS (SELECT * REPLACE ('ods_' || ((k // 5) % {SHARDS}) AS db) FROM log),
    alters AS (SELECT *, 10 + (event_id // 50) % 20 AS length, 'extra_' || (event_id % 7) AS extra FROM named WHERE v1 = 'signup'),
    changed AS (SELECT *, lag(length) OVER w AS old_length, lag(extra) OVER w AS old_extra FROM alters
      WINDOW w AS (PARTITION BY db, tbl ORDER BY event_id)),
    versions AS (SELECT *, row_number() OVER (PARTITION BY db, tbl ORDER BY event_id) AS version FROM changed
      WHERE old_length IS NULL OR old_length <> length OR old_extra <> extra)"""


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = schema_history(schema_changes(decode(ddl_log(spark, sf_dir, SHARDS))))
    path = work_dir(spark, "history")
    history.write.parquet(path)
    return spark.read.schema(history.schema).parquet(path)


@query("c11_as_of_schema", VERSIONS + """
    SELECT e.db, e.tbl, e.k, e.file_no, e.pos, e.row, coalesce(v.version, 0) AS version, v.length AS v1_length, v.extra
    FROM named e ASOF LEFT JOIN versions v ON e.db = v.db AND e.tbl = v.tbl AND e.event_id >= v.event_id""")
def c11_as_of_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change with the schema that its own table had at its position."""
    log = row_changes(decode(event_log(spark, sf_dir, shards=SHARDS)))
    key = F.coalesce(*[typed_value(image, "k", T.LongType()) for image in ("after", "before")])
    rows = log.select("db", "tbl", key.alias("k"), "file_no", "pos", F.col("row").cast("bigint").alias("row"))
    dated = with_schema(rows, _history(spark, sf_dir))
    return dated.select(
        "db", "tbl", "k", "file_no", "pos", "row", F.col("version").cast("bigint").alias("version"),
        F.get("columns", F.lit(1))["length"].cast("bigint").alias("v1_length"), F.get("columns", F.lit(4))["column"].alias("extra"))


@query("c11_column_changes", VERSIONS + """, each_change AS (
      SELECT db, tbl, version, event_id, 'v1' AS "column", CASE WHEN old_length IS NULL THEN 'added' ELSE 'altered' END AS change FROM versions
        WHERE old_length IS NULL OR old_length <> length
      UNION ALL SELECT db, tbl, version, event_id, extra, 'added' FROM versions WHERE old_extra IS NULL OR old_extra <> extra
      UNION ALL SELECT db, tbl, version, event_id, old_extra, 'dropped' FROM versions WHERE old_extra <> extra
      UNION ALL SELECT db, tbl, version, event_id, c."column", 'added' FROM versions, (VALUES ('k'), ('val'), ('add_time')) c("column") WHERE old_length IS NULL)
    SELECT c.db, c.tbl, c.version, l.file_no, l.pos, c."column", c.change FROM each_change c JOIN log l USING (event_id)""")
def c11_column_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each schema change did to its own table; shards of one name are kept apart."""
    found = column_changes(_history(spark, sf_dir))
    return found.select("db", "tbl", F.col("version").cast("bigint").alias("version"), "since.file_no", "since.pos", "column", "change")


@query("c12_inferred_fields", f"""WITH {LOG} SELECT DISTINCT tbl, c."column", c.type FROM log,
      (VALUES ('k', 'BIGINT'), ('v1', 'STRING'), ('add_time', 'STRING'), ('val', 'DECIMAL')) c("column", type)
    WHERE NOT gone""")
def c12_inferred_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types read off the row images; a decimal's digits depend on the values, so its name only."""
    found = infer_fields(changes(spark, sf_dir).where("op <> 'd'"))
    return found.select("tbl", "column", F.regexp_replace("type", r"\(.*", "").alias("type"))


@query("c07_target_schema_of_shards", """SELECT 'k' AS "column", 'bigint' AS type, true AS is_key, count(*) AS values FROM orders
    UNION ALL SELECT 'v1', 'string', false, count(o_orderpriority) FROM orders
    UNION ALL SELECT 'v2', 'double', false, count(o_totalprice) FROM orders WHERE o_orderkey % 2 = 1
    UNION ALL SELECT 'dt', 'string', true, count(*) FROM orders
    UNION ALL SELECT 'src', 'string', false, count(*) FROM orders""")
def c07_target_schema_of_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target schema of two shards with a day and a metadata column, and how full each column is."""
    first, second = _shards(spark, sf_dir)
    merged = merge_shards({("s1", "t"): _schema_of(first, ["k"]), ("s2", "t"): _schema_of(second, ["k"])})["t"]
    target = build_target(merged, [("dt", T.StringType())], {"TABLE": "src"}, ["dt", "k"])
    rows = union_shards([first, second], merged).withColumns({"dt": F.lit("1970-01-01"), "src": F.lit("t")})
    counts = rows.agg(*[F.count(f.name).alias(f.name) for f in target.fields])
    long = counts.unpivot([], target.names, "column", "values")
    kinds = F.create_map(*[F.lit(x) for f in target.fields for x in (f.name, f.dtype.simpleString())])
    return long.select("column", kinds[F.col("column")].alias("type"), F.col("column").isin(target.primary_key).alias("is_key"), "values")
