"""Find source tables and their schemas, and read snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import spark_type
from tidemark.operators.routing import Route, matched_targets, whole_match
from tidemark.operators.schema import Field, TableSchema

JDBC_PREFIX = "jdbc.properties."
LOG_PREFIX = "debezium."


def strip_prefix(options: Mapping[str, str], prefix: str) -> dict[str, str]:
    """R-14: the options under a prefix, without it."""
    return {k[len(prefix):]: v for k, v in options.items() if k.startswith(prefix)}


def jdbc_properties(options: Mapping[str, str], tinyint1_not_bool: bool = False) -> dict[str, str]:
    """R-14: pass-through JDBC properties; the tinyint(1) flag must not contradict them."""
    found = strip_prefix(options, JDBC_PREFIX)
    if tinyint1_not_bool:
        if found.get("tinyInt1isBit") == "true":
            raise ValueError("tinyint1-not-bool conflicts with jdbc.properties.tinyInt1isBit=true")
        found.setdefault("tinyInt1isBit", "false")
    return found


def information_schema_columns(spark: SparkSession, url: str, properties: Mapping[str, str]) -> DataFrame:
    """R-15: column list of a database server over JDBC, in the shape :func:`source_schemas` takes."""
    query = (
        "SELECT c.table_schema AS db, c.table_name AS tbl, c.column_name AS `column`, c.column_type AS type,"
        " c.ordinal_position AS position, c.is_nullable = 'YES' AS nullable, c.column_key = 'PRI' AS is_key,"
        " c.column_comment AS comment, t.table_comment AS table_comment"
        " FROM information_schema.columns c JOIN information_schema.tables t"
        " ON t.table_schema = c.table_schema AND t.table_name = c.table_name AND t.table_type = 'BASE TABLE'"
    )
    return spark.read.format("jdbc").options(url=url, query=query, **properties).load()


def discover(tables: DataFrame, database: str, routes: Sequence[Route]) -> DataFrame:
    """R-15: tables of the matching databases with the table patterns that take each; excluded if none."""
    patterns = sorted({r.table for r in routes})
    hits = F.array_compact(F.array(*[F.when(whole_match("tbl", p), F.lit(p)) for p in patterns]))
    return (
        tables.select("db", "tbl").distinct()
        .where(whole_match("db", database))
        .withColumn("patterns", hits)
        .withColumn("status", F.when(F.size("patterns") > 0, "matched").otherwise("excluded"))
    )


def source_schemas(
    columns: DataFrame, routes: Sequence[Route] | None = None, tinyint1_not_bool: bool = False
) -> dict[tuple[str, str], TableSchema]:
    """R-15: schemas of the matched tables. The result is catalog metadata, one entry per table."""
    if routes is not None:
        columns = columns.where(F.size(matched_targets(routes)) > 0)
    wanted = ["length", "scale", "comment", "table_comment", "is_key"]
    defaults = {"is_key": F.lit(False)}
    extra = [c if c in columns.columns else defaults.get(c, F.lit(None)).alias(c) for c in wanted]
    out: dict[tuple[str, str], TableSchema] = {}
    rows = columns.select("db", "tbl", "column", "type", "position", "nullable", *extra)
    for r in sorted(rows.collect(), key=lambda r: (r["db"], r["tbl"], r["position"])):
        table = out.setdefault((r["db"], r["tbl"]), TableSchema(comment=r["table_comment"]))
        dtype = spark_type(r["type"], r["length"], r["scale"], tinyint1_not_bool)
        table.fields.append(
            Field(r["column"], dtype, bool(r["nullable"]), r["type"], r["comment"], (r["column"],))
        )
        if r["is_key"]:
            table.primary_key.append(r["column"])
    return out


def snapshot_options(low: int, high: int, split_size: int, key: str) -> dict[str, str]:
    """R-13: partitioned JDBC read with about ``split_size`` rows per partition."""
    if split_size < 1:
        raise ValueError("split size must be positive")
    parts = max(1, -(-(high - low + 1) // split_size))
    return {
        "partitionColumn": key, "lowerBound": str(low), "upperBound": str(high + 1), "numPartitions": str(parts),
        "fetchsize": str(min(split_size, 10_000)),
    }


def read_snapshot_jdbc(
    spark: SparkSession, url: str, table: str, key: str, split_size: int, properties: Mapping[str, str]
) -> DataFrame:
    """R-13: a table snapshot over JDBC; an integer key makes it a parallel read."""
    reader = spark.read.format("jdbc").options(url=url, **properties)
    edge = reader.option("query", f"SELECT min({key}) AS low, max({key}) AS high FROM {table}").load().first()
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if edge["low"] is None:
        return reader.load()
    return reader.options(**snapshot_options(int(edge["low"]), int(edge["high"]), split_size, key)).load()


def snapshot_chunks(table: DataFrame, key: str, split_size: int) -> DataFrame:
    """R-13: the key ranges that a split size gives, with their row counts, for checking balance."""
    low = table.agg(F.min(key)).first()[0]
    chunk = F.floor((F.col(key) - F.lit(low if low is not None else 0)) / split_size).cast("bigint")
    return table.groupBy(chunk.alias("chunk")).agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count(F.lit(1)).alias("rows")
    )


def snapshot_changes(table: DataFrame, db: str, tbl: str) -> DataFrame:
    """R-07: rows of a table as changes with op ``r``, change time 0 and the lowest position."""
    image = F.to_variant_object(F.struct(*[F.col(c) for c in table.columns]))
    return table.select(
        F.lit(db).alias("db"),
        F.lit(tbl).alias("tbl"),
        F.lit("r").alias("op"),
        F.lit(None).cast("variant").alias("before"),
        image.alias("after"),
        F.lit(None).cast("string").alias("src_schema"),
        F.lit(0).cast("bigint").alias("ts_ms"),
        F.lit("").alias("file"),
        F.lit(0).cast("bigint").alias("file_no"),
        F.lit(0).cast("bigint").alias("pos"),
        F.lit(0).alias("row"),
        F.lit(None).cast("string").alias("gtid"),
    )


def from_server_zone(c: Column | str, zone: str) -> Column:
    """R-16: a wall-clock time of the source server's zone as an instant."""
    column = F.col(c) if isinstance(c, str) else c
    return F.convert_timezone(F.lit(zone), F.current_timezone(), column.cast("timestamp_ntz")).cast("timestamp")


def normalise_zones(table: DataFrame, zone: str, columns: Sequence[str] | None = None) -> DataFrame:
    """R-16: every wall-clock column, or the given ones, read in the server's zone."""
    picked = columns
    if picked is None:
        picked = [f.name for f in table.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return table.withColumns({c: from_server_zone(c, zone) for c in picked})
