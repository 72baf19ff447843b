"""Read and decode a change log of row changes and schema changes.

A log entry is one JSON text. Row changes carry ``payload.op``, ``before``, ``after`` and ``source``;
schema changes carry ``payload.source`` and ``payload.historyRecord`` (itself JSON text).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.routing import whole_match

SOURCE = (
    "STRUCT<ts_ms BIGINT, snapshot STRING, db STRING, `schema` STRING, `table` STRING, server_id BIGINT,"
    " gtid STRING, file STRING, pos BIGINT, `row` INT>"
)
ENVELOPE = (
    f"payload STRUCT<op STRING, before VARIANT, after VARIANT, source {SOURCE}, historyRecord STRING>"
)
HISTORY = (
    "databaseName STRING, ddl STRING, tableChanges ARRAY<STRUCT<type STRING, id STRING,"
    " `table` STRUCT<comment STRING, primaryKeyColumnNames ARRAY<STRING>, columns ARRAY<STRUCT<name STRING,"
    " typeName STRING, typeExpression STRING, length INT, scale INT, position INT, optional BOOLEAN,"
    " comment STRING>>>>>"
)


def read_log(spark: SparkSession, path: str, fmt: str = "text", options: Mapping[str, str] | None = None) -> DataFrame:
    """R-03: the log as a batch DataFrame with one ``value`` column. ``fmt``: text, parquet, orc, kafka."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("value"))
    return reader.schema("value STRING").load(path)


def read_log_stream(
    spark: SparkSession, path: str, fmt: str = "text", options: Mapping[str, str] | None = None
) -> DataFrame:
    """R-03: the log as a streaming DataFrame. Limit a micro-batch with ``maxFilesPerTrigger`` or its Kafka twin."""
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("value"))
    return reader.schema("value STRING").load(path)


def file_number(file: Column) -> Column:
    """Log files sort by their number, so the count may outgrow its zero padding. Snapshot rows sort first."""
    return F.coalesce(F.substring_index(file, ".", -1).try_cast("bigint"), F.lit(0).cast("bigint"))


def decode(log: DataFrame, value: str = "value", strict: bool = True) -> DataFrame:
    """R-04: one row per log entry, images as VARIANT (exact decimals), position and origin as columns.

    The parse sits in a one-row generator: through a plain projection Spark would push later filters
    below it and parse each entry once more per condition. In strict mode a row change without database or
    table name fails the job (F-09); the check sits in the generator too, ahead of every filter.
    """
    entry = F.array(F.from_json(value, ENVELOPE).getField("payload"))
    if strict:
        problem = F.raise_error(F.lit("cannot sync a change whose database or table name is unknown"))
        entry = F.transform(entry, lambda p: F.when(_named(p), p).otherwise(problem))
    return log.select(F.inline(entry)).select(
        F.col("source.db").alias("db"),
        F.col("source.table").alias("tbl"),
        "op",
        "before",
        "after",
        F.col("source.schema").alias("src_schema"),
        F.col("source.ts_ms").alias("ts_ms"),
        F.col("source.file").alias("file"),
        file_number(F.col("source.file")).alias("file_no"),
        F.coalesce("source.pos", F.lit(0)).alias("pos"),
        F.coalesce("source.row", F.lit(0)).alias("row"),
        F.col("source.gtid").alias("gtid"),
        F.col("historyRecord").alias("history"),
    )


def _named(payload: Column) -> Column:
    """Row changes need both names; schema changes may concern a whole database."""
    source = payload["source"]
    return payload["historyRecord"].isNotNull() | (source["db"].isNotNull() & source["table"].isNotNull())


def row_changes(decoded: DataFrame) -> DataFrame:
    """Row changes only. Entries without names, which a lenient decode lets through, are left out."""
    named = F.col("db").isNotNull() & F.col("tbl").isNotNull()
    return decoded.where(F.col("history").isNull() & named).drop("history")


def unnamed(decoded: DataFrame) -> DataFrame:
    """F-09: the entries of a lenient decode that a strict one rejects."""
    return decoded.where(F.col("history").isNull() & (F.col("db").isNull() | F.col("tbl").isNull()))


def schema_changes(decoded: DataFrame) -> DataFrame:
    """R-05: one row per column of each changed table, after the change."""
    history = F.from_json("history", HISTORY)
    return (
        decoded.where(F.col("history").isNotNull())
        .select("db", "tbl", "ts_ms", "file_no", "pos", "row", history.alias("h"))
        .select("db", "tbl", "ts_ms", "file_no", "pos", "row", F.col("h.ddl").alias("ddl"), F.inline("h.tableChanges"))
        .select(
            F.coalesce("db", F.regexp_extract("id", r'"([^"]*)"\."', 1)).alias("db"),
            F.coalesce("tbl", F.regexp_extract("id", r'\."([^"]*)"', 1)).alias("tbl"),
            "ts_ms", "file_no", "pos", "row", "ddl",
            F.col("type").alias("change"),
            F.col("table.primaryKeyColumnNames").alias("primary_key"),
            F.inline("table.columns"),
        )
        .select(
            "db", "tbl", "ts_ms", "file_no", "pos", "row", "ddl", "change", "primary_key",
            F.col("name").alias("column"),
            F.coalesce("typeExpression", "typeName").alias("type"),
            "length", "scale", "position",
            F.coalesce("optional", F.lit(True)).alias("nullable"),
            "comment",
        )
    )


def of_sources(database: str, tables: Sequence[str] | None = None) -> Column:
    """R-06: is an entry of the databases and tables that the regexes name? Schema changes of a whole database carry no
    table name and are."""
    keep = whole_match("db", database)
    if tables:
        # One alternation of the distinct patterns: one match per row, however many pairs there are.
        named = "|".join(f"(?:{p})" for p in dict.fromkeys(tables))
        keep = keep & (F.col("tbl").isNull() | whole_match("tbl", named))
    return keep


def source_filter(changes: DataFrame, database: str, tables: Sequence[str] | None = None) -> DataFrame:
    """R-06: keep entries of the databases and tables that the regexes name."""
    return changes.where(of_sources(database, tables))


def watched_filter(decoded: DataFrame, keep: Column, watch: Observation) -> DataFrame:
    """F-08: a filter that tells, from the pass that runs anyway, the names of the tables whose changes it drops."""
    name = F.struct("db", "tbl")
    lost = F.when(~F.col("_keep") & F.col("history").isNull(), name)
    marked = decoded.withColumn("_keep", F.coalesce(keep, F.lit(False))).observe(watch, F.collect_set(lost).alias("dropped"))
    return marked.where("_keep").drop("_keep")
