"""Filters, routing and reports over the names in the log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import target_name
from tidemark.operators import routing
from tidemark.queries.eventlog import LOG, ROUTES, event_log
from tidemark.queries.log import changes
from tidemark.queries.registry import query
from tidemark.sources.changelog import decode, row_changes, unnamed


def _counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("changes"))


@query("f01_include_exclude", f"""WITH {LOG} SELECT tbl, count(*) AS changes FROM log
    WHERE regexp_full_match(tbl, 'test_.+|other_1') AND NOT regexp_full_match(tbl, '.*2$') GROUP BY tbl""")
def f01_include_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(routing.include_exclude(changes(spark, sf_dir), "test_.+|other_1", ".*2$"), "tbl")


@query("f02_include_except_list", f"""WITH {LOG} SELECT tbl, count(*) AS changes FROM log
    WHERE regexp_full_match(tbl, 'test_.+') AND tbl NOT IN ('test_d_0', 'test_d_3') GROUP BY tbl""")
def f02_include_except_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    barred = [("ods_test", "test_d_0"), ("ods_test", "test_d_3"), ("elsewhere", "test_d_1")]
    return _counts(routing.include_except(changes(spark, sf_dir), "ods_.*", "test_.+", barred), "tbl")


@query("f03_only_listed", f"""WITH {LOG} SELECT tbl, count(*) AS changes FROM log
    WHERE tbl IN ('test_d_2', 'other_0') GROUP BY tbl""")
def f03_only_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = [("ods_test", "test_d_2"), ("ods_test", "other_0")]
    return _counts(routing.only_listed(changes(spark, sf_dir), listed), "tbl")


ROUTE_TABLE = r"""routes AS (SELECT * FROM (VALUES ('test_d_1', 'lake.pt1'), ('test_d_(\d+)$', 'lake.pt_all'),
      ('test_d_(\d+)$', 'lake.pt_all_dt')) r(pattern, target))"""


@query("f07_route_fanout", f"""WITH {LOG}, {ROUTE_TABLE}
    SELECT target, tbl, count(*) AS changes FROM log JOIN routes ON regexp_full_match(tbl, pattern) GROUP BY 1, 2""")
def f07_route_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(routing.route(changes(spark, sf_dir), ROUTES), "target", "tbl")


@query("f06_route_by_name_map", f"""WITH {LOG}, {ROUTE_TABLE}
    SELECT target, tbl, count(*) AS changes FROM log JOIN routes ON regexp_full_match(tbl, pattern) GROUP BY 1, 2""")
def f06_route_by_name_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fan-out as for many routes: patterns run once per distinct source table."""
    return _counts(routing.route(changes(spark, sf_dir), ROUTES, literal_limit=0), "target", "tbl")


@query("f08_quarantine", f"""WITH {LOG} SELECT db, tbl, count(*) AS changes FROM log
    WHERE NOT regexp_full_match(tbl, 'test_d_(\\d+)$') GROUP BY db, tbl""")
def f08_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(routing.unrouted(changes(spark, sf_dir), ROUTES), "db", "tbl")


@query("f09_unnamed_entries", f"""WITH {LOG} SELECT
      CAST(sum(CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS unnamed,
      CAST(sum(CASE WHEN event_id % 13 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS named FROM log""")
def f09_unnamed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some entries lose their table name; they are set apart, the rest goes on."""
    log = event_log(spark, sf_dir)
    hole = F.regexp_replace("value", r'"table":"[^"]*"', '"table":null')
    decoded = decode(log.select(F.when(F.col("event_id") % 13 == 0, hole).otherwise(F.col("value")).alias("value")),
                     strict=False)
    counted = unnamed(decoded).select(F.lit(1).alias("u"), F.lit(0).alias("n")).unionByName(
        row_changes(decoded).select(F.lit(0).alias("u"), F.lit(1).alias("n"))
    )
    return counted.agg(F.sum("u").alias("unnamed"), F.sum("n").alias("named"))


@query("f10_new_tables", f"""WITH {LOG} SELECT DISTINCT db, tbl,
      CASE WHEN tbl = 'test_d_1' THEN 'lake.pt1,lake.pt_all,lake.pt_all_dt'
           WHEN tbl LIKE 'test_d_%' THEN 'lake.pt_all,lake.pt_all_dt' ELSE '' END AS targets
    FROM log WHERE tbl NOT IN (SELECT tbl FROM log WHERE event_id < 2)""")
def f10_new_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that the first two changes did not name, with the targets they will feed."""
    c = changes(spark, sf_dir)
    seen = c.where("file_no = 1 and pos = 4").select("db", "tbl").distinct()
    new = routing.new_tables(c, seen, ROUTES)
    return new.select("db", "tbl", F.concat_ws(",", F.array_sort("targets")).alias("targets"))


@query("f11_target_names", f"""WITH {LOG} SELECT 'ods_' || tbl || '_f' AS merged, 'ods_' || db || '_' || tbl || '_f' AS apart,
      count(*) AS changes FROM log GROUP BY db, tbl""")
def f11_target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = changes(spark, sf_dir).select(
        target_name("ods_", "_f").alias("merged"), target_name("ods_", "_f", merge_shards=False).alias("apart")
    )
    return _counts(named, "merged", "apart")


@query("f12_monitor_report", f"""WITH {LOG}, {ROUTE_TABLE}, names AS (SELECT DISTINCT db, tbl FROM log)
    SELECT db, tbl, target,
      CASE WHEN target IS NULL OR tbl = 'test_d_3' OR target = 'lake.pt1' THEN 'excluded' ELSE 'monitored' END AS status,
      CASE WHEN tbl = 'test_d_3' THEN 'no primary key' WHEN target IS NULL THEN 'no pattern matches'
           WHEN target = 'lake.pt1' THEN 'incompatible schema' END AS reason
    FROM names LEFT JOIN routes ON regexp_full_match(tbl, pattern)""")
def f12_monitor_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = changes(spark, sf_dir).select("db", "tbl").distinct()
    keyless = F.array().cast("array<string>")
    tables = names.withColumn("primary_key", F.when(F.col("tbl") == "test_d_3", keyless).otherwise(F.array(F.lit("k"))))
    return routing.monitor_report(tables, ROUTES, ["lake.pt1"], require_primary_key=True)
