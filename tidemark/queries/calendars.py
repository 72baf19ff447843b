"""Calendar jobs over order days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import calendar
from tidemark.queries.registry import query, table


def _bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last order day of each priority and status."""
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.min("o_orderdate").cast("date").alias("s"), F.max("o_orderdate").cast("date").alias("e")
    )


BOUNDS = """b AS (SELECT o_orderpriority, o_orderstatus, CAST(min(o_orderdate) AS DATE) AS s,
    CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY o_orderpriority, o_orderstatus)"""


@query("d01_missing_days", """WITH have AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders
        WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'),
      marks AS (SELECT * FROM have UNION ALL SELECT DISTINCT o_custkey, DATE '1995-12-31' FROM orders
                UNION ALL SELECT DISTINCT o_custkey, DATE '1997-01-01' FROM orders),
      pairs AS (SELECT o_custkey, d, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS n FROM marks)
    SELECT o_custkey, CAST(d + 1 AS DATE) AS start_day, CAST(n - 1 AS DATE) AS end_day FROM pairs
    WHERE n - d > 1""")
def d01_missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return calendar.missing_days(orders, "o_orderdate", "1996-01-01", "1996-12-31", by=["o_custkey"])


@query("d01_missing_days_by_status", """WITH days AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
      kinds AS (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders),
      have AS (SELECT DISTINCT o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS d FROM orders),
      miss AS (SELECT * FROM kinds, days EXCEPT SELECT * FROM have),
      isl AS (SELECT *, d - CAST(row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY d) AS INTEGER) AS g FROM miss)
    SELECT o_orderpriority, o_orderstatus, min(d) AS start_day, max(d) AS end_day FROM isl GROUP BY o_orderpriority, o_orderstatus, g""")
def d01_missing_days_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    by = ["o_orderpriority", "o_orderstatus"]
    return calendar.missing_days(orders, "o_orderdate", "1995-01-01", "2001-12-31", by)


@query("d02_days", f"""WITH {BOUNDS}, d AS (SELECT b.*, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
    SELECT o_orderpriority, o_orderstatus, day FROM d""")
def d02_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.days_between(_bounds(spark, sf_dir), "s", "e").select("o_orderpriority", "o_orderstatus", "day")


@query("d03_windows", f"""WITH {BOUNDS}, w AS (SELECT b.*, CAST(unnest(generate_series(s, e, INTERVAL 31 DAY)) AS DATE) AS window_start FROM b)
    SELECT o_orderpriority, o_orderstatus, window_start, CAST(least(window_start + 30, e) AS DATE) AS window_end FROM w""")
def d03_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.windows(_bounds(spark, sf_dir), "s", "e", 30).select(
        "o_orderpriority", "o_orderstatus", "window_start", "window_end"
    )


@query("d04_retention", """SELECT o_orderstatus, count(*) AS kept FROM orders
    WHERE o_orderdate BETWEEN DATE '2000-12-31' - 400 AND DATE '2000-12-31' + 2 GROUP BY o_orderstatus""")
def d04_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("dt", F.date_format("o_orderdate", "yyyy-MM-dd"))
    kept = calendar.retained(orders, "dt", "2000-12-31", 400 * 86_400_000 + 1234, offset_end=2)
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("kept"))


@query("d04_expired_days", """SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt, count(*) AS rows FROM orders
    WHERE o_orderdate < DATE '2000-12-31' - 400 GROUP BY 1""")
def d04_expired_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("dt", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return calendar.expired_days(orders, "dt", "2000-12-31", 400 * 86_400_000)
