"""Calendar jobs over day partitions: gaps, day tasks, backfill windows, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _day(value: str | Column) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("date")


def days_between(bounds: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """D-02: one row per day of each ``[start, end]``, both ends included; nothing when start is after end."""
    s, e = F.col(start).cast("date"), F.col(end).cast("date")
    days = F.when(s <= e, F.sequence(s, e, F.expr("interval 1 day")))
    return bounds.withColumn(name, F.explode(days))


def missing_days(
    days: DataFrame, day: str, start: str | Column, end: str | Column, by: Sequence[str] = ()
) -> DataFrame:
    """D-01: ranges of days in ``[start, end]`` that have no row, per group.

    Works on distinct days and finds gaps between neighbours, so the work after the first aggregation
    grows with days per group, not rows, and no calendar is built.
    """
    lo, hi = _day(start), _day(end)
    have = (
        days.select(*by, F.col(day).cast("date").alias("_day")).where(F.col("_day").between(lo, hi)).distinct()
    )
    groups = days.select(*by).distinct() if by else days.sparkSession.range(1).select()
    edges = groups.where(lo <= hi).select(*by, F.explode(F.array(F.date_sub(lo, 1), F.date_add(hi, 1))).alias("_day"))
    marks = have.unionByName(edges)
    w = Window.partitionBy(*by).orderBy("_day")
    gaps = marks.withColumn("_next", F.lead("_day").over(w)).where(F.datediff("_next", "_day") > 1)
    return gaps.select(
        *by, F.date_add("_day", 1).alias("start_day"), F.date_sub("_next", 1).alias("end_day")
    )


def windows(bounds: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """D-03: backfill windows ``[s, s + days]``, both ends included; the next starts one day later and the
    last is cut at the end."""
    if days < 0:
        raise ValueError("window length must not be negative")
    s, e = F.col(start).cast("date"), F.col(end).cast("date")
    starts = F.when(s <= e, F.sequence(s, e, F.expr(f"interval {days + 1} days")))
    return bounds.withColumn("window_start", F.explode(starts)).withColumn(
        "window_end", F.least(F.date_add("window_start", days), e)
    )


def retention_range(today: str | Column, ttl_ms: int, offset_end: int = 0) -> tuple[Column, Column]:
    """D-04: first and last day that a time-to-live keeps; part days are cut toward zero."""
    days = int(ttl_ms / 86_400_000)
    return F.date_sub(_day(today), days), F.date_add(_day(today), offset_end)


def retained(df: DataFrame, day: str, today: str | Column, ttl_ms: int, offset_end: int = 0) -> DataFrame:
    """D-04 as a filter on a day column. The bounds fold to literals of its type, so day partitions are pruned."""
    kind = df.schema[day].dataType
    first, last = (bound.cast(kind) for bound in retention_range(today, ttl_ms, offset_end))
    return df.where(F.col(day).between(first, last))


def expired_days(df: DataFrame, day: str, today: str | Column, ttl_ms: int) -> DataFrame:
    """D-04: days that fall out of retention, with their row counts."""
    first, _ = retention_range(today, ttl_ms)
    return df.where(F.col(day).cast("date") < first).groupBy(day).agg(F.count(F.lit(1)).alias("rows"))
