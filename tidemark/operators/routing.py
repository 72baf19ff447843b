"""Route source tables to targets by regular expression."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import present

# Above this many routes a row is not tested against each regex; the distinct names are.
LITERAL_ROUTES = 32
# A map of at most this many (table, target) rows is small enough for every executor.
MAP_ROWS = 20_000


@dataclass(frozen=True)
class Route:
    """One source pattern and the target it feeds. Database and table patterns match apart."""

    database: str
    table: str
    target: str

    def matches(self, db: Column | str = "db", tbl: Column | str = "tbl") -> Column:
        return whole_match(db, self.database) & whole_match(tbl, self.table)


def whole_match(text: Column | str, pattern: str) -> Column:
    r"""The regex must match the whole text; ``^..$`` would also take a trailing newline."""
    column = F.col(text) if isinstance(text, str) else text
    return column.rlike(rf"\A(?:{pattern})\z")


def include_exclude(df: DataFrame, include: str | None = None, exclude: str | None = None, tbl: str = "tbl") -> DataFrame:
    """F-01: keep tables whose name matches ``include`` and not ``exclude``; an unknown name stays."""
    keep = F.lit(True)
    if include is not None:
        keep = keep & whole_match(tbl, include)
    if exclude is not None:
        keep = keep & ~whole_match(tbl, exclude)
    return df.where(F.col(tbl).isNull() | keep)


def _names(tables: Sequence[tuple[str, str]]) -> Column:
    found = F.lit(False)
    by_db: dict[str, list[str]] = {}
    for db, tbl in tables:
        by_db.setdefault(db, []).append(tbl)
    for db, tbls in by_db.items():
        found = found | ((F.col("db") == db) & F.col("tbl").isin(tbls))
    return found


def include_except(df: DataFrame, database: str, include: str, excluded: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """F-02: tables of matching databases and names, but for a list of exact names."""
    return df.where(whole_match("db", database) & whole_match("tbl", include) & ~_names(excluded))


def only_listed(df: DataFrame, tables: Sequence[tuple[str, str]]) -> DataFrame:
    """F-03: only the exact tables of a list."""
    return df.where(_names(tables))


def table_list_regex(database: str, include: str, excluded: Sequence[tuple[str, str]] = ()) -> str:
    """F-02 as one regex over ``db.table``, for sources that take a regex only."""
    wanted = rf"(?:{database})\.(?:{include})"
    if not excluded:
        return wanted
    barred = "|".join(rf"{re.escape(d)}\.{re.escape(t)}$" for d, t in excluded)
    return f"(?!{barred}){wanted}"


def listed_regex(tables: Sequence[tuple[str, str]]) -> str:
    """F-03 as one regex over ``db.table``."""
    return "|".join(rf"{re.escape(d)}\.{re.escape(t)}" for d, t in tables)


def matched_targets(routes: Sequence[Route], db: Column | str = "db", tbl: Column | str = "tbl") -> Column:
    """F-05..F-07: array of the targets of a source name, each once however many patterns lead to it."""
    hits = [F.when(r.matches(db, tbl), F.lit(r.target)) for r in routes]
    return F.array_distinct(F.array_compact(F.array(*hits)))


def route(
    changes: DataFrame, routes: Sequence[Route], literal_limit: int = LITERAL_ROUTES, map_limit: int = MAP_ROWS
) -> DataFrame:
    """F-07: a copy of each change per target, in column ``target``.

    A few routes are literal regexes in the row projection. Many routes are resolved once per distinct source
    table: the names are counted first, and only a map within ``map_limit`` rows is broadcast. A larger one joins
    as Spark sees fit, with skewed tables split at run time.
    """
    if len(routes) <= literal_limit:
        return changes.select("*", F.explode(matched_targets(routes)).alias("target"))
    names = changes.select("db", "tbl").distinct()
    table_map = names.select("db", "tbl", F.explode(matched_targets(routes)).alias("target"))
    rows = table_map.limit(map_limit + 1).collect()
    if len(rows) <= map_limit:
        small = changes.sparkSession.createDataFrame(rows, "db string, tbl string, target string")
        return changes.join(F.broadcast(small), ["db", "tbl"])
    return changes.join(table_map, ["db", "tbl"])


def require_routed(changes: DataFrame, routes: Sequence[Route]) -> DataFrame:
    """F-08, strict: a change that no route takes fails the job."""
    matched = F.lit(False)
    for r in routes:
        matched = matched | r.matches()
    message = F.concat(F.lit("cannot find a target for table "), F.concat_ws(".", "db", "tbl"))
    # In a generator, so that no later filter or pruning can drop the check.
    row = F.when(matched, F.struct("*")).otherwise(F.raise_error(message))
    return changes.select(F.inline(F.array(row)))


def unrouted(changes: DataFrame, routes: Sequence[Route]) -> DataFrame:
    """F-08, lenient: the changes that no route takes, for a quarantine table."""
    matched = F.lit(False)
    for r in routes:
        matched = matched | r.matches()
    return changes.where(~matched | F.col("db").isNull() | F.col("tbl").isNull())


def new_tables(changes: DataFrame, seen: DataFrame, routes: Sequence[Route]) -> DataFrame:
    """F-10: source tables not seen before, with their targets (empty if not routable). Needs a row image."""
    names = changes.where(present("after") | present("before")).select("db", "tbl").distinct()
    return names.join(seen.select("db", "tbl"), ["db", "tbl"], "left_anti").withColumn(
        "targets", matched_targets(routes)
    )


def monitor_report(
    tables: DataFrame, routes: Sequence[Route], incompatible: Sequence[str] = (), require_primary_key: bool = False
) -> DataFrame:
    """F-12, F-14: each source table with its targets, and whether it is synced.

    ``tables`` has ``db, tbl`` and, for the primary-key rule, ``primary_key``. Targets named in
    ``incompatible`` do not sync.
    """
    target = F.explode_outer(matched_targets(routes)).alias("target")
    out = tables.select("*", target)
    reason = F.when(F.col("target").isNull(), "no pattern matches")
    if require_primary_key:
        reason = F.when(F.size("primary_key") < 1, "no primary key").otherwise(reason)
    if incompatible:
        reason = F.coalesce(reason, F.when(F.col("target").isin(list(incompatible)), "incompatible schema"))
    return out.select(
        "db", "tbl", "target",
        F.when(reason.isNull(), "monitored").otherwise("excluded").alias("status"),
        reason.alias("reason"),
    )


def check_routes(report: DataFrame, routes: Sequence[Route]) -> None:
    """F-13: every route needs a source table at start, and something must be left to sync."""
    rows = report.agg(
        F.count_if(F.col("status") == "monitored").alias("monitored"),
        *[F.count_if(r.matches()).alias(f"r{i}") for i, r in enumerate(routes)],
    ).first()
    for i, r in enumerate(routes):
        if not rows[f"r{i}"]:
            raise ValueError(f"no source table matches {r.database}.{r.table}")
    if not rows["monitored"]:
        raise ValueError("no tables to sync: every source table is excluded, see the report")
