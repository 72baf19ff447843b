"""C-11: the schema of every source table over time, and the one that was valid at a change.

A history is kept per ``(db, table)``, so shards of one name do not mix. Versions are intervals of log positions. A change
finds its version by binary search in arrays of positions, first among blocks of its table's versions, then in the block;
the columns of a version are joined where they are asked for. So no task has to hold all changes of a table, and no row
all of its versions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.search import with_count_not_above

#: Versions up to which histories go to every task: some tens of MB. Beyond it they are joined by block.
BROADCAST_VERSIONS = 500_000

#: Versions whose positions are kept in one array.
BLOCK = 1024

DEFINITION = ("column", "type", "length", "scale", "position", "nullable", "comment")


def position() -> Column:
    return F.struct(F.col("file_no").cast("bigint").alias("file_no"), F.col("pos").cast("bigint").alias("pos"), F.col("row").cast("int").alias("row"))


def schema_history(schema_changes: DataFrame) -> DataFrame:
    """One row per version of a source table: ``db``, ``tbl``, ``version`` from 1, the positions ``since`` (included) and
    ``until`` (excluded, NULL for the last), ``primary_key`` and ``columns`` in order. Events that change nothing make no
    version. ``schema_changes`` has a row per column of each changed table."""
    definition = F.struct(F.col("position").alias("position"), *[F.col(c).alias(c) for c in DEFINITION if c != "position"])
    events = schema_changes.groupBy("db", "tbl", position().alias("since")).agg(
        F.first("primary_key").alias("primary_key"), F.array_sort(F.collect_set(definition)).alias("columns"))
    order = Window.partitionBy("db", "tbl").orderBy("since")
    content = F.struct("primary_key", "columns")
    changed = events.withColumn("_same", content.eqNullSafe(F.lag(content).over(order))).where("not _same").drop("_same")
    return changed.select(
        "db", "tbl", F.row_number().over(order).alias("version"), "since", F.lead("since").over(order).alias("until"), "primary_key", "columns")


def with_version(changes: DataFrame, history: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the ``version`` valid at each change, 0 ahead of the first one. ``history`` should be stored: it is counted.

    A change finds its block of BLOCK versions among the first positions of its table's blocks, then its version in it."""
    n = history.count()
    own = history.select(F.col("db").alias("_db"), F.col("tbl").alias("_tbl"), F.expr(f"(version - 1) div {BLOCK} + 1").alias("_own"), "since")
    blocks = own.groupBy("_db", "_tbl", "_own").agg(F.sort_array(F.collect_list("since")).alias("_since"))
    least = own.groupBy("_db", "_tbl", "_own").agg(F.min("since").alias("since"))
    firsts = least.groupBy("_db", "_tbl").agg(F.sort_array(F.collect_list("since")).alias("_firsts"))

    def of_table() -> Column:
        return F.col("db").eqNullSafe(F.col("_db")) & F.col("tbl").eqNullSafe(F.col("_tbl"))

    placed = changes.withColumn("_at", position() if at is None else at).join(F.broadcast(firsts), of_table(), "left").drop("_db", "_tbl")
    placed = with_count_not_above(placed, "_firsts", "_at", n // BLOCK + 1, "_block").drop("_firsts")
    # Changes ahead of all versions meet no block; they are dealt by their position, since a table may have no others.
    key = F.when(F.col("_block") > 0, F.col("_block")).otherwise(-1 - F.pmod(F.xxhash64("_at"), F.lit(1 << 16)))
    placed = placed.withColumn("_key", key)
    joined = placed.join(F.broadcast(blocks) if n <= BROADCAST_VERSIONS else blocks, of_table() & (F.col("_key") == F.col("_own")), "left")
    found = with_count_not_above(joined, "_since", "_at", BLOCK, "_place")
    version = F.when(F.col("_block") > 0, (F.col("_block") - 1) * BLOCK + F.col("_place")).otherwise(0)
    return found.select(*changes.columns, version.alias("version"))


def with_schema(changes: DataFrame, history: DataFrame) -> DataFrame:
    """Add ``version`` and the ``columns`` valid at each change; NULL ahead of the first version."""
    versions = history.select("db", "tbl", "version", "columns")
    if history.count() <= BROADCAST_VERSIONS // 10:  # a version has some tens of columns
        versions = F.broadcast(versions)
    return with_version(changes, history).join(versions, ["db", "tbl", "version"], "left")


def column_changes(history: DataFrame) -> DataFrame:
    """What each version changed in its own table: ``db``, ``tbl``, ``version``, ``since``, ``column``, ``change`` (added,
    dropped or altered), and the definitions before and after. The first version adds all its columns."""
    order = Window.partitionBy("db", "tbl").orderBy("version")
    keyed = {c: F.map_from_entries(F.transform(c, lambda d: F.struct(d["column"], d))) for c in ("columns", "before")}
    both = history.withColumn("before", F.coalesce(F.lag("columns").over(order), F.slice("columns", 1, 0)))
    both = both.select("db", "tbl", "version", "since", keyed["columns"].alias("new"), keyed["before"].alias("old"))
    each = both.select("*", F.explode(F.array_union(F.map_keys("new"), F.map_keys("old"))).alias("column"))
    each = each.select("db", "tbl", "version", "since", "column", F.col("old")[F.col("column")].alias("before"), F.col("new")[F.col("column")].alias("after"))
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "dropped").otherwise("altered")
    # A column that only moves within its table is the same column.
    kept = [c for c in DEFINITION if c not in ("column", "position")]
    same = F.struct(*[F.col("before")[c].alias(c) for c in kept]).eqNullSafe(F.struct(*[F.col("after")[c].alias(c) for c in kept]))
    return each.where(F.col("before").isNull() | F.col("after").isNull() | ~same).withColumn("change", change)
