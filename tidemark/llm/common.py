"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import work_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows up to which a side of fixed-width keys is broadcast: some tens of MB. Beyond it the same join shuffles.
BROADCAST_ROWS = 1_000_000


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. ``lower`` does the same on text of ASCII characters only, and faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage in a way that outlives lost executors."""
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a :func:`stored` table when its last reader is done."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Frames made within have their shuffle files deleted when their query ends, and not only when the driver collects
    its garbage. For steps whose results are all :func:`stored`."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def give_back() -> None:
    """Return what a Python worker has freed to the machine: workers wait for later stages with all that they hold."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries keep what they like
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast where the counted rows of ``df`` are few; give ``df`` as it is otherwise."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality of several columns in which NULL equals NULL."""
    return reduce(lambda a, b: a & b, (left[a].eqNullSafe(right[b]) for a, b in pairs))


def running_totals(df: DataFrame, order: list[str], amounts: dict[str, str], name: str) -> DataFrame:
    """Add, for each ``amounts`` item ``new: column``, the sum of ``column`` over all rows before this one, and the
    sum over all rows as ``new_total``.

    Rows are dealt into sorted ranges, so no task sees more than one range; only one row per range meets in one task.
    Rows that are equal in ``order`` come in any order, so end ``order`` with what tells rows apart.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "_tie")
    dealt = stored(dealt.withColumn("_range", F.spark_partition_id()), name)
    sums = dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_{n}_sum") for n, c in amounts.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    every = Window.partitionBy(F.lit(1))
    starts = sums.select(
        F.col("_range"),
        *[F.coalesce(F.sum(f"_{n}_sum").over(before), F.lit(0)).alias(f"_{n}_start") for n in amounts],
        *[F.sum(f"_{n}_sum").over(every).alias(f"{n}_total") for n in amounts],
    )
    inside = Window.partitionBy("_range").orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    joined = dealt.join(F.broadcast(starts), "_range")  # as many rows as shuffle partitions
    return joined.select(
        *df.columns,
        *[(F.col(f"_{n}_start") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in amounts.items()],
        *[F.col(f"{n}_total") for n in amounts],
    )


def components(edges: DataFrame, name: str, a: str = "a", b: str = "b") -> DataFrame:
    """Label connected components: union-find by alternating large-star and small-star rounds.

    Every round hangs nodes below the smallest neighbour known; it is over when each component is a star around its
    smallest node. Returns ``(node, component)`` for every node but the smallest of each component. Self links and
    repeated links are harmless. The minimum of a node is aggregated before the shuffle, so a hub costs little.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = edges.select(u, v).where("u <> v")
    turn = 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = large.where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, stored(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{turn}")
        if turn:
            discard(before)
        turn += 1
        if _are_stars(edges):
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs below one node at most, and none of those hangs itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    per = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return per.where("below > 1 or (below = 1 and above = 1)").isEmpty()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def drop_rows(docs: DataFrame, keys: dict[str, Column], dropped: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``keys`` are in ``dropped``, and one row for each of those in ``repeated``.

    ``keys`` names the key columns of both tables and says how to derive them from a row of ``docs``; NULL equals NULL.
    Texts move only where these tables are too large to broadcast.
    """
    marked = docs.select(*[docs[c] for c in docs.columns], *[e.alias(f"_key_{k}") for k, e in keys.items()])
    pairs = [(f"_key_{k}", k) for k in keys]
    kept = marked.join(small(dropped), null_safe(marked, dropped, pairs), "left_anti")
    if again := repeated.count():
        on = null_safe(kept, repeated, pairs)
        many = kept.join(small(repeated, again), on, "left_semi")
        once = many.groupBy(*[p for p, _ in pairs]).agg(F.first(F.struct(*docs.columns)).alias("_row")).select("_row.*")
        return kept.join(small(repeated, again), on, "left_anti").select(*docs.columns).unionByName(once)
    return kept.select(*docs.columns)
