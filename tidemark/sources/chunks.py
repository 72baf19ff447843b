"""R-13: chunks of a snapshot with about equal row counts, whatever the key's type and spread.

A sketch of the key is the sample of all keys whose hash falls below a threshold. It merges by union, needs no shuffle
and is the same however the rows are dealt. Its order statistics are the bounds of the chunks, so a sparse or skewed key
gives no empty and no huge chunks. A key value that repeats lies in one chunk with all its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.search import with_count_not_above
from tidemark.session import work_dir

SAMPLES = 64  # expected sample keys of a chunk: sizes then vary by an eighth, and hardly ever double
MOST_CHUNKS = 1_000_000  # bounds that go to every task, or to the driver as predicates


def key_hash(key: Column) -> Column:
    """32 bits of the key's text, the same in every engine that has MD5."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")


def key_sketch(table: DataFrame, key: str, split_size: int, samples: int = SAMPLES) -> DataFrame:
    """The sample of a table's keys, in column ``key``: all keys where chunks are smaller than ``samples`` rows."""
    if split_size < 1:
        raise ValueError("split size must be positive")
    keys = table.select(F.col(key).alias("key")).where(F.col("key").isNotNull())
    return keys if split_size <= samples else keys.where(key_hash(F.col("key")) % split_size < samples)


def ordered_places(rows: DataFrame, by: str) -> DataFrame:
    """Add ``place``, the number of rows ahead in the order of ``by``. Rows are dealt into sorted ranges; only one row per
    range meets in one task."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = rows.repartitionByRange(parts, by).withColumn("_range", F.spark_partition_id())
    path = work_dir(spark, "places")
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_range").agg(F.count("*").alias("n"))
    counts = counts.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_ahead"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(by)) - 1
    joined = dealt.join(F.broadcast(counts), "_range")  # as many rows as shuffle partitions
    return joined.select(*rows.columns, (F.col("_ahead") + inside).alias("place"))


def chunk_bounds(sketch: DataFrame, split_size: int, samples: int = SAMPLES) -> DataFrame:
    """``chunk`` from 0, its ``first`` key and the ``last`` key that is no longer in it. The first chunk has no first key
    and the last one no last key, so chunks cover keys that came after the sketch, and NULL."""
    every = split_size if split_size <= samples else samples
    cuts = ordered_places(sketch, "key").where((F.col("place") % every == 0) & (F.col("place") > 0))
    cuts = cuts.select("key").distinct()  # a key that fills several chunks is one cut
    cuts = ordered_places(cuts, "key")
    first = cuts.select((F.col("place") + 1).alias("chunk"), F.col("key").alias("first"))
    last = cuts.select(F.col("place").alias("chunk"), F.col("key").alias("last"))
    both = first.join(last, "chunk", "full")
    return both if not both.isEmpty() else _one_chunk(sketch)


def _one_chunk(sketch: DataFrame) -> DataFrame:
    kind = sketch.schema["key"].dataType
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("first", kind), T.StructField("last", kind)])
    return sketch.sparkSession.createDataFrame([(0, None, None)], schema)


def _few(bounds: DataFrame) -> int:
    """The number of bounds, which must not be too many."""
    if (n := bounds.count()) > MOST_CHUNKS:
        raise ValueError(f"{n} chunks; choose a larger split size, for {MOST_CHUNKS} chunks at most")
    return n


def with_chunk(rows: DataFrame, key: Column, bounds: DataFrame, *others: str) -> DataFrame:
    """Add ``chunk`` and other columns of ``bounds`` to rows, by binary search in the sorted first keys."""
    n = _few(bounds)
    entry = F.struct("chunk", "first", *others)
    table = bounds.agg(F.sort_array(F.collect_list(entry)).alias("_bounds"))  # one row
    firsts = F.transform(F.slice("_bounds", 2, F.greatest(F.size("_bounds") - 1, F.lit(0))), lambda b: b["first"])
    table = F.broadcast(table.select("_bounds", firsts.alias("_firsts")))
    found = with_count_not_above(rows.withColumn("_key", key).join(table, F.lit(True)), "_firsts", "_key", n, "_place")
    found = found.withColumn("_place", F.coalesce("_place", F.lit(0)))
    hit = F.get("_bounds", F.col("_place"))
    return found.select(*rows.columns, F.col("_place").cast("bigint").alias("chunk"), *[hit[c].alias(c) for c in others])


def literal(value: object) -> str:
    """A key value in SQL."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(value)
    if isinstance(value, bytes):
        return f"x'{value.hex()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "''") + "'"


def predicates(bounds: DataFrame, key: str) -> list[str]:
    """A condition per chunk, which together take every row once. ``key`` is the column as the database compares it in
    the order that Spark has, such as ``BINARY name`` for text under a collation that ignores case."""
    out = []
    _few(bounds)
    for r in bounds.sort("chunk").collect():
        terms = [f"{key} >= {literal(r['first'])}"] * (r["first"] is not None) + [f"{key} < {literal(r['last'])}"] * (r["last"] is not None)
        text = " AND ".join(terms) or "1 = 1"
        out.append(f"({text}) OR {key} IS NULL" if r["first"] is None and terms else text)
    return out


def read_chunks_jdbc(
    spark: SparkSession, url: str, table: str, key: str, split_size: int, properties: Mapping[str, str], compared: str | None = None
) -> DataFrame:
    """A snapshot over JDBC with a partition per chunk. The sketch is taken in the database, by its own CRC32."""
    low = f" WHERE CRC32({key}) % {split_size} < {SAMPLES}" if split_size > SAMPLES else f" WHERE {key} IS NOT NULL"
    reader = spark.read.format("jdbc").options(url=url, **properties)
    sketch = reader.option("query", f"SELECT {key} AS `key` FROM {table}{low}").load()
    parts = predicates(chunk_bounds(sketch, split_size), compared or key)
    return spark.read.jdbc(url, table, predicates=parts, properties=dict(properties))


def chunk_counts(table: DataFrame, key: str, split_size: int) -> DataFrame:
    """Chunks of a table with the first and last key that is in each, and their row counts."""
    bounds = chunk_bounds(key_sketch(table, key, split_size), split_size)
    dealt = with_chunk(table.select(F.col(key).alias("key")), F.col("key"), bounds)
    return dealt.groupBy("chunk").agg(F.min("key").alias("first_key"), F.max("key").alias("last_key"), F.count(F.lit(1)).alias("rows"))


# --- chunks read while the log goes on ------------------------------------------------------------

POSITION = "STRUCT<file_no: BIGINT, pos: BIGINT, row: INT>"


def read_waves(
    spark: SparkSession,
    bounds: DataFrame,
    read: Callable[[Sequence[tuple]], DataFrame],
    position: Callable[[], tuple[int, int, int]],
    folder: str,
    wave: int = 64,
) -> DataFrame:
    """R-07: read chunks while the source changes, ``wave`` of them in one job, and note the log's position around each.

    ``read`` gives the rows of chunks, listed as ``(chunk, first, last)``; ``position`` the log's last position. Rows are
    written below ``folder`` ahead of the second look at the position. A wave that is written and marked is not read
    again after a restart. Gives the marks: ``bounds`` with ``low`` and ``high``; :func:`wave_rows` has the rows.
    """
    _few(bounds)
    chunks = [(r["chunk"], r["first"], r["last"]) for r in bounds.sort("chunk").collect()]
    done = _marks(spark, folder)
    known = {r["chunk"] for r in done.select("chunk").collect()}
    schema = f"chunk BIGINT, low {POSITION}, high {POSITION}"
    for k in range(0, len(chunks), wave):
        part = [c for c in chunks[k:k + wave] if c[0] not in known]
        if part:
            low = position()
            read(part).write.mode("overwrite").parquet(f"{folder}/rows/wave={part[0][0]}")
            high = position()
            marks = spark.createDataFrame([(c[0], low, high) for c in part], schema)
            marks.coalesce(1).write.mode("append").parquet(f"{folder}/marks")
    return bounds.join(_marks(spark, folder), "chunk")


def _marks(spark: SparkSession, folder: str) -> DataFrame:
    schema = f"chunk BIGINT, low {POSITION}, high {POSITION}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/marks")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/marks")


def wave_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/rows").drop("wave")


def _at(c: str = "") -> Column:
    return F.struct(F.col(f"{c}file_no").cast("bigint").alias("file_no"), F.col(f"{c}pos").cast("bigint").alias("pos"), F.col(f"{c}row").cast("int").alias("row"))


def stitch(snapshot: DataFrame, changes: DataFrame, snapshot_key: Column, change_key: Column, marks: DataFrame) -> DataFrame:
    """R-07: chunks and log as one run of changes without a gap or an overlap.

    ``snapshot`` holds rows as changes (op ``r``), read at any time between the marks of their chunk; ``changes`` the log
    from the least low mark on. Rows of a chunk take its low position; changes of a chunk count from its low mark on,
    since what is older is in the rows already. So whatever follows in the log, the last change of a key is its state, and
    at the chunk's high mark the chunk is as the source was at that moment. Marks come with ``first``, ``low`` and ``high``.
    """
    base = with_chunk(snapshot, snapshot_key, marks, "low", "high")
    # Behind the change at the low mark itself, which the rows already show.
    base = base.withColumns({"file_no": F.col("low.file_no"), "pos": F.col("low.pos"), "row": F.lit(2**31 - 1)})
    later = with_chunk(changes, change_key, marks, "low", "high").where(_at() > F.col("low"))
    return base.unionByName(later)


def up_to_high(stitched: DataFrame) -> DataFrame:
    """Of stitched changes those that bring every chunk to its high mark; the rest of the log goes on from there."""
    return stitched.where((F.col("op") == "r") | (_at() <= F.col("high")))


def beyond_high(stitched: DataFrame) -> DataFrame:
    return stitched.where((F.col("op") != "r") & (_at() > F.col("high")))


def require_covered(marks: DataFrame, last: tuple[int, int, int] | None) -> None:
    """The log must reach the highest mark, or chunks are left between two states."""
    high = marks.agg(F.max("high").alias("high")).first()["high"]
    if high is not None and (last is None or tuple(high) > tuple(last)):
        raise ValueError(f"the log ends at {last}, before the last mark {tuple(high)} of the snapshot")
