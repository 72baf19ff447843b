"""R-09 .. R-11: seek in a folder of log files by an index of what each file holds.

The index is a table with a row per file: smallest and largest position and change time, entries, and the span of
transaction numbers per server. A start mode becomes a filter over these rows, and only files that can hold an entry
from the start on are read. Files that the index does not know, or knows under another size or time, are always read, so
an index that lags behind costs time and loses nothing.

Files are listed and indexed by Spark jobs. The driver holds the paths of the files to read, as any file source does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.changelog import file_number
from tidemark.sources.offsets import Start

POSITION = "STRUCT<file_no: BIGINT, pos: BIGINT, row: INT>"
INDEX = (
    f"path STRING, length BIGINT, modified TIMESTAMP, first {POSITION}, last {POSITION}, first_ms BIGINT, last_ms BIGINT,"
    " entries BIGINT, unnumbered BIGINT, servers ARRAY<STRUCT<server: STRING, first: BIGINT, last: BIGINT>>"
)
# Only what the index needs is parsed: no row images.
HEAD = "payload STRUCT<source STRUCT<ts_ms BIGINT, gtid STRING, file STRING, pos BIGINT, `row` INT>>"


class LogIndex:
    """An index, kept at ``path``, over the log files below ``log_path``."""

    def __init__(
        self, spark: SparkSession, path: str, log_path: str, fmt: str = "text", options: Mapping[str, str] | None = None
    ) -> None:
        self.spark, self.path, self.log_path = spark, path.rstrip("/"), log_path
        self.fmt, self.options = fmt, dict(options or {})

    # --- building ---------------------------------------------------------------------------------

    def listing(self) -> DataFrame:
        """``path``, ``length`` and ``modified`` of every log file. No content is read."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.log_path)
        return found.select("path", "length", F.col("modificationTime").alias("modified"))

    def rows(self) -> DataFrame:
        """The index: what was recorded for each state of a file."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(fs_path):
            return self.spark.createDataFrame([], INDEX)
        return self.spark.read.schema(INDEX).parquet(self.path)

    def files(self) -> DataFrame:
        """The log's files as they are now with what the index knows of them, which may be nothing."""
        return self.listing().join(self.rows().dropDuplicates(["path", "length", "modified"]), ["path", "length", "modified"], "left")

    def refresh(self) -> int:
        """Index the files that are new or have changed; gives their number. Repeating it does nothing."""
        new = self.files().where("entries is null").select("path", "length", "modified").collect()
        if not new:
            return 0
        paths = [r["path"] for r in new]
        listed = self.spark.createDataFrame(new, "path STRING, length BIGINT, modified TIMESTAMP")
        found = listed.join(self._spans(self.read(paths)), "path", "left")
        # A file without entries is known too, and never read again.
        found = found.na.fill(0, ["entries", "unnumbered"])
        found.select(*self.rows().columns).write.mode("append").parquet(self.path)
        return len(new)

    def _spans(self, log: DataFrame) -> DataFrame:
        head = F.from_json("value", HEAD).getField("payload").getField("source")
        source = log.select(F.col("_metadata.file_path").alias("path"), F.inline(F.array(head)))
        gtid = F.col("gtid")
        at = F.struct(
            file_number(F.col("file")).alias("file_no"), F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("row", F.lit(0)).alias("row"))
        each = source.select(
            "path", at.alias("at"), "ts_ms", F.substring_index(gtid, ":", 1).alias("server"),
            F.substring_index(gtid, ":", -1).try_cast("bigint").alias("number"))
        numbered = F.col("number").isNotNull()
        per = each.groupBy("path", F.when(numbered, F.col("server")).alias("server")).agg(
            F.min("at").alias("first"), F.max("at").alias("last"), F.min("ts_ms").alias("first_ms"), F.max("ts_ms").alias("last_ms"),
            F.count("*").alias("entries"), F.count_if(~numbered).alias("unnumbered"),
            F.min("number").alias("low"), F.max("number").alias("high"))
        span = F.struct("server", F.col("low").alias("first"), F.col("high").alias("last"))
        return per.groupBy("path").agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"),
            F.sum("entries").alias("entries"), F.sum("unnumbered").alias("unnumbered"),
            F.sort_array(F.collect_list(F.when(F.col("server").isNotNull(), span))).alias("servers"))

    # --- seeking ----------------------------------------------------------------------------------

    def read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], "value STRING")
        return self.spark.read.format(self.fmt).options(**self.options).schema("value STRING").load(paths)

    def candidates(self, start: Start) -> DataFrame:
        """Files that can hold an entry from the start on, or of which nothing is known."""
        return self.files().where(F.col("entries").isNull() | ((F.col("entries") > 0) & start.reaches()))

    def paths(self, start: Start) -> list[str]:
        return sorted(r["path"] for r in self.candidates(start).select("path").collect())

    def log(self, start: Start) -> DataFrame:
        """The log's files from the start on, as a ``value`` column. The entries of these files that lie ahead of the
        start are still in it: the caller filters by ``start.condition()`` as for the whole log."""
        return self.read(self.paths(start))

    def resolve(self, start: Start, select: Callable[[DataFrame], DataFrame]) -> Start:
        """``Start.resolve`` without a pass over the log. ``select`` decodes entries and keeps those that count.

        The latest position stands in the index. To skip events, files are opened in the order of their first position,
        as many as it takes: what is found counts once no unopened file begins before it.
        """
        if start.mode == "latest-offset":
            self.refresh()
            last = self.files().agg(F.max("last").alias("last")).first()["last"]
            if last is None:
                return Start("earliest-offset")
            return Start("latest-offset", file_no=last["file_no"], pos=last["pos"], row=last["row"])
        if start.mode != "specific-offset" or not start.skip_events:
            return start
        self.refresh()
        ahead = self.candidates(start).select("path", "first").orderBy("first", "path").collect()
        opened = 1
        while True:
            log = select(self.read([r["path"] for r in ahead[:opened]]))
            resolved, bound = start.skipped(log)
            beyond = ahead[opened:]
            if not beyond or (bound is not None and bound < (beyond[0]["first"]["file_no"], beyond[0]["first"]["pos"])):
                return resolved
            opened *= 2


def executed_set(changes: DataFrame) -> DataFrame:
    """R-10: the transactions that changes belong to, as ``server``, ``first``, ``last``: maximal runs of numbers.

    Distinct numbers are dealt into blocks of a fixed span. Runs are built within blocks, and only the runs of a block,
    not its numbers, meet in the second window, where runs that touch are joined across blocks.
    """
    gtid = F.col("gtid")
    each = changes.select(
        F.substring_index(gtid, ":", 1).alias("server"), F.substring_index(gtid, ":", -1).try_cast("bigint").alias("first"))
    each = each.where("first is not null").distinct()
    block = F.floor(F.col("first") / BLOCK).alias("block")
    return merged_intervals(runs_of(each.select("server", block, "first", F.col("first").alias("last")), ["server", "block"]))


BLOCK = 1 << 20  # transaction numbers that one window sorts
RESUME_BLOCK = 1 << 14  # transaction numbers of a join key; a run has a row for each block it reaches into


def runs_of(intervals: DataFrame, by: list[str]) -> DataFrame:
    """Intervals that overlap or touch joined into one, within each group of ``by``."""
    order = Window.partitionBy(*by).orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.col("first") > before + 1), 1).otherwise(0)
    run = F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = intervals.withColumn("begins", begins).withColumn("run", run)
    return numbered.groupBy(*by, "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def merged_intervals(intervals: DataFrame) -> DataFrame:
    """A GTID set in its shortest form, of intervals ``server``, ``first``, ``last`` in any order."""
    return runs_of(intervals.select("server", "first", "last"), ["server"])


def gtid_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return merged_intervals(a.select("server", "first", "last").unionByName(b.select("server", "first", "last")))


def gtid_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """The transactions of ``a`` that are not in ``b``, by a sweep over both sets' ends."""
    ends = None
    for sign, s in ((1, a), (-1, b)):
        s = merged_intervals(s)
        for at, step in ((F.col("first"), sign), (F.col("last") + 1, -sign)):
            part = s.select("server", at.alias("at"), F.lit(step if sign > 0 else 0).alias("a"), F.lit(0 if sign > 0 else -step).alias("b"))
            ends = part if ends is None else ends.unionByName(part)
    steps = ends.groupBy("server", "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    order = Window.partitionBy("server").orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = steps.select(
        "server", F.col("at").alias("first"), (F.lead("at").over(order) - 1).alias("last"),
        F.sum("a").over(so_far).alias("in_a"), F.sum("b").over(so_far).alias("in_b"))
    return merged_intervals(swept.where("in_a > 0 and in_b = 0"))


def outside_set(changes: DataFrame, intervals: DataFrame) -> DataFrame:
    """R-10: the changes whose transaction is not in a set, as ``in_gtid_set`` tells for a set written out in the spec.

    Intervals are cut at block borders, so the join has an equal key and a set of any number of runs does."""
    gtid = F.col("gtid")
    keyed = changes.withColumns({"_server": F.substring_index(gtid, ":", 1), "_number": F.substring_index(gtid, ":", -1).try_cast("bigint")})
    keyed = keyed.withColumn("_block", F.floor(F.col("_number") / RESUME_BLOCK))
    cut = intervals.select("server", "first", "last", F.explode(F.expr(f"sequence(first div {RESUME_BLOCK}, last div {RESUME_BLOCK})")).alias("block"))
    hit = (F.col("_server") == F.col("server")) & (F.col("_block") == F.col("block")) & F.col("_number").between(F.col("first"), F.col("last"))
    return keyed.join(cut, hit, "left_anti").drop("_server", "_number", "_block")


def gtid_text(intervals: DataFrame) -> str:
    """A set as text for a start mode: ``server:1-5:8,other:3``. One row per run: a set of a source, not of its rows."""
    one = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat_ws("-", "first", "last"))
    per = merged_intervals(intervals).groupBy("server").agg(F.sort_array(F.collect_list(F.struct("first", one.alias("text")))).alias("runs"))
    rows = per.select("server", F.concat_ws(":", "runs.text").alias("text")).sort("server").collect()
    return ",".join(f"{r['server']}:{r['text']}" for r in rows)
