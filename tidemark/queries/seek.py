"""Start modes by a file index, and sets of executed transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.queries.eventlog import EVENTS_PER_FILE, LOG, SERVER, event_log
from tidemark.queries.log import _per_table, _per_table_sql, changes
from tidemark.queries.registry import query
from tidemark.session import work_dir
from tidemark.sources.changelog import decode, row_changes
from tidemark.sources.offsets import Start
from tidemark.sources.seek import LogIndex, executed_set, gtid_difference, gtid_union, outside_set

DAY = 1705276800000  # 15 January 2024
LATER = 1705708800000  # 20 January 2024
GTIDS = f"{SERVER}:1-1200:1500-1600:2000-900000000,another:1-9999999"


def _write(log: DataFrame, folder: str) -> None:
    """A text file for each log file of the source."""
    parts = log.withColumn("part", F.floor(F.col("event_id") / EVENTS_PER_FILE)).repartition("part")
    parts.select("part", "value").write.mode("append").partitionBy("part").text(folder)


def indexed_log(spark: SparkSession, sf_dir: str) -> LogIndex:
    folder = work_dir(spark, "seek")
    _write(event_log(spark, sf_dir), f"{folder}/log")
    index = LogIndex(spark, f"{folder}/index", f"{folder}/log")
    index.refresh()
    return index


def _from(index: LogIndex, start: Start) -> DataFrame:
    start = index.resolve(start, lambda log: row_changes(decode(log)))
    return row_changes(decode(index.log(start))).where(start.condition())


@query("r09_seek_latest", _per_table_sql("event_id > (SELECT max(event_id) FROM log WHERE ts < TIMESTAMP '2024-01-15')"))
def r09_seek_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest position comes from the index alone; the log goes on after it."""
    folder = work_dir(spark, "seek-latest")
    log = event_log(spark, sf_dir)
    early = F.get_json_object("value", "$.payload.source.ts_ms").cast("bigint") < DAY
    _write(log.where(early), f"{folder}/log")
    index = LogIndex(spark, f"{folder}/index", f"{folder}/log")
    start = index.resolve(Start("latest-offset"), row_changes)
    _write(log.where(~early), f"{folder}/log")
    index.refresh()
    return _per_table(row_changes(decode(index.log(start))).where(start.condition()))


@query("r10_seek_offset", _per_table_sql("file_no > 2 OR (file_no = 2 AND (pos > 104 OR (pos = 104 AND row >= 1)))"))
def r10_seek_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File and position, then four more events and one row skipped, out of the files behind the position."""
    start = Start("specific-offset", file_no=2, pos=100, skip_events=4, skip_rows=1)
    return _per_table(_from(indexed_log(spark, sf_dir), start))


@query("r10_seek_gtid_set", _per_table_sql("NOT (txn BETWEEN 1 AND 1200 OR txn BETWEEN 1500 AND 1600 OR txn >= 2000)"))
def r10_seek_gtid_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_table(_from(indexed_log(spark, sf_dir), Start("specific-offset", gtid_set=GTIDS)))


@query("r11_seek_timestamp", _per_table_sql(f"ts_ms >= {LATER}"))
def r11_seek_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_table(_from(indexed_log(spark, sf_dir), Start("timestamp", timestamp_ms=LATER)))


@query("r11_seek_files", f"""WITH {LOG}
    SELECT file_no, min(pos) AS first_pos, max(pos) AS last_pos, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, count(*) AS entries,
      min(txn) AS first_txn, max(txn) AS last_txn, max(ts_ms) >= {LATER} AS by_time, file_no >= 2 AS by_offset,
      NOT (max(txn) <= 1200 OR (min(txn) >= 1500 AND max(txn) <= 1600) OR (min(txn) >= 2000)) AS by_gtid
    FROM log GROUP BY file_no""")
def r11_seek_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index itself, and which files each kind of start reads."""
    index = indexed_log(spark, sf_dir)
    starts = {
        "by_time": Start("timestamp", timestamp_ms=LATER), "by_offset": Start("specific-offset", file_no=2, pos=4),
        "by_gtid": Start("specific-offset", gtid_set=GTIDS),
    }
    span = F.col("servers")[0]
    return index.files().select(
        F.col("first.file_no").alias("file_no"), F.col("first.pos").alias("first_pos"), F.col("last.pos").alias("last_pos"),
        "first_ms", "last_ms", "entries", span["first"].alias("first_txn"), span["last"].alias("last_txn"),
        *[s.reaches().alias(name) for name, s in starts.items()])


# A third of the transactions, in runs of seven of every twenty-one and one long one.
SOME = "(txn % 21 < 7 OR txn BETWEEN 1000 AND 1400)"
ISLANDS = """SELECT '{server}' AS server, min(txn) AS first, max(txn) AS last FROM (
      SELECT txn, txn - row_number() OVER (ORDER BY txn) AS run FROM (SELECT DISTINCT txn FROM {source})) GROUP BY run"""


def _some(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    every = changes(spark, sf_dir)
    number = F.substring_index("gtid", ":", -1).cast("bigint")
    return every, every.where((number % 21 < 7) | number.between(1000, 1400))


@query("r10_executed_set", f"WITH {LOG}, chosen AS (SELECT * FROM log WHERE {SOME}) " + ISLANDS.format(server=SERVER, source="chosen"))
def r10_executed_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions that a part of the log holds, as the shortest set of intervals."""
    return executed_set(_some(spark, sf_dir)[1])


@query("r10_set_arithmetic", f"""WITH {LOG}, chosen AS (SELECT * FROM log WHERE {SOME}),
    even AS (SELECT * FROM log WHERE txn % 40 < 20),
    both_of AS (SELECT txn FROM chosen UNION SELECT txn FROM even),
    left_of AS (SELECT txn FROM chosen EXCEPT SELECT txn FROM even)
    SELECT 'union' AS op, * FROM ({ISLANDS.format(server=SERVER, source='both_of')})
    UNION ALL SELECT 'difference', * FROM ({ISLANDS.format(server=SERVER, source='left_of')})""")
def r10_set_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, some = _some(spark, sf_dir)
    even = executed_set(every.where(F.substring_index("gtid", ":", -1).cast("bigint") % 40 < 20))
    mine = executed_set(some)
    union = gtid_union(mine, even).select(F.lit("union").alias("op"), "server", "first", "last")
    return union.unionByName(gtid_difference(mine, even).select(F.lit("difference").alias("op"), "server", "first", "last"))


@query("r10_resume_from_set", _per_table_sql(f"NOT {SOME}"))
def r10_resume_from_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that goes on from the set of what has been taken: what was, in whatever order, does not come again."""
    every, some = _some(spark, sf_dir)
    return _per_table(outside_set(every, executed_set(some)))
