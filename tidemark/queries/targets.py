"""Current state, stored targets and streaming runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.routing import whole_match
from tidemark.operators.row_kinds import current_state, to_row_kinds
from tidemark.operators.schema import Field, TableSchema
from tidemark.operators.targets import ON_READ, ON_WRITE, Target
from tidemark.plans.spec import parse_spec
from tidemark.plans.sync import SyncPlan
from tidemark.queries.eventlog import EVENTS_PER_FILE, LIVE, LOG, ROUTES, event_log, projection, schema
from tidemark.queries.log import changes
from tidemark.queries.registry import query, table
from tidemark.session import work_dir
from tidemark.sources.changelog import decode, read_log_stream, row_changes
from tidemark.streaming.job import start_divided, start_new_tables, start_sync

TABLES = ("test_d_0", "test_d_1", "test_d_2", "test_d_3")

PT_ALL = f"""WITH {LOG}, {LIVE} SELECT k, v1, val FROM live WHERE tbl LIKE 'test_d_%'"""
PT_ALL_DT = f"""WITH {LOG}, {LIVE} SELECT k, v1, val, dt FROM live WHERE tbl LIKE 'test_d_%'"""


def spec(warehouse: str, start: dict[str, str] | None = None) -> str:
    """A pipeline spec: one table to its own target, all of them to one, and to one by day."""
    pair = {"srcDatabasePattern": "ods_test", "tgtDatabase": "lake", "pkList": ["k"]}
    every = r"test_d_(\d+)$"
    return json.dumps({
        "sourceConfig": start or {"scan.startup.mode": "earliest-offset"},
        "catalogConfig": {"warehouse": warehouse},
        "metaColumnTypeToTargetColName": {"FULL_TABLE_NAME": "src_tbl"},
        "dataPairList": [
            {**pair, "srcTablePattern": "test_d_1", "tgtTable": "pt1"},
            {**pair, "srcTablePattern": every, "tgtTable": "pt_all"},
            {**pair, "srcTablePattern": every, "tgtTable": "pt_all_dt", "dtColumns": ["add_time"]},
        ],
    })


def plan(spark: SparkSession, folder: str, start: dict[str, str] | None = None, **settings) -> SyncPlan:
    pipeline = parse_spec(spec(f"{folder}/lake", start))
    sources = {("ods_test", t): schema() for t in TABLES}
    return SyncPlan.prepare(spark, pipeline, sources, create_missing=True, buckets=2, **settings)


def _per_target(sync: SyncPlan) -> DataFrame:
    out = None
    for name, target in sorted(sync.targets.items()):
        one = target.read().agg(
            F.lit(name).alias("target"), F.count(F.lit(1)).alias("rows"), F.sum("k").alias("keys"),
            F.count_distinct("src_tbl").alias("sources"), F.sum(F.col("val").cast("decimal(18,2)")).cast("double").alias("total"),
        )
        out = one if out is None else out.unionByName(one)
    return out


PER_TARGET = f"""WITH {LOG}, {LIVE}, t AS (
      SELECT 'lake.pt1' AS target, * FROM live WHERE tbl = 'test_d_1'
      UNION ALL SELECT 'lake.pt_all', * FROM live WHERE tbl LIKE 'test_d_%'
      UNION ALL SELECT 'lake.pt_all_dt', * FROM live WHERE tbl LIKE 'test_d_%')
    SELECT target, count(*) AS rows, CAST(sum(k) AS BIGINT) AS keys, count(DISTINCT tbl) AS sources,
      CAST(sum(CAST(val AS DECIMAL(18,2))) AS DOUBLE) AS total FROM t GROUP BY target"""


def slices(log: DataFrame, parts: int) -> list[DataFrame]:
    """The log cut into consecutive parts by event id."""
    last = log.agg(F.max("event_id")).first()[0] or 0
    step = last // parts + 1
    return [log.where((F.col("event_id") >= i * step) & (F.col("event_id") < (i + 1) * step)) for i in range(parts)]


def _only_all(c: DataFrame) -> DataFrame:
    return c.where(ROUTES[1].matches())


@query("w13_current_state", PT_ALL)
def w13_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_row_kinds(_only_all(changes(spark, sf_dir)), projection())
    return current_state(rows, ["k"]).select("k", "v1", "val")


@query("w13_current_state_by_day", PT_ALL_DT)
def w13_current_state_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed by day and key: without the delete halves of updates, old days would keep stale rows."""
    rows = to_row_kinds(_only_all(changes(spark, sf_dir, "full")), projection(day=True))
    return current_state(rows, ["dt", "k"]).select("k", "v1", "val", "dt")


@query("w01_upsert_batches", PT_ALL)
def w01_upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = Target(spark, work_dir(spark, "w01")).create(schema(), buckets=8, merge=ON_READ)
    for number, part in enumerate(slices(event_log(spark, sf_dir), 3)):
        target.upsert(to_row_kinds(_only_all(row_changes(decode(part))), projection()), ("w01", number))
    return target.read().select("k", "v1", "val")


@query("w02_fanout_write", PER_TARGET)
def w02_fanout_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log into three targets."""
    sync = plan(spark, work_dir(spark, "w02"))
    sync.run_batch(event_log(spark, sf_dir, "full"))
    return _per_target(sync)


@query("w01_two_runs", PER_TARGET)
def w01_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batch runs without numbers: both count."""
    sync = plan(spark, work_dir(spark, "w01-runs"))
    for part in slices(event_log(spark, sf_dir, "full"), 2):
        sync.run_batch(part)
    return _per_target(sync)


@query("r11_spec_timestamp", f"""WITH {LOG}, live AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY event_id DESC) AS rn FROM log WHERE ts_ms >= 1705708800000)
      WHERE rn = 1 AND NOT gone)
    SELECT k, v1, val FROM live WHERE tbl LIKE 'test_d_%'""")
def r11_spec_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The start mode that stands in the spec, without any given to the run."""
    mode = {"scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": "1705708800000"}
    sync = plan(spark, work_dir(spark, "r11"), start=mode)
    return sync.state(event_log(spark, sf_dir, "full"), "lake.pt_all").select("k", "v1", "val")


@query("w04_bucket_layout", f"""WITH {LOG}, {LIVE} SELECT 'lake.pt_all_dt' AS target, count(*) AS rows,
      CAST(0 AS BIGINT) AS misplaced FROM live WHERE tbl LIKE 'test_d_%'""")
def w04_bucket_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored row lies in the bucket of its key."""
    target = Target(spark, work_dir(spark, "w04")).create(schema(day=True), buckets=4, day="dt")
    target.upsert(to_row_kinds(_only_all(changes(spark, sf_dir, "full")), projection(day=True)))
    return target.placement().agg(
        F.lit("lake.pt_all_dt").alias("target"), F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("in_place")).alias("misplaced"),
    )


@query("w07_partition_move", PT_ALL_DT)
def w07_partition_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored by day, in two batches: a row whose time changes leaves its old day."""
    folder = work_dir(spark, "w07")
    target = Target(spark, f"{folder}/target").create(schema(day=True), buckets=2, day="dt", merge=ON_READ)
    event_log(spark, sf_dir, "full").write.parquet(f"{folder}/log")
    for number, part in enumerate(slices(spark.read.parquet(f"{folder}/log"), 2)):
        target.upsert(to_row_kinds(_only_all(row_changes(decode(part))), projection(day=True)), ("w07", number))
    return target.read().select("k", "v1", "val", "dt")


@query("w07_move_without_before_image", PT_ALL_DT)
def w07_move_without_before_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log has keys only in its before images: a key's rows of all days are merged, and the latest one's day holds."""
    target = Target(spark, work_dir(spark, "w07k")).create(schema(day=True), buckets=2, day="dt", merge=ON_READ)
    for number, part in enumerate(slices(event_log(spark, sf_dir), 2)):
        rows = to_row_kinds(_only_all(row_changes(decode(part))), projection(day=True))
        target.upsert(rows, ("w07k", number), locate_moves=True)
    return target.read().select("k", "v1", "val", "dt")


@query("w01_merge_on_write", PT_ALL_DT)
def w01_merge_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that rewrite the cells they touch, and look up the old day of a key in the target."""
    target = Target(spark, work_dir(spark, "w01w")).create(schema(day=True), buckets=2, day="dt", merge=ON_WRITE)
    for number, part in enumerate(slices(event_log(spark, sf_dir), 2)):
        rows = to_row_kinds(_only_all(row_changes(decode(part))), projection(day=True))
        target.upsert(rows, ("w01w", number), locate_moves=True)
    return target.read().select("k", "v1", "val", "dt")


@query("w12_folded_read", PT_ALL_DT)
def w12_folded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, folded into one write after the second: readers see the same rows."""
    target = Target(spark, work_dir(spark, "w12")).create(schema(day=True), buckets=2, day="dt", merge=ON_READ)
    for number, part in enumerate(slices(event_log(spark, sf_dir, "full"), 3)):
        target.upsert(to_row_kinds(_only_all(row_changes(decode(part))), projection(day=True)), ("w12", number))
        if number == 1:
            target.fold()
    return target.read().select("k", "v1", "val", "dt")


@query("w08_replayed_batch", PT_ALL)
def w08_replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is delivered twice counts once, even when it comes after a later one."""
    target = Target(spark, work_dir(spark, "w08")).create(schema(), buckets=4, merge=ON_READ)
    first, second = slices(event_log(spark, sf_dir), 2)
    for number, part in ((0, first), (1, second), (0, first)):
        target.upsert(to_row_kinds(_only_all(row_changes(decode(part))), projection()), ("w08", number))
    return target.read().select("k", "v1", "val")


@query("t05_late_changes", PT_ALL)
def t05_late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches out of order: the target keeps positions and ignores changes older than what it holds."""
    target = Target(spark, work_dir(spark, "t05")).create(schema(), buckets=4, keep_positions=True, merge=ON_READ)
    for part in reversed(slices(event_log(spark, sf_dir), 3)):
        target.upsert(to_row_kinds(_only_all(row_changes(decode(part))), projection()))
    return target.read().select("k", "v1", "val")


@query("t05_bounded_memory", f"""WITH {LOG}, cut AS (SELECT max(event_id) AS last FROM log),
    last_of AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY event_id DESC) AS rn FROM log WHERE tbl LIKE 'test_d_%') WHERE rn = 1)
    SELECT k, CASE WHEN NOT gone THEN v1 END AS v1, gone AS deleted FROM last_of, cut
    WHERE NOT gone OR file_no > 1 + (last // 2) // 4000 OR (file_no = 1 + (last // 2) // 4000 AND pos >= 4 + ((last // 2) % 4000) // 2)""")
def t05_bounded_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A horizon at the middle of the log: deletes older than it are forgotten, and changes older than it that come once
    more do nothing, so deleted rows stay deleted."""
    log = event_log(spark, sf_dir)
    target = Target(spark, work_dir(spark, "t05h")).create(schema(), buckets=4, keep_positions=True, merge=ON_READ)
    parts = slices(log, 4)

    def apply(part: DataFrame) -> None:
        target.upsert(to_row_kinds(_only_all(row_changes(decode(part))), projection()))

    for k in (0, 2, 1, 3):
        apply(parts[k])
    middle = (log.agg(F.max("event_id")).first()[0] or 0) // 2
    target.fold(horizon=(1 + middle // EVENTS_PER_FILE, 4 + middle % EVENTS_PER_FILE // 2))
    apply(parts[0])  # far too late
    apply(parts[3])  # late but within the horizon
    alive = target.read().select("k", "v1", F.lit(False).alias("deleted"))
    return alive.unionByName(target.deletes().select("k", F.lit(None).cast("string").alias("v1"), F.lit(True).alias("deleted")))


@query("c09_evolved_read", f"""WITH {LOG}, {LIVE}, cut AS (SELECT max(event_id) * 95 // 100 AS c FROM log)
    SELECT k, v1, val, CASE WHEN event_id > c THEN v1 || '_x' END AS v3, CASE WHEN event_id > c THEN k * 3000000000 END AS n
    FROM live, cut WHERE tbl LIKE 'test_d_%'""")
def c09_evolved_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column is added and another widened late in the log; old rows read NULL, old files are not rewritten."""
    ev = table(spark, sf_dir, "events")
    cut = (ev.agg(F.max("event_id")).first()[0] or 0) * 95 // 100
    log = event_log(spark, sf_dir)
    late = F.col("event_id") > cut
    text = F.regexp_replace("value", r'"v1":"([a-z]*)"', r'"v1":"$1","v3":"$1_x"')
    k = F.regexp_extract("value", r'"k":(\d+)', 1).cast("bigint")
    text = F.regexp_replace(text, F.lit('"v3"'), F.concat(F.lit('"n":'), (k * 3000000000).cast("string"), F.lit(',"v3"')))
    target = Target(spark, work_dir(spark, "c09")).create(schema(), buckets=4, merge=ON_READ)
    target.evolve([Field("n", T.IntegerType(), True, "int")])

    def apply(part: DataFrame, number: int) -> None:
        p = projection()
        p = type(p)(target.current().schema)
        target.upsert(to_row_kinds(_only_all(row_changes(decode(part))), p), ("c09", number))

    apply(log.where(~late), 0)
    target.evolve([Field("v3", T.VarcharType(30), True, "varchar(30)"), Field("n", T.LongType(), True, "bigint")])
    apply(log.where(late).withColumn("value", text), 1)
    return target.read().select("k", "v1", "val", "v3", "n")


WIDE = [Field("k", T.LongType(), False), Field("n", T.DecimalType(25, 2)), Field("x", T.DoubleType()), Field("f", T.DoubleType()), Field("at", T.TimestampNTZType())]
NARROW = [Field("k", T.LongType(), False), Field("n", T.IntegerType()), Field("x", T.IntegerType()), Field("f", T.FloatType()), Field("at", T.DateType())]


@query("c10_widen_across_families", """SELECT o_orderkey AS k,
      CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) || '.00' ELSE CAST(o_custkey::HUGEINT * 1000000000000 AS VARCHAR) || '.25' END AS n,
      CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS DOUBLE) ELSE o_totalprice END AS x,
      CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) ELSE o_totalprice END AS f,
      strftime(CASE WHEN o_orderkey % 2 = 0 THEN date_trunc('day', o_orderdate) ELSE o_orderdate + INTERVAL 90 MINUTE END, '%Y-%m-%d %H:%M:%S') AS at
    FROM orders""")
def c10_widen_across_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INT becomes DECIMAL and DOUBLE, FLOAT becomes DOUBLE, DATE becomes a time. Old files stay as they are and are read
    under the wider types beside new ones."""
    target = Target(spark, work_dir(spark, "c10")).create(TableSchema(NARROW, ["k"]), buckets=4, merge=ON_READ)
    orders = table(spark, sf_dir, "orders")

    def apply(part: DataFrame, **columns: str) -> None:
        rows = part.select(F.col("o_orderkey").alias("k"), *[F.expr(e).alias(c) for c, e in columns.items()], F.lit("U").alias("_kind"),
                           F.lit(1).cast("bigint").alias("_file_no"), F.col("o_orderkey").alias("_pos"), F.lit(0).alias("_row"), F.lit(1).alias("_seq"))
        target.upsert(rows)

    apply(orders.where("o_orderkey % 2 = 0"), n="cast(o_custkey as int)", x="cast(o_orderkey as int)", f="cast(o_totalprice as float)", at="cast(o_orderdate as date)")
    target.evolve(WIDE)
    apply(orders.where("o_orderkey % 2 = 1"), n="cast(o_custkey * 1000000000000L + 0.25bd as decimal(25,2))", x="o_totalprice", f="o_totalprice",
          at="cast(o_orderdate as timestamp_ntz) + interval 90 minutes")
    return target.read().select("k", F.col("n").cast("string"), "x", "f", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("f08_dropped_by_filter", f"""WITH {LOG} SELECT DISTINCT db, tbl FROM log WHERE tbl LIKE 'other_%'""")
def f08_dropped_by_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables whose changes no pair takes, told by the batch that drops them."""
    report = plan(spark, work_dir(spark, "f08")).run_batch(event_log(spark, sf_dir, "full"))
    return spark.createDataFrame(report.unrouted, "db string, tbl string")


@query("f04_targets_by_pattern", f"""WITH {LOG}
    SELECT 'test_d_1' AS pattern, 'lake.pt1' AS target, count(*) AS changes FROM log WHERE tbl = 'test_d_1'
    UNION ALL SELECT 'test_d_(\\d+)$', t, count(*) FROM log, (VALUES ('lake.pt_all'), ('lake.pt_all_dt')) v(t) WHERE tbl LIKE 'test_d_%' GROUP BY t""")
def f04_targets_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of a spec grouped by source pattern, and how many changes each pattern brings to each target."""
    out = None
    c = changes(spark, sf_dir)
    for (database, pattern), targets in parse_spec(spec("/lake")).by_pattern().items():
        mine = c.where(whole_match("db", database) & whole_match("tbl", pattern)).agg(F.count(F.lit(1)).alias("changes"))
        one = mine.select(F.lit(pattern).alias("pattern"), F.explode(F.array(*map(F.lit, targets))).alias("target"), "changes")
        out = one if out is None else out.unionByName(one)
    return out


@query("f10_new_tables_of_a_stream", f"""WITH {LOG} SELECT db, tbl, count(DISTINCT db) AS told,
      (CASE WHEN tbl = 'test_d_1' THEN 1 ELSE 0 END) + (CASE WHEN tbl LIKE 'test_d_%' THEN 2 ELSE 0 END) AS targets FROM log GROUP BY db, tbl""")
def f10_new_tables_of_a_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source table is told once, though the stream stops and starts again in between."""
    folder = work_dir(spark, "f10")
    event_log(spark, sf_dir).write.parquet(f"{folder}/source")
    for part in slices(spark.read.parquet(f"{folder}/source"), 2):
        _write_log([part], f"{folder}/log")
        start_new_tables(read_log_stream(spark, f"{folder}/log"), ROUTES, f"{folder}/checkpoint", f"{folder}/new", None).awaitTermination()
    return spark.read.parquet(f"{folder}/new").groupBy("db", "tbl").agg(F.count("*").alias("told"), F.max(F.size("targets")).alias("targets"))


def _write_log(parts: list[DataFrame], folder: str) -> None:
    for part in parts:
        part.select("value").write.mode("append").text(folder)


@query("t02_stream_drain", PER_TARGET)
def t02_stream_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a stream of files, drained in up to three micro-batches into three targets. File order within
    the folder does not matter, since the targets keep positions."""
    folder = work_dir(spark, "t02")
    _write_log([event_log(spark, sf_dir, "full")], f"{folder}/log")
    sync = plan(spark, folder, keep_positions=True)
    a_third = -(-len(spark.read.text(f"{folder}/log").inputFiles()) // 3)
    log = read_log_stream(spark, f"{folder}/log", options={"maxFilesPerTrigger": str(a_third)})
    start_sync(sync, log, f"{folder}/checkpoint", interval=None).awaitTermination()
    return _per_target(sync)


@query("w03_one_query_per_target", PER_TARGET)
def w03_one_query_per_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "w03")
    _write_log([event_log(spark, sf_dir, "full")], f"{folder}/log")
    sync = plan(spark, folder)
    log = read_log_stream(spark, f"{folder}/log")
    start_divided(sync, log, f"{folder}/checkpoint", interval=None).awaitTermination()
    return _per_target(sync)


@query("w09_restart", PER_TARGET)
def w09_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain half the log, stop, let the rest arrive, start again from the checkpoint."""
    folder = work_dir(spark, "w09")
    event_log(spark, sf_dir, "full").write.parquet(f"{folder}/source")
    for part in slices(spark.read.parquet(f"{folder}/source"), 2):
        _write_log([part], f"{folder}/log")
        sync = plan(spark, folder)
        log = read_log_stream(spark, f"{folder}/log")
        start_sync(sync, log, f"{folder}/checkpoint", interval=None).awaitTermination()
    return _per_target(sync)


@query("d04_drop_expired_days", f"""WITH {LOG}, {LIVE} SELECT dt, count(*) AS rows FROM live
    WHERE tbl LIKE 'test_d_%' AND dt >= '2024-01-20' GROUP BY dt""")
def d04_drop_expired_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = Target(spark, work_dir(spark, "d04")).create(schema(day=True), buckets=2, day="dt")
    target.upsert(to_row_kinds(_only_all(changes(spark, sf_dir, "full")), projection(day=True)))
    target.drop_days("2024-01-20")
    return target.read().groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))
