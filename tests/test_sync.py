"""Scenarios of a whole sync: end state of every target, in batch and in stream."""

import json
import os

import pytest
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators.schema import Field, IncompatibleSchema, TableSchema
from tidemark.operators.targets import Target
from tidemark.plans.spec import connection, load_spec, parse_spec
from tidemark.plans.sync import SyncPlan
from tidemark.sources.changelog import read_log_stream
from tidemark.streaming.job import start_divided, start_sync

INT = T.IntegerType()


def source(*extra, key=("k",)):
    fields = [Field("k", INT, False, "int"), Field("v1", T.VarcharType(10), True, "varchar(10)"), *extra]
    return TableSchema(fields, list(key))


ADD_TIME = Field("add_time", INT, True, "int")


def spec(folder, *pairs, metadata=None, mode="earliest-offset"):
    return json.dumps({
        "sourceTypeCode": 0, "ip": "localhost", "port": "1", "username": "u", "pwd": "p",
        "sourceConfig": {"scan.startup.mode": mode}, "catalogConfig": {"warehouse": str(folder)},
        "metaColumnTypeToTargetColName": metadata or {},
        "dataPairList": [
            {"srcDatabasePattern": "ods", "srcTablePattern": p, "tgtDatabase": "lake", "tgtTable": t, "pkList": ["k"],
             **({"dtColumns": [d]} if d else {})}
            for p, t, d in pairs
        ],
    })


FULL = [("t1", "t1", None), ("ta", "ta", None), (r"t(\d+)$", "tall", None)]
BY_DAY = [("t1_d", "t1_part", "add_time"), ("ta_d", "ta_part", "add_time"), (r"t(\d+)_d", "tall_part", "add_time")]


def prepare(spark, text, sources, **settings):
    settings = {"create_missing": True, "buckets": 1, **settings}
    return SyncPlan.prepare(spark, parse_spec(text), sources, **settings)


def held(plan, name, *columns):
    return rows(plan.targets[f"lake.{name}"].read(), *columns)


def test_full_tables_and_tables_that_appear_later(spark, tmp_path, log):
    sources = {("ods", t): source() for t in ("t1", "t2", "ta", "a")}
    plan = prepare(spark, spec(tmp_path, *FULL), sources, strict_routes=False)
    assert ("ods", "a") in plan.excluded
    log.insert("t1", k=1, v1="one").insert("t2", k=2, v1="two").insert("ta", k=1, v1="Spruce").insert("a", k=1, v1="x")
    plan.run_batch(log.frame(), 0)
    log.insert("t22", k=3, v1="Hi").insert("t22", k=4, v1="Hello").insert("t3", k=5, v1="Larch").insert("t1", k=2, v1="two")
    report = plan.run_batch(log.frame(), 1)
    assert report.new_tables == [("ods", "t22"), ("ods", "t3")]
    assert held(plan, "tall") == [(1, "one"), (2, "two"), (3, "Hi"), (4, "Hello"), (5, "Larch")]
    assert held(plan, "t1") == [(1, "one"), (2, "two")]
    assert held(plan, "ta") == [(1, "Spruce")]


def test_day_partitions_and_added_columns(spark, tmp_path, log):
    sources = {("ods", t): source(ADD_TIME) for t in ("t1_d", "t2_d", "ta_d")}
    plan = prepare(spark, spec(tmp_path, *BY_DAY), sources)
    at = 1726239466
    log.insert("t1_d", k=1, v1="one", add_time=at).insert("t2_d", k=2, v1="two", add_time=at)
    plan.run_batch(log.frame(), 0)
    assert held(plan, "tall_part") == [(1, "one", at, "2024-09-13"), (2, "two", at, "2024-09-13")]

    base = [("k", "INT", None), ("v1", "VARCHAR", 10), ("add_time", "INT", None)]
    log.alter("t22_d", [*base, ("v3", "VARCHAR", 10)])
    log.insert("t22_d", k=4, v1="Hi", add_time=at, v3="Hi3")
    report = plan.run_batch(log.frame(), 1)
    assert report.evolved == ["lake.tall_part"]
    assert plan.targets["lake.tall_part"].current().schema.names == ["k", "v1", "add_time", "dt", "v3"]
    assert plan.targets["lake.t1_part"].current().schema.names == ["k", "v1", "add_time", "dt"]

    log.alter("t1_d", [*base, ("v3", "VARCHAR", 10), ("v4", "VARCHAR", 10)])
    log.insert("t1_d", k=7, v1="T1Hello", add_time=at, v3="T1Hello3", v4="T1Hello4")
    plan.run_batch(log.frame(), 2)
    last = (7, "T1Hello", at, "2024-09-13", "T1Hello3", "T1Hello4")
    assert held(plan, "t1_part") == [(1, "one", at, "2024-09-13", None, None), last]
    assert held(plan, "tall_part") == [
        (1, "one", at, "2024-09-13", None, None), (2, "two", at, "2024-09-13", None, None),
        (4, "Hi", at, "2024-09-13", "Hi3", None), last]


def test_updates_deletes_and_moves_between_days(spark, tmp_path, log):
    plan = prepare(spark, spec(tmp_path, (r"t\d_d", "p", "add_time")), {("ods", "t1_d"): source(ADD_TIME)}, buckets=2)
    day = 86_400
    old = {"k": 1, "v1": "a", "add_time": 1726239466}
    log.row("t1_d", "c", None, old).insert("t1_d", k=2, v1="b", add_time=1726239466).insert("t1_d", k=3, v1="c", add_time=1726239466)
    plan.run_batch(log.frame(), 0)
    log.update("t1_d", old, {**old, "add_time": old["add_time"] + day})
    log.delete("t1_d", k=2, v1="b", add_time=1726239466)
    log.update("t1_d", {"k": 3, "v1": "c", "add_time": 1726239466}, {"k": 30, "v1": "cc", "add_time": 1726239466})
    plan.run_batch(log.frame(), 1)
    assert held(plan, "p", "k", "v1", "dt") == [(1, "a", "2024-09-14"), (30, "cc", "2024-09-13")]


def test_column_widening_and_case(spark, tmp_path, log):
    plan = prepare(spark, spec(tmp_path, ("T", "t", None)), {("ods", "T"): TableSchema([
        Field("k", INT, False, "int"), Field("UPPERCASE_V0", T.VarcharType(20), True, "varchar(20)")], ["k"])},
        case_sensitive=False)
    log.insert("T", k=1, UPPERCASE_V0="one")
    plan.run_batch(log.frame(), 0)
    log.alter("T", [("k", "BIGINT", None), ("UPPERCASE_V0", "VARCHAR", 30), ("Uppercase_V1", "DOUBLE", None)])
    log.insert("T", k=3_000_000_000, UPPERCASE_V0="two", Uppercase_V1=0.5)
    plan.run_batch(log.frame(), 1)
    schema = plan.targets["lake.t"].current().schema
    assert [(f.name, f.dtype.simpleString()) for f in schema.fields] == [
        ("k", "bigint"), ("uppercase_v0", "varchar(30)"), ("uppercase_v1", "double")]
    assert held(plan, "t") == [(1, "one", None), (3_000_000_000, "two", 0.5)]
    # the key widened, and still the old row is found
    log.insert("T", k=1, UPPERCASE_V0="uno")
    plan.run_batch(log.frame(), 2)
    assert held(plan, "t", "k", "uppercase_v0") == [(1, "uno"), (3_000_000_000, "two")]


def test_metadata_columns(spark, tmp_path, log):
    names = {"FULL_TABLE_NAME": "src_tbl", "BINLOG_TIME": "binlog_time", "DATABASE": "database_name"}
    plan = prepare(spark, spec(tmp_path, (r"t\d", "m", None), metadata=names), {("ods", "t1"): source()})
    log.insert("t1", k=1, v1="a")
    plan.run_batch(log.frame(), 0)
    assert held(plan, "m") == [(1, "a", "ods.t1", "2024-09-13 14:57:46", "ods")]


def test_no_primary_key_source_lands_in_keyed_target(spark, tmp_path, log):
    sources = {("ods", "t1"): source(), ("ods", "t3"): source(key=())}
    plan = prepare(spark, spec(tmp_path, (r"t(\d+)$", "tall", None)), sources)
    log.insert("t1", k=1, v1="one").insert("t3", k=5, v1="Larch")
    plan.run_batch(log.frame(), 0)
    assert held(plan, "tall") == [(1, "one"), (5, "Larch")]


def test_start_checks(spark, tmp_path):
    text = spec(tmp_path, ("t1", "x", None))
    with pytest.raises(FileNotFoundError):
        prepare(spark, text, {("ods", "t1"): source()}, create_missing=False)
    with pytest.raises(ValueError, match="no source table"):
        prepare(spark, text, {("ods", "zz"): source()})
    with pytest.raises(ValueError, match="fixed number of buckets"):
        prepare(spark, text, {("ods", "t1"): source()}, buckets=0)
    Target(spark, f"{tmp_path}/lake/x").create(TableSchema([Field("k", T.StringType(), False)], ["k"]), 1)
    with pytest.raises(IncompatibleSchema):
        prepare(spark, text, {("ods", "t1"): source()})
    with pytest.raises(ValueError, match="no tables to sync"):
        prepare(spark, text, {("ods", "t1"): source()}, ignore_incompatible=True)
    both = spec(tmp_path, ("t1", "x", None), ("t2", "y", None))
    plan = prepare(spark, both, {("ods", "t1"): source(), ("ods", "t2"): source()}, ignore_incompatible=True)
    assert plan.monitored == [("ods", "t2", "lake.y")] and plan.excluded == [("ods", "t1")]


def test_unroutable_table_fails_a_strict_plan(spark, tmp_path, log):
    plan = prepare(spark, spec(tmp_path, (r"t1", "x", None)), {("ods", "t1"): source()}, strict_routes=True)
    assert plan.run_batch(log.insert("t1", k=1, v1="a").frame(), 0).unrouted == []
    log.insert("t1", k=2, v1="b").insert("zz", k=1, v1="a").insert("yy", k=1, v1="a").insert("zz", k=2, v1="b")
    entries = log.entries
    with pytest.raises(ValueError, match=r"cannot find a target.*'yy'.*'zz'"):
        plan.run_batch(log.frame(), 1)
    assert held(plan, "x") == [(1, "a")]
    log.entries, plan.strict_routes = entries, False
    assert plan.run_batch(log.frame(), 1).unrouted == [("ods", "yy"), ("ods", "zz")]
    assert held(plan, "x") == [(1, "a"), (2, "b")]
    plan.exclude, plan.strict_routes = "zz", True  # what is excluded on purpose is no error
    assert plan.run_batch(log.insert("zz", k=3, v1="c").frame(), 2).unrouted == []


def test_dropped_tables_are_told_by_every_batch_of_a_stream(spark, tmp_path, log):
    plan = prepare(spark, spec(tmp_path, (r"t1", "x", None)), {("ods", "t1"): source()})
    for n in range(2):
        _drop(f"{tmp_path}/log", f"{n}.txt", log.insert("t1", k=n, v1="a").insert(f"z{n}", k=1, v1="a"))
        reports = []
        start_sync(plan, read_log_stream(spark, f"{tmp_path}/log"), f"{tmp_path}/cp", interval=None, on_batch=reports.append).awaitTermination()
        assert [r.unrouted for r in reports] == [[("ods", f"z{n}")]]


def test_spec_rules(spark, tmp_path):
    path = tmp_path / "spec.json"
    path.write_text(spec(tmp_path, *BY_DAY))
    p = load_spec(spark, str(path))
    assert [x.day.name for x in p.pairs] == ["dt"] * 3 and p.source_options["database-name"] == "ods"
    assert p.source_options["scan.newly-added-table.enabled"] == "false"
    assert "p" not in p.source_options.values()
    assert connection({"ip": "h", "pwd": "s"}, p)["password"] == "s"
    pair = json.loads(spec(tmp_path, ("a", "b", None)))["dataPairList"][0]

    def refuse(pairs, match, **more):
        body = {"sourceConfig": {"scan.startup.mode": "earliest-offset"}, "dataPairList": pairs, **more}
        with pytest.raises(ValueError, match=match):
            parse_spec(json.dumps(body))

    refuse([], "no data pairs")
    refuse([pair, {**pair, "srcDatabasePattern": "x"}], "one source database")
    refuse([pair, {**pair, "tgtDatabase": "x"}], "one target database")
    refuse([{**pair, "dtColumns": ["a", "b"]}], "more than one day column")
    refuse([pair, pair], "takes one data pair only", sourceConfig={"scan.startup.mode": "initial"})
    refuse([pair], "unknown start mode", sourceConfig={"scan.startup.mode": "sometime"})
    refuse([pair], "unknown metadata", metaColumnTypeToTargetColName={"OWNER": "o"})
    assert p.by_pattern()[("ods", "t1_d")] == ["lake.t1_part"]


def test_many_tables_in_one_batch(spark, tmp_path, log):
    plan = prepare(spark, spec(tmp_path, (r"t_.*", "all", None), ("t_7", "seven", None)), {("ods", "t_0"): source(), ("ods", "t_7"): source()})
    for n in range(100):
        for k in range(20):
            log.insert(f"t_{n}", k=n * 100 + k, v1=f"v{k}")
    plan.run_batch(log.frame(), 0)
    assert len(held(plan, "all")) == 2000 and len(held(plan, "seven")) == 20


def _drop(folder, name, log):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        f.write("\n".join(log.entries) + "\n")
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")
    log.entries = []


def _stream(spark, folder):
    return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))


def test_stream_equals_batch_and_survives_a_restart(spark, tmp_path, log):
    sources = {("ods", "t1"): source(), ("ods", "ta"): source()}
    seen = []

    def drain():
        plan = prepare(spark, spec(tmp_path / "lake", *FULL), sources)
        start_sync(plan, _stream(spark, tmp_path / "log"), str(tmp_path / "cp"), interval=None, on_batch=seen.append).awaitTermination()
        return plan

    log.insert("t1", k=1, v1="one").insert("ta", k=1, v1="Spruce")
    _drop(tmp_path / "log", "a", log)
    drain()
    n = len(seen)
    drain()
    assert len(seen) == n  # nothing new, nothing done
    log.alter("t22", [("k", "INT", None), ("v1", "VARCHAR", 10), ("v2", "INT", None)])
    log.insert("t22", k=2, v1="two", v2=22).update("t1", {"k": 1, "v1": "one"}, {"k": 1, "v1": "uno"})
    _drop(tmp_path / "log", "b", log)
    log.delete("ta", k=1, v1="Spruce")
    _drop(tmp_path / "log", "c", log)
    plan = drain()
    assert held(plan, "tall") == [(1, "uno", None), (2, "two", 22)]
    assert held(plan, "t1") == [(1, "uno")] and held(plan, "ta") == []
    assert [r.evolved for r in seen if r.evolved] == [["lake.tall"]]


def test_a_writer_for_each_target_from_one_read(spark, tmp_path, log):
    plan = prepare(spark, spec(tmp_path / "lake", *FULL), {("ods", "t1"): source(), ("ods", "ta"): source()})
    log.insert("t1", k=1, v1="one").insert("ta", k=1, v1="Spruce").insert("t2", k=2, v1="two")
    _drop(tmp_path / "log", "a", log)
    start_divided(plan, _stream(spark, tmp_path / "log"), str(tmp_path / "cp"), interval=None).awaitTermination()
    assert held(plan, "tall") == [(1, "one"), (2, "two")] and held(plan, "ta") == [(1, "Spruce")]


def test_initial_mode_loads_the_snapshot_then_the_log(spark, tmp_path, log):
    text = spec(tmp_path, ("topic", "topic", None), metadata={"BINLOG_TIME": "at"}, mode="initial")
    plan = prepare(spark, text, {("ods", "topic"): source()}, keep_positions=True)
    table = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v1 string")
    assert plan.load_snapshot(table, "ods", "topic") == ["lake.topic"]
    assert plan.load_snapshot(table, "ods", "topic") == []
    log.update("topic", {"k": 2, "v1": "b"}, {"k": 2, "v1": "bb"})
    plan.run_batch(log.frame(), 0, start=plan.pipeline.start)
    assert held(plan, "topic") == [(1, "a", "1970-01-01 00:00:00"), (2, "bb", "2024-09-13 14:57:46")]


def test_uncached_batch_and_one_writer(spark, tmp_path, log):
    plan = prepare(spark, spec(tmp_path, *FULL), {("ods", "t1"): source(), ("ods", "ta"): source()}, cache_batch=False, writers=1)
    log.insert("t1", k=1, v1="one")
    assert plan.run_batch(log.frame(), 0).written == ["lake.t1", "lake.tall"]
    assert held(plan, "tall") == [(1, "one")]


def test_continuous_run(spark, tmp_path, log):
    plan = prepare(spark, spec(tmp_path / "lake", ("t1", "x", None)), {("ods", "t1"): source()})
    _drop(tmp_path / "log", "a", log.insert("t1", k=1, v1="one"))
    query = start_sync(plan, _stream(spark, tmp_path / "log"), str(tmp_path / "cp"), interval="1 second")
    try:
        query.processAllAvailable()
        _drop(tmp_path / "log", "b", log.insert("t1", k=2, v1="two"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert held(plan, "x") == [(1, "one"), (2, "two")]


def test_runs_without_a_number_all_count_and_numbered_ones_once(spark, tmp_path, log):
    plan = prepare(spark, spec(tmp_path, *FULL), {("ods", "t1"): source(), ("ods", "ta"): source()})
    assert plan.run_batch(log.insert("t1", k=1, v1="a").frame()).written == ["lake.t1", "lake.tall"]
    assert plan.run_batch(log.insert("t1", k=2, v1="b").frame()).written == ["lake.t1", "lake.tall"]
    assert plan.run_batch(log.insert("t1", k=3, v1="c").frame(), 0, "s").written == ["lake.t1", "lake.tall"]
    assert plan.run_batch(log.insert("t1", k=4, v1="d").frame(), 0, "s").written == []
    assert [r[0] for r in held(plan, "t1")] == [1, 2, 3]


def test_a_stream_with_a_new_checkpoint_drops_nothing(spark, tmp_path, log):
    sources = {("ods", "t1"): source(), ("ods", "ta"): source()}
    for k, name in enumerate("ab"):
        log.insert("t1", k=k, v1=name)
        _drop(tmp_path / f"log-{name}", name, log)
        plan = prepare(spark, spec(tmp_path / "lake", *FULL), sources)
        start_sync(plan, _stream(spark, tmp_path / f"log-{name}"), str(tmp_path / f"cp-{name}"), interval=None).awaitTermination()
    assert held(plan, "t1") == [(0, "a"), (1, "b")]


def test_the_spec_decides_start_sink_and_zone(spark, tmp_path, log):
    body = json.loads(spec(tmp_path, ("t1", "t1", None)))
    at = log.insert("t1", k=1, v1="old").insert("t1", k=2, v1="new").pos
    body["sourceConfig"] = {"scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": str(1726239466000 + at), "server-time-zone": "Asia/Shanghai"}
    body["sinkConfig"] = {"bucket": "3", "sink.parallelism": "2"}
    extra = Field("at", T.TimestampType(), True, "timestamp")
    plan = SyncPlan.prepare(spark, parse_spec(json.dumps(body)), {("ods", "t1"): source(extra)}, create_missing=True)
    assert plan.targets["lake.t1"].current().buckets == 3 and plan.parallelism == 2
    plan.run_batch(log.frame())
    assert held(plan, "t1", "k", "v1") == [(2, "new")]
    table = spark.sql("SELECT 3 AS k, 'snap' AS v1, timestamp_ntz'2024-01-02 07:00:00' AS at")
    plan.load_snapshot(table, "ods", "t1")
    assert str(plan.targets["lake.t1"].read().where("k = 3").select("at").first()[0].isoformat()).startswith("2024-01-01T23:00")


def test_a_start_that_depends_on_the_log_is_resolved_first(spark, tmp_path, log):
    plan = prepare(spark, spec(tmp_path, *FULL, mode="latest-offset"), {("ods", "t1"): source(), ("ods", "ta"): source()})
    so_far = log.insert("t1", k=1, v1="a").frame()
    with pytest.raises(ValueError, match="resolve the start"):
        plan.run_batch(so_far)
    plan.resolve_start(so_far)
    plan.run_batch(so_far.unionByName(log.insert("t1", k=2, v1="b").frame()))
    assert held(plan, "t1") == [(2, "b")]


def test_many_pairs_are_one_match_per_row(spark):
    from tidemark.sources.changelog import source_filter

    df = spark.createDataFrame([("ods", "t7"), ("ods", "t7x"), ("x", "t7"), ("ods", None)], "db string, tbl string")
    kept = source_filter(df, "ods", [f"t{i}" for i in range(500)])
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 2
    assert sorted(map(str, kept.collect())) == ["Row(db='ods', tbl='t7')", "Row(db='ods', tbl=None)"]


def test_columns_that_only_rows_tell_of(spark, tmp_path, log):
    from tidemark.operators.schema import TypeRegistry

    plan = prepare(spark, spec(tmp_path, (r"t\d", "x", None)), {("ods", "t1"): source()})
    plan.registry = TypeRegistry(spark, f"{tmp_path}/types")
    assert plan.run_batch(log.insert("t1", k=1, v1="a", extra=5).frame(), 0).evolved == ["lake.x"]
    assert plan.run_batch(log.insert("t1", k=2, v1="b", extra=2.25).frame(), 1).evolved == ["lake.x"]
    assert plan.run_batch(log.insert("t2", k=3, v1="c", extra=7).frame(), 2).evolved == []
    assert [(r.k, r.v1, float(r.extra)) for r in plan.targets["lake.x"].read().sort("k").collect()] == [(1, "a", 5.0), (2, "b", 2.25), (3, "c", 7.0)]
