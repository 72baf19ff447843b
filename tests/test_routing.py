import pytest

from tests.conftest import rows
from tidemark.functions.names import fold_names, target_name
from tidemark.operators import routing
from tidemark.operators.routing import Route
from tidemark.sources.changelog import decode, row_changes, source_filter

PAIRS = [Route("testDb", "t_1", "pt1"), Route("testDb", r"t_(\d+)$", "pt_all"), Route("testDb", "ta", "pt_a")]


def _names(spark, names, db="testDb"):
    return spark.createDataFrame([(db, n) for n in names], "db string, tbl string")


def test_router_golden(spark):
    names = ["t_1", "t_2", "ta", "t_10", "t_3", "t_4", "t_11", "tb"]
    df = _names(spark, names).withColumn("t", routing.matched_targets(PAIRS))
    got = {r.tbl: set(r.t) for r in df.collect()}
    assert got == {"t_1": {"pt1", "pt_all"}, "ta": {"pt_a"}, "tb": set(),
                   **{n: {"pt_all"} for n in ("t_2", "t_10", "t_3", "t_4", "t_11")}}


def test_patterns_match_whole_names_and_halves_apart(spark):
    df = _names(spark, ["t_1\n", "xt_1", "t_1x", "a", "b"])
    assert rows(df.where(routing.whole_match("tbl", "t_1$"))) == []
    assert rows(df.where(Route("testDb", "a|b", "x").matches()), "tbl") == [("a",), ("b",)]


def test_two_patterns_to_one_target_count_once(spark):
    routes = [Route("testDb", "t_1", "pt"), Route("testDb", r"t_\d", "pt")]
    assert routing.route(_names(spark, ["t_1"]), routes).count() == 1


@pytest.mark.parametrize("literal_limit, map_limit", [(32, 100), (0, 100), (0, 1)])
def test_every_way_to_route_agrees(spark, literal_limit, map_limit):
    df = _names(spark, ["t_1", "t_1", "t_2", "tb"])
    got = rows(routing.route(df, PAIRS, literal_limit, map_limit), "tbl", "target")
    assert got == [("t_1", "pt1"), ("t_1", "pt1"), ("t_1", "pt_all"), ("t_1", "pt_all"), ("t_2", "pt_all")]


def test_include_exclude(spark):
    df = _names(spark, ["lake_1", "lake_2", "stream", "ignored"])
    def keep(i, e):
        return {r[0] for r in rows(routing.include_exclude(df, i, e), "tbl")}
    assert keep("stream|lake.+", None) == {"lake_1", "lake_2", "stream"}
    assert keep(None, "ignored") == {"lake_1", "lake_2", "stream"}
    assert keep("lake.+", "lake_1") == {"lake_2"}


def test_table_lists(spark):
    df = _names(spark, ["a", "b", "c"]).unionByName(_names(spark, ["a"], "other"))
    assert rows(routing.only_listed(df, [("testDb", "a")])) == [("testDb", "a")]
    assert rows(routing.include_except(df, "testDb", ".*", [("testDb", "a")])) == [("testDb", "b"), ("testDb", "c")]
    regex = routing.table_list_regex("testDb", "a|b", [("testDb", "a")])
    full = df.selectExpr("concat(db, '.', tbl) as n")
    assert rows(full.where(routing.whole_match("n", regex))) == [("testDb.b",)]
    assert rows(full.where(routing.whole_match("n", routing.listed_regex([("other", "a")])))) == [("other.a",)]


def test_unroutable_fails_or_goes_to_quarantine(spark):
    df = _names(spark, ["t_1", "zzz"])
    assert rows(routing.unrouted(df, PAIRS), "tbl") == [("zzz",)]
    with pytest.raises(Exception, match="cannot find a target for table testDb.zzz"):
        routing.require_routed(df, PAIRS).where("tbl = 't_1'").collect()


def test_entries_without_names_fail(spark, log):
    log.insert("t", k=1)
    log.row(None, "c", None, {"k": 1})
    frame = log.frame()
    with pytest.raises(Exception, match="unknown"):
        source_filter(row_changes(decode(frame)), "ods", ["t"]).collect()
    assert row_changes(decode(frame, strict=False)).count() == 1


def test_target_names(spark):
    df = _names(spark, ["t1"], "shard_1")
    assert df.select(target_name("test_prefix_", "_test_suffix")).first()[0] == "test_prefix_t1_test_suffix"
    assert df.select(target_name(merge_shards=False)).first()[0] == "shard_1_t1"
    assert fold_names(["T", "UPPERCASE_V0"]) == ["t", "uppercase_v0"]
    with pytest.raises(ValueError):
        fold_names(["a", "A"])


def test_report_and_start_checks(spark):
    report = routing.monitor_report(_names(spark, ["t_1", "ta", "zzz"]), PAIRS)
    routing.check_routes(report, PAIRS)
    assert rows(report.where("status = 'excluded'"), "tbl", "reason") == [("zzz", "no pattern matches")]
    with pytest.raises(ValueError, match="no source table matches"):
        routing.check_routes(report, [*PAIRS, Route("testDb", "missing", "m")])
    nothing = routing.monitor_report(_names(spark, ["t_1"]), PAIRS[:1], incompatible=["pt1"])
    with pytest.raises(ValueError, match="no tables to sync"):
        routing.check_routes(nothing, PAIRS[:1])
