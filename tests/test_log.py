import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import calendar
from tidemark.queries.eventlog import previous_image
from tidemark.sources.changelog import decode, row_changes
from tidemark.sources.discovery import from_server_zone, snapshot_changes, snapshot_chunks
from tidemark.sources.offsets import Start, gtid_intervals


def positions(spark, data):
    return spark.createDataFrame(data, "file_no long, pos long, row int, gtid string, ts_ms long")


DATA = [(1, 4, 0, "s:1", 10), (1, 4, 1, "s:1", 10), (1, 9, 0, "s:2", 20), (2, 4, 0, "s:3", 30), (2, 4, 1, "s:3", 30), (3, 1, 0, None, 40)]


@pytest.mark.parametrize("start, want", [
    (Start("earliest-offset"), 6), (Start("initial"), 6), (Start("latest-offset"), 0), (Start("timestamp", timestamp_ms=20), 4),
    (Start("specific-offset", file_no=1, pos=9), 4), (Start("specific-offset", file_no=1, pos=4, skip_rows=1), 5),
    (Start("specific-offset", file_no=1, pos=4, skip_events=2), 3),
    (Start("specific-offset", file_no=1, pos=4, skip_events=2, skip_rows=1), 2),
    (Start("specific-offset", file_no=1, pos=4, skip_events=9), 0), (Start("specific-offset", gtid_set="s:1-2"), 3),
])
def test_start_modes(spark, start, want):
    df = positions(spark, DATA)
    assert df.where(start.resolve(df).condition()).count() == want


def test_latest_is_frozen_at_the_start(spark):
    early, late = positions(spark, DATA[:3]), positions(spark, DATA)
    assert late.where(Start("latest-offset").resolve(early).condition()).count() == 3


def test_start_options():
    s = Start.from_options({"scan.startup.mode": "specific-offset", "scan.startup.specific-offset.file": "bin.000012",
                            "scan.startup.specific-offset.pos": "7", "scan.startup.specific-offset.skip-rows": "2"})
    assert (s.file_no, s.pos, s.skip_rows) == (12, 7, 2)
    for bad in ({"scan.startup.mode": "never"}, {"scan.startup.mode": "timestamp"}, {"scan.startup.mode": "specific-offset"}):
        with pytest.raises(ValueError):
            Start.from_options(bad)
    assert gtid_intervals("a:1-3:7,b:2") == [("a", 1, 3), ("a", 7, 7), ("b", 2, 2)]


def test_log_files_order_by_number(spark, log):
    log.insert("t", k=1).insert("t", k=2)
    log.entries = [log.entries[0].replace("bin.000001", "bin.999999"), log.entries[1].replace("bin.000001", "bin.1000000")]
    assert rows(decode(log.frame()), "file_no") == [(1000000,), (999999,)]


def test_snapshot_rows(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (7, "c")], "id int, v string")
    got = snapshot_changes(t, "d", "t").collect()
    assert {(r.op, r.ts_ms, r.pos) for r in got} == {("r", 0, 0)} and len(got) == 3
    assert rows(snapshot_chunks(t, "id", 3)) == [(0, 1, 2, 2), (2, 7, 7, 1)]


def test_server_zone(spark):
    df = spark.sql("select timestamp_ntz '2023-03-23 03:00:10' as t").select(from_server_zone("t", "America/New_York").cast("string"))
    assert df.first()[0] == "2023-03-23 07:00:10"


def test_bad_json_is_an_error_in_strict_mode(spark):
    df = spark.createDataFrame([("not json",)], "value string")
    with pytest.raises(Exception, match="unknown"):
        row_changes(decode(df)).collect()


@pytest.mark.parametrize("slice_size", [1, 3, 1000])
def test_previous_image_in_slices(spark, slice_size):
    images = spark.range(60).selectExpr("id as event_id", "id % 4 as k", "named_struct('k', id % 4, 'v', id) as after")
    got = {r.event_id: (r.before or [None, None])[1] for r in previous_image(images, slice_size).collect()}
    want = {i: (None if i < 4 or (i - 4) % 11 == 0 else i - 4) for i in range(60)}
    assert got == want


def test_missing_days(spark):
    days = spark.createDataFrame([("2024-01-02",), ("2024-01-03",), ("2024-01-07",), ("2024-01-07",)], "d string")
    gaps = calendar.missing_days(days, "d", "2024-01-01", "2024-01-08")
    assert [(str(a), str(b)) for a, b in rows(gaps)] == [
        ("2024-01-01", "2024-01-01"), ("2024-01-04", "2024-01-06"), ("2024-01-08", "2024-01-08")]
    assert calendar.missing_days(days, "d", "2024-01-08", "2024-01-01").count() == 0
    assert calendar.missing_days(days.limit(0), "d", "2024-01-01", "2024-01-03").count() == 1


def test_windows_and_retention(spark):
    b = spark.sql("select date'2024-01-01' s, date'2024-01-10' e")
    got = [(str(r.window_start), str(r.window_end)) for r in calendar.windows(b, "s", "e", 3).collect()]
    assert got == [("2024-01-01", "2024-01-04"), ("2024-01-05", "2024-01-08"), ("2024-01-09", "2024-01-10")]
    assert calendar.windows(b, "e", "s", 3).count() == 0 and calendar.days_between(b, "s", "e").count() == 10
    first, last = calendar.retention_range("2024-01-10", 2 * 86_400_000 + 5, 1)
    assert [str(x) for x in spark.range(1).select(first, last).first()] == ["2024-01-08", "2024-01-11"]
    df = spark.createDataFrame([("2024-01-07",), ("2024-01-08",)], "dt string")
    assert rows(calendar.retained(df, "dt", "2024-01-10", 2 * 86_400_000)) == [("2024-01-08",)]
    assert rows(calendar.expired_days(df, "dt", "2024-01-10", 2 * 86_400_000)) == [("2024-01-07", 1)]
