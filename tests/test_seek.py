import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans.spec import parse_spec
from tidemark.plans.sync import SyncPlan
from tidemark.queries.eventlog import schema
from tidemark.queries.targets import spec
from tidemark.sources.changelog import decode, row_changes
from tidemark.sources.offsets import Start, in_gtid_set
from tidemark.sources.seek import LogIndex, executed_set, gtid_difference, gtid_text, gtid_union, merged_intervals, outside_set

SERVER = "3e11fa47-71ca-11e1-9e33-c80aa9429562"


def entry(file_no, pos, row=0, ts=0, txn=None, db="ods_test"):
    gtid = "null" if txn is None else f'"{SERVER}:{txn}"'
    return (f'{{"payload":{{"op":"c","before":null,"after":{{"k":{pos}}},"source":{{"ts_ms":{ts},"db":"{db}","table":"test_d_1",'
            f'"file":"bin.{file_no:06d}","pos":{pos},"row":{row},"gtid":{gtid}}}}}}}')


def folder(spark, tmp_path, files):
    """A log folder with one text file per list of entries, and its index."""
    (tmp_path / "log").mkdir(exist_ok=True)
    for name, entries in files.items():
        (tmp_path / "log" / name).write_text("".join(e + "\n" for e in entries))
    index = LogIndex(spark, str(tmp_path / "index"), str(tmp_path / "log"))
    index.refresh()
    return index


def six_files(spark, tmp_path):
    return folder(spark, tmp_path, {
        f"part-{n}": [entry(n, pos, row, 1000 * n + pos, 100 * n + pos) for pos in range(1, 11) for row in (0, 1)] for n in range(1, 7)})


def positions(df):
    return sorted((r.file_no, r.pos, r.row) for r in df.select("file_no", "pos", "row").collect())


def both_ways(index, start):
    """Entries by seek and by a scan of everything, and the number of files that the seek opened."""
    everything = row_changes(decode(index.read(index.paths(Start("earliest-offset")))))
    found = index.resolve(start, lambda log: row_changes(decode(log)))
    log = index.log(found)
    scanned = everything.where(start.resolve(everything).condition())
    return positions(row_changes(decode(log)).where(found.condition())), positions(scanned), len(log.inputFiles())


def test_only_files_that_can_hold_the_start_are_read(spark, tmp_path):
    index = six_files(spark, tmp_path)
    for start, files in [
        (Start("earliest-offset"), 6),
        (Start("timestamp", timestamp_ms=4005), 3),
        (Start("timestamp", timestamp_ms=9000), 0),
        (Start("specific-offset", file_no=5, pos=3), 2),
        (Start("specific-offset", file_no=5, pos=3, skip_events=4, skip_rows=1), 2),
        (Start("specific-offset", file_no=2, pos=9, skip_events=13), 3),  # into the second file behind
        (Start("specific-offset", file_no=6, pos=9, skip_events=40), 0),
        (Start("specific-offset", gtid_set=f"{SERVER}:1-350:500-505:601-610"), 2),
        (Start("latest-offset"), 0),
    ]:
        sought, scanned, opened = both_ways(index, start)
        assert sought == scanned, start
        assert opened == files, start


def test_skipped_events_do_not_trust_files_in_the_wrong_order(spark, tmp_path):
    # Positions of one source file lie in two text files that overlap, one named before the other.
    files = {"b": [entry(1, p) for p in range(1, 40, 2)], "a": [entry(1, p) for p in range(2, 40, 2)], "c": [entry(2, 1)]}
    index = folder(spark, tmp_path, files)
    sought, scanned, _ = both_ways(index, Start("specific-offset", file_no=1, pos=5, skip_events=6))
    assert sought == scanned and sought[0] == (1, 11, 0)


def test_a_lagging_index_loses_nothing(spark, tmp_path):
    index = six_files(spark, tmp_path)
    assert index.refresh() == 0
    path = tmp_path / "log" / "part-1"
    path.write_text(path.read_text() + entry(7, 1, 0, 99_000) + "\n")  # a known file grows
    (tmp_path / "log" / "part-9").write_text(entry(9, 1, 0, 99_999) + "\n")  # an unknown one comes
    (tmp_path / "log" / "part-2").unlink()
    log = index.log(Start("timestamp", timestamp_ms=90_000))
    assert len(log.inputFiles()) == 2
    assert positions(row_changes(decode(log)).where("ts_ms >= 90000")) == [(7, 1, 0), (9, 1, 0)]
    assert index.refresh() == 2 and index.refresh() == 0
    assert len(index.paths(Start("earliest-offset"))) == 6


def test_empty_folder_empty_files_and_entries_without_numbers(spark, tmp_path):
    index = folder(spark, tmp_path, {"a": [], "b": [entry(1, 1), entry(1, 2, txn=5)], "c": [entry(2, 1, txn=6)]})
    assert len(index.log(Start("specific-offset", gtid_set=f"{SERVER}:1-9")).inputFiles()) == 1  # b has one without
    assert index.resolve(Start("latest-offset"), row_changes).file_no == 2
    bare = LogIndex(spark, str(tmp_path / "index2"), str(tmp_path / "none"))
    (tmp_path / "none").mkdir()
    assert bare.refresh() == 0 and bare.log(Start("earliest-offset")).count() == 0
    assert bare.resolve(Start("latest-offset"), row_changes) == Start("earliest-offset")


def test_a_plan_reads_from_its_start(spark, tmp_path):
    index = six_files(spark, tmp_path)
    text = spec(str(tmp_path / "lake"), {"scan.startup.mode": "specific-offset", "scan.startup.specific-offset.file": "bin.000005",
                                         "scan.startup.specific-offset.pos": "3", "scan.startup.specific-offset.skip-events": "2"})
    plan = SyncPlan.prepare(spark, parse_spec(text), {("ods_test", "test_d_1"): schema(), ("ods_test", "test_d_2"): schema()},
                            create_missing=True, buckets=1)
    log = plan.read_from(index)
    assert len(log.inputFiles()) == 2 and positions(plan.select(log))[0] == (5, 5, 0)


def numbers(df):
    return {(r.server, n) for r in df.collect() for n in range(r.first, r.last + 1)}


def test_sets_of_transactions(spark):
    rng = random.Random(1)
    sets = []
    for _ in range(2):
        picked = [(rng.choice("xy"), a, a + rng.randint(0, 9)) for a in rng.sample(range(300), 40)]
        sets.append(spark.createDataFrame(picked, "server string, first bigint, last bigint"))
    a, b = sets
    for got, wanted in ((gtid_union(a, b), numbers(a) | numbers(b)), (gtid_difference(a, b), numbers(a) - numbers(b)), (merged_intervals(a), numbers(a))):
        assert numbers(got) == wanted
        by = sorted(map(tuple, got.select("server", "first", "last").collect()))
        assert all(p[0] != q[0] or q[1] > p[2] + 1 for p, q in zip(by, by[1:]))  # the shortest form
    assert gtid_difference(a, a).count() == 0 and gtid_union(a.limit(0), b.limit(0)).count() == 0


def test_executed_set_and_what_is_outside(spark, monkeypatch):
    from tidemark.sources import seek
    monkeypatch.setattr(seek, "BLOCK", 16)
    monkeypatch.setattr(seek, "RESUME_BLOCK", 8)
    held = [n for n in range(200) if n % 7 < 4 or 50 < n < 120]
    df = spark.createDataFrame([(f"{SERVER}:{n}",) for n in held * 2] + [(None,), ("odd",)], "gtid string")
    found = executed_set(df)
    assert {n for _, n in numbers(found)} == set(held)
    text = gtid_text(found)
    every = spark.createDataFrame([(f"{SERVER}:{n}",) for n in range(250)] + [(None,), ("other:5",)], "gtid string")
    left = [r.gtid for r in outside_set(every, found).collect()]
    assert sorted(left, key=str) == sorted((r.gtid for r in every.where(~in_gtid_set("gtid", text)).collect()), key=str)
    assert rows(every.where(F.col("gtid").isNull())) and None in left and "other:5" in left
