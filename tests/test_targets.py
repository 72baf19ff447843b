import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators.row_kinds import DayColumn, Projection, current_state, to_row_kinds
from tidemark.operators.schema import Field, IncompatibleSchema, TableSchema
from tidemark.operators.targets import ON_READ, ON_WRITE, Commit, Target
from tidemark.sources.changelog import decode, row_changes

SCHEMA = TableSchema([Field("k", T.LongType(), False, "bigint"), Field("v", T.StringType(), True, "text")], ["k"])
DAY_SCHEMA = TableSchema([*SCHEMA.fields, Field("at", T.StringType(), True, "text"), Field("dt", T.StringType(), False)], ["dt", "k"])
BY_DAY = Projection(DAY_SCHEMA, DayColumn("at"))


def changes(log, p=Projection(SCHEMA)):
    return to_row_kinds(row_changes(decode(log.frame())), p)


def random_history(log, steps, seed, full=True):
    """Random inserts, updates, deletes; returns what must be alive at the end."""
    rng, live = random.Random(seed), {}
    for i in range(steps):
        k = rng.randrange(12)
        row = {"k": k, "v": f"v{i}", "at": f"2024-01-{rng.randrange(1, 6):02d}"}
        before = live.get(k)
        shown = before if full or before is None else {"k": k}
        if before and rng.random() < 0.3:
            log.row("t", "d", shown, None)
            del live[k]
        else:
            log.row("t", "u" if before else "c", shown, row)
            live[k] = row
    return sorted((r["k"], r["v"], r["at"], r["at"]) for r in live.values())


@pytest.mark.parametrize("keep_positions, order", [(False, (0, 1, 2)), (True, (0, 1, 2)), (True, (2, 0, 1))])
@pytest.mark.parametrize("locate", [False, True])
@pytest.mark.parametrize("merge", [ON_READ, ON_WRITE])
def test_random_histories_in_batches(spark, tmp_path, new_log, keep_positions, order, locate, merge):
    log = new_log()
    target = Target(spark, str(tmp_path)).create(DAY_SCHEMA, 3, "dt", keep_positions, merge)
    want = random_history(log, 60, seed=7, full=not locate)
    entries = log.entries
    for number in order:
        log.entries = entries[number * 20:(number + 1) * 20]
        target.upsert(changes(log, BY_DAY), locate_moves=locate)
        assert target.placement().where("not in_place").count() == 0
    assert rows(target.read()) == sorted(want, key=str)
    if merge == ON_READ:
        assert target.fold() > 0 and target.fold() == 0
        assert rows(target.read()) == sorted(want, key=str)
        target.drop_unused_files()
        assert rows(target.read()) == sorted(want, key=str)


def files_of(path):
    return {str(p): p.stat().st_size for p in path.rglob("*.parquet")}


def test_a_batch_writes_what_it_holds_and_reads_nothing_stored(spark, tmp_path, log):
    target = Target(spark, str(tmp_path)).create(SCHEMA, 4, merge=ON_READ)
    for k in range(2000):
        log.insert("t", k=k, v="x" * 50 + str(k))
    target.upsert(changes(log))
    before = files_of(tmp_path)
    log.update("t", {"k": 1, "v": "a"}, {"k": 1, "v": "new"}).delete("t", k=2, v="b")
    latest = changes(log)
    target.upsert(latest)
    new = {p: n for p, n in files_of(tmp_path).items() if p not in before}
    assert set(before) <= set(files_of(tmp_path)) and sum(new.values()) < sum(before.values()) / 5
    assert spark.read.parquet(*new).count() == 2
    assert target.read().count() == 1999 and target.read().where("k = 1").first().v == "new"
    assert target.fold() == 2 and target.read().count() == 1999  # the two cells that hold two writes


def test_a_horizon_bounds_what_is_remembered(spark, tmp_path, log):
    target = Target(spark, str(tmp_path)).create(SCHEMA, 2, keep_positions=True, merge=ON_READ)
    for k in range(5):
        log.insert("t", k=k, v="a")  # positions 1 to 5
    entries = list(log.entries)
    target.upsert(changes(log))
    target.upsert(changes(log.delete("t", k=0, v="a").delete("t", k=1, v="a")))  # 6 and 7
    assert rows(target.deletes(), "k", "_pos") == [(0, 6), (1, 7)]
    target.fold(horizon=(1, 7))
    assert rows(target.deletes(), "k") == [(1,)] and rows(target.read(), "k") == [(2,), (3,), (4,)]
    log.entries = entries
    target.upsert(changes(log))  # older than the horizon: the forgotten delete cannot be undone
    assert rows(target.read(), "k") == [(2,), (3,), (4,)]
    with pytest.raises(ValueError, match="cannot go back"):
        target.fold(horizon=(1, 6))
    with pytest.raises(ValueError, match="needs positions"):
        Target(spark, f"{tmp_path}/b").create(SCHEMA, 1, merge=ON_READ).fold(horizon=(1, 1))
    with pytest.raises(ValueError, match="unknown way"):
        Target(spark, f"{tmp_path}/c").create(SCHEMA, 1, merge="sometimes")


@pytest.mark.parametrize("merge", [ON_READ, ON_WRITE])
def test_old_files_under_wider_types(spark, tmp_path, merge):
    kinds = [("a", "int", "bigint", "decimal(25,3)"), ("b", "int", "double", "double"), ("c", "float", "float", "double"),
             ("d", "date", "timestamp_ntz", "timestamp_ntz"), ("e", "decimal(5,2)", "decimal(8,2)", "decimal(9,4)"), ("f", "varchar(3)", "varchar(9)", "string")]

    def fields(at):
        return [Field("k", T.IntegerType() if at < 2 else T.DecimalType(20, 0), False), *[Field(k[0], T.DataType.fromDDL(k[1 + at]) if "char" not in k[1 + at] else T.VarcharType(int(k[1 + at][8:-1]))) for k in kinds]]

    target = Target(spark, str(tmp_path)).create(TableSchema(fields(0), ["k"]), 3, merge=merge)
    values = {"a": "7", "b": "8", "c": "1.5", "d": "date'2024-02-29'", "e": "1.25", "f": "'abc'"}
    for at in range(3):
        if at:
            assert target.evolve(fields(at)) and not target.evolve(fields(at))
        given = [F.expr(f"cast({v} as {kind})").alias(c) for (c, *types), v in zip(kinds, values.values()) for kind in [types[at] if "char" not in types[at] else "string"]]
        ids = spark.range(at * 20, at * 20 + 40)
        target.upsert(ids.select(F.col("id").cast("int" if at < 2 else "decimal(20,0)").alias("k"), *given, F.lit("U").alias("_kind"),
                                 F.lit(1).cast("bigint").alias("_file_no"), F.lit(at).cast("bigint").alias("_pos"), F.lit(0).alias("_row"), F.lit(0).alias("_seq")))
    out = target.read()
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["decimal(20,0)", "decimal(25,3)", "double", "double", "timestamp_ntz", "decimal(10,4)", "string"]
    assert out.count() == 80 and out.select([c for c in out.columns if c != "k"]).distinct().count() == 1
    assert sorted(int(r.k) for r in out.collect()) == list(range(80))
    with pytest.raises(IncompatibleSchema, match="key column k"):
        target.evolve([Field("k", T.DecimalType(24, 2), False)])
    commit = target.current()
    assert Commit.from_json(commit.to_json()) == commit


def test_state_from_log_equals_stored_target(spark, tmp_path, log):
    want = random_history(log, 80, seed=3)
    frame = changes(log, BY_DAY)
    assert rows(current_state(frame, ["dt", "k"])) == sorted(want, key=str)


def test_late_changes_are_ignored_when_positions_are_kept(spark, tmp_path, log):
    target = Target(spark, str(tmp_path)).create(SCHEMA, 2, keep_positions=True)
    first = changes(log.insert("t", k=1, v="a").insert("t", k=2, v="b"))
    second = changes(log.update("t", {"k": 1, "v": "a"}, {"k": 1, "v": "new"}).delete("t", k=2, v="b"))
    target.upsert(second)
    target.upsert(first)  # arrives late: neither brings the old value nor the deleted row back
    assert rows(target.read()) == [(1, "new")]


def test_replayed_batch_does_nothing(spark, tmp_path, log):
    target = Target(spark, str(tmp_path)).create(SCHEMA, 2)
    first = changes(log.insert("t", k=1, v="a"))
    second = changes(log.update("t", {"k": 1, "v": "a"}, {"k": 1, "v": "b"}))
    assert target.upsert(first, ("job", 0)) and target.upsert(second, ("job", 1))
    assert not target.upsert(first, ("job", 0)) and not target.upsert(second, ("job", 1))
    assert rows(target.read()) == [(1, "b")]


def test_failed_write_leaves_the_old_state(spark, tmp_path, log, monkeypatch):
    target = Target(spark, str(tmp_path)).create(SCHEMA, 1)
    target.upsert(changes(log.insert("t", k=1, v="a")), ("job", 0))
    with monkeypatch.context() as m:
        m.setattr(Target, "_commit", lambda self, commit: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            target.upsert(changes(log.insert("t", k=2, v="b")), ("job", 1))
    assert rows(target.read()) == [(1, "a")]
    target.upsert(changes(log.insert("t", k=2, v="b")), ("job", 1))
    assert rows(target.read()) == [(1, "a"), (2, "b")]


def test_two_writers_cannot_commit_one_version(spark, tmp_path, log):
    target = Target(spark, str(tmp_path)).create(SCHEMA, 1)
    commit = target.current()
    commit.version = 1
    target._commit(commit)
    with pytest.raises(RuntimeError, match="another writer"):
        target._commit(commit)


def test_only_touched_cells_are_rewritten(spark, tmp_path, log):
    target = Target(spark, str(tmp_path)).create(DAY_SCHEMA, 2, "dt")
    for k in range(20):
        log.insert("t", k=k, v="a", at=f"2024-01-{1 + k % 4:02d}")
    target.upsert(changes(log, BY_DAY))
    before = target.current()
    target.upsert(changes(log.insert("t", k=99, v="z", at="2024-01-01"), BY_DAY))
    after = target.current()
    (first, old), (second, new) = sorted(after.cells.items())
    assert first in before.cells and second.startswith("2-")
    assert len(new) == 1 and len(old) == len(before.cells[first]) - 1
    assert target.read().count() == 21


def test_retention_and_unused_files(spark, tmp_path, log):
    target = Target(spark, str(tmp_path)).create(DAY_SCHEMA, 1, "dt")
    log.insert("t", k=1, v="a", at="2024-01-01").insert("t", k=2, v="b", at="2024-01-02")
    target.upsert(changes(log, BY_DAY))
    assert target.drop_days("2024-01-02") == ["2024-01-01"]
    assert rows(target.read(), "k") == [(2,)]
    target.upsert(changes(log.insert("t", k=2, v="c", at="2024-01-02"), BY_DAY))
    assert target.drop_unused_files() == 1
    assert rows(target.read(), "k", "v") == [(2, "c")]


def test_creation_rules(spark, tmp_path):
    with pytest.raises(ValueError, match="buckets"):
        Target(spark, f"{tmp_path}/a").create(SCHEMA, 0)
    with pytest.raises(ValueError, match="primary key"):
        Target(spark, f"{tmp_path}/b").create(TableSchema(SCHEMA.fields, []), 1)
    with pytest.raises(ValueError, match="day column"):
        Target(spark, f"{tmp_path}/c").create(SCHEMA, 1, "dt")
    made = Target(spark, f"{tmp_path}/d").create(SCHEMA, 1)
    assert made.read().count() == 0
    with pytest.raises(FileExistsError):
        made.create(SCHEMA, 1)
    commit = made.current()
    assert Commit.from_json(commit.to_json()) == commit


def test_hot_key_is_reduced_before_the_shuffle(spark, log):
    log.insert("t", k=1, v="a")
    plan = current_state(changes(log), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_an_entry_is_parsed_once(spark, log):
    log.insert("t", k=1, v="a")
    df = row_changes(decode(log.frame())).where("tbl = 't' and db = 'ods' and op <> 'd'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_a_writer_that_loses_leaves_the_rows_of_the_winner(spark, tmp_path, log, monkeypatch):
    target = Target(spark, str(tmp_path)).create(DAY_SCHEMA, 1, "dt")
    before = target.current()
    target.upsert(changes(log.insert("t", k=1, v="won", at="2024-01-01"), BY_DAY))
    late = Target(spark, str(tmp_path))
    monkeypatch.setattr(late, "current", lambda: before)
    with pytest.raises(RuntimeError, match="another writer"):
        late.upsert(changes(log.insert("t", k=2, v="lost", at="2024-01-01"), BY_DAY))
    assert [(r.k, r.v) for r in target.read().collect()] == [(1, "won")]
    assert target.drop_unused_files() == 1
    assert [(r.k, r.v) for r in target.read().collect()] == [(1, "won")]


@pytest.mark.parametrize("day", [None, "2024-01-01 00:00", "a/b", ""])
def test_days_that_cannot_name_a_folder_are_refused(spark, tmp_path, log, day):
    target = Target(spark, str(tmp_path)).create(DAY_SCHEMA, 1, "dt")
    for _ in range(2):
        rows = changes(log.insert("t", k=1, v="a", at="2024-01-01"), BY_DAY)
        with pytest.raises(ValueError, match="cannot store rows of the days"):
            target.upsert(rows.withColumn("dt", F.lit(day).cast("string")))
        assert target.read().count() == 0
        target.upsert(changes(log.insert("t", k=2, v="b", at="2024-01-02"), BY_DAY))
        target.upsert(changes(log.delete("t", k=2, v="b", at="2024-01-02"), BY_DAY))


def test_day_of_typed_columns_in_another_zone(spark, log):
    from tidemark.functions.types import spark_type
    from tidemark.operators.row_kinds import DayColumn, Projection, project_image
    from tidemark.operators.schema import Field, TableSchema

    kinds = ["date", "datetime", "datetime(6)", "timestamp", "varchar(40)"]
    values = [19439, 1679601600000, 1679601600000000, "2023-03-23T20:00:00Z", "2023-03-23T20:00:00.5Z"]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        days = []
        for kind, value in zip(kinds, values):
            fields = [Field("c", spark_type(kind), True, kind), Field("dt", spark_type("varchar(10)"))]
            row = spark.sql(f"SELECT parse_json('{json.dumps({'c': value})}') AS after")
            days.append(project_image(row, Projection(TableSchema(fields), DayColumn("c")), "after").first()["dt"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days == ["2023-03-23", "2023-03-23", "2023-03-23", "2023-03-24", "1970-01-01"]
