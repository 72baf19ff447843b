from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.operators.history import column_changes, schema_history, with_schema, with_version
from tidemark.sources.changelog import decode, row_changes, schema_changes

A = [("k", "BIGINT", None), ("v", "VARCHAR", 10)]
B = [("k", "BIGINT", None), ("v", "VARCHAR", 20), ("w", "INT", None)]
C = [("k", "BIGINT", None), ("w", "INT", None)]


def two_shards(new_log):
    """Tables of one name in two databases, altered at different times; one row ahead of any definition."""
    log = new_log(db="s1")
    log.insert("t", k=1).alter("t", A).insert("t", k=2).insert("t", db="s2", k=3)
    log.alter("t", B, db="s2").insert("t", db="s2", k=4).insert("t", k=5)
    log.alter("t", A).insert("t", k=6).alter("t", C).insert("t", k=7).alter("t", C, db="s2").alter("t", A, db="s2").insert("t", db="s2", k=8)
    log.insert("u", k=9)
    return log.frame()


def test_each_shard_has_its_own_versions(spark, new_log, monkeypatch):
    decoded = decode(two_shards(new_log)).cache()
    versions = schema_history(schema_changes(decoded)).cache()
    found = sorted((r.db, r.version, r.since.pos, r.until and r.until.pos, [c.column for c in r.columns]) for r in versions.collect())
    assert found == [
        ("s1", 1, 2, 10, ["k", "v"]), ("s1", 2, 10, None, ["k", "w"]),  # the repeated definition at 8 is no version
        ("s2", 1, 5, 12, ["k", "v", "w"]), ("s2", 2, 12, 13, ["k", "w"]), ("s2", 3, 13, None, ["k", "v"])]
    rows = row_changes(decoded).withColumn("k", F.variant_get("after", "$.k", "int"))
    wanted = {1: 0, 2: 1, 3: 0, 4: 1, 5: 1, 6: 1, 7: 2, 8: 3, 9: 0}
    for limit in (history.BROADCAST_VERSIONS, 0):  # both ways of joining
        monkeypatch.setattr(history, "BROADCAST_VERSIONS", limit)
        dated = with_schema(rows, versions).collect()
        assert {r.k: r.version for r in dated} == wanted
        assert {r.k: r.columns and len(r.columns) for r in dated}[4] == 3 and {r.k: r.columns for r in dated}[9] is None
    assert with_version(rows, versions.limit(0)).where("version <> 0").count() == 0


def test_changes_of_columns(spark, new_log):
    versions = schema_history(schema_changes(decode(two_shards(new_log))))
    found = sorted((r.db, r.version, r.column, r.change) for r in column_changes(versions).collect())
    assert found == [
        ("s1", 1, "k", "added"), ("s1", 1, "v", "added"), ("s1", 2, "v", "dropped"), ("s1", 2, "w", "added"),
        ("s2", 1, "k", "added"), ("s2", 1, "v", "added"), ("s2", 1, "w", "added"),
        ("s2", 2, "v", "dropped"), ("s2", 3, "v", "added"), ("s2", 3, "w", "dropped")]
    assert column_changes(versions.limit(0)).count() == 0


def test_versions_in_many_blocks(spark, monkeypatch):
    """No row brings all versions of a table to a change; ahead of the first, with NULL names and behind the last as before."""
    monkeypatch.setattr(history, "BLOCK", 4)
    since = {("a", "t"): range(10, 200, 3), ("b", "t"): [7], (None, "t"): range(0, 100, 50)}
    at = lambda n: (1, n, 0)
    rows = [(db, t, v, at(p)) for (db, t), ps in since.items() for v, p in enumerate(ps, 1)]
    versions = spark.createDataFrame(rows, "db string, tbl string, version int, since struct<file_no: bigint, pos: bigint, row: int>").cache()
    given = [(db, t, 1, p, 0) for db, t in [*since, ("c", "t")] for p in range(0, 210)]
    changes = spark.createDataFrame(given, "db string, tbl string, file_no bigint, pos bigint, row int")
    for limit in (history.BROADCAST_VERSIONS, 0):
        monkeypatch.setattr(history, "BROADCAST_VERSIONS", limit)
        dated = with_version(changes, versions)
        assert dated.schema["version"].dataType.simpleString() == "int" and dated.columns[:-1] == changes.columns
        found = dated.collect()
        assert len(found) == len(given)
        assert all(r.version == sum(s <= r.pos for s in since.get((r.db, r.tbl), ())) for r in found)
        plan = dated._jdf.queryExecution().optimizedPlan().toString()
        assert "aggregate(" not in plan and "lambdafunction" not in plan  # would copy the array for every change
