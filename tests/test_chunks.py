import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.search import count_not_above, with_count_not_above
from tidemark.operators.row_kinds import Projection, current_state, to_row_kinds
from tidemark.operators.schema import Field, TableSchema
from tidemark.sources import chunks
from tidemark.sources.discovery import snapshot_changes
from pyspark.sql import types as T


def bounds_of(df, split, samples=chunks.SAMPLES):
    return chunks.chunk_bounds(chunks.key_sketch(df, "key", split, samples), split, samples)


def sizes(df, bounds):
    dealt = chunks.with_chunk(df, F.col("key"), bounds)
    return {r.chunk: r["count"] for r in dealt.groupBy("chunk").count().collect()}


def test_search_counts_elements_not_above(spark):
    rng = random.Random(1)
    rows = []
    for n in (0, 1, 2, 3, 7, 8, 9, 100):
        a = sorted(rng.choices(range(50), k=n))
        rows += [(a, v, sum(x <= v for x in a)) for v in range(-1, 52, 3)] + [(a, None, None)]
    df = spark.createDataFrame(rows, "a array<int>, v int, n int")
    assert df.where(~count_not_above(F.col("a"), F.col("v")).eqNullSafe(F.col("n"))).count() == 0


def test_search_by_projections_counts_the_same(spark):
    rng = random.Random(2)
    rows = []
    for n in (0, 1, 2, 3, 7, 8, 9, 100):
        a = sorted(rng.choices(range(50), k=n))
        rows += [(a, v, sum(x <= v for x in a)) for v in range(-1, 52, 3)] + [(a, None, None), (None, 3, 0)]
    df = spark.createDataFrame(rows, "a array<int>, v int, n int")
    found = with_count_not_above(df, "a", "v", 100, "found")
    assert found.columns == ["a", "v", "n", "found"] and found.where(~F.col("found").eqNullSafe(F.col("n"))).count() == 0


def test_dealing_rows_to_chunks_copies_no_bounds(spark):
    """The search and the join that brings the bounds are compiled together, also below a filter on what it finds."""
    bounds = spark.range(3000).select(F.col("id").alias("chunk"), F.expr("case when id > 0 then id * 10 end").alias("first"), F.col("id").alias("low"))
    dealt = chunks.with_chunk(spark.range(35000).toDF("key"), F.col("key"), bounds.cache(), "low")
    late = dealt.where((F.col("low") > 5) & (F.col("chunk") % 2 == 0) & (F.col("low") * 10 <= F.col("key")))
    plan = late._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and plan.count("lambdafunction") <= 1 and len(plan) < 20000
    found = {r.key: (r.chunk, r.low) for r in dealt.collect()}
    assert found == {k: (min(k // 10, 2999),) * 2 for k in range(35000)}
    assert late.count() == 10 * 1497


@pytest.mark.parametrize("key", [
    "id", "id * id * id", "cast(exp(id / 2500.0) * 1000 as bigint) * 20000 + id", "concat('k', sha2(cast(id as string), 256))",
    "concat(repeat('a', cast(id % 7 as int)), id)", "timestamp_micros(id * id)", "cast(id as decimal(30,5)) / 7", "cast(cast(id as string) as binary)"])
def test_no_chunk_is_over_twice_the_size_whatever_the_key(spark, key):
    df = spark.range(20000).select(F.expr(key).alias("key"))
    found = sizes(df, bounds_of(df, 500))
    assert sum(found.values()) == 20000 and max(found.values()) <= 1000 and 30 <= len(found) <= 55
    exact = sizes(df.limit(1000), bounds_of(df.limit(1000).cache(), 50))
    assert len(exact) == 20 and set(exact.values()) <= {50, 49, 51}


def test_nulls_repeated_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None,)] * 30 + [(5,)] * 400 + [(k,) for k in range(100)], "key bigint")
    found = sizes(df, bounds_of(df, 20))
    assert sum(found.values()) == 530 and max(found.values()) >= 400  # one key value stays in one chunk
    assert found[0] >= 30
    assert sizes(df.limit(0), bounds_of(df.limit(0), 20)) == {}
    assert chunks.predicates(bounds_of(df.limit(0), 20), "k") == ["1 = 1"]
    with pytest.raises(ValueError):
        chunks.key_sketch(df, "key", 0)


@pytest.mark.parametrize("key", ["id * 3", "concat('o''', id, '\\\\x')", "cast(cast(id as string) as binary)", "date_add(date'2020-01-01', cast(id as int))"])
def test_predicates_take_every_row_once(spark, key):
    df = spark.range(300).select(F.expr(f"case when id % 50 <> 7 then {key} end").alias("key")).cache()
    parts = chunks.predicates(bounds_of(df, 40), "key")
    assert len(parts) == 8
    hits = sum((F.when(F.expr(p), 1).otherwise(0) for p in parts), F.lit(0))
    assert df.where(hits != 1).count() == 0


FIELDS = TableSchema([Field("k", T.LongType(), False, "bigint"), Field("v", T.LongType(), True, "bigint")], ["k"])


class Source:
    """A table that changes under the reader. Every position is one change of one key."""

    def __init__(self, spark, keys, seed):
        self.spark, self.rng, self.at, self.log = spark, random.Random(seed), 0, []
        self.rows = {k: 0 for k in range(0, keys, 2)}
        self.history = [dict(self.rows)]
        self.keys = keys

    def go_on(self, n):
        for _ in range(n):
            k = self.rng.randrange(self.keys)
            self.at += 1
            if k in self.rows and self.rng.random() < 0.3:
                del self.rows[k]
                self.log.append((self.at, "d", k, None))
            else:
                self.rows[k] = self.at
                self.log.append((self.at, "u", k, self.at))
            self.history.append(dict(self.rows))

    def position(self):
        self.go_on(7)
        return (1, self.at, 0)

    def read(self, part):
        out = []
        for _, first, last in part:  # the table goes on changing while the chunks are read
            self.go_on(5)
            out += [(k, v) for k, v in self.rows.items() if (first is None or k >= first) and (last is None or k < last)]
        return self.spark.createDataFrame(out, "k bigint, v bigint")

    def changes(self):
        rows = [(p, op, f'{{"k":{k}}}', None if v is None else f'{{"k":{k},"v":{v}}}') for p, op, k, v in self.log]
        df = self.spark.createDataFrame(rows, "pos bigint, op string, b string, a string")
        parse = "case when {0} is not null then parse_json({0}) end"
        return df.select(
            F.lit("shop").alias("db"), F.lit("t").alias("tbl"), "op", F.expr(parse.format("b")).alias("before"), F.expr(parse.format("a")).alias("after"),
            F.lit(None).cast("string").alias("src_schema"), F.lit(0).cast("bigint").alias("ts_ms"), F.lit("f.1").alias("file"),
            F.lit(1).cast("bigint").alias("file_no"), "pos", F.lit(0).alias("row"), F.lit(None).cast("string").alias("gtid"))


def stitched(spark, source, marks, folder):
    key = lambda image: F.try_variant_get(image, "$.k", "bigint")
    snapshot = snapshot_changes(chunks.wave_rows(spark, folder), "shop", "t")
    return chunks.stitch(snapshot, source.changes(), key("after"), F.coalesce(key("after"), key("before")), marks)


def state(changes):
    return {r.k: r.v for r in current_state(to_row_kinds(changes, Projection(FIELDS)), ["k"]).collect()}


def test_chunks_read_while_the_source_changes(spark, tmp_path):
    source = Source(spark, 60, 3)
    bounds = bounds_of(spark.createDataFrame([(k,) for k in source.rows], "key bigint"), 5)
    marks = chunks.read_waves(spark, bounds, source.read, source.position, str(tmp_path), wave=2)
    source.go_on(40)
    both = stitched(spark, source, marks, str(tmp_path)).cache()
    # Every chunk is as the source was at the chunk's high mark, and the whole as it is at the end.
    wanted = {}
    for m in marks.collect():
        then = source.history[m.high.pos]
        wanted |= {k: v for k, v in then.items() if (m.first is None or k >= m.first) and (m["last"] is None or k < m["last"])}
    assert state(chunks.up_to_high(both)) == wanted
    assert state(both) == source.rows
    # A naive snapshot, without the log of the moments between the marks, is not what the source ever was there.
    assert state(both.where("op = 'r'")) != wanted
    highest = max(m.high.pos for m in marks.collect())
    chunks.require_covered(marks, (1, highest, 0))
    with pytest.raises(ValueError, match="before the last mark"):
        chunks.require_covered(marks, (1, highest - 1, 0))


def test_waves_that_are_marked_are_not_read_again(spark, tmp_path):
    source = Source(spark, 40, 5)
    bounds = bounds_of(spark.createDataFrame([(k,) for k in source.rows], "key bigint"), 5).cache()

    def fails_late(part):
        if part[0][0] >= 2:
            raise RuntimeError("lost")
        return source.read(part)

    with pytest.raises(RuntimeError):
        chunks.read_waves(spark, bounds, fails_late, source.position, str(tmp_path), wave=1)
    read = []
    marks = chunks.read_waves(spark, bounds, lambda part: read.append(part[0][0]) or source.read(part), source.position, str(tmp_path), wave=1)
    assert read == [2, 3] and marks.count() == 4
    assert state(stitched(spark, source, marks, str(tmp_path))) == source.rows
