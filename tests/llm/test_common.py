import random

from tests.llm.conftest import union_find
from tidemark.llm.common import ascii_lower, components, drop_rows, running_totals
from pyspark.sql import functions as F


def test_components_of_chains_stars_loops_and_repeats(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (5, 4), (4, 5)]
    links += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(45)]
    rng.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint"), "t").collect()))
    want = {n: r for n, r in union_find({x for e in links for x in e}, links).items() if n != r}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "t").collect() == []


def test_running_totals_with_ties_and_nulls(spark):
    rows = [(k % 7 if k % 5 else None, k) for k in range(500)]
    df = running_totals(spark.createDataFrame(rows, "k int, n int"), ["k", "n"], {"below": "n"}, "t")
    total, want = 0, []
    for k, n in sorted(rows, key=lambda r: (r[0] is not None, r)):
        want.append((k, n, total, 124750))
        total += n
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    assert running_totals(spark.createDataFrame([], "k int, n int"), ["k"], {"below": "n"}, "t").collect() == []


def test_only_a_to_z_is_lowered(spark):
    df = spark.createDataFrame([("AbZ",), ("ÀBİẞΣ K",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(ascii_lower(F.col("t"))).collect()] == ["abz", "Àbİẞσ k".replace("σ", "Σ"), "", None]


def test_drop_rows_treats_null_as_a_value(spark):
    df = spark.createDataFrame([(None, "x"), (1, "x"), (1, "x"), (2, "y"), (2, None)], "id int, _row string")
    keys = {"id": df["id"], "t": df["_row"]}
    table = "id int, t string"
    dropped, repeated = spark.createDataFrame([(None, "x"), (2, None)], table), spark.createDataFrame([(1, "x")], table)
    assert sorted(map(tuple, drop_rows(df, keys, dropped, repeated).collect())) == [(1, "x"), (2, "y")]
