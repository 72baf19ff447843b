import itertools
import random
import zlib

from tidemark.llm import sharding

SCHEMA = "doc_id bigint, text string, lang string, source string, shard int, place string"


def test_the_curve_visits_every_cell_and_moves_by_one_step(spark):
    for bits, n in ((3, 2), (2, 3), (1, 2), (3, 3)):
        axes = [f"c{i}" for i in range(n)]
        cells = list(itertools.product(range(1 << bits), repeat=n))
        df = spark.createDataFrame(cells, ", ".join(f"{a} int" for a in axes))
        rows = sorted(sharding.hilbert(df, axes, bits).collect(), key=lambda r: r.place)
        assert [r.place for r in rows] == list(range(1 << bits * n))
        assert all(sum(abs(a[c] - b[c]) for c in axes) == 1 for a, b in zip(rows, rows[1:]))


def corpus():
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 50) + "é" * rng.randint(0, 3), rng.choice(["en", "de", None]), "hot" if i % 3 else f"s{i % 7}", 9, "p") for i in range(331)]
    return rows + [(5, None, None, None, 1, "p"), (None, "", "en", "hot", 1, "p")] + [(7, "same", "en", "hot", 1, "p")] * 40


def test_counts_are_at_most_one_apart_and_slots_have_no_gap(spark):
    rows = corpus()
    out = sharding.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in out), key=str) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=str)
    slots = {}
    for r in out:
        assert r.law == "rows" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_levels_are_shares_of_the_rows_below(spark):
    df = spark.createDataFrame([(v,) for v in [None] * 2 + ["a"] * 5 + ["b"] * 8 + ["c"]], "v string")
    got = {r.value: r.level for r in sharding.levels(df, "v", 4).collect()}
    assert got == {None: 0, "a": 2, "b": 7, "c": 15}


def test_fewer_rows_than_shards_and_none(spark):
    few = spark.createDataFrame([(i, "t", "en", "s", 1, "p") for i in range(3)], SCHEMA)
    assert sorted((r.shard, r.slot) for r in sharding.judge(few).collect()) == [(0, 0), (5, 0), (10, 0)]
    assert sharding.judge(few.limit(0)).collect() == []
