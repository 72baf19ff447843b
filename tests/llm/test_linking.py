import random
from itertools import combinations

from pyspark.sql import functions as F

from tidemark.llm import linking


class Given(linking.Linking):
    """Sets as they are given."""

    name, percent, levels = "given", 85, []

    def __init__(self, spark, own):
        self.own = spark.createDataFrame([(k, sorted(v)) for k, v in own.items()], "key bigint, items array<bigint>")
        self.going = self.own.select("key", F.col("key").alias("component"))

    def sets(self, wanted, name):
        return self.own


def found(given, last):
    return {tuple(sorted(r)) for r in given.pairs(given.prefixes(given.going), last).collect()}


def links(own):
    return {(a, b) for a, b in combinations(sorted(own), 2) if 100 * len(own[a] & own[b]) >= 85 * len(own[a] | own[b])}


def near_copies(copies, edits, seed=1, size=100):
    """Copies of one set, each with so many of its items replaced by own ones; a part of them is shorter."""
    rng, own = random.Random(seed), {}
    for k in range(copies):
        n = size - rng.choice([0, 0, 5, 10])
        gone = set(rng.sample(range(n), rng.choice(edits)))
        own[k] = {x for x in range(n) if x not in gone} | {1000 * (k + 1) + x for x in gone}
    return own


def test_copies_too_far_from_each_other_are_not_paired(spark):
    own = near_copies(40, [12])
    assert not links(own) and len(found(Given(spark, own), True)) < 20  # of 780


def test_no_link_is_lost_by_places_and_merged_nodes(spark, monkeypatch):
    for seed in range(3):
        own = near_copies(30, [0, 1, 3, 6, 9], seed) | {100 + k: v for k, v in near_copies(8, [0, 2, 5], seed + 50, 24).items()}
        assert links(own) and links(own) <= found(Given(spark, own), True)
        with monkeypatch.context() as m:
            m.setattr(linking, "SMALL", 100)
            assert links(own) <= found(Given(spark, own), False)


def test_nodes_of_the_same_members_are_one(spark):
    given = Given(spark, {1: set(range(40)), 2: set(range(40)), 3: {50, 51, 52}})
    got = given.prefixes(given.going).collect()
    assert sorted((r.key, r.members, r.pos) for r in got) == [(1, 2, 1), (2, 2, 1)]


def test_members_connected_with_their_hub_are_not_compared_again(spark, monkeypatch):
    monkeypatch.setattr(linking, "SMALL", 2)
    given = Given(spark, {k: set(range(60)) for k in range(6)})
    given.going = given.going.withColumn("component", F.when(F.col("key") < 4, 0).otherwise(F.col("key")))
    assert found(given, False) == {(0, 4), (0, 5)}
