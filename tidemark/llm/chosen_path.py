"""Chosen-path similarity join: a recursion on minwise tokens, in independent trees.

The root of each tree branches its classes on one minwise value. A node whose classes are few is compared exhaustively. A
large one is compared with its hub; if its classes are not all connected then, it branches again: each of its children is
chosen by some more positions of the signatures, which the path so far decides, and holds the classes that agree there.
A child's path extends its parent's, so the recursion never leaves the node, and nodes of different trees branch on
different tokens. Trees are independent, and are as many as a target recall needs.

A pair of similarity ``s`` stays together in one of the ``b`` children of ``k`` tokens with ``1 - (1 - s^k)^b``, and so on
down the tree; it is lost where that fails in all trees. ``recall`` gives the figure for the worst case, a pair all of whose
nodes are large and torn on every level. What is still large and torn below the last level goes through the exact join
on rare items (see ``linking``), which loses nothing, so recall does not sink further with depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, discard, small, stored
from tidemark.llm.linking import SMALL, Linking, hubs

TREES = 8
#: Children of a node and tokens that choose each, level by level below the roots.
BRANCHES = ((4, 3), (6, 4))


def recall(similarity: float, levels: int = len(BRANCHES), trees: int = TREES) -> float:
    """The share of pairs of a similarity that meet in some node after ``levels`` levels below the roots."""
    stays = similarity
    for branches, tokens in BRANCHES[:levels]:
        stays *= 1 - (1 - similarity**tokens) ** branches
    return 1 - (1 - stays) ** trees


class ChosenPaths(Linking):
    """A run of the join. ``classes`` has ``key``, ``n`` and ``sig``, an array of ``values`` minwise values."""

    values: int

    def roots(self) -> DataFrame:
        trees = F.array(*[F.xxhash64(F.lit(t), F.col("sig")[t]) for t in range(TREES)])
        return self.counted(self.classes.select("key", F.explode(trees).alias("path")), 0)

    def children(self, level: int, torn: DataFrame) -> DataFrame:
        """The children of torn nodes, given as rows of ``path``, ``key`` and ``component``."""
        branches, tokens = BRANCHES[level - 1]
        rows = torn.join(self.classes.select("key", "sig"), "key")
        rows = rows.select("key", "component", "path", "sig", F.explode(F.array(*map(F.lit, range(branches)))).alias("branch"))
        # Positions behind those of the roots, by the path: the same for all classes of a node.
        chosen = [F.get("sig", (F.lit(TREES) + F.pmod(F.xxhash64("path", "branch", F.lit(j)), F.lit(self.values - TREES))).cast("int")) for j in range(tokens)]
        return self.counted(rows.select("key", "component", F.xxhash64("path", "branch", *chosen).alias("path")), level)

    def counted(self, walked: DataFrame, level: int) -> DataFrame:
        """Rows of the nodes of two classes or more that are not all connected, with the node's number of classes and its hub.
        Stored."""
        known = "component" in walked.columns
        ends = [f("component").alias(c) for f, c in ((F.min, "_x"), (F.max, "_y"))] if known else []
        sizes = walked.groupBy("path").agg(F.count("*").alias("members"), *hubs(known), *ends).where("members > 1")
        sizes = sizes.where("_x <> _y").drop("_x", "_y") if known else sizes
        return stored(walked.join(sizes, "path"), f"{self.name}-nodes-{level}")

    def members(self, nodes: DataFrame, torn: DataFrame) -> DataFrame:
        """The ``key`` of the classes in torn nodes, given as ``path``. Stored.

        A copy among many is in most nodes of the last level, and one of them is enough: the classes that a part of the nodes
        gives are left out of the others."""
        part = F.pmod("path", F.lit(TREES)) == 0
        found = stored(nodes.where(part).join(small(torn), "path", "left_semi").select("key").distinct(), f"{self.name}-members-part")
        others = nodes.where(~part).join(small(found), "key", "left_anti").join(small(torn), "path", "left_semi")
        return stored(found.unionByName(others.select("key").distinct()), f"{self.name}-members")

    def run(self) -> DataFrame:
        known, nodes = None, self.roots()
        for level in range(len(BRANCHES) + 2):
            rest = level == len(BRANCHES) + 1
            if rest:
                nodes = self.prefixes(going)  # noqa: F821
            new = self.confirm(self.pairs(nodes, False), str(level))
            stars = new if known is None else known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new)
            known = components(stars, f"{self.name}-components-{level}")
            large = nodes.where(F.col("members") > SMALL)
            if large.isEmpty():
                return known
            large = self.with_component(large.select(*[c for c in ("path", "key", "size", "pos") if c in nodes.columns]), known)
            split = large.groupBy("path").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
            split = stored(split.select("path"), f"{self.name}-torn-{level}")
            if split.isEmpty():
                return known
            if level == len(BRANCHES):
                going = stored(self.with_component(self.members(large.select("path", "key"), split), known), f"{self.name}-going")
                continue
            torn = large.join(small(split), "path", "left_semi")
            if rest:
                break
            above, nodes = nodes, self.children(level + 1, torn)
            discard(above)
        last = self.confirm(self.pairs(torn, True), "last")
        return components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(last), f"{self.name}-components-last")
