"""Similarity joins that branch on minwise values: nodes, pairs to compare, and components of what is confirmed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import components, discard, small, stored

SMALL = 16  # classes that a node may have to be compared exhaustively


class Linking:
    """Links among ``classes``, a stored table with a ``key``.

    ``levels`` lists, per level, the branches. Classes that agree on a branch are in one node. Small nodes are compared exhaustively, large ones with their hub. Members of large nodes that are not all
    connected by then go on to the next level. What the last level leaves goes through an exact prefix-filter join on full
    sets: of two sets that link, each has one of the other's among its rarest items, so nodes of rare items lose no pair.
    Nodes of this kind that stay large and torn are compared exhaustively across components, where the sizes and the places
    of the item in both sets leave enough behind it to link.
    """

    name: str
    percent: int
    levels: list[list]
    classes: DataFrame
    wide: int = 1  # how many times SMALL the classes of a small node may be ahead of the exact join

    def confirm(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs ``a``, ``b`` that link, stored."""
        raise NotImplementedError

    def sets(self, wanted: DataFrame, name: str) -> DataFrame:
        """The full sets, ``key`` and ``items``, of the classes with the distinct ``key`` of ``wanted``."""
        raise NotImplementedError

    def prefixes(self, classes: DataFrame) -> DataFrame:
        """Nodes of the exact join: the items in as many of a set's rarest as no set that links can do without."""
        sets = stored(self.sets(classes.select("key"), "rest"), f"{self.name}-rest-sets")
        size = F.col("n") if "n" in sets.columns else F.size("items")  # sets in slices come with their whole size
        each = sets.select("key", size.cast("int").alias("size"), F.explode("items").alias("path"))
        counts = stored(each.groupBy("path").agg(F.count("*").alias("often")).where("often > 1"), f"{self.name}-rest-counts")
        own = Window.partitionBy("key")
        # Items of one set only come first in the order, but make no node.
        met = each.join(small(counts), "path").select("key", "size", "path", F.count("*").over(own).alias("met"), F.row_number().over(own.orderBy("often", "path")).alias("at"))
        # Counted from 1 over the whole set, with what no other set has in front.
        walked = met.select("key", "path", "size", (F.col("size") - F.col("met") + F.col("at")).cast("int").alias("pos"))
        walked = walked.where(F.expr(f"pos <= size * {100 - self.percent} div 100 + 1"))
        walked = walked.join(small(classes.select("key", "component")), "key")
        nodes = walked.groupBy("path").agg(F.count("*").alias("members"), *hubs(True), *[
            F.bit_xor(F.xxhash64("key", F.lit(k))).alias(f"print{k}") for k in range(2)]).where("members > 1")
        # Nodes of the same members, such as the items of a passage, are one.
        same = F.xxhash64("print0", "print1", "members").alias("path")
        met = walked.join(nodes, "path").groupBy("key", "size", "component", "members", "hub", "hub_component", same).agg(F.min("pos").alias("pos"))
        return stored(met, f"{self.name}-nodes-rest")

    def nodes(self, level: int, classes: DataFrame) -> DataFrame:
        """Members of the nodes of a level that have two classes or more, with the node's number of members and hub."""
        if level == len(self.levels):
            return self.prefixes(classes)
        return self.met(self.walked(level, classes), str(level))

    def met(self, walked: DataFrame, name: str) -> DataFrame:
        """The rows of ``walked`` that meet others, with their node's number of members and hub, stored."""
        # One shuffle for sizes and members.
        own = Window.partitionBy("path")
        sizes = [F.count("*").over(own).alias("members"), F.min("key").over(own).alias("hub")]
        if "component" in walked.columns:
            sizes.append(F.min_by("component", "key").over(own).alias("hub_component"))
        return stored(walked.select("*", *sizes).where("members > 1"), f"{self.name}-nodes-{name}")

    def walked(self, level: int, classes: DataFrame) -> DataFrame:
        """Rows of ``key``, ``path`` and, below the first level, ``component``: the nodes of a level that classes are in.

        ``classes`` are all of them at first, and then the members of the large and torn nodes above: their ``path``,
        ``key`` and ``component``."""
        raise NotImplementedError

    def marked(self, rows: DataFrame) -> DataFrame:
        """Members of small nodes with the columns, if any, that :meth:`alike` compares."""
        return rows

    def alike(self) -> Column | None:
        """Whether ``_a`` and ``_b`` may link, by the columns that :meth:`marked` adds."""
        return None

    def pairs(self, nodes: DataFrame, last: bool) -> DataFrame:
        """Distinct pairs to compare: all of small nodes, hub and member of large ones, all across components at last.

        They come dealt by the member, ``a``; hubs are in ``b``."""
        known = "component" in nodes.columns
        sized = "size" in nodes.columns
        keep = ["path", "key", *(["component"] if known else []), *(["size", "pos"] if sized else [])]
        few = nodes if last else nodes.where(F.col("members") <= self.limit(nodes))
        few = few.select(*keep) if sized else self.marked(few.select(*keep))
        a, b = (few.select(*[F.col(c).alias(f"{c}_{x}") for c in few.columns]) for x in "ab")
        on = (F.col("path_a") == F.col("path_b")) & (F.col("key_a") > F.col("key_b"))
        if known:
            on &= F.col("component_a") != F.col("component_b")
        if not sized and (alike := self.alike()) is not None:
            on &= alike
        if sized:
            on &= F.expr(f"100 * least(size_a, size_b) >= {self.percent} * greatest(size_a, size_b)")
            # Two sets have nothing in common ahead of the first item that they meet in.
            left = "cast(1 + least(size_a - pos_a, size_b - pos_b) as bigint)"
            on &= F.expr(f"{100 + self.percent} * {left} >= {self.percent} * (cast(size_a as bigint) + size_b)")
        found = a.join(b, on).select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
        if not last:
            spokes = nodes.where((F.col("members") > self.limit(nodes)) & (F.col("key") != F.col("hub")))
            spokes = spokes.where("component <> hub_component") if known else spokes
            found = found.unionByName(spokes.select(F.col("key").alias("a"), F.col("hub").alias("b")))
        return found.repartition("a").distinct()

    def limit(self, nodes: DataFrame) -> int:
        return SMALL if "size" in nodes.columns else SMALL * self.wide

    def run(self) -> DataFrame:
        """``node`` and ``component`` of every class that links with another class, but the smallest of each component."""
        classes, known, nodes = self.classes, None, None
        for level in range(len(self.levels) + 1):
            nodes = self.nodes(level, classes)
            known = self.joined(known, self.confirm(self.pairs(nodes, False), str(level)), str(level))
            large = nodes.where(F.col("members") > self.limit(nodes)).select(*[c for c in ("path", "key", "size", "pos") if c in nodes.columns])
            if large.isEmpty():
                return known
            large = self.with_component(large, known)
            torn = large.groupBy("path").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
            torn = stored(torn.select("path"), f"{self.name}-torn-{level}")
            if torn.isEmpty():
                return known
            if level == len(self.levels):
                break
            going = large.join(small(torn), "path", "left_semi")
            if level + 1 == len(self.levels):
                going = going.select("key", "component").distinct()
            classes = stored(going, f"{self.name}-open-{level}")
            discard(nodes)
        rest = large.join(small(torn), "path", "left_semi")
        return self.joined(known, self.confirm(self.pairs(rest, True), "rest"), "rest")

    def joined(self, known: DataFrame | None, new: DataFrame, name: str) -> DataFrame:
        """The components known so far, joined by new links."""
        if known is None:
            return components(new, f"{self.name}-components-{name}")
        if new.isEmpty():
            return known
        stars = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return components(stars.unionByName(new), f"{self.name}-components-{name}")

    @staticmethod
    def with_component(keyed: DataFrame, known: DataFrame) -> DataFrame:
        kept = [c for c in keyed.columns if c != "component"]
        joined = keyed.select(*kept).join(small(known.withColumnRenamed("node", "key")), "key", "left")
        return joined.select(*kept, F.coalesce("component", "key").alias("component"))


def hubs(known: bool) -> list[Column]:
    """A node's hub, and the component of the hub if those of the members are known."""
    return [F.min("key").alias("hub"), *([F.min_by("component", "key").alias("hub_component")] if known else [])]


def agreement(a: str, b: str) -> Column:
    """In how many places two arrays agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda x, y: x + y)
