"""Prefix trie of conversations, by adaptive radix trees over turn ids.

A turn is known by a 16-byte big-endian id, the head of the SHA-256 of its role and text, so a conversation is a byte key
of fixed-width ids. Tasks put the keys of their share, some megabytes at a time, into an adaptive radix tree: nodes hold
4, 16, 48 or 256 children in layouts that grow as they fill, and a path without a branch is one compressed node. Branches
fall anywhere within an id; only depths at whole turns emit trie nodes. A trie node is named by a hash chained over the
ids down to it, and what the trees of several tasks tell of one node is summed after a partial aggregation. So a first
turn that a third of all conversations share costs each tree one row, and no task needs all that begins with it.

Keys are cut into sections of bounded length, each under the chained hash of what comes before, so neither a tree nor a
row grows with the longest conversation. Sums over subtrees need no walk from the leaves upwards: each conversation adds
its own turns to all nodes that it passes, and distinct nodes are counted by the smallest conversation of each, whose
nodes form one unbroken run. The digest of the conversations that end in a node is streamed: their sorted ids are joined
in tasks into pieces, and only pieces meet.

Turns are ordered by ``turn``, NULL first, then by turn id. A NULL role or text counts as empty. Rows without ``conv_id``
belong to no conversation and are left out. Repeated rows are turns of their own. Only the four named columns are read. An
empty table gives an empty result, without a root.
"""

from __future__ import annotations

import hashlib
from bisect import bisect
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

WIDTH = 16  # bytes of a turn id and of a node's name
ROOT = bytes(WIDTH)
KEY_BYTES = 256  # that a key costs a tree besides its own bytes
ROWS = 1 << 13  # rows of an Arrow batch made here
BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class Sizes:
    """Bounds of what a task holds; results do not depend on them."""

    section: int = 4096  # turns of a section
    tree: int = 8 << 20  # bytes of the keys in one tree
    piece: int = 1 << 16  # characters of joined ids in one row


# --- turns

def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``at`` from 1, ``id`` and ``size`` (code points of the text) of every turn, stored."""
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in ("role", "text"))
    name = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("bigint").alias("conv_id"), conversations["turn"].alias("turn"),
        F.unhex(F.substring(name, 1, 2 * WIDTH)).alias("id"), F.length(text).cast("bigint").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id", "size")
    numbered = rows.withColumn("at", F.row_number().over(order).cast("bigint"))
    return stored(numbered.select("conv_id", "at", "id", "size"), "trie-turns")


def plain(turned: DataFrame) -> DataFrame:
    """The keys of conversations as they are: ``conv_id``, ``part``, ``at``, ``id``, ``size``. Part -1 marks a conversation."""
    mark = turned.where("at = 1").select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("bigint").alias("at"), F.lit(None).cast("binary").alias("id"), F.lit(0).cast("bigint").alias("size"))
    return mark.unionByName(turned.select("conv_id", F.lit(1).alias("part"), "at", "id", "size"))


def head_length(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % 6


def rebuilt(turned: DataFrame) -> DataFrame:
    """Like ``plain``, but each conversation begins with up to five turns of the first one of its hundred."""
    keys = plain(turned)
    own = keys.where((F.col("part") < 0) | (F.col("at") > head_length(F.col("conv_id"))))
    first = turned.where("conv_id % 100 = 0 and at <= 5").select(F.col("conv_id").alias("base"), "at", "id", "size")
    each = turned.where("at = 1").select("conv_id", F.expr("conv_id - conv_id % 100").alias("base"))
    heads = each.join(first, "base").where(F.col("at") <= head_length(F.col("conv_id")))  # at most five for each
    return own.unionByName(heads.select("conv_id", F.lit(0).alias("part"), "at", "id", "size"))


SECTIONS = "conv_id bigint, start binary, depth bigint, ids binary, before array<bigint>, total bigint, end binary"


def sections(keys: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Keys cut into sections: the hash ``start`` and ``depth`` ahead, the ids, code points ``before`` each turn and after
    the last, code points of the whole conversation in ``total``, and in the last section the hash ``end``. Stored."""
    order = Window.partitionBy("conv_id").orderBy("part", "at")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = keys.repartition("conv_id").withColumn("total", F.sum("size").over(whole))
    rows = rows.sortWithinPartitions("conv_id", "part", "at").select("conv_id", "id", "size", "total")
    return stored(rows.mapInArrow(partial(_cut, sizes.section), SECTIONS), "trie-sections")


def chained(name: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(name + turn).digest()[:WIDTH]


def _cut(section: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def read() -> Iterator[tuple]:
        conv = None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if row[1] is None:  # the mark ahead of a conversation
                    if conv is not None:
                        yield conv, start, depth, bytes(ids), before, total, name  # noqa: F821
                    conv, total = row[0], row[3]
                    start = name = ROOT
                    depth, ids, before = 0, bytearray(), [0]
                    continue
                if len(before) > section:
                    yield conv, start, depth, bytes(ids), before, total, None
                    start, depth, ids, before = name, depth + len(before) - 1, bytearray(), before[-1:]
                ids += row[1]
                before.append(before[-1] + row[2])
                name = chained(name, row[1])
        if conv is not None:
            yield conv, start, depth, bytes(ids), before, total, name

    yield from _batched(read(), SECTION_TYPES, lambda row: len(row[3]))


SECTION_TYPES = pa.schema([
    ("conv_id", pa.int64()), ("start", pa.binary()), ("depth", pa.int64()), ("ids", pa.binary()),
    ("before", pa.list_(pa.int64())), ("total", pa.int64()), ("end", pa.binary())])


def _batched(rows: Iterable[tuple], schema: pa.Schema, weight=None) -> Iterator[pa.RecordBatch]:
    kept, heavy = [], 0
    for row in rows:
        kept.append(row)
        heavy += weight(row) if weight else 0
        if len(kept) >= ROWS or heavy > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), schema.types)], schema=schema)
            kept, heavy = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), schema.types)], schema=schema)


# --- the adaptive radix tree

class Few:
    """Up to 4, later 16 children: sorted key bytes beside them."""

    __slots__ = ("bytes", "nodes", "room")

    def __init__(self, keys: bytes = b"", nodes: Iterable[Node] = (), room: int = 4) -> None:
        self.bytes, self.nodes, self.room = bytearray(keys), list(nodes), room

    def get(self, byte: int) -> Node | None:
        k = self.bytes.find(byte)
        return self.nodes[k] if k >= 0 else None

    def add(self, byte: int, node: Node) -> Few | Indexed:
        if len(self.nodes) == self.room:
            grown = Few(self.bytes, self.nodes, 16) if self.room == 4 else Indexed(self.bytes, self.nodes)
            return grown.add(byte, node)
        k = bisect(self.bytes, byte)
        self.bytes.insert(k, byte)
        self.nodes.insert(k, node)
        return self

    def children(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.nodes)


class Indexed:
    """Up to 48 children: for each of the 256 bytes, the place of its child, or 0."""

    __slots__ = ("index", "nodes")

    def __init__(self, keys: bytes, nodes: list[Node]) -> None:
        self.index, self.nodes = bytearray(256), list(nodes)
        for k, byte in enumerate(keys, 1):
            self.index[byte] = k

    def get(self, byte: int) -> Node | None:
        k = self.index[byte]
        return self.nodes[k - 1] if k else None

    def add(self, byte: int, node: Node) -> Indexed | Whole:
        if len(self.nodes) == 48:
            return Whole(self.children()).add(byte, node)
        self.nodes.append(node)
        self.index[byte] = len(self.nodes)
        return self

    def children(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.nodes[k - 1]) for byte, k in enumerate(self.index) if k)


class Whole:
    """A place for each of 256 children."""

    __slots__ = ("nodes",)

    def __init__(self, children: Iterable[tuple[int, Node]]) -> None:
        self.nodes: list[Node | None] = [None] * 256
        for byte, node in children:
            self.nodes[byte] = node

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def add(self, byte: int, node: Node) -> Whole:
        self.nodes[byte] = node
        return self

    def children(self) -> Iterator[tuple[int, Node]]:
        return ((byte, node) for byte, node in enumerate(self.nodes) if node is not None)


class Node:
    """``path``: bytes after the one that led here, without a branch. ``section``: depth and sums of any key that passes.
    ``least`` is the smallest conversation with its mark, ``a`` and ``b`` sums over keys; first of keys that end here,
    after ``gather`` of the whole subtree."""

    __slots__ = ("path", "kids", "section", "least", "a", "b")

    def __init__(self, path: bytes, section: tuple | None, kids: Few | Indexed | Whole | None = None) -> None:
        self.path, self.section, self.kids = path, section, kids
        self.least, self.a, self.b = None, 0, 0

    def end(self, least: tuple, a: int, b: int) -> None:
        self.least = least if self.least is None else min(self.least, least)
        self.a += a
        self.b += b

    def split(self, at: int) -> None:
        """Branch within the path: what is below the place moves to a child."""
        lower = Node(self.path[at + 1:], self.section, self.kids)
        lower.least, lower.a, lower.b = self.least, self.a, self.b
        self.kids = Few().add(self.path[at], lower)
        self.path, self.least, self.a, self.b = self.path[:at], None, 0, 0


def agreeing(key: bytes, at: int, path: bytes) -> int:
    """How many bytes of ``path`` the key has from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    low, high = 0, min(len(path), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key.startswith(path[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


class Tree:
    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, key: bytes, section: tuple, least: tuple, a: int, b: int) -> None:
        if self.root is None:
            self.root = Node(key, section)
        node, at = self.root, 0
        while True:
            same = agreeing(key, at, node.path)
            if same < len(node.path):
                node.split(same)
            at += same
            if at == len(key):
                return node.end(least, a, b)
            child = node.kids.get(key[at]) if node.kids else None
            if child is None:
                child = Node(key[at + 1:], section)
                node.kids = (node.kids or Few()).add(key[at], child)
            node, at = child, at + 1

    def gather(self) -> list[tuple[bytes, Node, int]]:
        """Nodes from the root down, with the byte that leads to each and its parent's place; sums now hold subtrees."""
        order = [(b"", self.root, -1)] if self.root else []
        for k, (_, node, _) in enumerate(order):  # grows while it runs
            if node.kids:
                order += [(bytes((byte,)), child, k) for byte, child in node.kids.children()]
        for _, node, up in reversed(order):
            if up >= 0:
                order[up][1].end(node.least, node.a, node.b)
        return order

    def emit(self) -> Iterator[tuple]:
        """A row per depth at a whole turn: hash, parent's hash, depth, code points of the turn and before it, the sums."""
        order = self.gather()
        states: list[tuple[bytes | None, int, bytes]] = []
        for byte, node, up in order:
            name, turn, rest = states[up] if up >= 0 else (None, 0, b"")
            data, at = rest + byte + node.path, 0
            depth, before = node.section
            sums = (*node.least, node.a, node.b)
            while len(data) - at >= WIDTH:
                word = data[at:at + WIDTH]
                at += WIDTH
                if name is None:  # the section's start
                    name = word
                    if name == ROOT:
                        yield name, None, 0, 0, 0, *sums
                    continue
                name, parent, turn = chained(name, word), name, turn + 1
                yield name, parent, depth + turn, before[turn] - before[turn - 1], before[turn - 1], *sums
            states.append((name, turn, data[at:]))


PARTIAL = "name binary, parent binary, depth bigint, size bigint, before bigint, conv_id bigint, mark bigint, a bigint, b bigint"
PARTIAL_TYPES = pa.schema([("name", pa.binary()), ("parent", pa.binary()), *((c, pa.int64()) for c in ("depth", "size", "before", "conv_id", "mark", "a", "b"))])


def _grow(most: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        tree, held = Tree(), 0
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                for conv, start, depth, ids, before, mark, a, b in zip(*(c.to_pylist() for c in batch.slice(k, 256).columns)):
                    tree.insert(start + ids, (depth, before), (conv, mark), a, b)
                    held += 2 * len(ids) + KEY_BYTES
                    if held > most:
                        yield from tree.emit()
                        tree, held = Tree(), 0
        yield from tree.emit()

    yield from _batched(rows(), PARTIAL_TYPES)


def grown(cut: DataFrame, mark: Column, a: Column, b: Column, sizes: Sizes) -> DataFrame:
    """What trees tell of trie nodes: sums of ``a`` and ``b`` over the conversations that pass, the smallest and its mark."""
    rows = cut.select("conv_id", "start", "depth", "ids", "before", mark.alias("mark"), a.alias("a"), b.alias("b"))
    return rows.mapInArrow(partial(_grow, sizes.tree), PARTIAL)


# --- digests of conversations that end in a node

def _join(most: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a node to pieces of joined ids."""
    def rows() -> Iterator[tuple]:
        name, first, parts, held = None, 0, [], 0
        for batch in batches:
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if parts and (node != name or held >= most):
                    yield name, first, ",".join(parts)
                    parts, held = [], 0
                if not parts:
                    name, first = node, conv
                parts.append(str(conv))
                held += len(parts[-1]) + 1
        if parts:
            yield name, first, ",".join(parts)

    yield from _batched(rows(), pa.schema([("name", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]), lambda row: len(row[2]))


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest per node."""
    def rows() -> Iterator[tuple]:
        name = digest = None
        for batch in batches:
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != name:
                    if digest:
                        yield name, digest.hexdigest()
                    name, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if digest:
            yield name, digest.hexdigest()

    yield from _batched(rows(), pa.schema([("name", pa.binary()), ("ends_sha256", pa.string())]))


def digests(cut: DataFrame, sizes: Sizes) -> DataFrame:
    ends = cut.where("end is not null").select(F.col("end").alias("name"), "conv_id")
    parts = max(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ends = ends.repartitionByRange(parts, "name", "conv_id").sortWithinPartitions("name", "conv_id")
    pieces = ends.mapInArrow(partial(_join, sizes.piece), "name binary, first bigint, ids string")
    pieces = pieces.repartition("name").sortWithinPartitions("name", "first").select("name", "ids")
    return pieces.mapInArrow(_digest, "name binary, ends_sha256 string")


# --- the trie

def trie(keys: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """One row per trie node of ``keys`` (of ``plain`` or ``rebuilt``): ``conv_id``, ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    cut = sections(keys, sizes)
    zero = F.lit(0).cast("bigint")
    first = grown(cut, zero, F.lit(1).cast("bigint"), F.col("total"), sizes)
    node = ["name", "parent", "depth", "size", "before"]
    nodes = stored(first.groupBy(*node).agg(F.min("conv_id").alias("conv_id"), F.sum("a").alias("n_convs"), F.sum("b").alias("total")), "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(children, "name", "left").na.fill(0, ["n_children"]).join(parents, "parent", "left")
    full = stored(full, "trie-full")
    # The nodes of which a conversation is the smallest are one run down to its end: where it starts, how much it holds,
    # and whether it ends in a leaf.
    runs = full.groupBy("conv_id").agg(
        F.min("before").alias("mark"), (F.max(F.col("before") + F.col("size")) - F.min("before")).alias("own"),
        F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf"))
    second = grown(cut.join(runs, "conv_id"), F.col("mark"), F.col("own"), F.col("leaf"), sizes)
    sums = second.groupBy("name").agg(F.min(F.struct("conv_id", "mark")).alias("top"), F.sum("a").alias("own"), F.sum("b").alias("n_leaves"))
    met = full.join(sums, "name").join(digests(cut, sizes), "name", "left")
    passed = F.col("total") - F.col("n_convs") * F.col("before")  # code points of all turns below, once per conversation
    distinct = F.col("own") - (F.col("before") - F.col("top.mark"))  # of all nodes below, once each
    return met.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (passed - distinct).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def judge(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(turns(conversations)))


ORACLE = """
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, i)) AS t
), named AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS size,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS place FROM named
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
      list_transform(range(length(CAST(conv_id AS VARCHAR))), lambda i: CAST(ascii(CAST(conv_id AS VARCHAR)[i + 1]) AS BIGINT)),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), CAST(4294967295 AS BIGINT))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc
), keyed AS (
  SELECT c.conv_id, 0 AS part, x.place, x.id, x.size FROM convs c JOIN turns x ON x.conv_id = c.base AND x.place <= c.h
  UNION ALL SELECT c.conv_id, 1, x.place, x.id, x.size FROM convs c JOIN turns x ON x.conv_id = c.conv_id AND x.place > c.h
), whole AS (
  SELECT c.conv_id, coalesce(k.ids, []) AS ids, coalesce(k.sizes, []) AS sizes FROM convs c LEFT JOIN (
    SELECT conv_id, list(id ORDER BY part, place) AS ids, list(size ORDER BY part, place) AS sizes FROM keyed GROUP BY conv_id) k USING (conv_id)
), steps AS (
  SELECT conv_id, depth, ids[1:depth] AS path, CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS size, len(ids) = depth AS ends
  FROM (SELECT *, unnest(range(len(ids) + 1)) AS depth FROM whole)
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM steps GROUP BY path, depth
), children AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), above AS (
  SELECT n.path[1:d] AS path, CAST(count(*) FILTER (WHERE c.n_children IS NULL) AS BIGINT) AS n_leaves,
    CAST(sum((n.n_convs - 1) * n.size) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM nodes) n LEFT JOIN children c ON c.path = n.path GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
  a.n_leaves, a.saved_tokens, n.ends_sha256
FROM nodes n JOIN above a ON a.path = n.path LEFT JOIN children c ON c.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""
