"""Benchmark decontamination by SimHash over item-sized windows.

Texts and items are lower-cased and cut into words; a run of five words is a shingle. A window has as many words as an
item. Windows and items get 64-bit SimHash fingerprints in which a shingle weighs as often as it occurs. Fingerprints
are cut into eight blocks: two that differ in at most 18 bits differ in at most two bits in one block at least, so an
index of the block values of all items, each with every change of up to two bits, finds all items within that radius.
Candidates are confirmed by the exact weighted Jaccard similarity of their shingles, 0.8 or more.

A document with fewer words than an item is one window as a whole; it may hold the better part of the item.

Ahead of the fingerprints stands a bound that loses nothing: a window at 0.8 shares eight ninths of its shingles with
the item, so windows in which fewer of the shingles are any item's need no fingerprint.

Documents are read once for each block of items, of bounded size; the block's index goes to all tasks. Nothing is
shuffled but the found pairs. A NULL text or item has no words and matches nothing; an item of fewer than five words
matches only a document of just these words. Repeated rows give the same pairs once per distinct text. Only the named
columns are read. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations, repeat
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_rows, give_back, stored

WORDS = 5
RADIUS = 18
BLOCKS = 8
NEAR = RADIUS // BLOCKS
LEAST = 0.8
STRETCH = 4096  # window starts whose fingerprints are made at a time
ITEMS_BYTES = 4 << 20  # of item text in one pass over the documents
WORD = re.compile(r"[^\W_]+")

_ROLL = np.random.default_rng(3).integers(0, 1 << 63, WORDS, np.uint64) | np.uint64(1)
_BITS = np.arange(64, dtype=np.uint64)
_FLIPS = [sum(1 << b for b in c) for k in range(NEAR + 1) for c in combinations(range(64 // BLOCKS), k)]


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(found: list[str]) -> np.ndarray:
    """Hash of every run of five words, or of the whole sequence if it is shorter."""
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in found), np.uint64, len(found))
    size = min(WORDS, len(hashes))
    if not size:
        return hashes
    mixed = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        mixed += hashes[k : len(hashes) - size + 1 + k] * _ROLL[k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def signs(hashes: np.ndarray) -> np.ndarray:
    """One row per hash with +1 or -1 for each bit."""
    return (((hashes[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) << 1) - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BITS).sum(1, dtype=np.uint64)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard."""
    met = sum((a & b).values())
    return met / (a.total() + b.total() - met)


def _numbered(numbers: np.ndarray) -> np.ndarray:
    """A value for every run of five word numbers."""
    mixed = np.zeros(len(numbers) - WORDS + 1, np.uint64)
    for k in range(WORDS):
        mixed += numbers[k : len(mixed) + k] * _ROLL[k]
    return mixed


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


class Index:
    """Items of one block, by their size in words."""

    def __init__(self, items: list[tuple[object, str | None]], least: float = LEAST):
        self.least = least
        self.vocabulary: dict[str, int] = {}
        self.by_size: dict[int, list[tuple[object, Counter]]] = defaultdict(list)
        self.whole: dict[tuple[str, ...], list[object]] = defaultdict(list)
        runs, numbered, prints = [], [], defaultdict(list)
        for item, text in items:
            found = words(text)
            if not found:
                continue
            if len(found) < WORDS:
                self.whole[tuple(found)].append(item)
                continue
            for w in found:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
            hashes = shingles(found)
            runs.append(hashes)
            numbered.append(_numbered(np.array([self.vocabulary[w] for w in found], np.uint64)))
            prints[len(found)].append(fingerprints(signs(hashes).sum(0, keepdims=True))[0])
            self.by_size[len(found)].append((item, Counter(hashes.tolist())))
        self.runs = np.unique(np.concatenate(runs)) if runs else np.zeros(0, np.uint64)
        self.numbered = np.unique(np.concatenate(numbered)) if runs else self.runs
        self.prints = {size: np.array(p, np.uint64) for size, p in prints.items()}
        self.blocks = {size: self._blocks(p) for size, p in self.prints.items()}
        self.need = {size: ceil(2 * least / (1 + least) * (size - WORDS + 1) - 1e-9) for size in prints}
        self.widest = max(prints, default=0) - WORDS + 1
        self.least_shared = min(self.need.values(), default=0)

    def shared(self, size: int, runs: int) -> int:
        """How many of its runs a window must share with an item of a size: as wide as the item, or all of a shorter text."""
        width = size - WORDS + 1
        return self.need[size] if runs >= width else ceil(self.least * (runs + width) / (1 + self.least) - 1e-9)

    def fewest(self, runs: int) -> int:
        """The least that any item asks of a text of so many runs."""
        return min(self.shared(size, runs) for size in self.need)

    @staticmethod
    def _blocks(prints: np.ndarray) -> np.ndarray:
        """For each block and block value, the items (a mask) whose own value is within two bits of it."""
        table = np.zeros((BLOCKS, 256, len(prints)), bool)
        for block, value in enumerate(prints.view(np.uint8).reshape(-1, BLOCKS).T):  # eight blocks of eight bits
            for flip in _FLIPS:
                table[block, value ^ np.uint8(flip), np.arange(len(prints))] = True
        return table

    def within(self, size: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a fingerprint and an item of a size that differ in at most RADIUS bits: all of them, by the index."""
        table, values = self.blocks[size], found.view(np.uint8).reshape(-1, BLOCKS)
        near = table[0][values[:, 0]]
        for block in range(1, BLOCKS):
            near |= table[block][values[:, block]]
        which, items = np.nonzero(near)
        fits = np.bitwise_count(self.prints[size][items] ^ found[which]) <= RADIUS
        return which[fits], items[fits]

    def matches(self, text: str | None) -> list[tuple[object, float, int]]:
        """Items in a text, with the best similarity and the first word of its window."""
        found = words(text)
        out = [(item, 1.0, 0) for item in self.whole.get(tuple(found), ())] if len(found) < WORDS else []
        if not len(self.runs) or len(found) < WORDS:
            return out
        known = np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.uint64, len(found))
        inside = np.concatenate([[0], np.cumsum(known > 0)])
        whole = inside[WORDS:] - inside[:-WORDS] == WORDS  # runs of words that items have: few of them are an item's run
        fewest = self.least_shared if len(whole) >= self.widest else self.fewest(len(whole))
        if whole.sum() < fewest or _among(_numbered(known)[whole], self.numbered).sum() < fewest:
            return out
        hashes = shingles(found)
        hit = _among(hashes, self.runs)
        hits = np.concatenate([[0], np.cumsum(hit)])
        best: dict[object, tuple[float, int]] = {}
        starts, short = {}, []
        for size, need in self.need.items():
            width = size - WORDS + 1
            if width <= len(hashes):
                starts[size] = np.flatnonzero(hits[width:] - hits[:-width] >= need)
            elif hits[-1] >= self.shared(size, len(hashes)):
                short.append(size)
        if short:
            own = fingerprints(signs(hashes).sum(0, keepdims=True))
            for size in short:
                self._verify(size, hashes, np.zeros(1, np.int64), own, best)
        widest, lo = max(starts, default=0), min((int(s[0]) for s in starts.values() if len(s)), default=None)
        while lo is not None:
            hi = lo + STRETCH
            sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs(hashes[lo : hi + widest]), 0, np.int32)])
            for size, every in starts.items():
                own, width = every[(every >= lo) & (every < hi)], size - WORDS + 1
                if len(own):
                    self._verify(size, hashes, own, fingerprints(sums[own - lo + width] - sums[own - lo]), best)
            lo = min((int(s[s >= hi][0]) for s in starts.values() if len(s) and s[-1] >= hi), default=None)
        return out + [(item, alike, at) for item, (alike, at) in best.items()]


    def _verify(self, size: int, hashes: np.ndarray, starts: np.ndarray, prints: np.ndarray, best: dict) -> None:
        """Exact similarity of the windows whose fingerprints are near an item's; keeps the best per item."""
        for k, i in zip(*(x.tolist() for x in self.within(size, prints))):
            item, weights = self.by_size[size][i]
            if best.get(item, (0.0, 0))[0] < 1.0:
                at = int(starts[k])
                alike = similarity(Counter(hashes[at : at + size - WORDS + 1].tolist()), weights)
                if alike >= self.least and alike > best.get(item, (0.0, 0))[0]:
                    best[item] = (alike, at)


def _blocks_of(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, str | None]]]:
    """Items in blocks of bounded size."""
    block, size = [], 0
    for item, text in benchmark.select(item_col, text_col).toLocalIterator():
        if block and size + len(text or "") > ITEMS_BYTES:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text or "") + 64
    if block:
        yield block


def find(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", least: float = LEAST,
) -> DataFrame:
    """Pairs of a document and an item it contains: ``doc_id``, ``tid`` (a hash of the text), ``item_id``,
    ``similarity`` and ``first_word`` of the best window."""
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    schema = f"doc_id {kinds[0].simpleString()}, tid bigint, item_id {kinds[1].simpleString()}, similarity double, first_word bigint"
    text = F.coalesce(docs[text_col], F.lit(""))
    given = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(text).alias("tid"), text.alias("text"))
    pairs = spark.createDataFrame([], schema)
    for block in _blocks_of(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(block)
        pairs = pairs.unionByName(given.mapInArrow(_search(shared, least), schema))
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("back"))).alias("best")
    return pairs.groupBy("doc_id", "tid", "item_id").agg(best).select(
        "doc_id", "tid", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("first_word"))


def _search(shared, least: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, least)
        for batch in batches:
            rows = [(k, *m) for k, text in enumerate(batch.column(2)) for m in index.matches(text.as_py())]
            if rows:
                which, items, alike, first = zip(*rows)
                owners = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owners), batch.column(1).take(owners), pa.array(items), pa.array(alike, pa.float64()), pa.array(first, pa.int64())],
                    ["doc_id", "tid", "item_id", "similarity", "first_word"])
        give_back()

    return work


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """``docs`` without the rows that contain an item."""
    found = stored(find(docs, benchmark, id_col, text_col, **columns).select(F.col("doc_id").alias("id"), "tid").distinct(), "leaks")
    tid = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return drop_rows(docs, {"id": docs[id_col], "tid": tid}, found, found.limit(0))
