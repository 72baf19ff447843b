"""MinHash near-dedup: a chosen-path set similarity join.

A document's set is its distinct five-word shingles, or its whole word sequence if it has fewer words. Documents of one
set form a class, and only classes are joined, recursively by chosen minwise tokens in independent trees (see
``chosen_path``). Small nodes are compared exhaustively; a large one is compared with its hub and branches on only while its
classes are not all connected, so a group of thousands of near copies costs one comparison a member and not one a pair.
Every link is confirmed on full sets, after bounds on sizes and on the agreement of 96 minwise values have cut what cannot
link. Full sets are cut into slices by hash range, and the intersections of slices are summed for each pair, so no row
grows with a document.

Recall at the threshold: a pair meets in one of eight roots in all but 3e-7 of cases (at 0.85; 3e-6 at 0.8). If all its
nodes are large and torn on every level, it is lost with 2e-6 (4e-5). The agreement asked for ahead of the exact test is five
standard deviations below the mean. What is still large below the last level goes through an exact join on the rarest shingles,
which loses no pair; what stays large there is compared exhaustively across components, so nothing is capped.

A NULL text counts as empty; without words a document has an empty set and links with nothing. Repeated rows, also with
one id for different texts, are told apart by their sets. A NULL id is never the smallest of a component with another
id. Only id and text are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial
from math import floor, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chosen_path import ChosenPaths
from tidemark.llm.common import discard, drop_rows, give_back, small, stored
from tidemark.llm.linking import agreement

WORDS = 5
VALUES = 96
_rng = np.random.default_rng(85)
SLICE = 512  # items of a slice, about
SEGMENT = 4 << 20

_MUL = _rng.integers(0, 1 << 32, VALUES, np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, VALUES, np.uint32)
_ROLL = _rng.integers(0, 1 << 63, WORDS, np.uint64) | np.uint64(1)
_BLANK = re.compile(rb"[ \t-\r]")


def agree(percent: int) -> int:
    """In how many minwise values a pair must agree: five standard deviations below the mean at the threshold."""
    like = percent / 100
    return max(0, floor(VALUES * like - 5 * sqrt(VALUES * like * (1 - like))))


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word, with A-Z lower-cased; words end at ASCII white space. Long texts are cut between words."""
    found, at = [], 0
    while at < len(data):
        cut = _BLANK.search(data, at + SEGMENT) if len(data) - at > SEGMENT else None
        end = cut.end() if cut else len(data)
        words = data[at:end].lower().split()
        found.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingles(data: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = word_hashes(data)
    if not len(words):
        return words
    size = min(WORDS, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        mixed += words[k : len(words) - size + 1 + k] * _ROLL[k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def minwise(hashes: np.ndarray) -> np.ndarray:
    best = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(low), 4096):
        part = low[None, at : at + 4096] * _MUL[:, None] + _ADD[:, None]
        np.minimum(best, part.min(1), out=best)
    return best


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, tid, data -> doc_id, tid, n, key, sig, brief"""
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.slice(at, 2000)
            sizes, keys, sigs = [], [], []
            for data in part.column(2):  # one text at a time
                hashes = shingles(data.as_py())
                sizes.append(len(hashes))
                keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                sigs.append(minwise(hashes))
            values = np.concatenate(sigs)
            offsets = pa.array(np.arange(0, len(values) + 1, VALUES, np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (values.view(np.int32), (values & 255).astype(np.uint8).view(np.int8))]
            columns = [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tid", "n", "key", "sig", "brief"])
    give_back()


def cut_level(n: int) -> int:
    """How often hash ranges are halved for sets of up to ``n`` items, so that a slice has about SLICE of them."""
    return ((n - 1) // SLICE).bit_length()


def _cut_level(n: Column) -> Column:
    return F.when(n <= SLICE, 0).otherwise(F.length(F.bin(F.floor((n - 1) / SLICE).cast("bigint"))))


def _slices(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """data -> key, n, level, slice, items; a set is cut as finely as any set needs that it can link with"""
    names = ["key", "n", "level", "slice", "items"]

    def made() -> pa.RecordBatch:
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in items])]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(items)))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int32(), pa.int64()))]
        return pa.RecordBatch.from_arrays([*columns, lists], names)

    rows, items, size = [], [], 0
    for batch in batches:
        for data in batch.column(0):
            hashes = shingles(data.as_py())
            n = len(hashes)
            if not n:
                continue
            key = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            for level in sorted({cut_level(n), cut_level(n * 100 // percent)}):
                which = hashes >> np.uint64(64 - level) if level else np.zeros(n, np.uint64)
                starts = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
                for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n]):
                    rows.append((key, n, level, int(which[a])))
                    items.append(hashes[a:b].view(np.int64))
                    size += b - a
                    if size > 1 << 18:
                        yield made()
                        rows, items, size = [], [], 0
    if rows:
        yield made()
    give_back()


class Join(ChosenPaths):
    """One run of the join over a table."""

    name, values = "near", VALUES

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, percent: int):
        self.percent = percent
        text = F.coalesce(docs[text_col], F.lit(""))
        given = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(text).alias("tid"), text.cast("binary").alias("data"))
        self.texts = given
        kind = docs.schema[id_col].dataType.simpleString()
        schema = f"doc_id {kind}, tid bigint, n bigint, key binary, sig array<int>, brief array<tinyint>"
        self.rows = stored(given.mapInArrow(_sketch, schema), "near-rows")
        grouped = self.rows.where("key is not null").groupBy("key").agg(
            F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "tid")).alias("at"), F.first("n").alias("n"),
            F.first("sig").alias("sig"), F.first("brief").alias("brief"))
        self.classes = stored(grouped, "near-classes")

    def sets(self, wanted: DataFrame, name: str) -> DataFrame:
        """Whole sets, in slices of one level each: ``key``, ``n``, ``items``."""
        slices = self.slices(self.classes.join(small(wanted), "key", "left_semi").select("at"), name)
        return slices.where(F.col("level") == _cut_level(F.col("n"))).select("key", "n", "items")

    def slices(self, places: DataFrame, name: str) -> DataFrame:
        """The sets of the rows at ``places`` (id and text hash), cut into slices."""
        places = stored(places.distinct().select(F.col("at.doc_id").alias("id"), F.col("at.tid").alias("hash")), f"near-wanted-{name}")
        on = self.texts["doc_id"].eqNullSafe(places["id"]) & (self.texts["tid"] == places["hash"])
        data = self.texts.join(small(places), on, "left_semi").select("data")
        schema = "key binary, n bigint, level int, slice bigint, items array<bigint>"
        cut = data.mapInArrow(partial(_slices, self.percent), schema)
        return cut.dropDuplicates(["key", "level", "slice"])  # of repeated rows

    def confirm(self, pairs: DataFrame, name: str) -> DataFrame:
        """Links among the pairs, on full sets."""
        a, b = (self.classes.select(*[F.col(c).alias(f"{c}_{x}") for c in ("key", "n", "at", "brief")]) for x in "ab")
        fit = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        both = pairs.join(a, F.col("a") == F.col("key_a")).join(b, (F.col("b") == F.col("key_b")) & fit)
        level = _cut_level(F.greatest("n_a", "n_b")).alias("level")
        likely = both.where(agreement("brief_a", "brief_b") >= agree(self.percent)).select("a", "b", "at_a", "at_b", (F.col("n_a") + F.col("n_b")).alias("sum"), level)
        likely = stored(likely, f"near-likely-{name}")
        cut = stored(self.slices(likely.select(F.explode(F.array("at_a", "at_b")).alias("at")), name), f"near-slices-{name}")
        a, b = (cut.select(F.col("key").alias(x), "level", "slice", F.col("items").alias(f"items_{x}")) for x in "ab")
        both = likely.select("a", "b", "sum", "level").join(a, ["a", "level"]).join(b, ["b", "level", "slice"])
        met = both.groupBy("a", "b", "sum").agg(F.sum(F.size(F.array_intersect("items_a", "items_b"))).alias("met"))
        links = stored(met.where(F.expr(f"100 * met >= {self.percent} * (sum - met)")).select("a", "b"), f"near-links-{name}")
        discard(cut)
        return links


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, and ``tid``, a hash of the text.

    Two sets link when 100 times their intersection is at least ``percent`` times their union.
    """
    join = Join(docs, id_col, text_col, percent)
    known = join.run()
    labelled = join.with_component(join.classes.select("key", "least_id"), known)
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = labelled.join(least, "component").select("key", "component_id")
    rows = join.rows.select("doc_id", "tid", "n", "key").join(of_class, "key", "left")
    rows = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "tid")
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "tid")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; documents without words all stay."""
    judged = stored(judge(docs, id_col, text_col, percent), "near-judged")
    dropped = judged.where("not kept").select(F.col("doc_id").alias("id"), "tid").distinct()
    kept = judged.where("kept and n_shingles > 0").groupBy(F.col("doc_id").alias("id"), "tid").agg(F.count("*").alias("n"))
    repeated = stored(kept.where("n > 1").select("id", "tid"), "near-repeated")
    tid = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return drop_rows(docs, {"id": docs[id_col], "tid": tid}, stored(dropped, "near-dropped"), repeated)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 85 * (nx.n + ny.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, b FROM reach JOIN links ON a = r
), c AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""
