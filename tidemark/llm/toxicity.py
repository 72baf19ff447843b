"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text are built-in column functions: densities of a lexicon of words and word beginnings, how often
these stand near a second person, capitals, punctuation, and obfuscation (signs inside words, stretched letters, and
lexicon words that appear only once such signs are undone). The lexicon is learned from labelled texts by log odds of
document counts, on top of a short list of insults. Trees are boosted on four fifths of the sample; the rest fits the
isotonic curve that turns their margin into a probability.

Training uses at most ``SAMPLE`` labelled rows, taken by a hash of their id, and a lexicon of at most ``ENTRIES``
entries. With rows of one label only, or none, every text gets the smoothed share of label 1 (0.5 without rows). A NULL
text counts as empty; an empty text has all features 0. Rows are scored one by one, so repeated rows, ties, NULL ids
and extra columns, whatever their names, change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.rules import held_out

SAMPLE = 12_000
ENTRIES = 400
HEADS = (4, 5, 6, 7)  # letters of the word beginnings that may enter the lexicon
ROUNDS, DEPTH, SEED = 20, 3, 11
#: Insults to start from, persons addressed, and signs that stand for letters.
INSULTS = ["clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless"]
PERSONS = ["you", "your", "yours", "you're", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "vous", "votre", "tú", "ti", "usted", "ustedes", "vosotros"]
SIGNS, MEANT = "013457@$!", "oieastasi"


@dataclass(frozen=True)
class Lexicon:
    words: tuple[str, ...]
    heads: tuple[str, ...]

    def pattern(self) -> str:
        """A word of the lexicon, or a word that begins like one of its beginnings."""
        whole = _trie(self.words)
        tail = rf"(?:{whole})(?!\p{{L}})"
        return rf"(?<!\p{{L}})(?:{tail}|{_trie(self.heads)})" if self.heads else rf"(?<!\p{{L}}){tail}"


def _trie(words) -> str:
    """An alternation in which common beginnings are tried once."""
    tree: dict = {}
    for w in words:
        node = tree
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def text(node: dict) -> str:
        ends = "" in node
        parts = [re.escape(c) + text(n) for c, n in sorted(node.items()) if c]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 and not ends else f"(?:{'|'.join(parts)})"
        return body + "?" if ends else body

    return text(tree)


def features(text: Column, lexicon: Lexicon) -> dict[str, Column]:
    """Dense features; ``text`` must not be NULL."""
    low, chars = F.lower(text), F.length(text)
    undone = F.translate(low, SIGNS, MEANT)
    words = F.regexp_count(text, F.lit(r"\S+"))
    bad = lexicon.pattern()
    persons = rf"(?<!\p{{L}})(?:{_trie(PERSONS)})(?!\p{{L}})"
    near = rf"{persons}(?:[^\p{{L}}]+\p{{L}}+){{0,3}}?[^\p{{L}}]+{bad}|{bad}\p{{L}}*(?:[^\p{{L}}]+\p{{L}}+){{0,3}}?[^\p{{L}}]+{persons}"

    def count(body: Column, pattern: str) -> Column:
        return F.regexp_count(body, F.lit(pattern)).cast("double")

    def per(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    hits = count(low, bad)
    return {
        "hits": F.log1p(hits),
        "density": per(hits, words),
        "undone": per(F.greatest(count(undone, bad) - hits, F.lit(0.0)), words),
        "near_you": per(count(low, near), words),
        "you": per(count(low, persons), words),
        "capitals": per(count(text, r"\p{Lu}"), chars),
        "shouted": per(count(text, r"(?<!\p{L})\p{Lu}{3,}(?!\p{L})"), words),
        "calls": per(count(text, r"[!?]"), chars),
        "signs": per(count(text, r"\p{L}[*@$#!0-9]+\p{L}"), words),
        "stretched": per(count(text, r"(\p{L})\1\1"), words),
        "words": F.log1p(words.cast("double")),
    }


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Words and beginnings that many texts with label 1 have and hardly any with label 0. ``rows``: ``_label, text``."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,40}"), F.lit(0)))
    heads = [F.array_distinct(F.transform("_words", lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*")))) for n in HEADS]
    rows = rows.dropDuplicates(["text"])
    each = rows.withColumn("_words", words).select("_label", F.explode(F.array_distinct(F.concat("_words", *heads))).alias("entry"))
    one, zero = F.sum("_label"), F.sum(1 - F.col("_label"))
    counted = each.groupBy("entry").agg(one.alias("one"), zero.alias("zero"))
    totals = rows.agg(F.coalesce(F.sum("_label"), F.lit(0)), F.coalesce(F.sum(1 - F.col("_label")), F.lit(0))).first()
    least = max(4.0, totals[0] / 60)  # texts; fewer may be copies of one another
    odds = F.log((F.col("one") + 0.5) / (totals[0] + 1)) - F.log((F.col("zero") + 0.5) / (totals[1] + 1))
    picked = counted.where(F.col("one") >= least).withColumn("odds", odds).where("odds > 2.5")
    best = picked.orderBy(F.desc(F.col("odds") * F.sqrt("one")), "entry").limit(ENTRIES).collect()  # at most ENTRIES
    heads = sorted({r["entry"][:-1] for r in best if r["entry"].endswith("*")})
    heads = [h for h in heads if not any(h != g and h.startswith(g) for g in heads)]
    words = sorted({r["entry"] for r in best if not r["entry"].endswith("*")} | set(INSULTS))
    return Lexicon(tuple(w for w in words if not any(w.startswith(h) for h in heads)), tuple(heads))


@dataclass
class Scorer:
    share: float
    lexicon: Lexicon | None = None
    trees: GBTClassificationModel | None = None
    curve: tuple[tuple[float, float], ...] = ()

    def margins(self, docs: DataFrame, text_col: str) -> DataFrame:
        """``docs`` with ``_margin``, the trees' probability before calibration."""
        made = features(F.coalesce(docs[text_col], F.lit("")), self.lexicon)
        given = docs.select(*[docs[c] for c in docs.columns], *[c.cast("double").alias(f"_feature_{n}") for n, c in made.items()])
        packed = VectorAssembler(inputCols=[f"_feature_{n}" for n in made], outputCol="_features").transform(given)
        scored = self.trees.transform(packed)
        return scored.select(*docs.columns, vector_to_array("_probability")[1].alias("_margin"))

    def score(self, docs: DataFrame, text_col: str = "text", score_col: str = "score") -> DataFrame:
        """``docs`` with a score from 0 to 1. A thousandth of it is the margin itself, which orders ties of the curve."""
        if self.trees is None:
            return docs.withColumn(score_col, F.lit(self.share))
        scored = self.margins(docs, text_col)
        m, (first, *rest) = F.col("_margin"), self.curve
        level, last = F.lit(first[1]), first
        for x, y in rest:
            between = last[1] + (m - last[0]) * ((y - last[1]) / (x - last[0])) if x > last[0] else F.lit(y)
            level = F.when(m > last[0], F.when(m < x, between).otherwise(y)).otherwise(level)
            last = (x, y)
        return scored.select(*docs.columns, (0.999 * level + 0.001 * m).alias(score_col))


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text") -> Scorer:
    """Learn from ``labels`` (id and 0 or 1); the caller leaves out what is to be held out."""
    known = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("double").alias("_label"))
    known = known.where("_id is not null and _label in (0, 1)").orderBy(F.xxhash64("_id"), "_id", "_label").limit(SAMPLE)
    texts = docs.select(docs[id_col].alias("_doc"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    given = texts.join(F.broadcast(known), F.col("_doc") == F.col("_id")).drop("_doc")  # at most SAMPLE rows
    rows = stored(given.repartition(F.col("_id")), "toxic-sample")
    counts = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}  # two rows
    zero, one = counts.get(0.0, 0), counts.get(1.0, 0)
    share = (one + 1) / (zero + one + 2) if zero or one else 0.5
    if not zero or not one:
        return Scorer(share)
    lexicon = learn_lexicon(rows)
    made = features(F.col("text"), lexicon)
    part = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(5)).alias("_part")
    table = stored(rows.select("_label", part, *[c.cast("double").alias(f"_feature_{n}") for n, c in made.items()]), "toxic-features")
    packed = VectorAssembler(inputCols=[f"_feature_{n}" for n in made], outputCol="_features").transform(table).select("_label", "_part", "_features")
    grow = packed.where("_part > 0")
    if grow.select("_label").distinct().count() < 2:
        grow = packed
    boost = GBTClassifier(
        labelCol="_label", featuresCol="_features", predictionCol="_prediction", maxIter=ROUNDS, maxDepth=DEPTH,
        stepSize=0.2, seed=SEED).setProbabilityCol("_probability").setRawPredictionCol("_raw")
    trees = boost.fit(grow.coalesce(4))
    check = trees.transform(packed.where("_part = 0")).select("_label", vector_to_array("_probability")[1].alias("_margin"))
    if check.select("_label").distinct().count() < 2:
        return Scorer(share, lexicon, trees, ((0.0, 0.0), (1.0, 1.0)))
    iso = IsotonicRegression(labelCol="_label", featuresCol="_margin").fit(check)
    curve = tuple(zip(iso.boundaries.toArray().tolist(), iso.predictions.toArray().tolist()))
    return Scorer(share, lexicon, trees, _thinned(curve))


def _thinned(curve: tuple[tuple[float, float], ...]) -> tuple[tuple[float, float], ...]:
    """The curve without points on a level between two others."""
    return tuple(p for k, p in enumerate(curve) if k in (0, len(curve) - 1) or not curve[k - 1][1] == p[1] == curve[k + 1][1])


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    model = train(docs, labels.where(~held_out(F.col("doc_id"), 5, 0)), "toxic")
    scored = model.score(docs.select("doc_id", "text"))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
