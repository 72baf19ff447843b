"""Quality classifier as a sparse rule ensemble.

Statistics of a text are built-in column functions over the whole text. Shallow trees are grown on them, every path from
a root becomes a conjunctive rule, and a logistic regression with a lasso penalty keeps few of the rules. These are
compiled into one column expression, so scoring is a projection: no join, no shuffle, no Python.

Training uses at most ``SAMPLE`` labelled rows, taken by a hash of their id. With rows of one label only, or none,
every text gets the same score, the smoothed share of label 1 (0.5 without rows). A NULL text counts as empty; an empty
text has all statistics 0 and is scored like any other. Rows are scored one by one, so repeated rows, ties, NULL ids
and extra columns, whatever their names, change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SAMPLE = 20_000
TREES, DEPTH, LASSO, SEED = 16, 3, 0.001, 7


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that do not depend on language, source or id. ``text`` must not be NULL."""
    words, lines = F.filter(F.split(text, r"\s+"), lambda w: w != ""), F.split(text, "\n")
    chars, n_words, n_lines = F.length(text), F.size(words), F.size(lines)

    def per(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    solid = F.regexp_count(text, F.lit(r"\S"))
    return {
        "chars": F.log1p(chars.cast("double")),
        "words": F.log1p(n_words.cast("double")),
        "word_length": per(solid, n_words),
        "upper": per(F.regexp_count(text, F.lit(r"\p{Lu}")), chars),
        "digits": per(F.regexp_count(text, F.lit(r"[0-9]")), chars),
        "marks": per(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,]")), chars),
        "mark_runs": per(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,]{2,}")), n_words),
        "lone_marks": per(F.regexp_count(text, F.lit(r"(?<!\S)[^\p{L}\p{N}\s]+(?!\S)")), n_words),
        "stops": per(F.regexp_count(text, F.lit(r"[.,]")), n_words),
        "distinct_words": per(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": per(F.size(F.array_distinct(lines)), n_lines),
        "line_words": F.log1p(per(n_words, n_lines)),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of bounds ``(name, "<=" or ">", value)`` and its weight."""

    bounds: tuple[tuple[str, str, float], ...]
    weight: float = 0.0

    def holds(self, prefix: str = "") -> Column:
        tests = (F.col(prefix + n) <= v if op == "<=" else F.col(prefix + n) > v for n, op, v in self.bounds)
        return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    rules: tuple[Rule, ...]

    def logit(self, prefix: str = "") -> Column:
        terms = [F.when(r.holds(prefix), r.weight).otherwise(0.0) for r in self.rules]
        return reduce(lambda a, b: a + b, terms, F.lit(self.intercept))

    def score(self, docs: DataFrame, text_col: str = "text", score_col: str = "score") -> DataFrame:
        """``docs`` with a score from 0 to 1."""
        stats = statistics(F.coalesce(docs[text_col], F.lit("")))
        names = [n for n in stats if any(n == b[0] for r in self.rules for b in r.bounds)]
        given = docs.select(*[docs[c] for c in docs.columns], *[stats[n].cast("double").alias(f"_stat_{n}") for n in names])
        return given.select(*docs.columns, (1 / (1 + F.exp(-self.logit("_stat_")))).alias(score_col))


def paths(model) -> list[Rule]:
    """The rule of every node but the roots, without repeats."""
    names, found = [n for n in statistics(F.lit(""))], {}

    def walk(node, bounds) -> None:
        if bounds:
            found[_tight(bounds)] = None
        if node.subtreeDepth() > 0:
            split = node.split()
            name, value = names[split.featureIndex()], float(split.threshold())
            walk(node.leftChild(), (*bounds, (name, "<=", value)))
            walk(node.rightChild(), (*bounds, (name, ">", value)))

    for tree in model.trees:
        walk(tree._call_java("rootNode"), ())
    return [Rule(b) for b in found]


def _tight(bounds: tuple) -> tuple:
    """The strictest bound of each name and direction, in a fixed order."""
    best: dict[tuple[str, str], float] = {}
    for name, op, value in bounds:
        pick = min if op == "<=" else max
        best[name, op] = pick(best.get((name, op), value), value)
    return tuple(sorted((n, op, v) for (n, op), v in best.items()))


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text") -> Ensemble:
    """Learn from ``labels`` (id and 0 or 1); the caller leaves out what is to be held out."""
    known = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("double").alias("_label"))
    known = known.where("_id is not null and _label in (0, 1)").orderBy(F.xxhash64("_id"), "_id", "_label").limit(SAMPLE)
    stats = statistics(F.col("_text"))
    names = list(stats)
    texts = docs.select(docs[id_col].alias("_doc"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    given = texts.join(F.broadcast(known), F.col("_doc") == F.col("_id"))  # at most SAMPLE rows
    rows = stored(given.select("_label", *[stats[n].cast("double").alias(n) for n in names]), "rules-sample")
    counts = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}  # two rows
    zero, one = counts.get(0.0, 0), counts.get(1.0, 0)
    if not zero or not one:
        return Ensemble(log((one + 1) / (zero + 1)), ())
    packed = VectorAssembler(inputCols=names, outputCol="_stats").transform(rows).select("_label", "_stats", *names)
    forest = RandomForestClassifier(
        labelCol="_label", featuresCol="_stats", numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64,
        featureSubsetStrategy="0.5", minInstancesPerNode=max(1, min(20, (zero + one) // 100)))
    rules = paths(forest.fit(packed))
    if not rules:
        return Ensemble(log((one + 1) / (zero + 1)), ())
    marked = packed.select("_label", *[r.holds().cast("double").alias(f"r{k}") for k, r in enumerate(rules)])
    marked = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="_rules").transform(marked).select("_label", "_rules")
    lasso = LogisticRegression(labelCol="_label", featuresCol="_rules", elasticNetParam=1.0, regParam=LASSO, maxIter=60)
    model = lasso.fit(marked.cache())
    marked.unpersist()
    weights = model.coefficients.toArray().tolist()
    kept = tuple(Rule(r.bounds, w) for r, w in zip(rules, weights) if abs(w) > 1e-6)
    return Ensemble(float(model.intercept), kept)


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % modulus == remainder, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame) -> Ensemble:
    """Learned from the labels whose id is not held out."""
    return train(docs, labels.where(~held_out(F.col("doc_id"), 3, 1)), "quality")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    scored = quality_model(docs, labels).score(docs.select("doc_id", "text"))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Ensemble) -> DataFrame:
    """The rows of ``docs`` that the model does not reject."""
    return model.score(docs, score_col="_score").where("_score >= 0.5").select(*docs.columns)
