"""From raw documents to token ids, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, exact_dedup, near_dedup, rules
from tidemark.llm.common import read, stored
from tidemark.llm.queries import RANKS


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents of low quality, by rules learned from the labels of the raw documents."""
    model = rules.quality_model(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return rules.keep_good(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each text."""
    return exact_dedup.dedup(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, of 0.8 or more."""
    return near_dedup.dedup(docs, percent=80)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text, decode it again, and keep digests of both."""
    return bpe.digests(docs, RANKS)


STAGES = [
    ("quality_classifier", good),
    ("exact_dedup", distinct),
    ("minhash_near_dedup", unlike),
    ("benchmark_decontamination", unleaked),
    ("byte_level_bpe", tokens),
]

#: SQL can express neither the trained classifier nor the merges by rank.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{k}-{name}")
    return docs
