"""The dealt queries, one per operator, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, exact_dedup, line_dedup, near_dedup, packing, prefix_trie, rules, sharding, site_style, spelling, toxicity, urls
from tidemark.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.judge(read(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains."""
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("tid")


def op4_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.judge(read(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.judge(read(spark, sf_dir, "documents")).drop("tid")


def op7_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extract(read(spark, sf_dir, "pages"))


def op8_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.judge(read(spark, sf_dir, "documents"))


def op9_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), RANKS)


def op11_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.judge(read(spark, sf_dir, "documents"), TOKENIZER)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.judge(read(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.judge(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_url_reputation": op1_url_reputation,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_fuzzy_line_dedup": op4_fuzzy_line_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_site_style_tree": op7_site_style_tree,
    "op8_hilbert_sharding": op8_hilbert_sharding,
    "op9_boosted_toxicity": op9_boosted_toxicity,
    "op10_byte_level_bpe": op10_byte_level_bpe,
    "op11_vector_packing": op11_vector_packing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op1_url_reputation": urls.ORACLE,
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op6_minhash_near_dedup": near_dedup.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_spelling_variants": spelling.ORACLE,
}
