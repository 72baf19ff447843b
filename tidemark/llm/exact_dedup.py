"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after lower-casing A-Z. Each pass looks only at what the cheaper key before it
has left in groups of two or more, so full contents are hashed for texts alone that share length and prefix with
another. All of it is built-in column functions; groups are counted with partial aggregation, so a group with a third
of all rows costs each task one row.

A NULL text counts as empty, and empty texts are equal. Of equal texts the row with the largest ``doc_id`` stays, a
NULL id last of all; of rows that also share the id, one stays. Only the id and the text are read, so other columns do
not matter, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, drop_rows, small, stored

PREFIX = 96  # characters


def normalised(docs: DataFrame, text_col: str):
    return ascii_lower(F.coalesce(docs[text_col], F.lit("")))


def repeated_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text that occurs more than once: ``sha``, ``keep_id``, ``group_size``, and ``repeats``, the rows that
    share text and id with the one that stays."""
    text = F.coalesce(docs[text_col], F.lit(""))
    length = F.octet_length(text).alias("size")
    lengths = stored(docs.select(length).groupBy("size").agg(F.count("*").alias("n")).where("n > 1"), "exact-lengths")
    sized = docs.select(docs[id_col].alias("id"), length, text.alias("body"))
    first = sized.join(small(lengths), "size", "left_semi")
    prefixed = first.withColumn("prefix", F.xxhash64(ascii_lower(F.substring("body", 1, PREFIX))))
    heads = prefixed.groupBy("size", "prefix").agg(F.count("*").alias("n")).where("n > 1")
    heads = stored(heads, "exact-prefixes")
    second = prefixed.join(small(heads), ["size", "prefix"], "left_semi")
    full = second.select("id", F.sha2(ascii_lower(F.col("body")), 256).alias("sha"))
    each = full.groupBy("sha", "id").agg(F.count("*").alias("n"))
    best = each.groupBy("sha").agg(F.max(F.struct("id", "n")).alias("best"), F.sum("n").alias("group_size"))
    found = best.where("group_size > 1").select("sha", F.col("best.id").alias("keep_id"), "group_size", F.col("best.n").alias("repeats"))
    return stored(found, "exact-groups")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    groups = repeated_texts(docs, id_col, text_col)
    rows = docs.select(docs[id_col].alias("doc_id"), F.sha2(normalised(docs, text_col), 256).alias("text_sha256"))
    rows = rows.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n"))  # rows that are the same in both
    met = rows.join(small(groups), rows["text_sha256"] == groups["sha"], "left")
    met = met.select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
    stays = F.col("sha").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return met.select(
        "doc_id",
        F.when(F.col("sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (stays & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text."""
    groups = repeated_texts(docs, id_col, text_col)
    sha = F.sha2(normalised(docs, text_col), 256)
    rows = docs.select(docs[id_col].alias("id"), sha.alias("sha"))
    copies = rows.join(small(groups), "sha").where(~F.col("id").eqNullSafe(F.col("keep_id"))).select("id", "sha").distinct()
    dropped = stored(copies, "exact-dropped")
    repeated = groups.where("repeats > 1").select(F.col("keep_id").alias("id"), "sha")
    return drop_rows(docs, {"id": docs[id_col], "sha": sha}, dropped, repeated)


ORACLE = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (
  SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""
