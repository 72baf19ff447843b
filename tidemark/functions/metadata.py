"""Columns that tell where a change came from, under names the user picks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.dates import epoch_ms_text


def change_time() -> Column:
    """S-13: change time as local text to the second; snapshot rows carry epoch 0."""
    return epoch_ms_text(F.col("ts_ms"))


# Kind in the pipeline spec -> column expression over decoded changes (S-09 .. S-13).
METADATA_KINDS: Mapping[str, Callable[[], Column]] = {
    "DATABASE": lambda: F.col("db"),
    "TABLE": lambda: F.col("tbl"),
    "SCHEMA": lambda: F.col("src_schema"),
    "BINLOG_TIME": change_time,
    "FULL_TABLE_NAME": lambda: F.concat_ws(".", F.col("db"), F.col("tbl")),
}

# Kinds whose column may be NULL; the others are NOT NULL in the target.
NULLABLE_KINDS = frozenset({"BINLOG_TIME", "SCHEMA"})


def metadata_columns(names: Mapping[str, str]) -> list[Column]:
    """S-14: ``{kind: target column}`` to aliased columns, in spec order."""
    unknown = [kind for kind in names if kind not in METADATA_KINDS]
    if unknown:
        raise ValueError(f"unknown metadata kinds: {unknown}; known: {sorted(METADATA_KINDS)}")
    return [METADATA_KINDS[kind]().alias(name) for kind, name in names.items()]
