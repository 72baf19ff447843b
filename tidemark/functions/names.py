"""Table and column names: case folding and target names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_names(names: Sequence[str], case_sensitive: bool = False, table: str = "UNKNOWN") -> list[str]:
    """S-07: lower-case the names; two names that fold to one are an error."""
    if case_sensitive:
        return list(names)
    seen: set[str] = set()
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"columns of table '{table}' clash when case is ignored: '{name}'")
        seen.add(name.lower())
    return [name.lower() for name in names]


def fold_columns(df: DataFrame, case_sensitive: bool = False, table: str = "UNKNOWN") -> DataFrame:
    """S-07 on a DataFrame."""
    return df.toDF(*fold_names(df.columns, case_sensitive, table))


def image_keys(image: Column | str) -> Column:
    """Field names of a row image."""
    typed = F.col(image) if isinstance(image, str) else image
    return F.map_keys(F.try_variant_get(typed, "$", "map<string,variant>"))


def spellings(changes: DataFrame, image: str = "after") -> DataFrame:
    """S-08: each field spelling found in the row images, with its folded name and a clash flag.

    A clash is two spellings of one folded name in the *same* image. Returns one row per distinct
    ``(db, tbl, spelling)``, so it is as small as the catalog; rows are reduced map-side.
    """
    keys = image_keys(image)
    folded = F.transform(keys, F.lower)
    clash = F.size(F.array_distinct(folded)) < F.size(folded)
    return (
        changes.select("db", "tbl", F.explode(keys).alias("spelling"), clash.alias("clash"))
        .groupBy("db", "tbl", "spelling")
        .agg(F.max("clash").alias("clash"))
        .withColumn("folded", F.lower("spelling"))
    )


def target_name(
    prefix: str = "", suffix: str = "", merge_shards: bool = True, case_sensitive: bool = True,
    db: Column | str = "db", tbl: Column | str = "tbl",
) -> Column:
    """F-11: target table name from the source name. Shards keep the database in the name unless merged."""
    d, t = (F.col(c) if isinstance(c, str) else c for c in (db, tbl))
    base = t if merge_shards else F.concat(d, F.lit("_"), t)
    name = F.concat(F.lit(prefix), base, F.lit(suffix))
    return name if case_sensitive else F.lower(name)

