"""Binary search in a sorted array, as columns of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_count_not_above(rows: DataFrame, sorted_array: str, value: str, most: int, name: str) -> DataFrame:
    """Add ``name``: how many elements of an ascending array are not above ``value``, for arrays of up to ``most``.

    There is a projection per bit of ``most``, of plain expressions only. Spark compiles them together with the join that
    brings the array, and looks up one element each; a higher-order function would have the array copied for every row.
    The last one sits in a one-row generator: else a later filter on the result would be pushed below all of them, each
    step written out in the next.
    """
    found = rows.withColumn(name, F.lit(0))
    for bit in reversed(range(most.bit_length())):
        next_one = F.get(sorted_array, F.col(name) + F.lit((1 << bit) - 1))  # NULL behind the end
        found = found.withColumn(name, F.when(next_one <= F.col(value), F.col(name) + F.lit(1 << bit)).otherwise(F.col(name)))
    return found.select(*rows.columns, F.inline(F.array(F.struct(F.when(F.col(value).isNotNull(), F.col(name)).alias(name)))))


def count_not_above(sorted_array: Column, value: Column) -> Column:
    """The same for arrays of any size as one expression, for few rows or short arrays."""

    def step(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        goes_up = F.get(sorted_array, middle) <= value
        return F.when(s["low"] >= s["high"], s).when(goes_up, bounds(middle + 1, s["high"])).otherwise(bounds(s["low"], middle))

    def bounds(low: Column, high: Column) -> Column:
        return F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))

    bits = F.ceil(F.log2(F.size(sorted_array) + 1)).cast("int")
    start = bounds(F.lit(0), F.size(sorted_array))
    found = F.aggregate(F.sequence(F.lit(1), F.greatest(bits, F.lit(1))), start, step, lambda s: s["low"])
    return F.when(value.isNotNull(), found)
