"""Places in an order, and values carried along it, without a task that holds a whole key.

Rows are sorted by ranges of (keys, order), so a key with a third of all rows
lies in many partitions. What one partition must know of those before it is one
row for each key that it holds: a count or a last value. These few rows are
summed by a window, and given back to their partition by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settled

AT, PART = "__at", "__part"


def in_ranges(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """rows with AT, a number that follows the sort by keys and order, and PART, the range that they lie in; written once, as both must stay the same."""
    by = [*(F.col(k) for k in keys), *order]
    placed = settled(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id()))
    return placed.withColumn(PART, F.shiftright(AT, 33))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left joined with the columns of right, one row a key and range; null keys are equal."""
    renamed = right.withColumnsRenamed({c: f"__{c}" for c in (*keys, PART)})
    on = F.col(PART) == F.col(f"__{PART}")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(renamed, on, "left").drop(*(f"__{c}" for c in (*keys, PART)))


def number_rows(rows: DataFrame, keys: list[str], order: list[Column | str], name: str = "n") -> DataFrame:
    """rows with their places, from 1, within their keys by order, under a name that rows has not.

    Null keys are a key; rows that are equal in order are numbered in any way,
    each number once. An empty table gives no rows.
    """
    placed = in_ranges(rows, keys, order)
    runs = placed.groupBy(*keys, PART).agg(F.min(AT).alias("__first"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select(*keys, PART, (before - F.col("__first") + 1).alias("__shift"))
    return _same(placed, starts, keys).withColumn(name, F.col(AT) + F.col("__shift")).select(*rows.columns, name)


def carry_last(rows: DataFrame, key: str, order: list[Column | str], value: str, name: str) -> DataFrame:
    """rows with the last value, up to and with their own, that is not null within their key by order."""
    placed = in_ranges(rows, [key], order)
    ends = placed.where(F.col(value).isNotNull()).groupBy(key, PART).agg(F.max_by(value, AT).alias("__end"))
    every = placed.select(key, PART).distinct()
    held = _same(every, ends, [key])
    before = F.last("__end", ignorenulls=True).over(Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    held = held.select(key, PART, before.alias("__before"))
    own = F.last(value, ignorenulls=True).over(Window.partitionBy(key, PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return _same(placed.withColumn("__own", own), held, [key]).withColumn(name, F.coalesce("__own", "__before")).select(*rows.columns, name)
