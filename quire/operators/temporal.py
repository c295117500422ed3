"""Rows matched by the nearest earlier time, and windows of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import carry_last


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, columns: list[str]) -> DataFrame:
    """left with columns of the last row of right that has its key and no later time; null where there is none.

    Both sides go through one sort by ranges of key and time, never through
    pairs, and a key with many rows through many tasks. A row
    with a null key or time matches nothing; of rows of right with one key and
    time the one with the greatest columns counts.
    """
    value = F.struct(*columns)
    once = right.where(F.col(time).isNotNull()).groupBy(key, time).agg(F.max(value).alias("value"))
    rows = left.select(F.struct(*left.columns).alias("row"), F.col(key).alias("k"), F.col(time).alias("at"), F.lit(None).cast(once.schema["value"].dataType).alias("value"))
    rows = rows.unionByName(once.select(F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.col(key).alias("k"), F.col(time).alias("at"), "value"))
    rows = rows.withColumn("own", F.col("row").isNotNull())
    found = carry_last(rows.where("k is not null and at is not null"), "k", ["at", "own"], "value", "last")  # right's rows of one time come first
    alone = rows.where("own and (k is null or at is null)").withColumn("last", F.lit(None).cast(once.schema["value"].dataType))
    return found.where("own").unionByName(alone).select("row.*", *(F.col(f"last.{c}").alias(c) for c in columns))
