"""Conversions that only touch what has changed: a log of content hashes, compared with what there is now.

The log takes rows at its end and none is rewritten: (name, hash, method, at).
A book's last row counts. Its rows are written when its files are published, so
a run that dies in between converts some books once more and loses none; rows
of a run that wrote only a part of them are true by themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

#: In the folder of results; readers of files pass over names that begin so.
LOG = "_manifest"
ROW = "name string, hash string, method string, at timestamp"


def hashes(files: DataFrame, method: str = "text", name: str = "name", content: str = "content") -> DataFrame:
    """(name, hash, method) of files; contents stay where they are read. A null content is hashed as an empty one; of rows of one name the least hash counts."""
    whole = F.sha2(F.coalesce(F.col(content).cast("binary"), F.lit(b"")), 256)
    return files.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.min(whole).alias("hash")).withColumn("method", F.lit(method))


def last(spark: SparkSession, log: str) -> DataFrame:
    """(name, hash, method): the last row of each name; no log is an empty one, a name whose hash is null has gone."""
    try:
        rows = spark.read.schema(ROW).parquet(log)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], ROW)
    best = rows.where("name is not null").groupBy("name").agg(F.max(F.struct("at", "hash", "method")).alias("last"))
    return best.select("name", "last.hash", "last.method").where("hash is not null")


def compared(now: DataFrame, before: DataFrame) -> DataFrame:
    """(name, state, hash, method): new, changed (content or method), same or gone; hash and method are today's, null for what has gone."""
    old = before.select("name", F.col("hash").alias("__hash"), F.col("method").alias("__method"))
    same = F.col("hash").eqNullSafe(F.col("__hash")) & F.col("method").eqNullSafe(F.col("__method"))
    state = F.when(F.col("__hash").isNull(), "new").when(F.col("hash").isNull(), "gone").when(same, "same").otherwise("changed")
    return now.join(old, "name", "full").select("name", state.alias("state"), "hash", "method")


def record(delta: DataFrame, log: str) -> None:
    """What compared() found, at the end of the log; what is the same needs no row."""
    delta.where("state <> 'same'").select("name", "hash", "method", F.current_timestamp().alias("at")).write.mode("append").parquet(log)
