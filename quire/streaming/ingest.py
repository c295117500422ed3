"""Texts cleaned as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators.cleanup import clean_markdown


def arrivals(spark: SparkSession, folder: str, files_at_once: int = 1000) -> DataFrame:
    """A stream (doc_id: the file's path, text) of the text files that come into folder."""
    lines = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", files_at_once).load(folder)
    return lines.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def clean_arrivals(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Repair what has arrived, score it, write Parquet, and stop; started again it takes only new files. Each row stands alone: no state is kept."""
    cleaned = clean_markdown(stream).withColumn("score", T.quality_score(F.col("text")))
    return cleaned.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
