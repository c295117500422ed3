"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, one of our own, on a local master only."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"file://{tempfile.gettempdir()}/quire-checkpoints"


def settled(df: DataFrame) -> DataFrame:
    """df as written to the checkpoint folder: later plans read it, and a lost executor costs a reread."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files of one run, where checkpoints go."""
    return f"{checkpoint_dir(spark).rstrip('/')}/quire/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table of this run where checkpoints go: computed once, and smaller than a checkpoint."""
    path = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Let the driver find plans that nothing refers to any more, so that shuffle files and checkpoints of theirs are deleted."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
