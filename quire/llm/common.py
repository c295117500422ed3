"""What the operators share: scratch tables in the cluster's shared folder, Arrow helpers, hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCAL_CHECKPOINTS = "/tmp/checkpoints"
#: Bytes of Arrow data handed to a Python worker at once.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1024
#: Rows and bytes of a table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only under a local master whose session names none."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return LOCAL_CHECKPOINTS


def python_path(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; clusters may ship it with --py-files instead."""
    home, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (home, env.get("PYTHONPATH")) if x)


class Scratch:
    """Tables written under the shared folder to cut lineage; a lost executor costs a reread, not a recomputation."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, f"{shared_dir(spark)}/quire/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
        python_path(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write df as the table name and read it back."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def forget(self) -> None:
        """Let the driver find plans that nothing refers to any more, so that executors delete their shuffle files."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def _bytes_of(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in a row, whatever its type holds."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value) + 16
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(value, F.lit(24).cast("long"), lambda n, x: n + F.coalesce(_bytes_of(x, kind.elementType), F.lit(8)))
    elif isinstance(kind, T.StructType):
        size = sum((_bytes_of(value[f.name], f.dataType) for f in kind.fields), F.lit(8))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("long"), F.lit(8).cast("long"))


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether df has at most so many rows and bytes, both counted."""
    each = sum((_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(8).cast("long"))
    got = df.limit(rows + 1).agg(F.count("*").alias("rows"), F.sum(each).alias("size")).first()
    return got["rows"] <= rows and (got["size"] or 0) <= size


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its counted rows and bytes allow it; larger tables are shuffled."""
    return F.broadcast(df) if fits_broadcast(df, rows, size) else df


def text_bytes(docs: DataFrame) -> int:
    """Bytes of the column text, counted: the statistics of a plan know them for plain files only."""
    return docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many lines before it as no column of df needs."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, after which the worker, which Spark uses again, gives back the memory that it has freed."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # the C library has it on Linux only
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiplications and shifts that let every input bit reach every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def ranks_within(keys: np.ndarray) -> np.ndarray:
    """For each element how many equal ones stand before it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, np.int64)
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - np.repeat(first, np.diff(np.r_[first, len(keys)]))
    return out
