"""Best-fit decreasing over the whole corpus.

Lengths are whole numbers from 1 to the sequence's capacity, so the state of
best-fit decreasing is small: how many documents have each length, and which
bins are open with each remaining capacity. The driver packs this histogram,
never the documents. A segment tree over the remaining capacities finds the
tightest capacity that has an open bin in logarithmic time, and takes as many
documents of the length in hand as there are such bins. The plan that comes
out (ranges of documents of a length, to ranges of bins) has a size that the
capacity bounds, whatever the corpus; each piece finds its bin from its
length and its number among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ranks_within, tidy, utf8
from .tokens import encoder

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class OpenBins:
    """A segment tree over remaining capacities; each leaf holds ranges of bins that are open with it."""

    def __init__(self, capacity: int) -> None:
        self.n = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.n)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, n: int) -> None:
        self.ranges[room].append((first, n))
        self._change(room, n)

    def _change(self, room: int, n: int) -> None:
        i = room + self.n
        while i:
            self.count[i] += n
            i >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of an open bin that is at least length."""
        i = length + self.n
        if self.count[i]:
            return length
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.n:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.n
            i >>= 1
        return None

    def take(self, room: int, most: int) -> tuple[int, int]:
        first, n = self.ranges[room].pop()
        if n > most:
            self.ranges[room].append((first + most, n - most))
            n = most
        self._change(room, -n)
        return first, n


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(length, number of the first piece, first bin, offset) of each range; ranges of a length follow one another."""
    bins, made, plan = OpenBins(capacity), 0, []
    for length in sorted(histogram, reverse=True):
        left, nth = histogram[length], 0
        while left:
            room = bins.tightest(length)
            if room is None:
                each = capacity // length  # a new bin takes pieces of this length until another would not fit
                n = max(1, left // each)
                fit = min(each, left)
                for k in range(fit):
                    plan.append((length, nth, made, k * length))
                    nth += n
                left -= fit * n
                if capacity - fit * length:
                    bins.add(capacity - fit * length, made, n)
                made += n
            else:
                first, n = bins.take(room, left)
                plan.append((length, nth, first, capacity - room))
                nth, left = nth + n, left - n
                if room > length:
                    bins.add(room - length, first, n)
    return plan


def cut_documents(vocabulary: str, end_id: int, capacity: int):
    """Pieces of each document; nth counts the pieces of a length within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        end, seen = np.uint16(end_id).tobytes(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            docs, pieces, starts, lengths, crcs = [], [], [], [], []
            for doc, coded in zip(batch.column(0).to_pylist(), enc.encode(utf8(batch, "text"))):
                ids = np.frombuffer(coded + end, "<u2").astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    docs.append(doc)
                    pieces.append(k)
                    starts.append(a)
                    lengths.append(b - a)
                    crcs.append(zlib.crc32(ids[a:b].data))
            length = np.array(lengths, np.int32)
            nth = seen[length] + ranks_within(length) if len(length) else np.zeros(0, np.int64)
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(length), pa.array(crcs, pa.int64()), pa.array(np.full(len(docs), part, np.int32)), pa.array(nth)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )

    return run


def place(plan: list[tuple[int, int, int, int]]):
    """Bins of pieces by (length, number among all pieces of the length); the plan's size depends on the capacity only."""
    rows = np.array(sorted(plan), np.int64).reshape(-1, 4)
    shift = np.int64(1 << 48)
    keys = rows[:, 0] * shift + rows[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, nth = batch.column("length").to_numpy().astype(np.int64), batch.column("all_nth").to_numpy()
            at = rows[np.searchsorted(keys, length * shift + nth, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start")), pa.array(length), batch.column("ids_crc32"), pa.array(at[:, 2] + nth - at[:, 1]), pa.array(at[:, 3])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pack docs (doc_id, text) into sequences of at most capacity tokens.

    One row for each piece: doc_id, piece (from 0), start, length, ids_crc32,
    sequence_id, offset. Only documents longer than the capacity are cut, the
    first piece then being the shorter one. Null text is empty: its piece is
    the end id. Null and repeated doc_ids are documents like others; other
    columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.keep("pieces", docs.select("doc_id", "text").mapInArrow(tidy(cut_documents(vocabulary, end_id, capacity)), PIECES))
    counts = scratch.keep("counts", pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each length, capacity at most
    plan = best_fit_decreasing(histogram, capacity)
    before = counts.selectExpr("part", "length", "coalesce(sum(n) over (partition by length order by part rows between unbounded preceding and 1 preceding), 0) as before")
    # counts grow with tasks and lengths: joined by a shuffle of the pieces' few bytes at every size, never broadcast
    numbered = pieces.join(before.hint("merge"), ["part", "length"]).withColumn("all_nth", F.col("before") + F.col("nth"))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "all_nth").mapInArrow(tidy(place(plan)), PACKED)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
