"""Token ids as a grammar-compressed binary table with random access.

Layout of the table (one row is a shard, a run of whole documents in
ascending doc_id order):

    part, shard   place of the shard in the order (part first)
    n_docs        documents in it
    n_tokens      ids in it
    doc_ids       little-endian signed 64-bit integers; null_ids has a byte 1 for each null id
    doc_lens      little-endian unsigned 64-bit integers, ids per document
    rules         pairs of little-endian unsigned 16-bit symbols; rule r defines symbol base + r
    lengths       little-endian unsigned 32-bit integers, ids that each rule expands to
    symbols       the compressed sequence, little-endian unsigned 16-bit symbols

Symbol END stands for a document's end id and is in no rule, so that every
document begins at a symbol. The shard is written as a row of a Parquet table,
so that any store that Spark can write will do.

Re-Pair runs in rounds. A round counts all adjacent pairs of the shard, takes
the most frequent ones as new rules and replaces their occurrences from left
to right; where two chosen pairs overlap, the more frequent one wins. Rounds go
on until no pair is frequent or the 16-bit symbols are all but used up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, small_side, text_bytes, utf8
from .tokens import encoder

END = 0xFFFF
SHARD_TOKENS = 1 << 20
RULES_A_ROUND, LEAST_COUNT, LEAST_ROOM = 8192, 8, 256
SHARDS = "part int, shard int, n_docs int, n_tokens long, base int, doc_ids binary, null_ids binary, doc_lens binary, rules binary, lengths binary, symbols binary"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"
SLOT_BITS, NONE = 17, np.int32(1 << 30)


def slots(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)


def frequent_pairs(keys: np.ndarray, least: int, most: int) -> np.ndarray:
    """The pairs that occur at least so often, most frequent first, equals by a hash: were these in order, a repeated passage whose symbols ascend would give one rule a round. A sort of 32-bit keys is cheaper than a table of all pairs."""
    ordered = np.sort(keys)
    ends = np.r_[np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, len(ordered)] if len(ordered) else np.zeros(0, np.int64)
    counts = np.diff(ends, prepend=0)
    often = counts >= least
    found, counts = ordered[ends[often] - 1], counts[often]
    mixed = (found ^ found >> np.uint32(15)) * np.uint32(0x85EBCA6B)
    return found[np.lexsort((mixed ^ mixed >> np.uint32(13), -counts))[:most]]


def ranks_of(keys: np.ndarray, slot: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The place of each key among the chosen ones, which all differ, or NONE. Chosen ones that share a slot are looked up one after the other."""
    table, out = np.full(1 << SLOT_BITS, -1, np.int32), np.full(len(keys), NONE, np.int32)
    own, left = slots(chosen), np.arange(len(chosen), dtype=np.int32)
    table[own] = left
    at = table[slot]
    where = np.flatnonzero(at >= 0)
    at = at[where]
    while True:
        same = chosen[at] == keys[where]
        out[where[same]] = at[same]
        left, where = left[table[own[left]] != left], where[~same]
        if not len(left):
            return out
        table[own[left]] = left
        at = table[slot[where]]


def in_runs(ranks: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of the places in a run of one pair (as of a symbol that is repeated), every other one after the run's first; the first is taken or not by what stands before it."""
    at = np.flatnonzero((ranks == before) & (ranks != NONE))
    if not len(at):
        return at
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    offset = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at))) + 1
    start = at - offset
    return at[(offset % 2 == np.where(ranks[start] < before[start], 0, 1)) & (ranks[at] <= after[at])]


def compress(symbols: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (16 bits, END after each document) to compressed symbols, rules and the rules' expansion lengths.

    Ends when no pair occurs LEAST_COUNT times any more, or when the 16-bit
    symbols are used up but for LEAST_ROOM, which would cost as many rounds
    as all others.
    """
    rules: list[np.ndarray] = []
    made, sizes = 0, np.ones(1 << 16, np.uint32)
    while (room := END - base - made) > LEAST_ROOM and len(symbols) > 1:
        keys = symbols[:-1].astype(np.uint32) << np.uint32(16) | symbols[1:]
        free = (symbols[:-1] != END) & (symbols[1:] != END)
        chosen = frequent_pairs(keys[free], LEAST_COUNT, min(room, RULES_A_ROUND))
        if not len(chosen):
            break
        ranks = ranks_of(keys, slots(keys), chosen)
        before, after = np.r_[NONE, ranks[:-1]], np.r_[ranks[1:], NONE]
        taken = np.flatnonzero((ranks < before) & (ranks <= after))
        if len(more := in_runs(ranks, before, after)):
            taken = np.sort(np.r_[taken, more])
        used = np.flatnonzero(np.bincount(ranks[taken], minlength=len(chosen)))
        new = np.zeros(len(chosen), np.int64)
        new[used] = np.arange(len(used))
        rules.append(chosen[used])
        sizes[base + made : base + made + len(used)] = sizes[chosen[used] >> np.uint32(16)] + sizes[chosen[used] & np.uint32(0xFFFF)]
        symbols = symbols.copy()
        symbols[taken] = (base + made + new[ranks[taken]]).astype(np.uint16)
        stays = np.ones(len(symbols), bool)
        stays[taken + 1] = False
        symbols = symbols[stays]
        made += len(used)
    rule = np.concatenate(rules) if rules else np.zeros(0, np.uint32)
    return symbols, rule, sizes[base : base + made]


class Shard:
    """A shard opened for reading: whole, or any range of its ids."""

    def __init__(self, base: int, rules: bytes, lengths: bytes, symbols: bytes, end_id: int) -> None:
        self.symbols = np.frombuffer(symbols, "<u2")
        rule, self.lengths = np.frombuffer(rules, "<u2").reshape(-1, 2), np.frombuffer(lengths, "<u4")
        size = np.ones(1 << 16, np.int64)
        size[base : base + len(rule)] = self.lengths
        self.size, self.starts = size, np.r_[0, np.cumsum(size)]
        self.flat = np.empty(self.starts[-1], np.uint32)  # every symbol's expansion
        self.flat[self.starts[:-1]] = np.arange(1 << 16)
        self.flat[self.starts[END]] = end_id
        newest, done = rule.max(1, initial=0).astype(np.int64) - base, 0
        while done < len(rule):  # the next rules that need none of each other, at once
            later = newest[done:] >= done
            stop = done + int(np.argmax(later)) if later.any() else len(rule)
            self.flat[self.starts[base + done] : self.starts[base + stop]] = self.expand(rule[done:stop].reshape(-1))
            done = stop
        self.ends: np.ndarray | None = None

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.size[symbols]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[symbols] - (ends - n), n) + np.arange(total)]

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop: only the symbols over that range are expanded."""
        if self.ends is None:
            self.ends = np.cumsum(self.size[self.symbols])
        first, last = np.searchsorted(self.ends, start, "right"), np.searchsorted(self.ends, stop, "left")
        before = int(self.ends[first - 1]) if first else 0
        return self.expand(self.symbols[first : last + 1])[start - before : stop - before]


def encode_partition(vocabulary: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, shard = encoder(vocabulary), TaskContext.get().partitionId(), 0
        base = enc.tokenizer.get_vocab_size(with_added_tokens=True)
        ids: list[int | None] = []
        held: list[bytes] = []
        tokens = 0
        end = np.uint16(END).tobytes()

        def flush() -> pa.RecordBatch:
            nonlocal shard, ids, held, tokens
            lens = np.array([len(x) // 2 + 1 for x in held], "<u8")
            symbols, rules, lengths = compress(np.frombuffer(end.join([*held, b""]), "<u2"), base)
            pairs = np.stack([rules >> np.uint32(16), rules & np.uint32(0xFFFF)], 1).astype("<u2")
            row = {
                "part": part, "shard": shard, "n_docs": len(held), "n_tokens": int(lens.sum()), "base": base,
                "doc_ids": np.array([x or 0 for x in ids], "<i8").tobytes(), "null_ids": bytes(x is None for x in ids), "doc_lens": lens.tobytes(),
                "rules": pairs.tobytes(), "lengths": lengths.astype("<u4").tobytes(), "symbols": symbols.astype("<u2").tobytes(),
            }
            shard, ids, held, tokens = shard + 1, [], [], 0
            schema = [("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("base", pa.int32()), *((c, pa.binary()) for c in ("doc_ids", "null_ids", "doc_lens", "rules", "lengths", "symbols"))]
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(schema))

        for batch in batches:
            for doc, coded in zip(batch.column(0).to_pylist(), enc.encode(utf8(batch, "text"))):
                ids.append(doc)
                held.append(coded)
                tokens += len(held[-1]) // 2 + 1
                if tokens >= shard_tokens:
                    yield flush()
        if held:
            yield flush()

    return run


def decode_partition(end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Shard(row["base"], row["rules"], row["lengths"], row["symbols"], end_id)
                ids = ids.expand(ids.symbols).astype("<u4")
                lens = np.frombuffer(row["doc_lens"], "<u8").astype(np.int64)
                ends = np.cumsum(lens)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.frombuffer(row["null_ids"], np.uint8).astype(bool)),
                        pa.array(row["first"] + ends - lens),
                        pa.array(lens),
                        pa.array([zlib.crc32(ids[e - n : e].data) for e, n in zip(ends.tolist(), lens.tolist())], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def write_ids(docs: DataFrame, scratch: Scratch, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, shard_tokens: int = SHARD_TOKENS, bytes_a_part: int = 24 << 20) -> DataFrame:
    """Encode docs (doc_id, text) and write the shards; the table of shards as read back.

    Null text is empty (the end id alone); null doc_ids come first; rows with
    equal doc_id are ordered by a hash of their text, then by it, so they may
    go to several tasks. Other columns are not read. An empty table gives an
    empty table.
    """
    spark = docs.sparkSession
    size = text_bytes(docs)
    parts = max(-(-size // bytes_a_part), 2 * spark.sparkContext.defaultParallelism) if size > 1 << 20 else 1
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    ordered = ordered.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "h").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", "text").drop("h")
    return scratch.keep("shards", ordered.mapInArrow(encode_partition(vocabulary, end_id, shard_tokens), SHARDS))


def read_ids(shards: DataFrame, end_id: int = 2) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, decoded from the shards.

    Starts are summed first per part (a row for each task that wrote), then in
    each part, so that no task holds more than the shards' counts of one part.
    """
    sizes = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sizes.selectExpr("part", "sum(n) over (order by part rows between unbounded preceding and 1 preceding) as before_part")
    firsts = shards.select("part", "shard", "n_tokens").join(small_side(before), "part").selectExpr(
        "part", "shard", "coalesce(before_part, 0) + coalesce(sum(n_tokens) over (partition by part order by shard rows between unbounded preceding and 1 preceding), 0) as first"
    )
    return shards.join(small_side(firsts), ["part", "shard"]).select("first", "base", "doc_ids", "null_ids", "doc_lens", "rules", "lengths", "symbols").mapInArrow(decode_partition(end_id), RESULT)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ids(write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "op1")))
