"""Document fingerprints by a randomised edit embedding.

All texts are walked with the same coins: at time j a walk that stands on a
character c notes it and moves on if coin (j, c) says so. A walk is a string of
about twice the text's length, and texts of a small edit distance have walks of
a small Hamming distance: where they part they meet again soon. The coins have a
period of 256, no character is stood on for more than LONGEST_STAY times, and so
a walk is one table look-up a character and one byte of memory.

A fingerprint is the walk's length and what stands at SAMPLES of its times, a
byte each of a hash of the next GRAM characters. The times are those of least
priority, and the priorities are shared: of two walks the longer one's times
that the shorter one has are all among the shorter one's. The likeness of two
fingerprints is the share of the longer one's times at which both stand on the
same.

Near texts meet in bands, and none that are alike are missed. Sampled times are
dealt to one more band than there may be differences, and a time that takes
another's place as walks grow takes its band too: a band in which the longer
walk has only times of the shorter one is the same band of both, and of two
like walks one such band has no difference. A band's members are verified
against one of them, chosen by a hash, in ROUNDS rounds with other choices for
those that are not in one class yet; then all members of a band that still has
several classes are compared, class against class.

The next document comes by a sort: each task pairs neighbours in its range and
gives its first and last document, which are paired afterwards.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, mix64, small_side, text_bytes
from .jaccard import components

SAMPLES, GRAM, LONGEST_STAY = 128, 4, 15
ROUNDS, LIKE = 2, 0.8
#: Members of a band from which pairs are found in cells of two blocks, and members of a block.
MANY, BLOCK = 64, 1024
BYTES_A_PART, AT_ONCE = 48 << 20, 1 << 16
COINS, PRIORITY, BAND_SEED = np.uint64(0x5EED0001), np.uint64(0x5EED0002), np.uint64(0x5EED0003)
EVEN = np.uint64(0x9E3779B97F4A7C15)


def _next_times() -> list[list[int]]:
    """Of each class of characters and each time of the period, the time at which a walk that comes there then has moved on."""
    classes, times = np.meshgrid(np.arange(256, dtype=np.uint64), np.arange(256, dtype=np.uint64), indexing="ij")
    coins = (mix64(classes * EVEN + mix64(times + COINS)) & np.uint64(1)).astype(bool)
    out = np.empty((256, 256), np.int64)
    for t in range(256):
        stays = np.argmax(np.concatenate([coins[:, (t + np.arange(LONGEST_STAY)) % 256], np.ones((256, 1), bool)], 1), 1)
        out[:, t] = (t + np.minimum(stays + 1, LONGEST_STAY)) % 256
    return out.tolist()


NEXT = _next_times()
CLASS_OF = lambda codes: ((codes.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(13)).astype(np.uint8)
ASCII = CLASS_OF(np.arange(256)).tobytes()


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)


def walk(codes: np.ndarray, time: int = 0) -> bytes:
    """The times, modulo 256, at which a walk that begins at time has left each character."""
    classes = codes.tobytes().translate(ASCII) if codes.dtype == np.uint8 else CLASS_OF(codes).tobytes()
    table, out = NEXT, []
    for i in range(0, len(classes), AT_ONCE):
        part = bytes([time := table[c][time] for c in classes[i : i + AT_ONCE]])
        out.append(part)
    return b"".join(out)


@lru_cache(64)
def least_times(power: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Times under 2**power of the least priorities, by priority, and a few times as many as wanted; and the times' priorities."""
    found = []
    bar = np.uint64(min(1.0, 8 * wanted / 2**power) * (2**64 - 2**12)) if 2**power > 8 * wanted else np.uint64(2**64 - 1)
    for a in range(0, 1 << power, 1 << 20):
        t = np.arange(a, min(a + (1 << 20), 1 << power), dtype=np.uint64)
        p = mix64(t * EVEN + PRIORITY)
        found.append(np.stack([p[p <= bar], t[p <= bar]]))
    p, t = np.concatenate(found, 1)
    at = np.argsort(p, kind="stable")
    return t[at].astype(np.int64), p[at]


@lru_cache(4096)
def sample_times(length: int, wanted: int = SAMPLES) -> np.ndarray:
    """The wanted times under length that have the least priorities (all, if there are fewer), in order."""
    if length <= wanted:
        return np.arange(length)
    times, _ = least_times(length.bit_length(), wanted)
    return np.sort(times[times < length][:wanted])


def differences(times: int) -> int:
    """At how many of so many times two walks that are alike may differ."""
    return max(k for k in range(times + 1) if (times - k) / times >= LIKE)


BANDS = differences(SAMPLES) + 1


class Dealt:
    """The bands of all times that walks under a power of two have as samples: a time has the band of the one whose place it took."""

    def __init__(self) -> None:
        self.upto = SAMPLES
        self.band = {t: t % BANDS for t in range(SAMPLES)}
        first = mix64(np.arange(SAMPLES, dtype=np.uint64) * EVEN + PRIORITY).tolist()
        self.held = [(-p, t) for t, p in enumerate(first)]
        heapq.heapify(self.held)

    def grow(self, length: int) -> None:
        while self.upto < length:
            t = np.arange(self.upto, min(2 * self.upto, self.upto + (1 << 20)), dtype=np.uint64)
            p = mix64(t * EVEN + PRIORITY)
            low = p < np.uint64(-self.held[0][0])
            for time, priority in zip(t[low].tolist(), p[low].tolist()):
                if priority < -self.held[0][0]:
                    _, gone = heapq.heapreplace(self.held, (-priority, time))
                    self.band[time] = self.band[gone]
            self.upto += len(t)


DEALT = Dealt()


@lru_cache(4096)
def layouts(length: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ways to deal the sampled times of a walk to bands, each as the times' order by band, where bands begin, and the times' hashes.

    Walks of fewer than 64 times have fewer bands, by their power of two; where
    a longer one that may be alike has the next power, theirs too.
    """
    times, out = sample_times(length), []
    powers = {length.bit_length(), int(length / LIKE + 1).bit_length()} if length < 64 else {7}
    for salt in sorted({differences((1 << min(p, 7)) - 1) + 1 for p in powers}):
        if salt == BANDS:
            DEALT.grow(length)
            bands = np.array([DEALT.band[t] for t in times.tolist()])
        else:
            bands = times % salt
        order = np.argsort(bands, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(bands[order]) != 0])
        seeds = mix64((times[order].astype(np.uint64) * EVEN + BAND_SEED) ^ np.uint64(salt))
        out.append((order, starts, seeds))
    return out


def band_keys(packed: bytes) -> list[int]:
    """The keys of a fingerprint's bands; two that are alike share one."""
    length, values, out = int.from_bytes(packed[:6], "big"), np.frombuffer(packed, np.uint8, offset=6), []
    for order, starts, seeds in layouts(length) if length else []:
        tokens = mix64(seeds + (values[order].astype(np.uint64) + np.uint64(1)) * EVEN)
        out += mix64(np.add.reduceat(tokens, starts)).view(np.int64).tolist()
    return out


class Print:
    """A text's walk, seen at a few times."""

    def __init__(self, codes: np.ndarray, left: bytes) -> None:
        self.codes, self.left = codes, left
        times = np.frombuffer(left, np.uint8)
        ends, total = [], 0
        for i in range(0, len(times), AT_ONCE):  # lengths of stays, summed in pieces
            before = times[i - 1 : i] if i else np.zeros(1, np.uint8)
            stays = np.diff(np.r_[before, times[i : i + AT_ONCE]]).astype(np.int64)
            ends.append((i, total, stays))
            total += int(stays.sum())
        self.length = total
        self.samples = (self.seen(sample_times(total), ends) & np.uint64(255)).astype(np.uint8)

    def seen(self, times: np.ndarray, ends: list) -> np.ndarray:
        """Hashes of the characters from where the walk stands at these times."""
        order = np.argsort(times, kind="stable")
        wanted, at = times[order], np.empty(len(times), np.int64)
        for (first, begin, stays), (_, end, _) in zip(ends, [*ends[1:], (0, self.length, None)]):
            a, b = np.searchsorted(wanted, [begin, end])
            if b > a:
                at[a:b] = first + np.searchsorted(begin + np.cumsum(stays), wanted[a:b], side="right")
        where = np.empty(len(times), np.int64)
        where[order] = at
        places = where[:, None] + np.arange(GRAM)
        grams = np.where(places < len(self.codes), self.codes[np.minimum(places, len(self.codes) - 1)], 0).astype(np.uint64) if len(self.codes) else np.zeros((len(times), GRAM), np.uint64)
        h = np.zeros(len(times), np.uint64)
        for k in range(GRAM):
            h = h * EVEN + grams[:, k] + np.uint64(1)
        return mix64(h)

    def packed(self) -> bytes:
        return self.length.to_bytes(6, "big") + self.samples.tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The share of the longer walk's sampled times at which both stand on the same; 1 for two empty texts."""
    m, n = int.from_bytes(a[:6], "big"), int.from_bytes(b[:6], "big")
    if m > n:
        a, b, m, n = b, a, n, m
    x, y = np.frombuffer(a, np.uint8, offset=6), np.frombuffer(b, np.uint8, offset=6)
    if m == n:
        return float((x == y).mean()) if n else 1.0
    times = sample_times(n)
    both = times < m
    return float((x[np.searchsorted(sample_times(m), times[both])] == y[both]).sum() / len(times))


def edited(text: str, after: str) -> str:
    """The text with its last third replaced by as much of the next one's beginning."""
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


class Document:
    def __init__(self, text: str) -> None:
        self.text, self.codes = text, codes_of(text)
        self.print = Print(self.codes, walk(self.codes))
        self.packed = self.print.packed()

    def edited(self, after: str) -> tuple[str, bytes]:
        """The hash of the edited text and its fingerprint; the walk goes on from where the texts part."""
        text = edited(self.text, after)
        same = len(self.text) - len(self.text) // 3
        more = codes_of(after[: len(self.text) // 3])
        left = self.print.left[:same]
        left += walk(more, left[-1] if left else 0)
        return hashlib.sha256(text.encode()).hexdigest(), Print(codes_of(text), left).packed()


PRINTS = "kind string, part long, doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, text string"
ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def batch_of(schema: str, rows: list[dict]) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], ARROW[t]) for n, t in fields], names=[n for n, _ in fields])


def result(doc_id, mine: Document, after: str, next_packed: bytes) -> dict:
    sha, packed = mine.edited(after)
    return {"kind": "done", "doc_id": doc_id, "n_chars": len(mine.text), "edited_sha256": sha, "fingerprint": mine.packed, "edited_fingerprint": packed, "near_edited": likeness(mine.packed, packed), "near_next": likeness(mine.packed, next_packed)}


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents, each with the one after it; the first and the last of the task by themselves."""
    part, before = TaskContext.get().partitionId(), None
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            now = Document(text or "")
            if before is None:
                out.append({"kind": "first", "part": part, "fingerprint": now.packed, "text": now.text})
            else:
                out.append(result(*before, now.text, now.packed))
            before = doc_id, now
        if out:
            yield batch_of(PRINTS, out)
    if before is not None:
        yield batch_of(PRINTS, [{"kind": "last", "part": part, "doc_id": before[0], "text": before[1].text}])


def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last document of each part with the first of the next."""
    for batch in batches:
        yield batch_of(PRINTS, [result(r["doc_id"], Document(r["text"]), r["after"], r["next"]) for r in batch.to_pylist()])


def fingerprints(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """A row of PRINTS for each row of docs (doc_id, text), with the document that follows by descending doc_id; the first follows the last.

    Null text is empty. Null doc_ids come last; rows of one doc_id are ordered
    by a hash of their text, then by it. A single document follows itself. The
    fingerprint of an empty text is a length of 0 alone. Other columns are not
    read; an empty table gives no rows.
    """
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes(docs) // BYTES_A_PART))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange(parts, F.col("doc_id").desc_nulls_last(), "h").sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "h", "text")
    found = scratch.keep("prints", ordered.select("doc_id", "text").mapInArrow(neighbours, PRINTS))
    del rows, ordered
    firsts = found.where("kind = 'first'").select("part", F.col("text").alias("after"), F.col("fingerprint").alias("next"))
    order = firsts.select("part").selectExpr("part", "coalesce(lead(part) over (order by part), min(part) over ()) as next_part")  # a number a task
    lasts = found.where("kind = 'last'").select("part", "doc_id", "text").join(order, "part").drop("part")
    ends = scratch.keep("ends", lasts.join(firsts.withColumnRenamed("part", "next_part"), "next_part").mapInArrow(across, PRINTS))
    scratch.forget()  # the shuffled texts
    return found.where("kind = 'done'").unionByName(ends).drop("kind", "part", "text")


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        like = np.array([likeness(x, y) >= LIKE for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())], bool)
        yield batch.select(["a", "b"]).filter(pa.array(like))


def with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [band_keys(x) for x in batch.column("print").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("print"), pa.array(keys, pa.list_(pa.int64()))], names=["node", "print", "bands"])


def links_of_cell(cell: pa.Table) -> pa.Table:
    """Links that join the classes of a cell's members (node, print, block, component), those of its two blocks compared with each other.

    Two fingerprints agree at as many times as they have (time, byte) in
    common; members that a link has joined are compared no more.
    """
    nodes, blocks = cell.column("node").to_numpy(), cell.column("block").to_numpy()
    _, label = np.unique(cell.column("component").to_numpy(), return_inverse=True)
    prints = cell.column("print").to_pylist()
    lengths = np.array([int.from_bytes(x[:6], "big") for x in prints])
    tokens = np.full((len(prints), SAMPLES), -1, np.int64)
    for i, x in enumerate(prints):
        times = sample_times(int(lengths[i]))
        tokens[i, : len(times)] = times * 256 + np.frombuffer(x, np.uint8, offset=6)
    known, ids = np.unique(tokens, return_inverse=True)
    ids, sizes, out = ids.reshape(tokens.shape), np.minimum(lengths, SAMPLES), []
    one = len(set(blocks.tolist())) == 1
    for i in range(len(nodes)):
        others = np.flatnonzero((label != label[i]) & (one | (blocks != blocks[i])))
        others = others[others > i]
        if not len(others):
            continue
        mine = np.zeros(len(known), bool)
        mine[ids[i]] = True
        mine[0] &= known[0] >= 0  # no time
        longer = np.where(lengths[others] > lengths[i], sizes[others], sizes[i])
        for j in others[mine[ids[others]].sum(1) / longer >= LIKE].tolist():
            if label[j] != label[i]:
                out.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def rest_of_links(grouped: DataFrame, joined: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) that join the classes which still meet in a band: all members of such bands, class against class."""
    side = lambda c, p: nodes.select(F.col("node").alias(c), F.col("print").alias(p))
    now = grouped.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = now.groupBy("band").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band", "n")
    left = scratch.keep("left", now.join(mixed, "band"))
    few, many = left.where(F.col("n") <= MANY), left.where(F.col("n") > MANY)
    # the members of a small band as one row, so that pairs need no join
    ends = F.array_sort(F.collect_list(F.struct("node", "component")))
    pairs = few.groupBy("band").agg(ends.alias("m")).select(F.explode("m").alias("x"), "m").select("x", F.explode(F.filter("m", lambda y: (y.node > F.col("x.node")) & (y.component != F.col("x.component")))).alias("y"))
    pairs = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    found = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").mapInArrow(verified, "a long, b long")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = many.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cells = dealt.select("band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "block", "component").join(nodes.select("node", "print"), "node")
    return found.unionByName(cells.groupBy("band", "low", "high").applyInArrow(links_of_cell, "a long, b long"))


def classes(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of prints (fingerprint) that are like another one; a node is a fingerprint's hash.

    Equal fingerprints are one node, so copies never meet each other.
    """
    full = prints.where(F.octet_length("fingerprint") > 6).groupBy(F.xxhash64("fingerprint").alias("node")).agg(F.first("fingerprint").alias("print"))
    nodes = scratch.keep("nodes", full.mapInArrow(with_keys, "node long, print binary, bands array<long>"))
    grouped, links, joined = nodes.select("node", F.explode("bands").alias("band")), None, None
    shared = grouped.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    grouped = scratch.keep("shared", grouped.join(shared, "band"))
    side = lambda c, p: nodes.select(F.col("node").alias(c), F.col("print").alias(p))
    for k in range(ROUNDS):
        now = grouped.withColumn("component", F.col("node")) if joined is None else grouped.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        now = now.groupBy("band", "component").agg(F.min("node").alias("node"))  # one of each class a band
        heads = now.groupBy("band").agg(F.min_by("node", F.xxhash64("node", F.lit(k))).alias("a"), F.count("*").alias("n")).where("n > 1").select("band", "a")
        pairs = now.join(heads, "band").where("a <> node").select("a", F.col("node").alias("b")).distinct()
        found = scratch.keep(f"links_{k}", pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").mapInArrow(verified, "a long, b long"))
        links = found if links is None else links.unionByName(found)
        joined = components(links, scratch, f"classes_{k}")
    links = links.unionByName(scratch.keep("links_rest", rest_of_links(grouped, joined, nodes, scratch)))
    return components(links, scratch, "classes_all")


def near_classes(docs: DataFrame) -> DataFrame:
    """fingerprints() of docs with class_id: the smallest doc_id of the documents that are joined by likenesses of at least LIKE.

    Empty texts are a class of their own each; a class of null doc_ids only has
    a null id.
    """
    scratch = Scratch(docs.sparkSession, "walks")
    prints = fingerprints(docs, scratch)
    joined = classes(prints, scratch)
    keyed = prints.where(F.octet_length("fingerprint") > 6).groupBy(F.xxhash64("fingerprint").alias("node")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    named = scratch.keep("named", keyed.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = named.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("n")).where("n > 1").select("component", "class_id")
    several = scratch.keep("several", named.select("node", "component").join(small_side(least), "component").select("node", "class_id"))
    scratch.forget()
    return prints.withColumn("node", F.when(F.octet_length("fingerprint") > 6, F.xxhash64("fingerprint"))).join(small_side(several), "node", "left").withColumn("class_id", F.coalesce("class_id", "doc_id")).drop("node")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    hexed = lambda c: F.lower(F.hex(c)).alias(c)
    return found.select("doc_id", "n_chars", "edited_sha256", hexed("fingerprint"), hexed("edited_fingerprint"), "near_edited", "near_next", "class_id")
