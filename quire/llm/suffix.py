"""Removal of every byte under a string of LENGTH bytes that also starts earlier.

Starts of strings are suffixes that need ordering by their first LENGTH bytes
only. They are sorted into buckets, and buckets are refined by the buckets of
later offsets, as bucket-pointer refinement does, with two economies: suffixes
that share a pointer are refined together, and those of a bucket of one never
again.

* Each start p points at the offset in [p, p + SPAN) whose Q-gram has the
  smallest hash. Equal strings point at equal Q-grams at equal distances, and
  neighbouring starts share their pointer, so the first buckets are of
  pointers: some 3 of 100 bytes.
* Pointers of a bucket are sorted on the key of all bytes that their starts
  cover. In equal keys all but the earliest pointer's starts are repeats: the
  insides of long repeats, and copies, end here.
* Where a bucket holds several keys, the buckets of the Q-grams Q bytes before
  and after the pointer bound which starts can still repeat another's, and
  only those starts are sorted by themselves, on their LENGTH bytes.

Everything is dealt by the pointer's bucket as packed arrays. A task resolves
what it has in hand first, so a passage that stands in a third of all texts
sends one entry a task for each of its inner pointers. Bytes are judged on the
input: spans are joined in each document at the end.

Order: doc_id, null first; rows of one doc_id by a hash of their text; rows
equal in both are one document and get equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, mix64, utf8

LENGTH, Q = 100, 32
SPAN = LENGTH - Q + 1
BLOCK, PLACE = 1 << 17, 18
AT_ONCE = 300_000
NULL_DOC = -(1 << 63)
A = [np.uint64(pow(0x9E3779B97F4A7C15, 1 << k, 1 << 64)) for k in range(8)]
A_POWER = lambda n: np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64))
#: A fixed random-looking value for each byte.
BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
FIELDS = (("h", np.uint64), ("key", np.uint64), ("doc", np.int64), ("tie", np.uint64), ("at", np.uint32), ("back", np.uint8), ("more", np.uint8), ("left", np.uint16), ("right", np.uint16))
WINDOWS = (("h", np.uint64), ("key", np.uint64), ("doc", np.int64), ("tie", np.uint64), ("at", np.uint32))
DEALT = "bucket int, packed binary, doc_id long, tie long, spans binary"
FOUND = "doc_id long, tie long, spans binary, pointers binary"
Rows = dict[str, np.ndarray]


def tie_of(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) if text else 0


def pack(rows: Rows, at: np.ndarray, fields) -> bytes:
    """Columns one after another, documents as differences, compressed."""
    out = []
    for name, kind in fields:
        x = rows[name][at]
        if name in ("doc", "tie"):
            x = np.diff(x, prepend=x.dtype.type(0))
        out.append(x.astype(kind).tobytes())
    return len(at).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(blobs: list[bytes], fields) -> Rows:
    parts: dict[str, list[np.ndarray]] = {name: [] for name, _ in fields}
    for blob in blobs:
        n, raw, start = int.from_bytes(blob[:8], "little"), zstandard.ZstdDecompressor().decompress(blob[8:]), 0
        for name, kind in fields:
            x = np.frombuffer(raw, kind, n, start)
            start += x.nbytes
            parts[name].append(np.cumsum(x, dtype=kind) if name in ("doc", "tie") else x)
    return {name: np.concatenate(x) if x else np.zeros(0, kind) for (name, kind), x in zip(fields, parts.values())}


class Hashes:
    """Hashes of the strings that start at each byte of a block."""

    def __init__(self, data: np.ndarray) -> None:
        self.by = [BYTE[data]]
        for k in range(6):  # of 2, 4, ... 64 bytes
            x, n = self.by[-1], 1 << k
            self.by.append(x[:-n] * A[k] + x[n:])
        self.grams = mix64(self.by[5])

    def whole(self, at: np.ndarray) -> np.ndarray:
        """Of LENGTH = 64 + 32 + 4 bytes."""
        return mix64((self.by[6][at] * A_POWER(36) + self.by[5][at + 64] * A_POWER(4)) + self.by[2][at + 96])


def pointers(grams: np.ndarray, n: int) -> np.ndarray:
    """Where each of the first n starts points: the least hash among SPAN, leftmost where they tie."""
    place = np.uint64((1 << PLACE) - 1)
    x = grams[: n + SPAN - 1] & ~place | np.arange(n + SPAN - 1, dtype=np.uint64)
    size = 1
    while 2 * size <= SPAN:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    x = np.minimum(x[:n], x[SPAN - size : SPAN - size + n])
    return (x & place).astype(np.int64)


def blocks(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of joined texts: first byte, bytes (with Q before and enough after), whether a string starts at each, documents' begins and ends."""
    lens = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(lens)
    data = np.frombuffer(b"".join([bytes(Q), *texts, bytes(4 * LENGTH)]), np.uint8)
    total = int(ends[-1]) if len(ends) else 0
    starts = np.zeros(total, bool)
    for a, b in zip((ends - lens).tolist(), ends.tolist()):
        if b - a >= LENGTH:
            starts[a : b - LENGTH + 1] = True
    for first in range(0, total, BLOCK):
        valid = starts[first : first + BLOCK]
        if valid.any():
            yield first, data[first : first + Q + len(valid) + 3 * LENGTH], valid, ends - lens, ends


def find_pointers(texts: list[bytes], docs: np.ndarray, ties: np.ndarray) -> Rows:
    """A row for each run of starts that share a pointer."""
    found: list[Rows] = []
    for first, data, valid, begins, ends in blocks(texts):
        hashes = Hashes(data)
        to = pointers(hashes.grams[Q:], len(valid))
        new = valid & np.r_[True, ~valid[:-1] | (to[1:] != to[:-1])]
        last = valid & np.r_[~valid[1:] | (to[1:] != to[:-1]), True]
        s, e = np.flatnonzero(new), np.flatnonzero(last)
        doc = np.searchsorted(ends, first + s, "right")  # no run crosses documents: the last LENGTH - 1 bytes of one start nothing
        a = to[s]
        after = first + a + 2 * Q <= ends[doc]
        before = first + a - Q >= begins[doc]
        h = hashes.grams[a + Q]
        key = mix64(hashes.whole(s + Q) * np.uint64(3) + hashes.whole(e + Q) * np.uint64(0xD6E8FEB86659FD93) + ((a - s) * 256 + (e - s)).astype(np.uint64))
        bucket = lambda x, ok: np.where(ok, (hashes.grams[x] >> np.uint64(48)) | np.uint64(1), 0).astype(np.uint16)
        found.append({"h": h, "key": key, "doc": docs[doc], "tie": ties[doc], "at": (first + a - begins[doc]).astype(np.uint32), "back": (a - s).astype(np.uint8), "more": (e - s).astype(np.uint8), "left": bucket(a, before), "right": bucket(a + 2 * Q, after)})
    return {n: np.concatenate([x[n] for x in found]) if found else np.zeros(0, k) for n, k in FIELDS}


def earliest(rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of bucket, key, document and place, and which of them are their key's earliest."""
    at = np.lexsort((rows["at"], rows["tie"], rows["doc"], rows["key"], rows["h"]))
    h, key = rows["h"][at], rows["key"][at]
    first = np.r_[True, (h[1:] != h[:-1]) | (key[1:] != key[:-1])] if len(at) else np.zeros(0, bool)
    same = np.zeros(len(at), bool)  # one document that two equal rows hold is no repeat of itself
    if len(at):
        heads = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        for c in ("doc", "tie", "at"):
            x = rows[c][at]
            same = (x == x[heads]) & (same if c != "doc" else True)
    return at, first | same


def spans_by_document(rows: Rows, at: np.ndarray, first: np.ndarray, stop: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(doc, tie, pairs of first and last byte + 1) of the chosen rows."""
    order = np.lexsort((first, rows["tie"][at], rows["doc"][at]))
    at, pairs = at[order], np.stack([first[order], stop[order]], 1).astype(np.uint32)
    doc, tie = rows["doc"][at], rows["tie"][at]
    edges = np.r_[np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])]), len(at)] if len(at) else np.zeros(1, int)
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        yield int(doc[a]), int(tie[a].astype(np.int64)), join_spans(pairs[a:b]).tobytes()


def join_spans(pairs: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans joined."""
    if not len(pairs):
        return pairs
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.r_[True, pairs[1:, 0] > reach[:-1]]
    return np.stack([pairs[new, 0], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(pairs) - 1]]], 1)


def repeats_of(rows: Rows, at: np.ndarray, kept: np.ndarray, windows: bool) -> Iterator[tuple[int, int, bytes]]:
    gone = at[~kept]
    place = rows["at"][gone].astype(np.int64)
    first = place if windows else place - rows["back"][gone]
    return spans_by_document(rows, gone, first, first + LENGTH + (0 if windows else rows["more"][gone].astype(np.int64)))


def deal(rows: Rows, at: np.ndarray, buckets: int, fields) -> Iterator[tuple]:
    bucket = (rows["h"][at] % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b, (x, y) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
        if y > x:
            some = at[order[x:y]]
            some = some[np.lexsort((rows["at"][some], rows["tie"][some], rows["doc"][some]))]
            yield b, pack(rows, some, fields), None, None, None


def dealt_batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 2000):
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i : i + 2000]), (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()))], names=["bucket", "packed", "doc_id", "tie", "spans"])


def documents_of(batch: pa.RecordBatch, ties: bool) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    texts = utf8(batch, "text")
    docs = np.array([NULL_DOC if d is None else d for d in batch.column(0).to_pylist()], np.int64)
    return texts, docs, np.array([tie_of(x) for x in texts], np.uint64) if ties else np.zeros(len(texts), np.uint64)


def in_hand(read, fields, windows: bool, buckets: int):
    """Rows of each batch, the repeats among those in hand resolved, the rest dealt to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Rows] = []

        def flush() -> Iterator[pa.RecordBatch]:
            rows = {n: np.concatenate([x[n] for x in held]) for n, _ in fields}
            held.clear()
            at, kept = earliest(rows)
            out = list(deal(rows, at[kept], buckets, fields))
            pads = len(out)
            out += [(k % buckets, None, d, t, s) for k, (d, t, s) in enumerate(repeats_of(rows, at, kept, windows), pads)]
            yield from dealt_batches(out)

        for batch in batches:
            held.append(read(batch))
            if sum(len(x["h"]) for x in held) >= AT_ONCE:
                yield from flush()
        if held:
            yield from flush()

    return run


def read_pointers(ties: bool):
    return lambda batch: find_pointers(*documents_of(batch, ties))


def read_windows(ties: bool):
    """The starts that are still open, each with the hash of its LENGTH bytes; column pointers has their pointers' places and bounds."""

    def read(batch: pa.RecordBatch) -> Rows:
        texts, docs, tie = documents_of(batch, ties)
        lens = np.array([len(x) for x in texts], np.int64)
        begins = np.cumsum(lens) - lens
        asked = [np.frombuffer(b"".join(x or ()), np.uint32).reshape(-1, 3).astype(np.int64) for x in batch.column("pointers").to_pylist()]
        first, last, to = (np.concatenate([x[:, c] + b for x, b in zip(asked, begins)]) if asked else np.zeros(0, np.int64) for c in range(3))
        n = last - first + 1
        p = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        owner = np.repeat(to, n)
        order = np.argsort(p, kind="stable")
        p, owner = p[order], owner[order]
        found: list[Rows] = []
        for block, data, valid, doc_begins, ends in blocks(texts):
            a, b = np.searchsorted(p, (block, block + len(valid)))
            if a == b:
                continue
            hashes, at, to_here = Hashes(data), p[a:b] - block, owner[a:b] - block
            doc = np.searchsorted(ends, p[a:b], "right")
            found.append({"h": hashes.grams[to_here + Q], "key": hashes.whole(at + Q) + (to_here - at).astype(np.uint64), "doc": docs[doc], "tie": tie[doc], "at": (p[a:b] - doc_begins[doc]).astype(np.uint32)})
        return {k: np.concatenate([x[k] for x in found]) if found else np.zeros(0, t) for k, t in WINDOWS}

    return read


def open_starts(rows: Rows, at: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of buckets with several keys, the rows that are their key's earliest, and the starts of theirs that may still repeat: distances to the pointer, least and most."""
    h = rows["h"][at]
    head = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
    group = np.cumsum(head) - 1
    keys = np.bincount(group, weights=kept, minlength=0) if len(h) else np.zeros(0)
    mine = at[kept & (keys[group] > 1)] if len(h) else at[:0]
    least, most = rows["back"][mine].astype(np.int64) - rows["more"][mine], rows["back"][mine].astype(np.int64)

    def shared(side: str) -> np.ndarray:
        """Whether another of the bucket has the same neighbour."""
        code = mix64(rows["h"][mine] + rows[side][mine].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, where, n = np.unique(code, return_inverse=True, return_counts=True)
        return (n[where] > 1) & (rows[side][mine] > 0)

    # a start at most LENGTH - 2 Q before its pointer covers the Q-gram after the pointer's; one at least Q before it, the Q-gram before
    near, far = shared("right"), shared("left")
    least = np.where(near, least, np.maximum(least, LENGTH - 2 * Q + 1))
    most = np.where(far, most, np.minimum(most, Q - 1))
    open_ = least <= most
    return mine[open_], least[open_], most[open_]


def resolve(windows: bool):
    """All rows of the buckets that a task holds: repeats as spans; with pointers also the starts that stay open."""
    fields = WINDOWS if windows else FIELDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []
        spans: dict[tuple[int, int], bytes] = {}
        asked_of: dict[tuple[int, int], bytes] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["packed"] is None:
                    of = row["doc_id"], row["tie"]
                    spans[of] = spans.get(of, b"") + row["spans"]
                else:
                    blobs.append(row["packed"])
        rows = unpack(blobs, fields)
        at, kept = earliest(rows)
        for d, t, x in repeats_of(rows, at, kept, windows):
            spans[d, t] = spans.get((d, t), b"") + x
        if not windows:
            mine, least, most = open_starts(rows, at, kept)
            place = rows["at"][mine].astype(np.int64)
            order = np.lexsort((place, rows["tie"][mine], rows["doc"][mine]))
            asked = np.stack([place - most, place - least, place], 1)[order].astype(np.uint32)
            doc, tie = rows["doc"][mine][order], rows["tie"][mine][order]
            edges = np.r_[np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])]), len(doc)] if len(doc) else np.zeros(1, int)
            asked_of = {(int(doc[a]), int(tie[a].astype(np.int64))): asked[a:b].tobytes() for a, b in zip(edges.tolist(), edges[1:].tolist())}
        out = [(*of, spans.get(of), asked_of.get(of)) for of in spans.keys() | asked_of.keys()]  # one row a document
        for i in range(0, len(out), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out[i : i + 20_000]), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["doc_id", "tie", "spans", "pointers"])

    return run


def with_lists(docs: DataFrame, lists: DataFrame, column: str, ties: bool, how: str) -> DataFrame:
    """docs with the lists of their document, over a shuffle by doc_id at every size."""
    grouped = lists.groupBy("doc_id", "tie").agg(F.collect_list(column).alias(column)).withColumnsRenamed({"doc_id": "__d", "tie": "__t"})
    key = F.coalesce("doc_id", F.lit(NULL_DOC))
    if ties:
        docs = docs.mapInArrow(add_ties, "doc_id long, text string, tie long")
    on = (key == F.col("__d")) & (F.col("tie") == F.col("__t")) if ties else key == F.col("__d")
    return docs.join(grouped, on, how).select("doc_id", "text", column)


def add_ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.array([tie_of(x) for x in utf8(batch, "text")], np.uint64).view(np.int64))], names=["doc_id", "text", "tie"])


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def cut(keep_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, lists in zip(batch.column(0).to_pylist(), utf8(batch, "text"), batch.column("spans").to_pylist()):
                spans = join_spans(np.frombuffer(b"".join(lists or ()), np.uint32).reshape(-1, 2).astype(np.int64)).tolist()
                kept = b"".join([text[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(text)])])
                rows.append((doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), *([kept] if keep_bytes else [])))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * (5 + keep_bytes), types)], names=names[: 5 + keep_bytes])

    return run


def remove_repeats(docs: DataFrame, keep_bytes: bool = False) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with keep_bytes the bytes that stay.

    Null text is empty. Texts shorter than LENGTH bytes lose nothing. What
    stays need not be valid UTF-8. An empty table gives no rows; other columns
    are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    docs = docs.select("doc_id", "text")
    ties = bool(docs.groupBy("doc_id").count().where("count > 1").limit(1).count())
    long = docs.where(F.octet_length("text") >= LENGTH)
    buckets = max(48, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = long.mapInArrow(in_hand(read_pointers(ties), FIELDS, False, buckets), DEALT).repartition(buckets, "bucket")
    found = scratch.keep("found", dealt.mapInArrow(resolve(False), FOUND))
    del dealt
    scratch.forget()
    asked = with_lists(long, found.where(F.col("pointers").isNotNull()).select("doc_id", "tie", "pointers"), "pointers", ties, "inner")
    dealt = asked.mapInArrow(in_hand(read_windows(ties), WINDOWS, True, buckets), DEALT).repartition(buckets, "bucket")
    more = scratch.keep("more", dealt.mapInArrow(resolve(True), FOUND))
    del dealt, asked
    scratch.forget()
    spans = found.unionByName(more).where(F.col("spans").isNotNull()).select("doc_id", "tie", "spans")
    return with_lists(docs, spans, "spans", ties, "left").mapInArrow(cut(keep_bytes), KEPT + ", kept binary" * keep_bytes)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
