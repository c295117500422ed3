"""Documents whose sets of n-grams have a Jaccard similarity of at least 0.8, by vertical partitioning.

All n-grams stand in one global order, and an n-gram is known by its place in
it, its key: rare ones by hash, then the frequent ones by how often they were
counted. The order decides three things.

Candidates. Two sets that reach the similarity share one of the first
p = n - ceil(0.8 n) + 1 of each (prefix filter), so sets meet at the n-grams of
their prefixes. Where the shorter prefix ends, all that two sets share so far
is known; with what the one that ends there has left this bounds the overlap,
so pairs that share an n-gram by chance go before any set is sent.

Verification. The order is cut into FRAGMENTS ranges. Each pair is counted in
each fragment apart, from the parts of the two sets that fall into it, and the
partial overlaps are summed for each pair; the exact sizes then give the exact
similarity. Pairs are dealt by one end, and an end with many partners is salted.

Rounds. An n-gram's group first pairs its members with one of them, chosen by
one of ORDERS fixed orders. After these links are joined to components, only
groups that still hold several components matter, and in them only links across
components. Groups of at most SMALL nodes name those pairs. Larger groups are
gathered by their smallest node, never transitively: a family is that node and
all that meet it at a large group. A family is cut into blocks of at most BLOCK
nodes and BLOCK_GRAMS n-grams; every two blocks are a task, which counts the
fragments, sums them and gives the links across components as a forest.

Equal sets are one node, named by 64 bits of a 128-bit hash; should sets with
other 64 bits bear the same name, all is done again under another seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, free_names, mix64, small_side, text_bytes, tidy, utf8

WORDS, PERCENT, ORDERS, FRAGMENTS = 5, 80, 2, 8
SMALL, BLOCK, BLOCK_GRAMS, COLUMNS = 16, 512, 1 << 21, 2048
#: N-grams that are put last in the order: those counted most often, from SEEN times on.
FREQUENT, SEEN, COUNTED_AT_ONCE = 1 << 20, 2, 1_500_000
#: Keys of frequent n-grams begin here; below are 62-bit hashes.
FIRST_FREQUENT = 1 << 62
DEALT_AT_ONCE = 400_000
REMEMBERED = 100_000
#: Pairs of one end that go to one group, and n-grams that a group is made for.
PARTNERS, GROUP_GRAMS = 512, 4 << 20
#: Bytes of texts for which a task of prefixes is made.
BYTES_A_BUCKET = 8 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Sets of n-grams of texts, as sorted 62-bit hashes; words are hashed once each."""

    def __init__(self, words: int) -> None:
        self.n, self.known = words, {}

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        hashes = list(map(known.get, words))
        if None in hashes:
            if len(known) > REMEMBERED:
                known.clear()
            hashes = [x if x is not None else known.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w, x in zip(words, hashes)]
        h = np.array(hashes, np.uint64)
        size = min(self.n, len(h))
        out = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            out = out * BASE + h[k : k + len(out)]
        out = np.sort(mix64(out) >> np.uint64(2))
        return out[np.r_[True, out[1:] != out[:-1]]] if len(out) > 1 else out


def name_of(grams: np.ndarray, seed: int) -> tuple[int, int]:
    """The set's name and 64 more bits of its hash, both signed."""
    h = xxhash.xxh3_128_intdigest(grams.tobytes(), seed)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return signed(h & 0xFFFFFFFFFFFFFFFF), signed(h >> 64)


def prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def count_grams(words: int):
    """N-grams that stand in at least SEEN different sets of the texts that a task has in hand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held, size, seen = Grams(words), [], 0, set()

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            every = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
            counts = np.diff(np.r_[first, len(every)])
            often = counts >= SEEN
            held, size = [], 0
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(every[first[often]].view(np.int64)), pa.array(counts[often])], names=["gram", "n"])

        for batch in batches:
            for text in utf8(batch, "text"):
                g = grams.of(text)
                if len(g) and (name := name_of(g, 0)) not in seen:
                    seen.add(name)
                    held.append(g)
                    size += len(g)
                    if size >= COUNTED_AT_ONCE:
                        yield flush()
        if held:
            yield flush()

    return run


class Order:
    """The global order: n-grams that are not frequent by hash, then the frequent ones by count and hash."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        place = np.empty(len(grams), np.int64)
        place[np.lexsort((grams, counts))] = np.arange(len(grams))
        at = np.argsort(grams)
        self.grams, self.places = grams[at], place[at]
        self.hit = np.zeros(1 << 22, bool)
        self.hit[grams >> np.uint64(40)] = True

    def keys(self, grams: np.ndarray, n: int | None = None) -> np.ndarray:
        """The keys of a sorted set in order; the first n, if n is given."""
        maybe = np.flatnonzero(self.hit[grams >> np.uint64(40)])
        if not len(maybe):
            return grams[:n].view(np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams[maybe]), len(self.grams) - 1)
        is_frequent = self.grams[at] == grams[maybe]
        rare = np.ones(len(grams), bool)
        rare[maybe[is_frequent]] = False
        out = grams[rare][:n].view(np.int64)
        if n is not None and len(out) >= n:
            return out
        return np.r_[out, FIRST_FREQUENT + np.sort(self.places[at[is_frequent]])][:n]


PROFILE = "bucket int, docs binary, nulls binary, hashes binary, nodes binary, checks binary, sizes binary, lasts binary, grams binary, owners binary"
COLUMNS_OF_DOCS = ("docs", "hashes", "nodes", "checks", "sizes", "lasts")


def profile(words: int, percent: int, buckets: int, order, seed: int):
    """Rows of two kinds: a batch's documents with their sets' names, sizes and last prefix keys; and prefix keys of a bucket with their sets.

    Rare keys are dealt by ranges of the order. Frequent ones, known to be
    shared, need not meet here and are dealt by their set, so no key is hot.
    """
    names = [x.split()[0] for x in PROFILE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, global_order, seen = Grams(words), order.value, set()
        held: list[np.ndarray] = []
        owners: list[int] = []
        size = batches_seen = 0

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], pa.binary() if i else pa.int32()) for i, c in enumerate(names)], names=names)

        def flush() -> pa.RecordBatch:
            nonlocal held, owners, size
            keys, of = np.concatenate(held), np.repeat(np.array(owners, np.int64), [len(x) for x in held])
            ranges = keys // (FIRST_FREQUENT // buckets + 1)
            bucket = np.where(keys < FIRST_FREQUENT, ranges, mix64(of.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            at = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[at], np.arange(buckets + 1))
            held, owners, size = [], [], 0
            return batch_of([{"bucket": b, "grams": keys[at[x:y]].tobytes(), "owners": of[at[x:y]].tobytes()} for b, (x, y) in enumerate(zip(edges, edges[1:])) if y > x])

        for batch in batches:
            docs, nodes, checks, sizes, lasts = batch.column(0).to_pylist(), [], [], [], []
            for text in utf8(batch, "text"):
                g = sets.of(text)
                node, check = name_of(g, seed) if len(g) else (0, 0)
                keys = global_order.keys(g, prefix_length(len(g), percent))
                for x, y in zip((nodes, checks, sizes, lasts), (node, check, len(g), keys[-1] if len(keys) else 0)):
                    x.append(y)
                if len(g) and node not in seen:
                    if len(seen) > REMEMBERED:
                        seen.clear()
                    seen.add(node)
                    held.append(keys)
                    owners.append(node)
                    size += len(keys)
            batches_seen += 1  # rows of documents go with any bucket
            columns = [np.array([x or 0 for x in docs], np.int64), batch.column("t").to_numpy(), *(np.array(x, np.int64) for x in (nodes, checks, sizes, lasts))]
            yield batch_of([{"bucket": (TaskContext.get().partitionId() + batches_seen) % buckets, "nulls": bytes(x is None for x in docs)} | {c: x.tobytes() for c, x in zip(COLUMNS_OF_DOCS, columns)}])
            if size >= DEALT_AT_ONCE:
                yield flush()
        if held:
            yield flush()

    return run


GROUPED = "doc_id long, t long, node long, check long, n_shingles long, last long, gram long"


def shared_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From all rows of the buckets that a task holds: documents, one a row; and prefix keys that several sets may share with those sets (n_shingles null)."""
    names = [x.split()[0] for x in GROUPED.split(", ")]
    held: list[tuple[bytes, bytes]] = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["docs"] is None:
                held.append((row["grams"], row["owners"]))
                continue
            nulls = np.frombuffer(row["nulls"], np.uint8).astype(bool)
            docs, hashes, nodes, checks, sizes, lasts = (np.frombuffer(row[c], np.int64) for c in COLUMNS_OF_DOCS)
            yield pa.RecordBatch.from_arrays([pa.array(docs, mask=nulls), pa.array(hashes), pa.array(nodes, mask=sizes == 0), pa.array(checks), pa.array(sizes), pa.array(lasts), pa.nulls(len(docs), pa.int64())], names=names)
    if not held:
        return
    grams, owners = (np.concatenate([np.frombuffer(x[i], np.int64) for x in held]) for i in (0, 1))
    at = np.lexsort((owners, grams))
    grams, owners = grams[at], owners[at]
    new = np.r_[True, (grams[1:] != grams[:-1]) | (owners[1:] != owners[:-1])]
    grams, owners = grams[new], owners[new]
    alone = np.r_[True, grams[1:] != grams[:-1]] & np.r_[grams[1:] != grams[:-1], True] & (grams < FIRST_FREQUENT)
    grams, owners = grams[~alone], owners[~alone]
    for i in range(0, len(grams), 200_000):
        none = pa.nulls(len(grams[i : i + 200_000]), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.array(owners[i : i + 200_000]), none, none, none, pa.array(grams[i : i + 200_000])], names=names)


def parts_of_sets(words: int, fragments: int, order, seed: int):
    """The parts by fragment of the order of each text's set, for each place that asks for it; each set once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, global_order, seen = Grams(words), order.value, set()
        cuts = np.r_[np.arange(1, fragments - 1) * (FIRST_FREQUENT // max(1, fragments - 1)), FIRST_FREQUENT][: fragments - 1]
        for batch in batches:
            rows = []
            for text, node, places in zip(utf8(batch, "text"), batch.column("node").to_pylist(), batch.column("places").to_pylist()):
                if node in seen:
                    continue
                g = sets.of(text)
                if not len(g) or name_of(g, seed)[0] != node:
                    continue
                seen.add(node)
                keys = global_order.keys(g)
                parts = [(f, x.tobytes()) for f, x in enumerate(np.split(keys, np.searchsorted(keys, cuts))) if len(x)]
                rows += [(p, f, node, x) for p in places for f, x in parts]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 4, (pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=["place", "fragment", "node", "grams"])

    return run


PARTS = "place long, fragment int, node long, grams binary"


class Sets:
    """Where the sets of nodes come from: the texts that hold them, sent once to all places that ask."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, words: int, fragments: int, order, seed: int) -> None:
        self.docs, self.nodes, self.run = docs.select("doc_id", "text"), nodes, parts_of_sets(words, fragments, order, seed)

    def at(self, asked: DataFrame) -> DataFrame:
        """Parts for asked (node, place), from one text of each node."""
        places = asked.groupBy("node").agg(F.collect_set("place").alias("places"))
        home = places.join(self.nodes.select("node", "home"), "node").select(F.col("home.doc").alias("d"), F.col("home.t").alias("h"), "node", "places")
        texts = self.docs.join(small_side(home), F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("h")))
        return texts.select("text", "node", "places").mapInArrow(tidy(self.run), PARTS)


def overlaps(key, pairs: pa.Table, parts: pa.Table) -> pa.Table:
    """Overlap of each pair in one fragment; pairs and the parts of their sets are dealt by group and fragment."""
    a, b = pairs["a"].to_numpy(), pairs["b"].to_numpy()
    out = np.zeros(len(a), np.int64)
    nodes, sets = parts["node"].to_numpy(), [np.frombuffer(x, np.int64) for x in parts["grams"].to_pylist()]
    if len(sets) and len(a):
        where = dict(zip(nodes.tolist(), range(len(nodes))))
        distinct, index = np.unique(np.concatenate(sets), return_inverse=True)
        index = np.split(index, np.cumsum([len(x) for x in sets])[:-1])
        marked, order = np.zeros(len(distinct), bool), np.argsort(a, kind="stable")
        edges = np.flatnonzero(np.r_[True, a[order][1:] != a[order][:-1], True])
        for x, y in zip(edges.tolist(), edges[1:].tolist()):  # once for each end
            if (mine := where.get(int(a[order[x]]))) is None:
                continue
            marked[index[mine]] = True
            for i in order[x:y].tolist():
                if (other := where.get(int(b[i]))) is not None:
                    out[i] = np.count_nonzero(marked[index[other]])
            marked[index[mine]] = False
    return pa.table({"a": pairs["a"], "b": pairs["b"], "n_a": pairs["n_a"], "n_b": pairs["n_b"], "n": pa.array(out)})


def verify(pairs: DataFrame, sets: Sets, scratch: Scratch, name: str, percent: int, fragments: int) -> DataFrame:
    """The pairs (a, b) that reach the similarity: overlaps are counted by fragment and summed for each pair."""
    size = pairs.agg(F.sum(F.col("n_a") + F.col("n_b")).alias("n")).first()["n"] or 0
    groups = int(max(16, size // GROUP_GRAMS))
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("salts"))
    salted = pairs.join(salts, "a").withColumn("place", F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), "salts")), F.lit(groups)))
    salted = scratch.keep(f"{name}_dealt", salted.drop("salts"))
    asked = salted.select("place", F.explode(F.array("a", "b")).alias("node")).distinct()
    dealt = salted.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))))
    found = dealt.groupBy("place", "fragment").cogroup(sets.at(asked).groupBy("place", "fragment")).applyInArrow(overlaps, "a long, b long, n_a long, n_b long, n long")
    total = found.groupBy("a", "b", "n_a", "n_b").agg(F.sum("n").alias("n"))
    return scratch.keep(name, total.where((100 + percent) * F.col("n") >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b"))


def within_bound(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes leave the similarity possible.

    All that both sets hold up to where the first of the prefixes ends is in
    both prefixes; that set has n - p n-grams behind its end.
    """
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("last").alias(f"last_{c}"), F.col("grams").alias(f"grams_{c}"))
    rest = F.when(F.col("last_a") <= F.col("last_b"), _beyond("n_a", percent)).otherwise(_beyond("n_b", percent))
    most = F.size(F.array_intersect("grams_a", "grams_b")) + rest
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.where((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b", "n_a", "n_b")


def _beyond(n: str, percent: int) -> Column:
    """How many n-grams stand behind the prefix of a set of n."""
    return F.floor((percent * F.col(n) + 99) / 100).cast("long") - 1


def count_cell(percent: int):
    """The links across components between two blocks of a family: overlaps are counted by fragment and summed."""

    def run(key, members: pa.Table, parts: pa.Table) -> pa.Table:
        empty = pa.schema([("a", pa.int64()), ("b", pa.int64())]).empty_table()
        if not members.num_rows or not parts.num_rows:
            return empty
        x, y = members["x"][0].as_py(), members["y"][0].as_py()
        node, block, n, component = (members[c].to_numpy() for c in ("node", "block", "n", "component"))
        held: dict[int, dict[int, np.ndarray]] = {}
        for i, f, g in zip(parts["node"].to_pylist(), parts["fragment"].to_pylist(), parts["grams"].to_pylist()):
            held.setdefault(f, {})[i] = np.frombuffer(g, np.int64)
        a, b = np.flatnonzero(block == x), np.flatnonzero(block == y)
        total, none = np.zeros((len(a), len(b)), np.float32), np.zeros(0, np.int64)
        for f in sorted(held):
            mine, theirs = ([held[f].get(i, none) for i in node[side].tolist()] for side in (a, b))
            if not mine or not theirs:
                break
            common = np.intersect1d(np.concatenate(mine), np.concatenate(theirs))
            for i in range(0, len(common), COLUMNS):
                some = common[i : i + COLUMNS]
                total += incidence(mine, some) @ incidence(theirs, some).T  # whole numbers under 2**24: exact
        linked = ((100 + percent) * total.astype(np.float64) >= percent * (n[a][:, None] + n[b][None, :])) & (component[a][:, None] != component[b][None, :])
        pairs = np.unique(np.stack([component[a][np.nonzero(linked)[0]], component[b][np.nonzero(linked)[1]]], 1), axis=0)
        edges = list(forest(iter([pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], names=["a", "b"])])))
        return pa.Table.from_batches(edges).rename_columns(["a", "b"]) if edges else empty

    return run


def incidence(sets: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(columns)), np.float32)
    every, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    at = np.minimum(np.searchsorted(columns, every), len(columns) - 1)
    hit = columns[at] == every
    out[row[hit], at[hit]] = 1
    return out


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of a task's edges, each as edges to its smallest node."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        root = x
        while (y := up.setdefault(root, root)) != root:
            root = y
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    nodes = [x for x in up if top(x) != x]
    for i in range(0, len(nodes), 200_000):
        some = nodes[i : i + 200_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([top(x) for x in some], pa.int64())], names=["node", "component"])


def components(edges: DataFrame, scratch: Scratch, name: str, in_one_task: int = BROADCAST_ROWS) -> DataFrame:
    """(node, component: its smallest node) for the nodes that are not their component's smallest.

    Each task first turns its edges to a forest. What is left goes through one
    task if it has at most in_one_task rows, else through alternating large
    and small stars until nothing changes, written to the shared folder after
    every round.
    """
    now = scratch.keep(f"{name}_0", edges.select("a", "b").mapInArrow(tidy(forest), "node long, component long"))
    if (n := now.count()) <= in_one_task:
        return scratch.keep(f"{name}_done", now.coalesce(1).mapInArrow(tidy(forest), "node long, component long"))
    parts = max(1, n // in_one_task)
    now, k, mark = scratch.keep(f"{name}_1", now.repartition(parts).mapInArrow(tidy(forest), "node long, component long")), 1, None
    while True:
        both = now.union(now.select("component", "node")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.keep(f"{name}_large_{k}", large.where("u <> v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m").union(least.select("u", "m")).toDF("node", "component").where("node <> component").distinct()
        k += 1
        now = scratch.keep(f"{name}_{k}", small)
        was, mark = mark, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("node", "component").cast("decimal(38,0)"))).first())
        scratch.drop(f"{name}_large_{k - 1}", f"{name}_{k - 1}")
        if was == mark:
            return now


def families(placed: DataFrame, large: DataFrame, scratch: Scratch) -> DataFrame:
    """(place, x, y, node, block, n, component): the cells of each family, with the nodes of its two blocks."""
    members = scratch.keep("members", placed.join(large, "gram").select("head", "node", "n", "component").distinct())
    size = members.groupBy("head").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    dealt = members.join(size, "head").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = dealt.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
    return cells.select(F.xxhash64("head", "x", "y").alias("place"), "x", "y", "node", "block", "n", "component")


def buckets_for(docs: DataFrame) -> int:
    """As many tasks of prefixes as the texts' bytes need, and no fewer than other shuffles have."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes(docs) // BYTES_A_BUCKET))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, frequent: int = FREQUENT, fragments: int = FRAGMENTS, seed: int = 0) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id reachable by links), t (the text's hash) and component (a node).

    A text of fewer words than the n-gram is one n-gram; a null or empty text
    or one of white space has none and is its own component. Rows with equal
    doc_id are documents of their own; a null doc_id is not smaller than
    another, and a component of null ids only has a null id. Other columns are
    not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = docs.select("doc_id", "text")
    texts = docs.select("text").where(F.length("text") > 0)
    counted = texts.mapInArrow(tidy(count_grams(words)), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(frequent)
    counted = counted.toArrow()  # at most frequent rows of 16 bytes; whichever these are, the result is the same
    order = spark.sparkContext.broadcast(Order(counted["gram"].to_numpy().view(np.uint64), counted["n"].to_numpy()))
    buckets = buckets_for(docs)
    dealt = docs.withColumn("t", F.xxhash64("text")).mapInArrow(tidy(profile(words, percent, buckets, order, seed)), PROFILE).repartition(buckets, "bucket")
    profiles = scratch.keep("profiles", dealt.mapInArrow(tidy(shared_grams), GROUPED))
    del dealt
    scratch.forget()
    rows = profiles.where("n_shingles is not null").drop("gram")
    home = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), "t")
    sizes = rows.where("n_shingles > 0").groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("last").alias("last"), F.min(home).alias("home"), F.min("check").alias("check"), (F.min("check") != F.max("check")).alias("clash"))
    shared = profiles.where("gram is not null").groupBy("node").agg(F.collect_list("gram").alias("grams"))  # a prefix at most
    nodes = scratch.keep("nodes", sizes.join(shared, "node", "left"))
    if not nodes.where("clash").isEmpty():
        return jaccard_components(docs, words, percent, frequent, fragments, seed + 1)
    sets = Sets(docs, nodes, words, fragments, order, seed)
    grouped = nodes.select("node", "n", F.explode("grams").alias("gram"))
    close = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)

    # round 1: each group pairs its members with one of them
    rank = F.xxhash64("node", F.pmod("gram", F.lit(ORDERS)))
    heads = grouped.groupBy("gram").agg(F.min(F.struct(rank.alias("r"), F.col("node").alias("head"), F.col("n").alias("n_head"))).alias("h"), F.count("*").alias("m")).where("m > 1").select("gram", "h.head", "h.n_head")
    first = grouped.join(heads, "gram").where((F.col("node") != F.col("head")) & close(F.col("n"), F.col("n_head"))).select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    first = scratch.keep("pairs_1", within_bound(first, nodes, percent))
    links = [verify(first, sets, scratch, "links_1", percent, fragments)]
    joined = components(links[0], scratch, "components_1")

    # round 2: groups that still hold several components pair across them
    placed = nodes.where(F.col("grams").isNotNull()).join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = placed.select("node", "n", "component", F.explode("grams").alias("gram"))
    mixed = placed.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m"), F.min("node").alias("head")).where("x <> y").select("gram", "m", "head")
    placed = scratch.keep("placed", placed.join(mixed, "gram"))
    sides = placed.where(F.col("m") <= SMALL)
    other = sides.select("gram", *(F.col(c).alias(f"{c}_2") for c in ("node", "n", "component")))
    across = (F.col("component") < F.col("component_2")) & close(F.col("n"), F.col("n_2"))
    second = sides.join(other, "gram").where(across).select(F.col("node").alias("a"), F.col("node_2").alias("b")).distinct()
    second = scratch.keep("pairs_2", within_bound(second, nodes, percent))
    if not second.isEmpty():
        links.append(verify(second, sets, scratch, "links_2", percent, fragments))
    large = placed.where(F.col("m") > SMALL)
    if not large.isEmpty():
        cells = scratch.keep("cells", families(large.select("gram", "node", "n", "component"), large.select("gram", "head").distinct(), scratch))
        parts = sets.at(cells.select("node", "place"))
        links.append(scratch.keep("links_3", cells.groupBy("place").cogroup(parts.groupBy("place")).applyInArrow(count_cell(percent), "a long, b long")))
    if len(links) > 1:
        joined = components(reduce(DataFrame.unionByName, links), scratch, "components_2")

    named = nodes.select("node", "home").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min(F.col("home.doc")).alias("component_id"))
    named = named.join(least, "component").select("node", "component", "component_id")
    return rows.join(named, "node", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "t", "component")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without all but one row of each component: the one of the smallest doc_id stays (null last), then of the smallest text hash.

    Rows without n-grams stay; of rows that are equal in both one stays. Only
    the keys of rows that go are joined to docs, under names that docs has not.
    """
    scratch = Scratch(docs.sparkSession, "keep_one")
    found = scratch.keep("found", jaccard_components(docs).where("component is not null").select("doc_id", "t", "component"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("doc"), F.col("t"))
    best = found.groupBy("component").agg(F.min(rank).alias("best"))
    t, d, h = free_names(docs, "t", "d", "h")
    gone = found.join(best, "component").where(rank != F.col("best")).select(F.col("doc_id").alias(d), F.col("t").alias(h)).distinct()
    keyed = docs.withColumn(t, F.xxhash64("text"))
    kept = keyed.join(small_side(gone), F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(t) == F.col(h)), "left_anti")
    if found.groupBy("doc_id", "t").count().where("count > 1").limit(1).count():  # rows repeated as a whole; those without n-grams stay
        blank = F.length(F.btrim("text", F.lit(" \t\n\r\x0b\x0c"))) == 0
        kept = kept.where(~blank).dropDuplicates(["doc_id", t]).unionByName(kept.where(blank | F.col("text").isNull()))
    return kept.drop(t)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")
