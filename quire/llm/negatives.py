"""Hard negatives by one-dimensional distance keys.

Vectors get one more component, so that all are equally long; the largest inner
products of a query are then its nearest vectors. Each vector belongs to its
nearest of a few pivots, fitted on a bounded sample, and its key is (pivot,
distance to it). The vectors are stored sorted by key, cut into rings of near
distances for each pivot and packed into blocks of one ring.

A search knows a query's distance to each pivot. By the triangle inequality a
ring holds nothing nearer than the gap between that distance and the ring's
ends. Each round opens the next of a query's rings in the order of these gaps,
STEP times as many as the round before: key intervals that grow around the query
in every pivot. A query leaves out rings whose gap is beyond what it has found,
and is done when none is left.

Positives are the first rows of the anchor's label. Negatives of a positive are
the first rows of other labels whose score is between a share of the positive's
and the positive's own: an annulus, whose outer end shrinks as rows are found.

A ring's blocks are dealt by block, in salted groups where it has many; what
travels is an anchor's vector to the rings that it opens. Found rows are kept
to the first few of each list by a window with a limit before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

#: Rows that pivots are fitted on, and how often these are moved.
SAMPLE, MOVES = 8_192, 6
LEAST_PIVOTS, MOST_PIVOTS, MOST_RINGS, RING_ROWS, BLOCK_ROWS, QUERY_ROWS = 4, 1_024, 64, 512, 2_048, 256
#: Rings that the first round opens for a query, times as many each further one; blocks of a ring that are dealt together.
FIRST, STEP, GROUP_BLOCKS = 8, 8, 32
#: Of squared lengths, what rounding may take from a distance.
MARGIN = 1e-9
ROWS = "vec_id long, label long, dim int, norm double, top double, vector binary"
KEYED = "vec_id long, label long, dim int, pivot int, distance double, vector binary"
BLOCKS = "block long, dim int, pivot int, ring int, low double, high double, n int, ids binary, labels binary, vectors binary"
ANCHORS = "dim int, pivot int, distance double, vec_id long, label long, block long, row int, vector binary"
QUERIES = "q long, dim int, ids binary, labels binary, blocks binary, rows binary, vectors binary"
MOST = 10**38 - 1


def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole vectors floor(256 x) as doubles; rows with a null or non-finite component go."""
    for batch in batches:
        ids, labels, column = batch.columns
        lengths = np.array(column.value_lengths(), np.int64)
        flat = column.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
        whole = np.abs(flat) >= 2.0**52  # larger doubles are whole numbers
        with np.errstate(over="ignore", invalid="ignore"):
            flat = np.where(whole, flat * 256, np.floor(np.where(whole, 0, flat) * 256))
        bad = ~np.isfinite(flat)
        ends = np.cumsum(lengths)
        clear = np.diff(np.r_[0, np.cumsum(bad)][np.r_[0, ends]]) == 0
        out = []
        for i in np.flatnonzero(clear).tolist():
            v = flat[ends[i] - lengths[i] : ends[i]]
            with np.errstate(over="ignore"):
                out.append((ids[i].as_py(), labels[i].as_py(), len(v), float(v @ v), float(np.abs(v).max(initial=0)), v.tobytes()))
        yield packed(ROWS, out)


TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "decimal(38,0)": pa.decimal128(38, 0), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<decimal(38,0)>": pa.list_(pa.decimal128(38, 0))}


def packed(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), TYPES[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def fit(vectors: np.ndarray, pivots: int, moves: int = MOVES) -> np.ndarray:
    """Centres of a sample of vectors, moved to their members' means a few times."""
    centres = vectors[np.linspace(0, len(vectors) - 1, min(pivots, len(vectors))).astype(int)]
    for _ in range(moves):
        nearest = ((centres**2).sum(1) - 2 * vectors @ centres.T).argmin(1)
        for p in np.unique(nearest).tolist():
            centres[p] = vectors[nearest == p].mean(0)
    return np.unique(centres, axis=0)


class Space:
    """The pivots of each dimension, and distances to them in the space with one more component."""

    def __init__(self, pivots: dict[int, np.ndarray], longest: float) -> None:
        self.pivots, self.longest = pivots, longest

    def distances(self, vectors: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Of vectors with the further component extra to the pivots of their dimension, whose own is 0."""
        centres = self.pivots.get(vectors.shape[1])
        if centres is None:
            centres = np.zeros((1, vectors.shape[1]))
        squares = (vectors**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * vectors @ centres.T + extra[:, None] ** 2
        return np.sqrt(np.maximum(squares, 0))


def assign(space):
    """Each row's key: its nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, dims, out = batch.to_pylist(), batch.column("dim").to_numpy(), []
            for dim in np.unique(dims).tolist():
                mine = [r for r in rows if r["dim"] == dim]
                vectors = np.frombuffer(b"".join(r["vector"] for r in mine), np.float64).reshape(len(mine), dim)
                extra = np.sqrt(np.maximum(space.value.longest - np.array([r["norm"] for r in mine]), 0))
                distances = space.value.distances(vectors, extra)
                nearest = distances.argmin(1).tolist()
                out += [(r["vec_id"], r["label"], dim, p, float(d[p]), r["vector"]) for r, p, d in zip(mine, nearest, distances)]
            yield packed(KEYED, out)

    return run


def pack_rings(edges):
    """Rows sorted by key to blocks of one ring. edges: of each (dim, pivot) the distances where a new ring begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, held, now = TaskContext.get().partitionId(), 0, [], None

        def flush() -> tuple:
            nonlocal made, held
            made += 1
            row = ((part << 32) + made, *now, held[0]["distance"], held[-1]["distance"], len(held), np.array([r["vec_id"] for r in held], np.int64).tobytes(), np.array([r["label"] for r in held], np.int64).tobytes(), b"".join(r["vector"] for r in held))
            held = []
            return row

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                at = r["dim"], r["pivot"], int(np.searchsorted(edges.value.get((r["dim"], r["pivot"]), ()), r["distance"], side="right"))
                if held and (at != now or len(held) == BLOCK_ROWS):
                    out.append(flush())
                now = at
                held.append(r)
            if out:
                yield packed(BLOCKS, out)
        if held:
            yield packed(BLOCKS, [flush()])

    return run


def pick_anchors(every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                vectors = np.frombuffer(r["vectors"], np.float64).reshape(len(ids), r["dim"])
                out += [(r["dim"], r["pivot"], r["low"], int(ids[i]), int(labels[i]), r["block"], i, vectors[i].tobytes()) for i in np.flatnonzero(ids % every == 0).tolist()]
            yield packed(ANCHORS, out)

    return run


def pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors sorted by key to groups of one dimension that look at the same rings."""
    from pyspark import TaskContext

    part, made, held = TaskContext.get().partitionId(), 0, []

    def flush() -> pa.RecordBatch:
        nonlocal made, held
        made += 1
        column = lambda c, t: np.array([r[c] for r in held], t).tobytes()
        row = ((part << 32) + made, held[0]["dim"], column("vec_id", np.int64), column("label", np.int64), column("block", np.int64), column("row", np.int32), b"".join(r["vector"] for r in held))
        held = []
        return packed(QUERIES, [row])

    for batch in batches:
        for r in batch.to_pylist():
            if held and (len(held) == QUERY_ROWS or held[0]["dim"] != r["dim"]):
                yield flush()
            held.append(r)
    if held:
        yield flush()


class Rings:
    """What all tasks know of the index: of each ring its dimension, pivot, number, ends and groups of blocks; at most MOST_PIVOTS * MOST_RINGS a dimension."""

    def __init__(self, rows: list[tuple]) -> None:
        self.of: dict[int, list[np.ndarray]] = {}
        for dim in {r[0] for r in rows}:
            mine = [r for r in rows if r[0] == dim]
            self.of[dim] = [np.array([r[i] for r in mine]) for i in range(1, 6)]

    def gaps(self, dim: int, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest and the farthest that a ring's rows can be, of a query's distances to the pivots."""
        pivot, _, low, high, _ = self.of[dim]
        d = distance[pivot]
        return np.maximum(np.maximum(low - d, d - high), 0), d + high


def least(low, high, percent: int) -> int:
    """The lowest score that a bound still looks for: low, and percent of high."""
    return max(int(low), -(-int(high) * percent // 100)) if percent else int(low)


def visits(space, rings, first: int, last: int, percent: int, exact: str, whole: bool):
    """Which rings each query opens in a round: from first to last of its rings by gap, as far as its bounds ask for them.

    Rows of QUERIES with js and, for each of js, slots, lows and highs: the
    scores that are still looked for. The rows given out are dealt by ring and
    group and bear the anchors' vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n, dim = len(r["ids"]) // 8, r["dim"]
                vectors = np.frombuffer(r["vectors"], np.float64).reshape(n, dim)
                ids, labels, blocks, rows = (np.frombuffer(r[c], t) for c, t in (("ids", np.int64), ("labels", np.int64), ("blocks", np.int64), ("rows", np.int32)))
                asked: dict[int, list[int]] = {}
                for i, j in enumerate(r["js"]):
                    asked.setdefault(j, []).append(i)
                opened: dict[int, list[int]] = {}
                pivots, numbers, _, _, groups = rings.value.of[dim]
                distances = None if whole else space.value.distances(vectors, np.zeros(n))
                for j, at in asked.items():
                    if whole:
                        chosen = np.arange(len(pivots))[first:last]
                    else:
                        near, far = rings.value.gaps(dim, distances[j])
                        length = float(vectors[j] @ vectors[j]) + space.value.longest
                        slack = MARGIN * length + 1
                        best, worst = (length - near**2) / 2 + slack, (length - far**2) / 2 - slack
                        order = np.flatnonzero(worst <= max(r["highs"][i] for i in at))  # the same in all rounds
                        order = order[np.argsort(near[order], kind="stable")][first:last]
                        chosen = order[best[order] >= min(least(r["lows"][i], r["highs"][i], percent) for i in at)]
                    for k in chosen.tolist():
                        opened.setdefault(k, []).append(j)
                out = []
                for k, js in opened.items():
                    at, place = [i for j in js for i in asked[j]], {j: p for p, j in enumerate(js)}
                    row = (np.array(js, np.int32).tobytes(), ids[js].tobytes(), labels[js].tobytes(), blocks[js].tobytes(), rows[js].tobytes(), vectors[js].tobytes(), [place[r["js"][i]] for i in at], *([r[c][i] for i in at] for c in ("slots", "lows", "highs")))
                    out += [(dim, int(pivots[k]), int(numbers[k]), g, r["q"], *row) for g in range(int(groups[k]))]
                    if len(out) >= 32:
                        yield packed(visit_schema(exact), out)
                        out = []
                if out:
                    yield packed(visit_schema(exact), out)

    return run


def visit_schema(exact: str) -> str:
    return f"dim int, pivot int, ring int, salt int, q long, q_js binary, q_ids binary, q_labels binary, q_blocks binary, q_rows binary, q_vectors binary, b_js array<int>, b_slots array<int>, b_lows array<{exact}>, b_highs array<{exact}>"


def scan(k: int, same: bool, percent: int, exact: str, whole: bool):
    """A block against the queries that open its ring: of each bound the first k rows of the same label, or of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                js, q_labels, q_blocks, q_rows = (np.frombuffer(r[c], t) for c, t in (("q_js", np.int32), ("q_labels", np.int64), ("q_blocks", np.int64), ("q_rows", np.int32)))
                mine, theirs = np.frombuffer(r["vectors"], np.float64).reshape(len(ids), r["dim"]), np.frombuffer(r["q_vectors"], np.float64).reshape(len(js), r["dim"])
                if whole:
                    a, b = ([[int(x) for x in v] for v in m.tolist()] for m in (theirs, mine))
                    scores = np.array([[max(-MOST, min(MOST, sum(x * y for x, y in zip(u, v)))) for v in b] for u in a], object).reshape(len(a), len(b))
                else:
                    scores = theirs @ mine.T  # sums of whole numbers under 2**53
                usable = (labels == q_labels[:, None]) if same else (labels != q_labels[:, None])
                own = np.flatnonzero(q_blocks == r["block"])
                usable[own, q_rows[own]] = False
                bounds = zip(r["b_js"], r["b_slots"], r["b_lows"], r["b_highs"])
                for p, slot, low, high in bounds:
                    row = scores[p]
                    at = np.flatnonzero(usable[p] & (row >= least(low, high, percent)) & (row <= int(high)))
                    if len(at) > k and not whole:
                        at = at[row[at] >= np.partition(row[at], len(at) - k)[len(at) - k]]
                    best = sorted((-int(row[i]), int(ids[i])) for i in at.tolist())[:k]
                    out += [(r["q"], int(js[p]), slot, v, Decimal(-s) if whole else -s) for s, v in best]
            yield packed(found_schema(exact), out)

    return run


def found_schema(exact: str) -> str:
    return f"q long, j int, slot int, vec_id long, score {exact}"


class Index:
    """Rows (vec_id, label, embedding) sorted by (pivot, distance) in blocks, and what all tasks know of it."""

    def __init__(self, rows: DataFrame, scratch: Scratch, sample: int = SAMPLE) -> None:
        self.spark, self.scratch, context = rows.sparkSession, scratch, rows.sparkSession.sparkContext
        given = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("e")).where("vec_id is not null and label is not null and e is not null")
        self.rows = scratch.keep("rows", given.mapInArrow(clean, ROWS))
        seen = self.rows.agg(F.count("*").alias("n"), F.max("norm").alias("norm"), F.max("top").alias("top"), F.max("dim").alias("dim")).first()
        self.n, longest = seen["n"], seen["norm"] or 0.0
        #: Whether sums of products may pass 2**53: scores are then whole numbers of Python, and every ring is opened.
        self.whole = not longest < 2.0**52
        self.exact = "decimal(38,0)" if self.whole else "long"
        chosen = self.rows.orderBy(F.xxhash64("vec_id", "vector")).limit(sample).select("dim", "vector").toArrow().to_pylist()
        pivots = {}
        for dim in sorted({r["dim"] for r in chosen}) if not self.whole else ():
            mine = [r["vector"] for r in chosen if r["dim"] == dim]
            vectors = np.frombuffer(b"".join(mine), np.float64).reshape(len(mine), dim)
            pivots[dim] = fit(vectors, min(MOST_PIVOTS, max(LEAST_PIVOTS, isqrt(self.n) // 8))) if dim else np.zeros((1, 0))
        self.space = context.broadcast(Space(pivots, longest if not self.whole else 0.0))
        keyed = scratch.keep("keyed", self.rows.mapInArrow(assign(self.space), KEYED) if not self.whole else self.rows.selectExpr("vec_id", "label", "dim", "0 as pivot", "0D as distance", "vector"))
        per_pivot = max(1, self.n // max(1, max((len(p) for p in pivots.values()), default=1)))
        n_rings = int(min(MOST_RINGS, max(2, per_pivot // RING_ROWS)))
        scratch.drop("rows")
        cuts = keyed.groupBy("dim", "pivot").agg(F.percentile_approx("distance", [i / n_rings for i in range(1, n_rings)], 1000).alias("cuts")).collect()  # a row a pivot
        edges = context.broadcast({(r["dim"], r["pivot"]): np.unique(r["cuts"]) for r in cuts})
        order = ["dim", "pivot", "distance", "vec_id"]
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.n // (16 * BLOCK_ROWS))
        stored = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order, "label", "vector").mapInArrow(pack_rings(edges), BLOCKS)
        self.blocks = scratch.keep("blocks", stored)
        scratch.drop("keyed")
        known = self.blocks.groupBy("dim", "pivot", "ring").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.ceil(F.count("*") / GROUP_BLOCKS).cast("int").alias("groups"))
        known = scratch.keep("rings", known)
        rows_of_rings = [tuple(r) for r in known.collect()]  # MOST_PIVOTS * MOST_RINGS at most for each dimension
        self.rings, self.most = context.broadcast(Rings(rows_of_rings)), len(rows_of_rings)
        salted = self.blocks.join(F.broadcast(known.select("dim", "pivot", "ring", "groups")), ["dim", "pivot", "ring"])
        self.dealt = salted.withColumn("salt", F.pmod(F.xxhash64("block"), "groups").cast("int")).drop("groups", "low", "high", "n")

    def anchors(self, every: int) -> DataFrame:
        """QUERIES of the rows whose vec_id is divisible by every."""
        order = ["dim", "pivot", "distance", "vec_id", "block", "row"]
        picked = self.blocks.mapInArrow(pick_anchors(every), ANCHORS)
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.n // every // QUERY_ROWS)
        return self.scratch.keep("queries", picked.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(pack_queries, QUERIES))

    def first(self, queries: DataFrame, bounds: DataFrame, k: int, same: bool, percent: int, name: str) -> DataFrame:
        """Of each bound (q, j, slot, low, high) the first k rows by score, then vec_id, of the anchor's label or of others, with their places r from 1; with percent, as far as that share of high."""
        found, opened, step, n = [], 0, FIRST, 0
        while opened < self.most:
            now = bounds
            if found:
                reached = ranked(found[-1], k).groupBy("q", "j", "slot").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
                now = bounds.join(reached, ["q", "j", "slot"], "left").withColumn("low", F.when(F.col("n") >= k, F.greatest("low", "kth")).otherwise(F.col("low")))
            lists = now.groupBy("q").agg(F.collect_list(F.struct("j", "slot", "low", "high")).alias("b"))  # QUERY_ROWS times the slots at most
            asked = queries.join(lists, "q").select("q", "dim", "ids", "labels", "blocks", "rows", "vectors", F.col("b.j").alias("js"), F.col("b.slot").alias("slots"), F.col("b.low").alias("lows"), F.col("b.high").alias("highs"))
            asked = asked.repartition("q")
            last = min(self.most, opened + step)
            if last > self.most // 2:  # what is left is less than what has been opened
                last = self.most
            to = self.scratch.keep(f"{name}_visits_{n}", asked.mapInArrow(visits(self.space, self.rings, opened, last, percent, self.exact, self.whole), visit_schema(self.exact)))
            if to.isEmpty() and found:
                break  # gaps grow in this order: no later ring is nearer
            cells = to.join(self.dealt, ["dim", "pivot", "ring", "salt"]).mapInArrow(scan(k, same, percent, self.exact, self.whole), found_schema(self.exact))
            every = cells.unionByName(found[-1]) if found else cells
            found.append(self.scratch.keep(f"{name}_found_{n}", ranked(every, k).drop("r")))
            opened, step, n = last, step * STEP, n + 1
        if not found:
            return self.spark.createDataFrame([], f"{found_schema(self.exact)}, r int")
        return ranked(found[-1], k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.expr("cast(row_number() over (partition by q, j, slot order by score desc, vec_id) as int)")
    return found.withColumn("r", place).where(F.col("r") <= k)


def query_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            out += [(r["q"], j, v) for j, v in enumerate(np.frombuffer(r["ids"], np.int64).tolist())]
        yield packed("q long, j int, anchor_id long", out)


def within_long(score: Column) -> Column:
    return F.greatest(F.least(score, F.lit((1 << 63) - 1)), F.lit(-(1 << 63))).cast("long")


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """For the rows of vectors (vec_id, label, embedding) whose vec_id is divisible by every: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Null ids, labels and vectors and vectors with null or non-finite components
    (also times 256) take no part. An anchor is not its own positive; other
    rows of its vec_id are different rows. Vectors of another length than the
    anchor's are no candidates of it; empty ones have score 0. Ties go to the
    smaller vec_id. Positives without a negative in range give no rows. Scores
    are exact; beyond 38 digits they are taken for the nearest of 38, and given
    as the nearest long. Other columns are not read; an empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "negatives")
    index = Index(vectors, scratch)
    queries = index.anchors(every)
    places = scratch.keep("places", queries.mapInArrow(query_places, "q long, j int, anchor_id long"))
    ends = lambda x: F.lit(str(x)).cast(index.exact)
    whole = MOST if index.whole else 1 << 60
    near = index.first(queries, places.select("q", "j", F.lit(0).alias("slot"), ends(-whole).alias("low"), ends(whole).alias("high")), positives, True, 0, "near")
    near = scratch.keep("positives", near.select("q", "j", F.col("r").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    bounds = near.where("positive_score >= 0").select("q", "j", "slot", ends(0).alias("low"), F.col("positive_score").alias("high"))  # a share of a negative score is above it
    far = index.first(queries, bounds, negatives, False, percent, "far")
    pairs = far.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score", "r": "rank"}).join(near, ["q", "j", "slot"]).join(places, ["q", "j"])
    return pairs.select("anchor_id", "positive_id", "rank", "negative_id", within_long(F.col("positive_score")).alias("positive_score"), within_long(F.col("negative_score")).alias("negative_score"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")
    return hard_negatives(rows)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
