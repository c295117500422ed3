"""Exact k largest inner products by a uniform threshold in three phases.

Vectors are packed into blocks and each block is cut by dimensions: a slice of
a block is a row of its own, and no task sees another slice. The stated
queries, cut alike, meet every block in every slice.

1. Gather: each slice of each block lists its LISTED best a query, with its
   lowest and highest partial score. The other slices are asked for what they
   have of these; the k-th best of the exact sums is a cutoff that no result
   can be under.
2. Collect: less what the slices have at least, a result must reach the
   cutoff's equal share in some slice. The share is sent to all slices, and
   each gives the entries that reach it and can still make the cutoff with the
   other slices' best.
3. Resolve: what a slice has not given it is asked for by name; it adds its
   part and drops what cannot reach the cutoff any more. Complete sums are the
   exact scores.

Lists travel packed, one row for a block of queries and a block of candidates.
Where sums of products may pass 2**53 the phases run on scaled doubles with a
margin for rounding, and the slices give the parts of the entries that are left
as decimal text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

SLICES, BLOCK_ROWS, QUERY_ROWS, QUERIES_AT_ONCE, LISTED = 2, 16_384, 512, 128, 32
BLOCKS = "block long, slice int, dim int, top double, ids binary, vectors binary"
QUERIES = "q long, slice int, dim int, q_ids binary, q_vectors binary, own_block binary, own_row binary"
LISTS = "q long, j int, slice int, block long, low double, high double, rows array<int>, partials array<double>"
OPEN = "q long, block long, js binary, rows binary, sums binary, given binary"
SCORED = "q long, j int, block long, row int, vec_id long, total double"
EXACT = "q long, j int, block long, row int, vec_id long, exact string"
BROADCAST_BYTES = 64 << 20
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


def pack_vectors(block_rows: int, slices: int):
    """Blocks of rows of one dimension, floor(256 x) / 256 as doubles, one row for each slice; rows with a null or non-finite component are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, rows = (np.concatenate(x) for x in zip(*held.pop(dim)))
            made += 1
            edges = np.linspace(0, dim, slices + 1).astype(int)
            cut = [np.ascontiguousarray(rows[:, a:b]) for a, b in zip(edges, edges[1:])]
            columns = [[(part << 32) + made] * slices, range(slices), [dim] * slices, [float(np.abs(x).max(initial=0)) for x in cut], [ids.tobytes()] * slices, [x.tobytes() for x in cut]]
            return batch_of(BLOCKS, columns)

        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            valid = np.array(ids.is_valid()) & np.array(column.is_valid())
            lengths = np.array(column.value_lengths().fill_null(0))
            values, ends = column.flatten(), np.cumsum(lengths)
            flat = values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths[valid]).tolist():
                at = np.flatnonzero(valid & (lengths == dim))
                raw = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                good = np.isfinite(raw).all(1)
                raw = raw[good]
                small = np.abs(raw) < 2.0**52  # larger doubles are whole numbers
                rows = np.where(small, np.floor(np.where(small, raw, 0) * 256) / 256, raw)
                held.setdefault(dim, []).append((ids[at][good].astype(np.int64), rows))
                if sum(len(x) for x, _ in held[dim]) >= block_rows:
                    yield flush(dim)
        for dim in list(held):
            yield flush(dim)

    return run


TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64())}


def batch_of(schema: str, columns: list) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(x), TYPES[t]) for x, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def width(dim: int, s: int, slices: int) -> int:
    edges = np.linspace(0, dim, slices + 1).astype(int)
    return int(edges[s + 1] - edges[s])


def pick_queries(every: int, slices: int):
    """The rows whose vec_id is divisible by every, each with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                rows = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1) if row["vectors"] else np.zeros((len(ids), 0))
                chosen = np.flatnonzero(ids % every == 0)
                for i in range(0, len(chosen), QUERY_ROWS):
                    at = chosen[i : i + QUERY_ROWS]
                    parts = [x.tobytes() for x in (ids[at], rows[at], np.full(len(at), row["block"], np.int64), at.astype(np.int32))]
                    yield batch_of(QUERIES, [[row["block"] * 64 + i // QUERY_ROWS], [row["slice"]], [row["dim"]], *([x] for x in parts)])

    return run


def exact_products(q: np.ndarray, c: np.ndarray) -> list[str]:
    """Inner products of the whole numbers 256 q and 256 c for each row, without rounding, as text."""
    whole = lambda x: [int(y) * 256 if abs(y) >= 2.0**52 else int(y * 256) for y in x]
    mine = whole(q.tolist())
    return [str(sum(a * b for a, b in zip(mine, whole(r)))) for r in c.tolist()]


class Cell:
    """A slice of a block of candidates and of a block of queries."""

    def __init__(self, row: dict, slices: int, scale: float) -> None:
        self.ids, n = np.frombuffer(row["ids"], np.int64), width(row["dim"], row["slice"], slices)
        shaped = lambda x, ids: np.frombuffer(row[x], np.float64).reshape(-1, n) if n else np.zeros((len(row[ids]) // 8, 0))
        self.c_raw, self.q_raw, self.scale = shaped("vectors", "ids"), shaped("q_vectors", "q_ids"), scale
        self.c = self.c_raw * scale
        self.own = np.where(np.frombuffer(row["own_block"], np.int64) == row["block"], np.frombuffer(row["own_row"], np.int32), -1)

    def scores(self) -> Iterator[tuple[int, np.ndarray]]:
        """Partial scores of each query against all candidates."""
        for a in range(0, len(self.q_raw), QUERIES_AT_ONCE):
            for i, row in enumerate((self.q_raw[a : a + QUERIES_AT_ONCE] * self.scale) @ self.c.T):
                yield a + i, row

    def some(self, js: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Partial scores of pairs of a query and a candidate."""
        out = np.empty(len(js))
        for i in range(0, len(js), 1 << 16):
            out[i : i + (1 << 16)] = np.einsum("ij,ij->i", self.q_raw[js[i : i + (1 << 16)]] * self.scale, self.c[rows[i : i + (1 << 16)]])
        return out


def cells_in(batches: Iterator[pa.RecordBatch], *how) -> Iterator[tuple[dict, Cell]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row, Cell(row, *how)


def gather(listed: int, *how):
    """Phase 1: of each slice the best for each query, and its lowest and highest partial score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, cell in cells_in(batches, *how):
            out = []
            for j, scores in cell.scores():
                usable = np.flatnonzero(np.arange(len(scores)) != cell.own[j]) if cell.own[j] >= 0 else np.arange(len(scores))
                if len(usable):
                    mine = scores[usable]
                    best = np.argpartition(mine, len(mine) - listed)[len(mine) - listed :] if len(mine) > listed else np.arange(len(mine))
                    out.append((row["q"], j, row["slice"], row["block"], float(mine.min()), float(mine.max()), usable[best].tolist(), mine[best].tolist()))
            yield batch_of(LISTS, list(zip(*out)) if out else [[]] * 8)

    return run


def collect(*how):
    """Phase 2: the entries that reach their query's share, and with the other slices' best its cutoff."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, cell in cells_in(batches, *how):
            least, out = dict(zip(row["cut_js"], row["cuts"])), []
            for j, scores in cell.scores():
                at = np.flatnonzero(scores >= least[j]) if j in least else np.zeros(0, np.int64)
                at = at[at != cell.own[j]]
                if len(at):
                    out.append((row["q"], j, row["slice"], row["block"], 0.0, 0.0, at.tolist(), scores[at].tolist()))
            yield batch_of(LISTS, list(zip(*out)) if out else [[]] * 8)

    return run


def merge(key: tuple[pa.Scalar, ...], lists: pa.Table) -> pa.Table:
    """The lists of all slices for one pair of blocks as one: sums of what was given, and a bit for each slice that gave it."""
    sizes = np.array([len(x) for x in lists["rows"].to_pylist()], np.int64)
    js = np.repeat(lists["j"].to_numpy().astype(np.int64), sizes)
    bits = np.repeat(np.int64(1) << lists["slice"].to_numpy().astype(np.int64), sizes)
    rows, partials = (lists[c].combine_chunks().flatten().to_numpy() for c in ("rows", "partials"))
    pair, at = np.unique(js << np.int64(32) | rows.astype(np.int64), return_inverse=True)
    sums, given = np.bincount(at, weights=partials, minlength=len(pair)), np.bincount(at, weights=bits, minlength=len(pair))
    columns = [(pair >> 32).astype(np.int32), (pair & 0xFFFFFFFF).astype(np.int32), sums, given.astype(np.int32)]
    return pa.table([pa.array([key[0].as_py()]), pa.array([key[1].as_py()]), *(pa.array([x.tobytes()], pa.binary()) for x in columns)], names=[x.split()[0] for x in OPEN.split(", ")])


def unpack(row: dict) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(row[c], t) for c, t in (("js", np.int32), ("rows", np.int32), ("sums", np.float64), ("given", np.int32)))


def resolve(s: int, slices: int, last: bool, *how):
    """Phase 3 in slice s: its part of the entries that it has not given; entries that cannot reach the cutoff go. From the last slice complete entries come one a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, cell in cells_in(batches, slices, *how):
            js, rows, sums, given = unpack(row)
            mine = np.flatnonzero(given & (1 << s) == 0)
            sums = sums.copy()
            sums[mine] += cell.some(js[mine], rows[mine])
            if row["cut_js"] is not None:
                cut = np.full(len(cell.q_raw), -np.inf)
                cut[row["cut_js"]] = row["totals"]
                # slices after this one that have not given an entry have their highest at most
                highs = np.array(row["highs"]).reshape(len(row["cut_js"]), slices)
                room = np.zeros((len(cell.q_raw), slices))
                room[row["cut_js"]] = highs
                more = sum((np.where(given & (1 << t) == 0, room[js, t], 0.0) for t in range(s + 1, slices)), np.zeros(len(js)))
                stays = sums + more >= cut[js]
                js, rows, sums, given = js[stays], rows[stays], sums[stays], given[stays]
            if last:
                n = len(js)
                yield batch_of(SCORED, [[row["q"]] * n, js, [row["block"]] * n, rows, cell.ids[rows], sums])
            elif len(js):
                yield batch_of(OPEN, [[row["q"]], [row["block"]], [js.tobytes()], [rows.tobytes()], [sums.tobytes()], [given.tobytes()]])

    return run


def exact_parts(*how):
    """A slice's parts of the entries asked for, without rounding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, cell in cells_in(batches, *how):
            n, text = len(row["ask_js"]), [exact_products(cell.q_raw[j], cell.c_raw[r : r + 1])[0] for j, r in zip(row["ask_js"], row["ask_rows"])]
            rows = np.array(row["ask_rows"], np.int64)
            yield batch_of(EXACT, [[row["q"]] * n, row["ask_js"], [row["block"]] * n, rows, cell.ids[rows], text])

    return run


def rank_exactly(k: int):
    """Of a query's entries with exact scores as text the k best; scores beyond 64 bits are given as the nearest long."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        found = sorted((-sum(map(int, x)), v) for x, v in zip(rows["exact"].to_pylist(), rows["vec_id"].to_pylist()))[:k]
        n = len(found)
        scores = [min(max(-s, LEAST_LONG), MOST_LONG) for s, _ in found]
        return pa.table({"q": pa.array([key[0].as_py()] * n, pa.int64()), "j": pa.array([key[1].as_py()] * n, pa.int32()), "rank": pa.array(range(1, n + 1), pa.int32()), "vec_id": pa.array([v for _, v in found], pa.int64()), "score": pa.array(scores, pa.int64())})

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, block_rows: int = BLOCK_ROWS, slices: int = SLICES) -> DataFrame:
    """The k best candidates of each query among vectors (vec_id, embedding): query_id, rank, vec_id, score.

    Null ids, null vectors and vectors with null or non-finite components take
    no part. Rows with equal vec_id are different rows: a query leaves out its
    own row only, and repeated query rows give their results once each.
    Vectors of another length than the query's are no candidates of it. Where
    fewer than k candidates exist all are returned. Ranks follow the exact
    scores; a score beyond 64 bits is given as the nearest long. Other columns
    are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    blocks = scratch.keep("blocks", vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(pack_vectors(block_rows, slices), BLOCKS))
    queries = scratch.keep("queries", blocks.mapInArrow(pick_queries(every, slices), QUERIES))
    seen = blocks.agg(F.max("top").alias("top"), F.max("dim").alias("dim")).first()
    top, dim = seen["top"] or 0.0, seen["dim"] or 0
    wide = dim * (256 * max(1.0, top)) ** 2 >= 2.0**53 if top < 1e100 else True
    scale = 2.0 ** -np.ceil(np.log2(top)) if wide else 256.0
    margin = dim * 2.0**-48 if wide else 0.5  # scaled components are 1 at most; else partial scores are whole numbers
    how = (slices, float(scale))
    size = queries.agg(F.sum(F.octet_length("q_vectors")).alias("b")).first()["b"] or 0
    small = F.broadcast if size <= BROADCAST_BYTES else lambda x: x
    if size <= BROADCAST_BYTES:
        cells = blocks.drop("top").join(F.broadcast(queries), ["dim", "slice"])
    else:  # every query block goes to every block of candidates, over a shuffle by the candidates' block
        pairs = queries.select("q", "dim", "slice").join(blocks.select("block", "dim", "slice"), ["dim", "slice"])
        cells = blocks.drop("top").join(pairs.select("block", "slice", "q"), ["block", "slice"]).join(queries.drop("dim"), ["q", "slice"])
    cells = cells.repartition(max(8, spark.sparkContext.defaultParallelism), "block", "slice", "q")
    query = ["q", "j"]

    def complete(lists: DataFrame, cutoffs: DataFrame | None) -> DataFrame:
        """The sums of listed entries, all slices' parts taken together."""
        found = lists.groupBy("q", "block").applyInArrow(merge, OPEN)
        for s in range(slices):
            asked = found.join(blocks.where(F.col("slice") == s).drop("top"), "block").join(small(queries.where(F.col("slice") == s).drop("dim", "slice")), "q")
            if cutoffs is None:
                asked = asked.withColumn("cut_js", F.lit(None).cast("array<int>"))
            else:
                asked = asked.join(cutoffs, "q")
            last = s == slices - 1
            found = asked.mapInArrow(resolve(s, slices, last, *how[1:]), SCORED if last else OPEN)
        return found

    gathered = scratch.keep("gathered", cells.mapInArrow(gather(max(k, LISTED), *how), LISTS))
    ends = gathered.groupBy("q", "j", "slice").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ends = ends.groupBy(*query).agg(F.sum("low").alias("floor"), F.sum(F.col("high") - F.col("low")).alias("span"), F.transform(F.array_sort(F.collect_list(F.struct("slice", "low", "high"))), lambda x: F.struct(x.low.alias("low"), x.high.alias("high"))).alias("ends"))
    best = complete(gathered, None).selectExpr("q", "j", "total", "row_number() over (partition by q, j order by total desc) as r").where(F.col("r") <= k)
    kth = best.groupBy(*query).agg(F.min("total").alias("kth"), F.count("*").alias("n")).select(*query, F.when(F.col("n") >= k, F.col("kth") - margin).alias("kth"))
    # where a query has fewer than k candidates the cutoff is what all slices have at least
    bounds = ends.join(kth, query, "left").withColumn("total", F.greatest(F.coalesce("kth", F.col("floor")), F.col("floor")) - margin).withColumn("cut", F.col("total") - F.col("floor"))
    least = lambda e: F.greatest(e.low + F.col("cut") / slices, e.high + F.col("cut") - F.col("span")) - margin
    bounds = scratch.keep("bounds", bounds.select(*query, "total", F.transform("ends", least).alias("least"), F.transform("ends", lambda e: e.high).alias("highs")))
    shares = bounds.select("q", "j", F.posexplode("least").alias("slice", "least")).groupBy("q", "slice").agg(F.collect_list(F.struct("j", "least")).alias("c")).select("q", "slice", F.col("c.j").alias("cut_js"), F.col("c.least").alias("cuts"))  # QUERY_ROWS at most
    collected = cells.join(shares, ["q", "slice"]).mapInArrow(collect(*how), LISTS)
    totals = bounds.groupBy("q").agg(F.collect_list(F.struct("j", "total", "highs")).alias("c")).select("q", F.col("c.j").alias("cut_js"), F.col("c.total").alias("totals"), F.flatten("c.highs").alias("highs"))
    done = scratch.keep("done", complete(collected, totals))
    if wide:
        asked = done.groupBy("q", "block").agg(F.collect_list(F.struct("j", "row")).alias("c")).select("q", "block", F.col("c.j").alias("ask_js"), F.col("c.row").alias("ask_rows"))
        parts = asked.join(blocks.drop("top"), "block").join(queries.drop("dim"), ["q", "slice"]).mapInArrow(exact_parts(*how), EXACT)
        whole = parts.groupBy("q", "j", "block", "row", "vec_id").agg(F.collect_list("exact").alias("exact"))
        ranked = whole.groupBy(*query).applyInArrow(rank_exactly(k), "q long, j int, rank int, vec_id long, score long")
    else:
        scored = done.select("q", "j", "vec_id", F.col("total").cast("long").alias("score"))
        ranked = scored.selectExpr("q", "j", "vec_id", "score", "cast(row_number() over (partition by q, j order by score desc, vec_id) as int) as rank").where(F.col("rank") <= k)
    names = queries.where("slice = 0").select("q", "q_ids").mapInArrow(query_places, "q long, j int, query_id long")
    return ranked.join(names, query).select("query_id", "rank", "vec_id", "score")


def query_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["q_ids"], np.int64)
            yield batch_of("q long, j int, query_id long", [np.full(len(ids), row["q"], np.int64), range(len(ids)), ids])


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
