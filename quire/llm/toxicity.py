"""Toxic passages as maximum-scoring segments of token log-odds.

Learning, on a bounded sample of labelled rows (TRAIN_ROWS of either class, by
hash of doc_id): in how many toxic and other documents words and word
beginnings stand becomes log-odds under a Dirichlet prior (half a count, and
the pooled frequencies with the weight PRIOR); a feature is kept if the
likelihood ratio against equal shares, G squared, is at least MIN_G2. A token scores the log-odds of its word, or, where the word is
too rare to judge, of its longest known beginning; all other tokens score -GAP.

Scoring, over every whole text: one linear scan finds all maximal scoring
segments (each the best within any stretch that holds it and no better one).
Under a background of independent tokens the best score of n tokens has an
extreme-value distribution, P(S < x) = exp(-K n exp(-lambda x)); lambda solves
E[exp(lambda s)] = 1 over the background tokens of the sample and K is fitted
to its non-toxic documents. Segments whose chance in a document of that length
is under MAX_P are significant; a logistic curve fitted on the same sample
turns the best segment's and the significant segments' evidence into the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, tidy, utf8

TRAIN_ROWS = 20_000
PRIOR, MIN_G2, MIN_COUNT, GAP, MAX_P = 1000.0, 20.0, 5, 0.05, 0.01
BEGINNINGS = (6, 5, 4)
MAX_FEATURES = 50_000
REMEMBERED = 300_000
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def features(token: bytes) -> tuple[str, ...]:
    """The word without punctuation at its ends, and its beginnings, each with a star."""
    word = EDGES.sub("", token.decode("utf-8", "replace").lower())
    return (word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) > k)) if word else ()


def maximal_segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last + 1) in linear time.

    Tokens of one sign are first joined to runs; the scan keeps a list of
    candidates, each with the sums before it and at its end, and merges a new
    one leftwards while that gives a better segment.
    """
    positive = scores > 0
    if not positive.any():
        return []
    sums = np.r_[0.0, np.cumsum(scores)]
    edge = np.flatnonzero(np.diff(np.r_[False, positive, False].astype(np.int8)))
    found: list[tuple[float, float, int, int]] = []  # sum before, sum at the end, first, last + 1
    for a, b in edge.reshape(-1, 2).tolist():
        left, right = float(sums[a]), float(sums[b])
        while True:
            # candidates whose sum before is not lower cannot begin a better segment; what ends higher stands alone
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j -= 1
            if j < 0 or found[j][1] >= right:
                found.append((left, right, a, b))
                break
            left, a = found[j][0], found[j][2]
            del found[j:]
    return [(r - x, a, b) for x, r, a, b in found]


@dataclass
class Model:
    """What learning gives; its size is bounded by MAX_FEATURES."""

    odds: dict[str, float]
    judged: set[str]
    lam: float = 1.0
    k: float = 1.0
    curve: tuple[float, float] = (-1.0, 1.0)
    memory: dict[bytes, float] = field(default_factory=dict)

    def token(self, token: bytes) -> float:
        got = features(token)
        for i, f in enumerate(got):
            if f in self.odds:
                return self.odds[f]
            if i == 0 and f in self.judged:
                break
        return -GAP

    def scores(self, tokens: list[bytes]) -> np.ndarray:
        found = list(map(self.memory.get, tokens))
        if None in found:
            if len(self.memory) > REMEMBERED:
                self.memory.clear()
            new = {t: self.token(t) for t in {t for t, x in zip(tokens, found) if x is None}}
            self.memory.update(new)
            found = [new[t] if x is None else x for t, x in zip(tokens, found)]
        return np.array(found)

    def p_value(self, score: float, n: int) -> float:
        return -math.expm1(-self.k * max(n, 1) * math.exp(-self.lam * score))

    def evidence(self, text: bytes) -> tuple[float, list[tuple[float, int, int]]]:
        """Evidence in tens of decibans, and the significant segments."""
        tokens = text.split()
        segments = maximal_segments(self.scores(tokens)) if tokens else []
        tails = [(self.p_value(s, len(tokens)), s, a, b) for s, a, b in segments]
        best = min((t[0] for t in tails), default=1.0)
        good = [(s, a, b) for p, s, a, b in tails if p <= MAX_P]
        return min(30.0, -math.log10(max(best, 1e-30)) + math.log1p(max(0, len(good) - 1))), good

    def score(self, text: bytes) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.curve[0] + self.curve[1] * self.evidence(text)[0]))))


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, other = Counter(), Counter()
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), utf8(batch, "text")):
            (toxic if label else other).update({f for token in set(text.split()) for f in features(token)})
    keys = list(toxic.keys() | other.keys())
    for i in range(0, len(keys), 50_000):
        part = keys[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([toxic[x] for x in part], pa.int64()), pa.array([other[x] for x in part], pa.int64())], names=["feature", "toxic", "other"])


def solve_lambda(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum(weights * exp(lambda * values)) = 1."""
    low, high = 1e-6, 1.0
    excess = lambda x: float((weights * np.exp(np.minimum(x * values, 700))).sum()) - 1
    while excess(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of y on x by Newton steps with a little shrinkage; the slope is not negative."""
    design, w = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (y - p) - 0.1 * w
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 0.1 * np.eye(2), grad)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), max(0.0, float(w[1]))


def train(docs: DataFrame, labels: DataFrame, fold: int = 5, rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most rows labelled rows of either class, none of the held-out fold.

    Null labels and labels of unknown documents are left out. Without labels
    of both classes the model knows no features and every score is below 0.5.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", fold)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = [usable.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    sample = docs.select("doc_id", "text").join(F.broadcast(some[0].unionByName(some[1])), "doc_id").select("toxic", "text")  # 2 * rows ids at most
    sample = scratch.keep("sample", sample)
    counts = sample.mapInArrow(tidy(count_features), "feature string, toxic long, other long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    counts = scratch.keep("counts", counts.where((F.col("toxic") + F.col("other")) >= MIN_COUNT))
    whole = counts.where(~F.col("feature").endswith("*")).agg(F.sum("toxic").alias("t"), F.sum("other").alias("o")).first()
    t, o = float(whole["t"] or 0), float(whole["o"] or 0)
    if not t or not o:
        return Model({}, set())
    y, n = F.col("toxic"), F.col("toxic") + F.col("other")
    prior = 0.5 + PRIOR * n / (t + o)
    logit = lambda c, total: F.log((F.col(c) + prior) / (total + PRIOR - F.col(c)))
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    g2 = 2 * (part(y, n * t / (t + o)) + part(F.col("other"), n * o / (t + o)))
    kept = counts.withColumn("odds", logit("toxic", t) - logit("other", o)).withColumn("g2", g2).where((F.col("g2") >= MIN_G2) & (F.col("odds") > 1)).orderBy(F.desc("g2"), "feature").limit(MAX_FEATURES).select("feature", "odds", "toxic", "other").collect()
    model = Model({r["feature"]: r["odds"] for r in kept}, set())
    begins = {f[:-1] for f in model.odds if f.endswith("*")}
    if begins:  # words that were seen often enough to be judged by themselves, among those that a kept beginning could reach
        known = counts.where(~F.col("feature").endswith("*") & F.substring("feature", 1, min(BEGINNINGS)).isin(sorted({b[: min(BEGINNINGS)] for b in begins})))
        model.judged = {r["feature"] for r in known.orderBy(F.desc(F.col("toxic") + F.col("other")), "feature").limit(MAX_FEATURES).select("feature").collect()}
    by_value = Counter()
    for r in kept:
        if not r["feature"].endswith("*"):
            by_value[round(r["odds"], 3)] += r["other"]
    values = np.array([-GAP, *by_value, max(model.odds.values(), default=1.0)])
    weights = np.array([o, *by_value.values(), 0.5]) / (o + 0.5 + sum(by_value.values()))  # half a count: what the sample had none of may still come
    model.lam = solve_lambda(values, weights)
    seen = scratch.keep("seen", sample.mapInArrow(tidy(best_segments(model)), "toxic int, n long, best double"))
    background = seen.where("toxic = 0").selectExpr("avg(n) as n", f"avg(case when best > 0 then 1 else 0 end) as hit", f"avg(n * exp(-{model.lam} * best)) as tail").first()
    # the likelihood of the extreme-value distribution has its maximum where K is 1 over the mean of n exp(-lambda S)
    model.k = min(10.0, 1.0 / max(background["tail"] or 1.0, 1e-9))
    rows_seen = sample.mapInArrow(tidy(weigh_texts(model)), "toxic int, evidence double").toPandas()  # 2 * rows at most; the evidence that scoring sees
    x = rows_seen["evidence"].to_numpy(float)
    share = whole_share(usable)
    model.curve = fit_curve(x, rows_seen["toxic"].to_numpy(float)) if len(x) else (-1.0, 0.0)
    drawn = rows_seen["toxic"].mean() if len(x) else share
    if 0 < drawn < 1 and 0 < share < 1:  # classes were drawn alike; put the share of the labels back
        model.curve = (model.curve[0] + math.log(share / (1 - share)) - math.log(drawn / (1 - drawn)), model.curve[1])
    return model


def whole_share(labels: DataFrame) -> float:
    return labels.agg(F.avg("toxic").alias("s")).first()["s"] or 0.0


def best_segments(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, best = [], []
            for text in utf8(batch, "text"):
                tokens = text.split()
                found = maximal_segments(model.scores(tokens)) if tokens else []
                n.append(len(tokens))
                best.append(max((s for s, _, _ in found), default=0.0))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(n, pa.int64()), pa.array(best, pa.float64())], names=["toxic", "n", "best"])

    return run


def weigh_texts(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array([model.evidence(x)[0] for x in utf8(batch, "text")], pa.float64())], names=["toxic", "evidence"])

    return run


def held_out(column: str, fold: int, rest: int = 0):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % fold == rest, F.lit(False))


def score_texts(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = model.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([shared.score(x) for x in utf8(batch, "text")], pa.float64())], names=[*batch.schema.names, "toxic_score"])
        shared.memory.clear()

    return run


def toxic_segments(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant passage: doc_id, first and last word (last excluded), score, and the passage's text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d, a, b, s, b" ".join(x.split()[a:b]).decode("utf-8", "replace")) for d, x in zip(batch.column(0).to_pylist(), utf8(batch, "text")) for s, a, b in shared.value.evidence(x)[1]]
            yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "first", "last", "score", "passage"), r)) for r in rows], schema=pa.schema([("doc_id", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("passage", pa.string())]))

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, first int, last int, score double, passage string")


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """docs with toxic_score (0 to 1); null and empty texts have no segment and the lowest score; a column of that name is replaced."""
    docs = docs.drop("toxic_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_FEATURES words at most
    return docs.mapInArrow(tidy(score_texts(shared)), docs.select("*", F.lit(0.0).alias("toxic_score")).schema)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = F.col("toxic_score")
    return score_documents(docs, model).select("doc_id", held_out("doc_id", 5).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
