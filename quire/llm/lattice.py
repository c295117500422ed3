"""Document likelihood under a subword lattice.

A word's spellings are all ways to cut it into pieces of an existing
vocabulary; their probabilities are added by a forward recursion in log space.
The vocabulary's own scores (ranks of its merges) give the first weights of
the pieces, and EM_ROUNDS rounds over the training words fit them. A word that
training has seen also has an arc of its own:

    P(w) = (c - D(c) + (sum of D + 0.5) B(w)) / (N + 1)

c: its count, N: all tokens, D: discounts for counts of one, two and more,
from the counts of counts, B: the lattice's sum. The end of a text has
P = (ends + 0.5) / (N + 1), less its discount.

A text is drawn from a mixture: one component for all training texts and one
for each of the COMPONENTS most frequent values of a column such as lang, with
its own counts and piece weights; there B is half the lattice's sum and half
the word's probability in the component for all. The column is read from
training rows only; scoring adds the components' probabilities up.

Words are counted, fitted and scored once each, as a distributed table. The
HOT most frequent words' scores go to every task; all other occurrences are
joined to the table by a shuffle, so nothing that is sent to all tasks grows
with the vocabulary.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, utf8
from .toxicity import held_out

COMPONENTS, EM_ROUNDS, HOT, STEM, FLUSH = 8, 2, 500_000, 12, 400_000
MATRIX_CELLS, SLOTS = 1 << 16, 18
#: Longer words are summed place by place, one at a time.
LONG = 192
MULTIPLIER = np.uint64(0x100000001B3)


class Pieces:
    """The vocabulary: hashes of the pieces that may begin a word and of those that may go on, both sorted."""

    def __init__(self, file: str) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_file=file)
        begin, go_on, ranks = {}, {}, []
        self.alone = None  # the bare word mark, before pieces that go on
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            if sp.is_byte(i):
                raw, to = bytes([int(piece[3:5], 16)]), go_on
                if raw in go_on:
                    continue
            elif piece == "▁":
                self.alone = len(ranks)
                ranks.append(-sp.get_score(i))
                continue
            elif piece.startswith("▁"):
                raw, to = piece[1:].encode(), begin
            else:
                raw, to = piece.encode(), go_on
            if raw and b"\xe2\x96\x81" not in raw and raw == raw.lower():
                to[raw] = len(ranks)
                ranks.append(max(0.0, -sp.get_score(i)))
        for b in range(256):  # every byte can be spelled
            if bytes([b]) not in go_on:
                go_on[bytes([b])] = len(ranks)
                ranks.append(float(max(ranks)))
        if self.alone is None:
            self.alone = len(ranks)
            ranks.append(0.0)
        self.n = len(ranks)
        first = 1.0 / (1000.0 + np.array(ranks))
        self.first = np.log(first / first.sum())
        self.begin, self.go_on = self.index(begin), self.index(go_on)
        # beyond STEM bytes only words that hold the beginning of a longer piece are looked up
        self.longest = max(map(len, [*begin, *go_on]))
        self.stems = self.index({p[:STEM]: 0 for p in [*begin, *go_on] if len(p) > STEM})

    @staticmethod
    def index(pieces: dict[bytes, int]) -> list[tuple[np.uint64, np.ndarray, np.ndarray]]:
        """Hash tables with one place a slot: what finds its slot taken goes to the next table."""
        hashes, ids, tables = np.array([hash_bytes(p) for p in pieces], np.uint64), np.array(list(pieces.values()), np.int32), []
        while len(hashes):
            multiplier = np.uint64(0x9E3779B97F4A7C15 + 2 * len(tables) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)
            slot, keys, values = (hashes * multiplier) >> np.uint64(64 - SLOTS), np.zeros(1 << SLOTS, np.uint64), np.full(1 << SLOTS, -1, np.int32)
            _, first = np.unique(slot, return_index=True)
            keys[slot[first]], values[slot[first]] = hashes[first], ids[first]
            left = np.ones(len(hashes), bool)
            left[first] = False
            hashes, ids = hashes[left], ids[left]
            tables.append((multiplier, keys, values))
        return tables


def hash_bytes(raw: bytes) -> int:
    h = 0
    for b in raw:
        h = (h * int(MULTIPLIER) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def look_up(index: list[tuple[np.uint64, np.ndarray, np.ndarray]], hashes: np.ndarray) -> np.ndarray:
    out = np.full(len(hashes), -1, np.int32)
    for multiplier, keys, values in index:
        slot = (hashes * multiplier) >> np.uint64(64 - SLOTS)
        np.copyto(out, values[slot], where=keys[slot] == hashes)
    return out


@lru_cache(2)
def pieces(name: str) -> Pieces:
    return Pieces(name if os.sep in name else public_tokenizers.path(name))


def arcs(vocabulary: Pieces, words: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, bool]]:
    """Arcs of words of one length (a matrix of bytes): from, to, piece or -1 for each word, whether it begins the word."""
    n, length = words.shape
    for i in range(length):
        h, rows = np.zeros(n, np.uint64), slice(None)
        for j in range(i, min(length, i + vocabulary.longest)):
            if j == i + STEM:
                rows = np.flatnonzero(look_up(vocabulary.stems, h) >= 0)
                if not len(rows):
                    break
                h = h[rows]
            h = h * MULTIPLIER + words[rows, j] + np.uint64(1)
            for index, begins in ((vocabulary.begin, True), (vocabulary.go_on, False)):
                if (i == 0 or not begins) and (got := look_up(index, h)).max() >= 0:
                    all_rows = np.full(n, -1, np.int32)
                    all_rows[rows] = got
                    yield i, j + 1, all_rows, begins


def long_arcs(vocabulary: Pieces, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Arcs of one long word, all places at once for each length of a piece: from, to, piece, whether it begins the word; by where they end."""
    n, found = len(word), []
    h, at = np.zeros(n, np.uint64), np.arange(n)
    for size in range(1, min(n, vocabulary.longest) + 1):
        at = at[at + size <= n]
        if size == STEM + 1:
            at = at[look_up(vocabulary.stems, h[at]) >= 0]
        if not len(at):
            break
        h[at] = h[at] * MULTIPLIER + word[at + size - 1] + np.uint64(1)
        piece = look_up(vocabulary.go_on, h[at])
        some = np.flatnonzero(piece >= 0)
        found.append((at[some], at[some] + size, piece[some], np.zeros(len(some), bool)))
        if at[0] == 0 and (first := look_up(vocabulary.begin, h[:1])[0]) >= 0:
            found.append((at[:1], at[:1] + size, np.array([first], np.int32), np.ones(1, bool)))
    start, end, piece, begins = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(end, kind="stable")
    return start[order], end[order], piece[order], begins[order]


def recursion(n: int, size: int, at: np.ndarray, before: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Sums in log space over arcs (sorted by at, from 1 to n) that come from before."""
    out = np.full((n + 1, size), -np.inf)
    out[0] = 0
    cuts = np.searchsorted(at, np.arange(1, n + 2))
    for j, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist()), 1):
        x = out[before[a:b]] + step[a:b]  # every byte is a piece, so there is an arc
        top = x.max(0)
        out[j] = top + np.log(np.exp(x - top).sum(0))
    return out


def long_word(vocabulary: Pieces, weights: np.ndarray, word: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
    """Log probabilities of one long word, or with times the expected uses of pieces: time and memory are in proportion to its length."""
    start, end, piece, begins = long_arcs(vocabulary, word)
    n, marked = len(word), (start == 0) & ~begins
    step = weights[:, piece].T + np.where(marked[:, None], weights[:, vocabulary.alone], 0.0)
    alpha = recursion(n, len(weights), end, start, step)
    if times is None:
        return alpha[n]
    back = np.argsort(n - start, kind="stable")
    beta = recursion(n, len(weights), (n - start)[back], (n - end)[back], step[back])[::-1]
    mass = np.exp(alpha[start] + step + beta[end] - alpha[n]) * times
    out = np.stack([np.bincount(piece, weights=m, minlength=vocabulary.n) for m in mass.T])
    out[:, vocabulary.alone] += mass[marked].sum(0)
    return out


def forward(vocabulary: Pieces, weights: np.ndarray, words: np.ndarray, kept: list | None = None) -> np.ndarray:
    """Log probability of each word over all its segmentations, for each row of weights."""
    n, length = words.shape
    if length > LONG:
        return np.stack([long_word(vocabulary, weights, w) for w in words], 1)
    padded = np.c_[weights, np.full(len(weights), -np.inf)]  # piece -1 has no probability
    alpha = np.full((length + 1, len(weights), n), -np.inf)
    alpha[0] = 0
    for i, j, piece, begins in arcs(vocabulary, words):
        some = np.flatnonzero(piece >= 0)
        step = padded[:, piece[some]]
        if i == 0 and not begins:
            step = step + weights[:, vocabulary.alone, None]
        alpha[j][:, some] = np.logaddexp(alpha[j][:, some], alpha[i][:, some] + step)
        if kept is not None:
            kept.append((i, j, some, piece[some], begins, step))
    if kept is not None:
        kept.append(alpha)
    return alpha[length]


def expected(vocabulary: Pieces, weights: np.ndarray, words: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over the segmentations of words; times: how often each word counts for each row of weights."""
    if words.shape[1] > LONG:
        return sum(long_word(vocabulary, weights, w, t) for w, t in zip(words, times.T))
    kept: list = []
    total = forward(vocabulary, weights, words, kept)
    alpha = kept.pop()
    beta = np.full_like(alpha, -np.inf)
    beta[-1] = 0
    out = np.zeros((len(weights), vocabulary.n))
    for i, j, some, piece, begins, step in reversed(kept):  # arcs into j come before arcs out of it
        through = step + beta[j][:, some]
        beta[i][:, some] = np.logaddexp(beta[i][:, some], through)
        mass = np.exp(alpha[i][:, some] + through - total[:, some]) * times[:, some]
        for k in range(len(weights)):
            out[k] += np.bincount(piece, weights=mass[k], minlength=vocabulary.n)
        if i == 0 and not begins:
            out[:, vocabulary.alone] += mass.sum(1)
    return out


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Batches joined to larger ones: a matrix should have many words of its length."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def matrices(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and byte matrices of words of equal length, of bounded size."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        step = max(1, MATRIX_CELLS // max(1, length))
        for i in range(0, len(at), step):
            some = at[i : i + step]
            yield some, np.frombuffer(b"".join([words[k] for k in some.tolist()]), np.uint8).reshape(len(some), length).astype(np.uint64)


def count_words(k: int):
    """Uses of each word in all texts, in training texts, and in the training texts of each of k components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {i: Counter() for i in range(-2, k)}  # -2: held out, -1: no component

        def flush() -> pa.RecordBatch:
            keys = list(set().union(*counts.values()))
            c = np.array([[counts[i][w] for w in keys] for i in range(-1, k)], np.int64).reshape(k + 1, len(keys))
            c[0] = c.sum(0)
            uses = c[0] + np.array([counts[-2][w] for w in keys], np.int64)
            for x in counts.values():
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(uses), *map(pa.array, c)], names=["word", "uses", *(f"c{i}" for i in range(k + 1))])

        for batch in batches:
            for part, text in zip(batch.column(0).to_pylist(), utf8(batch, "text")):
                counts[part].update(text.lower().split())
                if sum(map(len, counts.values())) > FLUSH:
                    yield flush()
        yield flush()

    return run


def expected_uses(name: str, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, w = pieces(name), weights.value
        total = np.zeros(w.shape)
        for batch in gathered(batches):
            words, c = batch.column(0).to_pylist(), np.stack([batch.column(i + 1).to_numpy() for i in range(len(w))])
            alone = c[0] > c[1:].sum(0)  # uses in no component, learned by the first only
            for k in range(len(w)):
                mine = np.flatnonzero(alone if k == 0 else c[k] > 0)
                some = [words[i] for i in mine.tolist()]
                for at, matrix in matrices(some):
                    total[k] += expected(vocabulary, w[k : k + 1], matrix, np.ones((1, len(at))))[0]
        k, piece = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(total[k, piece])], names=["k", "piece", "uses"])

    return run


class Counts:
    """A component's counts: tokens, ends, discounts, and the mass that the discounts leave."""

    def __init__(self, tokens: int, ends: int, of: list[int]) -> None:
        """of: how many words have the counts 1, 2, 3, 4, and 3 or more."""
        self.n, self.ends = tokens + ends, ends
        n1, n2, n3, n4, _ = of
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        more = [i - (i + 1) * y * b / a if a and b else 0.5 * i for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        self.discounts = np.array([0.0, *(min(max(x, 0.1), i * 0.9) for i, x in enumerate(more, 1))])
        self.left = float(self.discounts[1] * n1 + self.discounts[2] * n2 + self.discounts[3] * of[4])
        self.end = math.log((max(ends - self.discounts[min(ends, 3)], 0) + 0.5) / (self.n + 1))

    def log_p(self, c: np.ndarray, back: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(c - self.discounts[np.minimum(c, 3)]), math.log(self.left + 0.5) + back) - math.log(self.n + 1)


def score_words(name: str, weights, counts: list[Counts], types: int):
    """log P of each word in each component, and log10 of the base."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, w = pieces(name), weights.value
        for batch in gathered(batches):
            words, c = batch.column(0).to_pylist(), [batch.column(2 + i).to_numpy().astype(np.int64) for i in range(len(w))]
            spelled = np.empty((len(w), len(words)))
            for at, matrix in matrices(words):
                spelled[:, at] = forward(vocabulary, w, matrix)
            scores = [counts[0].log_p(c[0], spelled[0])]
            for k in range(1, len(w)):
                scores.append(counts[k].log_p(c[k], np.logaddexp(spelled[k], scores[0]) - math.log(2)))
            base = np.log10((c[0] + 1) / (counts[0].n + types + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(c[0] > 0), *map(pa.array, scores), pa.array(base)], names=["word", "uses", "known", *(f"s{k}" for k in range(len(w))), "base"])

    return run


class Known(dict):
    """Places of frequent words; -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


def score_texts(hot, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (places, known, scores, base), part, made = hot.value, TaskContext.get().partitionId(), 0
        get = places.__getitem__
        for batch in batches:
            n, n_known, s, b, rare = [], [], [], [], []
            for text in utf8(batch, "text"):
                words = text.lower().split()
                found = list(map(get, words))
                at = np.array(found, np.int64)
                at = at[at >= 0]
                n.append(len(words))
                n_known.append(int(known[at].sum()))
                s.append(scores[at].sum(0))
                b.append(float(base[at].sum()))
                rare.append([w for w, i in zip(words, found) if i < 0] if len(at) < len(words) else [])
            keys = (part << 40) + made + np.arange(len(n))
            made += len(n)
            sums = np.array(s).reshape(len(n), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.int64()), pa.array(n, pa.int64()), pa.array(n_known, pa.int64()), *(pa.array(np.ascontiguousarray(sums[:, i])) for i in range(k)), pa.array(b, pa.float64()), pa.array(rare, pa.list_(pa.binary()))],
                names=["doc_id", "held_out", "key", "n_tokens", "n_known", *(f"s{i}" for i in range(k)), "base", "rare"],
            )

    return run


def score_corpus(docs: DataFrame, held, component: str | None = None, vocabulary: str = "piece_bpe_32k.model", em_rounds: int = EM_ROUNDS) -> DataFrame:
    """Score docs (doc_id, text) with a model of those rows where the condition held is false.

    component: a column whose values name the mixture's components in training.

    Columns: doc_id, held_out, n_tokens (words and the end), n_known,
    train_tokens, base_score and score (log10). A null text is empty: its only
    token is the end. Rows with a null condition are learned from. Rows with
    equal doc_id are scored each by itself. Without training rows every word
    is spelled, and the end has half a count.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lattice")
    texts = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), F.col(component).cast("string").alias("component") if component else F.lit(None).cast("string").alias("component"), "text")
    trained = texts.where(~F.col("held_out"))
    ends = trained.count()
    by_name = trained.where(F.col("component").isNotNull()).groupBy("component").count().orderBy(F.desc("count"), "component").limit(COMPONENTS).collect()
    names, k = [r["component"] for r in by_name], len(by_name) + 1
    place = F.coalesce(F.array_position(F.array(*map(F.lit, names)), F.col("component")) - 1, F.lit(-1)) if names else F.lit(-1)
    marked = texts.select(F.when(F.col("held_out"), F.lit(-2)).otherwise(place).cast("int").alias("part"), "text")
    c = [f"c{i}" for i in range(k)]
    words = marked.mapInArrow(count_words(k - 1), f"word binary, uses long, {', '.join(f'{x} long' for x in c)}").groupBy("word").agg(*(F.sum(x).alias(x) for x in ("uses", *c)))
    words = scratch.keep("words", words)
    totals = words.agg(*(f(x).alias(f"{t}_{x}") for x in c for t, f in [("n", F.sum), *((f"w{i}", lambda x, i=i: F.count_if(F.col(x) == i)) for i in (1, 2, 3, 4)), ("more", lambda x: F.count_if(F.col(x) >= 3)), ("types", lambda x: F.count_if(F.col(x) > 0))])).first()
    docs_in = [ends, *(r["count"] for r in by_name)]
    counts = [Counts(totals[f"n_{x}"] or 0, docs_in[i], [totals[f"{t}_{x}"] or 0 for t in ("w1", "w2", "w3", "w4", "more")]) for i, x in enumerate(c)]
    types = (totals["types_c0"] or 0) + (ends > 0)
    model = pieces(vocabulary)
    weights = np.tile(model.first, (k, 1))
    for _ in range(em_rounds):
        uses = words.where(F.col("c0") > 0).select("word", *c).mapInArrow(expected_uses(vocabulary, spark.sparkContext.broadcast(weights)), "k int, piece int, uses double").groupBy("k", "piece").agg(F.sum("uses").alias("uses")).collect()  # a row for each piece and component at most
        fitted = np.tile(np.exp(model.first), (k, 1))  # in all one use, as a prior
        for r in uses:
            fitted[r["k"], r["piece"]] += r["uses"]
            if r["k"]:
                fitted[0, r["piece"]] += r["uses"]  # the component for all has every use
        weights = np.log(fitted / fitted.sum(1, keepdims=True))
    sums = [f"s{i}" for i in range(k)]
    scored = words.mapInArrow(score_words(vocabulary, spark.sparkContext.broadcast(weights), counts, types), f"word binary, uses long, known boolean, {', '.join(f'{x} double' for x in sums)}, base double")
    scored = scratch.keep("scored", scored)
    by_uses = scored.groupBy(F.least("uses", F.lit(1 << 20)).alias("u")).agg(F.count("*").alias("n")).orderBy(F.desc("u")).collect()  # 2**20 rows at most
    least, room = (1 << 20) + 1, HOT  # uses from which words are sent to all tasks: as low as HOT words allow
    for r in by_uses:
        room -= r["n"]
        if room < 0:
            break
        least = r["u"]
    hot = scored.where(F.col("uses") >= least).select("word", "known", *sums, "base").toArrow()
    places = Known(zip(hot["word"].to_pylist(), range(hot.num_rows)))
    table = np.stack([hot[x].to_numpy() for x in sums], 1) if hot.num_rows else np.zeros((0, k))
    shared = spark.sparkContext.broadcast((places, hot["known"].to_numpy(), table, hot["base"].to_numpy()))
    fields = ", ".join(f"{x} double" for x in sums)
    first = texts.select("doc_id", "held_out", "text").mapInArrow(score_texts(shared, k), f"doc_id long, held_out boolean, key long, n_tokens long, n_known long, {fields}, base double, rare array<binary>")
    first = scratch.keep("texts", first)
    rare = first.select("key", F.explode("rare").alias("word")).join(scored.where(F.col("uses") < least), "word")
    rare = rare.groupBy("key").agg(*(F.sum(x).alias(f"r_{x}") for x in (*sums, "base")), F.count_if("known").alias("r_known"))
    of = lambda x: F.col(x) + F.coalesce(f"r_{x}", F.lit(0.0))
    logs = [of(x) + F.lit(counts[i].end + math.log((docs_in[i] + 1) / (sum(docs_in) + k))) for i, x in enumerate(sums)]
    most = F.greatest(*logs) if k > 1 else logs[0]
    total = most + F.log(sum((F.exp(x - most) for x in logs), F.lit(0.0)))
    return first.drop("rare").join(rare, "key", "left").select(
        "doc_id", "held_out", (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_known") + F.coalesce("r_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(counts[0].n).cast("long").alias("train_tokens"),
        (of("base") + math.log10((ends + 1) / (counts[0].n + types + 1))).alias("base_score"),
        (total / math.log(10)).alias("score"),
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(spark.read.parquet(f"{sf_dir}/documents.parquet"), held_out("doc_id", 7, 2), "lang")
