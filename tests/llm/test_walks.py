"""Fingerprints against walks taken step by step; neighbours, copies, near copies, odd rows."""

import hashlib

import numpy as np
import pytest

from quire.llm import walks

SCHEMA = "doc_id long, text string, class_id int, node string"


def steps(text):
    """The places that a walk stands on, one a time."""
    out, time = [], 0
    for i, c in enumerate(text):
        kind = (ord(c) * 2654435761 % 2**32 >> 13) & 255
        stay = (walks.NEXT[kind][time] - time) % 256
        assert 1 <= stay <= walks.LONGEST_STAY
        out += [i] * stay
        time = (time + stay) % 256
    return out


def texts():
    rng = np.random.default_rng(2)
    prose = lambda n: " ".join("".join(chr(97 + int(x)) for x in rng.integers(0, 26, int(rng.integers(2, 9)))) for _ in range(n))
    out = [prose(int(n)) for n in rng.integers(1, 400, 40)]
    near = out[3] + " " + prose(300)
    copies = [near, near, near[:500] + "x" + near[500:], near[:900] + near[903:], near.replace("a", "a", 1) + "!"]
    return out + copies + ["", None, "", "a", "ab", "naïve 東京 😀 text " * 30, " \n ", "z" * 300_000, prose(30_000)]


@pytest.fixture(scope="module")
def rows():
    out = [(7 * i % 1009, t, 1, "n") for i, t in enumerate(texts())]
    return out + [(None, "no id", 1, "n"), out[5], out[5]]


def test_walks_step_by_step():
    for text in [t for t in texts() if t and len(t) < 5000]:
        mine, places = walks.Document(text).print, steps(text)
        assert mine.length == len(places) and len(mine.samples) == min(len(places), walks.SAMPLES)
        times = walks.sample_times(mine.length)
        grams = {}
        for s, t in zip(mine.samples.tolist(), times.tolist()):
            gram = text[places[t] : places[t] + walks.GRAM]
            assert grams.setdefault(gram, s) == s  # a byte for each gram
        after = "é" + text[::-1]
        assert walks.Document(text).edited(after) == (hashlib.sha256(walks.edited(text, after).encode()).hexdigest(), walks.Document(walks.edited(text, after)).packed)


def test_shared_times_are_those_of_the_shorter_walk():
    for m in (1, 100, 128, 129, 1000, 4095, 4096, 5000, 70_000):
        for n in (m + 1, 2 * m, 100_003):
            of_n = walks.sample_times(n)
            assert len(of_n) == min(n, walks.SAMPLES) and set(of_n[of_n < m]) <= set(walks.sample_times(m))


def test_likeness_follows_the_hamming_distance_of_walks():
    rng = np.random.default_rng(9)
    text = "".join(chr(97 + int(x)) for x in rng.integers(0, 26, 20_000))
    for share in (0.0, 0.3, 0.6, 0.9):
        other = text[: int(len(text) * share)] + "".join(chr(65 + int(x)) for x in rng.integers(0, 26, len(text) - int(len(text) * share)))
        assert abs(walks.likeness(walks.Document(text).packed, walks.Document(other).packed) - share) < 0.15
    edits = list(text)
    for i in range(2000, 20_000, 4000):
        edits[i] = "#"
    assert walks.likeness(walks.Document(text).packed, walks.Document("".join(edits)).packed) > 0.7  # walks meet again


@pytest.mark.parametrize("parts", [1, 5])
def test_next_documents(spark, rows, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = walks.near_classes(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    following = [order[(i + 1) % len(order)][1] or "" for i in range(len(order))]
    want = sorted(((r[0] if r[0] is not None else -1), len(r[1] or ""), hashlib.sha256(walks.edited(r[1] or "", x).encode()).hexdigest(), walks.likeness(walks.Document(r[1] or "").packed, walks.Document(x).packed)) for r, x in zip(order, following))
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["n_chars"], r["edited_sha256"], r["near_next"]) for r in got) == want
    prints = {}
    for r in got:
        text = next(t for d, t, *_ in rows if d == r["doc_id"]) or ""
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"] and 0 <= r["near_edited"] <= 1
        if len(text) > 500:
            assert r["near_edited"] > 0.5 or len(set(text)) == 1
    ids = [7 * i % 1009 for i in range(40, 45)]
    assert {r["class_id"] for r in got if r["doc_id"] in ids} == {min(ids)}
    alone = [r for r in got if r["doc_id"] not in ids]
    assert all(r["class_id"] == r["doc_id"] for r in alone)


def test_no_documents_and_one(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert walks.near_classes(none).count() == 0
    (one,) = walks.near_classes(spark.createDataFrame([(3, "abcdef", 1, "n")], SCHEMA)).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0 and one["class_id"] == 3


def like_ones(rng, n):
    """Fingerprints in chains of near ones, of lengths that differ, many about as like as classes need."""
    out = []
    for _ in range(n):
        length = int(rng.choice([3, 9, 20, 31, 62, 100, 127, 128, 140, 900, 5000, 70_000]))
        byte = dict(zip(walks.sample_times(2 * length).tolist(), rng.integers(0, 256, 2 * length).tolist()))
        for _ in range(6):
            now = int(length * rng.uniform(1, 1.2))
            fresh = {t: byte.setdefault(t, int(rng.integers(0, 256))) for t in walks.sample_times(now).tolist()}
            share = rng.uniform(0, 0.25)
            samples = [v if rng.random() > share else int(rng.integers(0, 256)) for v in fresh.values()]
            out.append(now.to_bytes(6, "big") + bytes(samples))
    return out


def test_like_fingerprints_share_a_band():
    assert walks.BANDS == walks.differences(walks.SAMPLES) + 1
    prints = like_ones(np.random.default_rng(4), 150)
    keys, met = [set(walks.band_keys(x)) for x in prints], 0
    for i in range(0, len(prints), 6):
        for a in range(i, i + 6):
            for b in range(a + 1, i + 6):
                if walks.likeness(prints[a], prints[b]) >= walks.LIKE:
                    met += 1
                    assert keys[a] & keys[b]
    assert met > 100


@pytest.mark.parametrize("many", [64, 3])
def test_classes_are_those_of_all_pairs(spark, many, monkeypatch):
    monkeypatch.setattr(walks, "MANY", many)
    monkeypatch.setattr(walks, "BLOCK", 1024 if many > 3 else 4)
    rng = np.random.default_rng(8)
    prints = like_ones(rng, 40)
    base = rng.integers(0, 256, 128)
    for _ in range(60):  # many that share bands, few of them alike
        mine = base.copy()
        at = rng.random(128) < rng.choice([0.12, 0.5])
        mine[at] = rng.integers(0, 256, int(at.sum()))
        prints.append((4096).to_bytes(6, "big") + bytes(mine.tolist()))
    prints = sorted(set(prints))
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(prints):
        for j in range(i):
            if walks.likeness(x, prints[j]) >= walks.LIKE:
                root[find(i)] = find(j)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(prints)], "doc_id long, fingerprint binary")
    named = df.selectExpr("doc_id", "xxhash64(fingerprint) as node").collect()
    joined = dict(walks.classes(df, walks.Scratch(spark, "test")).collect())
    mine = [joined.get(r["node"], r["node"]) for r in sorted(named)]
    together = lambda c: {frozenset(i for i in range(len(c)) if c[i] == k) for k in set(c)}
    assert together(mine) == together([find(i) for i in range(len(prints))])
