"""Hard negatives against all pairs: ties, copies, nulls, several lengths, scores beyond 53 bits."""

import math

import numpy as np
import pytest

from quire.llm import negatives
from quire.llm.common import Scratch

SCHEMA = "vec_id long, label int, embedding array<double>, q string, score long"


def brute(rows, every=100, k=5, percent=80):
    kept = [(v, lab, [math.floor(256 * x) if abs(x) < 2**52 else int(x) * 256 for x in e]) for v, lab, e, *_ in rows if v is not None and lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, (anchor, label, a) in enumerate(kept):
        if anchor % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a, e)), v, lab == label) for j, (v, lab, e) in enumerate(kept) if j != i and len(e) == len(a)), key=lambda x: x[:2])
        for s, p, _ in [x for x in scored if x[2]][:k]:
            found = [(t, v) for t, v, same in scored if not same and percent * -s <= 100 * -t <= 100 * -s][:k]
            out += [(anchor, p, r, v, -s, -t) for r, (t, v) in enumerate(found, 1)]
    return sorted(out)


def some(rng, n, dim=6, spread=0.15):
    centres = rng.normal(size=(7, dim))
    return [(int(i), int(rng.integers(0, 4)), (centres[rng.integers(0, 7)] + rng.normal(size=dim) * spread).tolist(), "x", 1) for i in range(n)]


@pytest.fixture()
def small(monkeypatch):
    for name, n in (("RING_ROWS", 16), ("BLOCK_ROWS", 8), ("QUERY_ROWS", 3), ("GROUP_BLOCKS", 1), ("FIRST", 2), ("STEP", 2)):
        monkeypatch.setattr(negatives, name, n)


def mined(spark, rows, **how):
    return sorted(tuple(r) for r in negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), **how).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_against_all_pairs(spark, small):
    rng = np.random.default_rng(5)
    rows = some(rng, 500)
    rows += [(1000 + i, i % 3, rows[7][2], "x", 1) for i in range(150)]  # a hot vector, ties by vec_id
    rows += [(2000, None, rows[0][2], "x", 1), (2100, 1, None, "x", 1), (2200, 1, [0.1] * 5 + [None], "x", 1), (2300, 1, [0.1] * 5 + [math.inf], "x", 1), (None, 1, rows[0][2], "x", 1)]
    rows += [(3000 + i, i % 2, [0.3 * i, 1.0], "x", 1) for i in range(20)] + [(4000, 1, [], "x", 1), (4001, 1, [], "x", 1), (4002, 2, [], "x", 1), rows[100], rows[100]]
    got = mined(spark, rows, every=10)
    assert got == brute(rows, 10) and len(got) > 500


def test_scores_beyond_53_bits(spark, small):
    rng = np.random.default_rng(6)
    rows = [(v, lab, [x * 1e6 for x in e], *rest) for v, lab, e, *rest in some(rng, 60, 3)]
    got = mined(spark, rows, every=20)
    assert got == brute(rows, 20) and got
    odd = [(0, 1, [1e300, 1.0], "x", 1), (1, 1, [1e300, 2.0], "x", 1), (2, 0, [1e300, 1.0], "x", 1)]
    assert mined(spark, odd) == [(0, 1, 1, 2, 2**63 - 1, 2**63 - 1)]


def test_empty_vectors(spark):
    assert mined(spark, []) == [] and mined(spark, [(0, 1, None, "x", 1)]) == []


def test_rings_are_left_out(spark, small, monkeypatch):
    """In clusters far apart most rings of other clusters are never opened."""
    rng = np.random.default_rng(8)
    rows, seen, rings = [(v, lab, (np.array(e) / np.linalg.norm(e) * 4).tolist(), *rest) for v, lab, e, *rest in some(rng, 2000, 4, 0.02)], {}, []
    keep = Scratch.keep

    def counted(self, name, df):
        out = keep(self, name, df)
        if name == "rings":
            rings.append(out.count())
        if "visits" in name:
            seen[name] = out.where("salt = 0").selectExpr("sum(octet_length(q_js) div 4) as n").first()["n"] or 0
        return out

    monkeypatch.setattr(Scratch, "keep", counted)
    assert mined(spark, rows) == brute(rows)
    assert sum(n for name, n in seen.items() if name.startswith("near")) < 0.7 * 20 * rings[0]
