"""Rounds of Re-Pair: a run of one pair shrinks by half in a round, equals are not taken in order, and the most frequent pairs come first."""

import numpy as np
import pytest

from quire.llm import repair


@pytest.mark.parametrize("passage", (np.zeros(4000), np.r_[np.zeros(2000), 5, np.ones(2001)], np.arange(1000), np.tile([3, 3, 4], 900)))
def test_rounds_of_repeated_symbols(monkeypatch, passage):
    rounds, ranks = [], repair.ranks_of
    monkeypatch.setattr(repair, "ranks_of", lambda *a: rounds.append(1) or ranks(*a))
    text = np.tile(np.r_[passage, repair.END].astype(np.uint16), 9)
    symbols, rules, lengths = repair.compress(text, 1000)
    pairs = np.stack([rules >> np.uint32(16), rules & np.uint32(0xFFFF)], 1).astype("<u2")
    shard = repair.Shard(1000, pairs.tobytes(), lengths.astype("<u4").tobytes(), symbols.astype("<u2").tobytes(), 2)
    assert np.array_equal(shard.expand(shard.symbols), np.where(text == repair.END, 2, text)) and len(symbols) == 18
    assert len(rounds) < 60  # one place of a run a round would be thousands


def test_frequent_pairs():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 50, 400).astype(np.uint32) * np.uint32(0x10001)
    found, counts = np.unique(keys, return_counts=True)
    want = sorted(((int(n), int(k)) for k, n in zip(found, counts) if n >= 8), reverse=True)
    got = repair.frequent_pairs(keys, 8, 10)
    n = dict(zip(found.tolist(), counts.tolist()))
    assert [n[k] for k in got.tolist()] == [c for c, _ in want[:10]] and len(set(got.tolist())) == len(got)
    assert len(repair.frequent_pairs(keys[:0], 8, 10)) == 0 and len(repair.frequent_pairs(keys, 500, 10)) == 0
