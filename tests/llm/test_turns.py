"""The repair of conversations against all edit sequences, written down plainly."""

import hashlib
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest

from quire.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, copy string, head int"
GOOD = re.compile("(s?(ua)+)?")


def brute(rows):
    """The contract by recursion over all edits: (cost, audit, repaired) with what the grammar is told by a regular expression's prefixes."""
    faults, seen = [], set()
    for role, text in rows:
        end = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state):  # state: what stands before, shortened to s, u, a or nothing
        out = []
        if i == len(rows) and state in ("", "a"):
            out.append((0, "", ()))
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        new = "u" if "u" in legal else "a"
        whole = {"u": "user", "a": "assistant"}[new]
        if state != "u" or new == "a":
            follow = insert(i, new)
            if follow:
                out.append((2 + follow[0], "I" + follow[1], ((whole, ""), *follow[2])))
        if i < len(rows):
            role, text = rows[i]
            c, a, r = best(i + 1, state) or (10**9, "", ())
            out.append((c + 3, "D" + a, r))
            if faults[i] not in ("b", "d"):
                t = faults[i] == "t"
                if role[:1] and role[:1] in legal:
                    c, a, r = best(i + 1, role[:1]) or (10**9, "", ())
                    out.append((c + t, "K" + a, ((role, text), *r)))
                c, a, r = best(i + 1, new) or (10**9, "", ())
                out.append((c + t + 2, "R" + a, ((whole, text), *r)))
        return min(out, default=None, key=lambda x: x[:2])

    def insert(i, state, depth=0):
        """What follows an insertion; two in a row at most, as more only add a pair."""
        if depth == 2:
            return None
        out = []
        if i == len(rows) and state == "a":
            out.append((0, "", ()))
        new = "a" if state == "u" else "u"
        more = insert(i, new, depth + 1)
        if more:
            out.append((2 + more[0], "I" + more[1], (({"u": "user", "a": "assistant"}[new], ""), *more[2])))
        if i < len(rows):
            role, text = rows[i]
            c, a, r = best(i + 1, state)
            out.append((c + 3, "D" + a, r))
            if faults[i] not in ("b", "d"):
                t, legal = faults[i] == "t", "a" if state == "u" else "u"
                if role[:1] == legal:
                    c, a, r = best(i + 1, legal)
                    out.append((c + t, "K" + a, ((role, text), *r)))
                c, a, r = best(i + 1, legal)
                out.append((c + t + 2, "R" + a, (({"u": "user", "a": "assistant"}[legal], text), *r)))
        return min(out, default=None, key=lambda x: x[:2])

    cost, audit, left = best(0, "")
    assert GOOD.fullmatch("".join(r[:1] for r, _ in left))
    return faults, cost, audit, left


def expected(rows):
    by, every = defaultdict(list), {}
    for conv, turn, role, text, *_ in rows:
        role, text = (" " if x is None else x for x in (role, text))
        every.setdefault(conv)
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        by[conv] += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv in every:
        mine = sorted(by[conv], key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest()))
        faults, cost, audit, left = brute(tuple(x[1:] for x in mine))
        known = [x[0] for x in mine if x[0] is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    roles, texts = ["user", "assistant", "system", "tool", "u", "", None], ["One.", "Two!", "three", " \n", "", None, "a? ", "naïve…", "x" * 3000 + "."]
    out = []
    for conv in [None, *range(60)]:
        n = int(rng.integers(0, 9)) + 1
        for turn in range(n):
            nth = None if rng.random() < 0.05 else turn + (turn > 4)
            out.append((conv, nth, roles[rng.choice(7, p=[0.4, 0.35, 0.1, 0.05, 0.04, 0.03, 0.03])], texts[rng.choice(9, p=[0.3, 0.2, 0.2, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05])], "theirs", 7))
    return out + out[:9]  # repeated rows


@pytest.mark.parametrize("block", [256, 2])
def test_every_edit_sequence(spark, rows, monkeypatch, block):
    monkeypatch.setattr(turns.Path.__init__, "__defaults__", (block,))
    given = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = turns.repair(turns.damaged(given), given).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == expected(rows) and len(got) == len(expected(rows))


def test_long_conversations_pass_in_blocks():
    rng = np.random.default_rng(4)
    for _ in range(200):
        given = [("suat"[rng.choice(4, p=[0.1, 0.4, 0.4, 0.1])], int(rng.choice(4, p=[0.6, 0.1, 0.1, 0.2]))) for _ in range(int(rng.integers(0, 40)))]
        whole, found = turns.Path(1000), turns.Path(3)
        for t in given:
            whole.add(*t)
            found.add(*t)
        assert whole.end() == found.end()
    path = turns.Path()
    for i in range(100_000):
        path.add("ua"[i % 2], 0)
    assert path.end() == (0, "K" * 100_000) and max(len(a) for _, a in path.states.values()) < 2000


def test_repaired_turns_follow_the_grammar(spark, rows):
    given = spark.createDataFrame(rows, SCHEMA)
    found = defaultdict(list)
    for r in turns.repaired_turns(turns.damaged(given), given).collect():
        found[r["conv_id"]].append((r["place"], r["role"], r["text"]))
    want = {k: v[-1] for k, v in expected(rows).items()}
    for conv, sha in want.items():
        mine = sorted(found[conv])
        assert [x[0] for x in mine] == list(range(len(mine)))
        assert GOOD.fullmatch("".join(x[1][:1] for x in mine))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in mine).encode()).hexdigest() == sha


def test_empty_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turns.repair(turns.damaged(none), none).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    given = spark.createDataFrame([(dropped, 0, "user", "Gone.", "", 0)], SCHEMA)
    assert [tuple(r) for r in turns.repair(turns.damaged(given), given).collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
