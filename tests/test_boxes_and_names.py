"""Merged boxes against all pairs, names of files against taking them one by one."""

import random
import time
from collections import defaultdict

import pytest

from quire.operators import figures


def near(a, b, gap):
    return a[0] - gap < b[2] and b[0] < a[2] + gap and a[1] - gap < b[3] and b[1] < a[3] + gap


def all_pairs(boxes, gap):
    found = list(boxes)
    while pair := next(((i, j) for j in range(len(found)) for i in range(j) if near(found[i], found[j], gap)), None):
        a, b = (found[k] for k in pair)
        found = [x for k, x in enumerate(found) if k not in pair] + [(min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))]
    return sorted(found)


def some_boxes(rng, n, side, size):
    return [(x, y, x + rng.randint(0, size), y + rng.randint(0, size)) for x, y in ((rng.randint(0, side), rng.randint(0, side)) for _ in range(n))]


def test_merged_boxes_against_all_pairs():
    rng = random.Random(5)
    for _ in range(1500):
        boxes, gap = some_boxes(rng, rng.randint(0, 22), rng.choice((12, 60, 200)), rng.choice((0, 3, 25))), rng.choice((0, 1, 7))
        assert figures.merged_boxes(boxes, gap) == all_pairs(boxes, gap), (boxes, gap)
    ring = [(0, 0, 90, 10), (100, 0, 110, 90), (20, 100, 110, 110), (0, 20, 10, 110), (50, 50, 60, 60)]
    assert figures.merged_boxes(ring, 9) == all_pairs(ring, 9)
    assert figures.merged_boxes([], 1) == []


@pytest.mark.parametrize("side", (800, 100_000))
def test_many_boxes_of_a_page(side):
    boxes = some_boxes(random.Random(7), 100_000, side, 40)
    start = time.process_time()
    found = figures.merged_boxes(boxes, 30)
    assert time.process_time() - start < 10  # 1 second or so on a quiet machine
    assert 0 < len(found) < len(boxes) and figures.merged_boxes(found, 30) == found


def test_regions_of_a_hot_page(spark, monkeypatch):
    rng = random.Random(9)
    rows = [("hot", 1, *map(float, b)) for b in some_boxes(rng, 250, 500, 9)] + [(None, 2, *map(float, b)) for b in some_boxes(rng, 40, 300, 9)]
    rows += [("nan", 3, float("nan"), 0.0, 900.0, 900.0), ("null", 3, None, 0.0, 900.0, 900.0), ("turned", 3, 90.0, 80.0, 10.0, 20.0)]
    rng.shuffle(rows)
    given = spark.createDataFrame([(*r, "x") for r in rows], "book_id string, page_pdf int, x0 double, y0 double, x1 double, y1 double, key string")
    want = sorted(((k, p, *b) for k, p in (("hot", 1), (None, 2)) for b in all_pairs({r[2:] for r in rows if r[0] == k}, 6)), key=str)
    want = sorted([*want, ("turned", 3, 10.0, 20.0, 90.0, 80.0)], key=str)
    for at_once in (100, 200_000):
        monkeypatch.setattr(figures, "AT_ONCE", at_once)
        got = figures.merge_regions(given.repartition(5), gap=6, least=0)
        assert got.columns == ["book_id", "page_pdf", "x0", "y0", "x1", "y1"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert figures.merge_regions(given.limit(0)).count() == 0


def one_by_one(paths):
    bases = [p.rsplit("/", 1)[-1] for p in paths]
    taken, first, names = set(bases), set(), {}
    for p in sorted(paths):
        parts = p.split("/")
        base, folder = parts[-1], parts[-2] if len(parts) > 1 else ""
        name, n = base, 2
        if base in first:
            name = f"{folder}-{base}"
            while name in taken:
                name, n = f"{folder}-{n}-{base}", n + 1
        first.add(base)
        taken.add(name)
        names[p] = name
    return names


def test_names_against_taking_them_one_by_one(spark):
    rng, rows = random.Random(3), []
    parts = ["a", "b", "a-2", "2", "a-a", "2-a", "a-2-a", "3-a", "-a", "a-", "2-2-a", "a-3"]
    for doc in [*range(40), None]:
        rows += [(doc, "/".join(rng.choice(parts[: rng.randint(1, len(parts))]) for _ in range(rng.randint(1, 4))), "x") for _ in range(rng.randint(1, 40))]
    rows += [(7, None, "x"), (9, "a/a", "y"), (9, "a/a", "z")]
    rows += [(99, f"{i:03}/d/i.png", "x") for i in range(300)] + [(99, "d-7-i.png", "x"), (99, "q/d-9-i.png", "x"), (99, "z/d-2/7-i.png", "x")]
    paths = defaultdict(set)
    for doc, path, _ in rows:
        if path is not None:
            paths[doc].add(path)
    want = {(doc, p): n for doc, mine in paths.items() for p, n in one_by_one(mine).items()}
    given = spark.createDataFrame(rows, "doc_id int, path string, name string").repartition(3)
    got = figures.harvest_names(given).collect()
    assert {(r["doc_id"], r["path"]): r["name"] for r in got} == want and len(got) == len(want)
    assert figures.harvest_names(given.limit(0)).count() == 0


@pytest.mark.parametrize("parts", (["a", "b", "2", "3", "ab", ""], ["a", "2", "a-2"]))
def test_names_without_rounds(spark, monkeypatch, parts):
    """Keys without dashes of their own need no rounds, beside keys that do."""
    rng = random.Random(8)
    rows = [(doc, "/".join(rng.choice(parts[:5]) for _ in range(rng.randint(1, 4))) or "a") for doc in [*range(30), None] for _ in range(60)]
    rows = [(doc, p) for doc, p in rows if "-" not in p or doc == 7]
    if "" in parts:
        monkeypatch.setattr(figures, "names_by_rounds", None)
    paths = defaultdict(set)
    for doc, path in rows:
        paths[doc].add(path)
    want = {(doc, p): n for doc, mine in paths.items() for p, n in one_by_one(mine).items()}
    got = figures.harvest_names(spark.createDataFrame(rows, "doc_id int, path string").repartition(3)).collect()
    assert {(r["doc_id"], r["path"]): r["name"] for r in got} == want and len(got) == len(want)
