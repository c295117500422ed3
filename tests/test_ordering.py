"""Numbers and carried values over many ranges of a hot key, with null keys, ties and empty tables."""

from collections import defaultdict

import pytest

from quire.operators.ordering import carry_last, in_ranges, number_rows
from quire.operators.temporal import asof_join


@pytest.fixture()
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows():
    return [("hot" if i % 2 else f"k{i % 7}" if i % 11 else None, i * 37 % 101, i if i % 5 else None) for i in range(400)]


def test_numbers(spark, many_ranges):
    given = spark.createDataFrame(rows(), "k string, at int, v int").repartition(3)
    assert in_ranges(given, ["k"], ["at"]).where("k = 'hot'").select("__part").distinct().count() > 1
    got = defaultdict(list)
    for r in number_rows(given, ["k"], ["at"]).collect():
        got[r["k"]].append((r["n"], r["at"]))
    assert sum(map(len, got.values())) == 400
    for mine in got.values():
        mine.sort()
        assert [n for n, _ in mine] == list(range(1, len(mine) + 1)) and [at for _, at in mine] == sorted(at for _, at in mine)
    assert number_rows(given.limit(0), ["k"], ["at"]).count() == 0


def test_carried_values(spark, many_ranges):
    data = [(k, i, v) for i, (k, _, v) in enumerate(rows())]
    want, last = {}, {}
    for k, i, v in data:
        last[k] = v if v is not None else last.get(k)
        want[i] = last[k]
    given = spark.createDataFrame(data, "k string, at int, v int").repartition(3)
    got = {r["at"]: r["c"] for r in carry_last(given, "k", ["at"], "v", "c").collect()}
    assert got == want


def test_as_of_with_a_hot_key(spark, many_ranges):
    left = [("hot" if i % 3 else None, i if i % 17 else None, i) for i in range(300)]
    right = [("hot", i * 5, f"r{i}", i) for i in range(20, 60)] + [("hot", 150, "r9", 9), (None, 1, "no", 0), ("hot", None, "no", 0)]
    want = {}
    for k, at, i in left:
        found = [(t, name, x) for kk, t, name, x in right if k is not None and kk == k and at is not None and t is not None and t <= at]
        best = max(found, key=lambda x: (x[0], x[1], x[2]), default=(None, None, None))
        want[i] = best[1:]
    a = spark.createDataFrame(left, "k string, at int, id int").repartition(3)
    b = spark.createDataFrame(right, "k string, at int, name string, x int")
    got = asof_join(a, b, "k", "at", ["name", "x"]).collect()
    assert {r["id"]: (r["name"], r["x"]) for r in got} == want and len(got) == 300
    assert asof_join(a.limit(0), b, "k", "at", ["x"]).count() == 0
    assert asof_join(a, b.limit(0), "k", "at", ["x"]).where("x is not null").count() == 0
