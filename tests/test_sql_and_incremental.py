"""The table function against the operator; runs that convert what has changed only, and a sink that fails."""

import pytest
from pyspark.errors import AnalysisException

from quire.__main__ import main
from quire.functions import tables
from quire.operators import structure
from quire.plans import incremental
from quire.sources.files import write_files


def test_pages_by_sql(spark):
    tables.register(spark)
    texts = [("a", "before\n{1}----\nx\n\ny\n{2}--  \n{3}-\n{x}--\n{12}-----\n"), ("b", "no page"), ("c", None), (None, "{4}--\nq"), ("d", "{5}--\n{5}--\nsame"), ("e", "")]
    given = spark.createDataFrame(texts, "book_id string, text string")
    lines = structure.lines_of(given, "book_id").selectExpr("book_id", "cast(line_no as long) as at", "line", "'x' as text")
    got = spark.sql("SELECT * FROM quire_pages_of(TABLE({lines}))", lines=lines.repartition(4))
    want = structure.split_pages(given)
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.collect()), key=str)
    assert len(rows) == 6 and [r for r in rows if r[0] is not None] == sorted((tuple(r) for r in want.where("book_id is not null").collect()), key=str)
    assert [r for r in rows if r[0] is None] == [(None, 1, 4, "q")]
    assert spark.sql("SELECT * FROM quire_pages_of(TABLE({lines}))", lines=lines.limit(0)).count() == 0
    with pytest.raises(AnalysisException, match="at, line"):
        spark.sql("SELECT * FROM quire_pages_of(TABLE({lines}))", lines=given)


def test_compared(spark, tmp_path):
    log = str(tmp_path / "log")
    files = lambda *rows: spark.createDataFrame(rows, "name string, content string")
    state = lambda now, method="text": {r["name"]: r["state"] for r in incremental.compared(incremental.hashes(now, method), incremental.last(spark, log)).collect()}
    first = files(("a", "1"), ("b", "2"), ("c", None), ("c", None), (None, "4"))
    assert state(first) == {"a": "new", "b": "new", "c": "new"}
    incremental.record(incremental.compared(incremental.hashes(first), incremental.last(spark, log)), log)
    assert state(first) == {"a": "same", "b": "same", "c": "same"} and set(state(first, "other").values()) == {"changed"}
    second = files(("a", "1"), ("b", "x"), ("d", ""))
    assert state(second) == {"a": "same", "b": "changed", "c": "gone", "d": "new"}
    incremental.record(incremental.compared(incremental.hashes(second), incremental.last(spark, log)), log)
    assert state(first) == {"a": "same", "b": "changed", "c": "new", "d": "gone"}
    assert state(first.limit(0)) == {"a": "gone", "b": "gone", "d": "gone"}


def test_a_second_run(spark, tmp_path):
    books, out, archive = tmp_path / "in", tmp_path / "out", tmp_path / "archive"
    books.mkdir()
    text = "The river ran past the old mill and the people of the town met there in the evening. " * 8
    for name in ("one", "two"):
        (books / f"{name}.txt").write_text(f"{name} {text}")
    run = lambda: main([str(books), "-o", str(out), "--incremental", "--archive-dir", str(archive)], spark)
    assert run() == 0
    before = {p.name: p.stat().st_mtime_ns for p in out.glob("*.md")}
    assert set(before) == {"one.md", "two.md"}
    (books / "two.txt").write_text(f"changed {text}")
    assert run() == 0
    after = {p.name: p.stat().st_mtime_ns for p in out.glob("*.md")}
    assert after["one.md"] == before["one.md"] and after["two.md"] > before["two.md"] and "changed" in (out / "two.md").read_text()
    kept = sorted(p.name for p in archive.iterdir())
    assert len(kept) == 3 and kept[0] == "one.txt" and any(n.startswith("two.2") for n in kept) and (archive / "two.txt").read_text().startswith("two")
    assert run() == 0 and {p.name: p.stat().st_mtime_ns for p in out.glob("*.md")} == after


def test_a_run_that_dies(spark, tmp_path):
    rows = spark.range(40, numPartitions=4).selectExpr("concat('f', id, '.md') as path", "cast(case when id = 39 then raise_error('lost') else 'x' end as binary) as content")
    with pytest.raises(Exception, match="lost"):
        write_files(rows, str(tmp_path / "out"))
    assert not list((tmp_path / "out").glob("*.md"))
