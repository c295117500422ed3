"""Reports of books that no task holds whole are those of their whole texts."""

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import cleanup
from quire.plans import convert

START, END = "**---- Start of picture text ----**<br>", "**---- End of picture text ----**<br>"
LINES = [
    "# one\nplain words a1b and xvvy here. bThe end of it",
    "a comment that nobody ends <!-- here a2b\n# in it",
    "```\n# in a fence\nTABLE 3 of c3d",
    "# still in the fence\n~~~\n\n\n\n",
    "```\n# out of it\n| --- | --- |\n",
    f"before {START}\nfirst a4b half",
    f"Index of Terms {START} a5b",
    f"second half {END} after {START} dropped",
    f"a6b {END}\n\n\nbehind <!-- one --> BCDF GHJK\n",
    f"{START} that nothing ends a7b\n\n\n",
    "Ine. z <!-- open\n\n",
]


def test_counts_of_parts_are_those_of_the_whole(spark):
    rows = [(b, i + 1, f"<!-- page_pdf={i + 1} page_printed=none -->\n\n" + x) for b, of in (("a", LINES), ("b", LINES[::-1] * 9), ("c", LINES[:1] * 30)) for i, x in enumerate(of)]
    books = spark.createDataFrame([(b, f"# {b} <!-- x\n\n---") for b in "abcd"], "book_id string, head string")
    bodies = spark.createDataFrame(rows, "book_id string, page_pdf int, part string")
    parts = convert.book_parts(books, bodies)
    texts = parts.groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x.text), "").alias("text"))
    whole = {b: f"# {b} <!-- x\n\n---\n\n" + "\n\n".join(p for c, _, p in rows if c == b) for b in "abcd"}
    want = cleanup.clean_markdown(spark.createDataFrame(list(whole.items()), "book_id string, text string"), None, "book_id").select("book_id", "text")
    assert sorted(map(tuple, texts.collect())) == sorted(map(tuple, want.collect()))
    emitted, captions = T.table_signals(F.col("text"))
    score = lambda t: F.round(T.quality_score(t), 9)
    read = want.select("book_id", score(F.col("text")), *(n.cast("long") for n in T.ocr_warning_counts(F.col("text"))), emitted, captions, T.heading_count(F.col("text")))
    got = convert.part_counts(parts).select("book_id", F.round(T.score_of(F.col("artifacts")), 9), *T.dense(F.col("misread")), "emitted", "captions", "headings")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, read.collect()))


def test_no_task_holds_a_book(spark):
    """The report of a book is made of its pages: nothing in its plan gathers texts by book."""
    pages = spark.range(60).selectExpr("'b' as book_id", "cast(id as int) as page_pdf", "concat('words ', hash(id), ' of it') as text")
    reports, parts = convert.converted(pages)
    plan = reports.select("book_id", "status", "total_pages", "page_locator_count")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    assert reports.first()["page_locator_count"] == 60 and parts.count() == 61
