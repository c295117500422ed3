"""Word repair and e-book navigation on small planted tables."""

from quire.operators import cleanup, navigation


def test_joins(spark):
    words = spark.createDataFrame([(w,) for w in ("company", "chapter", "colour", "format", "able", None)], "word string")
    tokens = spark.createDataFrame([(w,) for w in ("thecompany", "withthe", "colour", "colourof", "attaches", "chapterour", "companya", "lowa", "wereable", "x")], "token string")
    got = {r["token"]: (r["left"], r["right"]) for r in cleanup.join_splits(tokens, words).collect()}
    assert got == {"thecompany": ("the", "company"), "withthe": ("with", "the"), "colourof": ("colour", "of"), "companya": ("company", "a"), "wereable": ("were", "able")}


def test_clean_markdown(spark):
    words = spark.createDataFrame([("company",)], "word string")
    block = "**---- Start of picture text ----**<br>\n{}\n**---- End of picture text ----**<br>"
    text = "thecompany, thecompany xthecompany wWilliam\n\n\n\n" + block.format("Index of Terms $1 \\2") + "|" + block.format("garble") + "|"
    docs = spark.createDataFrame([(1, text, "x"), (2, None, "x"), (3, "", None), (None, "thecompany", None)], "doc_id int, text string, n_joins_extra string")
    rows = cleanup.clean_markdown(docs, words).collect()
    got = {r["doc_id"]: r for r in rows}
    assert got[1]["text"] == "the company, the company xthecompany William\n\nIndex of Terms $1 \\2||"
    assert [got[1][c] for c in ("n_joins", "n_stray", "n_kept", "n_dropped")] == [1, 1, 1, 1]
    assert got[2]["text"] is None and got[2]["n_joins"] == 0 and got[3]["text"] == "" and len(rows) == 4
    again = cleanup.clean_markdown(spark.createDataFrame([(1, got[1]["text"])], "doc_id int, text string"), words).first()
    assert again["text"] == got[1]["text"] and again["n_joins"] == 0
    assert cleanup.clean_markdown(docs.limit(0), words).count() == 0


def test_navigation(spark):
    point = lambda label, src, inner="": f'<navPoint id="x"><navLabel><text>{label}</text></navLabel><content src="{src}"/>{inner}</navPoint>'
    markup = "</navPoint>" + point("One &amp; <b>two</b>", "a.xhtml", point("Sub", "../b%20c+.xhtml#s1")) + '<content src="lost.xhtml"/>' + point("", "none.xhtml") + point("Three", "/abs/./x/../c.xhtml#") + point("Four", "#only")
    got = navigation.ncx_entries(spark.createDataFrame([("b", "OEBPS/t", markup), ("n", None, None)], "book_id string, base string, markup string")).orderBy("ord").collect()
    assert [tuple(r)[1:] for r in got] == [(0, 1, "One & two", "OEBPS/t/a.xhtml", None), (1, 2, "Sub", "OEBPS/b c+.xhtml", "s1"), (2, 1, "Three", "abs/c.xhtml", None)]


def test_classes(spark):
    docs = spark.createDataFrame([("b", 1, '<p class="Chap-Title x">A &amp; b</p><p class="secthead">s</p><p>q</p>'), ("b", 2, "<p class='chap-title'>" + "y" * 130 + "</p><p class='secthead'>t</p>"), ("c", 3, "<p>none</p>"), ("c", 4, None)], "book_id string, doc int, markup string")
    picks = navigation.chapter_class(docs)
    assert [tuple(r) for r in picks.collect()] == [("b", "secthead", 2)]
    got = {r["doc"]: r for r in navigation.class_headings(docs, picks).collect()}
    assert got[1]["markup"].endswith("<h2>s</h2><p>q</p>") and got[1]["n_injected"] == 1
    assert got[3]["markup"] == "<p>none</p>" and got[3]["n_injected"] == 0 and got[4]["markup"] is None
