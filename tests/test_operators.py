"""Operators on small planted tables."""

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import furniture, locators, structure


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "text string").select(f(F.col("text")).alias("x")).first()["x"]


def samples(spark, pages):
    return locators.consensus(spark.createDataFrame([("b", k, v) for k, v in pages.items()], "book_id string, page_pdf int, page_printed string")).first()


def test_consensus(spark):
    r = samples(spark, {5: "1", 20: "16", 100: "96"})
    assert (r["page_offset"], r["consistent"]) == (-4, True)
    assert not samples(spark, {5: "1", 20: "16", 100: "40"})["consistent"]
    assert samples(spark, {5: "1", 20: "16"})["refusal"] == "only 2 arabic samples"
    assert samples(spark, {1: "i", 5: "1", 20: "16", 100: "96"})["page_offset"] == -4
    scattered = {i: str(i - 15) for i in range(20, 60)} | {54: "7"}
    assert samples(spark, scattered)["page_offset"] == -15
    assert "renumbering" in samples(spark, scattered | {55: "8"})["refusal"]
    assert "unanimity" in samples(spark, {i: str(i - 3) for i in range(4, 10)} | {30: "2"})["refusal"]


def test_furniture(spark):
    rows = [("b", i, f"THE HEAD\nsome prose on page {i} that goes on\nmore words here{i}\nand more lines{i}\nlast line{i}\n{i - 1}") for i in range(2, 9)]
    got = {r["page_pdf"]: r for r in furniture.strip_furniture(spark.createDataFrame(rows, "book_id string, page_pdf int, text string")).collect()}
    assert all(got[i]["page_printed"] == str(i - 1) and "THE HEAD" not in got[i]["body"] for i in range(2, 9))
    short = furniture.strip_furniture(spark.createDataFrame(rows[:4], "book_id string, page_pdf int, text string")).collect()
    assert all(r["page_printed"] is None and "THE HEAD" in r["body"] for r in short)


def test_text_rules(spark):
    clean = "The quick brown fox jumps over the lazy dog. " * 40
    assert one(spark, T.quality_score, clean) == 1.0
    assert one(spark, T.quality_score, "the managen1ent of con1panies is hovvever a n1ethod " * 30) < 0.5
    assert one(spark, T.quality_score, "sh0rt") == 1.0
    assert one(spark, T.clean_title, "A Book, Annotated Edition V2") == "A Book"
    assert one(spark, T.missing_spaces, "offthe office selfmade selfish stuffin") == "off the office self-made selfish stuff in"
    assert one(spark, T.heading_count, "# a\n#no\n```\n# x\n~~~\n```\n## b") == 2
    assert one(spark, T.fold_paragraphs, "one two\nthree-\nfour\n\n- item\nmore") == "one two threefour\n\n- item more"
    assert one(spark, T.looks_like_list, "\n".join(f"{c}word, 1{i}" for i, c in enumerate("ABCDEFGHIJKLMNO")))
    assert not one(spark, T.looks_like_list, clean)
    assert one(spark, lambda c: T.table_signals(c)[1], "TABLE 9-1\nTable of Contents\n") == 1
    assert one(spark, T.bullets, "● a ● b") == "- a\n- b"


def test_missing_spaces_takes_whole_texts(spark, tmp_path):
    from quire.plans import catalog

    text = "plain words that go on beyond the twentieth character offthe selfmade end"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["missing_spaces"](spark, str(tmp_path)).first()["text"]
    assert got == "off the office stuff in self-made selfish plain words that go on beyond the twentieth character off the self-made end"


def test_split_pages_and_caps(spark):
    d = spark.createDataFrame([("b", "lost\n{10}----\nx\ny\n{12}----\nz")], "book_id string, text string")
    assert [(r["page_pdf"], r["text"]) for r in structure.split_pages(d).orderBy("page_pdf").collect()] == [(10, "x\ny"), (12, "z")]
    assert structure.split_pages(spark.createDataFrame([("b", "no pages")], "book_id string, text string")).count() == 0
    caps = structure.merge_split_caps(spark.createDataFrame([(1, "THE\nCHALLENGE\nOF THE\nFUTURE\nprose")], "doc_id int, text string"))
    assert [r["line"] for r in caps.orderBy("line_no").collect()] == ["THE CHALLENGE OF THE FUTURE", "prose"]


def test_assets(spark):
    d = spark.createDataFrame([(1, 'a ![x](p.png "t")\n![](<q r.png>) ![z](https://h/i.png)')], "doc_id int, text string")
    refs = structure.image_refs(d)
    assert [(r["target"], r["line"]) for r in refs.orderBy("ref_no").collect()] == [("p.png", 1), ("q r.png", 2), ("https://h/i.png", 2)]
    files = spark.createDataFrame([(1, "p.png", 5)], "doc_id int, path string, bytes long")
    gone = structure.dangling_refs(refs, files)
    assert [r["target"] for r in gone.collect()] == ["q r.png"]
    text = structure.strip_dangling(d, gone).first()["text"]
    assert "<!-- missing image: q r.png -->" in text and "![x](p.png" in text


def test_entry_names_every_oracle():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_headings_of_a_page_are_placed_by_one_index():
    """As many entries as a long page has, in time that follows its length; first ids count, anchors in a line stand for their block."""
    from quire.operators.headings import with_headings

    markup = '<body><p id="a">One, two</p><P>x <a id=\'b\'/>y</P><div id="a">late</div><h2 id="c">Own</h2></body>'
    got, n = with_headings(markup, [(1, "one two", "a"), (2, "B & C", "b"), (9, "Own", "c"), (1, "top", "none"), (1, " ", "b")])
    assert n == 4 and got == "<body><h1>top</h1><h1>one two</h1><h2>B &amp; C</h2><P>x <a id='b'/>y</P><div id=\"a\">late</div><h6>Own</h6></body>"
    assert with_headings("", [(1, "t", "x")]) == ("<h1>t</h1>", 1) and with_headings("plain", []) == ("plain", 0)
    long = "".join(f'<p id="p{i}">line {i}</p>' for i in range(20_000))
    whole, n = with_headings(long, [(1, f"line {i}", f"p{i}") for i in range(20_000)])
    assert n == 20_000 and whole == "".join(f"<h1>line {i}</h1>" for i in range(20_000))
