"""Figures, e-book containers, sinks and the stream on small planted inputs."""

import zipfile

from quire.operators import figures
from quire.sources import files
from quire.streaming import ingest


def test_regions(spark):
    rows = [("b", 1, 0.0, 0.0, 50.0, 50.0), ("b", 1, 79.0, 0.0, 90.0, 50.0), ("b", 1, 119.0, 0.0, 130.0, 60.0), ("b", 1, 400.0, 400.0, 410.0, 410.0), ("b", 2, 0.0, 0.0, 60.0, 60.0), ("b", 2, None, 0.0, 1.0, 1.0)]
    d = spark.createDataFrame(rows, "book_id string, page_pdf int, x0 double, y0 double, x1 double, y1 double")
    assert sorted(map(tuple, figures.merge_regions(d).collect())) == [("b", 1, 0.0, 0.0, 130.0, 60.0), ("b", 2, 0.0, 0.0, 60.0, 60.0)]
    assert figures.raster_regions(d).count() == 2
    grown = figures.merged_boxes([(0, 0, 10, 10), (80, 2, 90, 5), (8, 8, 100, 100)], 2)
    assert grown == [(0, 0, 100, 100)]
    regions = spark.createDataFrame([("b", 1, 1, 0.0, 0.0, 100.0, 100.0), ("b", 1, 2, 0.0, 500.0, 100.0, 600.0)], "book_id string, page_pdf int, region_id int, x0 double, y0 double, x1 double, y1 double")
    lines = spark.createDataFrame([("b", 1, 0, 0.0, 130.0, 90.0, 140.0, " Figure 2.1 far"), ("b", 1, 1, 0.0, 110.0, 90.0, 120.0, "Fig. 3 near"), ("b", 1, 2, 0.0, 105.0, 9.0, 110.0, "Figures speak"), ("b", 1, 3, 300.0, 101.0, 310.0, 110.0, "Figure 4")], "book_id string, page_pdf int, ord int, x0 double, y0 double, x1 double, y1 double, text string")
    assert {r["region_id"]: r["caption"] for r in figures.match_captions(regions, lines).collect()} == {1: "Fig. 3 near", 2: None}


def test_harvest(spark):
    d = spark.createDataFrame([(1, "a/x.png"), (1, "b/x.png"), (1, "b/c/x.png"), (1, "b-x.png"), (2, None)], "doc_id int, path string")
    got = {r["path"]: r["name"] for r in figures.harvest_names(d).collect()}
    assert got == {"a/x.png": "x.png", "b-x.png": "b-x.png", "b/c/x.png": "c-x.png", "b/x.png": "b-2-x.png"}
    texts = spark.createDataFrame([(1, "![a](q/x%20y.png) ![b](https://h/x%20y.png) $1"), (2, None)], "doc_id int, text string")
    names = spark.createDataFrame([(1, "x y.png", "n.png")], "doc_id int, base string, name string")
    rows = {r["doc_id"]: r for r in figures.rewrite_refs(texts, names, "assets").collect()}
    assert rows[1]["text"] == "![a](assets/n.png) ![b](https://h/x%20y.png) $1" and rows[1]["n_rewritten"] == 1 and rows[2]["text"] is None


def test_epub(spark, tmp_path):
    opf = '<package><manifest><item id="a" href="t/a.xhtml" media-type="application/xhtml+xml"/><item id="n" href="nav.xhtml" properties="nav"/><item id="i" href="i.png" media-type="image/png"/><item id="b" href="b.html"/></manifest><spine toc="x"><itemref idref="n"/><itemref idref="b"/><itemref idref="i"/><itemref idref="a"/><itemref idref="zz"/></spine></package>'
    with zipfile.ZipFile(tmp_path / "Book.EPUB", "w") as z:
        for name, text in {"META-INF/container.xml": '<rootfile full-path="O/p.opf"/>', "first.opf": "<x/>", "O/p.opf": opf, "O/t/a.xhtml": "<p>a</p>", "O/nav.xhtml": "<nav/>", "O/b.html": "<p>b</p>"}.items():
            z.writestr(name, text)
    (tmp_path / "broken.epub").write_bytes(b"no archive")
    (tmp_path / "other.txt").write_text("x")
    found = files.books(spark, str(tmp_path))
    assert {r["stem"] for r in found.select("stem").collect()} == {"Book", "broken"}
    got = files.spine(files.epub_entries(found)).orderBy("ord").collect()
    assert [(r["book_id"], r["name"], r["markup"]) for r in got] == [("Book", "O/b.html", "<p>b</p>"), ("Book", "O/t/a.xhtml", "<p>a</p>")]
    done = spark.createDataFrame([("Book",)], "stem string")
    assert [r["stem"] for r in files.without_existing(found, done).select("stem").collect()] == ["broken"]


def test_sinks_and_stream(spark, tmp_path):
    pages = spark.createDataFrame([("k", 2, "two"), ("k", 1, "wWilliam"), ("l", 1, None)], "book_id string, page_pdf int, body string")
    files.write_markdown(pages, str(tmp_path / "md"))
    (part,) = (tmp_path / "md" / "stem=k").glob("*.txt")
    assert part.read_text().index("page_pdf=1") < part.read_text().index("page_pdf=2")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("wWilliam\n\n\n\nb")
    for i in (1, 2):
        ingest.clean_arrivals(ingest.arrivals(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == i
        (tmp_path / "in" / "b.md").write_text("c")
    assert "William\n\nb" in {r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
