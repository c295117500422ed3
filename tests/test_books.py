"""Paginated text, contents, layout, e-books, conversions and times on small planted tables."""

import importlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import contents, headings, layout, paginated, structure, temporal
from quire.plans import convert
from quire.session import settled
from quire.sources import files as sources

PAGES = "book_id string, page_pdf int, text string"


def apply(spark, f, value):
    return spark.createDataFrame([(value,)], "text string").select(f(F.col("text")).alias("x")).first()["x"]


def test_rules(spark):
    assert apply(spark, T.ligatures, "Th  e oﬃce, th\ne soft­ \n hyphen") == "The office, the softhyphen"
    assert apply(spark, T.clean_title, "A Book (First Edition), 2nd Edition V1.2, Revised (Second Edition), 3rd Edition - V4 (Third Edition) 5th Edition") == "A Book"
    assert apply(spark, T.bullets, "● ● one") == "- ● one" and apply(spark, T.bullets, "● a ● b\n  • c") == "- a\n- b\n  - c"
    assert apply(spark, T.spaced_letters, "x S t o r y of a b c") == "xStory of a b c"
    assert apply(spark, T.joined_caps, "THEHUMANSIDE\nplain THEHUMANSIDE of things here") == "THE HUMAN SIDE\nplain THEHUMANSIDE of things here"
    assert apply(spark, T.fold_paragraphs, "---\ntitle: a\nauthor: b\n---\none\ntwo") == "---\ntitle: a\nauthor: b\n---\none two"
    assert apply(spark, T.fold_paragraphs, "---\nnever\nclosed") == "---\nnever\nclosed"
    assert apply(spark, T.fold_paragraphs, "1. item\nmore\n# Head\ntext\n- \nx") == "1. item more\n# Head\ntext x"  # the lone dash is a hyphen at the line's end
    for rule in (T.ligatures, T.spaced_letters, T.joined_caps, T.bullets, T.contents_lines, T.fold_paragraphs, T.clean_text):
        assert apply(spark, rule, None) is None and apply(spark, rule, "") == ""


def test_paginated(spark):
    rows = [("b", i, f"{i} THE HEAD\n\nbody {chr(96 + i)}\nmore\n{900 + i}" if i == 3 else f"THE HEAD {i}\nbody {chr(96 + i)}\n## kept {i}") for i in range(1, 7)]
    rows += [("b", 7, "THE HEAD\n\n12\n13\nlist"), ("b", 8, "xi\nnew words"), ("b", 9, None), ("b", 10, "0\nlast")]
    got = {r["page_pdf"]: r for r in paginated.strip_paginated(spark.createDataFrame(rows, PAGES)).collect()}
    assert [got[i]["page_printed"] for i in range(1, 11)] == ["1", "2", "903", "4", "5", "6", None, "xi", None, None]
    assert got[3]["body"] == "body c\nmore" and got[1]["body"] == "body a\n## kept 1"
    assert got[7]["body"] == "list" and got[8]["body"] == "new words" and got[9]["body"] == "" and got[10]["body"] == "0\nlast"
    assert paginated.strip_paginated(spark.createDataFrame([], PAGES)).count() == 0


def test_contents(spark):
    marks = spark.createDataFrame([("b", 1, 1, "Chapter 1: The\tOpening", 2), ("b", 2, 2, "p. 9", 9), ("b", 3, 2, "Inner", 3), ("b", 4, 1, None, 4), ("c", 1, 1, "p. 1", 0)], "book_id string, ord int, level int, title string, page_pdf int")
    out = contents.render_contents(marks).collect()
    assert [(r["book_id"], r["contents"]) for r in out] == [("b", "## Table of Contents\n\n- Chapter 1: The Opening (p. 2)\n  - Inner (p. 3)\n")]
    pages = spark.createDataFrame([("b", 2, "THE\nOPENING of a tale\nmore"), ("b", 3, "innermost words"), ("b", 4, "x"), ("b", 9, None)], PAGES)
    got = {r["page_pdf"]: r for r in contents.promote_bookmarks(pages, marks).collect()}
    assert got[2]["text"] == "## THE OPENING\n\nof a tale\nmore" and got[2]["promoted"]
    assert not got[3]["promoted"] and got[3]["text"] == "innermost words" and got[9]["text"] is None
    assert apply(spark, contents.lists_contents, "One .... 1\nTwo ... 2\nFigure 3\nx\ny") and not apply(spark, contents.lists_contents, "One .... 1\nTwo ... 2")


def test_tables_of_a_page(spark):
    cells = [(100, 72, "TABLE 1-2"), (112, 72, "A short line")]
    cells += [(130 + 14 * r, 72 + 120 * c, f"r{r}c{c}") for r in range(3) for c in range(3)] + [(172, 192, "goes on")]
    cells += [(300, 72, "after that the following paragraph holds several longer words of prose"), (50, 72, "before")]
    c = spark.createDataFrame([("b", 1, float(y), float(x), t) for y, x, t in cells], "book_id string, page_pdf int, y double, x double, text string")
    size = spark.createDataFrame([("b", 1, 612.0, 792.0), ("b", 2, 612.0, 792.0)], "book_id string, page_pdf int, width double, height double")
    (t,) = layout.tables(c, size).collect()
    assert t["markdown"] == "**TABLE 1-2 — A short line**\n\n| r0c0 | r0c1 | r0c2 |\n|---|---|---|\n| r1c0 | r1c1 | r1c2 |\n| r2c0 | r2c1 goes on | r2c2 |"
    text = {r["page_pdf"]: r["text"] for r in layout.stitched(c, layout.tables(c, size), size).collect()}
    assert text[1].startswith("before\n\n**TABLE") and text[1].endswith("longer words of prose\n") and text[2] == "\n"
    assert layout.tables(c.where("text = 'none'"), size).count() == 0


def epub(pages, nav):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.opf", '<package><manifest><item id="n" href="n.xhtml" properties="nav" media-type="application/xhtml+xml"/>' + "".join(f'<item id="i{k}" href="{n}" media-type="application/xhtml+xml"/>' for k, n in enumerate(pages)) + "</manifest><spine>" + "".join(f'<itemref idref="i{k}"/>' for k in range(len(pages))) + "</spine></package>")
        z.writestr("mimetype", "application/epub+zip")
        z.writestr("n.xhtml", nav)
        for name, text in pages.items():
            z.writestr(name, text)
    return out.getvalue()


def test_ebook_from_archive_to_markdown(spark):
    book = epub({"1.xhtml": "<body><p id='a'>One  day</p><p>some <b>bold</b> text</p></body>", "2.xhtml": "<body><p>two</p></body>"}, '<nav epub:type="toc"><ol><li><a href="1.xhtml#a">One day</a><ol><li><a href="2.xhtml">Two</a></li></ol></li></ol></nav>')
    files = spark.createDataFrame([("p", "tale", "epub", len(book), bytearray(book)), ("q", "broken", "epub", 1, bytearray(b"x"))], "path string, stem string, suffix string, length long, content binary")
    entries = settled(sources.epub_entries(files))
    docs, nav = settled(sources.spine(entries)), settled(sources.navigation(entries))
    assert [(r["depth"], r["label"], r["doc"], r["anchor"]) for r in nav.orderBy("ord").collect()] == [(1, "One day", "1.xhtml", "a"), (2, "Two", "2.xhtml", None)]
    (r,) = convert.convert_ebooks(docs, nav).collect()
    assert r["text"] == "# One day\n\nsome **bold** text\n\n## Two\n\ntwo\n" and (r["heading_source"], r["n_injected"], r["headings_emitted"], r["warning"]) == ("nav", 2, 2, None)
    plan = headings.plan_headings(docs, nav)
    done = {x["stem"]: bytes(x["content"]) for x in sources.rewrite_ebooks(files, plan).collect()}
    with zipfile.ZipFile(io.BytesIO(done["tale"])) as z:
        assert z.namelist()[0] == "mimetype" and z.infolist()[0].compress_type == zipfile.ZIP_STORED and "<h1>One day</h1>" in z.read("1.xhtml").decode()
    assert done["broken"] == b"x"


def test_assets_by_path(spark):
    texts = spark.createDataFrame([(1, "![a](./img/a%20b.png) ![c](img/../gone.png)"), (2, None), (3, "")], "doc_id int, text string")
    files = spark.createDataFrame([(1, "img/a b.png", 7)], "doc_id int, path string, bytes long")
    done, manifest, report = structure.finalize_assets(texts, files)
    assert {r["doc_id"]: r["text"] for r in done.collect()} == {1: "![a](./img/a%20b.png) <!-- missing image: img/../gone.png -->", 2: None, 3: ""}
    assert [len(r["references"]) for r in manifest.collect()] == [1]
    assert {r["doc_id"]: (r["n_refs"], r["n_stripped"], r["n_dangling"]) for r in report.collect()} == {1: (2, 1, 0), 2: (0, 0, 0), 3: (0, 0, 0)}


def test_asof(spark):
    left = spark.createDataFrame([(1, 10, "a"), (1, 5, "b"), (2, 9, "c"), (None, 9, "d"), (1, None, "e")], "k int, t int, x string")
    right = spark.createDataFrame([(1, 5, 50), (1, 8, 80), (2, 10, 100), (None, 1, 1)], "k int, t int, v int")
    assert {r["x"]: r["v"] for r in temporal.asof_join(left, right, "k", "t", ["v"]).collect()} == {"a": 80, "b": 50, "c": None, "d": None, "e": None}


def test_command_line(spark, tmp_path):
    from quire.__main__ import main

    prose = "Some plain words that make a page of text with no marks at all. "
    (tmp_path / "in").mkdir()
    (tmp_path / "in/tale.txt").write_text("\f".join(f"THE HEAD\n{prose}{w}\nand on it goes {w}\nand more of it {w}\nthe end of page {w}\n{i}" for i, w in enumerate("ash birch cedar elm fir larch oak pine".split(), 1)))
    (tmp_path / "in/blank.txt").write_text("\f" * 30)
    importlib.invalidate_caches()
    assert main([str(tmp_path / "in"), "-o", str(tmp_path / "out")], spark) == 1  # the blank book fails
    text = (tmp_path / "out/tale.md").read_text()
    assert "<!-- page_pdf=3 page_printed=3 -->" in text and "THE HEAD" not in text and not (tmp_path / "out/blank.md").exists()
    assert '"status":"scanned"' in (tmp_path / "out/blank.report.json").read_text()
    assert main([str(tmp_path / "in"), "-o", str(tmp_path / "out"), "--extractor", "quire.sources.pages:form_feeds"], spark) == 1


def test_backends_say_what_they_lack():
    b = convert.Backends(convert.Backend("x", lambda f: f, modules=("no_such_module",), reads_scans=True))
    with pytest.raises(RuntimeError, match="no_such_module"):
        b.get("x")
    assert b.for_scans() is None
