"""Whole conversions: pages of books to Markdown with page addresses and a report a book, e-books likewise, retries over other backends."""

from __future__ import annotations

import importlib.util
import shutil
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cleanup, contents, furniture, headings, locators, paginated, structure
from ..session import settled, written

PAGE = ["book_id", "page_pdf"]


def with_headings(pages: DataFrame) -> DataFrame:
    """pages(key, text), a row a key, with capitals that were split over lines joined, and chapter lines and lines of capitals made headings."""
    merged = structure.merge_split_caps(pages, "key")
    lines = structure.promote_headings(merged.select("key", "line_no", "line"), "key")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x.line), "\n")
    return lines.groupBy("key").agg(text.alias("text"))


def page_markdown(pages: DataFrame, bookmarks: DataFrame | None = None) -> DataFrame:
    """(book_id, page_pdf, body) of cleaned pages(book_id, page_pdf, body): text rules, headings by bookmarks and by shape, contents lines.

    Lines of list pages stay apart, but for the first pages of a book whose
    contents come from bookmarks; printed contents there are left out, and so
    are pages that end up blank.
    """
    texts = pages.select(*PAGE, F.coalesce("body", F.lit("")).alias("text"))
    outline = contents.render_contents(bookmarks).select("book_id") if bookmarks is not None else None
    if outline is None:
        front = texts.withColumn("front", F.lit(False))
    else:
        sizes = texts.groupBy("book_id").agg(F.max("page_pdf").alias("n")).join(outline, "book_id")
        early = F.coalesce(F.col("page_pdf") <= F.greatest(F.lit(contents.FIRST_PAGES), F.floor(F.col("n") / 10)), F.lit(False))
        front = texts.join(sizes, "book_id", "left").select(*PAGE, "text", early.alias("front"))
    dealt = front.select(F.struct(*PAGE, "front").alias("key"), "text").repartition("key")  # rules are costly, and pages come dealt by book; lines stay where their page is
    cleaned = dealt.select("key", T.clean_text(F.col("text"), ~F.col("key.front") & T.looks_like_list(F.col("text"))).alias("text"))
    if bookmarks is not None:
        cleaned = contents.promote_bookmarks(cleaned.select("key.*", "text"), bookmarks).select(F.struct(*PAGE, "front").alias("key"), "text")
    done = with_headings(cleaned).select("key.*", T.contents_lines(F.col("text")).alias("text"))
    return done.where(F.col("text").rlike(r"\S") & ~(F.col("front") & contents.lists_contents(F.col("text")))).select(*PAGE, F.col("text").alias("body"))


def gate(total: Column, with_text: Column, score: Column) -> Column:
    """ok, scanned (too few pages have text) or low quality; the first that fails."""
    return F.when((total > 0) & (with_text < T.LOW_TEXT * total), "scanned").when(score < T.LOW_QUALITY, "low quality").otherwise("ok")


def warnings_of(misread: Column, missing: Column) -> Column:
    """Warnings on a book with such misread_counts: table captions without a table, and each pattern of misread letters that is frequent."""
    names = ("runs of capital consonants", "broken abbreviations", "digits inside words")
    read = [F.when(n.isNotNull(), F.concat(n.cast("string"), F.lit(f" {name}"))) for n, name in zip(T.dense(misread), names)]
    return F.array_compact(F.array(F.when(missing > 0, F.concat(missing.cast("string"), F.lit(" table caption(s) without a table"))), *read))


def misread_warnings(located: DataFrame, agreed: DataFrame) -> DataFrame:
    """(book_id, warnings): a line for every page whose printed number contradicts its book's offset."""
    wrong = located.where("misread").join(agreed.select("book_id", "page_offset"), "book_id")
    line = F.format_string("page_pdf=%d: the printed number does not fit the offset %d and was replaced", "page_pdf", "page_offset")
    return wrong.groupBy("book_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_pdf", line.alias("w")))), lambda x: x.w).alias("warnings"))


PICTURE_MARK = r"\*\*-+ (Start|End) of picture text -+\*\*<br>"
#: Pages whose headings are counted together, before those of a book are.
BLOCK = 4096


def joined_pictures(parts: DataFrame) -> DataFrame:
    """parts(book_id, at, last, text) in which no block of picture text goes beyond its part: parts from one that leaves a block open to the one that ends it are one.

    Only parts with marks are looked at along a book. A block that nothing ends is none.
    """
    marks = parts.select("book_id", "at", F.regexp_extract_all("text", F.lit(PICTURE_MARK), 1).alias("marks")).where(F.size("marks") > 0)
    along = Window.partitionBy("book_id").orderBy("at")
    ends = F.min(F.when(F.array_contains("marks", "End"), F.col("at"))).over(along.rowsBetween(1, Window.unboundedFollowing))
    spans = marks.withColumn("hi", ends).where((F.element_at("marks", -1) == "Start") & F.col("hi").isNotNull())
    new = F.coalesce(F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1)) < F.col("at"), F.lit(True))
    islands = spans.withColumn("new", new).withColumn("k", F.sum(F.col("new").cast("int")).over(along)).groupBy("book_id", "k").agg(F.min("at").alias("lo"), F.max("hi").alias("hi"))
    islands = settled(islands.select(F.col("book_id").alias("b"), "lo", "hi"))
    if islands.isEmpty():
        return parts
    placed = parts.join(islands, (F.col("book_id") == F.col("b")) & F.col("at").between(F.col("lo"), F.col("hi")), "left")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x.text), "")
    one = placed.where("lo is not null").groupBy("book_id", F.col("lo").alias("at")).agg(F.max("last").alias("last"), text.alias("text"))
    return placed.where("lo is null").select(*parts.columns).unionByName(one.select(*parts.columns))


def book_parts(books: DataFrame, bodies: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """parts(book_id, at, last, text): the repaired text of books(book_id, head) cut before the marks of pages, so that no task holds a book.

    bodies(book_id, page_pdf, part) are pages behind their marks. The parts of a
    book, in order of at, joined by nothing, are its whole text. No repair looks
    beyond a part, but for blocks of picture text, whose parts are one.
    """
    last = bodies.groupBy("book_id").agg(F.max("page_pdf").alias("n"))
    place = lambda body, page: F.struct(F.lit(body).alias("body"), page.cast("long").alias("page"))
    heads = books.join(last, "book_id", "left").select("book_id", place(0, F.lit(0)).alias("at"), F.col("n").isNull().alias("last"), F.concat("head", F.when(F.col("n").isNull(), "\n\n").otherwise("")).alias("text"))
    pages = bodies.join(last, "book_id").select("book_id", place(1, F.col("page_pdf")).alias("at"), (F.col("page_pdf") == F.col("n")).alias("last"), F.concat(F.lit("\n\n"), "part").alias("text"))
    parts = joined_pictures(heads.unionByName(pages)).withColumn("key", F.struct("book_id", "at"))
    text = F.when(F.col("last"), F.col("text")).otherwise(F.regexp_replace("text", r"\n+\z", ""))  # the next part begins with the empty line
    return cleanup.clean_markdown(parts, dictionary, "key").select("book_id", "at", "last", text.alias("text"))


def part_counts(parts: DataFrame) -> DataFrame:
    """(book_id, artifacts, misread, emitted, captions, headings): what the report says of a book's whole text, added up from its parts.

    A part is read from behind its own mark to behind the next one: that ends a
    comment that the part leaves open, as it does in the whole text.
    """
    inner = F.regexp_replace("text", r"(?s)\A\n\n<!--.*?-->", "")
    read = parts.select("book_id", "at", F.concat(F.when(F.col("at.body") == 0, F.col("text")).otherwise(inner), F.when(F.col("last"), "").otherwise("\n\n<!-- -->")).alias("t"))
    emitted, captions = T.table_signals(F.col("t"))
    counted = read.select("book_id", "at", T.artifact_counts(F.col("t")).alias("a"), T.misread_counts(F.col("t")).alias("m"), emitted.cast("long").alias("emitted"), captions.cast("long").alias("captions"), T.heading_steps(F.col("t")).alias("h"))
    sums = lambda c, fields: F.struct(*(F.sum(f"{c}.{f}").alias(f) for f in fields)).alias(c)
    found = lambda: [sums("a", ("chars", "artifacts")), sums("m", ("chars", *(f"p{k}" for k in range(len(T.OCR_PATTERNS))))), F.sum("emitted").alias("emitted"), F.sum("captions").alias("captions")]
    steps = T.steps_together(F.transform(F.array_sort(F.collect_list(F.struct("at", "h"))), lambda x: x.h)).alias("h")
    blocks = counted.groupBy("book_id", F.struct("at.body", F.floor(F.col("at.page") / BLOCK).alias("block")).alias("block")).agg(*found(), steps)
    books = blocks.withColumnRenamed("block", "at").groupBy("book_id").agg(*found(), steps)
    return books.select("book_id", F.col("a").alias("artifacts"), F.col("m").alias("misread"), "emitted", "captions", F.get("h", F.lit(0)).n.alias("headings"))


def converted(pages: DataFrame, bookmarks: DataFrame | None = None, shared_lines: bool = False, dictionary: DataFrame | None = None, method: str = "text") -> tuple[DataFrame, DataFrame]:
    """(reports, parts) of pages(book_id, page_pdf, text): convert_pages without texts, a row a book, and its texts as book_parts; no task holds a book."""
    clean = written(paginated.strip_paginated(pages), "clean") if shared_lines else furniture.strip_furniture(pages)  # the latter has been written
    located = settled(locators.locate(clean).select("book_id", "page_pdf", "page_printed", "captured", "misread"))
    number = F.coalesce("page_printed", F.lit("none"))
    part = F.concat(F.format_string("<!-- page_pdf=%d page_printed=%s -->\n\n", "page_pdf", number), "body")
    bodies = written(page_markdown(clean.select(*PAGE, "body"), bookmarks).join(located, PAGE).select(*PAGE, "captured", part.alias("part")), "bodies")
    counts = bodies.groupBy("book_id").agg(F.count("*").alias("page_locator_count"), F.count_if("captured").alias("page_printed_count"))
    head = F.concat(F.lit("# "), T.clean_title(F.col("book_id")), F.lit(f"\n\n*Converted by {method}*\n\n---"))
    books = pages.select("book_id").distinct()  # a book may have no line of its own
    if bookmarks is not None:
        books = books.join(contents.render_contents(bookmarks), "book_id", "left")
        head = F.concat(head, F.coalesce(F.concat(F.lit("\n\n"), "contents", F.lit("\n---")), F.lit("")))
    parts = book_parts(books.select("book_id", head.alias("head")), bodies, dictionary)
    totals = pages.groupBy("book_id").agg(F.count("*").alias("total_pages"), F.count_if(F.col("text").rlike(r"\S")).alias("pages_with_text"))
    agreed = locators.consensus(clean.where("page_printed is not null"))
    misread = misread_warnings(located, agreed)
    report = totals.join(part_counts(parts), "book_id", "left").join(counts, "book_id", "left").join(agreed, "book_id", "left").join(misread, "book_id", "left")
    score = F.coalesce(T.score_of(F.col("artifacts")), F.lit(1.0))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    emitted, captions = zero("emitted"), zero("captions")
    status = gate(F.col("total_pages"), F.col("pages_with_text"), score)
    none = F.array().cast("array<string>")
    printed, with_locator = zero("page_printed_count"), zero("page_locator_count")
    refused = F.when((printed > 0) & F.col("refusal").isNotNull(), F.array(F.concat(F.lit("no page offset: "), F.col("refusal")))).otherwise(none)
    reports = report.select(
        "book_id", status.alias("status"), F.lit(method).alias("method"), "total_pages", "pages_with_text", F.round(score, 6).alias("quality_score"),
        emitted.cast("int").alias("tables_emitted"), captions.cast("int").alias("table_captions_seen"), with_locator.alias("page_locator_count"), printed.alias("page_printed_count"),
        F.when(printed > 0, "printed").when(with_locator > 0, "pdf_only").otherwise("none").alias("page_numbering"), F.coalesce(F.round(printed / F.nullif(with_locator, F.lit(0)), 6), F.lit(0.0)).alias("page_printed_coverage"),
        F.col("page_offset").alias("page_printed_offset"), F.coalesce("consistent", F.lit(False)).alias("page_printed_offset_consistent"),
        zero("headings").cast("int").alias("headings_emitted"), F.concat(F.coalesce("warnings", none), refused, warnings_of(F.col("misread"), captions - emitted)).alias("warnings"),
    )
    return reports, parts


def convert_pages(pages: DataFrame, bookmarks: DataFrame | None = None, shared_lines: bool = False, dictionary: DataFrame | None = None, method: str = "text") -> DataFrame:
    """books(book_id, status, text, report...) of pages(book_id, page_pdf, text): the whole path from pages to a Markdown text a book.

    shared_lines: printed numbers may share a line with a running head, as in
    paginated text. A book that fails a gate has its status, and a null text.
    """
    reports, parts = converted(pages, bookmarks, shared_lines, dictionary, method)
    texts = parts.groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x.text), "").alias("text"))
    books = reports.join(texts, "book_id", "left")
    return books.select("book_id", "status", F.when(F.col("status") == "ok", F.col("text")).alias("text"), *reports.columns[2:])


def convert_ebooks(docs: DataFrame, nav: DataFrame) -> DataFrame:
    """(book_id, status, text, heading_source, n_injected, headings_emitted, warning) of e-books' pages and navigation entries."""
    docs, nav = settled(docs), settled(nav)  # read many times below
    plan = settled(headings.plan_headings(docs, nav))
    texts = headings.book_markdown(plan)
    texts = texts.select("book_id", T.without_noise(T.without_frontmatter(F.col("text"))).alias("text"))
    counted = texts.select("book_id", T.heading_count(F.col("text")).alias("n_headings"))
    checked = headings.reconciled(plan, counted)
    return checked.join(texts, "book_id").select("book_id", F.lit("ok").alias("status"), "text", "heading_source", "n_injected", F.col("n_headings").alias("headings_emitted"), "warning")


@dataclass(frozen=True)
class Backend:
    """A way to read pages: what it needs, and a function from files(path, stem, suffix, content) to pages(book_id, page_pdf, text)."""

    name: str
    read: Callable[[DataFrame], DataFrame]
    modules: tuple[str, ...] = ()
    programs: tuple[str, ...] = ()
    reads_scans: bool = False
    shared_lines: bool = False

    def missing(self) -> list[str]:
        return [m for m in self.modules if importlib.util.find_spec(m) is None] + [p for p in self.programs if shutil.which(p) is None]


class Backends:
    """The backends at hand, in order of preference."""

    def __init__(self, *backends: Backend) -> None:
        self.by_name = {b.name: b for b in backends}

    def get(self, name: str) -> Backend:
        """The named backend; what it lacks is said before any work starts."""
        if name not in self.by_name:
            raise ValueError(f"no backend {name}; there are {', '.join(self.by_name)}")
        if lacks := self.by_name[name].missing():
            raise RuntimeError(f"{name} needs {', '.join(lacks)}")
        return self.by_name[name]

    def for_scans(self) -> Backend | None:
        return next((b for b in self.by_name.values() if b.reads_scans and not b.missing()), None)

    def convert(self, files: DataFrame, name: str, retry: bool = True, bookmarks: DataFrame | None = None) -> DataFrame:
        """Books by one backend; those that fail a gate go once through the first other backend that reads scans, if there is one."""
        first, other = self.get(name), self.for_scans()
        done = convert_pages(first.read(files), bookmarks, first.shared_lines, method=name)
        if not retry or other is None or other.name == name:
            return done
        done = settled(done)
        failed = done.where("status <> 'ok'").select(F.col("book_id").alias("stem"))
        again = convert_pages(other.read(files.join(failed, "stem", "left_semi")), bookmarks, other.shared_lines, method=other.name)
        return done.where("status = 'ok'").unionByName(again)
