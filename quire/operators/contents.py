"""Bookmarks: tables of contents made of them, headings found by them, and printed contents that they replace.

Input: bookmarks(book_id, ord, level, title, page_pdf) and pages(book_id, page_pdf, text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import computed, strip

# Fixed values.
POINTER = r"(?i)^(?:p\.?\s*)?\d+\s*$"
LEADER = r"^(?:-\s+)?.+?\s+(?:\.{2,}|…)\s*\d+\s*$"
LABEL = r"(?i)^-\s+(?:Figure|Table|Chapter|Part|Section)\s*\.*\s*\d+\s*$"
BARE_LABEL = r"(?i)^-?\s*(?:Figure|Table|Chapter|Part|Section)\s+\d+\s*$"
NUMBERING = r"(?i)^(?:chapter\s+\d+[.:]?\s*|part\s+\d+[.:]?\s*|\d+[.)]\s*)"
LEAST_LINES, FIRST_PAGES, SEARCHED, SLACK, LEAST_TITLE = 5, 20, 20, 40, 4


def tidy(title: Column) -> Column:
    return strip(F.regexp_replace(F.coalesce(title, F.lit("")), "[\t   ]+", " "))


def is_pointer(title: Column) -> Column:
    return title.rlike(POINTER)


def useful_contents(bookmarks: DataFrame) -> DataFrame:
    """(book_id, useful): whether a book's bookmarks are worth a table: some lead to a page, and at most half are bare page numbers."""
    title = tidy(F.col("title"))
    return bookmarks.groupBy("book_id").agg(((F.count_if(F.col("page_pdf") > 0) > 0) & (2 * F.count_if(is_pointer(title)) <= F.count("*"))).alias("useful"))


def render_contents(bookmarks: DataFrame) -> DataFrame:
    """(book_id, contents): an outline in Markdown of each book's useful bookmarks in order; books without an entry have none."""
    title = tidy(F.col("title"))
    line = F.concat(F.repeat(F.lit("  "), F.greatest(F.col("level"), F.lit(1)) - 1), F.lit("- "), title, F.lit(" (p. "), F.col("page_pdf").cast("string"), F.lit(")"))
    entries = bookmarks.where((title != "") & ~is_pointer(title) & (F.col("page_pdf") > 0)).select("book_id", "ord", line.alias("line"))
    kept = entries.join(useful_contents(bookmarks).where("useful"), "book_id", "left_semi")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x.line)
    return kept.groupBy("book_id").agg(F.concat(F.lit("## Table of Contents\n\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("contents"))


def lists_contents(text: Column) -> Column:
    """Whether at least half of a page's lines are entries of a printed table of contents; pages of fewer than five lines are none."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    entries = F.size(F.filter(lines, lambda x: x.rlike(LEADER) | x.rlike(LABEL) | x.rlike(BARE_LABEL)))
    return F.coalesce((F.size(lines) >= LEAST_LINES) & (2 * entries >= F.size(lines)), F.lit(False))


def replaced_contents(pages: DataFrame, contents: DataFrame) -> DataFrame:
    """pages with replaced: printed contents among the first pages of a book that has a table made of its bookmarks."""
    sizes = pages.groupBy("book_id").agg(F.max("page_pdf").alias("n"))
    has = contents.select("book_id", F.lit(True).alias("has"))
    joined = pages.join(sizes, "book_id").join(has, "book_id", "left")
    early = F.col("page_pdf") <= F.greatest(F.lit(FIRST_PAGES), F.floor(F.col("n") / 10))
    return joined.select(*pages.columns, (F.coalesce("has", F.lit(False)) & early & lists_contents(F.col("text"))).alias("replaced"))


def letters_of(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))


def promote_bookmarks(pages: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """pages with text changed by the first bookmark of the page, in order, whose title is found, and promoted (whether one was).

    Letters and digits alone are compared. A title is found where it ends at a
    word's end, within the first lines and not far in, and before any heading.
    What stands before it on its lines belongs to the heading; what stands
    behind it becomes body text. Pages without bookmarks, and null texts, stay
    as they are.
    """
    titles = bookmarks.where(F.col("page_pdf") > 0).select("book_id", "page_pdf", "ord", F.regexp_replace(F.lower(strip(F.regexp_replace(strip(F.col("title")), NUMBERING, ""))), "[^a-z0-9]", "").alias("target"))
    asked = pages.select("book_id", "page_pdf", F.split("text", "\n").alias("lines")).join(titles.where(F.length("target") >= LEAST_TITLE), ["book_id", "page_pdf"])
    trimmed = F.transform(F.slice("lines", 1, SEARCHED), strip)
    look = computed(asked, s=trimmed)
    s = F.col("s")
    full = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (F.get(s, i) != "") & ~F.get(s, i).startswith("<!-- Page"))
    look = computed(look, full=full)
    heads = F.filter("full", lambda i: F.get(s, i).startswith("#"))
    look = computed(look, full_lines=F.filter("full", lambda i: F.coalesce(i < F.array_min(heads), F.lit(True)))).drop("full")
    at = lambda k: F.get("full_lines", k)
    look = computed(look, letters=F.transform("full_lines", lambda i: letters_of(F.get(s, i))))
    so_far = F.transform(F.sequence(F.lit(0), F.size("letters")), lambda k: F.array_join(F.slice("letters", F.lit(1), k), ""))  # before each line, and after the last
    look = computed(look.where(F.size("letters") > 0), so_far=so_far)
    target = F.col("target")
    ends = F.filter(F.sequence(F.lit(0), F.size("letters") - 1), lambda k: F.get("so_far", k + 1).contains(target) & (F.length(F.get("so_far", k)) <= F.length(target) + SLACK))
    look = computed(look, k=F.get(ends, F.lit(0))).where("k is not null")
    # how many letters of the last line end the first occurrence of the title
    needed = F.instr(F.get("so_far", F.col("k") + 1), target) + F.length(target) - 1 - F.length(F.get("so_far", F.col("k")))
    counted = F.concat(F.lit(r"^((?:[^\p{L}\p{N}]*[\p{L}\p{N}]){"), F.greatest(needed, F.lit(1)).cast("string"), F.lit("})"))
    line = F.get(s, at(F.col("k")))
    look = computed(look, first=at(F.lit(0)), last=at(F.col("k")), line=line, head=F.call_function("regexp_extract", line, counted, F.lit(1)))
    rest = F.substring("line", F.length("head") + 1, F.length("line"))
    opening = F.transform(F.slice("full_lines", F.lit(1), F.col("k")), lambda i: F.get(s, i))
    prefix = F.regexp_replace("head", r"[ \t.,:;\-]+$", "")
    heading = strip(F.array_join(F.concat(opening, F.filter(F.array(prefix), lambda x: x != "")), " "))
    look = computed(look, rest=rest, heading=heading).where((F.col("heading") != "") & ~F.col("rest").rlike(r"^[\p{L}\p{N}]"))
    body = F.regexp_replace("rest", r"^[ \t.,:;\-]+", "")
    first, last, lines = F.col("first"), F.col("last"), F.col("lines")
    between = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i > first) & (i < last) & ~F.array_contains("full_lines", i))
    out = F.concat(
        F.slice(lines, F.lit(1), first),
        F.array(F.concat(F.lit("## "), F.col("heading"))),
        F.transform(between, lambda i: F.get(lines, i)),
        F.when(body != "", F.array(F.lit(""), body)).otherwise(F.array().cast("array<string>")),
        F.slice(lines, last + 2, F.greatest(F.size(lines) - last - 1, F.lit(0))),
    )
    found = look.select("book_id", "page_pdf", "ord", F.array_join(out, "\n").alias("found")).groupBy("book_id", "page_pdf").agg(F.min_by("found", "ord").alias("found"))
    joined = pages.join(found, ["book_id", "page_pdf"], "left")
    return joined.select(*(c for c in pages.columns if c != "text"), F.coalesce("found", "text").alias("text"), F.col("found").isNotNull().alias("promoted"))
