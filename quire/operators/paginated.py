"""Printed page numbers and furniture of paginated text, where a number may share its line with a running head.

Input: pages(book_id, page_pdf, text). All rules work on rows of lines; only
the lines of the three first and last that are not blank are judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_roman, strip

# Fixed values.
BAND, LEAST_PAGES = 3, 3
NOT_A_HEAD = r"^(?:#{1,6}\s|>|!\[)"
LEADING, TRAILING = r"^(\d{1,4})\s+(\S.*)$", r"^(.*\S)\s+(\d{1,4})$"
HEADING = r"^#{1,6}\s"

PAGE = ("book_id", "page_pdf")


def is_folio(line: Column) -> Column:
    """Whether a stripped line is a printed page number by itself; no book prints page 0."""
    return F.coalesce((line.rlike("^[0-9]{1,4}$") & line.rlike("[1-9]")) | is_roman(line), F.lit(False))


def embedded(line: Column) -> Column:
    """(folio, residue) of a number at either end of a stripped line that has letters beside it; tables, headings, quotations and images have none."""
    pair = lambda pattern, folio, rest: F.when(line.rlike(pattern), F.struct(F.regexp_extract(line, pattern, folio).alias("folio"), F.regexp_extract(line, pattern, rest).alias("residue")))
    both = F.array_compact(F.array(pair(LEADING, 1, 2), pair(TRAILING, 2, 1)))
    good = F.filter(both, lambda x: x.folio.rlike("[1-9]") & x.residue.rlike(r"\p{L}"))
    none = F.array().cast("array<struct<folio:string,residue:string>>")
    return F.when(line.rlike(NOT_A_HEAD) | line.contains("|") | is_folio(line), none).otherwise(good)


def page_lines(pages: DataFrame) -> DataFrame:
    """(book_id, page_pdf, at, line, s, head, foot): every line, stripped too, with its rank from the top and the end among those that are not blank."""
    lines = pages.select(*PAGE, F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("s", strip(F.col("line")))
    full = F.when(F.col("s") != "", 1)
    rank = lambda order: F.when(F.col("s") != "", F.count(full).over(Window.partitionBy(*PAGE).orderBy(order)))
    return lines.withColumn("head", rank(F.col("at"))).withColumn("foot", rank(F.desc("at")))


def known_lines(lines: DataFrame) -> DataFrame:
    """(book_id, band, line): band lines, or what is left of them beside a number, on at least LEAST_PAGES pages of the book."""
    bands = F.array_compact(F.array(F.when(F.col("head") <= BAND, F.lit("head")), F.when(F.col("foot") <= BAND, F.lit("foot"))))
    band = lines.where(~is_folio(F.col("s"))).select(*PAGE, F.explode(bands).alias("band"), "s")
    forms = F.concat(F.array("s"), F.transform(embedded(F.col("s")), lambda x: x.residue))
    every = band.select(*PAGE, "band", F.explode(forms).alias("line")).distinct()
    return every.groupBy("book_id", "band", "line").count().where(F.col("count") >= LEAST_PAGES).select("book_id", "band", "line")


def judged_lines(pages: DataFrame) -> DataFrame:
    """Lines with, for either band, whether the line is known there (known_head, known_foot) and the number it is accepted to carry (folio_head, folio_foot).

    A number on a shared line is accepted if the line does not itself recur and
    exactly one of its readings leaves a line that does. A book's known lines
    are a short list, joined to its pages once.
    """
    lines = page_lines(pages)
    sets = known_lines(lines).groupBy("book_id").agg(*(F.collect_set(F.when(F.col("band") == b, F.col("line"))).alias(f"set_{b}") for b in ("head", "foot")))
    joined = lines.join(sets, "book_id", "left")
    out = joined.withColumn("bare", is_folio(F.col("s")))
    for b in ("head", "foot"):
        known = lambda x, b=b: F.coalesce(F.array_contains(f"set_{b}", x), F.lit(False))
        near = F.col(b) <= BAND
        accepted = F.filter(embedded(F.col("s")), lambda x: known(x.residue))
        out = out.withColumn(f"known_{b}", known(F.col("s")) & (F.col("s") != ""))
        out = out.withColumn(f"folio_{b}", F.when(near & ~F.col(f"known_{b}") & (F.size(accepted) == 1), F.get(accepted, F.lit(0)).folio))
    return out.drop("set_head", "set_foot")


def strip_paginated(pages: DataFrame) -> DataFrame:
    """pages_clean(book_id, page_pdf, body, page_printed) of pages(book_id, page_pdf, text).

    A number alone on its line goes before one beside a running head, and the
    head before the foot; a page with several lone numbers lists page numbers,
    and there only a running head's number counts. From either end the lines
    that are known go, with the blank ones between, up to the first other line.
    A null or empty text is one blank line: an empty body without a number.
    Rows that repeat a page's key are read as one page.
    """
    lines = judged_lines(pages.withColumn("text", F.coalesce("text", F.lit(""))))
    first = lambda value, order, ok: F.min_by(F.when(ok, value), F.when(ok, order))
    alone = lambda b: first(F.col("s"), F.col("at"), F.col("bare") & (F.col(b) <= BAND))
    shared = lambda b: first(F.col(f"folio_{b}"), F.col("at"), F.col(f"folio_{b}").isNotNull())
    lone = F.when(F.count_if("bare") <= 1, F.coalesce(alone("head"), alone("foot")))
    printed = lines.groupBy(*PAGE).agg(F.coalesce(lone, shared("head"), shared("foot")).alias("page_printed"))

    def goes(b: str, order: Column) -> Column:
        ok = ~F.col("s").rlike(HEADING) & (F.col("bare") | F.col(f"known_{b}") | F.col(f"folio_{b}").isNotNull()) & (F.col(b) <= BAND)
        stops = F.sum(F.when((F.col("s") == "") | ok, 0).otherwise(1)).over(Window.partitionBy(*PAGE).orderBy(order))
        taken = F.sum(F.when((F.col("s") != "") & ok, 1).otherwise(0)).over(Window.partitionBy(*PAGE).orderBy(order))
        return (stops == 0) & ((F.col("s") != "") | (taken < BAND))

    marked = lines.withColumn("top", goes("head", F.col("at"))).withColumn("end", goes("foot", F.desc("at")))
    kept = F.array_sort(F.collect_list(F.when(~F.col("top") & ~F.col("end"), F.struct("at", "line"))))
    body = marked.groupBy(*PAGE).agg(F.regexp_replace(F.array_join(F.transform(kept, lambda x: x.line), "\n"), r"\A\n+|\n+\z", "").alias("body"))
    return body.join(printed, list(PAGE)).select(*PAGE, "body", "page_printed")
