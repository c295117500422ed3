"""Page addresses: printed numbers, their offset to the page's index, and careful interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .furniture import beside

LEAST_SAMPLES, AGREEMENT, DISSENT_SAMPLES, RUN_GAP = 3, 0.85, 8, 2


def consensus(samples: DataFrame) -> DataFrame:
    """Per book of samples(book_id, page_pdf, page_printed): n, page_offset, consistent, refusal.

    The offset that most arabic samples share is adopted if enough agree, few
    samples agree as one, and no two dissenters stand close together.
    """
    arabic = samples.where(F.col("page_printed").rlike("^[0-9]+$")).select("book_id", "page_pdf", (F.col("page_printed").cast("int") - F.col("page_pdf")).alias("off"))
    by_offset = arabic.groupBy("book_id", "off").agg(F.count("*").alias("n"), F.min("page_pdf").alias("first"))
    mode = by_offset.groupBy("book_id").agg(F.sum("n").alias("n"), F.max_by("off", F.struct("n", -F.col("first"))).alias("off"), F.max("n").alias("agree"))
    dissent = arabic.join(mode.select("book_id", F.col("off").alias("adopted")), "book_id").where(F.col("off") != F.col("adopted"))
    gap = F.col("page_pdf") - F.lag("page_pdf").over(Window.partitionBy("book_id").orderBy("page_pdf"))
    runs = dissent.select("book_id", gap.alias("gap")).groupBy("book_id").agg(F.min("gap").alias("gap"))
    refusal = (
        F.when(F.col("n") < LEAST_SAMPLES, F.format_string("only %d arabic samples", "n"))
        .when(F.col("agree") / F.col("n") < AGREEMENT, F.format_string("%d of %d samples agree, below the consensus bar", "agree", "n"))
        .when((F.col("agree") < F.col("n")) & (F.col("n") < DISSENT_SAMPLES), F.format_string("%d of %d samples agree; unanimity is required", "agree", "n"))
        .when(F.col("gap") <= RUN_GAP, F.lit("dissenting pages stand together: a renumbering or a page-order defect"))
    )
    out = mode.join(runs, "book_id", "left").withColumn("refusal", refusal)
    return out.select("book_id", "n", F.when(F.col("refusal").isNull(), F.col("off")).alias("page_offset"), F.col("refusal").isNull().alias("consistent"), "refusal")


def locate(pages_clean: DataFrame) -> DataFrame:
    """pages_clean that are not blank with page_printed after outliers are dropped and gaps inside the sampled span filled; captured marks read numbers."""
    agreed = consensus(pages_clean.where("page_printed is not null")).select("book_id", "page_offset", "consistent")
    p = beside(pages_clean.withColumn("shows", F.col("body").rlike(r"\S")), agreed, "left")  # bodies that are not asked for are not moved
    arabic = F.col("page_printed").rlike("^[0-9]+$")
    off = F.when(arabic, F.col("page_printed").cast("int") - F.col("page_pdf"))
    misread = F.coalesce(arabic & F.col("consistent") & (off != F.col("page_offset")), F.lit(False))
    p = p.withColumn("misread", misread).withColumn("read", F.when(~F.col("misread"), F.col("page_printed")))
    sampled = F.when(F.col("read").rlike("^[0-9]+$"), F.col("page_pdf"))
    span = p.groupBy("book_id").agg(F.min(sampled).alias("lo"), F.max(sampled).alias("hi"))
    p = beside(p, span)
    value = F.col("page_pdf") + F.col("page_offset")
    filled = F.when(F.coalesce(F.col("consistent"), F.lit(False)) & F.col("page_pdf").between(F.col("lo"), F.col("hi")) & (value >= 1), value.cast("string"))
    return p.where("shows").select("book_id", "page_pdf", F.coalesce("read", filled).alias("page_printed"), F.col("read").isNotNull().alias("captured"), "misread", "body")


def book_report(pages: DataFrame, pages_clean: DataFrame) -> DataFrame:
    """One row a book: page counts, numbering, coverage and offset."""
    per_book = pages.groupBy("book_id").agg(F.count("*").alias("total_pages"), F.count_if(F.col("text").rlike(r"\S")).alias("pages_with_text"))
    emitted = locate(pages_clean).groupBy("book_id").agg(F.count("*").alias("page_locator_count"), F.count_if("captured").alias("page_printed_count"), F.count_if("misread").alias("n_misread"))
    agreed = consensus(pages_clean.where("page_printed is not null")).select("book_id", F.col("page_offset").alias("page_printed_offset"), F.col("consistent").alias("page_printed_offset_consistent"), "refusal")
    r = per_book.join(emitted, "book_id", "left").join(agreed, "book_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return r.select(
        "book_id", "total_pages", "pages_with_text", zero("page_locator_count").alias("page_locator_count"), zero("page_printed_count").alias("page_printed_count"),
        F.when(zero("page_printed_count") > 0, "printed").otherwise("pdf_only").alias("page_numbering"),
        F.coalesce(F.round(F.col("page_printed_count") / F.when(F.col("page_locator_count") > 0, F.col("page_locator_count")), 6), F.lit(0.0)).alias("page_printed_coverage"),
        "page_printed_offset", F.coalesce("page_printed_offset_consistent", F.lit(False)).alias("page_printed_offset_consistent"), zero("n_misread").alias("n_misread"), "refusal",
    )
