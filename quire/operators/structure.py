"""Headings, lists of figures and files, paginated text, e-book markup and one-dimensional layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import is_local, link_target, strip
from .navigation import normal_path

PAGE = r"^\{(\d+)\}-{2,}\s*$"
CAPS_RUN, CAPS_LINE, CAPS_SUM = r"^[A-Z][A-Z\s:&,\-']{0,40}$", 40, 80
IMAGE = r"!\[([^\]]*)\]\(([^()]*)\)"


def lines_of(texts: DataFrame, key: str) -> DataFrame:
    return texts.select(key, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def split_pages(paginated: DataFrame) -> DataFrame:
    """pages(book_id, page_pdf, text) of paginated text; what stands before the first separator is left out, text without one gives no page."""
    lines = lines_of(paginated, "book_id").select("book_id", F.lit(0).alias("block"), F.col("line_no").cast("long").alias("at"), "line")
    return split_lines(lines)


def lines_of_files(spark: SparkSession, folder: str, book: Column) -> DataFrame:
    """lines(book_id, block, at, line) of text files, for split_lines(): files are cut by Spark where it likes, a block is a stretch of one file.

    book is an expression of path. A book of several files has them in the
    order of their paths. Lines end with line feeds.
    """
    read = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(folder)
    place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    lines = read.select(place.alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))  # a task reads a stretch in order
    return lines.select(F.col("block.path").alias("path"), "block", "at", "line").withColumn("book_id", book).select("book_id", "block", "at", "line")


def split_lines(lines: DataFrame) -> DataFrame:
    """pages(book_id, ord, page_pdf, text) of lines(book_id, block, at, line): books cut into blocks, lines of a block in the order of at.

    Two passes: each block counts its separators, and these counts, a row a
    block, are summed along the book. A block's first lines go to the page that
    an earlier block has left open. No task holds a book, and only a block and a
    page are ever sorted together.
    """
    marked = lines.withColumn("is_page", F.col("line").rlike(PAGE))
    counts = marked.groupBy("book_id", "block").agg(F.count_if("is_page").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("book_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("book_id").alias("b"), F.col("block").alias("k"), before.alias("before"))
    here = F.sum(F.col("is_page").cast("long")).over(Window.partitionBy("book_id", "block").orderBy("at"))
    placed = marked.withColumn("here", here).join(starts, F.col("book_id").eqNullSafe(F.col("b")) & (F.col("block") == F.col("k"))).withColumn("ord", F.col("before") + F.col("here"))
    parts = F.array_sort(F.collect_list(F.when(~F.col("is_page"), F.struct("block", "at", "line"))))
    page = placed.where("ord > 0").groupBy("book_id", "ord")
    return page.agg(F.max(F.when(F.col("is_page"), F.regexp_extract("line", PAGE, 1).cast("int"))).alias("page_pdf"), F.array_join(F.transform(parts, lambda x: x.line), "\n").alias("text")).select("book_id", "ord", "page_pdf", "text")


def band_lines(pages: DataFrame, depth: int = 3) -> DataFrame:
    """The first and last depth lines of each page that are not blank."""
    lines = lines_of(pages.withColumn("key", F.struct("book_id", "page_pdf")), "key").select("key.*", "line_no", strip(F.col("line")).alias("line")).where("line <> ''")
    up = Window.partitionBy("book_id", "page_pdf").orderBy("line_no")
    down = Window.partitionBy("book_id", "page_pdf").orderBy(F.desc("line_no"))
    ranked = lines.withColumn("a", F.row_number().over(up)).withColumn("z", F.row_number().over(down))
    sides = F.array(F.when(F.col("a") <= depth, F.lit("head")), F.when(F.col("z") <= depth, F.lit("foot")))
    return ranked.withColumn("band", F.explode(F.array_compact(sides))).select("book_id", "page_pdf", "band", "line_no", "line")


def recurring_lines(pages: DataFrame, least: int = 3) -> DataFrame:
    """Band lines, and what is left of them beside a number, on at least so many pages; bare numbers are none."""
    band = band_lines(pages).where(~F.col("line").rlike("^[0-9]{1,4}$"))
    forms = F.array(F.col("line"), F.regexp_extract("line", r"^[0-9]{1,4}\s+(\S.*)$", 1), F.regexp_extract("line", r"^(.*\S)\s+[0-9]{1,4}$", 1))
    every = band.select("book_id", "page_pdf", "band", F.explode(F.array_distinct(forms)).alias("line")).where(F.col("line").rlike("[A-Za-z]"))
    return every.groupBy("book_id", "band", "line").agg(F.count_distinct("page_pdf").alias("n_pages")).where(F.col("n_pages") >= least)


def merge_split_caps(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Runs of short capital lines: the longest fitting suffix of each run becomes one line."""
    w = Window.partitionBy(key).orderBy("line_no")
    lines = lines_of(texts, key).withColumn("s", strip(F.col("line"))).withColumn("caps", F.col("s").rlike(CAPS_RUN) & (F.length("s") <= CAPS_LINE))
    lines = lines.withColumn("island", F.sum(F.when(F.col("caps") & F.coalesce(F.lag("caps").over(w), F.lit(False)), 0).otherwise(1)).over(w))
    back = Window.partitionBy(key, "island").orderBy(F.desc("line_no"))
    lines = lines.withColumn("room", F.sum(F.length("s") + 1).over(back)).withColumn("joins", F.col("caps") & (F.col("room") <= CAPS_SUM))
    group = F.when(F.col("joins"), F.concat(F.lit("j"), F.col("island"))).otherwise(F.concat(F.lit("l"), F.col("line_no")))
    merged = lines.withColumn("g", group).groupBy(key, "g").agg(F.min("line_no").alias("line_no"), F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "s"))), lambda x: x.s), " ").alias("merged"), F.first("line").alias("line"))
    return merged.select(key, "line_no", F.when(F.col("n") > 1, F.col("merged")).otherwise(F.col("line")).alias("line"), (F.col("n") > 1).alias("was_split"))


def promote_headings(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Chapter lines and lone lines in capitals of lines(key, line_no, line) become headings."""
    w = Window.partitionBy(key).orderBy("line_no")
    s = strip(F.col("line"))
    marker = lambda x: (x == "") | x.startswith("<!-- Page") | x.startswith("#")
    before, after = (F.coalesce(marker(strip(f("line").over(w))), F.lit(True)) for f in (F.lag, F.lead))
    letters = F.length(F.regexp_replace(s, "[^A-Za-z]", "")) / F.when(F.length(s) > 0, F.length(s))
    chapter = s.rlike(r"(?i)^(Chapter|Part)\s+([0-9]+|[IVXLC]+)") & (F.size(F.split(s, r"\s+")) <= 10)
    caps = s.rlike(r"^[A-Z][A-Z\s0-9:,\-&]{4,79}$") & (F.length(s) < 80) & (letters > 0.6) & (before | after)
    level = F.when(marker(s), 0).when(chapter, 2).when(caps, F.when(F.length(s) < 20, 3).otherwise(2)).otherwise(0)
    return lines.select(key, "line_no", level.alias("level"), F.when(level > 0, F.concat(F.repeat(F.lit("#"), level), F.lit(" "), s)).otherwise(F.col("line")).alias("line"))


def image_refs(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """refs(key, ref_no, alt, target, line): image references in reading order, lines counted from 1."""
    lines = lines_of(texts, key)
    pairs = F.arrays_zip(F.regexp_extract_all("line", F.lit(IMAGE), 1).alias("alt"), F.regexp_extract_all("line", F.lit(IMAGE), 2).alias("inner"))
    refs = lines.where(F.col("line").contains("![")).select(key, "line_no", F.posexplode(pairs).alias("at", "p"))
    w = Window.partitionBy(key).orderBy("line_no", "at")
    return refs.select(key, (F.row_number().over(w) - 1).alias("ref_no"), F.col("p.alt").alias("alt"), link_target(F.col("p.inner")).alias("target"), (F.col("line_no") + 1).alias("line"))


def target_path(target: Column) -> Column:
    """The file that a local target names from its text's folder: percent signs read, "." and ".." taken out."""
    decoded = F.coalesce(F.try_url_decode(F.replace(target, F.lit("+"), F.lit("%2B"))), target)
    return normal_path(decoded, decoded.startswith("/"))


def resolved_refs(refs: DataFrame) -> DataFrame:
    """refs with path, the file that each local target names; null for others."""
    return refs.withColumn("path", F.when(is_local(F.col("target")), target_path(F.col("target"))))


def dangling_refs(refs: DataFrame, files: DataFrame, key: str = "doc_id") -> DataFrame:
    """Local references to no file of files(key, path)."""
    known = files.select(key, normal_path(F.col("path"), F.col("path").startswith("/")).alias("path"))
    return resolved_refs(refs).where("path is not null").join(known, [key, "path"], "left_anti").select(*refs.columns)


def strip_dangling(texts: DataFrame, dangling: DataFrame, key: str = "doc_id") -> DataFrame:
    """texts with dangling references replaced by a comment that names the target, and how many."""
    gone = dangling.groupBy(key).agg(F.collect_set("target").alias("targets"), F.count("*").alias("n_stripped"))
    joined = texts.join(gone, key, "left")
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(IMAGE), 0))
    mine = F.filter(found, lambda m: F.array_contains("targets", link_target(F.regexp_extract(m, IMAGE, 2))))
    text = F.aggregate(mine, F.col("text"), lambda t, m: F.replace(t, m, F.concat(F.lit("<!-- missing image: "), link_target(F.regexp_extract(m, IMAGE, 2)), F.lit(" -->"))))
    return joined.select(key, F.when(F.col("targets").isNull(), F.col("text")).otherwise(text).alias("text"), F.coalesce("n_stripped", F.lit(0)).alias("n_stripped"))


def asset_manifest(refs: DataFrame, files: DataFrame, key: str = "doc_id") -> DataFrame:
    """manifest(key, path, bytes, references): every file, with the references to it in order; files without any too."""
    none = F.array().cast("array<struct<line:int,target:string,alt:string>>")
    by_path = resolved_refs(refs).where("path is not null").groupBy(key, F.col("path").alias("at")).agg(F.array_sort(F.collect_list(F.struct("line", "target", "alt"))).alias("references"))
    named = files.withColumn("at", normal_path(F.col("path"), F.col("path").startswith("/")))
    return named.join(by_path, [key, "at"], "left").select(key, "path", "bytes", F.coalesce("references", none).alias("references"))


def finalize_assets(texts: DataFrame, files: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """texts without dangling references, the manifest of files with lines as they then are, and (key, n_refs, n_stripped, n_dangling, warning) of each text.

    After this no text refers to a missing file: n_dangling is counted on the
    result and is 0.
    """
    refs = image_refs(texts, key)
    done = strip_dangling(texts, dangling_refs(refs, files, key), key)
    left = image_refs(done, key)
    still = dangling_refs(left, files, key).groupBy(key).agg(F.count("*").alias("n_dangling"))
    counts = refs.groupBy(key).agg(F.count("*").alias("n_refs"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    report = done.select(key, "n_stripped").join(counts, key, "left").join(still, key, "left")
    warning = F.when(F.col("n_stripped") > 0, F.concat(F.col("n_stripped").cast("string"), F.lit(" reference(s) to missing images were taken out")))
    return done.select(key, "text"), asset_manifest(left, files, key), report.select(key, zero("n_refs"), zero("n_stripped"), zero("n_dangling"), warning.alias("warning"))


def semantic_headings(markup):
    return markup.rlike(r"(?i)<h[1-6][\s/>]")


def links(docs: DataFrame, key: str = "page_id") -> DataFrame:
    """nav(key, ord, label, href): anchors in order, tags cut from labels."""
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(r"(?is)<a\s[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"), 1).alias("href"), F.regexp_extract_all("html", F.lit(r"(?is)<a\s[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"), 2).alias("label"))
    label = lambda x: strip(F.regexp_replace(F.regexp_replace(x, "<[^>]*>", " "), r"\s+", " "))
    return docs.select(key, F.posexplode(pairs).alias("ord", "p")).select(key, "ord", label(F.col("p.label")).alias("label"), F.col("p.href").alias("href"))


def cluster_1d(values: DataFrame, tol: float, key: str = "key", value: str = "v") -> DataFrame:
    """Clusters of sorted values: a gap under tol to the previous value joins; the centre is the mean."""
    w = Window.partitionBy(key).orderBy(value)
    breaks = F.when(F.col(value) - F.lag(value).over(w) < tol, 0).otherwise(1)
    numbered = values.withColumn("breaks", breaks).withColumn("cluster", F.sum("breaks").over(w))
    return numbered.groupBy(key, "cluster").agg(F.avg(value).alias("centre"), F.count("*").alias("n"))


def slice_lines(texts: DataFrame, slices: DataFrame, key: str = "doc_id") -> DataFrame:
    """Runs of lines named by slices(key, name, first, last), lines counted from 1, joined again."""
    lines = lines_of(texts, key).withColumn("line_no", F.col("line_no") + 1)
    hit = lines.join(slices, key).where(F.col("line_no").between(F.col("first"), F.col("last")))
    return hit.groupBy(key, "name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x.line), "\n").alias("text"))
