"""Tables of contents of e-books and headings made from paragraph classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .cleanup import rebuild

# Fixed values.
NAV_TOKEN = r"(?is)<navPoint\b[^>]*>|</navPoint>|<navLabel\b.*?</navLabel>|<content\b[^>]*>"
PARAGRAPH = r"(?is)<p\b([^>]*)>(.*?)</p>"
CLASS_TOKENS = ("chaphead", "chapterhead", "chaptitle", "chapter-title", "chap-title", "ct", "cn", "h1", "head1", "title1", "parttitle", "part-title")
CLASS_STEM, CLASS_HEAD = "chap|part|sect|division|book", "head|title|hd|ttl"
LONGEST_LABEL = 120
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def label(markup: Column) -> Column:
    """Text of markup: tags cut, the common entities read, white space folded."""
    out = F.regexp_replace(markup, "<[^>]*>", " ")
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return T.strip(F.regexp_replace(out, r"(?U)\s+", " "))


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value, null where there is none."""
    found = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*')", 1)
    return F.when(found != "", F.substring(found, F.lit(2), F.length(found) - 2))


def resolve(base: Column, href: Column) -> tuple[Column, Column]:
    """The archive entry that href names from the folder base (empty where it names none), and its anchor."""
    decoded = F.coalesce(F.try_url_decode(F.replace(T.strip(href), F.lit("+"), F.lit("%2B"))), T.strip(href))
    path = F.regexp_extract(decoded, "(?s)^([^#]*)", 1)
    anchor = F.regexp_extract(decoded, "(?s)#(.+)$", 1)
    whole = F.when(path.startswith("/") | (base == ""), path).otherwise(F.concat(base, F.lit("/"), path))
    folded = normal_path(whole, path.startswith("/") | base.startswith("/"))
    return F.when(path == "", "").when(folded == "", ".").otherwise(folded), F.when(anchor != "", anchor)


def normal_path(path: Column, absolute: Column) -> Column:
    """A path without empty parts, "." and, where they can be taken back, "..", and without a slash before it."""
    none = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        up = F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)) != ".."), F.slice(done, F.lit(1), F.size(done) - 1)).when(absolute, done)
        return F.when(part.isin("", "."), done).when(part == "..", F.coalesce(up, F.concat(done, F.array(part)))).otherwise(F.concat(done, F.array(part)))

    return F.array_join(F.reduce(F.split(path, "/"), none, lambda done, part: F.when(F.size(done) == 0, step(none, part)).otherwise(step(done, part))), "/")


def ncx_entries(books: DataFrame, key: str = "book_id") -> DataFrame:
    """nav(key, ord, depth, label, doc, anchor) from books(key, base, markup): the entries of a navigation map in order.

    The depth is a running sum of opened and closed points that never falls
    below 0: the sum less its lowest value so far. A target counts with the
    label straight before it, and without one not at all; so do targets of an
    empty name. Null markup has no entries.
    """
    tokens = books.select(key, F.coalesce("base", F.lit("")).alias("base"), F.posexplode(F.regexp_extract_all("markup", F.lit(NAV_TOKEN), 0)).alias("at", "token"))
    low = F.lower(F.substring("token", 1, 10))
    opens, closes = low.startswith("<navpoint"), low.startswith("</navpoi")
    change = F.when(opens & ~F.col("token").endswith("/>"), 1).when(closes, -1).otherwise(0)
    w = Window.partitionBy(key).orderBy("at")
    walked = tokens.withColumn("sum", F.sum(change).over(w)).withColumn("before", F.lag("token").over(w))
    depth = F.col("sum") - F.least(F.lit(0), F.min("sum").over(w))
    titled = walked.withColumn("depth", F.greatest(F.lit(1), depth)).where(low.startswith("<content") & F.lower("before").startswith("<navlabel"))
    doc, anchor = resolve(F.col("base"), attribute(F.col("token"), "src"))
    found = titled.select(key, "at", F.col("depth").cast("int").alias("depth"), label(F.col("before")).alias("label"), doc.alias("doc"), anchor.alias("anchor")).where("label <> '' and doc <> ''")
    return found.withColumn("ord", F.row_number().over(w) - 1).select(key, "ord", "depth", "label", "doc", "anchor")


def class_tokens(attributes: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(attribute(F.concat(F.lit("<p"), attributes), "class"), F.lit(""))), r"\s+"), lambda t: t != "")


def is_label(inner: Column) -> Column:
    return F.length(label(inner)).between(1, LONGEST_LABEL)


def chapter_class(docs: DataFrame, key: str = "book_id") -> DataFrame:
    """picks(key, token, n): of each book's docs(key, markup) the paragraph class for chapters used most; ties take the first by name."""
    both = F.arrays_zip(F.regexp_extract_all("markup", F.lit(PARAGRAPH), 1).alias("attributes"), F.regexp_extract_all("markup", F.lit(PARAGRAPH), 2).alias("inner"))
    short = docs.select(key, F.explode(both).alias("p")).where(is_label(F.col("p.inner")))
    named = short.select(key, F.explode(class_tokens(F.col("p.attributes"))).alias("token"))
    token = F.col("token")
    counts = named.where(token.isin(*CLASS_TOKENS) | (token.rlike(CLASS_STEM) & token.rlike(CLASS_HEAD))).groupBy(key, "token").agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.min_by(F.struct("token", "n"), F.struct(-F.col("n"), "token")).alias("b")).select(key, "b.token", "b.n")


def class_headings(docs: DataFrame, picks: DataFrame, key: str = "book_id") -> DataFrame:
    """docs with short paragraphs of the picked class made headings, and n_injected; books without a pick stay as they are."""
    joined = docs.join(picks.select(key, F.col("token").alias("__token")), key, "left")
    level = F.when(F.col("__token").rlike("sub|sect"), "2").otherwise("1")
    part = lambda m, i: F.regexp_extract(m, PARAGRAPH, i)
    chosen = lambda m: F.array_contains(class_tokens(part(m, 1)), F.col("__token")) & is_label(part(m, 2))
    escaped = lambda m: F.replace(F.replace(F.replace(label(part(m, 2)), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    heading = lambda m: F.when(chosen(m), F.concat(F.lit("<h"), level, F.lit(">"), escaped(m), F.lit("</h"), level, F.lit(">"))).otherwise(m)
    n = F.size(F.filter(F.regexp_extract_all("markup", F.lit(PARAGRAPH), 0), chosen))
    has = F.col("__token").isNotNull() & F.col("markup").isNotNull()
    return joined.select(*(c for c in docs.columns if c != "markup"), F.when(has, rebuild(F.col("markup"), PARAGRAPH, heading)).otherwise(F.col("markup")).alias("markup"), F.when(has, n).otherwise(0).alias("n_injected"))
