"""Queries over whole tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cleanup, furniture, locators, navigation, structure
from ..operators.ordering import number_rows
from ..session import settled

ODD, LATER = "coalesce(try_cast(substr(source, 4) as int), 1) % 3 = 0", "n >= 30"
FOLIO = f"case when n <= 3 then repeat('i', n) when n % 7 = 0 then '' when n = 23 then '999' when {ODD} and {LATER} then cast(n - 29 as string) when n >= 5 then cast(n - 4 as string) else '' end"


#: Digits of printed numbers where places in a book are asked for: a source of many documents is a book of more than 9,999 pages.
LONG_BOOKS = 9
#: Bytes of texts for which a task of line rules is made.
PART_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, doc_id and n, the document's place in its source; texts are not moved for it."""
    return number_rows(table(spark, sf_dir, "documents").select("source", "doc_id"), ["source"], ["doc_id"])


def with_places(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """source, n, doc_id and text of documents, dealt by doc_id to as many tasks as shuffles have: lines are costly, not large."""
    ids = numbered(spark, sf_dir) if ids is None else ids
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return docs.repartition(max(parts, size // PART_BYTES), "doc_id").join(ids, "doc_id")


def page_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books of pages from documents: a source is a book, its documents in order are pages with a running head and a printed number. Written once, read by all branches of a plan."""
    return settled(pages_of(with_places(spark, sf_dir)))


def pages_of(docs: DataFrame, *more: str) -> DataFrame:
    """The pages of page_stream from documents with_places, and more of their columns."""
    return docs.selectExpr("source as book_id", "n as page_pdf", f"concat(upper(source), ' STUDIES', '\\n', text, '\\n', {FOLIO}) as text", *more)


def paginated_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text a book, its pages behind separators."""
    pages = page_stream(spark, sf_dir).withColumn("part", F.concat(F.lit("{"), F.col("page_pdf"), F.lit("}"), F.repeat(F.lit("-"), F.lit(48)), F.lit("\n"), F.col("text"), F.lit("\n")))
    return pages.groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_pdf", "part"))), lambda x: x.part), "").alias("text"))


def with_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr("doc_id", "concat(text, '\\n![figure ', doc_id, '](./img/a%20', doc_id, '.png)\\n![x](https://example.org/a.png \"t\")') as text")


def asset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("doc_id % 2 = 0").selectExpr("doc_id", "concat('img/a ', doc_id, '.png') as path", "n_chars as bytes")


def _docs(f):
    return lambda spark, sf_dir: f(table(spark, sf_dir, "documents"))


def book_report(spark, sf_dir):
    pages = page_stream(spark, sf_dir)
    return locators.book_report(pages, settled(furniture.strip_furniture(pages, LONG_BOOKS)))


def running_heads(spark, sf_dir):
    r = furniture.recurring(page_stream(spark, sf_dir))
    named = lambda kind: r.select("book_id", F.lit(kind).alias("kind"), F.explode(kind).alias("key"))
    return named("heads").unionByName(named("feet"))


def folio_capture(spark, sf_dir):
    return furniture.strip_furniture(page_stream(spark, sf_dir)).select("book_id", "page_pdf", "page_printed", F.md5("body").alias("body_md5"))


def page_locators(spark, sf_dir):
    return locators.locate(settled(furniture.strip_furniture(page_stream(spark, sf_dir), LONG_BOOKS))).select("book_id", "page_pdf", "page_printed", "captured")


def offset_consensus(spark, sf_dir):
    return locators.consensus(furniture.strip_furniture(page_stream(spark, sf_dir), LONG_BOOKS).where("page_printed is not null"))


def paginated_split(spark, sf_dir):
    return structure.split_pages(paginated_stream(spark, sf_dir)).select("book_id", "page_pdf", F.md5(T.strip(F.col("text"))).alias("text_md5"))


def quality(d):
    score = T.quality_score(F.col("text"))
    return d.select("doc_id", F.round(score, 6).alias("score"), F.when(score < T.LOW_QUALITY, "low quality").otherwise("ok").alias("status"))


def ocr_warnings(d):
    counts = zip(("n_caps", "n_inc", "n_digit"), T.ocr_warning_counts(F.col("text")))
    return d.select("doc_id", *(n.cast("long").alias(c) for c, n in counts)).where("n_caps is not null or n_inc is not null or n_digit is not null")


def signals(d):
    emitted, captions = T.table_signals(F.col("text"))
    return d.select("doc_id", emitted.alias("tables_emitted"), captions.alias("captions_seen"))


def stray(d):
    text, n = T.stray_consonants(F.col("text"))
    return d.select("doc_id", n.alias("n"), F.md5(text).alias("text_md5"))


def page_titles(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1), F.element_at(F.array(F.lit(", 4th Edition"), F.lit(" V3.1"), F.lit(" (Second Edition)"), F.lit(": Revised and Updated")), (F.col("page_id") % 4 + 1).cast("int"))).alias("stem"))
    return p.select("page_id", T.clean_title(F.col("stem")).alias("title"))


def words_x(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("i", "w"))
    values = d.selectExpr("doc_id as key", "cast(72 + (i % 5) * 90 + length(w) % 4 as double) as v")
    return structure.cluster_1d(values, 15.0).select(F.col("key").alias("doc_id"), "cluster", F.round("centre", 6).alias("centre"), "n")


def line_slices(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return structure.slice_lines(d, d.selectExpr("doc_id", "'body' as name", "2 as first", "4 as last")).select("doc_id", "name", F.md5("text").alias("text_md5"))


PICTURE = "concat('\\n\\n\\n\\n**---- Start of picture text ----**<br>\\n', case when doc_id % 2 = 0 then 'Index of Terms' else 'Noise' end, '\\n**---- End of picture text ----**<br>\\nEND')"


def joined_words(spark, sf_dir):
    """Documents with a joined word before and a block of picture text behind."""
    return table(spark, sf_dir, "documents").selectExpr("doc_id", f"concat('the', regexp_extract(text, '[a-z]{{3,}}', 0), ' wWilliam ', text, {PICTURE}) as text")


def dictionary(spark, sf_dir):
    """Words of at least three letters that five documents use."""
    words = cleanup.candidates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return words.groupBy(F.col("token").alias("word")).count().where("count >= 5").select("word")


def join_splits(spark, sf_dir):
    return cleanup.join_splits(cleanup.candidates(joined_words(spark, sf_dir)), dictionary(spark, sf_dir))


def clean_markdown(spark, sf_dir):
    cleaned = cleanup.clean_markdown(joined_words(spark, sf_dir), dictionary(spark, sf_dir))
    return cleaned.select("doc_id", "n_joins", "n_stray", "n_kept", "n_dropped", F.md5("text").alias("text_md5"))


def nav_maps(spark, sf_dir):
    """A navigation map for each source: every third document opens a point that holds the next two."""
    docs = numbered(spark, sf_dir)
    entry = "concat('<navPoint id=\"p\"><navLabel><text>Part &amp; ', doc_id, '</text></navLabel><content src=\"../d', doc_id, '.xhtml#a', doc_id, '\"/>', case n % 3 when 1 then '' when 2 then '</navPoint>' else '</navPoint></navPoint>' end)"
    parts = docs.selectExpr("source as book_id", "n", f"{entry} as part").groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("n", "part"))).alias("parts"))
    return parts.select("book_id", F.lit("OEBPS").alias("base"), F.array_join(F.transform("parts", lambda x: x.part), "").alias("markup"))


def classed(spark, sf_dir):
    """Documents as marked-up pages of a book whose class for chapters depends on the source."""
    markup = "concat('<p class=\"', case when source in ('src1', 'src2') then 'SectHead' else 'chaptitle' end, ' x\">Title <i>', doc_id, '</i></p><p>', replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '</p><p class=\"other\">z</p>')"
    return table(spark, sf_dir, "documents").selectExpr("source as book_id", "doc_id", f"{markup} as markup")


def class_headings(spark, sf_dir):
    d = classed(spark, sf_dir)
    return navigation.class_headings(d, navigation.chapter_class(d)).select("doc_id", "n_injected", F.md5("markup").alias("markup_md5"))


QUERIES = {
    "book_report": book_report,
    "running_heads": running_heads,
    "folio_capture": folio_capture,
    "page_locators": page_locators,
    "offset_consensus": offset_consensus,
    "paginated_split": paginated_split,
    "paginated_recurring": lambda s, d: structure.recurring_lines(page_stream(s, d)),
    "quality_score": _docs(quality),
    "ocr_warnings": _docs(ocr_warnings),
    "table_signals": _docs(signals),
    "stray_consonants": _docs(stray),
    "list_pages": _docs(lambda d: d.select("doc_id", T.looks_like_list(F.col("text")).alias("is_list"))),
    "heading_count": _docs(lambda d: d.select("doc_id", T.heading_count(F.concat(F.lit("# a\n"), F.col("text"), F.lit("\n## b\n```\n# c\n```"))).alias("n_headings"))),
    "paragraphs": _docs(lambda d: d.select("doc_id", F.md5(T.fold_paragraphs(F.col("text"))).alias("text_md5"))),
    "split_caps": _docs(lambda d: structure.merge_split_caps(d.select("doc_id", F.concat(F.lit("NOTES ON\nSLOW RIVERS\nAND TIDES\n"), F.col("text")).alias("text"))).where("was_split").select("doc_id", "line_no", "line")),
    "promote_headings": _docs(lambda d: structure.promote_headings(structure.lines_of(d.select("doc_id", F.concat(F.lit("CHAPTER 1\n"), F.col("text"), F.lit("\n\nA LONG HEADING IN CAPITALS\n")).alias("text")), "doc_id")).where("level > 0")),
    "ligatures": _docs(lambda d: d.select("doc_id", F.md5(T.ligatures(F.regexp_replace("text", "fi", "ﬁ"))).alias("text_md5"))),
    "missing_spaces": _docs(lambda d: d.select("doc_id", T.missing_spaces(F.concat(F.lit("offthe office stuffin selfmade selfish "), F.col("text"))).alias("text"))),
    "clean_title": page_titles,
    "image_refs": lambda s, d: structure.image_refs(with_refs(s, d)),
    "dangling_refs": lambda s, d: structure.dangling_refs(structure.image_refs(with_refs(s, d)), asset_files(s, d)).select("doc_id", "ref_no", "target", "line"),
    "strip_dangling": lambda s, d: structure.strip_dangling(with_refs(s, d), structure.dangling_refs(structure.image_refs(with_refs(s, d)), asset_files(s, d))).select("doc_id", "n_stripped", F.md5("text").alias("text_md5")),
    "asset_manifest": lambda s, d: structure.asset_manifest(structure.image_refs(with_refs(s, d)), asset_files(s, d)).select("doc_id", "path", "bytes", F.size("references").alias("n_references")),
    "html_semantic": lambda s, d: table(s, d, "pages").select("page_id", structure.semantic_headings(F.col("html")).alias("semantic")),
    "nav_links": lambda s, d: structure.links(table(s, d, "pages")).select("page_id", F.col("ord").cast("long").alias("ord"), "label", "href"),
    "cluster_1d": words_x,
    "line_slice": line_slices,
    "join_splits": join_splits,
    "clean_markdown": clean_markdown,
    "ncx_entries": lambda s, d: navigation.ncx_entries(nav_maps(s, d)),
    "chapter_class": lambda s, d: navigation.chapter_class(classed(s, d)),
    "class_headings": class_headings,
}

_DUCK_FOLIO = FOLIO.replace("as string", "as varchar")
_S = r"regexp_replace(regexp_replace({}, '^\s+', ''), '\s+$', '')"
_PAGES = rf"""numbered AS (SELECT source, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
pages AS (SELECT source AS book_id, n AS page_pdf, upper(source) || ' STUDIES' || chr(10) || text || chr(10) || {_DUCK_FOLIO} AS text FROM numbered)"""
_PLAIN = r"regexp_replace(regexp_replace(text, '(?s)<!--.*?-->|[#*_`|]+', ' ', 'g'), '(?m)^-{3,}$', ' ', 'g')"
_IN = lambda words: "(" + ", ".join(f"'{w}'" for w in words) + ")"
_JOINS = rf"""t AS (SELECT doc_id, 'the' || regexp_extract(text, '[a-z]{{3,}}') || ' wWilliam ' || text AS text FROM documents),
dict AS (SELECT w FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+'))) AS w FROM documents) WHERE regexp_full_match(w, '[a-z]{{4,}}') GROUP BY w HAVING count(*) >= 5),
tok AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS token FROM t),
cut AS (SELECT token, unnest(range(1, length(token))) AS cut FROM tok WHERE regexp_full_match(token, '[a-z]{{4,}}') AND token NOT IN (SELECT w FROM dict)),
hv AS (SELECT token, cut, left(token, cut) AS l, substr(token, cut + 1) AS r FROM cut),
fl AS (SELECT *, l IN {_IN(cleanup.FUNCTION_WORDS)} AS lf, r IN {_IN(cleanup.FUNCTION_WORDS)} AS rf FROM hv),
ok AS (SELECT *, least(length(l), length(r)) * 1000000 - cut AS score FROM fl WHERE (lf OR rf) AND r NOT IN {_IN(cleanup.NEVER_TRAILING)} AND (NOT lf OR l IN {_IN(cleanup.LEADING_WORDS)})
 AND (lf OR length(l) >= 3 AND l IN (SELECT w FROM dict)) AND (rf OR length(r) >= 3 AND r IN (SELECT w FROM dict)) AND (r NOT IN ('a', 'an') OR lf OR length(l) >= 4)),
sp AS (SELECT token, arg_max(l, score) AS "left", arg_max(r, score) AS "right" FROM ok GROUP BY token)"""
_MARKUP = """m AS (SELECT source AS book_id, doc_id, CASE WHEN source IN ('src1', 'src2') THEN 'SectHead' ELSE 'chaptitle' END AS c, CASE WHEN source IN ('src1', 'src2') THEN '2' ELSE '1' END AS lv, text FROM documents)"""
_LINES = "l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents)"

_CONSENSUS = f"""{_PAGES},
cap AS (SELECT source AS book_id, n AS page_pdf, nullif({_DUCK_FOLIO}, '') AS p FROM numbered),
ar AS (SELECT book_id, page_pdf, try_cast(p AS INTEGER) - page_pdf AS off FROM cap WHERE try_cast(p AS INTEGER) IS NOT NULL),
byo AS (SELECT book_id, off, count(*) AS n, min(page_pdf) AS f FROM ar GROUP BY book_id, off),
rk AS (SELECT *, sum(n) OVER (PARTITION BY book_id) AS total, row_number() OVER (PARTITION BY book_id ORDER BY n DESC, f) AS r FROM byo),
md AS (SELECT book_id, off, n AS agree, CAST(total AS BIGINT) AS n FROM rk WHERE r = 1),
ds AS (SELECT ar.book_id, ar.page_pdf - lag(ar.page_pdf) OVER (PARTITION BY ar.book_id ORDER BY ar.page_pdf) AS g FROM ar JOIN md ON ar.book_id = md.book_id WHERE ar.off <> md.off),
gp AS (SELECT book_id, min(g) AS gap FROM ds GROUP BY book_id),
rf AS (SELECT md.book_id, md.n, md.off, CASE WHEN md.n < 3 THEN 'only ' || md.n || ' arabic samples' WHEN agree * 1.0 / md.n < 0.85 THEN agree || ' of ' || md.n || ' samples agree, below the consensus bar'
 WHEN agree < md.n AND md.n < 8 THEN agree || ' of ' || md.n || ' samples agree; unanimity is required' WHEN gap <= 2 THEN 'dissenting pages stand together: a renumbering or a page-order defect' END AS refusal FROM md LEFT JOIN gp ON md.book_id = gp.book_id)"""
_LOCATED = _CONSENSUS + """,
o AS (SELECT cap.book_id, cap.page_pdf, p, CASE WHEN refusal IS NULL THEN off END AS off FROM cap LEFT JOIN rf ON cap.book_id = rf.book_id),
m AS (SELECT *, coalesce(off IS NOT NULL AND try_cast(p AS INTEGER) - page_pdf <> off, false) AS misread FROM o),
q AS (SELECT *, CASE WHEN NOT misread THEN p END AS rd FROM m),
sp AS (SELECT book_id, min(CASE WHEN try_cast(rd AS INTEGER) IS NOT NULL THEN page_pdf END) AS lo, max(CASE WHEN try_cast(rd AS INTEGER) IS NOT NULL THEN page_pdf END) AS hi FROM q GROUP BY book_id),
loc AS (SELECT q.book_id, q.page_pdf, coalesce(rd, CASE WHEN off IS NOT NULL AND page_pdf BETWEEN lo AND hi AND page_pdf + off >= 1 THEN CAST(page_pdf + off AS VARCHAR) END) AS page_printed, rd IS NOT NULL AS captured, misread, off FROM q JOIN sp ON q.book_id = sp.book_id)"""

ORACLES = {
    "offset_consensus": f"WITH {_CONSENSUS} SELECT book_id, n, CASE WHEN refusal IS NULL THEN off END AS page_offset, refusal IS NULL AS consistent, refusal FROM rf",
    "page_locators": f"WITH {_LOCATED} SELECT book_id, page_pdf, page_printed, captured FROM loc",
    "book_report": f"""WITH {_LOCATED},
c AS (SELECT book_id, count(*) AS total_pages, count(*) AS pages_with_text, count(*) AS page_locator_count, count(*) FILTER (WHERE captured) AS page_printed_count, count(*) FILTER (WHERE misread) AS n_misread FROM loc GROUP BY book_id)
SELECT c.book_id, total_pages, pages_with_text, page_locator_count, page_printed_count, CASE WHEN page_printed_count > 0 THEN 'printed' ELSE 'pdf_only' END AS page_numbering,
round(page_printed_count::DOUBLE / page_locator_count, 6) AS page_printed_coverage, CASE WHEN refusal IS NULL THEN off END AS page_printed_offset, coalesce(refusal IS NULL AND off IS NOT NULL, false) AS page_printed_offset_consistent, n_misread, refusal
FROM c LEFT JOIN rf ON c.book_id = rf.book_id""",
    "quality_score": rf"""WITH p AS (SELECT doc_id, {_PLAIN} AS b FROM documents),
s AS (SELECT doc_id, CASE WHEN length(b) < 500 THEN 1.0 ELSE greatest(0.0, 1 - (len(regexp_extract_all(b, '(?i)[a-z][0-9][a-z]')) + len(regexp_extract_all(b, '(?i)[a-z]vv[a-z]'))) * 10000.0::DOUBLE / length(b) / 2) END AS s FROM p)
SELECT doc_id, round(s::DOUBLE, 6) AS score, CASE WHEN s < 0.5 THEN 'low quality' ELSE 'ok' END AS status FROM s""",
    "ocr_warnings": rf"""WITH p AS (SELECT doc_id, {_PLAIN} AS b FROM documents),
c AS (SELECT doc_id, length(b) AS n, len(list_filter(regexp_extract_all(b, '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '[B-DF-HJ-NP-TV-Z]{{4,}}'))) AS a, len(regexp_extract_all(b, '(?i)[a-z][0-9][a-z]')) AS d, len(regexp_extract_all(b, '\bIne\.\b')) AS i FROM p),
w AS (SELECT doc_id, CASE WHEN n >= 500 AND i * 10000.0 / n >= 2 THEN i END AS n_inc, CASE WHEN n >= 500 AND a * 10000.0 / n >= 2 THEN a END AS n_caps, CASE WHEN n >= 500 AND d * 10000.0 / n >= 2 THEN d END AS n_digit FROM c)
SELECT * FROM w WHERE n_caps IS NOT NULL OR n_inc IS NOT NULL OR n_digit IS NOT NULL""",
    "table_signals": r"""SELECT doc_id, len(regexp_extract_all(text, '(?m)^\s*\|(\s*:?-+:?\s*\|)+\s*$')) + len(regexp_extract_all(text, '(?i)<table')) AS tables_emitted,
len(regexp_extract_all(text, '(?m)^\s*\**\s*(TABLE|Table|TAB\.|Tab\.|EXHIBIT|Exhibit)\s+[A-Z]?-?[0-9]+([-.][0-9]+)?')) AS captions_seen FROM documents""",
    "stray_consonants": r"""SELECT doc_id, len(regexp_extract_all(text, '\b[b-df-hj-np-tv-z][A-Z][a-z]{2,}\b')) AS n, md5(regexp_replace(text, '\b[b-df-hj-np-tv-z]([A-Z][a-z]{2,})\b', '\1', 'g')) AS text_md5 FROM documents""",
    "paginated_split": f"WITH {_PAGES} SELECT book_id, page_pdf, md5({_S.format('text')}) AS text_md5 FROM pages",
    "running_heads": rf"""WITH {_PAGES},
l AS (SELECT book_id, page_pdf, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM pages),
s AS (SELECT book_id, page_pdf, i, {_S.format('line')} AS s FROM l),
f AS (SELECT *, row_number() OVER (PARTITION BY book_id, page_pdf ORDER BY i) AS a, row_number() OVER (PARTITION BY book_id, page_pdf ORDER BY i DESC) AS z FROM s WHERE s <> ''),
e AS (SELECT book_id, 'heads' AS kind, s FROM f WHERE a <= 3 UNION ALL SELECT book_id, 'feet', s FROM f WHERE z <= 3),
k AS (SELECT book_id, kind, {_S.format(r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '^[0-9]+\s*', ''), '\s*[0-9]+$', ''), '\s*\|\s*[0-9A-Za-z_]*$', ''), '^[0-9A-Za-z_]+\s*\|\s*', '')")} AS key FROM e),
c AS (SELECT book_id, kind, key, count(*) AS n FROM k WHERE length(key) > 3 GROUP BY ALL),
b AS (SELECT book_id, count(*) AS m FROM pages GROUP BY book_id)
SELECT c.book_id, c.kind, c.key FROM c JOIN b ON c.book_id = b.book_id WHERE n >= greatest(3, 0.15 * m)""",
    "html_semantic": r"SELECT page_id, regexp_matches(html, '(?i)<h[1-6][\s/>]') AS semantic FROM pages",
    "nav_links": r"""WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\s[^>]*href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\s[^>]*href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 2) AS t FROM pages),
u AS (SELECT page_id, unnest(h) AS href, unnest(t) AS t, unnest(range(len(h))) AS ord FROM a)
SELECT page_id, ord, """ + _S.format(r"regexp_replace(regexp_replace(t, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')") + " AS label, href FROM u",
    "cluster_1d": """WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS i FROM documents),
v AS (SELECT doc_id, CAST(72 + (i % 5) * 90 + length(w) % 4 AS DOUBLE) AS v FROM w),
b AS (SELECT doc_id, v, CASE WHEN v - lag(v) OVER (PARTITION BY doc_id ORDER BY v) < 15 THEN 0 ELSE 1 END AS b FROM v),
c AS (SELECT doc_id, v, sum(b) OVER (PARTITION BY doc_id ORDER BY v) AS cluster FROM b)
SELECT doc_id, CAST(cluster AS BIGINT) AS cluster, round(avg(v), 6) AS centre, count(*) AS n FROM c GROUP BY doc_id, cluster""",
    "join_splits": f"WITH {_JOINS} SELECT * FROM sp",
    "clean_markdown": rf"""WITH {_JOINS},
pc AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+')) AS p, generate_subscripts(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+'), 1) AS i FROM t),
jn AS (SELECT doc_id, string_agg(CASE WHEN token IS NULL THEN p ELSE "left" || ' ' || "right" END, '' ORDER BY i) AS text, CAST(count(DISTINCT token) AS INTEGER) AS n_joins FROM pc LEFT JOIN sp ON p = token GROUP BY doc_id),
st AS (SELECT doc_id, n_joins, CAST(len(regexp_extract_all(text, '\b[b-df-hj-np-tv-z][A-Z][a-z]{{2,}}\b')) AS INTEGER) AS n_stray, regexp_replace(text, '\b[b-df-hj-np-tv-z]([A-Z][a-z]{{2,}})\b', '\1', 'g') AS text FROM jn)
SELECT doc_id, n_joins, n_stray, CAST(1 - doc_id % 2 AS INTEGER) AS n_kept, CAST(doc_id % 2 AS INTEGER) AS n_dropped,
md5(regexp_replace(text || chr(10) || chr(10) || chr(10) || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'Index of Terms' ELSE '' END || chr(10) || 'END', '\n{{3,}}', chr(10) || chr(10), 'g')) AS text_md5 FROM st""",
    "ncx_entries": """WITH n AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents)
SELECT source AS book_id, CAST(n - 1 AS INTEGER) AS ord, CASE WHEN n % 3 = 1 THEN 1 ELSE 2 END AS depth, 'Part & ' || doc_id AS label, 'd' || doc_id || '.xhtml' AS doc, 'a' || doc_id AS anchor FROM n""",
    "chapter_class": f"WITH {_MARKUP} SELECT book_id, lower(c) AS token, count(*) AS n FROM m GROUP BY book_id, c",
    "class_headings": f"""WITH {_MARKUP} SELECT doc_id, 1 AS n_injected, md5('<h' || lv || '>Title ' || doc_id || '</h' || lv || '><p>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p><p class="other">z</p>') AS markup_md5 FROM m""",
    "line_slice": f"WITH {_LINES} SELECT doc_id, 'body' AS name, md5(string_agg(line, chr(10) ORDER BY line_no)) AS text_md5 FROM l WHERE line_no BETWEEN 1 AND 3 GROUP BY doc_id",
}
