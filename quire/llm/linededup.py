"""Cross-site boilerplate: lines that stand on many sites are removed.

A line's spread is the number of distinct sites (the column source) that hold
it. HyperLogLog sketches per line hash are built map-side and merged by the
aggregation, so a line that stands in a third of all documents moves one small
sketch a task. Lines whose estimate is clear of the threshold by six standard
errors are decided by it; those nearer get an exact distinct count. All of it
is DataFrame operations.

Lines are compared without white space at their ends. Blank lines and lines
of fewer than min_chars characters are never removed. Documents of a null
source are cleaned too but count for no site. Null text stays null with 0
lines; an empty text has one empty line. Rows with equal doc_id are judged
each by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, free_names, small_side

LG_K = 12
#: Six relative standard errors of a sketch of 2**LG_K registers.
MARGIN = 6 * 1.04 / 2 ** (LG_K / 2)
MIN_SITES, MIN_CHARS = 10, 1


def _stripped(line):
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def spread_lines(docs: DataFrame, scratch: Scratch, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Hashes (h, n: its length) of the lines that stand on at least min_sites sites."""
    lines = docs.select("source", F.explode(F.split("text", "\n")).alias("line")).select("source", _stripped("line").alias("line"))
    lines = lines.where(F.length("line") >= min_chars).select("source", F.xxhash64("line").alias("h"), F.length("line").alias("n"))
    spread = scratch.keep("spread", lines.groupBy("h", "n").agg(F.hll_sketch_estimate(F.hll_sketch_agg("source", LG_K)).alias("sites")).where(F.col("sites") >= min_sites * (1 - MARGIN)))
    near = spread.where(F.col("sites") <= min_sites * (1 + MARGIN)).select("h", "n")
    exact = lines.join(small_side(near), ["h", "n"], "left_semi").groupBy("h", "n").agg(F.count_distinct("source").alias("sites")).where(F.col("sites") >= min_sites)
    return scratch.keep("boilerplate", spread.where(F.col("sites") > min_sites * (1 + MARGIN)).select("h", "n").unionByName(exact.select("h", "n")))


def drop_spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with the boilerplate lines cut from text, and n_lines and n_removed; other columns are kept, whatever their names.

    Columns n_lines and n_removed of docs are replaced. Only the places of
    removed lines are joined to the documents, by doc_id and the text's hash.
    An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "linededup")
    gone = small_side(spread_lines(docs, scratch, min_sites, min_chars))
    t, d, k, where, split = free_names(docs, "t", "d", "k", "where", "split")
    placed = docs.select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("at", "line")).select("doc_id", "t", "at", _stripped("line").alias("line"))
    placed = placed.where(F.length("line") >= min_chars).select("doc_id", "t", "at", F.xxhash64("line").alias("h"), F.length("line").alias("n"))
    hits = placed.join(gone, ["h", "n"], "left_semi").groupBy("doc_id", "t").agg(F.collect_set("at").alias("at"))
    hits = hits.select(F.col("doc_id").alias(d), F.col("t").alias(k), F.col("at").alias(where))
    joined = docs.withColumn(t, F.xxhash64("text")).join(hits, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(t) == F.col(k)), "left")
    joined = joined.withColumn(split, F.split("text", "\n"))  # a column of its own, which is used several times: split once, not once a line
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), where)  # by hashing, in order
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col(split), i)), "\n")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(split))
    return joined.select(
        *(F.col(c) for c in docs.columns if c not in ("text", "n_lines", "n_removed")),
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size(where), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col(where).isNull(), F.col("text")).otherwise(kept).alias("text"),
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return drop_spread_lines(docs).select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_kept"), F.sha2("text", 256).alias("kept_sha256"))


ORACLE = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS nth FROM documents),
t AS (SELECT *, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS k FROM l),
b AS (SELECT k FROM t WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT source) >= {MIN_SITES}),
j AS (SELECT t.doc_id, t.nth, t.line, b.k IS NOT NULL AS gone FROM t LEFT JOIN b ON t.k = b.k),
a AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE NOT gone), '') AS kept FROM j GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, length(kept) AS n_chars_kept, sha256(kept) AS kept_sha256 FROM a
"""
