"""Repair of extraction damage in Markdown: joined words, stray consonants, blocks of picture text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import rebuild

# Fixed values.
FUNCTION_WORDS = (
    "the a an of and or to in on at for from with was were is are be been being his her its their our my so as by not but that this "
    "these those would could should had has have out off over into upon such more very all one two no we he she him them then than up if it "
    "do who when where which"
).split()
LEADING_WORDS = (
    "the and of to in on by for from with was were are is has had have out over into upon such that this these those more very all one two "
    "our her his its their been being would could should than then when where which who not but"
).split()
NEVER_TRAILING = ("our", "ours", "us")
PICTURE = r"(?sU)\*\*-+ Start of picture text -+\*\*<br>\s*(.*?)\s*\*\*-+ End of picture text -+\*\*<br>"
WORD, PIECE, CANDIDATE = r"[\p{L}\p{N}_]+", r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+", "^[a-z]{4,}$"


def join_splits(tokens: DataFrame, dictionary: DataFrame) -> DataFrame:
    """splits(token, left, right): how tokens that dictionary(word) lacks fall into a function word and a word.

    Of several ways the one with the longest shorter half wins, then the first
    cut. The halves that need the dictionary are looked up by a join, each
    distinct token once, so neither table has to fit anywhere.
    """
    known = dictionary.select(F.lower("word").alias("word")).where("word is not null").distinct()
    unknown = tokens.select("token").where(F.length("token") > 1).distinct().join(known, F.col("token") == F.col("word"), "left_anti")
    cuts = unknown.select("token", F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("cut"))
    cuts = cuts.selectExpr("token", "cut", "left(token, cut) as left", "substr(token, cut + 1) as right")
    left, right = F.col("left"), F.col("right")
    leads, trails = left.isin(FUNCTION_WORDS), right.isin(FUNCTION_WORDS)
    other = F.when(leads & trails, None).when(leads, right).otherwise(left)
    fits = (leads | trails) & ~right.isin(*NEVER_TRAILING) & (~leads | left.isin(LEADING_WORDS)) & (~right.isin("a", "an") | leads | (F.length(left) >= 4))
    cuts = cuts.where(fits).withColumn("other", other).where(F.col("other").isNull() | (F.length("other") >= 3))
    good = cuts.where("other is null").unionByName(cuts.join(known, F.col("other") == F.col("word"), "left_semi"))
    best = F.max_by(F.struct("left", "right"), F.struct(F.least(F.length("left"), F.length("right")), -F.col("cut")))
    return good.groupBy("token").agg(best.alias("b")).select("token", "b.left", "b.right")


def candidates(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, token): the distinct words of lower-case letters alone of each text."""
    words = F.filter(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), 0)), lambda w: w.rlike(CANDIDATE))
    return texts.select(key, F.explode(words).alias("token"))


def split_joins(texts: DataFrame, dictionary: DataFrame, key: str = "doc_id") -> DataFrame:
    """texts with joined words taken apart, and n_joins, the distinct tokens replaced; null text stays null and counts 0."""
    tokens = candidates(texts, key)
    found = tokens.join(join_splits(tokens, dictionary), "token").select(key, "token", F.concat_ws(" ", "left", "right").alias("apart")).distinct()
    found = found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("token", "apart"))).alias("__apart"))
    pieces = F.regexp_extract_all("text", F.lit(PIECE), 0)
    text = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.col("__apart")[p], p)), "")
    n = F.size(F.array_intersect(pieces, F.map_keys("__apart")))
    joined = texts.join(found, key, "left")
    changed = F.col("__apart").isNotNull() & F.col("text").isNotNull()
    return joined.select(*(c for c in texts.columns if c != "text"), F.when(changed, text).otherwise(F.col("text")).alias("text"), F.when(changed, n).otherwise(0).cast("int").alias("n_joins"))


def picture_text(text: Column) -> tuple[Column, Column, Column]:
    """Text with blocks of picture text unwrapped where they hold a table of contents, else dropped; how many of either."""
    contents = lambda x: x.contains("Index of Terms") | ((F.regexp_count(x, F.lit(r"\|")) >= 8) & x.rlike(r"(?i)\b(contents|chapter)\b"))
    inner = lambda m: F.regexp_extract(m, PICTURE, 1)
    kept = F.size(F.filter(F.regexp_extract_all(text, F.lit(PICTURE), 1), contents))
    return rebuild(text, PICTURE, lambda m: F.when(contents(inner(m)), inner(m)).otherwise("")), kept, T.count(text, PICTURE) - kept


def clean_markdown(texts: DataFrame, dictionary: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """texts repaired: joined words (where there is a dictionary), stray consonants, picture text, then runs of empty lines.

    Adds n_joins, n_stray, n_kept and n_dropped. A second pass changes nothing.
    """
    now = texts.withColumn("n_joins", F.lit(0)) if dictionary is None else split_joins(texts, dictionary, key)
    text, n = T.stray_consonants(F.col("text"))
    now = now.withColumns({"n_stray": F.coalesce(n, F.lit(0)), "text": text})
    text, kept, dropped = picture_text(F.col("text"))
    now = now.withColumns({"n_kept": F.coalesce(kept, F.lit(0)), "n_dropped": F.coalesce(dropped, F.lit(0)), "text": text})
    return now.withColumn("text", F.regexp_replace("text", r"\n{3,}", "\n\n"))
