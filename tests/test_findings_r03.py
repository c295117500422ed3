"""Findings of round 3."""

import collections

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from quire.functions import text as T


@pytest.fixture(scope="module")
def long_book(spark, tmp_path_factory):
    """A book of more than 9,999 pages."""
    folder = tmp_path_factory.mktemp("long_book")
    spark.range(10_040).selectExpr("id as doc_id", "concat('words of page ', hash(id), ' that stay') as text", "'en' as lang", "'src0' as source", "20L as n_chars").write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("name", ["book_report", "offset_consensus", "page_locators"])
def test_numbers_of_five_digits(spark, long_book, name):
    df = __spark_entry__.queries()[name](spark, str(long_book))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{long_book}/documents.parquet/*.parquet'")
    columns = ", ".join(f'"{c}"' for c in df.columns)
    want = collections.Counter(con.execute(f"SELECT {columns} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall())
    assert collections.Counter(tuple(r) for r in df.collect()) == want


def test_spaced_letters_behind_an_accent(spark):
    given = "vequée a b c d e f"
    assert spark.createDataFrame([(given,)], "t string").select(T.spaced_letters(F.col("t"))).first()[0] == "vequée abcdef"


def test_clean_text_reads_its_text_once(spark):
    """A rule that names its text several times does not double the work of the rules before it."""
    cleaned = spark.createDataFrame([("T H E  S T O R Y offthe\n● one ● two",)], "t string").select(T.clean_text(F.col("t")).alias("x"))
    assert cleaned.first()[0] == "THESTORY off the\n- one\n- two"
    assert cleaned._jdf.queryExecution().logical().toString().count("ﬃ") == 1
