"""A corpus made ready for training: toxic documents out, boilerplate lines out, one of each group of near copies, no benchmark passages, packed.

Stages take documents as their predecessor left them. Null and empty texts are
clean, have no lines to lose, are no copies of one another, and pack as their
end id alone. Of rows that are equal in doc_id and text the Jaccard stage keeps
one; other rows with one doc_id, or a null one, are documents of their own. All
stages but the last return the columns they got, others than those of documents
included. Empty tables give empty tables; without labels nothing is toxic, and
without benchmark items nothing is a leak.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import Scratch, free_names
from quire.llm.decontam import mark_leaks
from quire.llm.jaccard import keep_one
from quire.llm.linededup import drop_spread_lines
from quire.llm.packing import pack
from quire.llm.toxicity import score_documents, train


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; the model learns from the labels of the documents at hand."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).where("toxic_score < 0.5").drop("toxic_score")


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its lines that stand on many sites; n_chars follows the text."""
    theirs = free_names(docs, "n_lines", "n_removed")
    renamed = docs.withColumnsRenamed(dict(zip(("n_lines", "n_removed"), theirs)))  # the caller's own, where there are any
    cut = drop_spread_lines(renamed).drop("n_lines", "n_removed").withColumnsRenamed(dict(zip(theirs, ("n_lines", "n_removed"))))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs).select(*docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    marked = mark_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.where(~F.col("contaminated")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands."""
    return pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_boilerplate),
    ("n-gram Jaccard join", without_copies),
    ("benchmark decontamination", without_leaks),
    ("best-fit packing", packed),
]

#: The stages fit models and group by similarity: no SQL gives their rows. tests/llm/test_pipeline.py holds each against planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(f"stage_{i}", stage(spark, docs, sf_dir))
    return docs
