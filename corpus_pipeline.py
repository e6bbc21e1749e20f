"""A training corpus from raw documents, in five stages; each works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import decontaminate, jaccard, pieces, quality, suffixes
from pitchlake.llm.store import table, written


# Rows that go to a Python worker at once. Whole texts are a few kilobytes each, and both sides hold a batch.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """For a session whose batches are larger: the memory of a task follows the batch, not the input."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    small_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document of smaller id holds; a document may be left empty."""
    return suffixes.remove_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and whether they decode to it."""
    rows = docs.select("doc_id", "lang", "source", "text")
    found = pieces.encode(rows, checked="round_trip", keep_text=False)
    return found.select("doc_id", "lang", "source", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "round_trip")


STAGES = [
    ("quality classifier", good),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding", encoded),
]

# Classifier, forest and suffix sorting are beyond SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
