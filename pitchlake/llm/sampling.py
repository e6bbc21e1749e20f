"""Folds by doc_id, and a bounded share of the labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 1 << 30


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(parts)).cast("int")


def labelled(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(doc_id, y): one row per id that has a label; of several labels the larger one counts."""
    return (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where("doc_id IS NOT NULL AND y IN (0, 1)")
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    )


def training_labels(labels: DataFrame, doc_id: str, label: str, bound: int, held: Column) -> DataFrame:
    """Labels for fitting: all that ``held`` does not keep back, or about ``bound`` of them.

    Ids are taken by their hash, so the choice is the same on every run.
    """
    known = labelled(labels, doc_id, label).where(~held)
    count = known.count()
    if count <= bound:
        return known
    share = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(STEPS))
    return known.where(share < int(STEPS * bound / count))


def with_labels(documents: DataFrame, doc_id: str, text: str, chosen: DataFrame) -> DataFrame:
    """(text, y) of the chosen labels' documents; ``chosen`` is bounded, so it is broadcast.

    A document id that occurs on several rows gives a row each.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.join(F.broadcast(chosen), "doc_id")
