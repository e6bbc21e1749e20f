"""Landed pitch batches and what is derived from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.catalog.pitches import PITCHES
from pitchlake.functions.pitch import regular_season
from pitchlake.operators.conform import conform

FORMATS = ("parquet", "csv")


def empty_pitches(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PITCHES.schema)


def read_landing(
    spark: SparkSession, paths: str | list[str], fmt: str = "parquet", merge_schema: bool = True
) -> DataFrame:
    """Landed pitches with the columns the files have, matched by name.

    CSV values stay text here; ``pitch_batch`` gives every column its documented type. Parquet
    files may have different columns: the feed gains some over the years, and taking one file's
    schema for all (``merge_schema=False``, quicker) would lose them. Files that disagree on the
    type of a column are read apart and joined with ``union_batches``.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; choices: {FORMATS}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return empty_pitches(spark)
    if fmt == "csv":
        return spark.read.option("header", True).csv(paths)
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def pitch_batch(landed: DataFrame, start: date, end: date) -> DataFrame:
    """Regular-season pitches of [start, end] with exactly the table's columns."""
    return conform(landed, PITCHES).where(
        F.col("game_date").between(F.lit(start), F.lit(end)) & regular_season()
    )


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Batches from differently typed files as one; each has the table's columns already."""
    return reduce(DataFrame.unionByName, batches)


def distinct_games(pitches: DataFrame) -> DataFrame:
    """The games of a batch: one (game_pk, game_date) each."""
    return pitches.select("game_pk", "game_date").distinct()
