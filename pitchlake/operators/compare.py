"""Compare our values with an outside source, within a tolerance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_THRESHOLD = 0.99


def compare(
    ours: DataFrame,
    expected: DataFrame,
    tolerance: float | Column,
    names: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per id on both sides, ordered by id.

    ``ours`` is (id, value, sample_size), ``expected`` is (id, expected), ``names`` is (id, name);
    ``by`` lists further columns that both sides share, such as the metric. Neither side is hinted
    for broadcast: adaptive execution does that once it has seen a small enough size.
    """
    keys = [*by, "id"]
    limit = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    joined = ours.join(expected, keys)
    if names is None:
        joined = joined.withColumn("name", F.lit(None).cast("string"))
    else:
        joined = joined.join(names, "id", "left")
    diff = F.col("value") - F.col("expected")
    return joined.select(
        *by,
        F.col("id").alias("entity_id"),
        F.coalesce("name", F.col("id").cast("string")).alias("entity_name"),
        F.col("value").alias("ours"),
        "expected",
        diff.alias("diff"),
        F.coalesce("sample_size", F.lit(0)).alias("sample_size"),
        F.coalesce(F.abs(diff) <= limit, F.lit(False)).alias("within_tolerance"),
    ).orderBy(*by, "entity_id")


def _verdict_columns(total: Column, hits: Column, threshold: float) -> list[Column]:
    share = F.when(total == 0, 0.0).otherwise(F.try_divide(hits, total))
    return [
        total.alias("total_compared"),
        hits.alias("within_count"),
        share.alias("pct_within"),
        (share >= threshold).alias("passed"),
    ]


def summarise(comparison: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row: how many were compared, how many agree, their share, and the verdict."""
    return comparison.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("within_tolerance").alias("hits")
    ).select(*_verdict_columns(F.col("total"), F.col("hits"), threshold))


def summarise_metrics(
    comparison: DataFrame, metrics: DataFrame, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """``summarise`` per metric. A metric of ``metrics`` with nothing compared does not pass."""
    counted = comparison.groupBy("metric").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("within_tolerance").alias("hits")
    )
    total = F.coalesce("total", F.lit(0))
    hits = F.coalesce("hits", F.lit(0))
    return metrics.join(counted, "metric", "left").select(
        "metric", *_verdict_columns(total, hits, threshold)
    )


def overall(summaries: DataFrame) -> DataFrame:
    """One row: whether every metric passed."""
    return summaries.agg(
        F.count(F.lit(1)).alias("metrics"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
    )


def results(
    comparison: DataFrame, metrics: DataFrame, season: int, source: str,
    threshold: float = DEFAULT_THRESHOLD, limit: int = 5,
) -> DataFrame:
    """A verification result per metric, fit for a report.

    ``metrics`` is (metric, aggregation, tolerance). ``deltas`` holds up to ``limit`` of the largest
    differences outside the tolerance, the largest first.
    """
    place = F.row_number().over(
        Window.partitionBy("metric").orderBy(F.abs("diff").desc(), "entity_id")
    )
    entry = F.struct("place", "entity_id", "entity_name", "ours", "expected", "diff", "sample_size")
    worst = (
        comparison.where(~F.col("within_tolerance")).withColumn("place", place)
        .where(F.col("place") <= limit)
        .groupBy("metric").agg(F.array_sort(F.collect_list(entry)).alias("deltas"))
    )
    judged = summarise_metrics(comparison, metrics.select("metric"), threshold)
    none = F.expr("array()").cast(worst.schema["deltas"].dataType)
    return metrics.join(judged, "metric").join(worst, "metric", "left").select(
        "metric", F.lit(season).cast("bigint").alias("season"), "aggregation",
        F.lit(source).alias("source"), "tolerance", F.lit(threshold).alias("threshold"),
        "total_compared", "within_count", "pct_within", "passed",
        F.coalesce("deltas", none).alias("deltas"),
    )


def top_deltas(comparison: DataFrame, limit: int = 5) -> DataFrame:
    """The largest differences among the rows outside the tolerance."""
    return (
        comparison.where(~F.col("within_tolerance"))
        .orderBy(F.abs("diff").desc(), "entity_id")
        .limit(limit)
    )
