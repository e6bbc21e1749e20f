"""Outside leaderboards, the yardstick of the season metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.plans.metrics import metric

NAME = "last_name, first_name"


def read_leaderboard(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A landed leaderboard; CSV columns arrive as text and are cast on use."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path)


def expected_values(
    board: DataFrame,
    metrics: Sequence[str],
    sample_column: str | None = None,
    min_sample: int = 0,
) -> DataFrame:
    """Rows (metric, id, expected) in our units, all metrics from one read of the board.

    ``sample_column`` names the board's own sample size, cut at ``min_sample``.
    """
    specs = [metric(name) for name in metrics]
    if sample_column is not None:
        board = board.where(F.col(f"`{sample_column}`").cast("bigint") >= min_sample)
    rows = F.array(*[
        F.struct(
            F.lit(s.name).alias("metric"),
            (F.col(s.board_field).cast("double") * s.board_scale).alias("expected"),
        )
        for s in specs
    ])
    return board.select(F.col("player_id").cast("bigint").alias("id"), F.inline(rows)).select(
        "metric", "id", "expected"
    )


@dataclass(frozen=True)
class Board:
    """A leaderboard, the metrics to take from it, and its own cut on its own sample size."""

    frame: DataFrame
    metrics: tuple[str, ...]
    sample_column: str
    min_sample: int


def expected_from(boards: Sequence[Board]) -> DataFrame:
    """``expected_values`` of several boards, each at its own minimum."""
    return reduce(DataFrame.unionByName, [
        expected_values(b.frame, b.metrics, b.sample_column, b.min_sample) for b in boards
    ])


def player_names(board: DataFrame) -> DataFrame:
    """Rows (id, name); one name per player."""
    return board.groupBy(F.col("player_id").cast("bigint").alias("id")).agg(
        F.max(F.col(f"`{NAME}`")).alias("name")
    )
