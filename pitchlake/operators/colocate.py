"""Copies of pitches, games and umpires that lie by game, for joins on the game without a shuffle.

Tables split by day serve questions about days; a join of all seasons on ``game_pk`` would shuffle both
sides of it. These copies are split by season and, within it, dealt to the same buckets by game. Spark
reads a bucket of both tables in one task, so groups and joins by game need no exchange, and a slice is
still replaced by itself (``tables.replace_seasons``).

One task reads a bucket over all seasons asked, so choose as many as a bucket of the longest question
fits a task. A game is never split: where one may hold a large part of all pitches, read the table by day.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.catalog.columns import Column, TableLayout
from pitchlake.catalog.games import GAMES, UMPIRES
from pitchlake.catalog.pitches import PITCHES

BUCKETS = 256
_SEASON = Column("season", "bigint", ("temporal", "partition_key"), "Season of the game.", required=True)


def pitches_by_game(buckets: int = BUCKETS) -> TableLayout:
    return replace(PITCHES, partition_by=("game_year",), cluster_by=("game_pk",), buckets=("game_pk", buckets))


def games_by_game(buckets: int = BUCKETS) -> TableLayout:
    return replace(GAMES, cluster_by=("game_pk",), buckets=("game_pk", buckets))


def umpires_by_game(buckets: int = BUCKETS) -> TableLayout:
    return replace(
        UMPIRES, columns=(*UMPIRES.columns, _SEASON), partition_by=("season",), cluster_by=("game_pk",),
        buckets=("game_pk", buckets),
    )


def with_season(umpires: DataFrame) -> DataFrame:
    """Rows for the layout of ``umpires_by_game``."""
    return umpires.withColumn("season", F.year("game_date").cast("long"))
