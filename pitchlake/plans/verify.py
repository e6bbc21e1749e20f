"""Season checks: metrics against a leaderboard, team records against the standings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.catalog.teams import teams
from pitchlake.operators.compare import compare
from pitchlake.plans.metrics import metric, metrics_of, player_metrics, team_metrics


def _tolerances(names: Sequence[str], override: float | None):
    pairs = []
    for name in names:
        value = metric(name).tolerance if override is None else override
        pairs += [F.lit(name), F.lit(float(value))]
    return F.element_at(F.create_map(*pairs), F.col("metric"))


def verify_players(
    pitches: DataFrame,
    expected: DataFrame,
    entity: str,
    season: int,
    names: Sequence[str] | None = None,
    min_n: int | None = None,
    tolerance: float | None = None,
    player_names: DataFrame | None = None,
) -> DataFrame:
    """Comparison rows of several metrics at once; ``expected`` is (metric, id, expected)."""
    wanted = list(names or metrics_of(entity))
    for name in wanted:
        metric(name, entity)
    ours = player_metrics(pitches, wanted, season, min_n)
    return compare(ours, expected, _tolerances(wanted, tolerance), player_names, by=["metric"])


def expected_records(standings: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows (metric, id, expected) from standings rows of one season."""
    values = {
        "wins": F.col("wins"),
        "losses": F.col("losses"),
        "run_diff": F.col("runs_scored") - F.col("runs_allowed"),
    }
    rows = F.array(*[
        F.struct(F.lit(n).alias("metric"), values[n].cast("double").alias("expected"))
        for n in names
    ])
    return standings.select(F.col("team").alias("id"), F.inline(rows)).select(
        "metric", "id", "expected"
    )


def verify_teams(
    pitches: DataFrame,
    standings: DataFrame,
    season: int,
    names: Sequence[str] | None = None,
    min_n: int | None = None,
    tolerance: float | None = None,
) -> DataFrame:
    """Comparison rows of the team metrics; of ``standings`` the rows of ``season`` count."""
    wanted = list(names or metrics_of("team"))
    standings = standings.where(F.col("season") == season)
    ours = team_metrics(pitches, wanted, season, min_n)
    full_names = teams(pitches.sparkSession).select(
        F.col("feed_abbr").alias("id"), F.col("full_name").alias("name")
    )
    return compare(
        ours,
        expected_records(standings, wanted),
        _tolerances(wanted, tolerance),
        F.broadcast(full_names),
        by=["metric"],
    )


def metric_table(spark: SparkSession, names: Sequence[str], tolerance: float | None = None) -> DataFrame:
    """(metric, aggregation, tolerance) of the names, for results that must mention every metric."""
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("metric"), F.lit(metric(n).entity).alias("aggregation"),
            F.lit(float(metric(n).tolerance if tolerance is None else tolerance)).alias("tolerance"),
        )
        for n in names
    ])
    return spark.range(1).select(F.inline(rows))


def metric_names(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """The names as a frame, for summaries that must mention every metric."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("metric"))
