"""Season metrics by player and team: rows (id, value, sample_size)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import pitch as p


@dataclass(frozen=True)
class Metric:
    """How a metric is computed and what it is compared with.

    ``keep`` picks the rows that count. ``value`` and ``sample`` aggregate over them; both are
    conditional on ``keep``, so any number of metrics can share one scan.
    """

    name: str
    entity: str
    tolerance: float
    board_field: str
    board_scale: float = 1.0
    keep: Callable[[], Column] | None = None
    value: Callable[[Column], Column] | None = None
    sample: Callable[[Column], Column] | None = None


def _count(keep: Column) -> Column:
    return F.count_if(keep)


def _mean(name: str) -> Callable[[Column], Column]:
    return lambda keep: F.avg(F.when(keep, F.col(name)))


def _classified(*names: str) -> Callable[[], Column]:
    def keep() -> Column:
        found = F.col("launch_speed_angle").isNotNull()
        for name in names:
            found = found & F.col(name).isNotNull()
        return found

    return keep


def _weighted_woba(keep: Column) -> Column:
    """Expected value on contact, actual value otherwise, over the appearances that count."""
    worth = F.when(
        F.col("description") == "hit_into_play",
        F.coalesce("estimated_woba_using_speedangle", F.lit(0.0)),
    ).otherwise(F.coalesce("woba_value", F.lit(0.0)))
    weight = F.col("woba_denom")
    return F.try_divide(F.sum(F.when(keep, worth * weight)), F.sum(F.when(keep, weight)))


# Leaderboard fields, unit factors and tolerances. The fields of avg_release_speed
# and whiff_rate measure something else; pass other ones to the comparison where that matters.
METRICS = {
    m.name: m
    for m in (
        Metric("barrel_rate", "batter", 0.005, "brl_percent", 0.01,
               _classified(),
               lambda keep: p.rate_among(keep, F.col("launch_speed_angle") == 6), _count),
        Metric("hard_hit_pct", "batter", 0.005, "ev95percent", 0.01,
               _classified("launch_speed"),
               lambda keep: p.rate_among(keep, p.hard_hit()), _count),
        Metric("avg_exit_velo", "batter", 0.5, "avg_hit_speed", 1.0,
               _classified("launch_speed"), _mean("launch_speed"), _count),
        Metric("avg_launch_angle", "batter", 0.5, "avg_hit_angle", 1.0,
               _classified("launch_angle"), _mean("launch_angle"), _count),
        Metric("xwoba_contact", "batter", 0.005, "est_woba", 1.0,
               lambda: F.col("events").isNotNull(), _weighted_woba,
               lambda keep: F.sum(F.when(keep, F.col("woba_denom")))),
        Metric("avg_release_speed", "pitcher", 0.2, "avg_hit_speed", 1.0,
               lambda: F.col("release_speed").isNotNull(), _mean("release_speed"), _count),
        Metric("whiff_rate", "pitcher", 0.005, "ev95percent", 0.01,
               lambda: F.lit(True),
               lambda keep: p.rate_among(p.is_swing(), p.is_whiff()),
               lambda keep: F.count_if(p.is_swing())),
        Metric("hard_hit_allowed", "pitcher", 0.005, "ev95percent", 0.01,
               _classified("launch_speed"),
               lambda keep: p.rate_among(keep, p.hard_hit()), _count),
        Metric("wins", "team", 1.0, "wins"),
        Metric("losses", "team", 1.0, "losses"),
        Metric("run_diff", "team", 5.0, "run_diff"),
    )
}
# Smallest sample that is reported, by kind of entity.
MIN_SAMPLE = {"batter": 50, "pitcher": 20, "team": 1}


def metric(name: str, entity: str | None = None) -> Metric:
    """The named metric; an unknown name or one of another entity is an error."""
    found = METRICS.get(name)
    if found is None or (entity is not None and found.entity != entity):
        choices = [m.name for m in METRICS.values() if entity in (None, m.entity)]
        raise ValueError(f"unsupported metric {name!r}; choices: {sorted(choices)}")
    return found


def metrics_of(entity: str) -> list[str]:
    return [m.name for m in METRICS.values() if m.entity == entity]


def player_metrics(
    pitches: DataFrame,
    names: Sequence[str],
    season: int,
    min_n: int | None = None,
) -> DataFrame:
    """Rows (metric, id, value, sample_size) of several metrics of one entity, from one scan."""
    specs = [metric(name) for name in names]
    entity = specs[0].entity
    specs = [metric(s.name, entity) for s in specs]
    floor = MIN_SAMPLE[entity] if min_n is None else min_n
    keeps = {s.name: s.keep() for s in specs}
    wanted = F.lit(False)
    for keep in keeps.values():
        wanted = wanted | keep
    totals = (
        pitches.where(p.regular_season() & p.in_season(season) & wanted)
        .groupBy(F.col(entity).alias("id"))
        .agg(*[
            F.struct(
                F.lit(s.name).alias("metric"),
                s.value(keeps[s.name]).cast("double").alias("value"),
                s.sample(keeps[s.name]).cast("bigint").alias("sample_size"),
                F.count_if(keeps[s.name]).alias("kept"),
            ).alias(s.name)
            for s in specs
        ])
    )
    return (
        totals.select("id", F.inline(F.array(*[F.col(s.name) for s in specs])))
        .where((F.col("kept") > 0) & (F.col("sample_size") >= floor))
        .select("metric", "id", "value", "sample_size")
    )


def player_metric(
    pitches: DataFrame, name: str, season: int, min_n: int | None = None
) -> DataFrame:
    return player_metrics(pitches, [name], season, min_n).drop("metric")


def final_scores(pitches: DataFrame, season: int) -> DataFrame:
    """One row (game_pk, home_team, away_team, home, away) per game, from its last pitch.

    The last pitch is found by hash aggregation on one number per pitch, so games are not sorted
    and every task sends at most one row per game. The number orders pitches by plate appearance,
    then pitch, then score, which decides between copies of a pitch. Missing numbers count as 0.
    """
    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    scored = pitches.where(p.regular_season() & p.in_season(season)).select(
        "game_pk", "home_team", "away_team",
        p.home_runs_after().alias("home"),
        p.away_runs_after().alias("away"),
        "at_bat_number", "pitch_number",
    )
    place = p.place(*[number(c) for c in ("at_bat_number", "pitch_number", "home", "away")])
    last = scored.groupBy("game_pk", "home_team", "away_team").agg(
        F.max_by("home", place).alias("home"),
        F.max_by("away", place).alias("away"),
        F.max(place).alias("place"),
    )
    # A game whose team labels changed part-way has several rows here; the latest one counts.
    line = F.struct("home_team", "away_team", "home", "away")
    return (
        last.groupBy("game_pk")
        .agg(F.max_by(line, F.struct("place", "home_team", "away_team")).alias("line"))
        .select("game_pk", "line.*")
    )


def team_records(pitches: DataFrame, season: int) -> DataFrame:
    """Rows (id, wins, losses, run_diff, sample_size) per team; ties count in the sample only."""
    sides = F.array(
        F.struct(F.col("home_team").alias("id"), F.col("home").alias("rs"),
                 F.col("away").alias("ra")),
        F.struct(F.col("away_team").alias("id"), F.col("away").alias("rs"),
                 F.col("home").alias("ra")),
    )
    return (
        final_scores(pitches, season)
        .select(F.inline(sides))
        .groupBy("id")
        .agg(
            F.count_if(F.col("rs") > F.col("ra")).alias("wins"),
            F.count_if(F.col("rs") < F.col("ra")).alias("losses"),
            (F.sum("rs") - F.sum("ra")).alias("run_diff"),
            F.count("*").alias("sample_size"),
        )
    )


def team_metrics(
    pitches: DataFrame, names: Sequence[str], season: int, min_n: int | None = None
) -> DataFrame:
    """Rows (metric, id, value, sample_size); all metrics come from one pass over the games."""
    for name in names:
        metric(name, "team")
    floor = MIN_SAMPLE["team"] if min_n is None else min_n
    rows = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
        for name in names
    ])
    return (
        team_records(pitches, season)
        .where(F.col("sample_size") >= floor)
        .select("id", "sample_size", F.inline(rows))
        .select("metric", "id", "value", "sample_size")
    )


def team_metric(pitches: DataFrame, name: str, season: int, min_n: int | None = None) -> DataFrame:
    return team_metrics(pitches, [name], season, min_n).drop("metric")
