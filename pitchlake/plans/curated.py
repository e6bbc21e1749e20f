"""The 25 named analyses over the pitch table.

Defaults are the published thresholds. Rows that tie in a top list are ordered by id. Analyses
that need a second table or a per-game fact reduce the pitches to one row per game (or outing)
before anything is shuffled, so a game or player with very many pitches costs no more than another.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.functions import pitch as p




def _contact() -> Column:
    return p.regular_season() & F.col("launch_speed").isNotNull()


def _leaders(
    pitches: DataFrame,
    entity: str | Sequence[str],
    keep: Column,
    values: Sequence[Column],
    sample: str,
    min_n: int,
) -> DataFrame:
    keys = [entity] if isinstance(entity, str) else list(entity)
    return (
        pitches.where(keep)
        .groupBy(*keys)
        .agg(*values, F.count("*").alias(sample))
        .where(F.col(sample) >= min_n)
    )


def league_barrel_rate(pitches: DataFrame) -> DataFrame:
    return (
        pitches.where(_contact())
        .groupBy("game_year")
        .agg(
            p.rate(p.barrel_by_speed_and_angle()).alias("barrel_rate"),
            F.count("*").alias("batted_balls"),
        )
        .orderBy("game_year")
    )


def top_hard_hit(
    pitches: DataFrame, season: int | None = None, min_n: int = 100, limit: int = 10
) -> DataFrame:
    found = _leaders(
        pitches, "batter", _contact() & p.in_season(season),
        [p.rate(p.hard_hit()).alias("hard_hit_pct")], "bbe", min_n,
    )
    return found.orderBy(F.desc("hard_hit_pct"), "batter").limit(limit)


def _called_by_umpire(
    pitches: DataFrame, umpires: DataFrame | None, keep: Column, name: str, min_n: int
) -> DataFrame:
    called = pitches.where(p.is_called() & keep)
    counts = [
        F.count_if(F.col("description") == "called_strike").alias("strikes"),
        F.count("*").alias("sample"),
    ]
    if umpires is None:
        who = called.groupBy("umpire").agg(*counts)
    else:
        plate = umpires.where(F.col("position") == "HP").select(
            "game_pk", F.col("umpire_id").alias("umpire")
        )
        who = (
            called.groupBy("game_pk").agg(*counts)
            .join(plate, "game_pk")
            .groupBy("umpire")
            .agg(F.sum("strikes").alias("strikes"), F.sum("sample").alias("sample"))
        )
    return (
        who.where(F.col("sample") >= min_n)
        .select("umpire", F.try_divide("strikes", "sample").alias(name), "sample")
        .orderBy(F.desc(name), "umpire")
    )


def umpire_called_strikes(
    pitches: DataFrame,
    umpires: DataFrame | None = None,
    as_of: date | None = None,
    days: int = 30,
    min_n: int = 100,
) -> DataFrame:
    """Called-strike rate by plate umpire over the last days.

    Without ``umpires`` it groups on the pitch table's own umpire column, which is always null.
    """
    window = p.last_days(days, as_of)
    if umpires is not None:
        umpires = umpires.where(window)
    return _called_by_umpire(pitches, umpires, window, "called_k_rate", min_n)


def umpire_edge_strikes(
    pitches: DataFrame, umpires: DataFrame | None = None, min_n: int = 50
) -> DataFrame:
    return _called_by_umpire(pitches, umpires, p.on_plate_edge(), "edge_k_rate", min_n)


def whiff_by_hand(pitches: DataFrame, swings: Sequence[str] = p.SWINGS) -> DataFrame:
    """Share of swings that miss, by the batter's side; ``swings`` are the results that count as one."""
    def against(side: str) -> Column:
        return p.rate_among((F.col("stand") == side) & p.is_swing(swings), p.is_whiff())

    return (
        pitches.where(p.regular_season())
        .groupBy("pitcher")
        .agg(against("L").alias("whiff_vs_L"), against("R").alias("whiff_vs_R"))
        .orderBy("pitcher")
    )


def starter_exit_velocity(pitches: DataFrame, min_n: int = 50) -> DataFrame:
    """Exit velocity allowed in games in which the pitcher threw in the first inning.

    One scan: an outing (game and pitcher) is reduced to its contact sums and to whether it
    includes the first inning, so no join against a list of starters is needed.
    """
    first = F.col("inning") == 1
    counted = F.coalesce(_contact(), F.lit(False))
    outings = (
        pitches.where((first | counted) & F.col("game_pk").isNotNull()
                      & F.col("pitcher").isNotNull())
        .groupBy("game_pk", "pitcher")
        .agg(
            F.bool_or(first).alias("started"),
            F.sum(F.when(counted, F.col("launch_speed"))).alias("speed"),
            F.count_if(counted).alias("n"),
        )
        .where(F.col("started") & (F.col("n") > 0))
    )
    return (
        outings.groupBy("pitcher")
        .agg(
            F.try_divide(F.sum("speed"), F.sum("n")).alias("avg_ev_allowed"),
            F.sum("n").alias("bbe"),
        )
        .where(F.col("bbe") >= min_n)
        .orderBy(F.desc("avg_ev_allowed"), "pitcher")
    )


def xwoba_on_contact(
    pitches: DataFrame, season: int | None = None, min_n: int = 150, limit: int = 25
) -> DataFrame:
    found = _leaders(
        pitches, "batter", _contact() & p.in_season(season),
        [F.avg("estimated_woba_using_speedangle").alias("xwoba_contact")], "bbe", min_n,
    )
    return found.orderBy(F.desc("xwoba_contact"), "batter").limit(limit)


def pitches_per_plate_appearance(pitches: DataFrame) -> DataFrame:
    appearance = (
        pitches.where(p.regular_season())
        .groupBy("game_pk", "at_bat_number", p.batting_team().alias("batting_team"))
        .agg(F.count("*").alias("pitches"))
    )
    return (
        appearance.groupBy("batting_team")
        .agg(F.avg("pitches").alias("p_per_pa"), F.count("*").alias("pa_count"))
        .orderBy(F.desc("p_per_pa"), "batting_team")
    )


def sweet_spot_leaders(pitches: DataFrame, min_n: int = 100, limit: int = 25) -> DataFrame:
    found = _leaders(
        pitches, "batter", _contact(),
        [p.rate(p.sweet_spot()).alias("sweet_spot_pct")], "bbe", min_n,
    )
    return found.orderBy(F.desc("sweet_spot_pct"), "batter").limit(limit)


def bat_speed_leaders(
    pitches: DataFrame, since: int = 2024, min_n: int = 50, limit: int = 25
) -> DataFrame:
    keep = (
        F.col("bat_speed").isNotNull()
        & (F.col("game_year") >= since)
        & (F.col("game_date") >= F.make_date(F.lit(since), F.lit(1), F.lit(1)))
        & p.regular_season()
    )
    found = _leaders(
        pitches, "batter", keep, [F.avg("bat_speed").alias("avg_bat_speed")], "bbe", min_n
    )
    return found.orderBy(F.desc("avg_bat_speed"), "batter").limit(limit)


def strikeouts_ahead(pitches: DataFrame, min_n: int = 50, limit: int = 25) -> DataFrame:
    keep = (
        (F.col("balls") == 0) & (F.col("strikes") == 2)
        & F.col("events").isNotNull() & p.regular_season()
    )
    found = _leaders(
        pitches, "pitcher", keep,
        [p.rate(F.col("events") == "strikeout").alias("k_rate_02")], "pa_02", min_n,
    )
    return found.orderBy(F.desc("k_rate_02"), "pitcher").limit(limit)


def velocity_by_pitch_type(pitches: DataFrame, min_n: int = 50) -> DataFrame:
    found = _leaders(
        pitches, ("pitcher", "pitch_type"), F.col("pitch_type").isNotNull() & p.regular_season(),
        [F.avg("release_speed").alias("avg_velo")], "pitches", min_n,
    )
    return found.orderBy("pitcher", F.desc("avg_velo"), "pitch_type")


def spin_distribution(pitches: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Mean, median and 90th percentile of spin by pitch type.

    Spin is a whole number with a few thousand values, so exact percentiles cost no more memory
    than a count per value; ``accuracy`` asks for the approximate ones instead.
    """
    if accuracy is None:
        def quantile(share: float) -> Column:
            return F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY release_spin_rate)")
    else:
        def quantile(share: float) -> Column:
            return F.percentile_approx("release_spin_rate", share, accuracy)

    return (
        pitches.where(F.col("release_spin_rate").isNotNull() & p.regular_season())
        .groupBy("pitch_type")
        .agg(
            F.avg("release_spin_rate").alias("avg_spin"),
            quantile(0.5).cast("bigint").alias("p50"),
            quantile(0.9).cast("bigint").alias("p90"),
            F.count("*").alias("pitches"),
        )
        .orderBy(F.desc("avg_spin"), "pitch_type")
    )


def usage_by_count(pitches: DataFrame) -> DataFrame:
    """Share of each pitch type in a ball-strike count; the window runs over the counts only."""
    in_count = Window.partitionBy("balls", "strikes")
    return (
        pitches.where(F.col("pitch_type").isNotNull() & p.regular_season())
        .groupBy("balls", "strikes", "pitch_type")
        .agg(F.count("*").alias("n"))
        .withColumn("pct", F.try_divide(F.lit(100.0) * F.col("n"), F.sum("n").over(in_count)))
        .orderBy("balls", "strikes", F.desc("pct"), "pitch_type")
    )


def results_by_inning(pitches: DataFrame) -> DataFrame:
    return (
        pitches.where(F.col("events").isNotNull() & p.regular_season())
        .groupBy("inning", "events")
        .agg(F.count("*").alias("n"))
        .orderBy("inning", F.desc("n"), "events")
    )


def late_hard_hit_allowed(pitches: DataFrame, min_n: int = 25) -> DataFrame:
    found = _leaders(
        pitches, "pitcher", (F.col("inning") >= 7) & _contact(),
        [p.rate(p.hard_hit()).alias("hard_hit_allowed")], "bbe", min_n,
    )
    return found.orderBy(F.desc("hard_hit_allowed"), "pitcher")


def run_expectancy(pitches: DataFrame, last_pitch: bool = False) -> DataFrame:
    """Mean score change on the first pitch of a plate appearance, by bases and outs.

    With ``last_pitch`` it is the change on the pitch that ends the appearance, which has its result.
    """
    chosen = F.col("events").isNotNull() if last_pitch else F.col("pitch_number") == 1
    occupied = {
        f"r{base}": F.when(F.col(f"on_{base}b").isNotNull(), 1).otherwise(0).cast("bigint")
        for base in (1, 2, 3)
    }
    state = [*[c.alias(name) for name, c in occupied.items()], F.col("outs_when_up").alias("outs")]
    return (
        pitches.where(chosen & p.regular_season())
        .groupBy(*state)
        .agg(
            F.avg(F.col("post_bat_score") - F.col("bat_score")).alias("re"),
            F.count("*").alias("n"),
        )
        .orderBy("r1", "r2", "r3", "outs")
    )


def pitches_with_runner_on_first(pitches: DataFrame) -> DataFrame:
    keep = F.col("on_1b").isNotNull() & F.col("pitch_type").isNotNull() & p.regular_season()
    return (
        pitches.where(keep)
        .groupBy("pitch_type")
        .agg(
            F.count("*").alias("pitches"),
            p.rate(F.col("description") == "ball").alias("ball_rate"),
        )
        .orderBy(F.desc("pitches"), "pitch_type")
    )


def late_and_close(pitches: DataFrame) -> DataFrame:
    close = F.abs(F.col("post_bat_score") - F.col("post_fld_score")) <= 2
    keep = (F.col("inning") >= 7) & close & p.regular_season() & F.col("woba_value").isNotNull()
    return (
        pitches.where(keep)
        .groupBy(p.batting_team().alias("batting_team"))
        .agg(F.avg("woba_value").alias("late_close_woba"), F.count("*").alias("n"))
        .orderBy(F.desc("late_close_woba"), "batting_team")
    )


def exit_velocity_by_season(pitches: DataFrame) -> DataFrame:
    return (
        pitches.where(_contact())
        .groupBy("game_year")
        .agg(F.avg("launch_speed").alias("avg_ev"), F.count("*").alias("bbe"))
        .orderBy("game_year")
    )


def pitch_tempo(pitches: DataFrame) -> DataFrame:
    """Pitches per game. Outings are counted first, so the distinct games need no second pass."""
    outings = (
        pitches.where(p.regular_season())
        .groupBy("pitcher", "game_pk")
        .agg(F.count("*").alias("n"))
    )
    return (
        outings.groupBy("pitcher")
        .agg(F.sum("n").alias("pitches"), F.count("game_pk").alias("games"))
        .withColumn("pitches_per_game", F.try_divide("pitches", "games"))
        .orderBy(F.desc("pitches_per_game"), "pitcher")
    )


def two_strike_results(pitches: DataFrame, min_n: int = 25) -> DataFrame:
    keep = (F.col("strikes") == 2) & F.col("events").isNotNull() & p.regular_season()
    found = _leaders(
        pitches, ("pitcher", "balls", "strikes"), keep,
        [
            p.rate(F.col("events") == "strikeout").alias("k_rate"),
            p.rate(F.col("events").isin(*p.HITS)).alias("contact_rate"),
        ],
        "terminal_pas", min_n,
    )
    return found.orderBy("pitcher", "balls", "strikes")


def catcher_framing(pitches: DataFrame, min_n: int = 100) -> DataFrame:
    found = _leaders(
        pitches.withColumnRenamed("fielder_2", "catcher"), "catcher",
        p.is_called() & p.on_plate_edge() & p.regular_season(),
        [p.rate(F.col("description") == "called_strike").alias("edge_called_k_rate")],
        "edge_pitches", min_n,
    )
    return found.orderBy(F.desc("edge_called_k_rate"), "catcher")


def park_exit_velocity(pitches: DataFrame, min_n: int = 1000) -> DataFrame:
    found = _leaders(
        pitches.withColumnRenamed("home_team", "park"), "park", _contact(),
        [F.avg("launch_speed").alias("avg_ev")], "bbe", min_n,
    )
    return found.orderBy(F.desc("avg_ev"), "park")


def team_game_lines(pitches: DataFrame) -> DataFrame:
    return (
        pitches.where(_contact())
        .groupBy("game_pk", "game_date", p.batting_team().alias("batting_team"))
        .agg(
            p.rate(p.barrel_by_speed_and_angle()).alias("barrel_rate"),
            p.rate(p.hard_hit()).alias("hard_hit_pct"),
            F.avg("launch_speed").alias("avg_ev"),
            F.avg("launch_angle").alias("avg_la"),
            F.avg("estimated_woba_using_speedangle").alias("xwoba_contact"),
            F.count("*").alias("bbe"),
        )
        .orderBy("game_pk", "game_date", "batting_team")
    )
