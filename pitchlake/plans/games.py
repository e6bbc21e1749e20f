"""Questions about single games: slate, results, plate appearances, starters, umpires."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import pitch as p


def _on(day: date) -> Column:
    # The season is the partition of the schedule table; a game is played in its season's year.
    return (F.col("season") == day.year) & (F.col("game_date") == F.lit(day))


def results_on(games: DataFrame, day: date) -> DataFrame:
    """Finished games of a day."""
    return games.where(_on(day) & (F.col("status_code") == "F")).select(
        "game_pk", "home_team_abbrev", "final_home_score", "away_team_abbrev", "final_away_score"
    ).orderBy("game_pk")


def slate_on(games: DataFrame, day: date) -> DataFrame:
    """Games of a day still to be played, with the announced starters."""
    return games.where(_on(day) & (F.col("status_code") == "S")).select(
        "game_pk", "home_team_abbrev", "probable_home_pitcher_id",
        "away_team_abbrev", "probable_away_pitcher_id",
    ).orderBy("game_pk")


def plate_appearance_results(pitches: DataFrame) -> DataFrame:
    """One row per plate appearance: the result on its last pitch, null when it was cut off."""
    # Text as a key stays in hash aggregation; one row per result is left to choose from.
    ends = pitches.groupBy("game_pk", "at_bat_number", "events").agg(
        F.max("pitch_number").alias("pitch_number")
    )
    last = F.struct("pitch_number", F.coalesce("events", F.lit("")))
    return ends.groupBy("game_pk", "at_bat_number").agg(F.max_by("events", last).alias("events"))


def result_counts(pitches: DataFrame) -> DataFrame:
    """How often each result ended a regular-season plate appearance."""
    return (
        plate_appearance_results(pitches.where(p.regular_season()))
        .groupBy("events")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "events")
    )


def actual_starters(pitches: DataFrame) -> DataFrame:
    """Who threw the first pitch for each side: (game_pk, home_pitcher, away_pitcher).

    Each pitcher's first pitch is found by hash aggregation; only one row per pitcher and game is
    left to choose from. Pitches without a plate appearance or a number have no place and never
    come first.
    """
    first = p.place(F.col("at_bat_number"), F.col("pitch_number"))
    outing = pitches.groupBy("game_pk", "inning_topbot", "pitcher").agg(
        F.min(first).alias("first")
    )

    def opener(half: str) -> Column:
        placed = (F.col("inning_topbot") == half) & F.col("first").isNotNull()
        order = F.when(placed, F.struct("first", "pitcher"))
        return F.min(order)["pitcher"]

    return outing.groupBy("game_pk").agg(
        opener("Top").alias("home_pitcher"), opener("Bot").alias("away_pitcher")
    )


def announced_and_actual_starters(pitches: DataFrame, games: DataFrame) -> DataFrame:
    """Announced next to actual starters, for games that are in both tables."""
    announced = games.select("game_pk", "probable_home_pitcher_id", "probable_away_pitcher_id")
    return (
        announced.join(actual_starters(pitches), "game_pk")
        .select(
            "game_pk",
            "probable_home_pitcher_id", "home_pitcher",
            F.col("probable_home_pitcher_id").eqNullSafe(F.col("home_pitcher")).alias("home_same"),
            "probable_away_pitcher_id", "away_pitcher",
            F.col("probable_away_pitcher_id").eqNullSafe(F.col("away_pitcher")).alias("away_same"),
        )
        .orderBy("game_pk")
    )


def plate_umpire_workload(pitches: DataFrame, umpires: DataFrame) -> DataFrame:
    """Games and pitches seen from behind the plate; games without an umpire are one null row."""
    per_game = pitches.groupBy("game_pk").agg(F.count("*").alias("pitches"))
    plate = umpires.where(F.col("position") == "HP").select("game_pk", "umpire_id")
    return (
        per_game.join(plate, "game_pk", "left")
        .groupBy("umpire_id")
        .agg(F.count("*").alias("games"), F.sum("pitches").alias("pitches"))
        .orderBy("umpire_id")
    )


def strike_zone_calls(pitches: DataFrame) -> DataFrame:
    """How pitches in and out of the measured zone are called, by the batter's side."""
    return (
        pitches.where(p.is_called() & p.regular_season())
        .groupBy("stand", p.in_strike_zone().alias("in_zone"))
        .agg(
            F.count("*").alias("called"),
            p.rate(F.col("description") == "called_strike").alias("strike_rate"),
            F.avg(p.batter_view_x()).alias("batter_view_x"),
        )
        .orderBy("stand", "in_zone")
    )
