"""Column expressions over the pitch table. All are built-in, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pitch results by meaning.
CALLED = ("called_strike", "ball")
WHIFFS = ("swinging_strike", "swinging_strike_blocked", "foul_tip", "missed_bunt")
SWINGS = (*WHIFFS, "foul", "hit_into_play")
HITS = ("single", "double", "triple", "home_run")
# Half width of the plate and the edge band around it, in feet.
PLATE_HALF_WIDTH = 0.83
EDGE_BAND = 0.0833


def regular_season() -> Column:
    return F.col("game_type") == "R"


def in_season(season: int | None = None) -> Column:
    """Rows of one season, the current one when none is given.

    The day range repeats what ``game_year`` says so that only the season's partitions are read.
    """
    year = F.year(F.current_date()) if season is None else F.lit(season)
    return (F.col("game_year") == year) & F.col("game_date").between(
        F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31))
    )


def last_days(days: int, as_of: date | None = None) -> Column:
    """Rows of the window of ``days`` days that ends on ``as_of`` (today by default)."""
    end = F.current_date() if as_of is None else F.lit(as_of)
    return F.col("game_date").between(F.date_sub(end, days), end)


def rate(condition: Column) -> Column:
    """Share of rows for which ``condition`` holds; unknown counts as no."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def rate_among(keep: Column, condition: Column) -> Column:
    """Share of the rows in ``keep`` for which ``condition`` holds; null without such rows."""
    return F.avg(F.when(keep, F.when(condition, 1.0).otherwise(0.0)))


def batting_team() -> Column:
    return F.when(F.col("inning_topbot") == "Top", F.col("away_team")).otherwise(
        F.col("home_team")
    )


def is_called() -> Column:
    return F.col("description").isin(*CALLED)


def is_swing(swings: Sequence[str] = SWINGS) -> Column:
    return F.col("description").isin(*swings)


def is_whiff() -> Column:
    return F.col("description").isin(*WHIFFS)


def hard_hit() -> Column:
    return F.col("launch_speed") >= 95


def barrel_by_speed_and_angle() -> Column:
    """The simple box used by the analyses; the season metric uses the feed's contact class."""
    return (F.col("launch_speed") >= 98) & F.col("launch_angle").between(8, 50)


def sweet_spot() -> Column:
    return F.col("launch_angle").between(8, 32)


def on_plate_edge() -> Column:
    """Within an inch of either side of the plate."""
    return F.abs(F.abs(F.col("plate_x")) - PLATE_HALF_WIDTH) < EDGE_BAND


def in_strike_zone() -> Column:
    """From the measured position, which the coarse ``zone`` column does not replace."""
    return (F.abs(F.col("plate_x")) <= PLATE_HALF_WIDTH) & F.col("plate_z").between(
        F.col("sz_bot"), F.col("sz_top")
    )


def batter_view_x() -> Column:
    """``plate_x`` as the batter sees it: mirrored for right-handed batters."""
    return F.when(F.col("stand") == "R", -F.col("plate_x")).otherwise(F.col("plate_x"))


def home_runs_after() -> Column:
    """Home score after the pitch, from the batting/fielding scores."""
    return F.when(F.col("inning_topbot") == "Top", F.col("post_fld_score")).otherwise(
        F.col("post_bat_score")
    )


def away_runs_after() -> Column:
    return F.when(F.col("inning_topbot") == "Top", F.col("post_bat_score")).otherwise(
        F.col("post_fld_score")
    )


def place(at_bat: Column, pitch: Column, home: Column | None = None, away: Column | None = None) -> Column:
    """One decimal that orders pitches by plate appearance, then pitch, then the two scores.

    Null where the plate appearance or the pitch is. Numbers of 2^40 or more, scores of 2^20 or more
    and negative ones do not fit and raise an error.
    """
    def held(value: Column | None, bits: int) -> Column:
        if value is None:
            return F.lit(0).cast("decimal(38,0)")
        fits = (value >= 0) & (value < F.lit(2**bits))
        error = F.raise_error(F.lit(f"a number beyond {bits} bits cannot be ordered")).cast("bigint")
        return F.when(value.isNull() | fits, value.cast("bigint")).otherwise(error).cast("decimal(13,0)")

    def times(value: Column, power: int) -> Column:
        factor = F.lit(str(2**power)).cast(f"decimal({len(str(2**power))},0)")
        return (value * factor).cast("decimal(38,0)")

    found = times(held(at_bat, 40), 80) + times(held(pitch, 40), 40)
    return (found + times(held(home, 20), 20) + held(away, 20)).cast("decimal(38,0)")
