"""States equal a scan of the pitches, also after days were replaced, emptied or loaded again."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pitchlake.catalog.pitches import PITCHES
from pitchlake.operators.tables import create_table
from pitchlake.plans import curated, metrics, states
from tests.helpers import pitches

YEAR = (date(2024, 4, 1), date(2024, 4, 12))
WEEK = (date(2024, 4, 3), date(2024, 4, 9))


def made(spark, seed, first, last, n=400):
    rng = random.Random(seed)
    span = (last - first).days + 1
    rows = []
    for i in range(n):
        hit = rng.random() < 0.5
        rows.append({
            "game_pk": i % 9, "game_date": first + timedelta(days=rng.randrange(span)), "at_bat_number": i,
            "game_type": "S" if i % 17 == 0 else "R", "batter": rng.randrange(5), "pitcher": rng.randrange(4),
            "pitch_type": rng.choice(["FF", "SL", None]), "release_speed": rng.choice([None, 90.5, 95.25, 88.0]),
            "release_spin_rate": rng.choice([None, *range(1800, 2600, 7)]),
            "launch_speed": 70 + rng.randrange(45) * 1.0 if hit else None, "launch_angle": rng.randrange(-20, 60) if hit else None,
            "launch_speed_angle": rng.randrange(1, 7) if hit and i % 5 else None,
            "events": rng.choice(["single", "walk", None]), "description": "hit_into_play" if hit else "ball",
            "woba_value": rng.choice([None, 0.875]), "woba_denom": rng.choice([None, 0, 1]),
            "estimated_woba_using_speedangle": rng.choice([None, 0.5]),
        })
    return pitches(spark, *rows)


def check(spark, where, rows):
    table = spark.table(str(where.pitches))
    contact = where.read(spark, "contact_days")
    assert rows(states.league_barrel_rate(contact)) == rows(curated.league_barrel_rate(table))
    assert rows(states.exit_velocity_by_season(contact)) == rows(curated.exit_velocity_by_season(table))
    velocity = where.read(spark, "velocity_days")
    assert rows(states.velocity_by_pitch_type(velocity, 10)) == rows(curated.velocity_by_pitch_type(table, 10))
    assert rows(states.pitch_tempo(where.read(spark, "game_days"))) == rows(curated.pitch_tempo(table))
    names = metrics.metrics_of("batter")
    batting = states.batting_metrics(where.read(spark, "batter_days"), 2024, names, 1).withColumn("value", F.round("value", 9))
    assert rows(batting) == rows(metrics.player_metrics(table, names, 2024, 1).withColumn("value", F.round("value", 9)))
    exact = {r.pitch_type: r for r in curated.spin_distribution(table).collect()}
    for r in states.spin_distribution(where.read(spark, "spin_days")).collect():
        values = sorted(x[0] for x in table.where((F.col("game_type") == "R") & F.col("pitch_type").eqNullSafe(F.lit(r.pitch_type)) & F.col(
            "release_spin_rate").isNotNull()).select("release_spin_rate").collect())
        assert (r.avg_spin, r.pitches) == (exact[r.pitch_type].avg_spin, exact[r.pitch_type].pitches)
        for share, value in ((0.5, r.p50), (0.9, r.p90)):
            low, high = (sum(v < value for v in values) / len(values), sum(v <= value for v in values) / len(values))
            assert low <= share + states.RANK_ERROR + 1 / len(values) and high >= share - states.RANK_ERROR - 1 / len(values)


def test_states_equal_a_scan(spark, table, rows):
    where = states.StateTables(table)
    create_table(spark, table, PITCHES)
    assert states.replace_days(made(spark, 1, *YEAR), where, *YEAR) == 400
    check(spark, where, rows)
    # A week with other rows, on fewer days; then the same once more; then a week without rows.
    other = made(spark, 2, WEEK[0], date(2024, 4, 5), 90)
    for _ in range(2):
        states.replace_days(other, where, *WEEK)
        check(spark, where, rows)
    assert states.replace_days(other.where("false"), where, *WEEK) == 0
    check(spark, where, rows)
    states.replace_days(other.where("false"), where, *WEEK, keep_when_empty=False)
    check(spark, where, rows)
    days = {r.game_date for r in where.read(spark, "batter_days").select("game_date").distinct().collect()}
    assert days and not any(WEEK[0] <= d <= WEEK[1] for d in days)


def test_games_of_any_id_are_counted_once(spark, rows):
    ids = [None, 0, -5, 5, 32768, 32769, 2**40, -(2**40), 5, None]
    frame = pitches(spark, *[
        {"game_pk": g, "game_date": date(2024, 4, 1 + i % 3), "pitcher": i % 2, "at_bat_number": i}
        for i, g in enumerate(ids * 3)
    ])
    days = states.game_days(frame)
    assert rows(states.pitch_tempo(days)) == rows(curated.pitch_tempo(frame))
    assert states.pitch_tempo(states.game_days(frame.where("false"))).count() == 0


def test_unknown_metrics_are_refused(spark):
    with pytest.raises(ValueError, match="no state"):
        states.batting_metrics(spark.range(1), 2024, ["wins"])
