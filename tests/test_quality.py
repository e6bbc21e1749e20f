from __future__ import annotations

from datetime import date

import pytest

from pitchlake.catalog.games import UMPIRES
from pitchlake.catalog.pitches import PITCHES
from pitchlake.catalog.support import DICTIONARY
from pitchlake.operators import quality
from pitchlake.operators.conform import conform
from tests.helpers import pitches


def violations(frame, *kinds):
    found = quality.check_columns(frame, PITCHES, kinds).collect()
    return {r.column_name: r.violations for r in found if r.violations}


def test_rules(spark):
    frame = pitches(
        spark,
        {"balls": 4, "stand": "S", "spin_dir": 3}, {"game_pk": None, "balls": 3, "stand": "L"},
        {"release_speed": 49.9}, {"release_speed": 50.0, "home_score_diff": -31},
        {"spin_dir": 5, "game_year": 2016}, {"description": "wild"},
    )
    assert violations(frame, "not_null") == {"game_pk": 1}
    assert violations(frame, "valid_range") == {
        "balls": 1, "release_speed": 1, "home_score_diff": 1,
    }
    assert violations(frame, "valid_values") == {"stand": 1, "description": 1}
    assert violations(frame, "deprecated") == {"spin_dir": 1}
    with pytest.raises(ValueError, match="fresh"):
        quality.check_columns(frame, PITCHES, ["fresh"])


def test_rules_of_a_partial_frame(spark):
    frame = pitches(spark, {}).select("balls")
    assert quality.check_columns(frame, PITCHES, ["valid_range"]).count() == 1
    assert quality.check_columns(frame, PITCHES, ["not_null"]).count() == 0


def test_duplicates(spark, rows):
    frame = pitches(spark, {}, {}, {"pitch_number": 2}, {"game_pk": 2})
    assert rows(quality.duplicates(frame, PITCHES)) == [(1, 1, 1, 2)]
    crew = spark.createDataFrame([(1, "HP"), (1, "1B"), (1, "HP")], "game_pk bigint, position string")
    assert rows(quality.duplicates(crew, UMPIRES)) == [(1, "HP", 2)]


def test_profile(spark):
    frame = pitches(spark, {"balls": 1}, {"balls": 3}, {"stand": "L"}, {})
    found = {r.column_name: r for r in quality.profile(frame, PITCHES).collect()}
    assert len(found) == 118
    assert tuple(found["balls"])[2:] == (4, 2, 0.5, "1", "3")
    assert tuple(found["stand"])[2:] == (4, 1, 0.75, "L", "L")
    assert tuple(found["umpire"])[2:] == (4, 0, 1.0, None, None)
    assert found["game_date"].min_value == "2024-05-01"
    empty = quality.profile(frame.where("false"), PITCHES).collect()
    assert {r.null_share for r in empty} == {None}


def test_completeness(spark, rows):
    played = pitches(spark, {}, {}, {"game_pk": 2})
    schedule = spark.createDataFrame(
        [(g, date(2024, 5, 1), t, s) for g, t, s in
         ((1, "R", "F"), (3, "R", "F"), (4, "R", "S"), (5, "D", "F"))],
        "game_pk bigint, game_date date, game_type string, status_code string",
    )
    assert rows(quality.games_without_pitches(schedule, played)) == [(3, date(2024, 5, 1), "R")]
    crew = spark.createDataFrame([(1, "HP"), (2, "1B")], "game_pk bigint, position string")
    assert rows(quality.games_without_plate_umpire(played, crew)) == [(2, date(2024, 5, 1))]


def test_profile_counts_arrays_in_two_passes(spark):
    frame = spark.createDataFrame([("a", ["x"]), ("b", None)], "dtype string, tags array<string>")
    found = quality.profile(frame, DICTIONARY)
    assert sorted((r.column_name, r.row_count, r.non_null, r.min_value) for r in found.collect()) == [
        ("dtype", 2, 2, "a"), ("tags", 2, 1, None)]
    everything = conform(frame, PITCHES)
    plan = quality.profile(everything, PITCHES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 2
