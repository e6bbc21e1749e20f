from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitchlake.operators.compare import (
    compare,
    overall,
    summarise,
    summarise_metrics,
    top_deltas,
)
from pitchlake.plans.metrics import (
    METRICS,
    MIN_SAMPLE,
    final_scores,
    metric,
    metrics_of,
    player_metric,
    player_metrics,
    team_metric,
    team_records,
)
from pitchlake.plans.verify import metric_names, verify_players, verify_teams
from tests.helpers import pitches

OURS = [(1, 0.240, 100), (2, 0.300, 90), (3, 0.180, None), (4, 0.1, 10), (None, 0.5, 5)]
EXPECTED = [(3, 0.181), (2, 0.310), (1, 0.241), (9, 0.5), (None, 0.5)]


@pytest.fixture
def comparison(spark):
    return compare(
        spark.createDataFrame(OURS, "id bigint, value double, sample_size bigint"),
        spark.createDataFrame(EXPECTED, "id bigint, expected double"),
        0.005,
        spark.createDataFrame([(1, "Doe, J")], "id bigint, name string"),
    )


def test_compare(comparison):
    found = comparison.collect()
    assert [r.entity_id for r in found] == [1, 2, 3]
    assert [r.within_tolerance for r in found] == [True, False, True]
    assert [r.entity_name for r in found] == ["Doe, J", "2", "3"]
    assert [r.sample_size for r in found] == [100, 90, 0]
    assert found[1].diff == pytest.approx(-0.01)


def test_tolerance_is_inclusive_and_unknown_is_outside(spark):
    ours = spark.createDataFrame(
        [("A", 5.0, 1), ("B", 6.0, 1), ("C", None, 1)], "id string, value double, sample_size bigint"
    )
    expected = spark.createDataFrame([("A", 4.0), ("B", 4.0), ("C", 1.0)], "id string, expected double")
    assert [r.within_tolerance for r in compare(ours, expected, 1.0).collect()] == [
        True, False, False,
    ]


def test_summary(comparison):
    row = summarise(comparison).collect()[0]
    assert (row.total_compared, row.within_count, row.passed) == (3, 2, False)
    assert row.pct_within == pytest.approx(2 / 3)
    assert summarise(comparison, 0.5).collect()[0].passed
    none = summarise(comparison.where("false")).collect()[0]
    assert (none.total_compared, none.pct_within, none.passed) == (0, 0.0, False)


def test_summary_by_metric_counts_the_missing_one(spark, comparison):
    named = comparison.withColumn("metric", F.lit("barrel_rate"))
    found = summarise_metrics(named, metric_names(spark, ["barrel_rate", "whiff_rate"]), 0.5)
    assert {r.metric: (r.total_compared, r.passed) for r in found.collect()} == {
        "barrel_rate": (3, True), "whiff_rate": (0, False),
    }
    assert tuple(overall(found).collect()[0]) == (2, False)
    assert tuple(overall(found.where("passed")).collect()[0]) == (1, True)


def test_top_deltas(spark):
    ours = spark.createDataFrame(
        [(i, float(i), 1) for i in range(10)], "id bigint, value double, sample_size bigint"
    )
    expected = spark.range(10).select("id", F.lit(4.5).alias("expected"))
    found = top_deltas(compare(ours, expected, 1.0)).collect()
    assert [r.entity_id for r in found] == [0, 9, 1, 8, 2]


def bbe(**more):
    return {"events": "field_out", "description": "hit_into_play", "launch_speed": 90.0,
            "launch_angle": 10, "launch_speed_angle": 4, "woba_denom": 1, "woba_value": 0.0, **more}


def test_batting_metrics_by_hand(spark):
    frame = pitches(
        spark,
        bbe(launch_speed_angle=6, launch_speed=100.0, launch_angle=30, woba_value=2.0,
            estimated_woba_using_speedangle=1.5),
        bbe(launch_speed=95.0, launch_angle=-10, estimated_woba_using_speedangle=None),
        bbe(launch_speed=None, launch_angle=None),
        {"description": "swinging_strike", "events": "strikeout", "woba_denom": 1,
         "woba_value": 0.0},
        {"description": "ball", "events": "walk", "woba_denom": 1, "woba_value": 0.7},
        {"description": "foul", "events": "sac_bunt", "woba_denom": 0, "woba_value": 0.9},
        {"description": "ball"},
        bbe(game_type="S"), bbe(game_year=2023),
        bbe(launch_speed=120.0, launch_speed_angle=None),
    )
    found = {
        r.metric: (r.value, r.sample_size)
        for r in player_metrics(frame, metrics_of("batter"), 2024, 1).collect()
    }
    assert found["barrel_rate"] == (pytest.approx(1 / 3), 3)
    assert found["hard_hit_pct"] == (1.0, 2)
    assert found["avg_exit_velo"] == (97.5, 2)
    assert found["avg_launch_angle"] == (10.0, 2)
    assert found["xwoba_contact"] == (pytest.approx((1.5 + 0.7) / 6), 6)


def test_xwoba_without_counting_appearances(spark):
    frame = pitches(spark, {"description": "foul", "events": "sac_bunt", "woba_denom": 0})
    row = player_metric(frame, "xwoba_contact", 2024, 0).collect()[0]
    assert (row.value, row.sample_size) == (None, 0)


def test_whiff_rate(spark):
    frame = pitches(spark, *[
        {"description": d} for d in ("swinging_strike", "foul_tip", "foul", "hit_into_play", "ball",
                                     "swinging_strike_blocked", "missed_bunt", "foul_bunt", None)
    ])
    row = player_metric(frame, "whiff_rate", 2024, 1).collect()[0]
    assert (row.id, row.value, row.sample_size) == (20, pytest.approx(4 / 6), 6)
    assert player_metric(frame, "whiff_rate", 2024, 7).count() == 0


def test_one_scan_equals_single_metrics(spark, rows):
    frame = pitches(spark, *[
        bbe(batter=i % 3, launch_speed=80.0 + i, launch_speed_angle=1 + i % 6,
            launch_angle=i, estimated_woba_using_speedangle=i / 8) for i in range(24)
    ], {"batter": 7, "events": "walk", "woba_denom": 1})
    for floor in (0, 5):
        fused = player_metrics(frame, metrics_of("batter"), 2024, floor)
        for name in metrics_of("batter"):
            alone = player_metric(frame, name, 2024, floor)
            assert rows(fused.where(F.col("metric") == name).drop("metric")) == rows(alone), name


def test_unknown_metrics(spark):
    with pytest.raises(ValueError, match="unsupported metric 'era'"):
        metric("era")
    with pytest.raises(ValueError, match="choices"):
        player_metrics(pitches(spark, {}), ["barrel_rate", "whiff_rate"], 2024)
    with pytest.raises(ValueError, match="barrel_rate"):
        team_metric(pitches(spark, {}), "barrel_rate", 2024)
    assert MIN_SAMPLE == {"batter": 50, "pitcher": 20, "team": 1}
    assert METRICS["run_diff"].tolerance == 5.0


def final(game, home, away, home_runs, away_runs, half="Top", **more):
    bat, fld = (away_runs, home_runs) if half == "Top" else (home_runs, away_runs)
    return {"game_pk": game, "home_team": home, "away_team": away, "inning_topbot": half,
            "post_bat_score": bat, "post_fld_score": fld, **more}


def team_frame(spark):
    return pitches(
        spark,
        final(1, "DET", "NYY", 0, 9, at_bat_number=70, pitch_number=9),
        final(1, "DET", "NYY", 3, 2, "Bot", at_bat_number=71, pitch_number=2),
        final(1, "DET", "NYY", 1, 2, "Bot", at_bat_number=71, pitch_number=1),
        final(2, "NYY", "DET", 4, 4),
        final(3, "NYY", "DET", 1, 8, "Bot"),
        final(4, "NYY", "DET", 9, 0, game_type="S"),
    )


def test_team_records(spark, rows):
    assert rows(final_scores(team_frame(spark), 2024)) == [
        (1, "DET", "NYY", 3, 2), (2, "NYY", "DET", 4, 4), (3, "NYY", "DET", 1, 8),
    ]
    assert rows(team_records(team_frame(spark), 2024)) == [
        ("DET", 2, 0, 8, 3), ("NYY", 0, 2, -8, 3),
    ]
    assert rows(team_metric(team_frame(spark), "run_diff", 2024)) == [
        ("DET", 8.0, 3), ("NYY", -8.0, 3),
    ]
    assert team_metric(team_frame(spark), "wins", 2024, 4).count() == 0


def test_a_game_whose_labels_change_counts_once(spark, rows):
    frame = pitches(
        spark,
        final(1, "OAK", "NYY", 1, 0, at_bat_number=1),
        final(1, "ATH", "NYY", 2, 0, at_bat_number=2),
    )
    assert rows(final_scores(frame, 2024)) == [(1, "ATH", "NYY", 2, 0)]


def test_final_scores_do_not_sort_pitches(spark):
    plan = final_scores(team_frame(spark), 2024)._jdf.queryExecution().executedPlan().toString()
    below_first_shuffle = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "HashAggregate" in below_first_shuffle
    assert "Sort" not in below_first_shuffle
    assert "SortAggregate" not in below_first_shuffle


def test_verify_teams(spark):
    table = spark.createDataFrame(
        [(2024, "DET", 3, 0, 158, 147), (2024, "NYY", 0, 4, 100, 118)],
        "season bigint, team string, wins bigint, losses bigint, runs_scored bigint,"
        " runs_allowed bigint",
    )
    found = {
        (r.metric, r.entity_id): (r.within_tolerance, r.entity_name)
        for r in verify_teams(team_frame(spark), table, 2024).collect()
    }
    assert found["wins", "DET"] == (True, "Detroit Tigers")
    assert found["losses", "NYY"][0] is False
    assert found["run_diff", "DET"][0] is True
    assert found["run_diff", "NYY"][0] is False


def test_verify_players(spark):
    frame = pitches(spark, bbe(launch_speed_angle=6), bbe())
    expected = spark.createDataFrame(
        [("barrel_rate", 10, 0.5), ("avg_exit_velo", 10, 89.0), ("avg_exit_velo", 11, 1.0)],
        "metric string, id bigint, expected double",
    )
    found = {
        r.metric: r.within_tolerance
        for r in verify_players(frame, expected, "batter", 2024, min_n=1).collect()
    }
    assert found == {"barrel_rate": True, "avg_exit_velo": False}
    wide = verify_players(
        frame, expected, "batter", 2024, ["avg_exit_velo"], min_n=1, tolerance=1.0
    )
    assert [r.within_tolerance for r in wide.collect()] == [True]
    with pytest.raises(ValueError, match="unsupported"):
        verify_players(frame, expected, "batter", 2024, ["whiff_rate"])


def test_large_and_missing_numbers_keep_their_order(spark, rows):
    frame = pitches(
        spark,
        {"game_pk": 1, "at_bat_number": 1, "pitch_number": 2**20 - 1, "post_fld_score": 9, "post_bat_score": 0},
        {"game_pk": 1, "at_bat_number": 1, "pitch_number": 2**20 + 5, "post_fld_score": 3, "post_bat_score": 0},
        {"game_pk": 2, "at_bat_number": None, "pitch_number": 7, "post_fld_score": 8, "post_bat_score": 1},
        {"game_pk": 2, "at_bat_number": 3, "pitch_number": None, "post_fld_score": 2000, "post_bat_score": 1},
    )
    assert [r[:1] + r[3:] for r in rows(final_scores(frame, 2024))] == [(1, 3, 0), (2, 2000, 1)]
    broken = pitches(spark, {"at_bat_number": -1})
    with pytest.raises(Exception, match="cannot be ordered"):
        final_scores(broken, 2024).collect()


def test_teams_are_compared_with_their_own_season(spark):
    lines = [(y, "DET", 1, 0, 5, 1) for y in (2023, 2024)]
    board = spark.createDataFrame(lines, "season long, team string, wins long, losses long, runs_scored long, runs_allowed long")
    found = verify_teams(team_frame(spark), board, 2024, names=["wins"], min_n=0)
    assert found.groupBy("entity_id").count().where("count > 1").count() == 0
