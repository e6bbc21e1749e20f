from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from pitchlake.functions import pitch as p
from pitchlake.plans import curated, games
from tests.helpers import pitches


def test_unknown_conditions_count_as_no(spark):
    frame = pitches(
        spark, {"launch_speed": 100.0, "launch_angle": 20}, {"launch_speed": 100.0},
        {"launch_speed": 90.0, "launch_angle": 20}, {"launch_angle": 20},
        {"launch_speed": 100.0, "launch_angle": 20, "game_type": "S"},
    )
    row = curated.league_barrel_rate(frame).collect()[0]
    assert (row.batted_balls, row.barrel_rate) == (3, pytest.approx(1 / 3))


def test_whiff_by_hand_skips_what_is_not_a_swing(spark):
    frame = pitches(
        spark,
        *[{"stand": "L", "description": d} for d in ("swinging_strike", "foul", "ball", None)],
        {"stand": "R", "description": "ball"},
    )
    row = curated.whiff_by_hand(frame).collect()[0]
    assert (row.whiff_vs_L, row.whiff_vs_R) == (0.5, None)


def test_top_lists_break_ties_by_id(spark):
    frame = pitches(spark, *[
        {"batter": b, "launch_speed": s} for b in (5, 3, 9, 1) for s in (96.0, 90.0)
    ])
    found = curated.top_hard_hit(frame, season=2024, min_n=2, limit=3).collect()
    assert [r.batter for r in found] == [1, 3, 5]
    assert curated.top_hard_hit(frame, season=2023, min_n=2).count() == 0
    assert curated.top_hard_hit(frame, season=2024, min_n=3).count() == 0


def test_current_season_is_the_default(spark):
    today = date.today()
    frame = pitches(spark, {"launch_speed": 96.0, "game_year": today.year, "game_date": today},
                    {"launch_speed": 96.0})
    assert curated.top_hard_hit(frame, min_n=1).collect()[0].bbe == 1


def test_season_filter_prunes_day_partitions(spark, tmp_path):
    path = str(tmp_path / "pitches")
    spark.sql(
        "SELECT 1L AS batter, 'R' AS game_type, 95D AS launch_speed, 2024L AS game_year,"
        " DATE'2024-05-01' AS game_date"
    ).write.partitionBy("game_date").parquet(path)
    found = curated.top_hard_hit(spark.read.parquet(path), season=2024, min_n=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(game_date" in plan
    assert found.count() == 1


def test_the_window_ends_today_by_default(spark):
    today = date.today()
    frame = pitches(
        spark, {"description": "ball", "game_date": today, "game_year": today.year},
        {"description": "ball", "game_date": date(2020, 5, 1)},
    )
    assert curated.umpire_called_strikes(frame, min_n=1).collect()[0].sample == 1


def umpire_frame(spark):
    called = {"plate_x": 0.8}
    return pitches(
        spark,
        {**called, "description": "called_strike"}, {**called, "description": "ball"},
        {**called, "description": "ball", "game_pk": 2},
        {**called, "description": "foul", "game_pk": 2},
        {"plate_x": 0.1, "description": "ball", "game_pk": 2},
        {**called, "description": "ball", "game_date": date(2024, 3, 1), "game_pk": 3},
    )


def test_umpire_column_of_the_feed_gives_one_null_group(spark):
    found = curated.umpire_edge_strikes(umpire_frame(spark), min_n=1).collect()
    assert [(r.umpire, r.edge_k_rate, r.sample) for r in found] == [(None, 0.25, 4)]


def test_umpires_from_the_crew_table(spark):
    crew = spark.createDataFrame(
        [(1, date(2024, 5, 1), "HP", 70), (1, date(2024, 5, 1), "1B", 71),
         (2, date(2024, 5, 1), "HP", 70), (3, date(2024, 3, 1), "HP", 72)],
        "game_pk bigint, game_date date, position string, umpire_id bigint",
    )
    edge = curated.umpire_edge_strikes(umpire_frame(spark), crew, min_n=1).collect()
    assert [(r.umpire, r.sample) for r in edge] == [(70, 3), (72, 1)]
    recent = curated.umpire_called_strikes(
        umpire_frame(spark), crew, as_of=date(2024, 5, 31), min_n=1
    ).collect()
    assert [(r.umpire, r.called_k_rate, r.sample) for r in recent] == [(70, 0.25, 4)]
    outside = curated.umpire_called_strikes(
        umpire_frame(spark), crew, as_of=date(2024, 6, 1), min_n=1
    )
    assert outside.count() == 0
    load = games.plate_umpire_workload(umpire_frame(spark), crew.where("umpire_id = 70")).collect()
    assert [tuple(r) for r in load] == [(None, 1, 1), (70, 2, 5)]


def test_starters_equal_the_join(spark, rows):
    outings = []
    for i in range(200):
        outings.append({
            "game_pk": i % 7, "pitcher": i % 5, "inning": 1 + i % 3,
            "launch_speed": None if i % 4 == 0 else 80.0 + i % 16,
            "game_type": "S" if i % 7 == 3 else "R",
        })
    outings += [{"game_pk": None, "pitcher": 1, "launch_speed": 99.0, "inning": 1}]
    frame = pitches(spark, *outings)
    frame.createOrReplaceTempView("starter_pitches")
    joined = spark.sql("""
        SELECT p.pitcher, avg(p.launch_speed) AS avg_ev_allowed, count(*) AS bbe
        FROM starter_pitches p
        JOIN (SELECT DISTINCT game_pk, pitcher FROM starter_pitches WHERE inning = 1) s
          ON p.game_pk = s.game_pk AND p.pitcher = s.pitcher
        WHERE p.launch_speed IS NOT NULL AND p.game_type = 'R'
        GROUP BY p.pitcher HAVING count(*) >= 10""")
    assert rows(curated.starter_exit_velocity(frame, min_n=10)) == rows(joined)
    plan = curated.starter_exit_velocity(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_pitches_per_plate_appearance(spark):
    frame = pitches(
        spark, {}, {}, {}, {"at_bat_number": 2},
        {"at_bat_number": 3, "inning_topbot": "Bot"}, {"game_type": "S"},
    )
    found = {r.batting_team: (r.p_per_pa, r.pa_count)
             for r in curated.pitches_per_plate_appearance(frame).collect()}
    assert found == {"NYY": (2.0, 2), "DET": (1.0, 1)}


def test_spin_percentiles(spark):
    frame = pitches(spark, *[
        {"pitch_type": "FF", "release_spin_rate": n} for n in range(1, 101)
    ], {"pitch_type": None, "release_spin_rate": 7}, {"pitch_type": "SL"})
    exact = {r.pitch_type: (r.p50, r.p90, r.pitches)
             for r in curated.spin_distribution(frame).collect()}
    assert exact == {"FF": (50, 90, 100), None: (7, 7, 1)}
    near = {r.pitch_type: (r.p50, r.p90)
            for r in curated.spin_distribution(frame, accuracy=10000).collect()}
    assert near == {"FF": (50, 90), None: (7, 7)}


def test_usage_shares_add_up(spark):
    frame = pitches(
        spark, *[{"balls": 0, "strikes": 0, "pitch_type": t} for t in ("FF", "FF", "FF", "SL")],
        {"balls": 3, "strikes": 2, "pitch_type": "SL"}, {"balls": 3, "strikes": 2},
    )
    found = [(r.balls, r.pitch_type, r.pct) for r in curated.usage_by_count(frame).collect()]
    assert found == [(0, "FF", 75.0), (0, "SL", 25.0), (3, "SL", 100.0)]


def test_run_expectancy(spark):
    frame = pitches(
        spark,
        {"on_1b": 5, "outs_when_up": 1, "bat_score": 2, "post_bat_score": 4},
        {"on_1b": 6, "outs_when_up": 1, "bat_score": 2, "post_bat_score": 2},
        {"on_1b": 6, "outs_when_up": 1, "bat_score": 0, "post_bat_score": 9, "pitch_number": 2},
    )
    found = [tuple(r) for r in curated.run_expectancy(frame).collect()]
    assert found == [(1, 0, 0, 1, 1.0, 2)]


def test_last_pitch_decides_the_result(spark, rows):
    frame = pitches(
        spark,
        {"pitch_number": 1, "events": "walk"}, {"pitch_number": 3, "events": "single"},
        {"pitch_number": 2}, {"at_bat_number": 2, "pitch_number": 1, "events": "walk"},
        {"at_bat_number": 2, "pitch_number": 2},
    )
    assert rows(games.plate_appearance_results(frame)) == [(1, 1, "single"), (1, 2, None)]
    assert rows(games.result_counts(frame)) == [("single", 1), (None, 1)]


def test_starters(spark):
    frame = pitches(
        spark,
        {"pitcher": 9, "at_bat_number": 5}, {"pitcher": 2, "at_bat_number": 1, "pitch_number": 2},
        {"pitcher": 1, "at_bat_number": 1, "pitch_number": 3},
        {"pitcher": 4, "at_bat_number": 4, "inning_topbot": "Bot"},
        {"pitcher": 8, "game_pk": 2},
    )
    schedule = spark.createDataFrame(
        [(1, 2, 5), (2, None, None), (3, 1, 1)],
        "game_pk bigint, probable_home_pitcher_id bigint, probable_away_pitcher_id bigint",
    )
    found = [tuple(r) for r in games.announced_and_actual_starters(frame, schedule).collect()]
    assert found == [(1, 2, 2, True, 5, 4, False), (2, None, 8, False, None, None, True)]


def test_slate_and_results(spark):
    schedule = spark.createDataFrame(
        [(1, 2024, date(2024, 5, 1), "F", "DET", 3, "NYY", 2, None, None),
         (2, 2024, date(2024, 5, 1), "S", "BOS", None, "TB", None, 7, 8),
         (3, 2024, date(2024, 5, 2), "F", "BOS", 1, "TB", 0, None, None)],
        "game_pk bigint, season bigint, game_date date, status_code string,"
        " home_team_abbrev string, final_home_score bigint, away_team_abbrev string,"
        " final_away_score bigint, probable_home_pitcher_id bigint,"
        " probable_away_pitcher_id bigint",
    )
    assert [r.game_pk for r in games.results_on(schedule, date(2024, 5, 1)).collect()] == [1]
    slate = games.slate_on(schedule, date(2024, 5, 1)).collect()
    assert [(r.game_pk, r.probable_home_pitcher_id) for r in slate] == [(2, 7)]


def test_zone_and_view(spark):
    frame = pitches(
        spark,
        {"plate_x": 0.5, "plate_z": 2.0, "sz_top": 3.5, "sz_bot": 1.5, "stand": "R"},
        {"plate_x": -0.9, "plate_z": 2.0, "sz_top": 3.5, "sz_bot": 1.5, "stand": "L"},
        {"plate_x": 0.5, "plate_z": 4.0, "sz_top": 3.5, "sz_bot": 1.5, "stand": "R"},
    )
    found = frame.select(p.in_strike_zone().alias("z"), p.batter_view_x().alias("x")).collect()
    assert [(r.z, r.x) for r in found] == [(True, -0.5), (False, -0.9), (False, -0.5)]


def test_edges_of_the_plate(spark):
    frame = spark.createDataFrame(
        [(x,) for x in (0.83, -0.83, 0.75, 0.91, 0.9134, 0.7, 0.0)], "plate_x double"
    )
    assert [r.e for r in frame.select(p.on_plate_edge().alias("e")).collect()] == [
        True, True, True, True, False, False, False,
    ]


def test_team_lines(spark):
    frame = pitches(
        spark, {"launch_speed": 100.0, "launch_angle": 10, "estimated_woba_using_speedangle": 1.0},
        {"launch_speed": 80.0, "launch_angle": 20}, {"description": "ball"},
        {"launch_speed": 90.0, "launch_angle": 0, "inning_topbot": "Bot"},
    )
    found = curated.team_game_lines(frame).collect()
    assert [r.batting_team for r in found] == ["DET", "NYY"]
    line = found[1]
    assert (line.barrel_rate, line.hard_hit_pct, line.avg_ev, line.avg_la, line.bbe) == (
        0.5, 0.5, 90.0, 15.0, 2,
    )
    assert line.xwoba_contact == 1.0


def test_tempo_counts_games_once(spark):
    frame = pitches(spark, {}, {}, {"game_pk": 2}, {"game_pk": 3, "game_type": "S"})
    row = curated.pitch_tempo(frame).collect()[0]
    assert (row.pitches, row.games, row.pitches_per_game) == (3, 2, 1.5)


def test_late_and_close_and_two_strikes(spark):
    late = {"inning": 8, "post_bat_score": 3, "woba_value": 0.5, "strikes": 2, "balls": 1}
    frame = pitches(
        spark, {**late, "post_fld_score": 5, "events": "single"},
        {**late, "post_fld_score": 6, "events": "strikeout"},
        {**late, "post_fld_score": None, "events": "walk"},
    )
    close = curated.late_and_close(frame).collect()
    assert [(r.batting_team, r.late_close_woba, r.n) for r in close] == [("NYY", 0.5, 1)]
    row = curated.two_strike_results(frame, min_n=3).collect()[0]
    assert (row.k_rate, row.contact_rate, row.terminal_pas) == (
        pytest.approx(1 / 3), pytest.approx(1 / 3), 3,
    )


def test_expressions_stay_in_generated_code(spark):
    frame = spark.range(1000).select(
        F.col("id").alias("batter"), F.lit("R").alias("game_type"),
        F.lit(2024).alias("game_year"), F.lit(date(2024, 5, 1)).alias("game_date"),
        F.col("id").cast("double").alias("launch_speed"),
    )
    text = curated.top_hard_hit(frame, 2024)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text
    assert "Python" not in text


def test_pitches_without_a_place_never_start(spark):
    frame = pitches(
        spark, {"pitcher": 1, "at_bat_number": 1}, {"pitcher": 2, "at_bat_number": None},
        {"pitcher": 3, "inning_topbot": "Bot", "pitch_number": None},
        {"pitcher": 4, "at_bat_number": 2, "pitch_number": 2**21, "inning_topbot": "Bot"},
        {"pitcher": 5, "at_bat_number": 3, "inning_topbot": "Bot"},
    )
    assert games.actual_starters(frame).collect()[0][1:] == (1, 4)


def test_results_need_no_sort_of_pitches(spark):
    plan = games.plate_appearance_results(pitches(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan[plan.rindex("Exchange"):]
