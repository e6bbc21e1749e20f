from __future__ import annotations

import copy
import json
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pitchlake.catalog.games import GAMES
from pitchlake.catalog.pitches import PITCHES
from pitchlake.operators.conform import conform, drift, fractions, lost_values
from pitchlake.sources import documents as docs
from pitchlake.sources import leaderboard as boards
from pitchlake.sources.pitches import (
    distinct_games,
    empty_pitches,
    pitch_batch,
    read_landing,
    union_batches,
)

# The second game of a double header, decided in the eleventh; the day of play is the day before in UTC.
LATE = {
    "gamePk": 870431, "season": "2023", "seriesDescription": "Night Series",
    "officialDate": "2023-06-06", "gameDate": "2023-06-07T02:45:00Z",
    "gameType": "R", "doubleHeader": "S", "gameNumber": 2,
    "venue": {"id": 41, "name": "Harbour Field"},
    "status": {"detailedState": "Final", "codedGameState": "F"},
    "teams": {
        "away": {"score": 5, "team": {"name": "Minnesota", "id": 142},
                 "probablePitcher": {"fullName": "R Moss", "id": 55013}},
        "home": {"score": 6, "team": {"name": "Seattle", "id": 136}, "probablePitcher": None},
    },
}
POSTPONED = {
    **LATE, "gamePk": 870499, "gameDate": None, "officialDate": "rain",
    "status": {"codedGameState": "D", "detailedState": "Postponed"}, "venue": None,
    "teams": {
        "away": {"team": {"id": "121"}},
        "home": {"team": {"id": " 143 "}, "probablePitcher": {"id": "55012", "fullName": "Q Vale"}},
    },
}


def changed(**teams):
    game = copy.deepcopy(LATE)
    for side, team in teams.items():
        game["teams"][side]["team"] = team
    return game


def parsed(spark, document, schema):
    text = spark.createDataFrame([(json.dumps(document),)], "text string")
    return docs.parse_documents(text, "text", schema)


def schedule(spark, *games):
    document = {"dates": [{"games": [g]} for g in games]}
    return docs.schedule_games(parsed(spark, document, docs.SCHEDULE))


def test_game_with_a_result(spark):
    found = schedule(spark, LATE)
    assert found.columns == GAMES.names
    row = found.collect()[0]
    assert (row.game_pk, row.season, row.double_header_flag, row.game_number) == (870431, 2023, "S", 2)
    assert (row.home_team_abbrev, row.home_league, row.home_division) == ("SEA", "AL", "West")
    assert (row.away_team_abbrev, row.away_division) == ("MIN", "Central")
    assert (row.final_home_score, row.final_away_score) == (6, 5)
    assert (row.game_date, row.game_datetime) == (date(2023, 6, 6), datetime(2023, 6, 7, 2, 45))
    assert (row.probable_home_pitcher_id, row.probable_away_pitcher_id) == (None, 55013)


def test_game_without_a_day(spark):
    row = schedule(spark, POSTPONED).collect()[0]
    assert (row.status_code, row.status_detail) == ("D", "Postponed")
    assert (row.home_team_id, row.probable_home_pitcher_id, row.probable_home_pitcher_name) == (143, 55012, "Q Vale")
    unknown = (row.final_home_score, row.game_date, row.game_datetime, row.venue_id, row.venue_name)
    assert unknown == (None,) * 5


def landed(spark, schema, *versions):
    """Documents with a version each."""
    text = spark.createDataFrame([(json.dumps(d), v) for v, d in versions], "text string, version long")
    return docs.parse_documents(text, "text", schema, ["version"])


def test_the_newest_entry_of_a_game_counts(spark):
    open_ = {**LATE, "status": {"codedGameState": "S", "detailedState": "Scheduled"}}
    moved = {**LATE, "officialDate": "2023-08-01"}
    found = docs.schedule_games(landed(
        spark, docs.SCHEDULE, (9, {"dates": [{"games": [open_]}, {"games": [moved]}]}), (3, {"dates": [{"games": [open_]}]}),
        (3, {"dates": [{"games": [POSTPONED]}]}),
    ))
    assert sorted((r.game_pk, r.status_code, str(r.game_date)) for r in found.collect()) == [
        (870431, "F", "2023-08-01"), (870499, "D", "None")]


def test_kinds_of_games(spark):
    spring = {**LATE, "gamePk": 1, "gameType": "S"}
    document = {"dates": [{"games": [spring, LATE]}]}
    found = docs.schedule_games(parsed(spark, document, docs.SCHEDULE), docs.INGESTED)
    assert [r.game_pk for r in found.collect()] == [870431]
    assert schedule(spark, spring, LATE).count() == 2


def test_the_newest_box_score_of_a_game_counts(spark, rows):
    found = docs.officials(landed(
        spark, docs.BOXSCORE, (2, {"game_pk": 1, "officials": crew((7, "A", "Home Plate"))}),
        (1, {"game_pk": 1, "officials": crew((8, "B", "Home Plate"), (9, "C", "First Base"))}),
        (2, {"game_pk": 1, "officials": crew((7, "A", "Home Plate"))}),
    ))
    assert rows(found) == [(1, "HP", 7, "A")]


def test_the_newest_standings_of_a_season_count(spark, rows):
    def line(team, wins):
        return {"season": 2023, "records": [{"teamRecords": [{"team": {"id": team}, "wins": wins}]}]}

    found = docs.standings(landed(
        spark, docs.STANDINGS, (5, line(136, 10)), (8, line(136, 90)), (8, line(142, 80)), (5, line(143, 1)),
    )).select("team", "wins")
    assert rows(found) == [("MIN", 80), ("SEA", 90)]


def test_files_have_their_time_as_version(spark, tmp_path):
    import os

    for name, stamp, wins in (("a", 1000, 1), ("b", 500, 2)):
        (tmp_path / f"{name}.json").write_text(json.dumps(
            {"season": 2023, "records": [{"teamRecords": [{"team": {"id": 136}, "wins": wins}]}]}))
        os.utime(tmp_path / f"{name}.json", (stamp, stamp))
    found = docs.standings(docs.read_documents(spark, str(tmp_path), docs.STANDINGS)).collect()
    assert [r.wins for r in found] == [1]


def test_games_without_ids_are_left_out(spark):
    bad = [
        {**LATE, "gamePk": None}, {**LATE, "gamePk": "n/a"},
        changed(home={"name": "nobody"}), changed(away=None), {"gamePk": 5},
    ]
    assert [r.game_pk for r in schedule(spark, *bad, LATE).collect()] == [870431]


def test_unknown_teams(spark):
    found = schedule(
        spark,
        changed(home={"id": 159, "abbreviation": "ALS"}, away={"id": 160, "abbreviation": ""}),
    ).collect()[0]
    assert (found.home_team_abbrev, found.away_team_abbrev) == ("ALS", "UNK")
    assert found.home_league is None
    assert found.away_division is None


@pytest.mark.parametrize("document", [{}, {"dates": []}, {"dates": [{"games": []}]},
                                      {"dates": [{}]}, {"dates": None}])
def test_empty_schedules(spark, document):
    assert docs.schedule_games(parsed(spark, document, docs.SCHEDULE)).count() == 0


def test_seasons_from_files(spark, tmp_path):
    for season in (2023, 2024):
        game = {**LATE, "season": season, "gamePk": season}
        (tmp_path / f"{season}.json").write_text(json.dumps({"dates": [{"games": [game]}]}))
    paths = {s: [str(tmp_path / f"{s}.json")] for s in (2024, 2023)}
    assert {r.season for r in docs.schedule_seasons(spark, paths).collect()} == {2023, 2024}
    assert docs.schedule_seasons(spark, {}).columns == GAMES.names
    with pytest.raises(AnalysisException):
        docs.read_documents(spark, str(tmp_path / "none.json"), docs.SCHEDULE)
    (tmp_path / "pretty.json").write_text(json.dumps({"dates": [{"games": [LATE]}]}, indent=2))
    whole = docs.read_documents(
        spark, str(tmp_path / "pretty.json"), docs.SCHEDULE, one_per_file=True
    )
    assert docs.schedule_games(whole).count() == 1


def crew(*officials):
    return [
        {"official": {"id": i, "fullName": name} if i or name else None, "officialType": title}
        for i, name, title in officials
    ]


def test_officials(spark, rows):
    boxscores = spark.createDataFrame(
        [(json.dumps(d),) for d in (
            {"game_pk": 1, "officials": crew((7, "A", "Home Plate"), (8, None, "First Base"),
                                             (9, "C", "Replay Official"), (None, "D", "Left Field"),
                                             (None, None, "Third Base"))},
            {"game_pk": 2}, {"game_pk": 3, "officials": []},
            {"game_pk": 5, "officials": crew((7, "A", "Home Plate"))},
        )], "text string",
    )
    games = spark.createDataFrame(
        [(1, date(2024, 5, 1))] * 2 + [(g, date(2024, 5, 2)) for g in (2, 3, 4)],
        "game_pk bigint, game_date date",
    )
    found = docs.game_officials(games, docs.parse_documents(boxscores, "text", docs.BOXSCORE))
    assert rows(found) == [
        (1, date(2024, 5, 1), "1B", 8, None), (1, date(2024, 5, 1), "HP", 7, "A"),
    ]
    none = docs.game_officials(
        games.where("false"), docs.parse_documents(boxscores, "text", docs.BOXSCORE)
    )
    assert none.count() == 0
    assert none.columns == ["game_pk", "game_date", "position", "umpire_id", "umpire_name"]


def test_boxscores_named_by_folder(spark, tmp_path):
    folder = tmp_path / "game_pk=42"
    folder.mkdir()
    (folder / "boxscore.json").write_text(json.dumps(
        {"officials": crew((7, "A", "Home Plate"))}, indent=1
    ))
    found = docs.read_documents(spark, str(tmp_path), docs.BOXSCORE, one_per_file=True)
    games = spark.createDataFrame([(42, date(2024, 5, 1))], "game_pk bigint, game_date date")
    assert docs.game_officials(games, found).collect()[0].umpire_id == 7


def test_standings(spark, rows):
    def line(team, wins):
        return {"team": {"id": team}, "wins": wins, "losses": 70, "runsScored": 700,
                "runsAllowed": 650}

    document = {"season": 2024, "records": [
        {"teamRecords": [line(133, 69), line(109, 80), line(999, 1), line(147, 10)]},
        {"teamRecords": [line(147, 94)]}, {"teamRecords": []},
    ]}
    found = docs.standings(parsed(spark, document, docs.STANDINGS))
    assert rows(found) == [
        (2024, "ATH", 69, 70, 700, 650), (2024, "AZ", 80, 70, 700, 650),
        (2024, "NYY", 94, 70, 700, 650),
    ]


def test_pitch_batch_keeps_the_regular_season_of_the_range(spark):
    landed = spark.createDataFrame(
        [(1, date(2024, 5, 1), "R", 174434, 95.5, 1.0), (2, date(2024, 5, 1), "S", 1, 1.0, 1.0),
         (3, date(2024, 4, 30), "R", 1, 1.0, 1.0), (4, date(2024, 5, 2), "R", None, None, 2.0)],
        "game_pk int, game_date date, game_type string, sv_id bigint, launch_speed double,"
        " miss_distance double",
    )
    found = pitch_batch(landed, date(2024, 5, 1), date(2024, 5, 2))
    assert found.columns == PITCHES.names
    assert [f.dataType for f in found.schema] == [f.dataType for f in PITCHES.schema]
    assert [(r.game_pk, r.sv_id) for r in found.orderBy("game_pk").collect()] == [
        (1, "174434"), (4, None),
    ]
    assert drift(landed, PITCHES).unknown == ("miss_distance",)
    assert len(drift(landed, PITCHES).missing) == 113


def test_conform_turns_not_a_number_into_null(spark):
    landed = spark.createDataFrame(
        [(1, float("nan"), float("nan")), (2, 6.0, 90.0)],
        "game_pk bigint, zone double, launch_speed double",
    )
    found = conform(landed, PITCHES).orderBy("game_pk").collect()
    assert (found[0].zone, found[0].launch_speed) == (None, None)
    assert (found[1].zone, found[1].launch_speed) == (6, 90.0)


def test_conform_does_not_cut_fractions(spark, rows):
    landed = spark.createDataFrame(
        [("6.7", 6.7, "9007199254740993"), ("6.0", 6.0, "9007199254740993.0"), ("", None, None)],
        "zone string, inning double, batter string",
    )
    found = conform(landed, PITCHES).select("zone", "inning", "batter")
    assert rows(found) == [(6, 6, 2**53 + 1), (None, None, 2**53 + 1), (None, None, None)]
    assert rows(fractions(landed, PITCHES).where("lost > 0")) == [("inning", 1), ("zone", 1)]


def test_csv_landing(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "launch_speed,game_pk,game_date,game_type,zone,sv_id,extra\n"
        "101.5,7,2024-05-01,R,6.0,151004_174434,x\n,8,2024-05-01,R,,,y\n"
    )
    landed = read_landing(spark, str(tmp_path / "a.csv"), "csv")
    found = pitch_batch(landed, date(2024, 5, 1), date(2024, 5, 1)).orderBy("game_pk").collect()
    assert (found[0].zone, found[0].launch_speed, found[0].sv_id) == (6, 101.5, "151004_174434")
    assert (found[1].zone, found[1].launch_speed, found[1].sv_id) == (None, None, None)


def test_parquet_landing_with_drift(spark, tmp_path):
    one = "SELECT 1L AS game_pk, DATE'2024-05-01' AS game_date, 'R' AS game_type"
    spark.sql(one).write.parquet(str(tmp_path / "a"))
    spark.sql(one + ", 55D AS bat_speed").write.parquet(str(tmp_path / "b"))
    landed = read_landing(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert pitch_batch(landed, date(2024, 5, 1), date(2024, 5, 1)).where(
        F.col("bat_speed") == 55
    ).count() == 1
    # An all-null day lands a text column as numbers.
    spark.sql(one + ", 5L AS sv_id").write.parquet(str(tmp_path / "c"))
    spark.sql(one + ", '151004_174434' AS sv_id").write.parquet(str(tmp_path / "d"))
    day = (date(2024, 5, 1), date(2024, 5, 1))
    both = union_batches([
        pitch_batch(read_landing(spark, str(tmp_path / part)), *day) for part in ("c", "d")
    ])
    assert {r.sv_id for r in both.collect()} == {"5", "151004_174434"}
    assert read_landing(spark, []).columns == empty_pitches(spark).columns
    with pytest.raises(ValueError, match="orc"):
        read_landing(spark, "x", "orc")


def test_batch_filters_reach_the_files(spark, tmp_path):
    spark.sql(
        "SELECT 1L AS game_pk, DATE'2024-05-01' AS game_date, 'R' AS game_type, 1D AS launch_speed"
    ).write.parquet(str(tmp_path / "p"))
    landed = read_landing(spark, str(tmp_path / "p"))
    batch = pitch_batch(landed, date(2024, 5, 1), date(2024, 5, 1)).select("game_pk")
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(game_type,R)" in plan
    assert "GreaterThanOrEqual(game_date" in plan
    assert "launch_speed" not in plan


def test_distinct_games(spark, rows):
    frame = spark.createDataFrame(
        [(1, date(2024, 5, 1))] * 3 + [(2, date(2024, 5, 1))], "game_pk bigint, game_date date"
    )
    assert len(rows(distinct_games(frame))) == 2


def test_leaderboard_units(spark, rows):
    board = spark.createDataFrame(
        [(1, "Doe, J", 60, 8.5, 91.0), (2, None, 10, 5.0, 88.0)],
        "player_id bigint, `last_name, first_name` string, attempts bigint, brl_percent double,"
        " avg_hit_speed double",
    )
    found = boards.expected_values(
        board, ["barrel_rate", "avg_exit_velo"], sample_column="attempts", min_sample=50
    )
    assert rows(found) == [("avg_exit_velo", 1, 91.0), ("barrel_rate", 1, pytest.approx(0.085))]
    assert rows(boards.player_names(board)) == [(1, "Doe, J"), (2, None)]
    second = spark.createDataFrame([(1, 300, 0.4), (2, 20, 0.3)], "player_id bigint, pa bigint, est_woba double")
    both = boards.expected_from([
        boards.Board(board, ("barrel_rate",), "attempts", 5), boards.Board(second, ("xwoba_contact",), "pa", 100),
    ])
    assert [r[:2] for r in rows(both)] == [("barrel_rate", 1), ("barrel_rate", 2), ("xwoba_contact", 1)]


def test_leaderboard_files(spark, tmp_path):
    (tmp_path / "b.csv").write_text('"last_name, first_name",player_id,brl_percent\n"Doe, J",1,8.5\n')
    board = boards.read_leaderboard(spark, str(tmp_path / "b.csv"), "csv")
    assert boards.expected_values(board, ["barrel_rate"]).collect()[0].expected == pytest.approx(
        0.085
    )


def test_standings_of_a_season_in_two_files(spark, rows, tmp_path):
    def line(*teams):
        records = [{"teamRecords": [{"team": {"id": t}, "wins": w} for t, w in teams]}]
        return json.dumps({"season": 2023, "records": records})

    def land(folder, at, **texts):
        (tmp_path / folder).mkdir(exist_ok=True)
        for name, text in texts.items():
            (tmp_path / folder / f"{name}.json").write_text(text)
            os.utime(tmp_path / folder / f"{name}.json", (at, at))
            at += 1

    land("monday", 1000, al=line((136, 1), (142, 2)), nl=line((143, 3)))
    land("tuesday", 2000, al=line((136, 11)), nl=line((143, 13), (144, 14)), cut=line((136, 99))[:40])

    def found():
        read = docs.read_documents(spark, f"{tmp_path}/*", docs.STANDINGS)
        return rows(docs.standings(read).select("team", "wins"))

    # Both leagues of the newest folder, none of the older one's, and nothing of the cut file.
    assert found() == [("ATL", 14), ("PHI", 13), ("SEA", 11)]
    land("wednesday", 3000, cut=line((136, 99))[:40], busy='{"message": "busy"}')
    assert found() == [("ATL", 14), ("PHI", 13), ("SEA", 11)]


def test_conform_makes_what_does_not_fit_null_and_counts_it(spark, rows):
    landed = spark.createDataFrame(
        [("9223372036854775808", 1e30, "abc", "2024-13-45", Decimal("9223372036854775808"), "1e400x"),
         ("9223372036854775807", 6.0, " 7.0 ", "2024-05-01", Decimal("5"), "2.5"),
         ("1e3", float("nan"), "", None, None, " "), (None, None, "6.7", "x", Decimal("-1"), "NaN")],
        "batter string, inning double, zone string, game_date string, pitcher decimal(20,0), release_speed string",
    )
    found = conform(landed, PITCHES).select("batter", "inning", "zone", "pitcher", "release_speed", F.col("game_date").cast("string"))
    kept = [[r[c] for r in found.collect()] for c in ("batter", "inning", "zone", "pitcher", "game_date")]
    assert kept == [[None, 2**63 - 1, 1000, None], [None, 6, None, None], [None, 7, None, None], [None, 5, None, -1], [None, "2024-05-01", None, None]]
    assert dict(tuple(r) for r in lost_values(landed, PITCHES).where("lost > 0").collect()) == {
        "batter": 1, "inning": 1, "zone": 2, "game_date": 2, "pitcher": 1, "release_speed": 1,
    }
    assert lost_values(landed.select(F.lit(1).cast("long").alias("batter")), PITCHES).count() == 0
