from __future__ import annotations

import pytest

from pitchlake.catalog.columns import TAG_GROUPS, Column, TableLayout, tagged
from pitchlake.catalog.games import GAMES, UMPIRE_POSITIONS, UMPIRES
from pitchlake.catalog.pitches import PITCHES
from pitchlake.catalog.support import DICTIONARY, RUNS
from pitchlake.catalog.teams import TEAMS, teams


@pytest.mark.parametrize(
    ("layout", "count"), [(PITCHES, 118), (GAMES, 26), (UMPIRES, 5), (RUNS, 9), (DICTIONARY, 12)]
)
def test_column_counts(layout, count):
    assert len(layout.columns) == count


def test_pitch_types_that_are_easy_to_get_wrong():
    assert PITCHES["sv_id"].dtype == "string"
    assert PITCHES["launch_angle"].dtype == "bigint"
    assert PITCHES["release_spin_rate"].dtype == "bigint"
    for name in ("bat_speed", "swing_length", "attack_angle", "attack_direction",
                 "swing_path_tilt", "hyper_speed"):
        assert PITCHES[name].dtype == "double"


def test_required_columns():
    assert [c.name for c in PITCHES.columns if c.required] == ["game_pk", "game_date", "game_year"]
    assert PITCHES.schema["game_pk"].nullable is False
    assert PITCHES.schema["batter"].nullable is True


def test_every_pitch_tag_is_a_known_group():
    for column in PITCHES.columns:
        assert column.tags
        assert set(column.tags) <= set(TAG_GROUPS), column.name
    assert [c.name for c in tagged(PITCHES.columns, "team")] == ["home_team", "away_team"]


def test_bad_columns_are_refused():
    with pytest.raises(ValueError, match="unknown type"):
        Column("x", "int128", (), "something")
    with pytest.raises(ValueError, match="description"):
        Column("x", "bigint", (), "  ")
    twice = Column("x", "bigint", (), "something")
    with pytest.raises(ValueError, match="unique"):
        TableLayout((twice, twice), "comment")
    with pytest.raises(ValueError, match="unknown columns"):
        TableLayout((twice,), "comment", partition_by=("y",))


def test_definition_states_the_rules():
    text = PITCHES["balls"].definition
    assert "Between 0 and 3" in text
    assert "One of L, R" in PITCHES["stand"].definition
    assert "2017" in PITCHES["umpire"].definition


def test_layouts():
    assert PITCHES.partition_by == ("game_date",)
    assert PITCHES.cluster_by == ("home_team", "away_team", "game_pk")
    assert UMPIRES.key == ("game_pk", "position")
    assert GAMES.partition_by == ("season",)


def test_teams(spark):
    assert len(TEAMS) == 30
    assert len({(league, division) for _, _, league, division, _ in TEAMS}) == 6
    found = {r.abbr: r.feed_abbr for r in teams(spark).collect()}
    assert found["OAK"] == "ATH"
    assert found["ARI"] == "AZ"
    assert found["NYY"] == "NYY"
    assert set(UMPIRE_POSITIONS.values()) == {"HP", "1B", "2B", "3B", "LF", "RF"}
