"""The game schedule and the umpire crews."""

from __future__ import annotations

from pitchlake.catalog.columns import Column, TableLayout

# Columns of the schedule.
GAMES = TableLayout(
    columns=(
        Column("game_pk", "bigint", ("identifier",), "League-wide id of the game.", required=True),
        Column("season", "bigint", ("temporal",), "Season; splits the table.", required=True,
               low=2015, high=2099),
        Column("game_date", "date", ("temporal", "partition_key"), "Official day of the game.",
               required=True),
        Column("game_datetime", "timestamp", ("temporal",), "Scheduled start, UTC.",
               required=True),
        Column("game_type", "string", ("category",), "Kind of game.", required=True,
               allowed=("R", "P", "F", "D", "L", "W")),
        Column("status_code", "string", ("category",),
               "State of the game: F finished, S scheduled.", required=True),
        Column("status_detail", "string", ("display_name",), "State of the game in words.",
               required=True),
        Column("home_team_id", "bigint", ("identifier", "team"), "Home team id.", required=True),
        Column("home_team_abbrev", "string", ("display_name", "team"), "Home abbreviation.",
               required=True),
        Column("home_league", "string", ("category", "team"), "Home league.",
               allowed=("AL", "NL")),
        Column("home_division", "string", ("category", "team"), "Home division.",
               allowed=("East", "Central", "West")),
        Column("away_team_id", "bigint", ("identifier", "team"), "Visitor id.", required=True),
        Column("away_team_abbrev", "string", ("display_name", "team"), "Visitor abbreviation.",
               required=True),
        Column("away_league", "string", ("category", "team"), "Visitor league.",
               allowed=("AL", "NL")),
        Column("away_division", "string", ("category", "team"), "Visitor division.",
               allowed=("East", "Central", "West")),
        Column("venue_id", "bigint", ("identifier",), "Ballpark id."),
        Column("venue_name", "string", ("display_name",), "Ballpark."),
        Column("probable_home_pitcher_id", "bigint", ("identifier", "pitcher"),
               "Announced home starter; who really started is in the pitches."),
        Column("probable_home_pitcher_name", "string", ("display_name", "pitcher"),
               "Name of the announced home starter."),
        Column("probable_away_pitcher_id", "bigint", ("identifier", "pitcher"),
               "Announced visiting starter."),
        Column("probable_away_pitcher_name", "string", ("display_name", "pitcher"),
               "Name of the announced visiting starter."),
        Column("final_home_score", "bigint", ("outcome_game",), "Home runs; null until played.",
               low=0, high=60),
        Column("final_away_score", "bigint", ("outcome_game",), "Visitor runs; null until played.",
               low=0, high=60),
        Column("double_header_flag", "string", ("category",), "Kind of double header.",
               allowed=("N", "Y", "S")),
        Column("game_number", "bigint", ("identifier",), "Game of the day for the two teams.",
               low=1, high=2),
        Column("series_description", "string", ("display_name",), "Name of the series."),
    ),
    comment="Game schedule, regular season and postseason, one row per game.",
    partition_by=("season",),
    cluster_by=("game_date", "game_type", "home_team_id"),
    key=("game_pk",),
)

# Columns of the umpire crews.
UMPIRES = TableLayout(
    columns=(
        Column("game_pk", "bigint", ("identifier",), "Game the crew worked.", required=True),
        Column("game_date", "date", ("temporal", "partition_key"),
               "Day of the game, as in the pitch table.", required=True),
        Column("position", "string", ("category",), "Where the umpire stood; HP is home plate.",
               required=True, allowed=("HP", "1B", "2B", "3B", "LF", "RF")),
        Column("umpire_id", "bigint", ("identifier",), "Umpire id.", required=True),
        Column("umpire_name", "string", ("display_name",), "Umpire name."),
    ),
    comment="Umpire crew of each game, one row per game and position.",
    partition_by=("game_date",),
    cluster_by=("game_pk",),
    key=("game_pk", "position"),
)

# officials' titles in landed box scores and their short codes.
UMPIRE_POSITIONS = {
    "Home Plate": "HP",
    "First Base": "1B",
    "Second Base": "2B",
    "Third Base": "3B",
    "Left Field": "LF",
    "Right Field": "RF",
}
