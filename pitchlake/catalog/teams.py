"""The thirty teams as a small dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Id, abbreviation, league, division and name of each team.
TEAMS = (
    (108, "LAA", "AL", "West", "Los Angeles Angels"),
    (109, "ARI", "NL", "West", "Arizona Diamondbacks"),
    (110, "BAL", "AL", "East", "Baltimore Orioles"),
    (111, "BOS", "AL", "East", "Boston Red Sox"),
    (112, "CHC", "NL", "Central", "Chicago Cubs"),
    (113, "CIN", "NL", "Central", "Cincinnati Reds"),
    (114, "CLE", "AL", "Central", "Cleveland Guardians"),
    (115, "COL", "NL", "West", "Colorado Rockies"),
    (116, "DET", "AL", "Central", "Detroit Tigers"),
    (117, "HOU", "AL", "West", "Houston Astros"),
    (118, "KC", "AL", "Central", "Kansas City Royals"),
    (119, "LAD", "NL", "West", "Los Angeles Dodgers"),
    (120, "WSH", "NL", "East", "Washington Nationals"),
    (121, "NYM", "NL", "East", "New York Mets"),
    (133, "OAK", "AL", "West", "Oakland Athletics"),
    (134, "PIT", "NL", "Central", "Pittsburgh Pirates"),
    (135, "SD", "NL", "West", "San Diego Padres"),
    (136, "SEA", "AL", "West", "Seattle Mariners"),
    (137, "SF", "NL", "West", "San Francisco Giants"),
    (138, "STL", "NL", "Central", "St. Louis Cardinals"),
    (139, "TB", "AL", "East", "Tampa Bay Rays"),
    (140, "TEX", "AL", "West", "Texas Rangers"),
    (141, "TOR", "AL", "East", "Toronto Blue Jays"),
    (142, "MIN", "AL", "Central", "Minnesota Twins"),
    (143, "PHI", "NL", "East", "Philadelphia Phillies"),
    (144, "ATL", "NL", "East", "Atlanta Braves"),
    (145, "CWS", "AL", "Central", "Chicago White Sox"),
    (146, "MIA", "NL", "East", "Miami Marlins"),
    (147, "NYY", "AL", "East", "New York Yankees"),
    (158, "MIL", "NL", "Central", "Milwaukee Brewers"),
)

# Schedule abbreviation -> abbreviation in the pitch feed.
FEED_ALIASES = {"OAK": "ATH", "ARI": "AZ"}


def feed_abbreviation(abbr: Column) -> Column:
    """The pitch feed's spelling of a schedule abbreviation."""
    pairs = [F.lit(x) for pair in FEED_ALIASES.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), abbr), abbr)


def teams(spark: SparkSession) -> DataFrame:
    """Thirty rows (team_id, abbr, league, division, full_name, feed_abbr).

    The size is fixed by the list above, so joins may broadcast it without a check.
    """
    rows = ", ".join(str(team) for team in TEAMS)
    frame = spark.sql(
        f"SELECT CAST(team_id AS BIGINT) AS team_id, abbr, league, division, full_name"
        f" FROM VALUES {rows} AS t(team_id, abbr, league, division, full_name)"
    )
    return frame.withColumn("feed_abbr", feed_abbreviation(F.col("abbr")))
