"""Pitch-shaped rows made from the given tables.

Every value is a function of one lineitem row (games: of one order key), so the pitch frame is a
plain projection: no shuffle, and a query reads only the lineitem columns it needs. Fractions are
multiples of powers of two, so sums do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.catalog.games import UMPIRE_POSITIONS
from pitchlake.catalog.teams import FEED_ALIASES, TEAMS

TEAM_IDS = [t[0] for t in TEAMS]
TEAM_ABBRS = [t[1] for t in TEAMS]
FEED_ABBRS = [FEED_ALIASES.get(a, a) for a in TEAM_ABBRS]
TITLES = list(UMPIRE_POSITIONS)[:4]


def _pick(values: list, index: Column) -> Column:
    """``values[index]``, counted from zero."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _div(value: Column, by: int) -> Column:
    """Whole-number quotient."""
    return F.call_function("div", value, F.lit(by))


def _array(values: list) -> str:
    return "array(" + ", ".join("NULL" if v is None else repr(v) for v in values) + ")"


_GAME_FACTS = (
    "2022 + game_pk % 4 AS game_year",
    "date_add(make_date(CAST(2022 + game_pk % 4 AS INT), 4, 1),"
    " CAST((game_pk div 4) % 180 AS INT)) AS game_date",
    "CASE WHEN game_pk % 20 = 19 THEN 'S' WHEN game_pk % 40 = 38 THEN 'D' ELSE 'R' END"
    " AS game_type",
    "game_pk % 30 AS home",
    "(game_pk + 1 + (game_pk div 30) % 29) % 30 AS away",
    "1 + (game_pk div 4) % 4 AS away_pace",
    "1 + (game_pk div 16) % 4 AS home_pace",
)
_LINE = (
    "l_orderkey AS k",
    "l_partkey AS pk",
    "l_suppkey AS sk",
    "CAST(l_linenumber AS BIGINT) AS ln",
    "CAST(l_quantity AS BIGINT) AS q",
    "CAST(round(l_discount * 100) AS BIGINT) AS d",
    "CAST(round(l_tax * 100) AS BIGINT) AS t",
    "l_orderkey div 75 AS game_pk",
    "l_orderkey % 75 + 1 AS at_bat_number",
)
_PLACE = (
    "1 + (ln - 1) * 3 + pk % 3 AS pitch_number",
    "(at_bat_number - 1) div 8 + 1 AS inning",
    "((at_bat_number - 1) div 4) % 2 = 0 AS top",
    "(pk + sk) % 4 = 0 AS last",
    "(q + d) % 10 AS v",
)
_SIDES = (
    "if(top, away, home) AS bt",
    "if(top, home, away) AS ft",
    "if(top, away_pace, home_pace) AS bat_pace",
    "if(top, home_pace, away_pace) AS fld_pace",
)
_PLAY = (
    "((at_bat_number - 1) * bat_pace) div 12 AS bat_score",
    "((at_bat_number - 1) * fld_pace) div 12 AS fld_score",
    "((at_bat_number - if(last, 0, 1)) * bat_pace) div 12 AS post_bat_score",
    "CASE WHEN NOT last THEN element_at("
    + _array(["called_strike", "ball", "swinging_strike", "foul", "ball", "foul_tip",
              "blocked_ball"])
    + ", CAST(pk % 7 + 1 AS INT)) WHEN v < 7 THEN 'hit_into_play'"
    " WHEN v = 7 THEN 'swinging_strike' WHEN v = 8 THEN 'ball' ELSE 'called_strike' END"
    " AS description",
    "CASE WHEN NOT last THEN NULL WHEN v < 7 THEN element_at("
    + _array(["field_out"] * 6 + ["single"] * 2 + ["double", "home_run"])
    + ", CAST(pk % 10 + 1 AS INT)) WHEN v = 8 THEN 'walk' ELSE 'strikeout' END AS events",
    "last AND v < 7 AND pk % 50 <> 0 AS contact",
    "1000 + ft * 4 + (inning - 1) div 3 AS pitcher",
    "if(pk % 97 <> 0, 75D + q * 0.5D, NULL) AS release_speed",
)
_PITCH = (
    "game_pk", "game_date", "game_year", "game_type", "at_bat_number", "pitch_number",
    "concat(k, '_', ln) AS sv_id",
    "5000 + bt * 9 + at_bat_number % 9 AS batter",
    "pitcher",
    "concat('Pitcher ', pitcher) AS player_name",
    "9000 + ft * 2 + game_pk % 2 AS fielder_2",
    f"element_at({_array(FEED_ABBRS)}, CAST(home + 1 AS INT)) AS home_team",
    f"element_at({_array(FEED_ABBRS)}, CAST(away + 1 AS INT)) AS away_team",
    "inning",
    "if(top, 'Top', 'Bot') AS inning_topbot",
    "ln % 4 AS balls", "q % 3 AS strikes", "k % 3 AS outs_when_up",
    "if(k % 4 = 0, 5000 + bt * 9, NULL) AS on_1b",
    "if(k % 5 = 0, 5001 + bt * 9, NULL) AS on_2b",
    "if(k % 7 = 0, 5002 + bt * 9, NULL) AS on_3b",
    "if(top, fld_score, bat_score) AS home_score",
    "if(top, bat_score, fld_score) AS away_score",
    "if(top, fld_score, post_bat_score) AS post_home_score",
    "if(top, post_bat_score, fld_score) AS post_away_score",
    "bat_score", "fld_score", "post_bat_score", "fld_score AS post_fld_score",
    "element_at(" + _array(["FF", "SI", "SL", "CH", "CU", "FC", "ST", None])
    + ", CAST(sk % 8 + 1 AS INT)) AS pitch_type",
    "release_speed",
    "release_speed + if(pk % 101 = 0, 20D, 0D) AS effective_speed",
    "if(pk % 89 <> 0, 1500 + pk % 2000, NULL) AS release_spin_rate",
    "CAST(sk % 100 - 20 AS DOUBLE) AS arm_angle",
    "(d - 5) * 0.1875D AS plate_x",
    "1D + t * 0.375D AS plate_z",
    "3.5D AS sz_top", "1.5D AS sz_bot",
    "1 + pk % 14 AS zone",
    "description", "events",
    "if(contact, CAST(60 + q AS DOUBLE), NULL) AS launch_speed",
    "if(contact, pk % 91 - 30, NULL) AS launch_angle",
    "if(contact, 1 + (ln + q) % 6, NULL) AS launch_speed_angle",
    "if(contact, d / 8D, NULL) AS estimated_woba_using_speedangle",
    "CASE WHEN NOT last THEN NULL WHEN v < 7 THEN element_at("
    "array(0D, 0D, 0D, 0D, 0D, 0D, 0.875D, 0.875D, 1.25D, 2D), CAST(pk % 10 + 1 AS INT))"
    " WHEN v = 8 THEN 0.6875D ELSE 0D END AS woba_value",
    "if(last, CAST(if(k % 41 = 0, 0, 1) AS BIGINT), NULL) AS woba_denom",
    "if(game_year >= 2024 AND description IN ('swinging_strike', 'foul', 'hit_into_play'),"
    " 60D + q * 0.5D, NULL) AS bat_speed",
    "if((at_bat_number % 9) % 3 = 0, 'L', 'R') AS stand",
    "CASE WHEN pk % 333 = 0 THEN 'S' WHEN pitcher % 3 = 0 THEN 'L' ELSE 'R' END AS p_throws",
    "if(pk % 500 = 0, pk % 360, NULL) AS spin_dir",
    "CAST(NULL AS BIGINT) AS umpire",
)


def pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .selectExpr(*_LINE)
        .selectExpr("*", *_GAME_FACTS)
        .selectExpr("*", *_PLACE)
        .selectExpr("*", *_SIDES)
        .selectExpr("*", *_PLAY)
        .selectExpr(*_PITCH)
    )


def game_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per game of the orders table, with the facts that depend on the game alone."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    keys = orders.selectExpr("o_orderkey div 75 AS game_pk").groupBy("game_pk").agg(
        F.count("*").alias("appearances")
    )
    return keys.selectExpr("game_pk", "appearances", *_GAME_FACTS)


def schedule_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule documents (text, version), one per game. Some list a second entry without a home team.

    Every third game landed before, when it was still to be played.
    """
    g = F.col("game_pk")
    played = g % 25 != 24

    def side(which: str, pace_turns: int) -> Column:
        index = F.col(which)
        team = F.struct(_pick(TEAM_IDS, index).alias("id"),
                        _pick([t[4] for t in TEAMS], index).alias("name"))
        if which == "away":
            guest = F.struct(F.lit(159).alias("id"), F.lit("All-Stars").alias("name"),
                             F.when(g % 120 != 119, "NLS").alias("abbreviation"))
            known = F.struct(team["id"].alias("id"), team["name"].alias("name"),
                             F.lit(None).cast("string").alias("abbreviation"))
            team = F.when(g % 60 == 59, guest).otherwise(known)
        starter = F.lit(1000) + index * 4
        return F.struct(
            team.alias("team"),
            F.when(played, _div(F.col(f"{which}_pace") * pace_turns, 12)).alias("score"),
            F.when(g % 3 != 0, F.struct(
                starter.alias("id"),
                F.concat(F.lit("Pitcher "), starter).alias("fullName"),
            )).alias("probablePitcher"),
        )

    def game(home: Column) -> Column:
        return F.struct(
            g.alias("gamePk"),
            F.col("game_year").cast("string").alias("season"),
            F.concat(F.col("game_date").cast("string"), F.lit("T"),
                     (F.lit(16) + g % 8).cast("string"), F.lit(":05:00Z")).alias("gameDate"),
            F.col("game_date").cast("string").alias("officialDate"),
            F.col("game_type").alias("gameType"),
            F.when(g % 50 == 0, "Y").otherwise("N").alias("doubleHeader"),
            (F.lit(1) + g % 50 % 2).alias("gameNumber"),
            F.lit("Regular Season").alias("seriesDescription"),
            F.struct(
                F.when(played, "F").otherwise("S").alias("codedGameState"),
                F.when(played, "Final").otherwise("Scheduled").alias("detailedState"),
            ).alias("status"),
            F.struct(home.alias("home"), side("away", 75).alias("away")).alias("teams"),
            F.struct((F.lit(2000) + F.col("home")).alias("id"),
                     F.concat(F.lit("Park "), _pick(TEAM_ABBRS, F.col("home"))).alias("name"))
            .alias("venue"),
        )

    home = side("home", 74)
    whole = F.to_json(game(home))
    broken = F.to_json(game(F.struct(home["score"].alias("score"))))
    entries = F.when(g % 10 == 0, F.concat_ws(",", whole, broken)).otherwise(whole)
    early = F.regexp_replace(entries, '"codedGameState":"F"', '"codedGameState":"S"')
    early = F.regexp_replace(early, '"score":[0-9]+,?', "")
    landed = F.filter(
        F.array(F.struct(entries.alias("entries"), F.lit(2).alias("version")),
                F.when(g % 3 == 1, F.struct(early.alias("entries"), F.lit(1).alias("version")))),
        lambda x: x.isNotNull(),
    )
    return game_keys(spark, sf_dir).select(F.inline(landed)).select(
        F.concat(F.lit('{"dates":[{"games":['), "entries", F.lit("]}]}")).alias("text"), "version"
    )


def umpire_id(game: Column, position: int) -> Column:
    return F.lit(400000) + (game + 5 * position) % 20


def boxscore_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box scores (text, version), one per game; spring games have none.

    Each lists four umpires and a title nobody knows; some lack the id of the last umpire. Every
    fourth landed before with the crew of another game.
    """
    g = F.col("game_pk")

    def official(title: str, who: Column) -> Column:
        return F.struct(
            F.struct(who.alias("id"),
                     F.concat(F.lit("Umpire "), umpire_id(g, 0)).alias("fullName"))
            .alias("official"),
            F.lit(title).alias("officialType"),
        )

    crew = [official(title, umpire_id(g, i)) for i, title in enumerate(TITLES)]
    crew[3] = official(TITLES[3], F.when(g % 7 != 0, umpire_id(g, 3)))
    crew.append(official("Replay Official", umpire_id(g, 4)))
    other = F.array(*[official(title, umpire_id(g + 7, i)) for i, title in enumerate(TITLES)])
    landed = F.filter(
        F.array(F.struct(F.array(*crew).alias("officials"), F.lit(2).alias("version")),
                F.when(g % 4 == 1, F.struct(other.alias("officials"), F.lit(1).alias("version")))),
        lambda x: x.isNotNull(),
    )
    games = game_keys(spark, sf_dir).where(F.col("game_type") != "S")
    return games.select("game_pk", "appearances", F.inline(landed)).select(
        F.to_json(F.struct("game_pk", "appearances", "officials")).alias("text"), "version"
    )


def standings_documents(records: DataFrame, season: int) -> DataFrame:
    """Standings documents (text, version), one per team from its record; an outdated entry comes first.

    An older set of documents of the same season has other wins.
    ``records`` is (id, wins, losses, run_diff). A team nobody knows is listed too.
    """
    pairs = [F.lit(x) for abbr, tid in zip(FEED_ABBRS, TEAM_IDS, strict=True) for x in (abbr, tid)]
    tid = F.element_at(F.create_map(*pairs), F.col("id"))

    def entry(team: Column, wins: Column) -> Column:
        return F.struct(
            F.struct(team.alias("id")).alias("team"),
            wins.alias("wins"),
            F.col("losses").alias("losses"),
            (F.lit(500) + F.col("run_diff") + F.col("wins") % 8).alias("runsScored"),
            F.lit(500).alias("runsAllowed"),
        )

    listed = F.array(
        entry(tid, F.lit(0).cast("bigint")),
        entry(F.lit(999), F.col("wins")),
        entry(tid, F.col("wins") + tid % 3),
    )
    old = F.array(entry(tid, F.col("wins") + 50))
    landed = F.array(
        F.struct(listed.alias("listed"), F.lit(2).alias("version")),
        F.struct(old.alias("listed"), F.lit(1).alias("version")),
    )
    return records.select(F.inline(landed)).select(F.to_json(F.struct(
        F.lit(season).alias("season"),
        F.array(F.struct(F.col("listed").alias("teamRecords"))).alias("records"),
    )).alias("text"), "version")
