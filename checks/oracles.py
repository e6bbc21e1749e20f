"""The SQL each registered query is checked against, for the given tables.

``SAMPLE`` states the same rows as ``checks.sample`` in SQL; every other text is written against
it and independent of the library.
"""

from __future__ import annotations

from checks.sample import FEED_ABBRS, TEAM_ABBRS, TEAM_IDS, TITLES
from pitchlake.catalog.columns import TableLayout
from pitchlake.catalog.games import GAMES, UMPIRE_POSITIONS, UMPIRES
from pitchlake.catalog.pitches import PITCHES
from pitchlake.catalog.teams import TEAMS


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


_FACTS = """
  2022 + game_pk % 4 AS game_year,
  CAST(make_date(CAST(2022 + game_pk % 4 AS INT), 4, 1)
       + CAST((game_pk // 4) % 180 AS INT) AS DATE) AS game_date,
  CASE WHEN game_pk % 20 = 19 THEN 'S' WHEN game_pk % 40 = 38 THEN 'D' ELSE 'R' END AS game_type,
  game_pk % 30 AS home, (game_pk + 1 + (game_pk // 30) % 29) % 30 AS away,
  1 + (game_pk // 4) % 4 AS away_pace, 1 + (game_pk // 16) % 4 AS home_pace
"""

SAMPLE = f"""
line AS (
  SELECT l_orderkey AS k, l_partkey AS pk, l_suppkey AS sk, CAST(l_linenumber AS BIGINT) AS ln,
         CAST(l_quantity AS BIGINT) AS q, CAST(round(l_discount * 100) AS BIGINT) AS d,
         CAST(round(l_tax * 100) AS BIGINT) AS t
  FROM lineitem),
keyed AS (
  SELECT *, k // 75 AS game_pk, k % 75 + 1 AS at_bat_number FROM line),
base AS (
  SELECT *, {_FACTS},
         1 + (ln - 1) * 3 + pk % 3 AS pitch_number,
         (at_bat_number - 1) // 8 + 1 AS inning,
         CASE WHEN ((at_bat_number - 1) // 4) % 2 = 0 THEN 'Top' ELSE 'Bot' END AS inning_topbot,
         (pk + sk) % 4 = 0 AS last_one, (q + d) % 10 AS v
  FROM keyed),
acts AS (
  SELECT *,
    CASE WHEN inning_topbot = 'Top' THEN away ELSE home END AS bt,
    CASE WHEN inning_topbot = 'Top' THEN home ELSE away END AS ft,
    (at_bat_number - 1) * home_pace // 12 AS home_score,
    (at_bat_number - 1) * away_pace // 12 AS away_score,
    (at_bat_number - CASE WHEN last_one AND inning_topbot = 'Bot' THEN 0 ELSE 1 END)
      * home_pace // 12 AS post_home_score,
    (at_bat_number - CASE WHEN last_one AND inning_topbot = 'Top' THEN 0 ELSE 1 END)
      * away_pace // 12 AS post_away_score,
    CASE WHEN NOT last_one THEN ['called_strike','ball','swinging_strike','foul','ball','foul_tip',
                                 'blocked_ball'][pk % 7 + 1]
         WHEN v < 7 THEN 'hit_into_play' WHEN v = 7 THEN 'swinging_strike'
         WHEN v = 8 THEN 'ball' ELSE 'called_strike' END AS description,
    CASE WHEN NOT last_one THEN NULL
         WHEN v < 7 THEN CASE WHEN pk % 10 <= 5 THEN 'field_out' WHEN pk % 10 <= 7 THEN 'single'
                              WHEN pk % 10 = 8 THEN 'double' ELSE 'home_run' END
         WHEN v = 8 THEN 'walk' ELSE 'strikeout' END AS events,
    last_one AND v < 7 AND pk % 50 <> 0 AS contact
  FROM base),
pitches AS (
  SELECT game_pk, game_date, game_year, game_type, at_bat_number, pitch_number,
    CAST(k AS VARCHAR) || '_' || CAST(ln AS VARCHAR) AS sv_id,
    5000 + bt * 9 + at_bat_number % 9 AS batter,
    1000 + ft * 4 + (inning - 1) // 3 AS pitcher,
    'Pitcher ' || CAST(1000 + ft * 4 + (inning - 1) // 3 AS VARCHAR) AS player_name,
    9000 + ft * 2 + game_pk % 2 AS fielder_2,
    {_list(FEED_ABBRS)}[home + 1] AS home_team, {_list(FEED_ABBRS)}[away + 1] AS away_team,
    inning, inning_topbot, ln % 4 AS balls, q % 3 AS strikes, k % 3 AS outs_when_up,
    CASE WHEN k % 4 = 0 THEN 5000 + bt * 9 END AS on_1b,
    CASE WHEN k % 5 = 0 THEN 5001 + bt * 9 END AS on_2b,
    CASE WHEN k % 7 = 0 THEN 5002 + bt * 9 END AS on_3b,
    home_score, away_score, post_home_score, post_away_score,
    CASE WHEN inning_topbot = 'Top' THEN away_score ELSE home_score END AS bat_score,
    CASE WHEN inning_topbot = 'Top' THEN home_score ELSE away_score END AS fld_score,
    CASE WHEN inning_topbot = 'Top' THEN post_away_score ELSE post_home_score END
      AS post_bat_score,
    CASE WHEN inning_topbot = 'Top' THEN post_home_score ELSE post_away_score END
      AS post_fld_score,
    ['FF','SI','SL','CH','CU','FC','ST',NULL][sk % 8 + 1] AS pitch_type,
    CASE WHEN pk % 97 <> 0 THEN 75e0 + q * 0.5e0 END AS release_speed,
    CASE WHEN pk % 97 <> 0 THEN 75e0 + q * 0.5e0 END
      + CASE WHEN pk % 101 = 0 THEN 20e0 ELSE 0e0 END AS effective_speed,
    CASE WHEN pk % 89 <> 0 THEN 1500 + pk % 2000 END AS release_spin_rate,
    CAST(sk % 100 - 20 AS DOUBLE) AS arm_angle,
    (d - 5) * 0.1875e0 AS plate_x, 1e0 + t * 0.375e0 AS plate_z, 3.5e0 AS sz_top, 1.5e0 AS sz_bot,
    1 + pk % 14 AS zone, description, events,
    CASE WHEN contact THEN CAST(60 + q AS DOUBLE) END AS launch_speed,
    CASE WHEN contact THEN pk % 91 - 30 END AS launch_angle,
    CASE WHEN contact THEN 1 + (ln + q) % 6 END AS launch_speed_angle,
    CASE WHEN contact THEN d / 8e0 END AS estimated_woba_using_speedangle,
    CASE events WHEN 'single' THEN 0.875e0 WHEN 'double' THEN 1.25e0 WHEN 'home_run' THEN 2e0
                WHEN 'walk' THEN 0.6875e0 WHEN 'field_out' THEN 0e0 WHEN 'strikeout' THEN 0e0 END
      AS woba_value,
    CASE WHEN last_one THEN CASE WHEN k % 41 = 0 THEN 0 ELSE 1 END END AS woba_denom,
    CASE WHEN game_year >= 2024 AND description IN ('swinging_strike','foul','hit_into_play')
         THEN 60e0 + q * 0.5e0 END AS bat_speed,
    CASE WHEN (at_bat_number % 9) % 3 = 0 THEN 'L' ELSE 'R' END AS stand,
    CASE WHEN pk % 333 = 0 THEN 'S'
         WHEN (1000 + ft * 4 + (inning - 1) // 3) % 3 = 0 THEN 'L' ELSE 'R' END AS p_throws,
    CASE WHEN pk % 500 = 0 THEN pk % 360 END AS spin_dir,
    CAST(NULL AS BIGINT) AS umpire,
    CASE WHEN inning_topbot = 'Top' THEN {_list(FEED_ABBRS)}[away + 1]
         ELSE {_list(FEED_ABBRS)}[home + 1] END AS batting_team
  FROM acts)
"""
# What the sample does not fill; the tables have these columns too, all null.
_FILLED = {
    "game_pk", "game_date", "game_year", "game_type", "at_bat_number", "pitch_number", "sv_id",
    "batter", "pitcher", "player_name", "fielder_2", "home_team", "away_team", "inning",
    "inning_topbot", "balls", "strikes", "outs_when_up", "on_1b", "on_2b", "on_3b", "home_score",
    "away_score", "post_home_score", "post_away_score", "bat_score", "fld_score",
    "post_bat_score", "post_fld_score", "pitch_type", "release_speed", "effective_speed",
    "release_spin_rate", "arm_angle", "plate_x", "plate_z", "sz_top", "sz_bot", "zone",
    "description", "events", "launch_speed", "launch_angle", "launch_speed_angle",
    "estimated_woba_using_speedangle", "woba_value", "woba_denom", "bat_speed", "stand",
    "p_throws", "spin_dir", "umpire",
}

_TEAM_ROWS = ", ".join(f"({i}, '{a}', '{lg}', '{dv}', '{n}')" for i, a, lg, dv, n in TEAMS)

GAMES_SQL = f"""
dim AS (SELECT * FROM (VALUES {_TEAM_ROWS}) AS v(team_id, abbr, league, division, full_name)),
game_keys AS (
  SELECT game_pk, {_FACTS} FROM (SELECT DISTINCT o_orderkey // 75 AS game_pk FROM orders)),
game_ids AS (
  SELECT *, CAST({_list(TEAM_IDS)}[home + 1] AS BIGINT) AS home_team_id,
         CAST(CASE WHEN game_pk % 60 = 59 THEN 159 ELSE {_list(TEAM_IDS)}[away + 1] END AS BIGINT)
           AS away_team_id,
         game_pk % 25 <> 24 AS played
  FROM game_keys),
games AS (
  SELECT g.game_pk, game_year AS season, game_date,
    epoch(CAST(game_date AS TIMESTAMP)) + (16 + g.game_pk % 8) * 3600 + 300 AS game_datetime,
    game_type, CASE WHEN played THEN 'F' ELSE 'S' END AS status_code,
    CASE WHEN played THEN 'Final' ELSE 'Scheduled' END AS status_detail,
    home_team_id, h.abbr AS home_team_abbrev, h.league AS home_league,
    h.division AS home_division, away_team_id,
    coalesce(a.abbr, CASE WHEN g.game_pk % 120 <> 119 THEN 'NLS' ELSE 'UNK' END)
      AS away_team_abbrev,
    a.league AS away_league, a.division AS away_division,
    2000 + home AS venue_id, 'Park ' || {_list(TEAM_ABBRS)}[home + 1] AS venue_name,
    CASE WHEN g.game_pk % 3 <> 0 THEN 1000 + home * 4 END AS probable_home_pitcher_id,
    CASE WHEN g.game_pk % 3 <> 0 THEN 'Pitcher ' || CAST(1000 + home * 4 AS VARCHAR) END
      AS probable_home_pitcher_name,
    CASE WHEN g.game_pk % 3 <> 0 THEN 1000 + away * 4 END AS probable_away_pitcher_id,
    CASE WHEN g.game_pk % 3 <> 0 THEN 'Pitcher ' || CAST(1000 + away * 4 AS VARCHAR) END
      AS probable_away_pitcher_name,
    CASE WHEN played THEN home_pace * 74 // 12 END AS final_home_score,
    CASE WHEN played THEN away_pace * 75 // 12 END AS final_away_score,
    CASE WHEN g.game_pk % 50 = 0 THEN 'Y' ELSE 'N' END AS double_header_flag,
    1 + g.game_pk % 50 % 2 AS game_number, 'Regular Season' AS series_description
  FROM game_ids g JOIN dim h ON h.team_id = home_team_id LEFT JOIN dim a ON a.team_id = away_team_id)
"""

_CREW = ", ".join(
    f"({i}, '{UMPIRE_POSITIONS[t]}')" for i, t in enumerate(TITLES)
)
UMPIRES_SQL = f"""
crew AS (
  SELECT game_pk, position, 400000 + (game_pk + 5 * i) % 20 AS umpire_id,
         'Umpire ' || CAST(400000 + game_pk % 20 AS VARCHAR) AS umpire_name
  FROM (SELECT DISTINCT o_orderkey // 75 AS game_pk FROM orders),
       (VALUES {_CREW}) AS p(i, position)
  WHERE NOT (i = 3 AND game_pk % 7 = 0)),
umpires AS (
  SELECT c.game_pk, g.game_date, position, umpire_id, umpire_name
  FROM crew c JOIN (SELECT DISTINCT game_pk, game_date FROM pitches WHERE game_type <> 'S') g
    USING (game_pk))
"""


def _q(body: str, *parts: str) -> str:
    return "WITH " + ", ".join([SAMPLE, *parts]) + body


_WHIFF = "description IN ('swinging_strike','swinging_strike_blocked','foul_tip','missed_bunt')"
_SWING = ("description IN ('swinging_strike','swinging_strike_blocked','foul_tip','missed_bunt',"
          "'foul','hit_into_play')")
_CALLED = "description IN ('called_strike','ball')"
_EDGE = "abs(abs(plate_x) - 0.83e0) < 0.0833e0"


def _rate(condition: str) -> str:
    return f"round(avg(CASE WHEN {condition} THEN 1e0 ELSE 0e0 END), 6)"


def _top(entity, value, name, where, sample, n, limit=None) -> str:
    tail = f" LIMIT {limit}" if limit else ""
    return _q(f"""
SELECT {entity}, round(v, 6) AS {name}, {sample} FROM (
  SELECT {entity}, {value} AS v, count(*) AS {sample} FROM pitches WHERE {where}
  GROUP BY {entity} HAVING count(*) >= {n}) ORDER BY v DESC, {entity}{tail}""")


def _avg_if(condition: str) -> str:
    return f"avg(CASE WHEN {condition} THEN 1e0 ELSE 0e0 END)"


_R = "game_type = 'R'"
_HIT = "launch_speed IS NOT NULL AND game_type = 'R'"

CURATED = {
    "q01_league_barrel_rate": _q(f"""
SELECT game_year, {_rate('launch_speed >= 98 AND launch_angle BETWEEN 8 AND 50')} AS barrel_rate,
       count(*) AS batted_balls FROM pitches WHERE {_HIT} GROUP BY game_year"""),
    "q02_top_hard_hit": _top("batter", _avg_if("launch_speed >= 95"), "hard_hit_pct",
                             f"{_HIT} AND game_year = 2024", "bbe", 5, 10),
    "q03_umpire_called_strike_30d": _q(f"""
SELECT umpire_id AS umpire, {_rate("description = 'called_strike'")} AS called_k_rate,
       count(*) AS sample
FROM pitches JOIN umpires USING (game_pk)
WHERE position = 'HP' AND {_CALLED}
  AND pitches.game_date BETWEEN DATE '2024-05-01' AND DATE '2024-05-31'
GROUP BY umpire_id HAVING count(*) >= 20""", UMPIRES_SQL),
    "q04_umpire_edge_zone": _q(f"""
SELECT umpire_id AS umpire, {_rate("description = 'called_strike'")} AS edge_k_rate,
       count(*) AS sample
FROM pitches JOIN umpires USING (game_pk)
WHERE position = 'HP' AND {_CALLED} AND {_EDGE}
GROUP BY umpire_id HAVING count(*) >= 50""", UMPIRES_SQL),
    "q05_whiff_by_hand": _q(f"""
SELECT pitcher,
  round(avg(CASE WHEN stand = 'L' AND {_SWING} THEN CASE WHEN {_WHIFF} THEN 1e0 ELSE 0e0 END END),
        6) AS "whiff_vs_L",
  round(avg(CASE WHEN stand = 'R' AND {_SWING} THEN CASE WHEN {_WHIFF} THEN 1e0 ELSE 0e0 END END),
        6) AS "whiff_vs_R"
FROM pitches WHERE {_R} GROUP BY pitcher"""),
    "q06_starter_ev_allowed": _q("""
, starters AS (SELECT DISTINCT game_pk, pitcher FROM pitches WHERE inning = 1)
SELECT pitcher, round(avg(launch_speed), 6) AS avg_ev_allowed, count(*) AS bbe
FROM pitches JOIN starters USING (game_pk, pitcher)
WHERE launch_speed IS NOT NULL AND game_type = 'R'
GROUP BY pitcher HAVING count(*) >= 50"""),
    "q07_xwoba_contact": _top("batter", "avg(estimated_woba_using_speedangle)", "xwoba_contact",
                              f"{_HIT} AND game_year = 2024", "bbe", 8, 25),
    "q08_pitches_per_pa": _q(f"""
, ab AS (SELECT game_pk, at_bat_number, batting_team, count(*) AS n FROM pitches WHERE {_R}
         GROUP BY ALL)
SELECT batting_team, round(avg(n), 6) AS p_per_pa, count(*) AS pa_count FROM ab
GROUP BY batting_team"""),
    "q09_sweet_spot": _top("batter", _avg_if("launch_angle BETWEEN 8 AND 32"), "sweet_spot_pct",
                           _HIT, "bbe", 20, 25),
    "q10_bat_speed": _top("batter", "avg(bat_speed)", "avg_bat_speed",
                          f"bat_speed IS NOT NULL AND game_year >= 2024 AND {_R}", "bbe", 20, 25),
    "q11_k_rate_02": _top("pitcher", _avg_if("events = 'strikeout'"), "k_rate_02",
                          f"balls = 0 AND strikes = 2 AND events IS NOT NULL AND {_R}",
                          "pa_02", 5, 25),
    "q12_velo_by_pitch_type": _q(f"""
SELECT pitcher, pitch_type, round(avg(release_speed), 6) AS avg_velo, count(*) AS pitches
FROM pitches WHERE pitch_type IS NOT NULL AND {_R}
GROUP BY pitcher, pitch_type HAVING count(*) >= 50"""),
    "q13_spin_distribution": _q(f"""
SELECT pitch_type, round(avg(release_spin_rate), 6) AS avg_spin,
       quantile_disc(release_spin_rate, 0.5) AS p50, quantile_disc(release_spin_rate, 0.9) AS p90,
       count(*) AS pitches
FROM pitches WHERE release_spin_rate IS NOT NULL AND {_R} GROUP BY pitch_type"""),
    "q14_usage_by_count": _q(f"""
SELECT balls, strikes, pitch_type, count(*) AS n,
  round(100e0 * count(*) / CAST(sum(count(*)) OVER (PARTITION BY balls, strikes) AS DOUBLE), 6)
    AS pct
FROM pitches WHERE pitch_type IS NOT NULL AND {_R} GROUP BY balls, strikes, pitch_type"""),
    "q15_pa_results_by_inning": _q(f"""
SELECT inning, events, count(*) AS n FROM pitches WHERE events IS NOT NULL AND {_R}
GROUP BY inning, events"""),
    "q16_late_hard_hit_allowed": _q(f"""
SELECT pitcher, {_rate('launch_speed >= 95')} AS hard_hit_allowed, count(*) AS bbe
FROM pitches WHERE inning >= 7 AND {_HIT} GROUP BY pitcher HAVING count(*) >= 25"""),
    "q17_run_expectancy_24": _q(f"""
SELECT CAST(on_1b IS NOT NULL AS BIGINT) AS r1, CAST(on_2b IS NOT NULL AS BIGINT) AS r2,
       CAST(on_3b IS NOT NULL AS BIGINT) AS r3, outs_when_up AS outs,
       round(avg(post_bat_score - bat_score), 6) AS re, count(*) AS n
FROM pitches WHERE pitch_number = 1 AND {_R} GROUP BY 1, 2, 3, 4"""),
    "q18_runner_on_first": _q(f"""
SELECT pitch_type, count(*) AS pitches, {_rate("description = 'ball'")} AS ball_rate
FROM pitches WHERE on_1b IS NOT NULL AND pitch_type IS NOT NULL AND {_R} GROUP BY pitch_type"""),
    "q19_late_and_close": _q(f"""
SELECT batting_team, round(avg(woba_value), 6) AS late_close_woba, count(*) AS n
FROM pitches WHERE inning >= 7 AND abs(post_bat_score - post_fld_score) <= 2
  AND woba_value IS NOT NULL AND {_R} GROUP BY batting_team"""),
    "q20_ev_trend": _q(f"""
SELECT game_year, round(avg(launch_speed), 6) AS avg_ev, count(*) AS bbe
FROM pitches WHERE {_HIT} GROUP BY game_year"""),
    "q21_pitch_tempo": _q(f"""
SELECT pitcher, count(*) AS pitches, count(DISTINCT game_pk) AS games,
       round(count(*) / CAST(nullif(count(DISTINCT game_pk), 0) AS DOUBLE), 6) AS pitches_per_game
FROM pitches WHERE {_R} GROUP BY pitcher"""),
    "q22_two_strike": _q(f"""
SELECT pitcher, balls, strikes, {_rate("events = 'strikeout'")} AS k_rate,
       {_rate("events IN ('single','double','triple','home_run')")} AS contact_rate,
       count(*) AS terminal_pas
FROM pitches WHERE strikes = 2 AND events IS NOT NULL AND {_R}
GROUP BY pitcher, balls, strikes HAVING count(*) >= 8"""),
    "q23_catcher_framing": _q(f"""
SELECT fielder_2 AS catcher, {_rate("description = 'called_strike'")} AS edge_called_k_rate,
       count(*) AS edge_pitches
FROM pitches WHERE {_CALLED} AND {_EDGE} AND {_R} GROUP BY fielder_2 HAVING count(*) >= 30"""),
    "q24_park_ev": _q(f"""
SELECT home_team AS park, round(avg(launch_speed), 6) AS avg_ev, count(*) AS bbe
FROM pitches WHERE {_HIT} GROUP BY home_team HAVING count(*) >= 100"""),
    "q25_team_game_line": _q(f"""
SELECT game_pk, CAST(game_date AS VARCHAR) AS game_date, batting_team,
       {_rate('launch_speed >= 98 AND launch_angle BETWEEN 8 AND 50')} AS barrel_rate,
       {_rate('launch_speed >= 95')} AS hard_hit_pct, round(avg(launch_speed), 6) AS avg_ev,
       round(avg(launch_angle), 6) AS avg_la,
       round(avg(estimated_woba_using_speedangle), 6) AS xwoba_contact, count(*) AS bbe
FROM pitches WHERE {_HIT} GROUP BY game_pk, pitches.game_date, batting_team"""),
}

_PLAYER = {
    "barrel_rate": ("batter", "launch_speed_angle IS NOT NULL",
                    _avg_if("launch_speed_angle = 6"), "count(*)"),
    "hard_hit_pct": ("batter", "launch_speed_angle IS NOT NULL AND launch_speed IS NOT NULL",
                     _avg_if("launch_speed >= 95"), "count(*)"),
    "avg_exit_velo": ("batter", "launch_speed_angle IS NOT NULL AND launch_speed IS NOT NULL",
                      "avg(launch_speed)", "count(*)"),
    "avg_launch_angle": ("batter", "launch_speed_angle IS NOT NULL AND launch_angle IS NOT NULL",
                         "avg(launch_angle)", "count(*)"),
    "xwoba_contact": ("batter", "events IS NOT NULL",
                      "sum(CASE WHEN description = 'hit_into_play' "
                      "THEN coalesce(estimated_woba_using_speedangle, 0e0) "
                      "ELSE coalesce(woba_value, 0e0) END * woba_denom) "
                      "/ nullif(CAST(sum(woba_denom) AS DOUBLE), 0e0)",
                      "CAST(sum(woba_denom) AS BIGINT)"),
    "avg_release_speed": ("pitcher", "release_speed IS NOT NULL", "avg(release_speed)",
                          "count(*)"),
    "whiff_rate": ("pitcher", "true",
                   f"avg(CASE WHEN {_SWING} THEN CASE WHEN {_WHIFF} THEN 1e0 ELSE 0e0 END END)",
                   f"count(*) FILTER (WHERE {_SWING})"),
    "hard_hit_allowed": ("pitcher", "launch_speed_angle IS NOT NULL AND launch_speed IS NOT NULL",
                         _avg_if("launch_speed >= 95"), "count(*)"),
}
_FLOOR = {"batter": 5, "pitcher": 20}


def _player(name: str) -> str:
    entity, keep, value, sample = _PLAYER[name]
    return (f"SELECT {entity} AS id, CAST({value} AS DOUBLE) AS value, {sample} AS sample_size "
            f"FROM pitches WHERE game_type = 'R' AND game_year = 2024 AND {keep} "
            f"GROUP BY {entity} HAVING {sample} >= {_FLOOR[entity]}")


def _all_players(entity: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS metric, * FROM ({_player(n)})"
        for n, spec in _PLAYER.items() if spec[0] == entity
    )


RECORDS_SQL = """
last_pitch AS (
  SELECT game_pk, home_team, away_team,
    CASE WHEN inning_topbot = 'Top' THEN post_fld_score ELSE post_bat_score END AS hs,
    CASE WHEN inning_topbot = 'Top' THEN post_bat_score ELSE post_fld_score END AS aws,
    at_bat_number, pitch_number
  FROM pitches WHERE game_type = 'R' AND game_year = 2024),
finals AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY game_pk ORDER BY at_bat_number DESC, pitch_number DESC, hs DESC, aws DESC) AS rn
    FROM last_pitch) WHERE rn = 1),
team_games AS (
  SELECT home_team AS team, hs AS rs, aws AS ra FROM finals
  UNION ALL SELECT away_team, aws, hs FROM finals),
records AS (
  SELECT team AS id, CAST(sum(CASE WHEN rs > ra THEN 1 ELSE 0 END) AS BIGINT) AS wins,
    CAST(sum(CASE WHEN rs < ra THEN 1 ELSE 0 END) AS BIGINT) AS losses,
    CAST(sum(rs) - sum(ra) AS BIGINT) AS run_diff, count(*) AS sample_size
  FROM team_games GROUP BY team)
"""

_PAIRS = ", ".join(f"('{a}', {i})" for a, i in zip(FEED_ABBRS, TEAM_IDS, strict=True))
STANDINGS_SQL = f"""
ids AS (SELECT * FROM (VALUES {_PAIRS}) AS v(abbr, team_id)),
standings AS (
  SELECT CAST(2024 AS BIGINT) AS season, id AS team, wins + team_id % 3 AS wins, losses,
         500 + run_diff + wins % 8 AS runs_scored, CAST(500 AS BIGINT) AS runs_allowed
  FROM records JOIN ids ON abbr = id)
"""

METRIC_SQL = {
    **{
        f"m_{n}": _q(f" SELECT id, round(value, 6) AS value, sample_size FROM ({_player(n)})")
        for n in _PLAYER
    },
    **{
        f"s_{n}": _q(f" SELECT id, CAST({n} AS DOUBLE) AS value, sample_size FROM records",
                     RECORDS_SQL)
        for n in ("wins", "losses", "run_diff")
    },
    "m_batting_all": _q(f" SELECT metric, id, round(value, 6) AS value, sample_size "
                        f"FROM ({_all_players('batter')})"),
    "m_pitching_all": _q(f" SELECT metric, id, round(value, 6) AS value, sample_size "
                         f"FROM ({_all_players('pitcher')})"),
    "w1_final_scores": _q(" SELECT game_pk, home_team, away_team, hs AS home, aws AS away "
                          "FROM finals", RECORDS_SQL),
}

_BOARD_FIELDS = {  # metric -> (scale, tolerance)
    "barrel_rate": (0.01, 0.005), "hard_hit_pct": (0.01, 0.005), "avg_exit_velo": (1.0, 0.5),
    "avg_launch_angle": (1.0, 0.5), "xwoba_contact": (1.0, 0.005),
    "avg_release_speed": (1.0, 0.2), "hard_hit_allowed": (0.01, 0.005),
}
_SHIFT = "((id % 7) - 3) * 0.002e0 + (id % 100) * 0.000013e0 + 0.0000002e0"


def _board_ids(entity: str) -> str:
    first, floor = {"batter": ("barrel_rate", 8), "pitcher": ("avg_release_speed", 100)}[entity]
    return f"SELECT id FROM ({_player(first)}) WHERE sample_size >= {floor}"


def _compared(metric: str) -> str:
    scale, tolerance = _BOARD_FIELDS[metric]
    return f"""
SELECT '{metric}' AS metric, id AS entity_id,
  CASE WHEN id % 2 = 0 THEN 'Player ' || CAST(id AS VARCHAR) ELSE CAST(id AS VARCHAR) END
    AS entity_name,
  value AS ours, (value + {_SHIFT}) / {scale}e0 * {scale}e0 AS expected,
  value - ((value + {_SHIFT}) / {scale}e0 * {scale}e0) AS diff, sample_size,
  abs(value - ((value + {_SHIFT}) / {scale}e0 * {scale}e0)) <= {tolerance}e0 AS within_tolerance
FROM ({_player(metric)}) WHERE id IN ({_board_ids(_PLAYER[metric][0])})"""


_ALL_COMPARED = " UNION ALL ".join(
    _compared(m) for m in _BOARD_FIELDS if _PLAYER[m][0] == "batter"
)
# Both percentages of the pitchers are compared with the field that holds hard_hit_allowed.
_PITCHERS_COMPARED = f"""
{_compared('avg_release_speed')} UNION ALL {_compared('hard_hit_allowed')} UNION ALL
SELECT 'whiff_rate', w.id, CASE WHEN w.id % 2 = 0 THEN 'Player ' || CAST(w.id AS VARCHAR)
    ELSE CAST(w.id AS VARCHAR) END,
  w.value, h.expected, w.value - h.expected, w.sample_size,
  coalesce(abs(w.value - h.expected) <= 0.005e0, false)
FROM ({_player('whiff_rate')}) w
JOIN ({_board_ids('pitcher')}) b USING (id)
LEFT JOIN (SELECT id, (value + {_SHIFT}) / 0.01e0 * 0.01e0 AS expected
           FROM ({_player('hard_hit_allowed')})) h USING (id)"""
_TEAM_COMPARED = " UNION ALL ".join(
    f"""SELECT '{m}' AS metric, r.id AS entity_id, full_name AS entity_name,
  CAST(r.{m} AS DOUBLE) AS ours, CAST({theirs} AS DOUBLE) AS expected,
  CAST(r.{m} - ({theirs}) AS DOUBLE) AS diff, sample_size,
  abs(r.{m} - ({theirs})) <= {tolerance} AS within_tolerance
FROM records r JOIN standings s ON s.team = r.id JOIN ids ON ids.abbr = r.id
  JOIN dim ON dim.team_id = ids.team_id"""
    for m, theirs, tolerance in (
        ("wins", "s.wins", 1), ("losses", "s.losses", 1),
        ("run_diff", "s.runs_scored - s.runs_allowed", 5),
    )
)
_DIM = f"dim AS (SELECT * FROM (VALUES {_TEAM_ROWS}) AS v(team_id, abbr, league, division, full_name))"
_ROUNDED = ("metric, entity_id, entity_name, round(ours, 6) AS ours, round(expected, 6) AS "
            "expected, round(diff, 6) AS diff, sample_size, within_tolerance")
_SUMMARY = """
SELECT metric, count(*) AS total_compared, count(*) FILTER (WHERE within_tolerance) AS within_count,
  round(count(*) FILTER (WHERE within_tolerance) / CAST(count(*) AS DOUBLE), 6) AS pct_within,
  count(*) FILTER (WHERE within_tolerance) / CAST(count(*) AS DOUBLE) >= 0.5e0 AS passed"""

VERIFY_SQL = {
    "v_compare_batting": _q(f" SELECT {_ROUNDED} FROM ({_ALL_COMPARED})"),
    "v_compare_pitching": _q(f" SELECT {_ROUNDED} FROM ({_PITCHERS_COMPARED})"),
    "v_summary_batting": _q(f" {_SUMMARY} FROM ({_ALL_COMPARED}) GROUP BY metric"),
    "v_overall_batting": _q(f"""
, s AS ({_SUMMARY} FROM ({_ALL_COMPARED}) GROUP BY metric)
SELECT count(*) AS metrics, bool_and(passed) AS passed FROM s"""),
    "v_top_deltas": _q(f"""
 SELECT {_ROUNDED} FROM ({_compared('barrel_rate')}) WHERE NOT within_tolerance
ORDER BY abs(diff) DESC, entity_id LIMIT 5"""),
    "v_compare_teams": _q(f" SELECT {_ROUNDED} FROM ({_TEAM_COMPARED})",
                          RECORDS_SQL, STANDINGS_SQL, _DIM),
    "v_report_json": _q(f" SELECT {_ROUNDED} FROM ({_compared('barrel_rate')})"),
}

_GAME_COLUMNS = ", ".join(
    "CAST(game_date AS VARCHAR) AS game_date" if c == "game_date"
    else "CAST(game_datetime AS BIGINT) AS game_datetime" if c == "game_datetime" else c
    for c in GAMES.names
)

SOURCE_SQL = {
    "src_pitch_batch": _q("""
 SELECT game_pk, at_bat_number, pitch_number, CAST(game_date AS VARCHAR) AS game_date, sv_id,
        batter, pitcher, description, launch_speed, CAST(NULL AS DOUBLE) AS swing_length
FROM pitches WHERE game_type = 'R' AND game_date BETWEEN DATE '2024-05-01' AND DATE '2024-05-31'"""),
    "src_schedule_games": _q(f" SELECT {_GAME_COLUMNS} FROM games", GAMES_SQL),
    "src_game_officials": _q("""
 SELECT game_pk, CAST(game_date AS VARCHAR) AS game_date, position, umpire_id, umpire_name
FROM umpires""", UMPIRES_SQL),
    "src_distinct_games": _q("""
 SELECT DISTINCT game_pk, CAST(game_date AS VARCHAR) AS game_date FROM pitches"""),
    "src_standings": _q(" SELECT season, team, wins, losses, runs_scored, runs_allowed "
                        "FROM standings", RECORDS_SQL, STANDINGS_SQL),
    "src_leaderboard": _q(f"""
 SELECT 'barrel_rate' AS metric, id,
        round((value + {_SHIFT}) / 0.01e0 * 0.01e0, 6) AS expected
FROM ({_player('barrel_rate')}) WHERE sample_size >= 10"""),
}

GAME_SQL = {
    "g_results_on": _q("""
 SELECT game_pk, home_team_abbrev, final_home_score, away_team_abbrev, final_away_score
FROM games WHERE game_date = DATE '2024-05-01' AND status_code = 'F'""", GAMES_SQL),
    "g_slate_on": _q("""
 SELECT game_pk, home_team_abbrev, probable_home_pitcher_id, away_team_abbrev,
        probable_away_pitcher_id
FROM games WHERE game_date = DATE '2024-04-19' AND status_code = 'S'""", GAMES_SQL),
    "a15_result_counts": _q("""
, ranked AS (SELECT game_pk, at_bat_number, events, row_number() OVER (
    PARTITION BY game_pk, at_bat_number ORDER BY pitch_number DESC, coalesce(events, '') DESC) AS rn
  FROM pitches WHERE game_type = 'R')
SELECT events, count(*) AS n FROM ranked WHERE rn = 1 GROUP BY events"""),
    "a16_starters": _q("""
, ranked AS (SELECT game_pk, inning_topbot, pitcher, row_number() OVER (
    PARTITION BY game_pk, inning_topbot ORDER BY at_bat_number, pitch_number, pitcher) AS rn
  FROM pitches),
actual AS (SELECT game_pk, max(CASE WHEN inning_topbot = 'Top' THEN pitcher END) AS home_pitcher,
           max(CASE WHEN inning_topbot = 'Bot' THEN pitcher END) AS away_pitcher
           FROM ranked WHERE rn = 1 GROUP BY game_pk)
SELECT game_pk, probable_home_pitcher_id, home_pitcher,
  probable_home_pitcher_id IS NOT DISTINCT FROM home_pitcher AS home_same,
  probable_away_pitcher_id, away_pitcher,
  probable_away_pitcher_id IS NOT DISTINCT FROM away_pitcher AS away_same
FROM games JOIN actual USING (game_pk)""", GAMES_SQL),
    "j6_plate_umpires": _q("""
 SELECT u.umpire_id, count(DISTINCT p.game_pk) AS games, count(*) AS pitches
FROM pitches p LEFT JOIN (SELECT game_pk, umpire_id FROM umpires WHERE position = 'HP') u
  USING (game_pk) GROUP BY u.umpire_id""", UMPIRES_SQL),
    "x_strike_zone_calls": _q(f"""
 SELECT stand, abs(plate_x) <= 0.83e0 AND plate_z BETWEEN sz_bot AND sz_top AS in_zone,
  count(*) AS called, {_rate("description = 'called_strike'")} AS strike_rate,
  round(avg(CASE WHEN stand = 'R' THEN -plate_x ELSE plate_x END), 6) AS batter_view_x
FROM pitches WHERE {_CALLED} AND {_R} GROUP BY ALL"""),
}


def _rules(layout: TableLayout, table: str, filled: set[str], kinds: list[str]) -> str:
    rows = []
    for kind in kinds:
        for c in layout.columns:
            value = c.name if c.name in filled else "NULL"
            if kind == "not_null" and c.required:
                bad = f"{value} IS NULL"
            elif kind == "valid_range" and c.low is not None:
                bad = f"{value} < {c.low} OR {value} > {c.high}"
            elif kind == "valid_values" and c.allowed:
                bad = f"{value} NOT IN ({', '.join(repr(a) for a in c.allowed)})"
            elif kind == "deprecated" and c.deprecated:
                bad = f"{value} IS NOT NULL AND game_year > {c.deprecated}"
            else:
                continue
            rows.append((kind, c.name, bad))
    counts = ", ".join(f"count(*) FILTER (WHERE {bad}) AS c{i}" for i, (_, _, bad) in enumerate(rows))
    picked = " UNION ALL ".join(
        f"SELECT '{kind}' AS check_name, '{name}' AS column_name, c{i} AS violations FROM counted"
        for i, (kind, name, _) in enumerate(rows)
    )
    return f", counted AS MATERIALIZED (SELECT {counts} FROM {table}) {picked}"


def _profile(layout: TableLayout, table: str, filled: set[str]) -> str:
    cells, rows = ["count(*) AS n"], []
    for i, c in enumerate(layout.columns):
        value = c.name if c.name in filled else "NULL"
        cells += [f"count({value}) AS c{i}", f"CAST(min({value}) AS VARCHAR) AS l{i}",
                  f"CAST(max({value}) AS VARCHAR) AS h{i}"]
        rows.append(
            f"SELECT '{c.name}' AS column_name, '{c.dtype}' AS dtype, n AS row_count, "
            f"c{i} AS non_null, round((n - c{i}) / CAST(n AS DOUBLE), 6) AS null_share, "
            f"l{i} AS min_value, h{i} AS max_value FROM counted"
        )
    return (f", counted AS MATERIALIZED (SELECT {', '.join(cells)} FROM {table}) "
            + " UNION ALL ".join(rows))


_SEEN = """
SELECT CAST(game_date AS VARCHAR) AS game_date, count(*) AS pitches,
       CAST(sum(batter) AS BIGINT) AS batters"""

QUALITY_SQL = {
    "d1_not_null": _q(_rules(PITCHES, "pitches", _FILLED, ["not_null"])),
    "d2_valid_range": _q(_rules(PITCHES, "pitches", _FILLED, ["valid_range"])),
    "d3_valid_values": _q(_rules(PITCHES, "pitches", _FILLED, ["valid_values"])),
    "d3_games_rules": _q(_rules(GAMES, "games", set(GAMES.names),
                                ["not_null", "valid_range", "valid_values"]), GAMES_SQL),
    "d3_umpire_rules": _q(_rules(UMPIRES, "umpires", set(UMPIRES.names),
                                 ["not_null", "valid_range", "valid_values"]), UMPIRES_SQL),
    "d4_duplicates": _q("""
 SELECT game_pk, at_bat_number, pitch_number, count(*) AS copies FROM pitches
GROUP BY 1, 2, 3 HAVING count(*) > 1"""),
    "d6_profile": _q(_profile(PITCHES, "pitches", _FILLED)),
    "d7_deprecated": _q(_rules(PITCHES, "pitches", _FILLED, ["deprecated"])),
    "d8_games_without_pitches": _q("""
 SELECT game_pk, CAST(game_date AS VARCHAR) AS game_date, game_type FROM games
WHERE status_code = 'F' AND game_type IN ('R', 'D')
  AND game_pk NOT IN (SELECT game_pk FROM pitches WHERE game_type = 'R')""", GAMES_SQL),
    "d8_games_without_umpire": _q("""
 SELECT DISTINCT p.game_pk, CAST(p.game_date AS VARCHAR) AS game_date FROM pitches p
WHERE NOT EXISTS (SELECT 1 FROM umpires u WHERE u.game_pk = p.game_pk AND u.position = 'HP')""",
                                  UMPIRES_SQL),
}

_MONTHS = """
, bounds AS (SELECT min(game_date) AS lo, max(game_date) AS hi FROM pitches),
days AS (SELECT game_date, count(*) AS n FROM pitches GROUP BY game_date),
starts AS (
  SELECT CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP),
                                     CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS s,
         lo, hi FROM bounds),
chunks AS (
  SELECT greatest(s, lo) AS chunk_start,
         least(CAST(s + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), hi) AS chunk_end FROM starts),
loaded AS (
  SELECT chunk_start, chunk_end, CAST(coalesce(sum(n), 0) AS BIGINT) AS pitches
  FROM chunks LEFT JOIN days ON game_date BETWEEN chunk_start AND chunk_end GROUP BY ALL)
"""
_CHUNK_TEXT = ("CAST(chunk_start AS VARCHAR) AS chunk_start, CAST(chunk_end AS VARCHAR) AS "
               "chunk_end")

TABLE_SQL = {
    "t_replace_days": _q(f"""{_SEEN}
FROM pitches WHERE game_year = 2024 AND game_type = 'R'
  AND (game_date NOT BETWEEN DATE '2024-05-01' AND DATE '2024-05-31' OR home_team < 'M')
GROUP BY game_date"""),
    "t_replace_seasons": _q("""
 SELECT season, status_code, count(*) AS games, CAST(sum(final_home_score) AS BIGINT) AS home_runs
FROM games WHERE season <> 2023 AND NOT (season = 2024 AND status_code = 'S') GROUP BY ALL""",
                            GAMES_SQL),
    "r_month_chunks": _q(f"{_MONTHS} SELECT {_CHUNK_TEXT}, pitches FROM loaded"),
    "r_pending_chunks": _q(f"""{_MONTHS}
SELECT {_CHUNK_TEXT} FROM loaded
WHERE NOT (pitches = 0 OR (pitches > 0 AND month(chunk_start) % 2 = 0))"""),
    "r_sync_tables": _q("""
, kept AS (SELECT * FROM pitches WHERE game_type = 'R'
           AND game_date BETWEEN DATE '2024-04-10' AND DATE '2024-06-20'),
crews AS (SELECT u.* FROM umpires u WHERE game_pk IN (SELECT game_pk FROM kept))
SELECT 'pitches' AS name, CAST(game_date AS VARCHAR) AS slice, count(*) AS n FROM kept
GROUP BY game_date
UNION ALL SELECT 'umpires', CAST(game_date AS VARCHAR), count(*) FROM crews GROUP BY game_date
UNION ALL SELECT 'games', CAST(season AS VARCHAR), count(*) FROM games WHERE season = 2024
GROUP BY season
UNION ALL SELECT 'log ' || CASE WHEN n > 0 THEN 'success' ELSE 'empty' END, s, n FROM (
  SELECT s, count(game_pk) AS n FROM (VALUES ('2024-04-10', '2024-04-30'),
    ('2024-05-01', '2024-05-31'), ('2024-06-01', '2024-06-20')) AS c(s, e)
  LEFT JOIN kept ON game_date BETWEEN CAST(s AS DATE) AND CAST(e AS DATE) GROUP BY s)""",
                         UMPIRES_SQL, GAMES_SQL),
    "t_dictionary": _q(f"""
, counted AS (SELECT {", ".join(
    f"count({c.name if c.name in _FILLED else 'NULL'}) AS c{i}"
    for i, c in enumerate(PITCHES.columns))} FROM pitches)
""" + " UNION ALL ".join(
        f"SELECT '{c.name}' AS column_name, '{c.dtype}' AS dtype, "
        f"'{'|'.join(c.tags)}' AS tags, c{i} AS non_null FROM counted"
        for i, c in enumerate(PITCHES.columns))),
    "d5_drift": _q("""
 SELECT 'unknown' AS kind, 'miss_distance' AS column_name, count(*) AS rows_seen FROM pitches
UNION ALL SELECT 'missing', column_name, count(*) FROM pitches,
  (VALUES """ + ", ".join(f"('{c}')" for c in PITCHES.names if c not in _FILLED)
        + """) AS m(column_name) GROUP BY column_name"""),
}

_BATTERS = [m for m in _BOARD_FIELDS if _PLAYER[m][0] == "batter"]


def _overall(compared: str, threshold: float, *parts: str) -> str:
    """A metric with nothing to compare does not pass."""
    summary = _SUMMARY.replace("0.5e0", f"{threshold}e0")
    names = {_ALL_COMPARED: _BATTERS, _PITCHERS_COMPARED: [m for m in _PLAYER if _PLAYER[m][0] == "pitcher"]}
    rows = ", ".join(f"('{m}')" for m in names.get(compared, ["wins", "losses", "run_diff"]))
    return _q(f"""
, s AS ({summary} FROM ({compared}) GROUP BY metric), names(metric) AS (VALUES {rows})
SELECT count(*) AS metrics, bool_and(coalesce(passed, false)) AS passed FROM names LEFT JOIN s USING (metric)""", *parts)


_CUT = "SELECT id FROM ({0}) WHERE sample_size >= {1}"
_TEAM_PARTS = (RECORDS_SQL, STANDINGS_SQL, _DIM)
_OWN_SWING = "description IN ('swinging_strike','swinging_strike_blocked','foul','hit_into_play')"
MORE_SQL = {
    "v_two_boards": _q(f" SELECT {_ROUNDED} FROM (" + " UNION ALL ".join(
        f"SELECT * FROM ({_compared(m)}) WHERE entity_id IN ("
        f"{_CUT.format(_player('barrel_rate'), 11 if m == 'xwoba_contact' else 9)})" for m in _BATTERS
    ) + ")"),
    "v_results_json": _q(f"""
, c AS ({_ALL_COMPARED}), s AS ({_SUMMARY.replace("0.5e0", "0.99e0")} FROM c GROUP BY metric),
d AS (SELECT metric, entity_id, diff, row_number() OVER (
    PARTITION BY metric ORDER BY abs(diff) DESC, entity_id) AS rn FROM c WHERE NOT within_tolerance),
t(metric, tolerance) AS (VALUES {", ".join(f"('{m}', {_BOARD_FIELDS[m][1]}e0)" for m in _BATTERS)})
SELECT metric, CAST(2024 AS BIGINT) AS season, 'batter' AS aggregation, tolerance, 0.99e0 AS threshold,
  total_compared, within_count, pct_within, passed,
  (SELECT count(*) FROM d WHERE d.metric = s.metric AND rn <= 5) AS n_deltas,
  (SELECT max(entity_id) FROM d WHERE d.metric = s.metric AND rn = 1) AS worst_id,
  (SELECT round(max(diff), 6) FROM d WHERE d.metric = s.metric AND rn = 1) AS worst_diff
FROM s JOIN t USING (metric)"""),
    "v_overall_batting_099": _overall(_ALL_COMPARED, 0.99),
    "v_overall_pitching": _overall(_PITCHERS_COMPARED, 0.5),
    "v_overall_pitching_099": _overall(_PITCHERS_COMPARED, 0.99),
    "v_overall_teams": _overall(_TEAM_COMPARED, 0.5, *_TEAM_PARTS),
    "v_overall_teams_099": _overall(_TEAM_COMPARED, 0.99, *_TEAM_PARTS),
    "src_schedule_kinds": _q(
        f" SELECT {_GAME_COLUMNS} FROM games WHERE game_type IN ('R','P','F','D','L','W')", GAMES_SQL),
    "src_schedule_seasons": _q(f" SELECT {_GAME_COLUMNS} FROM games WHERE season IN (2023, 2024)", GAMES_SQL),
    "src_leaderboard_file": SOURCE_SQL["src_leaderboard"],
    "q05_whiff_own_swings": CURATED["q05_whiff_by_hand"].replace(_SWING, _OWN_SWING),
    "q17_last_pitch": CURATED["q17_run_expectancy_24"].replace("pitch_number = 1", "events IS NOT NULL"),
    "t_pruned_scan": _q("""
 SELECT CAST(game_date AS VARCHAR) AS game_date, count(*) AS pitches, round(avg(launch_speed), 6) AS launch_speed
FROM pitches WHERE game_type = 'R' AND game_date BETWEEN DATE '2024-05-01' AND DATE '2024-05-31'
GROUP BY game_date"""),
}

_LOST = {"batter": "pitcher % 4 = 0", "zone": "zone = 3", "release_speed": "zone = 5"}
_KEPT = "(game_date NOT BETWEEN DATE '2024-04-02' AND DATE '2024-05-31' OR home_team < 'M')"
STORE_SQL = {
    "r_daily_feed": _q("""
 SELECT CAST(game_date AS VARCHAR) AS game_date, count(*) AS pitches, CAST(sum(batter) AS BIGINT) AS batters,
  CAST(0 AS INTEGER) AS loaded_again FROM pitches WHERE game_type = 'R' AND game_year = 2024 GROUP BY game_date"""),
    "d5_lost_values": _q(" SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {bad}) AS lost, count({c}) FILTER (WHERE NOT ({bad})) AS kept FROM pitches"
        for c, bad in _LOST.items()) + ") WHERE lost > 0"),
    "st_season_lines": _q(f"""
 SELECT game_year, {_rate('launch_speed >= 98 AND launch_angle BETWEEN 8 AND 50')} AS barrel_rate, count(*) AS batted_balls,
  round(avg(launch_speed), 6) AS avg_ev FROM pitches WHERE {_HIT} AND {_KEPT} GROUP BY game_year"""),
    "st_velocity": _q(f"""
 SELECT pitcher, pitch_type, round(avg(release_speed), 6) AS avg_velo, count(*) AS pitches FROM pitches
WHERE pitch_type IS NOT NULL AND {_R} AND {_KEPT} GROUP BY pitcher, pitch_type HAVING count(*) >= 50"""),
    "st_batting_metrics": METRIC_SQL["m_batting_all"].replace("FROM pitches WHERE", f"FROM pitches WHERE {_KEPT} AND"),
    "st_spin": _q(f"""
 SELECT pitch_type, round(avg(release_spin_rate), 6) AS avg_spin, count(*) AS pitches, true AS p50_within, true AS p90_within
FROM pitches WHERE release_spin_rate IS NOT NULL AND {_R} AND {_KEPT} GROUP BY pitch_type"""),
    "st_pitch_tempo": _q(f"""
 SELECT pitcher, count(*) AS pitches, count(DISTINCT game_pk) AS games,
  round(count(*) / CAST(nullif(count(DISTINCT game_pk), 0) AS DOUBLE), 6) AS pitches_per_game
FROM pitches WHERE {_R} AND {_KEPT} GROUP BY pitcher"""),
    "t_by_game": _q("""
 SELECT 'umpire' AS kind, u.umpire_id AS id, count(DISTINCT p.game_pk) AS games, count(*) AS pitches
FROM pitches p LEFT JOIN (SELECT game_pk, umpire_id FROM umpires WHERE position = 'HP') u USING (game_pk) GROUP BY u.umpire_id
UNION ALL SELECT 'game', game_pk, 1, 0 FROM games
WHERE status_code = 'F' AND game_type IN ('R', 'D') AND game_pk NOT IN (SELECT game_pk FROM pitches WHERE game_type = 'R')""",
                    UMPIRES_SQL, GAMES_SQL),
    "t_point_lookup": _q("""
, year AS (SELECT * FROM pitches WHERE game_type = 'R' AND game_year = 2024)
SELECT pitcher, batter, count(*) AS pitches, round(avg(release_speed), 6) AS release_speed FROM year
WHERE pitcher IN (SELECT pitcher FROM year GROUP BY pitcher ORDER BY count(*) DESC, pitcher LIMIT 3) GROUP BY ALL"""),
    "src_landing_manifest": _q("""
 SELECT CAST(game_date AS VARCHAR) AS game_date, count(*) AS pitches, CAST(sum(batter) AS BIGINT) AS batters,
  round(sum(CASE WHEN game_year >= 2024 THEN bat_speed END), 6) AS bat_speed, (SELECT count(*) FROM pitches) AS rows_noted, true AS once
FROM pitches WHERE game_type = 'R' AND game_date BETWEEN DATE '2023-04-03' AND DATE '2024-05-31' GROUP BY game_date"""),
    "t_z_order": _q("""
 SELECT away_team, game_pk, count(*) AS pitches, CAST(sum(pitcher) AS BIGINT) AS pitchers, round(avg(release_speed), 6) AS release_speed
FROM pitches WHERE game_type = 'R' AND game_year = 2024 AND away_team IN ('NYY', 'BOS', 'SEA') GROUP BY ALL"""),
    "t_replace_atomic": _q("""
 SELECT CAST(game_date AS VARCHAR) AS game_date, count(*) AS before, CAST(sum(batter) AS BIGINT) AS before_batters,
  nullif(count(*) FILTER (WHERE stays), 0) AS after, CAST(sum(batter) FILTER (WHERE stays) AS BIGINT) AS after_batters, true AS refused
FROM (SELECT *, game_date NOT BETWEEN DATE '2024-04-02' AND DATE '2024-05-31' OR home_team < 'M' AS stays
      FROM pitches WHERE game_year = 2024 AND game_type = 'R')
GROUP BY game_date"""),
    "t_comments": _q(f"""
, counted AS (SELECT {", ".join(f"count({c.name}) AS c{i}" for i, c in enumerate(GAMES.columns))} FROM games)
""" + " UNION ALL ".join(
        f"SELECT '{c.name}' AS column_name, '{c.description.replace(chr(39), chr(39) * 2)}' AS description, c{i} AS non_null, "
        f"CAST({len(GAMES.columns[::3])} AS INTEGER) AS changed FROM counted"
        for i, c in enumerate(GAMES.columns)), GAMES_SQL),
    "src_damaged_documents": _q("""
, keys AS (SELECT DISTINCT o_orderkey // 75 AS g FROM orders),
aside AS (
  SELECT 'unreadable' AS name, CAST(2022 + g % 4 AS VARCHAR) AS slice, count(*) AS n FROM keys WHERE g % 5 = 0 GROUP BY 2
  UNION ALL SELECT 'no answer', CAST(2022 + g % 4 AS VARCHAR), count(*) FROM keys WHERE g % 7 = 0 GROUP BY 2)
SELECT name, slice, n FROM aside
UNION ALL SELECT name, 'all', CAST(sum(n) AS BIGINT) FROM aside GROUP BY name
UNION ALL SELECT 'home runs', CAST(season AS VARCHAR), CAST(sum(final_home_score) AS BIGINT) FROM games GROUP BY season""", GAMES_SQL),
}

ORACLES = {
    **CURATED, **METRIC_SQL, **VERIFY_SQL, **SOURCE_SQL, **GAME_SQL, **QUALITY_SQL, **TABLE_SQL,
    **MORE_SQL, **STORE_SQL,
}
