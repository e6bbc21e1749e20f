"""The pitch table: one row per pitch, 118 columns."""

from __future__ import annotations

from pitchlake.catalog.columns import Column, TableLayout

# Names, types, bounds, value sets and tags of the pitch feed.
_IDENTIFIERS = (
    Column("game_pk", "bigint", ("identifier", "join_key", "mlb_canonical"),
           "League-wide id of the game; the join key to games and umpires.", required=True),
    Column("game_date", "date", ("temporal", "identifier", "mlb_canonical"),
           "Official day of the game; splits the table.", required=True),
    Column("game_year", "bigint", ("temporal", "identifier"),
           "Calendar year of the game, same as the year of game_date.",
           required=True, low=2008, high=2030),
    Column("game_type", "string", ("pitch_context", "identifier"),
           "Kind of game; R is the regular season.",
           allowed=("R", "S", "E", "F", "D", "L", "W", "A")),
    Column("at_bat_number", "bigint", ("pitch_context", "identifier"),
           "Running number of the plate appearance in the game.", low=1, high=100),
    Column("pitch_number", "bigint", ("pitch_context",),
           "Running number of the pitch in the plate appearance.", low=1, high=25),
    Column("sv_id", "string", ("identifier",),
           "Tracking-system id in the form yymmdd_hhmmss; text, not a number."),
    Column("batter", "bigint", ("identifier", "join_key", "mlb_canonical"),
           "Player id of the batter."),
    Column("pitcher", "bigint", ("identifier", "join_key", "mlb_canonical"),
           "Player id of the pitcher."),
    Column("player_name", "string", ("identifier",), "Name for display, last name first."),
    *(
        Column(f"fielder_{number}", "bigint", ("identifier", "join_key"),
               f"Player id of the {post}.")
        for number, post in (
            (2, "catcher"), (3, "first baseman"), (4, "second baseman"), (5, "third baseman"),
            (6, "shortstop"), (7, "left fielder"), (8, "center fielder"), (9, "right fielder"),
        )
    ),
    Column("home_team", "string", ("team", "identifier"), "Home team, feed abbreviation."),
    Column("away_team", "string", ("team", "identifier"), "Visiting team, feed abbreviation."),
)

_CONTEXT = (
    Column("inning", "bigint", ("pitch_context",), "Inning.", low=1, high=25),
    Column("inning_topbot", "string", ("pitch_context",),
           "Half of the inning: visitors bat in Top, the home team in Bot.",
           allowed=("Top", "Bot")),
    Column("balls", "bigint", ("pitch_context",), "Balls before the pitch.", low=0, high=3),
    Column("strikes", "bigint", ("pitch_context",), "Strikes before the pitch.", low=0, high=2),
    Column("outs_when_up", "bigint", ("pitch_context",), "Outs before the pitch.", low=0, high=2),
    Column("on_1b", "bigint", ("runner", "pitch_context"),
           "Player on first base; null when the base is empty."),
    Column("on_2b", "bigint", ("runner", "pitch_context"),
           "Player on second base; null when the base is empty."),
    Column("on_3b", "bigint", ("runner", "pitch_context"),
           "Player on third base; null when the base is empty."),
)

_SCORE = (
    Column("home_score", "bigint", ("score_state",), "Home runs before the pitch.", low=0, high=30),
    Column("away_score", "bigint", ("score_state",), "Visitor runs before the pitch.",
           low=0, high=30),
    Column("post_home_score", "bigint", ("score_state",), "Home runs after the pitch.",
           low=0, high=30),
    Column("post_away_score", "bigint", ("score_state",), "Visitor runs after the pitch.",
           low=0, high=30),
    Column("bat_score", "bigint", ("score_state",), "Runs of the batting team before the pitch.",
           low=0, high=30),
    Column("fld_score", "bigint", ("score_state",), "Runs of the fielding team before the pitch.",
           low=0, high=30),
    Column("post_bat_score", "bigint", ("score_state",),
           "Runs of the batting team after the pitch.", low=0, high=30),
    Column("post_fld_score", "bigint", ("score_state",),
           "Runs of the fielding team after the pitch.", low=0, high=30),
    Column("home_score_diff", "bigint", ("score_state",), "Home lead before the pitch.",
           low=-30, high=30),
    Column("bat_score_diff", "bigint", ("score_state",), "Lead of the batting team.",
           low=-30, high=30),
)

_FLIGHT = (
    Column("pitch_type", "string", ("pitch_physics", "pitch_context"), "Two-letter pitch class.",
           allowed=("FF", "SI", "SL", "CH", "CU", "FC", "KC", "ST", "SV", "CS", "KN", "EP", "PO",
                    "FA", "IN", "FO", "SC")),
    Column("pitch_name", "string", ("pitch_physics", "pitch_context"), "Pitch class in words."),
    Column("type", "string", ("outcome_pitch",), "Ball (B), strike (S) or in play (X).",
           allowed=("B", "S", "X")),
    Column("release_speed", "double", ("pitch_physics", "physics"), "Speed at release, mph.",
           low=50, high=110),
    Column("effective_speed", "double", ("pitch_physics", "physics"),
           "Speed as the batter perceives it, given the extension, mph.", low=50, high=115),
    Column("release_spin_rate", "bigint", ("pitch_physics", "physics"), "Spin at release, rpm.",
           low=0, high=3500),
    Column("release_extension", "double", ("pitch_physics", "physics"),
           "How far in front of the rubber the ball leaves the hand, feet.", low=3, high=9),
    Column("release_pos_x", "double", ("pitch_physics", "physics"),
           "Sideways release point seen by the catcher, feet.", low=-4, high=4),
    Column("release_pos_z", "double", ("pitch_physics", "physics"), "Height of release, feet.",
           low=3, high=9),
    Column("release_pos_y", "double", ("pitch_physics", "physics"),
           "Distance of the release point from home plate, feet.", low=50, high=60),
    Column("spin_axis", "bigint", ("pitch_physics", "physics"), "Spin axis, degrees.",
           low=0, high=360),
    Column("vx0", "double", ("pitch_physics", "physics"), "Velocity along x at 50 feet, ft/s.",
           low=-20, high=20),
    Column("vy0", "double", ("pitch_physics", "physics"), "Velocity along y at 50 feet, ft/s.",
           low=-160, high=-100),
    Column("vz0", "double", ("pitch_physics", "physics"), "Velocity along z at 50 feet, ft/s.",
           low=-25, high=25),
    Column("ax", "double", ("pitch_physics", "physics"), "Acceleration along x, ft/s2.",
           low=-30, high=30),
    Column("ay", "double", ("pitch_physics", "physics"), "Acceleration along y, ft/s2.",
           low=15, high=35),
    Column("az", "double", ("pitch_physics", "physics"), "Acceleration along z, ft/s2.",
           low=-50, high=15),
    Column("pfx_x", "double", ("pitch_physics", "physics"), "Sideways movement, feet.",
           low=-3, high=3),
    Column("pfx_z", "double", ("pitch_physics", "physics"), "Vertical movement, feet.",
           low=-3, high=3),
    Column("api_break_z_with_gravity", "double", ("pitch_physics", "physics"),
           "Drop with gravity, inches.", low=-80, high=10),
    Column("api_break_x_arm", "double", ("pitch_physics", "physics"),
           "Break to the throwing-arm side, inches.", low=-30, high=30),
    Column("api_break_x_batter_in", "double", ("pitch_physics", "physics"),
           "Break towards the batter, inches.", low=-30, high=30),
    Column("arm_angle", "double", ("pitch_physics", "physics"), "Arm angle at release, degrees.",
           low=-10, high=90),
)

_LOCATION = (
    Column("plate_x", "double", ("pitch_location",),
           "Sideways position at the plate seen by the catcher, feet.", low=-3, high=3),
    Column("plate_z", "double", ("pitch_location",), "Height at the plate, feet.",
           low=-1, high=6),
    Column("sz_top", "double", ("pitch_location",), "Upper edge of the strike zone, feet.",
           low=2.5, high=4.5),
    Column("sz_bot", "double", ("pitch_location",), "Lower edge of the strike zone, feet.",
           low=1, high=2.5),
    Column("zone", "bigint", ("pitch_location",),
           "Coarse region: 1-9 in the zone, 11-14 outside it.", low=1, high=14),
)

_OUTCOME = (
    Column("description", "string", ("outcome_pitch",), "Result of the pitch.",
           allowed=("called_strike", "ball", "swinging_strike", "foul", "hit_into_play",
                    "blocked_ball", "foul_tip", "swinging_strike_blocked", "pitchout",
                    "intent_ball", "missed_bunt", "foul_bunt", "hit_into_play_score",
                    "foul_pitchout")),
    Column("events", "string", ("outcome_at_bat",),
           "Result of the plate appearance, on its last pitch only."),
    Column("des", "string", ("outcome_at_bat",), "Play in words."),
)

_BATTED = (
    Column("launch_speed", "double", ("batted_ball", "physics", "post_hit"),
           "Exit velocity, mph; null without contact.", low=20, high=130),
    Column("launch_angle", "bigint", ("batted_ball", "physics", "post_hit"),
           "Vertical angle off the bat, degrees.", low=-90, high=90),
    Column("hit_distance_sc", "bigint", ("batted_ball", "post_hit"), "Projected distance, feet.",
           low=0, high=600),
    Column("hc_x", "double", ("batted_ball", "post_hit"), "Spray-chart x."),
    Column("hc_y", "double", ("batted_ball", "post_hit"), "Spray-chart y."),
    Column("bb_type", "string", ("batted_ball", "post_hit"), "Shape of the batted ball.",
           allowed=("ground_ball", "line_drive", "fly_ball", "popup")),
    Column("hit_location", "bigint", ("batted_ball", "post_hit"),
           "Position of the first fielder on the ball.", low=1, high=9),
    Column("estimated_ba_using_speedangle", "double", ("expected_stats", "batted_ball"),
           "Expected batting average from speed and angle.", low=0, high=1),
    Column("estimated_woba_using_speedangle", "double", ("expected_stats", "batted_ball"),
           "Expected wOBA from speed and angle.", low=0, high=2),
    Column("estimated_slg_using_speedangle", "double", ("expected_stats", "batted_ball"),
           "Expected slugging from speed and angle.", low=0, high=4),
    Column("woba_value", "double", ("expected_stats", "outcome_at_bat"),
           "wOBA weight of the actual result.", low=0, high=3),
    Column("woba_denom", "bigint", ("expected_stats", "outcome_at_bat"),
           "1 when the plate appearance counts for wOBA, else 0.", low=0, high=1),
    Column("babip_value", "bigint", ("expected_stats", "outcome_at_bat"),
           "1 for a hit on a ball in play.", low=0, high=1),
    Column("iso_value", "bigint", ("expected_stats", "outcome_at_bat"),
           "Extra bases of the hit.", low=0, high=3),
    Column("launch_speed_angle", "bigint", ("batted_ball", "expected_stats"),
           "Contact class by speed and angle; 6 is a barrel.", low=1, high=6),
    Column("bat_speed", "double", ("batted_ball", "physics", "post_hit"),
           "Bat speed, mph; from 2024.", low=30, high=90),
    Column("swing_length", "double", ("batted_ball", "physics", "post_hit"),
           "Path of the bat, feet; from 2024.", low=3, high=12),
    Column("attack_angle", "double", ("batted_ball", "physics", "post_hit"),
           "Vertical angle of the bat at contact, degrees.", low=-30, high=40),
    Column("attack_direction", "double", ("batted_ball", "physics", "post_hit"),
           "Horizontal angle of the bat at contact, degrees.", low=-180, high=180),
    Column("swing_path_tilt", "double", ("batted_ball", "physics", "post_hit"),
           "Tilt of the swing plane, degrees.", low=-90, high=90),
    Column("intercept_ball_minus_batter_pos_x_inches", "double",
           ("batted_ball", "physics", "post_hit"),
           "Contact point relative to the batter, sideways, inches.", low=-30, high=30),
    Column("intercept_ball_minus_batter_pos_y_inches", "double",
           ("batted_ball", "physics", "post_hit"),
           "Contact point relative to the batter, towards the mound, inches.", low=-30, high=30),
    Column("hyper_speed", "double", ("batted_ball", "expected_stats", "post_hit"),
           "Exit velocity with slow contact raised to 88 mph.", low=88, high=130),
)

_PEOPLE = (
    Column("stand", "string", ("handedness",), "Side the batter stands on.", allowed=("L", "R")),
    Column("p_throws", "string", ("handedness",), "Throwing hand of the pitcher.",
           allowed=("L", "R")),
    Column("if_fielding_alignment", "string", ("pitch_context",), "Infield alignment."),
    Column("of_fielding_alignment", "string", ("pitch_context",), "Outfield alignment."),
)

_EXPECTANCY = (
    Column("delta_home_win_exp", "double", ("score_state",),
           "Change of the home win chance on the play.", low=-1, high=1),
    Column("delta_run_exp", "double", ("score_state",), "Change of run expectancy.",
           low=-3, high=3),
    Column("delta_pitcher_run_exp", "double", ("score_state",),
           "Change of run expectancy credited to the pitcher.", low=-3, high=3),
    Column("home_win_exp", "double", ("score_state",), "Home win chance before the pitch.",
           low=0, high=1),
    Column("bat_win_exp", "double", ("score_state",),
           "Win chance of the batting team before the pitch.", low=0, high=1),
)

_AGE_AND_REST = (
    Column("age_pit_legacy", "bigint", ("temporal",), "Age of the pitcher, older rule.",
           low=18, high=50),
    Column("age_bat_legacy", "bigint", ("temporal",), "Age of the batter, older rule.",
           low=18, high=50),
    Column("age_pit", "bigint", ("temporal",), "Age of the pitcher.", low=18, high=50),
    Column("age_bat", "bigint", ("temporal",), "Age of the batter.", low=18, high=50),
    Column("n_thruorder_pitcher", "bigint", ("pitch_context",),
           "How often the pitcher has been through the order.", low=1, high=5),
    Column("n_priorpa_thisgame_player_at_bat", "bigint", ("pitch_context",),
           "Earlier plate appearances of the batter in the game.", low=0, high=8),
    Column("pitcher_days_since_prev_game", "bigint", ("temporal", "pitch_context"),
           "Days since the pitcher last played.", low=0, high=200),
    Column("batter_days_since_prev_game", "bigint", ("temporal", "pitch_context"),
           "Days since the batter last played.", low=0, high=200),
    Column("pitcher_days_until_next_game", "bigint", ("temporal", "pitch_context"),
           "Days until the pitcher plays again.", low=0, high=200),
    Column("batter_days_until_next_game", "bigint", ("temporal", "pitch_context"),
           "Days until the batter plays again.", low=0, high=200),
)

_DEPRECATED = (
    Column("spin_dir", "bigint", ("pitch_physics",), "Old spin direction.", deprecated=2017),
    Column("spin_rate_deprecated", "bigint", ("pitch_physics",), "Old spin rate.",
           deprecated=2017),
    Column("break_angle_deprecated", "bigint", ("pitch_physics",), "Old break angle.",
           deprecated=2017),
    Column("break_length_deprecated", "bigint", ("pitch_physics",), "Old break length.",
           deprecated=2017),
    Column("tfs_deprecated", "bigint", ("temporal",), "Old time stamp.", deprecated=2017),
    Column("tfs_zulu_deprecated", "bigint", ("temporal",), "Old UTC time stamp.",
           deprecated=2017),
    Column("umpire", "bigint", ("identifier",),
           "Always null; the umpire table has the crew.", deprecated=2017),
)

PITCHES = TableLayout(
    columns=(
        *_IDENTIFIERS, *_CONTEXT, *_SCORE, *_FLIGHT, *_LOCATION, *_OUTCOME, *_BATTED, *_PEOPLE,
        *_EXPECTANCY, *_AGE_AND_REST, *_DEPRECATED,
    ),
    comment="Pitch tracking data, regular season, one row per pitch.",
    partition_by=("game_date",),
    cluster_by=("home_team", "away_team", "game_pk"),
    key=("game_pk", "at_bat_number", "pitch_number"),
    lookup_by=("pitcher", "batter"),
)
