"""The 41 boards as configuration: one generic board query reads them all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TEAM_VIEWS = ("batter", "batting-team", "pitcher", "pitching-team", "league")
ROLES = ("batter", "pitcher")
NAMED = ("last_name", "first_name", "player_id")


@dataclass(frozen=True)
class Board:
    slug: str
    title: str
    category: str
    season: str  # int | special | range | array
    since: int
    views: tuple[str, ...]
    min_param: str | None
    min_column: str | None
    filters: tuple[str, ...]
    player_rule: str  # unknown | ignored | supported | breaks
    columns: tuple[str, ...]
    required: tuple[str, ...] = ()
    drop_type: bool = False
    json_var: str | None = None
    weight: str | None = None
    sums: tuple[str, ...] = ()
    means: tuple[str, ...] = ()

    @property
    def id_column(self) -> str:
        return next((c for c in ("player_id", "id", "pitcher_id") if c in self.columns), "player_id")


def _b(slug, title, category, since, views, min_param, min_column, filters, rule, columns, season="int", **more):
    return Board(
        slug, title, category, season, since, tuple(views), min_param, min_column,
        tuple(filters), rule, tuple(columns), **more,
    )


# Slug, title, category, first season, views, threshold parameter and the column
# it tests, other filters, player-id rule, key columns.
BOARDS: dict[str, Board] = {
    b.slug: b
    for b in [
        _b("exit-velocity-barrels", "Exit Velocity & Barrels", "batting", 2015, ROLES, "min_bbe", "attempts", [], "ignored",
           (*NAMED, "attempts", "avg_hit_speed", "max_hit_speed", "barrels", "brl_percent")),
        _b("expected_statistics", "Expected Statistics (xBA/xSLG/xwOBA/xERA)", "batting", 2015, ROLES, "min_pa", "pa", ["min_pitches"], "ignored",
           (*NAMED, "pa", "bip", "ba", "est_ba", "slg", "est_slg", "woba", "est_woba")),
        _b("bat-tracking", "Bat Tracking", "batting", 2023, TEAM_VIEWS, "minSwings", "swings_competitive", ["gameType"], "ignored",
           ("id", "name", "swings_competitive", "contact", "avg_bat_speed", "hard_swing_rate", "squared_up_per_swing",
            "blast_per_swing", "swing_length", "swords", "batter_run_value"), "range",
           weight="swings_competitive", sums=("swings_competitive", "contact", "swords", "batter_run_value"),
           means=("avg_bat_speed", "hard_swing_rate", "squared_up_per_swing", "blast_per_swing", "swing_length")),
        _b("bat-tracking/swing-path-attack-angle", "Swing Path / Attack Angle", "batting", 2023, TEAM_VIEWS, "minSwings",
           "competitive_swings", ["gameType"], "ignored",
           ("id", "name", "side", "avg_bat_speed", "swing_tilt", "attack_angle", "attack_direction", "ideal_attack_angle_rate",
            "avg_intercept_y_vs_plate", "competitive_swings"), "range",
           weight="competitive_swings", sums=("competitive_swings",),
           means=("avg_bat_speed", "swing_tilt", "attack_angle", "attack_direction", "ideal_attack_angle_rate",
                  "avg_intercept_y_vs_plate")),
        _b("bat-tracking/swing-timing-miss-distance", "Swing Timing / Miss Distance", "batting", 2023, TEAM_VIEWS, "min", "n_swings",
           ["minSplit", "splitYear", "gameType[]", "showColumn"], "ignored",
           ("id", "name", "year", "team_name", "miss_distance", "whiff_rate", "n_swings", "perfect_percent", "flawed_percent",
            "early_percent", "on_time_percent", "late_percent", "over_percent", "under_percent"), "array"),
        _b("batted-ball", "Batted Ball Profile", "batting", 2015, ROLES, "min_bbe", "bbe", [], "unknown",
           (*NAMED, "ba", "slg", "xba", "xslg", "xwoba", "la_avg", "barrel_batted_rate")),
        _b("percentile-rankings", "Percentile Rankings", "batting", 2015, ROLES, None, None, [], "supported",
           (*NAMED, "year", "xba", "xslg", "xwoba", "exit_velocity_avg")),
        _b("pitch-arsenal-stats", "Pitch Arsenal Stats", "batting", 2015, ROLES, "min_pa", "pa", ["pitch_type", "min_pitches"], "ignored",
           (*NAMED, "pitch_type", "pitches", "pa", "ba", "slg", "woba", "whiff_percent", "run_value", "run_value_per100")),
        _b("home-runs", "Home Runs", "batting", 2015, ROLES, None, None, [], "unknown",
           (*NAMED, "total_home_runs", "avg_hr_distance", "avg_launch_speed", "avg_launch_angle")),
        _b("statcast-year-to-year", "Year-Over-Year Changes", "batting", 2016, ROLES, "min_pa", "pa", ["min_pitches", "year_pair"],
           "unknown", NAMED),
        _b("pitch-tempo", "Pitch Tempo", "batting", 2015, ROLES, "min_pa", "pa", ["min_pitches"], "unknown",
           (*NAMED, "avg_time_between_pitches")),
        _b("active-spin", "Active Spin", "pitching", 2017, (), "min_pitches", "n_pitches", [], "breaks",
           ("pitcher", "pitcher_id", "pitch_type", "n_pitches", "active_spin", "active_spin_pct", "spin_rate", "velocity"),
           "special"),
        _b("pitch-movement", "Pitch Movement", "pitching", 2015, (), "min_pitches", "pitches", ["pitch_type", "pitcher_throws"], "breaks",
           ("last_name", "first_name", "pitcher_id", "pitch_type", "pitches", "pitcher_hand", "avg_speed", "avg_spin",
            "avg_break_x", "avg_break_z"), required=("pitch_type",)),
        _b("pitch-arsenals", "Pitch Arsenals (Mix Breakdown)", "pitching", 2015, ("pitcher",), "min_pitches", "pitches", [], "unknown",
           (*NAMED, "n_ff", "n_si", "n_sl", "ff_pct", "si_pct", "sl_pct")),
        _b("spin-direction-pitches", "Spin Direction", "pitching", 2020, ("pitcher",), "min_pitches", "pitches", ["pitch_type"],
           "unknown", (*NAMED, "pitch_type", "pitches", "spin_rate", "spin_direction", "active_spin_pct"),
           required=("pitch_type",)),
        _b("pitcher-arm-angles", "Arm Angles", "pitching", 2020, ("pitcher",), "min_pitches", "pitches", [], "unknown",
           (*NAMED, "pitches", "arm_angle", "pitcher_hand", "team")),
        _b("pitcher-running-game", "Pitcher Running Game", "pitching", 2015, ("pitcher",), "min_attempts", "sb_attempts", [],
           "unknown", (*NAMED, "sb_attempts", "sb_pct", "stolen_bases", "caught_stealing", "pickoffs")),
        _b("outs_above_average", "Outs Above Average", "fielding", 2016, ("fielder",), "min_attempts", "attempts", ["position"],
           "unknown", (*NAMED, "team", "position", "attempts", "outs_above_average")),
        _b("fielding-run-value", "Fielding Run Value", "fielding", 2015, ("fielder",), "min_inn", "inn", ["position"], "unknown",
           (*NAMED, "team", "position", "inn", "run_value", "run_value_per_inn")),
        _b("catch-probability-alt", "Catch Probability", "fielding", 2016, ("fielder",), "min_attempts", "attempts",
           ["star_min", "star_max"], "unknown", (*NAMED, "team", "attempts", "success_rate_raw", "outs_above_average")),
        _b("directional-oaa", "Directional OAA", "fielding", 2016, (), "min_attempts", "attempts", ["position"], "unknown",
           (*NAMED, "team", "position", "oaa_in", "oaa_out", "oaa_left", "oaa_right", "oaa_total")),
        _b("outfield_jump", "Outfield Jump", "fielding", 2020, ("fielder",), "min_opportunities", "opportunities", [], "unknown",
           (*NAMED, "team", "opportunities", "jump_distance", "reaction_distance")),
        _b("arm-strength", "Arm Strength", "fielding", 2020, ("fielder",), "min_throws", "throws", ["position"], "unknown",
           (*NAMED, "team", "position", "throws", "max_arm_strength", "avg_arm_strength")),
        _b("baserunning", "Extra Bases / Arm Value", "fielding", 2015, ("Fld", "Run"), "min_opportunities", "attempts", ["position"],
           "unknown", (*NAMED, "team", "attempts", "arm_value", "kills", "assists")),
        _b("catcher-framing", "Catcher Framing", "catching", 2015, ("catcher",), "min_pitches", "n", [], "unknown",
           (*NAMED, "team", "n", "extra_strikes", "framing_runs", "strike_rate")),
        _b("poptime", "Pop Time", "catching", 2015, ("catcher",), "min_attempts", "attempts", ["exchange_min", "exchange_max"], "unknown",
           (*NAMED, "team", "pop_2b", "pop_3b", "exchange_2b", "arm_2b")),
        _b("catcher-blocking", "Catcher Blocking", "catching", 2015, ("catcher",), "min_blocks", "n", [], "unknown",
           (*NAMED, "team", "n", "blocks_above_average", "run_value")),
        _b("catcher-throwing", "Catcher Throwing", "catching", 2015, ("catcher",), "min_attempts", "sb_attempts", [], "unknown",
           (*NAMED, "team", "sb_attempts", "cs", "cs_pct", "pop_time", "arm_speed")),
        _b("catcher-stance", "Catcher Receiving Stance", "catching", 2020, ("catcher",), "min_pitches", "pitches", [], "unknown",
           ("id", "name", "year", "pitches")),
        _b("sprint_speed", "Sprint Speed", "running", 2015, (), "min_opportunities", "opportunities", [], "ignored",
           (*NAMED, "team", "sprint_speed", "hp_to_1b", "opportunities")),
        _b("running-splits", "90-Foot Running Splits", "running", 2015, (), "min_opportunities", "n_tracked", [], "unknown",
           (*NAMED, "team", "n_tracked", "sprint_speed", "hp1b")),
        _b("baserunning-run-value", "Baserunning Run Value", "running", 2015, (), "min_opportunities", "opportunities", [],
           "unknown", (*NAMED, "team", "opportunities", "run_value", "outs", "extra_bases")),
        _b("basestealing-run-value", "Basestealing Run Value", "running", 2015, (), "min_attempts", "attempts", [], "unknown",
           (*NAMED, "team", "attempts", "sb", "cs", "run_value")),
        _b("custom", "Custom Leaderboard", "other", 2015, ROLES, "min_pa", "pa", ["min_pitches", "custom_col"], "unknown", ()),
        _b("game-scores", "Enhanced Game Scores", "other", 2015, (), "min_gs", "gs", [], "unknown",
           (*NAMED, "team", "gs", "avg_game_score", "max_game_score")),
        _b("abs-challenges", "ABS Challenges", "other", 2025, (), None, None, [], "unknown",
           (*NAMED, "team", "challenges", "wins", "losses", "win_pct")),
        _b("pitch-timer-infractions", "Pitch Timer Infractions", "other", 2023, (), None, None, [], "unknown",
           (*NAMED, "team", "infractions", "inf_per_game"), drop_type=True),
        _b("swing-take", "Swing/Take Run Value", "other", 2015, (), None, None, [], "supported", NAMED),
        _b("statcast-park-factors", "Statcast Park Factors", "other", 2015, ("year", "batter", "pitcher", "venue"), None, None,
           ["bat_side", "condition", "stat"], "unknown",
           ("venue_name", "venue_id", "team", "year", "park_factor", "hr_factor", "r_factor"), json_var="data"),
        _b("rolling", "Rolling Windows", "other", 2015, (), None, None, [], "unknown", (), json_var="rolling"),
        _b("hot-stove", "Hot Stove", "other", 2015, ROLES, None, None, ["side"], "unknown", (), json_var="HOT_STOVE_BATTER_DATA"),
    ]
}

# Other names boards are asked for by.
ALIASES = {
    "running-splits-alt": "running-splits",
    "sprint-speed-alt": "sprint_speed",
    "expected-stats-alt": "expected_statistics",
}
HOT_STOVE_VARS = {"batter": "HOT_STOVE_BATTER_DATA", "pitcher": "HOT_STOVE_PITCHER_DATA"}


def board(slug: str) -> Board:
    known = ALIASES.get(slug, slug)
    if known not in BOARDS:
        raise ValueError(f"unknown board {slug!r}; have {sorted(BOARDS)}")
    return BOARDS[known]


def list_boards(category: str | None = None) -> list[str]:
    return sorted(s for s, b in BOARDS.items() if category is None or b.category == category)


def registry_frame(spark: SparkSession) -> DataFrame:
    """The registry as a table: one row per board."""
    rows = [
        (b.slug, b.title, b.category, b.season, b.since, list(b.views), b.min_param, b.player_rule, list(b.columns))
        for b in BOARDS.values()
    ]
    schema = (
        "slug string, title string, category string, season string, since int, "
        "views array<string>, min_param string, player_rule string, key_columns array<string>"
    )
    return spark.createDataFrame(rows, schema)
