"""One handle over a landed data folder, with a call per query of the library.

Folder layout below ``root``: ``pitches`` (see ``land_pitches``), ``register`` (shards
``people-*.csv`` or Parquet), ``boards/<slug>``, ``pages/<slug>`` (HTML boards) and
``api/<endpoint>``.
"""

from __future__ import annotations

from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.functions.spin import add_spin_columns
from dugout.operators import arsenal, leaderboard, pitch_search, register
from dugout.plans.endpoints import LandedApi
from dugout.plans.registry import HOT_STOVE_VARS, board
from dugout.sources import files

# Fixed names: board functions and the board each one reads.
BOARD_CALLS = {
    "get_exit_velocity_barrels": "exit-velocity-barrels",
    "get_expected_statistics": "expected_statistics",
    "get_bat_tracking": "bat-tracking",
    "get_swing_path_attack_angle": "bat-tracking/swing-path-attack-angle",
    "get_swing_timing_miss_distance": "bat-tracking/swing-timing-miss-distance",
    "get_batted_ball": "batted-ball",
    "get_percentile_rankings": "percentile-rankings",
    "get_pitch_arsenal_stats": "pitch-arsenal-stats",
    "get_home_runs": "home-runs",
    "get_year_to_year": "statcast-year-to-year",
    "get_pitch_tempo": "pitch-tempo",
    "get_active_spin": "active-spin",
    "get_pitch_movement": "pitch-movement",
    "get_pitch_arsenals": "pitch-arsenals",
    "get_spin_direction": "spin-direction-pitches",
    "get_arm_angles": "pitcher-arm-angles",
    "get_pitcher_running_game": "pitcher-running-game",
    "get_outs_above_average": "outs_above_average",
    "get_fielding_run_value": "fielding-run-value",
    "get_catch_probability": "catch-probability-alt",
    "get_directional_oaa": "directional-oaa",
    "get_outfield_jump": "outfield_jump",
    "get_arm_strength": "arm-strength",
    "get_baserunning": "baserunning",
    "get_catcher_framing": "catcher-framing",
    "get_poptime": "poptime",
    "get_catcher_blocking": "catcher-blocking",
    "get_catcher_throwing": "catcher-throwing",
    "get_catcher_stance": "catcher-stance",
    "get_sprint_speed": "sprint_speed",
    "get_running_splits": "running-splits",
    "get_baserunning_run_value": "baserunning-run-value",
    "get_basestealing_run_value": "basestealing-run-value",
    "get_custom_leaderboard": "custom",
    "get_game_scores": "game-scores",
    "get_abs_challenges": "abs-challenges",
    "get_timer_infractions": "pitch-timer-infractions",
    "get_swing_take": "swing-take",
    "get_park_factors": "statcast-park-factors",
    "get_hot_stove": "hot-stove",
    "get_rolling_windows": "rolling",
}


class Landed:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.api = LandedApi(spark, f"{self.root}/api")

    @cached_property
    def pitches(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/pitches")

    @cached_property
    def register(self) -> DataFrame:
        return files.read_register(self.spark, f"{self.root}/register")

    def search_pitches(self, start_date, end_date, *args: Any, **filters: Any) -> DataFrame:
        return pitch_search.search_pitches(self.pitches, start_date, end_date, *args, **filters)

    statcast_search = search_pitches

    def search_game(self, game_pk, *args: Any, **filters: Any) -> DataFrame:
        return pitch_search.search_game(self.pitches, game_pk, *args, **filters)

    def search_matchup(self, pitcher_id, batter_id, *args: Any, **filters: Any) -> DataFrame:
        return pitch_search.search_matchup(self.pitches, pitcher_id, batter_id, *args, **filters)

    def search_team(self, team: str, *args: Any, **filters: Any) -> DataFrame:
        return pitch_search.search_team(self.pitches, team, *args, **filters)

    def get_pitcher_arsenal(self, pitcher_id, *args: Any, **filters: Any) -> DataFrame:
        return arsenal.pitcher_arsenal(self.pitches, pitcher_id, *args, **filters)

    def get_pitcher_arsenals(self, **options: Any) -> DataFrame:
        return arsenal.aggregate_arsenal(self.pitches, **options)

    def add_spin_columns(self) -> DataFrame:
        return add_spin_columns(self.pitches)

    def lookup(self, *args: Any, **tests: Any) -> DataFrame:
        return register.lookup(self.register, *args, **tests)

    def convert_id(self, source: str, target: str, value: int | str) -> str | None:
        """One id from one system in another, from the first register row that has it."""
        key = register.ID_COLUMNS[source]
        rows = self.register.where(F.col(key) == str(value))
        found = register.crosswalk(rows, source, target).first()
        return found["_to"] if found else None

    def mlbam_to_fangraphs(self, mlbam: int | str) -> str | None:
        return self.convert_id("mlbam", "fangraphs", mlbam)

    def mlbam_to_bbref(self, mlbam: int | str) -> str | None:
        return self.convert_id("mlbam", "bbref", mlbam)

    def fangraphs_to_mlbam(self, fangraphs: int | str) -> str | None:
        return self.convert_id("fangraphs", "mlbam", fangraphs)

    def bbref_to_mlbam(self, bbref: str) -> str | None:
        return self.convert_id("bbref", "mlbam", bbref)

    def get_leaderboard(self, slug: str, year: Any = None, player_id: Any = None, **params: Any) -> DataFrame:
        """A landed board; boards kept as HTML pages give the rows of their embedded arrays."""
        spec = board(slug)
        if spec.json_var is None:
            landed = leaderboard.scan_board(self.spark, f"{self.root}/boards", slug)
            return leaderboard.leaderboard(landed, slug, year, player_id, **params)
        variable = HOT_STOVE_VARS[params.get("side", "batter")] if slug == "hot-stove" else spec.json_var
        pages = self.spark.read.parquet(f"{self.root}/pages/{spec.slug}")
        wanted = {"year": year, **params}
        wanted = {k: v for k, v in wanted.items() if v is not None and k != "side"}
        if player_id is not None:
            wanted["player_id"] = player_id
        if absent := sorted(set(wanted) - set(pages.columns)):
            raise ValueError(f"pages of {slug!r} have no column for {absent}")
        rows = pitch_search.filter_rows(pages, **wanted)
        return leaderboard.page_rows(files.embedded_json(rows, "html", variable), spec)

    def __getattr__(self, name: str):
        if name not in BOARD_CALLS:
            raise AttributeError(name)

        def call(year: Any = None, player_id: Any = None, **params: Any) -> DataFrame:
            return self.get_leaderboard(BOARD_CALLS[name], year, player_id, **params)

        return call
