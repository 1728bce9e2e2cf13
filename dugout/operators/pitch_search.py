"""Pitch search: date span, player role, level, team, game, matchup, multi-value filters.

Everything here is a conjunction of column predicates, so it prunes partitions of a table
laid out by ``level`` and year and is pushed into the Parquet scan.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dugout.functions.spin import SPIN_INPUTS
from dugout.functions.text import day_of, number
from dugout.operators.resolve import team_code

ROLES = {"pitcher": "pitcher", "batter": "batter"}
LEVELS = ("mlb", "milb")
SIDES = ("any", "home", "away")
DAILY_CAP = 30_000
LAYOUT_YEAR = "pitch_year"

# Fixed names: filter keys of the remote search form and the pitch column each one tests.
FILTER_COLUMNS = {
    "hfPT": "pitch_type",
    "hfAB": "events",
    "hfPR": "description",
    "hfBBT": "bb_type",
    "hfGT": "game_type",
    "hfInn": "inning",
    "hfSea": "game_year",
    "pitcher_throws": "p_throws",
    "batter_stands": "stand",
    "pitchers_lookup[]": "pitcher",
    "batters_lookup[]": "batter",
    "hfTeam": "team",
}
# Form knobs that shape the remote page, not the rows.
FORM_KNOBS = {"all", "type", "player_type", "group_by", "sort_col", "sort_order"}
THRESHOLDS = {"min_pitches", "min_results", "min_abs"}


def as_date(value: str | date, name: str) -> date:
    if isinstance(value, date):
        return value
    try:
        return date.fromisoformat(value)
    except ValueError:
        raise ValueError(f"{value!r} is not a valid {name}: expected YYYY-MM-DD") from None


def choose(value: str, name: str, allowed) -> str:
    if value not in allowed:
        raise ValueError(f"{value!r} is not a valid {name}: expected one of {sorted(allowed)}")
    return value


def multi_value(value: Any) -> list[str]:
    """``"FF|SL|"`` or a list to its values; empty parts are dropped, commas are text."""
    if isinstance(value, (list, tuple, set)):
        return [str(v) for v in value]
    return [v for v in str(value).split("|") if v]


def value_filter(df: DataFrame, name: str, value: Any) -> Column:
    """Equality or membership with the literals in the column's own type, so it pushes down."""
    kind = df.schema[name].dataType
    wanted = [F.lit(v).try_cast(kind) for v in multi_value(value)]
    return F.col(name) == wanted[0] if len(wanted) == 1 else F.col(name).isin(wanted)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def filter_rows(df: DataFrame, **filters: Any) -> DataFrame:
    """Equality or membership per named column; ``None`` and thresholds of 0 mean no filter.

    Thresholds count a group's rows, which a row filter does not know, so they are refused;
    ``search_pitches`` applies ``min_pitches`` itself.
    """
    out = df
    for key, value in filters.items():
        if key in THRESHOLDS and value is not None and float(value) > 0:
            raise ValueError(f"the threshold {key!r} cannot be applied here")
        if value is None or key in FORM_KNOBS or key in THRESHOLDS:
            continue
        column = FILTER_COLUMNS.get(key, key)
        if column == "team":
            sides = [value_filter(df, c, value) for c in ("home_team", "away_team")]
            out = out.where(sides[0] | sides[1])
        elif multi_value(value):
            out = out.where(value_filter(df, column, value))
    return out


def search_pitches(
    df: DataFrame,
    start_date: str | date,
    end_date: str | date,
    player_type: str = "pitcher",
    player_id: int | str | None = None,
    level: str = "mlb",
    **filters: Any,
) -> DataFrame:
    """Pitches of a date span, both ends included.

    Explicit filters win over ``player_id``; the date arguments win over any date filter.
    ``min_pitches`` above 0 keeps players with at least that many matching pitches.
    """
    start, end = as_date(start_date, "start_date"), as_date(end_date, "end_date")
    if start > end:
        raise ValueError(f"start_date {start} is after end_date {end}")
    role = ROLES[choose(player_type, "player_type", ROLES)]
    choose(level, "level", LEVELS)
    typed = isinstance(df.schema["game_date"].dataType, T.DateType)
    day = F.col("game_date") if typed else day_of(df, "game_date")
    conditions = [day.between(F.lit(start), F.lit(end))]
    if LAYOUT_YEAR in df.columns:
        conditions.append(F.col(LAYOUT_YEAR).between(start.year, end.year))
    if "level" in df.columns:
        conditions.append(F.col("level") == level)
    lookup = {"pitcher": "pitchers_lookup[]", "batter": "batters_lookup[]"}[role]
    if player_id is not None and lookup not in filters:
        conditions.append(value_filter(df, role, player_id))
    own = ("game_date_gt", "game_date_lt", "min_pitches")
    dateless = {k: v for k, v in filters.items() if k not in own}
    out = filter_rows(df.where(_all(conditions)), **dateless)
    least = int(filters.get("min_pitches") or 0)
    if least > 0:
        counts = out.groupBy(role).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
        out = out.join(counts.select(role), role, "left_semi")
    return out


statcast_search = search_pitches


def search_game(df: DataFrame, game_pk: int | str, level: str = "mlb", **filters: Any) -> DataFrame:
    choose(level, "level", LEVELS)
    rows = df.where(value_filter(df, "game_pk", game_pk))
    if "level" in df.columns:
        rows = rows.where(F.col("level") == level)
    return filter_rows(rows, **filters)


def search_matchup(
    df: DataFrame,
    pitcher_id: int | str,
    batter_id: int | str,
    start_date: str | date,
    end_date: str | date,
    level: str = "mlb",
    **filters: Any,
) -> DataFrame:
    """Pitches from one pitcher to one batter."""
    both = {**filters, "pitchers_lookup[]": str(pitcher_id), "batters_lookup[]": str(batter_id)}
    return search_pitches(df, start_date, end_date, "pitcher", None, level, **both)


def search_team(
    df: DataFrame,
    team: str,
    start_date: str | date,
    end_date: str | date,
    side: str = "any",
    level: str = "mlb",
    resolve: bool = True,
    **filters: Any,
) -> DataFrame:
    """Pitches of a team's games on either side, or only at home or away."""
    choose(side, "side", SIDES)
    code = team_code(team) if resolve else team
    home, away = F.col("home_team") == code, F.col("away_team") == code
    on_side = {"any": home | away, "home": home, "away": away}[side]
    return search_pitches(df.where(on_side), start_date, end_date, level=level, **filters)


# Fixed names: numeric columns of a pitch row that the operators read.
PITCH_NUMBERS = (
    "release_speed", "release_spin_rate", "effective_speed", "release_extension", "release_pos_x",
    "release_pos_z", "pfx_x", "pfx_z", "plate_x", "plate_z", "launch_speed", "launch_angle",
    "spin_axis", "bat_speed", "swing_length", "miss_distance", "attack_angle",
    "attack_direction", "swing_path_tilt", "intercept_ball_minus_batter_pos_x_inches",
    "intercept_ball_minus_batter_pos_y_inches", "arm_angle", "api_break_z_with_gravity",
    "api_break_x_arm", "api_break_x_batter_in", "hyper_speed", *SPIN_INPUTS,
)


def typed_pitches(df: DataFrame) -> DataFrame:
    """Text pitch rows with dates and numbers parsed, so later queries need not."""
    numbers = {c: number(df, c) for c in dict.fromkeys(PITCH_NUMBERS) if c in df.columns}
    out = df.withColumns(numbers)
    return out.withColumn("game_date", day_of(df, "game_date")) if "game_date" in df.columns else out


def land_pitches(df: DataFrame, path: str) -> None:
    """Writes typed pitches in folders per level and year, files ordered by date.

    Rows are range-partitioned on date and game, so files are even whatever the busiest day
    holds, and each covers a narrow span of dates: a date search prunes the year folders
    and skips the other files and row groups by their statistics. Bloom filters on pitcher and
    batter let a search for a player skip row groups; ``file_index`` skips whole files.
    """
    order = ["level", "game_date", "game_pk"]
    typed = typed_pitches(df).withColumn(LAYOUT_YEAR, F.year("game_date"))
    ranged = typed.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = ranged.write.mode("append").partitionBy("level", LAYOUT_YEAR)
    for c in ("pitcher", "batter"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def capped_days(df: DataFrame, cap: int = DAILY_CAP) -> DataFrame:
    """Days at or above the source's row cap, which may have lost rows at the source."""
    keys = [k for k in ("level", "game_date") if k in df.columns]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pitches"))
    return counts.where(F.col("n_pitches") >= cap)


def by_pitches(df: DataFrame, role: str = "pitcher", ascending: bool = False) -> DataFrame:
    """Pitches per player, most first: the search form's default order."""
    counts = df.groupBy(role).agg(F.count(F.lit(1)).alias("pitches"))
    return counts.orderBy(F.asc("pitches") if ascending else F.desc("pitches"), role)
