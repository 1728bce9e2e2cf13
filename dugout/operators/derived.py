"""Boards computed from pitch rows. The column lists follow the boards; the formulas are ours.

All of them are one pass over the pitches with numeric buffers, so they stay hash
aggregates that combine before a single shuffle. ``by`` is any grouping grain.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dugout.functions.spin import SPIN_INPUTS, add_spin_columns, axis_to_clock
from dugout.functions.text import day_of, number
from dugout.operators.ordered import GROUP_LIMIT, look_back
from dugout.operators.ranking import percentiles
from dugout.session import shared_dir
from dugout.sources.codes import EVENT_GROUPS

BARREL = 6
BASES = {"single": 1, "double": 2, "triple": 3, "home_run": 4}
NOT_AT_BAT = (*EVENT_GROUPS["walks_hbp"], "sac_fly", "sac_bunt", "sac_fly_double_play", "sac_bunt_double_play")
# Fixed names: the bat-tracking columns of the pitch table.
BAT_COLUMNS = (
    "bat_speed", "swing_length", "miss_distance", "attack_angle", "attack_direction",
    "swing_path_tilt",
)
# The team views read columns that ``with_teams`` adds.
VIEWS = {
    "batter": "batter",
    "pitcher": "pitcher",
    "batting-team": "batting_team",
    "pitching-team": "pitching_team",
    "league": None,
}


def _count() -> Column:
    return F.count(F.lit(1))


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(100.0 * part, whole)


def with_season(df: DataFrame, day: str = "game_date", out: str = "year") -> DataFrame:
    return df.withColumn(out, F.year(day_of(df, day)))


def with_teams(df: DataFrame, half: str = "inning_topbot") -> DataFrame:
    """Adds ``batting_team`` and ``pitching_team``: the away team bats in the top half.

    Refuses rows without a half-inning column; a half that is neither gives NULL teams.
    """
    if half not in df.columns:
        raise ValueError(f"team views need the half-inning column {half!r}")
    top, bottom = F.lower(half) == "top", F.lower(half).isin("bot", "bottom")
    away, home = F.col("away_team"), F.col("home_team")
    return df.withColumns(
        {
            "batting_team": F.when(top, away).when(bottom, home),
            "pitching_team": F.when(top, home).when(bottom, away),
        }
    )


def view_key(view: str, columns: dict[str, str] | None = None) -> list[str]:
    """Grouping columns of a board view; the league view has none."""
    known = {**VIEWS, **(columns or {})}
    if view not in known:
        raise ValueError(f"{view!r} is not a view: {sorted(known)}")
    return [known[view]] if known[view] else []


def exit_velocity(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Batted balls, mean and top exit speed, barrels and their share."""
    speed, quality = number(df, "launch_speed"), number(df, "qoc")
    hit = df.select(*by, speed.alias("_speed"), (quality == BARREL).alias("_barrel"))
    out = hit.where("_speed IS NOT NULL").groupBy(*by).agg(
        _count().alias("attempts"),
        F.avg("_speed").alias("avg_hit_speed"),
        F.max("_speed").alias("max_hit_speed"),
        F.count_if("_barrel").alias("barrels"),
    )
    return out.withColumn("brl_percent", _percent(F.col("barrels"), F.col("attempts")))


def observed_stats(df: DataFrame, by: Sequence[str], events: str = "events") -> DataFrame:
    """Plate appearances, balls in play, batting average and slugging from event codes.

    Sacrifices are balls in play, but not at-bats.
    """
    event = F.col(events)
    known = [e for g in ("hits", "outs", "walks_hbp", "errors") for e in EVENT_GROUPS[g]]
    bases = F.lit(0)
    for name, n in BASES.items():
        bases = F.when(event == name, n).otherwise(bases)
    at_bat = ~event.isin(*NOT_AT_BAT)
    strikeout = event.isin("strikeout", "strikeout_double_play", "strikeout_triple_play")
    sums = df.where(event.isin(*known)).groupBy(*by).agg(
        _count().alias("pa"),
        F.count_if(~event.isin(*EVENT_GROUPS["walks_hbp"]) & ~strikeout).alias("bip"),
        F.count_if(at_bat).alias("ab"),
        F.count_if(event.isin(*EVENT_GROUPS["hits"])).alias("hits"),
        F.sum(bases).alias("total_bases"),
    )
    return sums.select(
        *by,
        "pa",
        "bip",
        F.try_divide(F.col("hits").cast("double"), "ab").alias("ba"),
        F.try_divide(F.col("total_bases").cast("double"), "ab").alias("slg"),
    )


def metric_means(
    df: DataFrame, by: Sequence[str], metrics: Sequence[str], count: str = "n", prefix: str = "avg_"
) -> DataFrame:
    """Row count and null-skipping means of any columns: the custom board."""
    return df.groupBy(*by).agg(
        _count().alias(count), *[F.avg(number(df, m)).alias(prefix + m) for m in metrics]
    )


def bat_tracking(
    df: DataFrame, by: Sequence[str], metrics: Sequence[str] = BAT_COLUMNS, swing: str = "bat_speed"
) -> DataFrame:
    """Tracked swings and swing means, over rows that have a tracked swing."""
    tracked = df.where(number(df, swing).isNotNull())
    return metric_means(tracked, by, [m for m in metrics if m in df.columns], "swings_competitive")


def miss_distance(
    df: DataFrame, by: Sequence[str], miss: str = "miss_distance", whiff: Column | None = None
) -> DataFrame:
    """Swings, mean miss in inches and the share of swings that missed."""
    inches = number(df, miss)
    missed = inches.isNotNull() if whiff is None else whiff
    sums = df.groupBy(*by).agg(
        _count().alias("n_swings"), F.avg(inches).alias("miss_distance"), F.count_if(missed).alias("_missed")
    )
    rate = _percent(F.col("_missed"), F.col("n_swings")).alias("whiff_rate")
    return sums.select(*by, "n_swings", "miss_distance", rate)


def batted_ball(
    df: DataFrame,
    by: Sequence[str],
    kinds: Sequence[str] = ("ground_ball", "line_drive", "fly_ball", "popup"),
) -> DataFrame:
    """Share of each batted-ball type and the mean launch angle."""
    kind = F.col("bb_type")
    sums = df.where(kind.isin(*kinds)).groupBy(*by).agg(
        _count().alias("bbe"),
        F.avg(number(df, "launch_angle")).alias("la_avg"),
        *[F.count_if(kind == k).alias(f"_{k}") for k in kinds],
    )
    shares = [_percent(F.col(f"_{k}"), F.col("bbe")).alias(f"{k}_percent") for k in kinds]
    return sums.select(*by, "bbe", "la_avg", *shares)


def percentile_board(
    df: DataFrame,
    player: str,
    metrics: Sequence[str],
    year: str = "year",
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Season means per player as 0-100 percentiles within the season.

    The means, one row per player and season, are checkpointed: measuring and ranking them
    then costs no further pass over the pitches.
    """
    means = metric_means(df, [year, player], metrics, prefix="")
    shared_dir(df.sparkSession)
    return percentiles(means.checkpoint(), [year], metrics, limit=limit)


def arsenal_stats(
    df: DataFrame,
    by: Sequence[str],
    whiff: Column,
    value: Column,
    events: str = "events",
) -> DataFrame:
    """Pitches, plate appearances, whiff share and run value per pitch group."""
    sums = df.groupBy(*by).agg(
        _count().alias("pitches"),
        F.count_if(F.coalesce(F.col(events), F.lit("")) != "").alias("pa"),
        F.count_if(whiff).alias("_whiffs"),
        F.sum(value).alias("run_value"),
    )
    return sums.select(
        *by,
        "pitches",
        "pa",
        _percent(F.col("_whiffs"), F.col("pitches")).alias("whiff_percent"),
        "run_value",
        _percent(F.col("run_value"), F.col("pitches")).alias("run_value_per100"),
    )


def home_runs(df: DataFrame, by: Sequence[str], events: str = "events") -> DataFrame:
    """Home runs with their mean exit speed, angle and, if tracked, distance."""
    means = {"avg_launch_speed": "launch_speed", "avg_launch_angle": "launch_angle"}
    if "hit_distance_sc" in df.columns:
        means["avg_hr_distance"] = "hit_distance_sc"
    return df.where(F.col(events) == "home_run").groupBy(*by).agg(
        _count().alias("total_home_runs"), *[F.avg(number(df, c)).alias(n) for n, c in means.items()]
    )


def year_changes(
    df: DataFrame,
    player: str,
    metrics: Sequence[str],
    year: str = "year",
    limit: int | None = None,
) -> DataFrame:
    """Change of each metric against the season before; rows without one give NULL.

    With one row per player and season a player has no more rows than there are seasons,
    so no group needs measuring.
    """

    def build(w: WindowSpec) -> dict[str, Column]:
        follows = F.lag(year).over(w) == F.col(year) - 1
        return {
            f"{m}_change": F.when(follows, F.col(m) - F.lag(m).over(w)) for m in metrics
        }

    return look_back(df, [player], [year], 1, build, limit)


def year_pair_changes(
    df: DataFrame, player: str, metrics: Sequence[str], first: int, second: int, year: str = "year"
) -> DataFrame:
    """Change of each metric between two named seasons, for players in both.

    One grouped pass with a conditional value per season in place of a self join.
    """
    pair = df.where(F.col(year).isin(first, second)).groupBy(player).agg(
        *[F.max(F.when(F.col(year) == y, F.col(m))).alias(f"_{m}_{y}") for m in metrics for y in (first, second)],
        F.count_if(F.col(year) == first).alias("_first"),
        F.count_if(F.col(year) == second).alias("_second"),
    )
    both = pair.where("_first > 0 AND _second > 0")
    return both.select(
        player, *[(F.col(f"_{m}_{second}") - F.col(f"_{m}_{first}")).alias(f"{m}_change") for m in metrics]
    )


def pitch_tempo(
    df: DataFrame,
    game: Sequence[str],
    player: str,
    ts: str,
    order: Sequence[str] = (),
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Mean seconds between a player's successive pitches of a game.

    Gaps add up as whole microseconds, so the mean does not depend on the order of rows.
    """

    def build(w: WindowSpec) -> dict[str, Column]:
        return {"_gap": F.timestamp_diff("MICROSECOND", F.lag(ts).over(w), F.col(ts))}

    keys = list(dict.fromkeys([*game, player]))
    gaps = look_back(df.select(*keys, ts, *order), keys, [ts, *order], 1, build, limit)
    return gaps.groupBy(player).agg(
        _count().alias("pitches"),
        (F.try_divide(F.sum("_gap"), F.count("_gap")) / 1e6).alias("avg_time_between_pitches"),
    )


def active_spin(df: DataFrame, by: Sequence[str] = ("pitcher", "pitch_type")) -> DataFrame:
    """Active-spin share from the spin physics, with spin rate and speed."""
    speed = number(df, "release_speed").alias("_speed")
    inputs = [c for c in SPIN_INPUTS if c in df.columns]
    solved = add_spin_columns(df.select(*by, speed, *inputs), ("spin_rate", "spin_eff"))
    return solved.groupBy(*by).agg(
        F.count("spin_eff").alias("n_pitches"),
        (100 * F.avg("spin_eff")).alias("active_spin"),
        F.avg("spin_rate").alias("spin_rate"),
        F.avg("_speed").alias("velocity"),
    )


def pitch_movement(
    df: DataFrame,
    pitch_type: str | None,
    by: Sequence[str] = ("pitcher", "pitch_type", "p_throws"),
    metrics: dict[str, str] | None = None,
) -> DataFrame:
    """Means per pitcher, pitch type and hand; one pitch type, or all with None."""
    wanted = metrics or {
        "avg_speed": "release_speed",
        "avg_spin": "release_spin_rate",
        "avg_break_x": "pfx_x",
        "avg_break_z": "pfx_z",
    }
    rows = df if pitch_type is None else df.where(F.col("pitch_type") == pitch_type)
    present = {n: c for n, c in wanted.items() if c in df.columns}
    return rows.groupBy(*by).agg(
        _count().alias("pitches"), *[F.avg(number(df, c)).alias(n) for n, c in present.items()]
    )


def spin_direction(df: DataFrame, pitch_type: str | None, by: Sequence[str] = ("pitcher", "pitch_type")) -> DataFrame:
    """Mean spin rate and axis, and the axis as a clock face."""
    means = {"spin_rate": "release_spin_rate", "spin_axis": "spin_axis"}
    rows = pitch_movement(df, pitch_type, by, means)
    return rows.withColumn("spin_direction", axis_to_clock("spin_axis"))


def arm_angles(df: DataFrame, by: Sequence[str] = ("pitcher", "p_throws"), angle: str = "arm_angle") -> DataFrame:
    return pitch_movement(df, None, by, {"arm_angle": angle})


def pitch_mix(
    df: DataFrame, by: Sequence[str], pitch_types: Sequence[str], pitch_type: str = "pitch_type"
) -> DataFrame:
    """Pitches and share per pitch type, one column each; the type list keeps it one pass."""
    kind = F.col(pitch_type)
    names = [t.lower() for t in pitch_types]
    sums = df.groupBy(*by).agg(
        _count().alias("pitches"),
        *[F.count_if(kind == t).alias(f"n_{n}") for t, n in zip(pitch_types, names, strict=True)],
    )
    shares = [_percent(F.col(f"n_{n}"), F.col("pitches")).alias(f"{n}_pct") for n in names]
    return sums.select("*", *shares)


def park_factors(
    df: DataFrame,
    metric: Column,
    home: str = "home_team",
    away: str = "away_team",
    by: Sequence[str] = (),
) -> DataFrame:
    """100 x (metric in a team's park) / (metric in that team's road games).

    Each row counts once at its park and once for the visiting team's road side; both
    sides are summed in one grouped pass.
    """
    at_home, on_road = F.lit(True).alias("_home"), F.lit(False).alias("_home")
    sides = F.array(
        F.struct(F.col(home).alias("team"), at_home), F.struct(F.col(away).alias("team"), on_road)
    )
    rows = df.select(*by, metric.cast("double").alias("_metric"), F.inline(sides))
    rates = rows.groupBy(*by, "team").agg(
        F.count_if("_home").alias("n_home"),
        F.count_if(~F.col("_home")).alias("n_road"),
        F.avg(F.when(F.col("_home"), F.col("_metric"))).alias("home_rate"),
        F.avg(F.when(~F.col("_home"), F.col("_metric"))).alias("road_rate"),
    )
    factor = F.try_divide(100 * F.col("home_rate"), F.col("road_rate"))
    return rates.withColumn("park_factor", factor)


def rolling_mean(
    df: DataFrame,
    player: str,
    order: Sequence[str],
    metric: str,
    rows: int,
    out: str = "rolling",
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Mean of the last ``rows`` rows of each player, the current one included."""

    def build(w: WindowSpec) -> dict[str, Column]:
        return {out: F.avg(metric).over(w.rowsBetween(-(rows - 1), 0))}

    return look_back(df, [player], order, rows - 1, build, limit)


def rolling_days(
    df: DataFrame, player: str, day: str, metric: str, days: int, out: str = "rolling"
) -> DataFrame:
    """Per player and day, the mean over the last ``days`` calendar days.

    Rows are first reduced to one per player and day, so a window group holds at most as
    many rows as the calendar has days.
    """
    daily = df.groupBy(player, F.col(day).cast("date").alias("day")).agg(
        F.sum(metric).alias("_sum"), F.count(metric).alias("_n")
    )
    span = Window.partitionBy(player).orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    mean = F.try_divide(F.sum("_sum").over(span), F.sum("_n").over(span)).alias(out)
    return daily.select(player, "day", F.col("_n").alias("n"), mean)


def all_views(df: DataFrame, views: Sequence[str], build: Callable[[], list[Column]]) -> DataFrame:
    """Several views in one pass: the keys of each view form one grouping set."""
    keys = list(dict.fromkeys(k for v in views for k in view_key(v)))
    sets = [[F.col(k) for k in view_key(v)] for v in views]
    marks = [F.grouping(k) for k in keys]
    grouped = df.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        *build(), *[m.alias(f"_all_{k}") for m, k in zip(marks, keys, strict=True)]
    )
    name = F.lit(None).cast("string")
    ident = F.lit(None).cast("string")
    for v in views:
        own = view_key(v)
        test = F.lit(True)
        for k in keys:
            test = test & (F.col(f"_all_{k}") == (0 if k in own else 1))
        name = F.when(test, v).otherwise(name)
        if own:
            ident = F.when(test, F.col(own[0])).otherwise(ident)
    drop = [f"_all_{k}" for k in keys]
    return grouped.withColumns({"view": name, "id": ident}).drop(*drop, *keys)
