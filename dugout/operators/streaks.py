"""Hitting and on-base streaks over a player's ordered games."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.operators.ordered import GROUP_LIMIT, both_ways, look_back, running_total, same, sliced, total_over_slices

# Fixed names: streak types as (flag, side) and spans.
STREAK_TYPES = {
    "hittingStreakOverall": ("hit", None),
    "hittingStreakHome": ("hit", True),
    "hittingStreakAway": ("hit", False),
    "onBaseOverall": ("on_base", None),
    "onBaseHome": ("on_base", True),
    "onBaseAway": ("on_base", False),
}
STREAK_SPANS = (
    "career", "season", "currentStreak", "currentStreakInSeason", "notable", "notableInSeason",
)
BY_SEASON = {"season", "currentStreakInSeason", "notableInSeason"}


def islands(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column, limit: int = GROUP_LIMIT
) -> DataFrame:
    """Runs of consecutive rows with ``flag``: length, first and last order value, current.

    A run is named by the number of misses before it, a running total; runs are then plain
    grouped counts, whatever the size of a key. The current run is the one after the key's
    last miss. For ordinary keys all of it happens in the one shuffle on the key.
    """
    rows = df.select(*keys, *order, F.coalesce(flag, F.lit(False)).alias("_hit"))
    miss = F.when(F.col("_hit"), 0).otherwise(1).cast("long")

    def plain(part: DataFrame) -> DataFrame:
        runs = _runs(running_total(part, keys, order, miss, "_run", None), keys, order[0])
        last = F.max("_run").over(Window.partitionBy(*keys))
        return runs.withColumn("is_current", F.col("_run") == last).where("length > 0").drop("_run")

    def hot(part: DataFrame) -> DataFrame:
        slices = sliced(part, keys, order)
        runs = _runs(total_over_slices(slices, keys, order, miss, "_run"), keys, order[0])
        names = [f"_last{i}" for i in range(len(keys))]
        owned = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
        last = slices.groupBy(*owned).agg(F.sum(miss).alias("_last"))
        found = runs.where("length > 0").join(last, same(keys, names))
        return found.withColumn("is_current", F.col("_run") == F.col("_last")).drop("_run", "_last", *names)

    return both_ways(rows, keys, limit, plain, hot)


def _runs(numbered: DataFrame, keys: Sequence[str], start: str) -> DataFrame:
    when_hit = F.when(F.col("_hit"), F.col(start))
    return numbered.groupBy(*keys, "_run").agg(
        F.count_if("_hit").alias("length"),
        F.min(when_hit).alias("started"),
        F.max(when_hit).alias("ended"),
    )


def streaks(
    games: DataFrame,
    streak_type: str,
    streak_span: str,
    *,
    player: str,
    order: Sequence[str],
    season: str,
    flags: dict[str, Column],
    home: Column | None = None,
    only_season: int | None = None,
    least: int = 1,
    top: int | None = None,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Streaks of one type over one span.

    ``flags`` gives the ``hit`` and ``on_base`` tests. Season spans break streaks at the
    season's end; *current* keeps the run that holds the player's last game; *notable*
    keeps runs of at least ``least`` games. ``top`` keeps the longest.
    """
    if streak_type not in STREAK_TYPES:
        raise ValueError(f"{streak_type!r} is not a streak type: {sorted(STREAK_TYPES)}")
    if streak_span not in STREAK_SPANS:
        raise ValueError(f"{streak_span!r} is not a streak span: {STREAK_SPANS}")
    flag, side = STREAK_TYPES[streak_type]
    rows = games
    if side is not None:
        if home is None:
            raise ValueError(f"{streak_type!r} needs the home test")
        rows = rows.where(home if side else ~home)
    keys = [player]
    if streak_span in BY_SEASON:
        keys.append(season)
        if only_season is not None:
            rows = rows.where(F.col(season) == only_season)
    found = islands(rows, keys, order, flags[flag], limit)
    if streak_span.startswith("current"):
        found = found.where("is_current")
    if streak_span.startswith("notable"):
        found = found.where(F.col("length") >= least)
    if top is not None:
        found = found.orderBy(F.desc("length"), *keys, "started").limit(top)
    return found


# What a slice of a player's games says about its streaks; summaries of neighbouring slices join to one.
SUMMARY = ("length", "started", "ended", "at_start", "at_end")


def streak_summary(
    games: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column, part: Column, limit: int | None = GROUP_LIMIT
) -> DataFrame:
    """Runs (keys, ``part``, length, started, ended, at_start, at_end) of each slice of games.

    ``part`` numbers the slices in the order of games: a season, a month, a batch. A run that touches its slice's
    first or last game may go on in a neighbour. A slice with no run, or none at its end, still has a
    row, of length 0, so that what lies around it is not joined.
    """
    placed = games.withColumn("part", part)
    own = [*keys, "part"]
    numbered = running_total(
        placed.select(*own, *order, F.coalesce(flag, F.lit(False)).alias("_hit")),
        own,
        order,
        F.when(F.col("_hit"), 0).otherwise(1).cast("long"),
        "_run",
        limit,
    )
    # A run's number is the misses before it: 0 touches the start, as many as there are touches the end.
    runs = _runs(numbered, own, order[0])
    names = [f"_own{i}" for i in range(len(own))]
    ends = numbered.groupBy(*[F.col(k).alias(n) for k, n in zip(own, names, strict=True)]).agg(F.max("_run").alias("_last"))
    joined = runs.join(ends, same(own, names))
    kept = joined.where((F.col("length") > 0) | (F.col("_run") == F.col("_last")))
    at_end = (F.col("_run") == F.col("_last")) & (F.col("length") > 0)
    return kept.select(*own, "length", "started", "ended", (F.col("_run") == 0).alias("at_start"), at_end.alias("at_end"), F.col("_run").alias("place"))


def join_summaries(summaries: DataFrame, keys: Sequence[str], limit: int | None = GROUP_LIMIT) -> DataFrame:
    """Streaks (keys, length, started, ended, is_current) of whole histories from summaries of their slices.

    Joining is associative, so it does not matter how games were cut. A player has a few rows a
    slice, and players with more than ``limit`` of them are cut in turn.
    """
    order = ["part", "place"]
    goes_on = {
        "_end": F.lag("at_end"),
        "_part": F.lag("part"),
    }
    marked = look_back(summaries, keys, order, 1, lambda w: {n: c.over(w) for n, c in goes_on.items()}, limit)
    joins = F.coalesce(F.col("at_start") & F.col("_end") & (F.col("part") != F.col("_part")) & (F.col("length") > 0), F.lit(False))
    new = F.when(joins, 0).otherwise(1).cast("long")
    numbered = running_total(marked, keys, order, new, "_streak", limit)
    found = numbered.groupBy(*keys, "_streak").agg(
        F.sum("length").alias("length"),
        F.min("started").alias("started"),
        F.max("ended").alias("ended"),
        F.max(F.struct("part", "place", "at_end")).alias("_final"),
    )
    names = [f"_own{i}" for i in range(len(keys))]
    last = numbered.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(F.max("_streak").alias("_newest"))
    current = (F.col("_streak") == F.col("_newest")) & F.col("_final.at_end")
    whole = found.join(last, same(keys, names)).where("length > 0")
    return whole.select(*keys, "length", "started", "ended", current.alias("is_current"))
