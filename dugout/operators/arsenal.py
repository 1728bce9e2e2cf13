"""Pitcher arsenals: per-group counts, usage shares, metric means and tilt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.functions.spin import axis_to_clock
from dugout.functions.text import day_of, null_to_blank, number
from dugout.operators.grouping import sums_with_labels
from dugout.operators.pitch_search import search_pitches

# Fixed list of averaged metrics, in output order.
ARSENAL_METRICS = (
    "release_speed", "release_spin_rate", "effective_speed", "release_extension",
    "release_pos_x", "release_pos_z", "pfx_x", "pfx_z", "plate_x", "plate_z",
    "launch_speed", "launch_angle", "spin_axis",
)
CARRIED = ("player_name", "p_throws")
# Columns whose distinct values per pitcher are few by nature.
NARROW_KEYS = {"pitcher", "pitch_type", "p_throws"}


def group_key(df: DataFrame, name: str) -> Column:
    """Group keys treat a missing cell, or a missing column, as blank."""
    return (null_to_blank(name) if name in df.columns else F.lit("")).alias(name)


def pitch_order(df: DataFrame) -> Column:
    """Ingest order of a pitch as one long: its ordinal, else its game date and game."""
    if "row_order" in df.columns:
        return F.col("row_order").cast("long")
    if {"game_date", "game_pk"} <= set(df.columns):
        day = F.unix_date(day_of(df, "game_date")).cast("long")
        return day * 10_000_000_000 + F.col("game_pk").try_cast("long")
    return F.lit(0).cast("long")


def aggregate_arsenal(
    df: DataFrame,
    group_by: Sequence[str] = ("pitcher", "pitch_type"),
    metrics: Sequence[str] = ARSENAL_METRICS,
    order: Column | None = None,
) -> DataFrame:
    """One row per group: carried name and hand, ``n_pitches``, shares, means, tilt.

    ``order`` is a long that ranks the rows of a group; name and hand come from the first
    one. ``usage_pct`` exists only when ``pitcher`` is a group key. Means skip blank and
    junk cells; a metric column the table lacks has a NULL mean, as has the tilt of a
    missing axis.
    """
    group_by = list(group_by)
    carried = [c for c in CARRIED if c in df.columns and c not in group_by]
    present = [m for m in metrics if m in df.columns]
    numbers = {m: number(df, m) for m in present}
    rows = df.select(
        *[group_key(df, k) for k in group_by],
        *[null_to_blank(c).alias(c) for c in carried],
        pitch_order(df).alias("_order") if order is None else order.alias("_order"),
        *[numbers[m].alias(f"_{m}") for m in present],
    )
    sums = {"n_pitches": F.lit(1).cast("long")}
    for m in present:
        sums[f"_{m}"] = F.col(f"_{m}")
        sums[f"_n_{m}"] = F.col(f"_{m}").isNotNull().cast("long")
    grouped = sums_with_labels(rows, group_by, carried, "_order", sums)
    head = [*group_by, *carried, "n_pitches"]
    if "pitcher" in group_by:
        grouped = add_usage(grouped, rows, narrow=set(group_by) <= NARROW_KEYS)
        head.append("usage_pct")
    means = grouped.select(
        *head,
        *[
            (F.try_divide(f"_{m}", f"_n_{m}") if m in present else F.lit(None).cast("double")).alias(
                f"avg_{m}"
            )
            for m in metrics
        ],
    )
    if "spin_axis" in metrics:
        return means.withColumn("avg_tilt", axis_to_clock("avg_spin_axis"))
    return means


def add_usage(grouped: DataFrame, rows: DataFrame, narrow: bool) -> DataFrame:
    """Share of the pitcher's pitches per group.

    With few groups per pitcher a window on the grouped rows does. With arbitrary keys a
    pitcher may own many groups, so totals come from a second scan, which reads the pitcher's
    column alone, and are joined.
    """
    share = (F.lit(100.0) * F.col("n_pitches") / F.col("_total")).alias("usage_pct")
    if narrow:
        totals = F.sum("n_pitches").over(Window.partitionBy("pitcher"))
        return grouped.withColumn("_total", totals).select(*grouped.columns, share)
    totals = rows.groupBy(F.col("pitcher").alias("_pitcher")).agg(F.count(F.lit(1)).alias("_total"))
    return grouped.join(totals, F.col("pitcher") == F.col("_pitcher")).select(*grouped.columns, share)


def pitcher_arsenal(
    df: DataFrame, pitcher_id: int | str, start, end, level: str = "mlb", **filters
) -> DataFrame:
    """Arsenal of one pitcher over a date span; the filters reach the scan."""
    rows = search_pitches(df, start, end, "pitcher", pitcher_id, level, **filters)
    return aggregate_arsenal(rows)
