"""Leaders, sorted pages, record highs and lows, percentile ranks.

Ranks come from counts per distinct value, which combine before the shuffle, so a category
that holds most rows, or one value shared by most rows, never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugout.operators.ordered import GROUP_LIMIT, numbered, running_total, same

BROADCAST_ROWS = 100_000
TOP_SLICES = 64
PAGE_ROWS = 100_000


def unpivot_stats(
    df: DataFrame, ids: Sequence[str], stats: Sequence[str], name: str = "category", value: str = "value"
) -> DataFrame:
    """Wide stat columns to (id..., category, value) rows; missing values are dropped."""
    wide = df.select(*ids, *[F.col(s).cast("double").alias(s) for s in stats])
    return wide.unpivot(list(ids), list(stats), name, value).where(F.col(value).isNotNull())


def leaders(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    top: int | None = None,
    descending: bool = True,
    rank: str = "rank",
    groups: int | None = None,
) -> DataFrame:
    """Rows ranked within ``top`` per group (all of them without), ties kept (1, 1, 3, ...).

    The cut-off table holds at most ``top`` distinct values per group and is built from
    per-value counts; the rows themselves are only filtered and joined, never gathered.
    A group's values are first cut to ``top`` in each of a fixed number of slices, so a
    category with many values is not sorted in one task. Without ``top``, ranks are running totals
    over the values, cut into slices where a group is hot; ``value`` must then be a number.
    Where the caller knows how many ``groups`` there are at most, the cut-off table has a
    proven size and is broadcast, which spares the rows a shuffle.
    """
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    if top is None:
        step = F.col(value) * (-1 if descending else 1)
        upto = running_total(counts.withColumn("_step", step), by, ["_step"], F.col("_n"), "_upto")
        cut = upto.withColumn(rank, (F.col("_upto") - F.col("_n") + 1).cast("long")).select(*by, value, rank)
    else:
        direction = F.desc(value) if descending else F.asc(value)
        slices = Window.partitionBy(*by, "_slice").orderBy(direction)
        few = (
            counts.withColumn("_slice", F.pmod(F.xxhash64(value), F.lit(TOP_SLICES)))
            .withColumn("_place", F.row_number().over(slices))
            .where(F.col("_place") <= top)
        )
        w = Window.partitionBy(*by).orderBy(direction) if by else Window.orderBy(direction)
        best = few.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= top)
        above = w.rowsBetween(Window.unboundedPreceding, -1)
        cut = best.withColumn(rank, (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).cast("long"))
        cut = cut.where(F.col(rank) <= top).select(*by, value, rank)
    return _join_groups(known, _bounded(cut, groups, top), [*by, value], rank)


def _join_groups(df: DataFrame, table: DataFrame, keys: Sequence[str], *extra: str) -> DataFrame:
    """``df`` with ``extra`` from ``table``, groups that are NULL included."""
    names = [f"_key{i}" for i in range(len(keys))]
    side = table.withColumnsRenamed(dict(zip(keys, names, strict=True)))
    return df.join(side, same(keys, names)).select(*df.columns, *extra)


def _bounded(table: DataFrame, groups: int | None, rows: int | None) -> DataFrame:
    """``table`` marked for broadcast if ``groups`` times ``rows`` bounds it well enough."""
    if groups is not None and rows is not None and groups * rows <= BROADCAST_ROWS:
        return F.broadcast(table)
    return table


def high_low(df: DataFrame, by: Sequence[str], value: str, groups: int | None = None) -> DataFrame:
    """Rows holding the highest or lowest value per group, tagged ``high`` / ``low``."""
    ends = df.groupBy(*by).agg(F.max(value).alias("high"), F.min(value).alias("low"))
    marks = ends.unpivot(list(by), ["high", "low"], "record", value).where(F.col(value).isNotNull())
    return _join_groups(df, _bounded(marks, groups, 2), [*by, value], "record")


def page(
    df: DataFrame,
    sort: str,
    ties: Sequence[str],
    limit: int | None = None,
    offset: int = 0,
    descending: bool = True,
) -> DataFrame:
    """One page of sorted rows; ``ties`` makes the order total so pages never overlap.

    A page that ends within ``PAGE_ROWS`` rows comes from each task's first rows. A deeper or
    open one is cut by place, so that no task gathers what lies before or after it.
    """
    if (offset or limit is not None) and not ties:
        raise ValueError("pages need tie keys, or they may overlap")
    order = [F.desc(sort) if descending else F.asc(sort), *[F.asc(t) for t in ties]]
    if not offset and limit is None:
        return df.orderBy(*order)
    if limit is not None and offset + limit <= PAGE_ROWS:
        ordered = df.orderBy(*order)
        return (ordered.offset(offset) if offset else ordered).limit(limit)
    placed = numbered(df, order, "_place").where(F.col("_place") > offset)
    wanted = placed if limit is None else placed.where(F.col("_place") <= offset + limit)
    return wanted.orderBy("_place").drop("_place")


def percentiles(
    df: DataFrame,
    by: Sequence[str],
    metrics: Sequence[str],
    suffix: str = "_pct",
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """0-100 percentile of each metric within its group; NULL metrics get NULL.

    Ranks are read off running totals over distinct values, whatever a group's size; groups
    with more than ``limit`` distinct values are cut into slices.
    """
    out = df
    for m in metrics:
        out = _percentile_by_counts(out, by, m, m + suffix, limit)
    return out


def _percentile_by_counts(df: DataFrame, by, metric: str, out: str, limit: int) -> DataFrame:
    counts = (
        df.where(F.col(metric).isNotNull())
        .groupBy(*by, metric)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    upto = running_total(counts, by, [metric], F.col("_n"), "_upto", limit)
    size = counts.groupBy(*by).agg(F.sum("_n").alias("_size"))
    share = F.when(F.col("_size") == 1, F.lit(0.0)).otherwise(
        100 * ((F.col("_upto") - F.col("_n")) / (F.col("_size") - 1))
    )
    ranked = _join_groups(upto, size, list(by), "_size").withColumn(out, share)
    names = [f"_key{i}" for i in range(len(by) + 1)]
    keys = [*by, metric]
    side = ranked.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], out)
    return df.join(side, same(keys, names), "left").select(*df.columns, out)
