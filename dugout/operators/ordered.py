"""Ordered per-key work (lag, rolling, running totals, fill-forward) that survives hot keys.

A window partition is one task's work, so a key holding a large share of all rows would
put that share on one executor. Each function here first measures the largest key with a
count that combines before the shuffle. Below ``limit`` rows per key a plain window is
the cheapest plan. The rows of the keys above it, and only those, are range-partitioned on
(key, order) into slices of even size, checkpointed so slice numbers stay fixed if executors
are lost, and worked on slice by slice; what crosses a slice border is carried by a small
table with at most two rows per slice border. Both ways give the same rows, for NULL keys too.
The limit counts rows: carry wide columns (payload bodies) beside, and join them after.

The order columns must be unique within a key (``fill_forward``: rows that carry a value).
``limit=None`` states that groups are small by nature and skips the measuring pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dugout.session import shared_dir, shared_path, shuffle_partitions

GROUP_LIMIT = 2_000_000
SLICE = "_slice"
POSITION = "_position"


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Join condition under which NULL keys meet, as they do in a window."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def split_hot(df: DataFrame, keys: Sequence[str], limit: int | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of keys with more than ``limit`` rows or None).

    Runs a counting job at once; the hot keys, at most rows / limit of them, are written to the
    shared folder, so the count runs once.
    """
    if limit is None:
        return df, None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    names = [f"_hot{i}" for i in range(len(keys))]
    path = shared_path(df.sparkSession, "hot-keys")
    counts.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).write.parquet(path)
    hot = df.sparkSession.read.parquet(path)
    if hot.isEmpty():
        return df, None
    return df.join(hot, same(keys, names), "left_anti"), df.join(hot, same(keys, names), "left_semi")


def both_ways(
    df: DataFrame,
    keys: Sequence[str],
    limit: int | None,
    plain: Callable[[DataFrame], DataFrame],
    hot: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``plain`` on the rows of ordinary keys and ``hot`` on those of hot ones."""
    ordinary, rest = split_hot(df, keys, limit)
    if rest is None:
        return plain(ordinary)
    return plain(ordinary).unionByName(hot(rest))


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows range-partitioned on key and order, numbered by slice, reliably checkpointed."""
    spark = df.sparkSession
    shared_dir(spark)
    ranged = df.repartitionByRange(shuffle_partitions(spark), *keys, *order)
    return ranged.withColumn(SLICE, F.spark_partition_id()).checkpoint()


def _borders(slices: DataFrame, keys: Sequence[str], local: Column, carry: str, agg) -> DataFrame:
    """Per (key, slice) what the earlier slices of that key hand over.

    Only keys that span several slices are kept: a sorted layout has at most two such rows
    per slice border, so the table is bounded by the slice count and safe to broadcast.
    """
    per_slice = slices.groupBy(*keys, SLICE).agg(local.alias("_local"))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    spanning = per_slice.withColumns(
        {carry: agg("_local").over(before), "_slices": F.count(F.lit(1)).over(Window.partitionBy(*keys))}
    )
    return spanning.where("_slices > 1").select(*keys, SLICE, carry)


def _join_borders(slices: DataFrame, borders: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = [f"_border{i}" for i in range(len(keys) + 1)]
    all_keys = [*keys, SLICE]
    renamed = borders.withColumnsRenamed(dict(zip(all_keys, names, strict=True)))
    return slices.join(F.broadcast(renamed), same(all_keys, names), "left").drop(*names)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    limit: int | None = GROUP_LIMIT,
) -> DataFrame:
    """Inclusive running sum of ``value`` per key."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return both_ways(
        df,
        keys,
        limit,
        lambda rows: rows.withColumn(out, F.sum(value).over(upto)),
        lambda rows: total_over_slices(sliced(rows, keys, order), keys, order, value, out).drop(SLICE),
    )


def total_over_slices(
    slices: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str
) -> DataFrame:
    """The running sum on rows that are already cut into slices."""
    inner = (
        Window.partitionBy(SLICE, *keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    borders = _borders(slices, keys, F.sum(value), "_before", F.sum)
    joined = _join_borders(slices, borders, keys)
    zero = F.lit(0)
    return joined.withColumn(out, F.sum(value).over(inner) + F.coalesce(F.col("_before"), zero)).drop(
        "_before"
    )


def look_back(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    back: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    limit: int | None = GROUP_LIMIT,
) -> DataFrame:
    """Window columns that look at most ``back`` rows back: lags, rolling means.

    Hot keys: exact positions cut each key into blocks; the last ``back`` rows of a block
    are repeated at the head of the next one, and dropped again after the window.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    return both_ways(
        df,
        keys,
        limit,
        lambda rows: rows.withColumns(build(spec)),
        lambda rows: _look_back_in_blocks(rows, keys, order, back, build, max(back, limit)),
    )


def _look_back_in_blocks(df, keys, order, back: int, build, block: int) -> DataFrame:
    one = F.lit(1).cast("long")
    placed = total_over_slices(sliced(df, keys, order), keys, order, one, POSITION).drop(SLICE)
    number = F.floor((F.col(POSITION) - 1) / block)
    tail = (F.col(POSITION) - 1) % block >= block - back
    own = F.struct(number.alias("_block"), F.lit(False).alias("_repeat"))
    again = F.struct((number + 1).alias("_block"), F.lit(True).alias("_repeat"))
    copies = placed.withColumn("_home", F.when(tail, F.array(own, again)).otherwise(F.array(own)))
    blocks = copies.select(*placed.columns, F.inline("_home"))
    spec = Window.partitionBy(*keys, "_block").orderBy(POSITION)
    return (
        blocks.withColumns(build(spec))
        .where(~F.col("_repeat"))
        .drop("_block", "_repeat", POSITION)
    )


def fill_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    limit: int | None = GROUP_LIMIT,
) -> DataFrame:
    """Latest non-null ``value`` at or before each row of its key."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return both_ways(
        df,
        keys,
        limit,
        lambda rows: rows.withColumn(out, F.last(value, ignorenulls=True).over(upto)),
        lambda rows: _fill_over_slices(rows, keys, order, value, out),
    )


def _fill_over_slices(df: DataFrame, keys, order, value: str, out: str) -> DataFrame:
    slices = sliced(df, keys, order)
    inner = (
        Window.partitionBy(SLICE, *keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    at = F.when(F.col(value).isNotNull(), F.struct(*order))
    borders = _borders(
        slices, keys, F.max_by(value, at), "_before", lambda c: F.last(c, ignorenulls=True)
    )
    joined = _join_borders(slices, borders, keys)
    here = F.last(value, ignorenulls=True).over(inner)
    return joined.withColumn(out, F.coalesce(here, F.col("_before"))).drop(SLICE, "_before")


def numbered(df: DataFrame, order: Sequence[Column], out: str = POSITION) -> DataFrame:
    """Adds each row's place (from 1) in the total order ``order``; no task holds all rows.

    Rows are range-partitioned in that order, checkpointed, and numbered slice by slice on
    top of the counts of the slices before.
    """
    spark = df.sparkSession
    shared_dir(spark)
    ranged = df.repartitionByRange(shuffle_partitions(spark), *order)
    slices = ranged.withColumn(SLICE, F.spark_partition_id()).checkpoint()
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    counts = slices.groupBy(F.col(SLICE).alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_of", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy(SLICE).orderBy(*order))
    placed = slices.withColumn(out, inner).join(F.broadcast(starts), F.col(SLICE) == F.col("_of"))
    return placed.withColumn(out, F.col(out) + F.col("_before")).select(*df.columns, out)
