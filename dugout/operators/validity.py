"""States that hold from one change to the next, looked up for many dates at once.

Changes become intervals ``[day, until)``. Intervals and dates are dealt into bins of days; a date meets, by an
equality join on bin and keys, only intervals that touch its bin. A key with very many rows is
spread over its bins, and Spark splits what is still too much at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugout.operators.ordered import GROUP_LIMIT, look_back, same

BIN_DAYS = 32


def intervals(
    changes: DataFrame, keys: Sequence[str], day: str, ties: Sequence[str] = (), until: str = "until", limit: int | None = GROUP_LIMIT
) -> DataFrame:
    """``changes`` with ``until``, the day of the key's next change, NULL for the last one.

    Of several changes of a key on one day the one with the largest ``ties`` holds; NULL is a key;
    changes without a day hold never.
    """
    known = changes.where(F.col(day).isNotNull())
    of_day = Window.partitionBy(*keys, day).orderBy(*[F.desc(t) for t in ties], F.desc(F.xxhash64(*changes.columns)))
    last = known.withColumn("_place", F.row_number().over(of_day)).where("_place = 1").drop("_place")
    # Only keys and days are put in order; whole rows then join the next day.
    dates = last.select(*keys, day)
    ahead = look_back(dates, keys, [day], 1, lambda w: {"_prior": F.lag(day).over(w)}, limit).where("_prior IS NOT NULL")
    names = [f"_key{i}" for i in range(len(keys))]
    side = ahead.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "_prior", F.col(day).alias(until))
    return last.join(side, same(keys, names) & (F.col(day) == F.col("_prior")), "left").drop(*names, "_prior")


def at_dates(
    held: DataFrame,
    dates: DataFrame,
    on: Sequence[str],
    date: str,
    day: str = "day",
    until: str = "until",
    width: int = BIN_DAYS,
) -> DataFrame:
    """For each distinct row (``on``, ``date``) of ``dates`` the intervals of the same ``on`` that hold on it.

    ``on`` may be empty and may hold NULLs. An open interval reaches to the last date asked for, so
    the number of bins is bounded by the calendar. Runs a job for that last date.
    """
    probes = dates.select(*on, F.col(date).cast("date").alias(date)).where(F.col(date).isNotNull()).distinct()
    first, last = probes.agg(F.min(date), F.max(date)).first()

    def bin_of(c):
        return F.floor(F.unix_date(c) / width)

    start = F.greatest(F.col(day).cast("date"), F.lit(first))
    end = F.least(F.coalesce(F.date_sub(F.col(until).cast("date"), 1), F.lit(last)), F.lit(last))
    touched = held.where(start <= end).withColumn("_bin", F.explode(F.sequence(bin_of(start), bin_of(end))))
    names = [f"_on{i}" for i in range(len(on))]
    asked = probes.withColumnsRenamed(dict(zip(on, names, strict=True))).withColumn("_bin_asked", bin_of(F.col(date)))
    equal = F.col("_bin") == F.col("_bin_asked")
    if on:
        equal = equal & same(on, names)
    holds = (F.col(day) <= F.col(date)) & (F.col(until).isNull() | (F.col(date) < F.col(until)))
    return touched.join(asked, equal & holds).drop(*names, "_bin", "_bin_asked")
