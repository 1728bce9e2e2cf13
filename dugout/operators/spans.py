"""Sums over any span of seasons, and the coverage of pulled spans of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugout.functions.text import number
from dugout.operators.ordered import GROUP_LIMIT, look_back, running_total, same

PULL_DAYS = 6


def season_sums(df: DataFrame, keys: Sequence[str], year: str, sums: Sequence[str]) -> DataFrame:
    """Cumulative sums per key and season, a row for every season from the key's first to its last.

    Any span is then the difference of two rows. A missing number adds nothing; rows without a season
    are left out. ``n_seasons`` counts the seasons with rows so far. A key has as many rows as the
    calendar has seasons, so its window is small.
    """
    known = df.where(F.col(year).isNotNull())
    yearly = known.groupBy(*keys, F.col(year).cast("int").alias(year)).agg(
        *[F.sum(F.coalesce(number(df, c), F.lit(0.0))).alias(c) for c in sums]
    )
    of_key = Window.partitionBy(*keys).orderBy(year)
    upto = of_key.rowsBetween(Window.unboundedPreceding, 0)
    running = {c: F.sum(c).over(upto) for c in sums} | {"n_seasons": F.count(F.lit(1)).over(upto)}
    totals = yearly.withColumns(running).withColumn("_next", F.lead(year).over(of_key))
    filled = F.sequence(F.col(year), F.coalesce(F.col("_next") - 1, F.col(year)))
    return totals.withColumn(year, F.explode(filled)).select(*keys, year, "n_seasons", *sums)


def over_spans(cumulative: DataFrame, spans: DataFrame, keys: Sequence[str], year: str, sums: Sequence[str], start: str, end: str) -> DataFrame:
    """For each distinct span (``start``, ``end``), both ends included, and each key with a season in it: the sums.

    Two look-ups per span and key: the last cumulative row up to the end and the one before the start, each by
    equality. Spans that end before they start give no rows.
    """
    asked = spans.select(F.col(start).cast("int").alias(start), F.col(end).cast("int").alias(end)).distinct().where(F.col(start) <= F.col(end))
    bounds = cumulative.groupBy(*keys).agg(F.min(year).alias("_first"), F.max(year).alias("_last"))
    names = [f"_key{i}" for i in range(len(keys))]
    # A key's last season stands for all later ones: a span meets the row of its end, or the last row before it.
    edge = bounds.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "_first", "_last")
    rows = cumulative.join(edge, same(keys, names)).drop(*names)
    ends = asked.select(start, end, F.explode(F.sequence(F.col(start), F.col(end))).alias("_at"))
    upper = rows.join(ends, F.col(year) == F.col("_at")).where((F.col("_at") == F.col(end)) | (F.col("_at") == F.col("_last")))
    lower = cumulative.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(year).alias("_y"), *[F.col(c).alias(f"_before_{c}") for c in ("n_seasons", *sums)]
    )
    both = upper.join(lower, same(keys, names) & (F.col("_y") == F.col(start) - 1), "left")
    differ = {c: F.col(c) - F.coalesce(F.col(f"_before_{c}"), F.lit(0.0)) for c in sums}
    # The filled seasons of a key may lie in a span without any of its own.
    both = both.where(F.col("n_seasons") > F.coalesce("_before_n_seasons", F.lit(0)))
    return both.select(*keys, start, end, *[v.alias(c) for c, v in differ.items()])


def covered(pulls: DataFrame, keys: Sequence[str], start: str, end: str, limit: int | None = GROUP_LIMIT) -> DataFrame:
    """Disjoint spans (keys, ``start``, ``end``) of the days that some pull covers, as long as they go.

    A sweep over the ends of spans: +1 where one starts, -1 on the day after it ends; days combine before the
    shuffle, and the running total goes by slices where a key has very many. Pulls without both ends, or that end
    before they start, cover nothing.
    """
    known = pulls.select(*keys, F.col(start).cast("date").alias("_s"), F.col(end).cast("date").alias("_e")).where("_s <= _e")
    step = F.inline(F.array(F.struct(F.col("_s").alias("_day"), F.lit(1).alias("_step")), F.struct(F.date_add("_e", 1).alias("_day"), F.lit(-1).alias("_step"))))
    steps = known.select(*keys, step).groupBy(*keys, "_day").agg(F.sum("_step").alias("_step"))
    open_now = running_total(steps, keys, ["_day"], F.col("_step"), "_open", limit)
    # What ends a covered stretch is a day without an open pull; what starts one, the day after such a day.
    marked = look_back(open_now, keys, ["_day"], 1, lambda w: {"_was": F.lag("_open").over(w)}, limit)
    edges = marked.where((F.col("_open") == 0) | (F.coalesce("_was", F.lit(0)) == 0))
    # Edges alternate: a start, its end, the next start.
    paired = look_back(edges, keys, ["_day"], 1, lambda w: {"_from": F.lag("_day").over(w)}, limit)
    return paired.where("_open = 0 AND _from IS NOT NULL").select(*keys, F.col("_from").alias(start), F.date_sub("_day", 1).alias(end))


def gaps(spans: DataFrame, wanted: DataFrame, keys: Sequence[str], start: str, end: str, limit: int | None = GROUP_LIMIT) -> DataFrame:
    """Spans of the days that ``wanted`` (keys, ``start``, ``end``, one row a key) asks for and ``spans`` lack."""
    # The wanted span with its days before and after as sentinels: what lies between neighbours is a gap.
    asked = wanted.select(*keys, F.col(start).cast("date").alias("_first"), F.col(end).cast("date").alias("_last"))
    names = [f"_key{i}" for i in range(len(keys))]
    side = asked.withColumnsRenamed(dict(zip(keys, names, strict=True)))
    inside = spans.join(side, same(keys, names)).where((F.col(end) >= F.col("_first")) & (F.col(start) <= F.col("_last")))
    inside = inside.select(*keys, F.greatest(start, "_first").alias("_s"), F.least(end, "_last").alias("_e"))
    before = asked.select(*keys, F.date_sub("_first", 1).alias("_s"), F.date_sub("_first", 1).alias("_e"))
    after = asked.select(*keys, F.date_add("_last", 1).alias("_s"), F.date_add("_last", 1).alias("_e"))
    every = inside.unionByName(before).unionByName(after)
    placed = look_back(every, keys, ["_s"], 1, lambda w: {"_prior": F.lag("_e").over(w)}, limit)
    return placed.where(F.date_add("_prior", 1) < F.col("_s")).select(
        *keys, F.date_add("_prior", 1).alias(start), F.date_sub("_s", 1).alias(end)
    )


def pull_plan(missing: DataFrame, keys: Sequence[str], start: str, end: str, days: int = PULL_DAYS) -> DataFrame:
    """``missing`` spans cut into pulls of at most ``days`` days."""
    first = F.explode(F.sequence(F.col(start), F.col(end), F.make_interval(days=F.lit(days)))).alias("_from")
    cut = missing.select(*keys, first, F.col(end).alias("_to"))
    return cut.select(*keys, F.col("_from").alias(start), F.least(F.date_add("_from", days - 1), F.col("_to")).alias(end))
