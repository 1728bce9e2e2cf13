"""Entity queries over landed payload tables: filters, dates, feeds, hydration, merges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dugout.functions.text import TIMECODE, as_col, format_timecode
from dugout.operators.ordered import GROUP_LIMIT, fill_forward, same
from dugout.operators.pitch_search import value_filter
from dugout.operators.ranking import page
from dugout.session import shared_path


def entity_filter(df: DataFrame, **filters: Any) -> DataFrame:
    """Equality or membership per column; unset filters are skipped."""
    out = df
    for column, value in filters.items():
        if value is not None:
            out = out.where(value_filter(df, column, value))
    return out


def _day(value: Any) -> Column:
    return F.lit(value).cast("date") if not isinstance(value, Column) else value


def date_window(
    df: DataFrame, column: str, on: Any = None, start: Any = None, end: Any = None
) -> DataFrame:
    """Rows of one date, or of a span with both ends included."""
    out, day = df, F.col(column)
    if on is not None:
        out = out.where(day == _day(on))
    if start is not None:
        out = out.where(day >= _day(start))
    if end is not None:
        out = out.where(day <= _day(end))
    return out


def as_of_date(df: DataFrame, keys: Sequence[str], column: str, on: Any) -> DataFrame:
    """Per key, NULL being one, the latest row at or before a date.

    The latest date per key is found with a numeric hash aggregate and joined back, so
    whole rows are never carried through aggregation buffers.
    """
    if not keys:
        raise ValueError("the state at a date needs the columns that name what has a state")
    known = df.where(F.col(column) <= _day(on))
    names = [f"_key{i}" for i in range(len(keys))]
    owned = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    latest = known.groupBy(*owned).agg(F.max(column).alias("_latest"))
    return known.join(latest, same(keys, names) & (F.col(column) == F.col("_latest"))).drop(*names, "_latest")


def changed_since(
    df: DataFrame, updated: str, since: Any, limit: int | None = None, offset: int = 0, ties: Sequence[str] = ()
) -> DataFrame:
    """Rows updated at or after a time; pages go by time, then ``ties``, which a page needs."""
    rows = df.where(F.col(updated) >= F.lit(since).cast(df.schema[updated].dataType))
    if limit is None and not offset:
        return rows
    if not ties:
        raise ValueError("pages of changes need a tie key, or they may overlap")
    return page(rows, updated, ties, limit, offset, descending=False)


def moment(timecode: str | Column) -> Column:
    """A timecode (``YYYYMMDD_HHMMSS``) as a zone-less timestamp."""
    if isinstance(timecode, Column):
        return timecode
    return F.to_timestamp(F.lit(timecode), TIMECODE).cast("timestamp_ntz")


def one_per_time(df: DataFrame, game: str, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row per game and time: the largest ``ties``, then the largest hash of the plain columns.

    Only (game, time, ties, hash) are compared, as numbers and plain values; rows equal in all of
    them differ in nothing that could be told apart, and one stays.
    """
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    tied = df.withColumn("_hash", F.xxhash64(*plain))
    last = Window.partitionBy(game, ts).orderBy(*[F.desc(t) for t in ties], F.desc("_hash"))
    # Few rows share a game and a time, so this window is small; it carries bodies, but sorts and aggregates none.
    return tied.withColumn("_place", F.row_number().over(last)).where("_place = 1").drop("_place", "_hash")


def feed_at(df: DataFrame, game: str, ts: str, timecode: str | Column | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Per game the snapshot in force at a timecode (the latest one without).

    The time comes first, from a small hash aggregate, then the snapshot by a join: bodies do
    not pass through aggregation buffers. Of snapshots of one game and time the one with the
    largest ``ties`` counts.
    """
    seen = df if timecode is None else df.where(F.col(ts) <= moment(timecode))
    newest = seen.groupBy(F.col(game).alias("_game")).agg(F.max(ts).alias("_newest"))
    rows = seen.join(newest, F.col(game).eqNullSafe(F.col("_game")) & (F.col(ts) == F.col("_newest")))
    return one_per_time(rows.drop("_game", "_newest"), game, ts, ties)


def feed_between(
    df: DataFrame, ts: str, start: str | Column | None = None, end: str | Column | None = None
) -> DataFrame:
    """Snapshots after one timecode, up to another; either may be left open."""
    after = F.lit(True) if start is None else F.col(ts) > moment(start)
    return df.where(after if end is None else after & (F.col(ts) <= moment(end)))


def feed_timecodes(df: DataFrame, game: str, ts: str, out: str = "timecode") -> DataFrame:
    return df.select(game, format_timecode(ts).alias(out)).distinct()


def feed_at_probes(
    feeds: DataFrame,
    probes: DataFrame,
    game: str,
    ts: str,
    body: str,
    probe: str,
    out: str = "body_at",
    limit: int = GROUP_LIMIT,
    ties: Sequence[str] = (),
) -> DataFrame:
    """For each probe row the body in force at its own time, NULL before the first.

    Both sides are stacked and the snapshot's time is carried forward in time order, so no
    pair of probe and snapshot is ever formed, however many a game has; the body then joins by
    game and time. A snapshot at the very time of a probe counts; one without a body does not.
    """
    marks = probes.select(game, F.col(ts).alias("_at"), F.lit(1).alias("_side"), probe)
    known = feeds.where(F.col(body).isNotNull())
    shots = known.select(game, F.col(ts).alias("_at"), F.lit(0).alias("_side"), F.col(ts).alias("_shot"))
    stacked = marks.unionByName(shots, allowMissingColumns=True)
    filled = fill_forward(stacked, [game], ["_at", "_side"], "_shot", "_from", limit)
    asked = filled.where("_side = 1")
    # Only bodies at a time that some probe asks for are moved.
    wanted = asked.where("_from IS NOT NULL").select(F.col(game).alias("_g"), F.col("_from").alias("_f")).distinct()
    used = known.join(wanted, F.col(game).eqNullSafe(F.col("_g")) & (F.col(ts) == F.col("_f")), "left_semi")
    bodies = one_per_time(used, game, ts, ties).select(F.col(game).alias("_game"), F.col(ts).alias("_ts"), F.col(body).alias(out))
    at = F.col(game).eqNullSafe(F.col("_game")) & (F.col("_from") == F.col("_ts"))
    rows = asked.join(bodies, at, "left")
    return rows.select(game, F.col("_at").alias(ts), probe, out)


def nested_rows(df: DataFrame, payload: str, path: str, fields: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Elements of an array inside a VARIANT payload as rows, with typed fields.

    ``fields`` maps an output name to ``"json.path:type"``.
    """
    inner = F.variant_get(payload, path, "variant").alias("_list")
    listed = df.select(*keep, inner)
    rows = listed.lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("_list").outer())
    ).select(*keep, F.col("pos").cast("long").alias("pos"), F.col("value").alias("_item"))
    return rows.select(*keep, "pos", *variant_fields("_item", fields))


def variant_fields(item: str | Column, fields: Mapping[str, str]) -> list[Column]:
    """Typed columns read from a VARIANT; a missing path gives NULL."""
    out = []
    for name, spec in fields.items():
        path, _, kind = spec.rpartition(":")
        out.append(F.try_variant_get(as_col(item), f"$.{path}" if path else "$", kind).alias(name))
    return out


def hydrate(df: DataFrame, other: DataFrame, on: Sequence[str] | str, as_struct: str | None = None) -> DataFrame:
    """Attaches a related entity; with ``as_struct`` its columns nest under one name.

    The related side is the larger table's dimension; Spark picks broadcast or sort-merge
    by its measured size.
    """
    keys = [on] if isinstance(on, str) else list(on)
    extra = [c for c in other.columns if c not in keys]
    side = other
    if as_struct:
        side = other.select(*keys, F.struct(*extra).alias(as_struct))
    return df.join(side, keys, "left")


def sparse_fields(df: DataFrame, fields: str | Sequence[str]) -> DataFrame:
    """Only the named (dotted) paths, so the scan reads just those, nested ones included."""
    wanted = fields.split(",") if isinstance(fields, str) else fields
    return df.select(*[F.col(f.strip()).alias(f.strip().replace(".", "_")) for f in wanted])


def situation_splits(df: DataFrame, codes: Mapping[str, Column], keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """One row per key and situation code; a row counts under every code it meets."""
    met = F.filter(
        F.array(*[F.when(test, F.lit(code)) for code, test in codes.items()]), lambda c: c.isNotNull()
    )
    tagged = df.withColumn("sit_code", F.explode(met))
    return tagged.groupBy(*keys, "sit_code").agg(*aggs)


def merge_sports(df: DataFrame, sport_ids: Sequence[int], keys: Sequence[str], sport: str = "sport_id") -> DataFrame:
    """Rows of the wanted sports, plus an empty row for each wanted sport without any.

    ``keys`` name the entity columns that stay NULL in such a row.
    """
    from dugout.sources.codes import fixed_frame

    ids = fixed_frame(df.sparkSession, [(int(i),) for i in sport_ids], (sport,))
    rows = df.where(F.col(sport).isin(*[int(i) for i in sport_ids]))
    seen = rows.select(F.col(sport).cast("long").alias(sport)).distinct()
    missing = ids.join(seen, sport, "left_anti")
    typed = rows.withColumn(sport, F.col(sport).cast("long"))
    return typed.unionByName(missing, allowMissingColumns=True).select(sport, *keys)


def name_search(df: DataFrame, names: str | Sequence[str], name: str, active: bool | None = None, active_col: str = "active") -> DataFrame:
    """People whose full name contains any of the given names, without regard to case."""
    wanted = [names] if isinstance(names, str) else list(names)
    low = F.lower(F.col(name))
    test = F.lit(False)
    for n in wanted:
        test = test | F.contains(low, F.lit(n.lower()))
    out = df.where(test)
    return out if active is None else out.where(F.col(active_col) == active)


def affiliate_tree(teams: DataFrame, team: str, parent: str) -> DataFrame:
    """(team, ancestor, depth) for every club above a team, the parent at depth 1.

    A chain that comes back to a team it has passed ends there, so circles do no harm, and a team is
    never its own ancestor. With several ways up, the shortest counts. Each round doubles the depth that is
    known: the clubs just at its end join all that is known above them. A shortest way has one club
    there, so no pair is missed and a chain of n clubs takes log2(n) rounds. Runs a job per round; what it
    found is in the shared folder.
    """
    spark, home, reach = teams.sparkSession, shared_path(teams.sparkSession, "affiliates"), 1
    links = teams.select(F.col(team).alias("team"), F.col(parent).alias("ancestor"))
    found = links.where("team IS NOT NULL AND ancestor <> team").distinct().withColumn("depth", F.lit(1))
    schema, paths = found.schema, []
    while True:
        paths.append(f"{home}/to-{reach}")
        found.write.parquet(paths[-1])
        known = spark.read.schema(schema).parquet(*paths)
        if known.where(F.col("depth") == reach).isEmpty():
            return known
        ends = known.where(F.col("depth") == reach).select("team", F.col("ancestor").alias("_end"))
        above = known.select(F.col("team").alias("_team"), "ancestor", "depth")
        met = ends.join(above, F.col("_end") == F.col("_team")).where("ancestor <> team")
        pairs = met.groupBy("team", "ancestor").agg((F.min("depth") + reach).cast("int").alias("depth"))
        found = pairs.join(known.drop("depth"), ["team", "ancestor"], "left_anti")
        reach *= 2


def affiliates_of(teams: DataFrame, ids: Sequence[Any], team: str, parent: str) -> DataFrame:
    """The clubs named and all teams below them, with their columns."""
    tree = affiliate_tree(teams, team, parent)
    below = tree.where(value_filter(tree, "ancestor", list(ids))).select(F.col("team").alias("_below")).distinct()
    named = teams.where(value_filter(teams, team, list(ids)))
    others = teams.where(~value_filter(teams, team, list(ids)))
    return named.unionByName(others.join(below, F.col(team) == F.col("_below"), "left_semi"))
