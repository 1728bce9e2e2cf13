"""Differences between the snapshots of a feed, and snapshots rebuilt from them.

A body is taken apart into leaves, an empty object or array being a leaf. Each snapshot meets
the one before it by a join of bodies on (game, time), and the leaves of the two are compared by path in
that row, so no game, however many snapshots it has, meets in one task: what does is two bodies. Replaying
takes the last operation of every path up to a time in one aggregate, and folds
leaves into objects and arrays level by level.

Paths are JSON pointers (``/plays/0/result``, ``~1`` for a slash and ``~0`` for a tilde in a name,
``''`` for the whole body); ``steps`` holds the same as names and positions. Values are JSON texts as
a VARIANT spells them: names in order, no spaces. Snapshots without a body or without a
time are none; of several with one game and time the one with the largest tie counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dugout.functions.text import as_col
from dugout.operators.entities import moment, one_per_time
from dugout.operators.ordered import GROUP_LIMIT, look_back, same
from dugout.session import shared_path

STEPS = "array<struct<name:string,place:int>>"


def _text(body: Column, kind: T.DataType) -> Column:
    return F.to_json(body) if isinstance(kind, T.VariantType) else body


def body_depth(df: DataFrame, body: str) -> int:
    """How deep the bodies nest, 0 for plain values. Runs a job; one number reaches the driver."""
    bare = F.regexp_replace(_text(F.col(body), df.schema[body].dataType), r'"(\\.|[^"\\])*"', "")
    brackets = F.split(F.regexp_replace(bare, r"[^\[\]{}]", ""), "")

    def step(at: Column, c: Column) -> Column:
        now = at["now"] + F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(at["most"], now).alias("most"))

    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    deepest = F.aggregate(brackets, start, step, lambda at: at["most"])
    return df.agg(F.max(deepest)).first()[0] or 0


def leaf_rows(df: DataFrame, keys: Sequence[str], body: str, depth: int | None = None) -> DataFrame:
    """Rows (keys, path, steps, value), one for each leaf of each body.

    ``depth`` bounds the nesting that is taken apart; what lies deeper stays a value. It is
    measured if not given. All of it is one pass without a shuffle.
    """
    levels = body_depth(df, body) if depth is None else depth
    own = df.schema[body].dataType
    parsed = F.col(body) if isinstance(own, T.VariantType) else F.try_parse_json(F.col(body))
    rows = df.select(*keys, F.array().cast(STEPS).alias("steps"), parsed.alias("_value")).where("_value IS NOT NULL")
    explode = df.sparkSession.tvf.variant_explode_outer
    for _ in range(levels):
        # A leaf gives one row without a position and stays as it is.
        inner = rows.lateralJoin(explode(F.col("_value").outer()))
        step = F.struct(F.col("key").alias("name"), F.when(F.col("key").isNull(), F.col("pos")).alias("place"))
        deeper = F.when(F.col("pos").isNotNull(), F.array_append("steps", step)).otherwise(F.col("steps"))
        value = F.when(F.col("pos").isNotNull(), F.col("value")).otherwise(F.col("_value"))
        rows = inner.select(*keys, deeper.cast(STEPS).alias("steps"), value.alias("_value"))
    return rows.select(*keys, pointer("steps").alias("path"), "steps", F.to_json("_value").alias("value"))


def pointer(steps: str | Column) -> Column:
    """Steps as a JSON pointer."""

    def part(s: Column) -> Column:
        name = F.replace(F.replace(s["name"], F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        return F.concat(F.lit("/"), F.coalesce(name, s["place"].cast("string")))

    return F.array_join(F.transform(as_col(steps), part), "")


def _leaves(body: Column, levels: int) -> Column:
    """The leaves of a parsed body as an array of (steps, value), as ``leaf_rows`` gives them; empty without a body."""

    def deeper(x: Column) -> Column:
        members = F.try_variant_get(x["value"], "$", "map<string,variant>")
        items = F.try_variant_get(x["value"], "$", "array<variant>")
        named = F.transform(F.map_entries(members), lambda m: _leaf(x, m["key"], F.lit(None).cast("int"), m["value"]))
        placed = F.transform(items, lambda v, i: _leaf(x, F.lit(None).cast("string"), i, v))
        return F.when(F.size(members) > 0, named).when(F.size(items) > 0, placed).otherwise(F.array(x))

    found = F.array(F.struct(F.array().cast(STEPS).alias("steps"), body.alias("value")))
    for _ in range(levels):
        found = F.flatten(F.transform(found, deeper))
    return F.when(body.isNotNull(), found)


def _leaf(above: Column, name: Column, place: Column, value: Column) -> Column:
    step = F.struct(name.alias("name"), place.alias("place"))
    return F.struct(F.array_append(above["steps"], step).cast(STEPS).alias("steps"), value.alias("value"))


def feed_diffs(
    feed: DataFrame,
    game: str,
    ts: str,
    body: str,
    ties: Sequence[str] = (),
    depth: int | None = None,
    limit: int | None = GROUP_LIMIT,
) -> DataFrame:
    """Operations that lead from each snapshot of a game to the next: game, ts, op, path, steps, value, old.

    ``op`` is ``add``, ``replace`` or ``remove``; a game's first snapshot is all ``add``. ``old`` is the
    value before, NULL for ``add``, as ``value`` is for ``remove``. Snapshots that change nothing give
    no rows.
    """
    shots = one_per_time(feed.where(F.col(ts).isNotNull() & F.col(body).isNotNull()), game, ts, ties).select(game, ts, body)
    # The depth, the order of times and both sides of the join read the snapshots, so they are made once.
    path = shared_path(feed.sparkSession, "shots")
    shots.write.parquet(path)
    shots = feed.sparkSession.read.schema(shots.schema).parquet(path)
    levels = body_depth(shots, body) if depth is None else depth
    # Times only are put in order; each is told the one after it, as its own is the one before.
    times = look_back(shots.select(game, ts), [game], [ts], 1, lambda w: {"_prior": F.lag(ts).over(w)}, limit)
    times = times.where("_prior IS NOT NULL").select(F.col(game).alias("_g"), F.col("_prior"), F.col(ts).alias("_next"))
    here = F.col(game).eqNullSafe(F.col("_g")) & (F.col(ts) == F.col("_prior"))
    before = shots.join(times, here).select("_g", F.col("_next").alias("_t"), F.col(body).alias("_before"))
    pairs = shots.join(before, same([game, ts], ["_g", "_t"]), "left")
    # Two bodies meet as texts, and only what differs leaves their row: leaves are not shuffled.
    kind = feed.schema[body].dataType
    parsed = [F.col(c) if isinstance(kind, T.VariantType) else F.try_parse_json(F.col(c)) for c in (body, "_before")]
    both = pairs.select(game, ts, parsed[0].alias("_now"), parsed[1].alias("_before"))

    def placed(column: str, side: int) -> Column:
        def leaf(x: Column) -> Column:
            text = F.to_json(x["value"]).alias("value")
            return F.struct(pointer(x["steps"]).alias("path"), F.lit(side).alias("side"), x["steps"].alias("steps"), text)

        return F.coalesce(F.transform(_leaves(F.col(column), levels), leaf), F.array())

    # In order of paths a leaf lies beside the one it replaces.
    sorted_leaves = both.select(game, ts, F.sort_array(F.concat(placed("_now", 0), placed("_before", 1))).alias("_all"))

    def operation(x: Column, i: Column) -> Column:
        after, prior = F.get("_all", i + 1), F.get("_all", i - 1)
        fresh = x["side"] == 0
        old = F.when(after["path"] == x["path"], after["value"])
        paired = F.coalesce(F.when(fresh, after["path"]).otherwise(prior["path"]) == x["path"], F.lit(False))
        op = F.when(fresh & ~paired, "add").when(~fresh & ~paired, "remove").when(fresh & (x["value"] != old), "replace")
        return F.struct(
            op.alias("op"),
            x["path"].alias("path"),
            x["steps"].alias("steps"),
            F.when(fresh, x["value"]).alias("value"),
            F.when(fresh, old).otherwise(x["value"]).alias("old"),
        )

    changed = F.filter(F.transform("_all", operation), lambda x: x["op"].isNotNull())
    return sorted_leaves.select(game, ts, F.inline(changed))


def diffs_between(diffs: DataFrame, ts: str, start: str | Column | None = None, end: str | Column | None = None) -> DataFrame:
    """Operations after one timecode, up to another; either may be left open."""
    out = diffs if start is None else diffs.where(F.col(ts) > moment(start))
    return out if end is None else out.where(F.col(ts) <= moment(end))


def feed_replayed(
    diffs: DataFrame, game: str, ts: str, timecode: str | Column | None = None, out: str = "body", depth: int | None = None
) -> DataFrame:
    """Per game the body in force at a timecode (the latest without), rebuilt from its operations alone.

    A path's value is that of its last operation; removed paths are left out. Games whose first snapshot
    is later are left out too. Runs a job for the depth if it is not given.
    """
    seen = diffs if timecode is None else diffs.where(F.col(ts) <= moment(timecode))
    # The operations pass once: the last one of a path in each task, then of all.
    at_last = F.max(F.struct(F.col(ts).alias("ts"), (F.col("op") != "remove").alias("there"), "steps", "value")).alias("_last")
    last = seen.groupBy(game, "path").agg(at_last).where("_last.there")
    # The depth and the bodies read what is left.
    path = shared_path(diffs.sparkSession, "leaves")
    last.select(game, "_last.steps", "_last.value").write.parquet(path)
    return assemble(diffs.sparkSession.read.parquet(path), [game], out, depth)


def assemble(leaves: DataFrame, keys: Sequence[str], out: str, depth: int | None = None) -> DataFrame:
    """Bodies (keys, ``out``) from leaves (keys, steps, value), the deepest objects and arrays first.

    One task holds the members of one object at a time.
    """
    levels = depth if depth is not None else leaves.agg(F.max(F.size("steps"))).first()[0] or 0
    rows = leaves.select(*keys, "steps", "value")
    for level in range(levels, 0, -1):
        inner = F.size("steps") == level
        # Shallower leaves pass through as groups of one.
        above = F.when(inner, F.slice("steps", 1, level - 1)).otherwise(F.col("steps"))
        last = F.when(inner, F.element_at("steps", -1))
        member = F.struct(last["place"].alias("place"), last["name"].alias("name"), "value", inner.alias("inner"))
        grouped = rows.select(*keys, above.alias("steps"), member.alias("_m")).groupBy(*keys, "steps")
        rows = grouped.agg(F.sort_array(F.collect_list("_m")).alias("_all")).select(*keys, "steps", _joined().alias("value"))
    return rows.select(*keys, F.col("value").alias(out))


def _joined() -> Column:
    """An object or array from its sorted members; a shallower leaf as it is."""
    first = F.col("_all")[0]

    def pair(m: Column) -> Column:
        quoted = F.to_json(F.array(m["name"]))
        return F.concat(F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit(":"), m["value"])

    pairs = F.concat(F.lit("{"), F.array_join(F.transform("_all", pair), ","), F.lit("}"))
    listed = F.concat(F.lit("["), F.array_join(F.col("_all.value"), ","), F.lit("]"))
    whole = F.when(first["place"].isNotNull(), listed).otherwise(pairs)
    return F.when(first["inner"], whole).otherwise(first["value"])
