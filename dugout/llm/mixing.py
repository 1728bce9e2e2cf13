"""Mixing sources to target weights by pivotal dependent rounding, in column functions only.

Every document should be taken ``target / source size`` times. The whole part is certain; the
fractions are rounded together. Two fractional documents of a source meet, and mass (words)
moves from one to the other, in a random direction whose mean is zero, until one of them is
whole; so a source's words stay what they were at every meeting. Meetings run down a list inside a
block of about ``FAN`` documents, each block leaves one residual, residuals are dealt into
blocks again, and so on: a reduction tree over Spark's shuffles. Only the last residual
of a source is rounded alone, so a source misses its target by less than one document. Lists
go from large to small documents, so neighbours are alike and what is left over is mostly small.

Randomness is a hash of the seed and the two documents, so reruns agree.

Defined results: a NULL text has size 0; a NULL source is a source, last in order; documents
of size 0 take nothing; of rows equal in id, source and size as many get one copy more than the others
as the fraction asks for, to less than one row; an empty table gives no rows; other columns are kept by ``apply_mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.llm.common import numbered, word_count, written

FAN = 64
LEVELS = 6
UNIT = ("doc_id", "source", "size")
# Fractions this near to 0 or 1 are taken as whole, so float dust forms no meetings.
DUST = 1e-9


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def targets(totals: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Adds ``target`` to a table of one row per source with ``source`` and ``source_size``.

    Sources in code point order, NULL last, weigh ``weights`` in turn and share ``share`` of all
    sizes; none gets over ``cap`` times its size, what is over is dealt out again by weight. This
    ends where every source has the lesser of its cap and one common level times its weight;
    the level comes from running sums in the order in which sources reach their caps. The two
    global windows hold one row per source, not per document.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    fills = Window.orderBy("_full", "_rank")
    before, after = fills.rowsBetween(Window.unboundedPreceding, -1), fills.rowsBetween(0, Window.unboundedFollowing)
    table = F.array(*(F.lit(float(w)) for w in weights))
    ranked = totals.withColumn("_rank", F.row_number().over(place)).withColumns(
        {"_weight": F.get(table, (F.col("_rank") - 1) % len(weights)), "_cap": F.col("source_size") * F.lit(float(cap))}
    )
    whole = fills.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("_full", F.col("_cap") / F.col("_weight"))
        .withColumn("_all", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn(
            "_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
        )
    )
    open_level = F.when(F.col("_level") <= F.col("_full"), F.struct("_full", "_rank", "_level"))
    level = F.min(open_level).over(whole)["_level"]
    return levels.withColumn(
        "target", F.least("_cap", F.coalesce(level * F.col("_weight"), F.col("_cap")))
    ).select("source", "source_size", "n_units", "target")


def _meet(acc: Column, item: Column, seed: int) -> Column:
    """One meeting of the carried unit with the next one."""
    a, b = acc["carry"], item
    up = F.least((1 - a["p"]) * a["mass"], b["p"] * b["mass"])
    down = F.least(a["p"] * a["mass"], (1 - b["p"]) * b["mass"])
    move = F.when(uniform(F.lit(seed), a["unit"], b["unit"]) * (up + down) < down, up).otherwise(-down)

    def with_p(x: Column, p: Column) -> Column:
        whole = F.when(p < DUST, 0.0).when(p > 1 - DUST, 1.0).otherwise(p)
        return F.struct(x["mass"].alias("mass"), x["unit"].alias("unit"), whole.alias("p"))

    # Structs name the steps, since a column function cannot bind a variable otherwise.
    met = F.struct(with_p(a, a["p"] + move / a["mass"]).alias("a"), with_p(b, b["p"] - move / b["mass"]).alias("b"))

    def settle(m: Column) -> Column:
        first = m["a"]["p"].isin(0.0, 1.0)
        done, carry = F.when(first, m["a"]).otherwise(m["b"]), F.when(first, m["b"]).otherwise(m["a"])
        return F.struct(carry.alias("carry"), F.array_append(acc["done"], done).alias("done"))

    return F.when(a.isNull(), F.struct(b.alias("carry"), acc["done"].alias("done"))).otherwise(
        F.transform(F.array(met), settle)[0]
    )


def _round_blocks(items: DataFrame, level: int, seed: int) -> DataFrame:
    """One tree level: from items (source, n_units, unit, mass, p) to ``done`` and ``carry`` per block."""
    blocks = F.greatest(F.ceil(F.col("n_units") / F.lit(float(FAN ** (level + 1)))), F.lit(1).cast("long"))
    dealt = items.withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "unit"), blocks))
    lists = dealt.groupBy("source", "n_units", "_block").agg(
        F.sort_array(F.collect_list(F.struct("mass", "unit", "p")), asc=False).alias("_items")
    )
    kind = lists.schema["_items"].dataType
    start = F.struct(F.lit(None).cast(kind.elementType).alias("carry"), F.array().cast(kind).alias("done"))
    return lists.withColumn("_end", F.aggregate("_items", start, lambda acc, x: _meet(acc, x, seed))).select(
        "source", "n_units", F.col("_end")["carry"].alias("carry"), F.col("_end")["done"].alias("done")
    )


def decide(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 17
) -> DataFrame:
    """One row per (doc_id, source, size) of ``docs``: n_rows, source_size, target, ``copies`` of every one of
    the rows, and ``n_more``, how many of them get one more.

    Runs jobs at once: sizes and levels are written to the shared folder, so texts are read once and plans stay short.
    """
    units = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .groupBy(*UNIT)
        .agg(F.count(F.lit(1)).alias("n_rows")),
        "mix-sizes",
    )
    totals = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n_rows")).alias("source_size"), F.count(F.lit(1)).alias("n_units")
    )
    goals = targets(totals, weights, share, cap).withColumnRenamed("source", "_goal_source")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    asked = (
        units.join(goals, F.col("source").eqNullSafe(F.col("_goal_source")))
        .drop("_goal_source")
        .withColumn("_base", F.floor(times + DUST).cast("long"))
        .withColumn("_rest", F.when(F.col("size") == 0, 0.0).otherwise(F.greatest(times - F.col("_base"), F.lit(0.0))))
        # Of equal rows, as many get one more copy for certain as the fraction allows; what is left is one row's.
        .withColumn("_more", F.floor(F.col("_rest") * F.col("n_rows") + DUST).cast("long"))
        .withColumn("_p", F.greatest(F.col("_rest") * F.col("n_rows") - F.col("_more"), F.lit(0.0)))
        .withColumn("unit", F.struct(*UNIT, "n_rows", "source_size", "target", "_base", "_more"))
        .select("source", "n_units", "unit", F.col("size").cast("double").alias("mass"), F.col("_p").alias("p"))
    )
    certain = asked.filter(F.col("p") < DUST).select("unit", F.lit(0.0).alias("p"))
    items, parts = asked.filter(F.col("p") >= DUST), [certain]
    for level in range(LEVELS):
        # Each level is read twice; planned in place, the last would hold the plans of all before it many times over.
        ends = written(_round_blocks(items, level, seed), f"mix-blocks-{level}")
        parts.append(ends.select(F.explode("done").alias("_d")).select("_d.unit", "_d.p"))
        items = ends.select("source", "n_units", "carry.unit", "carry.mass", "carry.p")
    alone = F.when(uniform(F.lit(seed), F.lit("last"), "unit") < F.col("p"), 1.0).otherwise(0.0)
    last = items.select("unit", alone.alias("p"))
    settled = parts[0]
    for part in [*parts[1:], last]:
        settled = settled.unionByName(part)
    return settled.select(
        *(F.col("unit")[c].alias(c) for c in (*UNIT, "n_rows", "source_size", "target")),
        F.col("unit")["_base"].alias("copies"),
        (F.col("unit")["_more"] + F.col("p").cast("long")).alias("n_more"),
    )


def _each_row(decided: DataFrame) -> DataFrame:
    """Decisions (..., n_rows, copies, n_more) as a row for each of the equal rows, with its own copies."""
    each = decided.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    more = (F.col("_row") <= F.col("n_more")).cast("long")
    return each.withColumn("copies", F.col("copies") + more).drop("_row", "n_more")


def mix_report(docs: DataFrame, **settings) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, source, copies."""
    return _each_row(decide(docs, **settings)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )


def apply_mix(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; the columns stay."""
    decided = decide(docs, **settings)
    # All rows of most units are taken equally often.
    even = F.col("n_more").isin(0) | (F.col("n_more") == F.col("n_rows"))
    level = decided.withColumn("copies", F.col("copies") + F.when(F.col("n_more") > 0, 1).otherwise(0))
    taken = _with_units(docs, level.filter(even & (F.col("copies") > 0))).select("_row", "copies")
    uneven = decided.filter(~even)
    if not uneven.isEmpty():
        # Equal rows are told apart by their place in a written table, numbered file by file.
        some = written(_with_units(docs, uneven), "mix-repeats")
        at = some.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
        ranked = numbered(at, [f"_m_{c}" for c in UNIT], F.col("_file"), [F.col("_at")], "_number")
        more = (F.col("_number") < F.col("n_more")).cast("long")
        taken = taken.unionByName(ranked.select("_row", (F.col("copies") + more).alias("copies")))
    return taken.withColumn("_again", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("_row.*")


def _with_units(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs``, as ``_row``, with what was decided for their unit."""
    units = decided.select(*(F.col(c).alias(f"_m_{c}") for c in UNIT), "copies", "n_more")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("_own"), F.struct("*").alias("_row"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_m_doc_id"))
        & F.col("source").eqNullSafe(F.col("_m_source"))
        & (F.col("_own") == F.col("_m_size"))
    )
    return sized.join(units, same).select("_row", *(f"_m_{c}" for c in UNIT), "copies", "n_more")
