"""Sharding by jump consistent hashing (Lamping and Veach), in column functions only.

A stable key walks the pseudo-random jumps of a 64-bit linear congruential generator; the last
jump below the shard count is the shard. There is no ring table, and with one more shard a row
either stays or moves into the new one.

Defined results: a NULL key counts as key 0 and a NULL text as an empty one; equal keys share a
shard, so repeated rows do; an empty table gives no rows; other columns are kept on request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import numbered

# Multiplier of the generator of the published algorithm, in halves and quarters.
MULTIPLIER = 2862933555777941757
_C0, _C1 = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
_C0L, _C0H = _C0 & 0xFFFF, _C0 >> 16
_LOW = 0xFFFFFFFF
BLOCKS = 1024


def _times(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * MULTIPLIER + 1 modulo 2**64, in products that never overflow a long."""

    def by_low(x: Column) -> Column:
        return x * F.lit(_C0L) + F.shiftleft((x * F.lit(_C0H)).bitwiseAND(F.lit(0xFFFF)), 16)

    low = by_low(lo) + F.lit(1)
    carry = F.shiftright(low, 32) + F.shiftright(lo * F.lit(_C0H), 16)
    high = carry + (lo * F.lit(_C1)).bitwiseAND(F.lit(_LOW)) + by_low(hi).bitwiseAND(F.lit(_LOW))
    return high.bitwiseAND(F.lit(_LOW)), low.bitwiseAND(F.lit(_LOW))


def stable_key(column: Column, kind: str) -> Column:
    """A long from a key column: integers as they are, anything else hashed."""
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    return F.coalesce(column.cast("long") if whole else F.xxhash64(column), F.lit(0).cast("long"))


def jump(key: Column, shards: int) -> Column:
    """Shard of a long key, from 0; at most ``shards`` steps, about ln(shards) of them in use."""
    if shards < 1:
        raise ValueError("at least one shard")

    def step(s: Column, _: Column) -> Column:
        hi, lo = _times(s["hi"], s["lo"])
        to = F.floor((s["next"] + 1) * (F.lit(2.0**31) / (F.shiftright(hi, 1) + 1)))
        moved = F.struct(s["next"].alias("shard"), to.alias("next"), hi.alias("hi"), lo.alias("lo"))
        return F.when(s["next"] < F.lit(shards), moved).otherwise(s)

    start = F.struct(
        F.lit(-1).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("next"),
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(F.lit(_LOW)).alias("lo"),
    )
    steps = F.array_repeat(F.lit(0), shards)
    return F.aggregate(steps, start, step, lambda s: s["shard"].cast("int"))


RESULTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def shard(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", columns: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``columns`` of ``docs`` with size, text_crc32, law, shard, slot (gapless within a shard) and
    grown_shard, the shard if there were one more.

    Slots follow a block taken from the key's first random step, then the key, size and
    checksum; no shard is numbered in one task. A result hides a column of its name.
    """
    kept = [c for c in columns if c not in RESULTS]
    body = F.coalesce(docs[text], F.lit(""))
    held = docs.select(
        *(docs[c].alias(f"_c{i}") for i, c in enumerate(kept)),
        stable_key(docs[key], dict(docs.dtypes)[key]).alias("_key"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
    ).withColumns({"law": F.lit("key"), "shard": jump(F.col("_key"), shards), "grown_shard": jump(F.col("_key"), shards + 1)})
    first, _ = _times(F.shiftrightunsigned(F.col("_key"), 32), F.col("_key").bitwiseAND(F.lit(_LOW)))
    order = [F.col("_key"), F.col("size"), F.col("text_crc32")]
    placed = numbered(held, ["shard"], first.bitwiseAND(F.lit(BLOCKS - 1)), order, "slot")
    return placed.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(kept)), *RESULTS)
