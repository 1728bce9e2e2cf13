"""A table of what each landed pitch file holds, asked before a scan so that a needle opens few files.

Files are narrow in date only; a player is in any of them. The index has, for each file, its level and span of
dates, and for each indexed column a bit table of hashed ids, cut into buckets of 32,768 bits: a
look-up reads one bucket a file. A set bit may be chance, a clear one is certain, and the rows
found are filtered again, so the index decides what is opened, never what is returned. Files
that are not in the index yet are always read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.operators.pitch_search import ROLES, as_date, choose, multi_value, search_pitches

INDEXED = ("pitcher", "batter")
BITS = 1 << 18


def _mark(value: Column, bits: int) -> Column:
    """A place from 1 to ``bits`` for an id."""
    return F.pmod(F.xxhash64(value.cast("string")), F.lit(bits)) + 1


# File listings and file columns write the slashes after a scheme differently.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def landed_files(spark: SparkSession, path: str) -> dict[str, str]:
    """The files below ``path`` by the name that the index knows them by."""
    return {re.sub(SCHEME, r"\1:/", f): f for f in sorted(spark.read.parquet(path).inputFiles())}


def update_index(spark: SparkSession, path: str, index: str, columns: Sequence[str] = INDEXED, bits: int = BITS) -> int:
    """Adds the landed files that ``index`` does not know yet; returns how many there were.

    Reads the dates and the indexed columns of those files only. Bits combine in each task before
    the shuffle, so what moves is bounded by files, columns and ``bits``.
    """
    files = landed_files(spark, path)
    known = _indexed_files(spark, index)
    new = [files[f] for f in files if f not in known]
    if not new:
        return 0
    rows = spark.read.option("basePath", path).parquet(*new)
    file = F.regexp_replace("_metadata.file_path", SCHEME, "$1:/").alias("file")
    held = rows.select(file, "level", "game_date", *columns)
    spans = held.groupBy("file").agg(
        F.first("level").alias("level"), F.min("game_date").alias("first_day"), F.max("game_date").alias("last_day")
    )
    # One row per file, column and bucket of ids; an id that is NULL is no needle.
    ids = held.unpivot(["file"], [F.col(c).cast("string").alias(c) for c in columns], "column", "id").where("id IS NOT NULL")
    marked = ids.withColumn("_mark", _mark(F.col("id"), bits))
    tables = marked.groupBy("file", "column", F.bitmap_bucket_number("_mark").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_mark")).alias("marks")
    )
    full = tables.join(spans, "file").withColumn("bits", F.lit(bits))
    ordered = full.repartition("column", "bucket").sortWithinPartitions("column", "bucket", "first_day")
    ordered.write.mode("append").partitionBy("column").parquet(f"{index}/marks")
    # Files count as indexed once this is written; a lost run leaves rows that a later one repeats, which is harmless.
    spans.select("file").write.mode("append").parquet(f"{index}/files")
    return len(new)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _indexed_files(spark: SparkSession, index: str) -> set[str]:
    """One name per file, as any file listing has."""
    if not _exists(spark, f"{index}/files"):
        return set()
    return {r["file"] for r in spark.read.parquet(f"{index}/files").distinct().collect()}


def files_with(
    spark: SparkSession,
    path: str,
    index: str,
    needles: dict[str, Sequence[Any]],
    start: date | None = None,
    end: date | None = None,
    level: str | None = None,
) -> list[str]:
    """Landed files that may hold, in every column of ``needles``, one of its values, in the span and level."""
    files = landed_files(spark, path)
    known = _indexed_files(spark, index)
    found = set(files)
    for column, values in needles.items():
        rows = spark.read.parquet(f"{index}/marks").where(F.col("column") == column) if known else None
        if rows is None:
            break
        bits = rows.select("bits").first()
        kept = set()
        if bits is not None:
            asked = spark.createDataFrame([(str(v),) for v in values], "id string").select(_mark(F.col("id"), bits[0]).alias("_m"))
            places = [(r[0], r[1]) for r in asked.select(F.bitmap_bucket_number("_m"), F.bitmap_bit_position("_m")).collect()]
            set_bit = F.lit(False)
            for bucket, bit in places:
                byte = F.conv(F.hex(F.substring("marks", bit // 8 + 1, 1)), 16, 10).cast("int")
                set_bit = set_bit | ((F.col("bucket") == bucket) & (F.floor(byte / 2 ** (bit % 8)) % 2 == 1))
            rows = rows.where(F.col("bucket").isin([b for b, _ in places])).where(set_bit)
            if start is not None:
                rows = rows.where(F.col("last_day") >= F.lit(start))
            if end is not None:
                rows = rows.where(F.col("first_day") <= F.lit(end))
            if level is not None:
                rows = rows.where(F.col("level") == level)
            kept = {r["file"] for r in rows.select("file").distinct().collect()}
        found &= kept | (files.keys() - known)
    return [files[f] for f in sorted(found)]


def search_indexed(
    spark: SparkSession,
    path: str,
    index: str,
    start_date: str | date,
    end_date: str | date,
    player_type: str = "pitcher",
    player_id: int | str | None = None,
    level: str = "mlb",
    **filters: Any,
) -> DataFrame:
    """``search_pitches`` over landed files, opening only those that may hold the players asked for."""
    start, end = as_date(start_date, "start_date"), as_date(end_date, "end_date")
    role = ROLES[choose(player_type, "player_type", ROLES)]
    needles = {}
    for column, lookup in (("pitcher", "pitchers_lookup[]"), ("batter", "batters_lookup[]")):
        wanted = multi_value(filters[lookup]) if filters.get(lookup) else []
        if not wanted and player_id is not None and column == role and lookup not in filters:
            wanted = multi_value(player_id)
        if wanted:
            needles[column] = wanted
    files = files_with(spark, path, index, needles, start, end, level)
    whole = spark.read.parquet(path)
    rows = spark.read.option("basePath", path).schema(whole.schema).parquet(*files) if files else whole.where("false")
    return search_pitches(rows, start_date, end_date, player_type, player_id, level, **filters)
