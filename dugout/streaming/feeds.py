"""Change feeds and live feeds as streams that keep their result in a table.

Each micro-batch reduces its own rows and writes them under its batch number, so a batch
replayed after a failure overwrites itself and nothing passes through the driver. Readers
reduce the batches to the latest row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dugout.operators.ordered import same

BATCH = "_batch"


def landing_stream(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files: int | None = None
) -> DataFrame:
    """New Parquet files of a landing folder as a stream, at most ``files`` in a batch."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def latest(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row per key, the one with the largest ``order``, then the largest ``ties``.

    The newest time is a small hash aggregate; whole rows only join it, so bodies never sit in
    aggregation buffers. Rows equal in ``ties`` too are told apart by a hash of their plain columns. A key
    whose times are all NULL keeps one of its rows.
    """
    names = [f"_latest{i}" for i in range(len(keys))]
    owned = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    newest = df.groupBy(*owned).agg(F.max(order).alias("_newest"))
    top = df.join(newest, same(keys, names) & F.col(order).eqNullSafe(F.col("_newest"))).drop(*names, "_newest")
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    last = Window.partitionBy(*keys).orderBy(*[F.desc(t) for t in ties], F.desc(F.xxhash64(*plain)))
    return top.withColumn("_place", F.row_number().over(last)).where("_place = 1").drop("_place")


def run_to_table(stream: DataFrame, reduce_batch, table: str, checkpoint: str, mode: str = "append"):
    """Drains the stream, one folder per micro-batch; returns the finished query."""

    def write(batch: DataFrame, number: int) -> None:
        # A batch is read for its newest times and for its rows.
        batch.persist()
        try:
            reduce_batch(batch).write.mode("overwrite").parquet(f"{table}/{BATCH}={number}")
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def follow_changes(
    stream: DataFrame, keys: Sequence[str], updated: str, table: str, checkpoint: str, ties: Sequence[str] = ()
):
    """Latest version per key and batch. There is no state and no watermark: repeats meet on
    reading, and a change that arrives late, however late, counts."""
    return run_to_table(stream, lambda batch: latest(batch, keys, updated, ties), table, checkpoint)


def current_versions(
    spark: SparkSession, table: str, keys: Sequence[str], updated: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The followed table: one latest row per key over all batches.

    Reads every batch; ``change_log`` keeps the number of folders bounded where there are many.
    """
    rows = spark.read.option("basePath", table).parquet(table).drop(BATCH)
    return latest(rows, keys, updated, ties)


def follow_windows(
    stream: DataFrame,
    key: str,
    ts: str,
    width: str,
    table: str,
    checkpoint: str,
    body: str | None = None,
    ties: Sequence[str] = (),
):
    """Increments per game and time window: count, first and last time, and the newest body.

    Each batch writes its own part of a window; ``current_windows`` adds the parts, so late rows
    count whenever they come.
    """

    def parts(batch: DataFrame) -> DataFrame:
        placed = batch.withColumn("window_start", F.window(ts, width)["start"])
        counts = placed.groupBy("window_start", key).agg(
            F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
        )
        if body is None:
            return counts
        newest = latest(placed.select("window_start", key, ts, *ties, body), ["window_start", key], ts, ties)
        side = newest.select(F.col("window_start").alias("_w"), F.col(key).alias("_k"), F.col(body).alias("last_body"))
        return counts.join(side, same(["window_start", key], ["_w", "_k"])).drop("_w", "_k")

    return run_to_table(stream, parts, table, checkpoint)


def current_windows(spark: SparkSession, table: str, key: str) -> DataFrame:
    """The followed windows: the parts of all batches added up, with the newest body."""
    rows = spark.read.option("basePath", table).parquet(table)
    keys = ["window_start", key]
    out = rows.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )
    if "last_body" not in rows.columns:
        return out
    newest = latest(rows.select(*keys, "last_ts", BATCH, "last_body"), keys, "last_ts", [BATCH])
    side = newest.select(F.col("window_start").alias("_w"), F.col(key).alias("_k"), "last_body")
    return out.join(side, same(keys, ["_w", "_k"])).drop("_w", "_k")
