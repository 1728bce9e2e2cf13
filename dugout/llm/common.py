"""Helpers that several operators share: words, sizes, gapless numbers, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dugout.session import shared_path

# Words are runs of anything but space and the five ASCII controls from tab to return.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for NULL; one row of memory, no array of words.

    Every run of white space becomes one space and the ends are trimmed, so the words are
    one more than the spaces left.
    """
    spaced = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    words = F.length(F.regexp_replace(spaced, "[^ ]+ *", "w"))
    return F.coalesce(words, F.lit(0)).cast("long")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: its work is done once, and a
    lost executor costs a read instead of the steps before it."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ARROW = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
# Rows that ``per_text`` hands over at a time: bounds what their results and texts hold.
ROWS = 512

BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
READ_KEY = "spark.sql.parquet.columnarReaderBatchSize"

Work = Callable[[list[str | None]], list[tuple]]


def few_rows(spark: SparkSession) -> dict[str, str]:
    """Has Spark read Parquet files and hand workers at most ``ROWS`` rows at a time from now on, so that neither
    side holds more texts (those of the usual 4,096 rows are one array, which grows by doubling); lower settings
    stay. Returns the settings before; rows are the same with any."""
    before = {key: spark.conf.get(key) for key in (BATCH_KEY, READ_KEY)}
    for key, rows in before.items():
        if not 0 < int(rows) <= ROWS:
            spark.conf.set(key, str(ROWS))
    return before


@contextmanager
def by_few_rows(spark: SparkSession) -> Iterator[None]:
    """As ``few_rows`` for the jobs that run inside."""
    before = few_rows(spark)
    try:
        yield
    finally:
        for key, rows in before.items():
            spark.conf.set(key, rows)


class PerText:
    """Results of a function of a text beside the rows' own columns, which pass through as Arrow.

    Inside, columns go by position, so extra columns may have any names. ``with_columns`` gives
    results beside columns (a result hides a column of its name); ``rows_where`` gives the rows
    whose result ``flag`` is as asked, with their own columns only.
    """

    def __init__(self, docs: DataFrame, columns: Sequence[str], text: str, results: Mapping[str, str], work: Work):
        self.columns, self.results = list(columns), list(results)
        own = docs.select(*(docs[c].alias(f"_c{i}") for i, c in enumerate(self.columns)), docs[text].alias("_t"))
        # A text that is kept anyway travels once.
        self.text_at = self.columns.index(text) if text in self.columns else None
        read = own if self.text_at is None else own.drop("_t")
        source = "_t" if self.text_at is None else f"_c{self.text_at}"
        kept = [f for f in read.schema if f.name != "_t"]
        kinds = [ARROW[k] for k in results.values()]
        schema = T.StructType([*kept, *T.StructType.fromDDL(", ".join(f"_r{i} {k}" for i, k in enumerate(results.values())))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    found = work(part.column(source).to_pylist())
                    arrays = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
                    names = [f.name for f in kept]
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(n) for n in names), *arrays], names=[*names, *(f"_r{i}" for i in range(len(kinds)))]
                    )

        self.found = read.mapInArrow(run, schema)

    def with_columns(self) -> DataFrame:
        own = [F.col(f"_c{i}").alias(c) for i, c in enumerate(self.columns) if c not in self.results]
        return self.found.select(*own, *(F.col(f"_r{i}").alias(r) for i, r in enumerate(self.results)))

    def rows_where(self, flag: str, value: bool) -> DataFrame:
        at = self.results.index(flag)
        own = [F.col(f"_c{i}").alias(c) for i, c in enumerate(self.columns)]
        return self.found.filter(F.col(f"_r{at}") == F.lit(value)).select(*own)


def numbered(df: DataFrame, groups: Sequence[str], block: Column, order: Sequence[Column], name: str) -> DataFrame:
    """Adds ``name``, a number gapless from 0 within each group, with no group in one task.

    Rows are numbered inside (group, block); the few block counts of a group are then summed
    in block order and added. ``block`` must be a function of the row with a bounded number of
    values. Groups may be NULL. Rows equal in ``order`` get numbers in any order.
    """
    keys = [*groups, "_block"]
    own = Window.partitionBy(*keys).orderBy(*order)
    held = df.withColumn("_block", block)
    inner = held.withColumn("_in", F.row_number().over(own) - 1)
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        held.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_of"))
        .withColumn("_before", F.coalesce(F.sum("_of").over(before), F.lit(0)))
        .select(*(F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)), "_before")
    )
    same = None
    for i, k in enumerate(keys):
        test = F.col(k).eqNullSafe(F.col(f"_s{i}"))
        same = test if same is None else same & test
    return (
        inner.join(starts, same)
        .withColumn(name, (F.col("_before") + F.col("_in")).cast("long"))
        .select(*df.columns, name)
    )
