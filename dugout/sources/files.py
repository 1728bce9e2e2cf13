"""Landed files: CSV pulls, HTML pages with embedded JSON, JSON payloads, register shards."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dugout.functions.text import as_col

CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
HTML_START = r"^\s*(?i:<!doctype|<html)"
NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    line_breaks: bool = True,
) -> DataFrame:
    """CSV rows with every column text; blank cells are NULL.

    Quoted line breaks need whole-file tasks. Landed pulls are small files, so that is the
    default; for large files known to have none, ``line_breaks=False`` lets them split.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=line_breaks)
    if columns:
        # A file whose header says otherwise fails rather than giving shifted cells.
        reader = reader.schema(_text_schema(columns)).option("enforceSchema", False)
    return reader.csv(path)


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv_folder(
    spark: SparkSession, path: str | Sequence[str], line_breaks: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows of all CSV files by their own headers, files set aside with a ``reason``).

    A job over the files finds each one's first line and whether it is an HTML page. Files with
    equal headers are read together, by that header; the groups are united by column name, so
    order and number of columns may differ. What reaches the driver is one line per file, as
    any file listing does. Reasons are ``html_body`` and ``empty``;
    files of no bytes add nothing.
    """
    bodies = read_bodies(spark, path)
    head = F.regexp_extract("body", r"\A\x{FEFF}?([^\r\n]*)", 1)
    reason = F.when(is_html("body"), "html_body").when(F.trim(head) == "", "empty")
    heads = bodies.select("file", F.coalesce(reason, F.lit("")).alias("reason"), head.alias("head")).collect()
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(heads, key=lambda r: r["file"]):
        if not row["reason"]:
            by_header.setdefault(tuple(next(csv.reader([row["head"]]))), []).append(row["file"])
    frames = [
        spark.read.options(**CSV_OPTIONS, multiLine=line_breaks).schema(_text_schema(names)).csv(found)
        for names, found in by_header.items()
    ]
    aside = [(r["file"], r["reason"]) for r in heads if r["reason"]]
    rejected = spark.createDataFrame(aside, "file string, reason string")
    return (union_rows(frames) if frames else spark.createDataFrame([], T.StructType([]))), rejected


def with_row_order(df: DataFrame, out: str = "row_order") -> DataFrame:
    """Adds (file, position) so first-row rules survive shuffles; for whole-file reads."""
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("row"))
    return df.select("*", place.alias(out))


def read_register(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    shards: str = "people-*.csv",
) -> DataFrame:
    """The player register from its shards; empty and header-only shards add nothing."""
    return with_row_order(read_csv(spark, f"{path}/{shards}", columns))


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``file`` and its whole text ``body``."""
    pages = spark.read.text(path, wholetext=True)
    return pages.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))


def is_html(body: Column | str) -> Column:
    return as_col(body).rlike(HTML_START)


def split_html(df: DataFrame, body: str) -> tuple[DataFrame, DataFrame]:
    """(rows that may hold CSV, rows whose body is an HTML page, with a ``reason``)."""
    html = F.coalesce(is_html(body), F.lit(False))
    return df.where(~html), df.where(html).withColumn("reason", F.lit("html_body"))


def embedded_json(df: DataFrame, html: str, variable: str = "data", out: str = "json") -> DataFrame:
    """Adds the JSON value assigned to a script variable, and ``<out>_status``.

    Status is ``ok``, ``missing_var`` or ``bad_json``. The JSON parser stops after the first
    value, so script text behind it does not matter and brackets in strings are safe.
    """
    pattern = rf"(?s)(?:var|const|let)\s+\Q{variable}\E\s*=\s*([\[{{].*)"
    tail = F.regexp_extract(F.col(html), pattern, 1)
    found = df.withColumn("_tail", F.nullif(tail, F.lit("")))
    parsed = found.withColumn(out, F.try_parse_json("_tail"))
    status = (
        F.when(F.col("_tail").isNull(), "missing_var")
        .when(F.col(out).isNull(), "bad_json")
        .otherwise("ok")
    )
    return parsed.withColumn(f"{out}_status", status).drop("_tail")


def payload_objects(df: DataFrame, body: str, out: str = "json") -> DataFrame:
    """Adds the parsed payload and ``<out>_status``: ``ok``, ``not_object`` or ``bad_json``.

    The parser ignores text after the first value, which would hide a damaged payload, so
    the body must also parse wrapped as the only element of an array and of an object.
    """
    text = F.col(body)
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    boxed = F.try_parse_json(F.concat(F.lit('{"b":'), text, F.lit("}")))
    whole = df.withColumns({"_listed": listed, "_boxed": boxed})
    alone = (
        F.col("_listed").isNotNull()
        & F.col("_boxed").isNotNull()
        & F.variant_get("_listed", "$[1]", "variant").isNull()
    )
    value = F.when(alone, F.variant_get("_listed", "$[0]", "variant"))
    parsed = whole.withColumn("_value", value)
    object_like = F.schema_of_variant("_value").startswith("OBJECT<")
    status = (
        F.when(F.col("_value").isNull(), "bad_json")
        .when(object_like, "ok")
        .otherwise("not_object")
    )
    done = parsed.withColumn(f"{out}_status", status)
    kept = F.when(F.col(f"{out}_status") == "ok", F.col("_value"))
    return done.withColumn(out, kept).drop("_listed", "_boxed", "_value")


def union_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; columns in first-seen order, missing cells NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_rows(frames: DataFrame | Sequence[DataFrame], path: str, fmt: str = "csv") -> bool:
    """Writes rows as CSV, JSON or Parquet; an empty result writes nothing.

    CSV takes flat columns only. Returns whether anything was written.
    """
    df = frames if isinstance(frames, DataFrame) else union_rows(frames)
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(f"unknown output format {fmt!r}")
    nested = [f.name for f in df.schema if isinstance(f.dataType, NESTED)]
    if fmt == "csv" and nested:
        raise ValueError(f"CSV cannot hold nested columns {nested}; use json or parquet")
    if df.isEmpty():
        return False
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS, emptyValue="", nullValue="")
    writer.format(fmt).save(path)
    return True
