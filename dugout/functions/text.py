"""Text cells to typed values: blanks, numbers, dates, timecodes, seasons, names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = " \t\n\r\x0b\x0c"
TIMECODE = "yyyyMMdd_HHmmss"
SPIN_METHODS = ("spin-based", "observed")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def null_to_blank(c: Column | str) -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


# Fixed pattern: the number spellings accepted in a text cell.
NUMBER = (
    r"^\s*[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)"
    r"(?:[eE][+-]?\d+(?:_\d+)*)?|(?i:inf|infinity|nan))\s*$"
)


def to_float(c: Column | str) -> Column:
    """Number in a text cell; blank and junk give NULL, ``"0"`` gives 0.0.

    The JVM parser also takes a trailing type letter (``93.4d``) and hex floats, which are
    junk here; digit-group underscores (``1_000``) and a signed ``nan`` are valid here and
    unknown to it. Only
    cells with such a letter pay for the full pattern, and blank is tested first because a
    failed parse costs an exception per cell. The one accepted spelling the JVM still
    fails on is the signed ``nan``. The expression is kept short: it is compiled once per
    column, and long generated methods start slowly.
    """
    cell = as_col(c)
    plain = F.replace(cell, F.lit("_"), F.lit(""))
    return (
        F.when(cell == "", None)
        .when(~cell.rlike("[_dDfFxXnN]"), cell.try_cast("double"))
        .when(cell.rlike(NUMBER), F.coalesce(plain.try_cast("double"), F.lit(float("nan"))))
    )


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as double: parsed when text, cast when typed, NULL when absent."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    return number_of(df.schema[name].dataType, F.col(name))


def number_of(kind: T.DataType, c: Column) -> Column:
    return to_float(c) if isinstance(kind, (T.StringType, T.VarcharType)) else c.cast("double")


def cast_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Blank to NULL, numeric columns to double, columns with junk stay text.

    One aggregate pass over the wanted columns decides which columns are numeric; the
    driver sees a single row of counts. Names absent from ``df`` are skipped.
    """
    wanted = [c for c in (cols if cols is not None else df.columns) if c in df.columns]
    text = [c for c in wanted if isinstance(df.schema[c].dataType, T.StringType)]
    if not text:
        return df
    junk = df.agg(
        *[
            F.count_if(blank_to_null(c).isNotNull() & to_float(c).isNull()).alias(c)
            for c in text
        ]
    ).first()
    return df.withColumns(
        {c: to_float(c) if junk[c] == 0 else blank_to_null(c) for c in text}
    )


def parse_date(c: Column | str) -> Column:
    """Date of an ISO date, ``MM/DD/YYYY`` or ISO datetime text; other text gives NULL."""
    s = strip(c)
    stamp = s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}(:\d{2}){0,2}") & s.try_cast("timestamp").isNotNull()
    return (
        F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd"))
        .when(s.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date(s, "MM/dd/yyyy"))
        .when(s.rlike(r"^\d{8}$"), F.try_to_date(s, "yyyyMMdd"))
        .when(stamp, F.try_to_date(F.left(s, F.lit(10)), "yyyy-MM-dd"))
    )


def day_of(df: DataFrame, name: str) -> Column:
    """Column ``name`` as date: parsed when it is text, so blanks and junk give NULL."""
    text = isinstance(df.schema[name].dataType, T.StringType)
    return parse_date(name) if text else F.col(name).cast("date")


def format_date(c: Column | str) -> Column:
    """Any accepted date text as ``MM/DD/YYYY``; other text comes back trimmed, unchanged."""
    s = strip(c)
    slashed = s.rlike("^../../....$")
    return F.when(slashed, s).otherwise(F.coalesce(F.date_format(parse_date(s), "MM/dd/yyyy"), s))


def parse_timecode(c: Column | str) -> Column:
    return F.try_to_timestamp(as_col(c), F.lit(TIMECODE)).cast("timestamp_ntz")


def format_timecode(c: Column | str) -> Column:
    return F.date_format(as_col(c), TIMECODE)


def spin_season(year: int | Column, method: str = "spin-based") -> Column:
    """Composite season text ``YYYY_method`` used by the active-spin board."""
    if method not in SPIN_METHODS:
        raise ValueError(f"method must be one of {SPIN_METHODS}, got {method!r}")
    value = year if isinstance(year, Column) else F.lit(year)
    return F.concat_ws("_", value.cast("string"), F.lit(method))


def split_spin_season(c: Column | str) -> tuple[Column, Column]:
    parts = F.split(as_col(c), "_", 2)
    return F.try_element_at(parts, F.lit(1)).try_cast("int"), F.try_element_at(parts, F.lit(2))


def full_name(first: Column | str, last: Column | str) -> Column:
    """Lower-case ``first last`` with missing parts left out at the ends."""
    return F.trim(F.concat_ws(" ", F.lower(null_to_blank(first)), F.lower(null_to_blank(last))))


def name_matches(needle: str, first: Column | str, last: Column | str) -> Column:
    """Case-insensitive substring test on the first, last and joined name."""
    low = F.lit(needle.lower())
    return (
        F.contains(F.lower(null_to_blank(first)), low)
        | F.contains(F.lower(null_to_blank(last)), low)
        | F.contains(full_name(first, last), low)
    )
