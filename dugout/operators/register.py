"""Player register: lookup filters and id conversion between the id systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.functions.text import blank_to_null, name_matches

# Fixed names of the register's id columns.
ID_COLUMNS = {
    "mlbam": "key_mlbam",
    "fangraphs": "key_fangraphs",
    "bbref": "key_bbref",
    "bbref_minors": "key_bbref_minors",
    "retro": "key_retro",
}
ROW_ORDER = "row_order"


def lookup(
    register: DataFrame,
    name: str | None = None,
    mlbam: int | str | None = None,
    fangraphs: int | str | None = None,
    bbref: str | None = None,
    bbref_minors: str | None = None,
    retro: str | None = None,
    mlb_only: bool = True,
) -> DataFrame:
    """Register rows meeting every given test; ids compare as text.

    ``mlb_only`` keeps players with a first or last played year. A blank id matches nobody.
    """
    given = {
        "mlbam": mlbam,
        "fangraphs": fangraphs,
        "bbref": bbref,
        "bbref_minors": bbref_minors,
        "retro": retro,
    }
    out = register
    for system, value in given.items():
        if value is not None:
            out = out.where(blank_to_null(ID_COLUMNS[system]) == str(value))
    if name:
        out = out.where(name_matches(name, "name_first", "name_last"))
    if mlb_only:
        first, last = blank_to_null("mlb_played_first"), blank_to_null("mlb_played_last")
        out = out.where(first.isNotNull() | last.isNotNull())
    return out


def crosswalk(register: DataFrame, source: str, target: str, row_order: str = ROW_ORDER) -> DataFrame:
    """One row per source id, from the register row that comes first; blank targets are NULL."""
    key, value = ID_COLUMNS[source], ID_COLUMNS[target]
    known = register.where(blank_to_null(key).isNotNull())
    first = known.groupBy(F.col(key).alias("_id")).agg(F.min_by(value, row_order).alias("_to"))
    return first.select("_id", blank_to_null("_to").alias("_to"))


def convert_ids(
    df: DataFrame,
    column: str,
    register: DataFrame,
    source: str,
    target: str,
    out: str,
    row_order: str = ROW_ORDER,
) -> DataFrame:
    """Adds the ``target`` id for a column of ``source`` ids; unknown or blank gives NULL.

    No broadcast hint: the register is small in practice, and Spark broadcasts it when its
    measured size allows, else it sort-merges with skewed ids split at run time.
    """
    pairs = crosswalk(register, source, target, row_order).withColumnRenamed("_to", out)
    key = blank_to_null(F.col(column).cast("string"))
    return df.join(pairs, key == F.col("_id"), "left").drop("_id")
