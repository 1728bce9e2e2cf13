"""The generic board query over landed board tables, and season regrouping."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.functions.text import null_to_blank, number, spin_season
from dugout.operators.grouping import sums_with_labels
from dugout.operators.pitch_search import filter_rows, value_filter
from dugout.plans.registry import NAMED, Board, board

PLACEHOLDER_ID = "999999"
# Fixed names: parameters that shape the page and not the rows, and parameters whose column
# has another name.
DISPLAY_PARAMS = {"showColumn", "csv"}
OFF = {"0", "false", "no", ""}
PARAM_COLUMNS = {"gameType": "game_type", "gameType[]": "game_type", "pitcher_throws": "pitcher_hand"}
BOUND_COLUMNS = {"exchange": "exchange_2b"}
ID_COLUMNS = ("player_id", "id", "pitcher_id")


def board_path(root: str, slug: str) -> str:
    return f"{root.rstrip('/')}/{board(slug).slug}"


def land_board(df: DataFrame, root: str, slug: str) -> str:
    """Writes a board table, partitioned by season so a season query reads one folder.

    The rebalance hint gives each season few files and splits a season that is too big.
    """
    path = board_path(root, slug)
    if "year" in df.columns:
        df.hint("rebalance", F.col("year")).write.mode("overwrite").partitionBy("year").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def scan_board(spark: SparkSession, root: str, slug: str) -> DataFrame:
    """A landed board by slug or alias."""
    return spark.read.parquet(board_path(root, slug))


def id_column(df: DataFrame) -> str:
    """First present of player_id, id, pitcher_id."""
    found = next((c for c in ID_COLUMNS if c in df.columns), None)
    if found is None:
        raise ValueError(f"the board has none of {ID_COLUMNS} to find a player by")
    return found


def player_rows(df: DataFrame, player_id: int | str) -> DataFrame:
    return df.where(value_filter(df, id_column(df), str(player_id)))


def drop_placeholder(df: DataFrame) -> DataFrame:
    """Without the stand-in player 999999; rows lacking the id stay."""
    if "player_id" not in df.columns:
        return df
    return df.where(null_to_blank("player_id") != PLACEHOLDER_ID)


def season_filter(df: DataFrame, spec: Board, season: Any, year: str = "year") -> Column:
    """The season test of a board: one year, ``YYYY_method``, a span, or a set of years."""
    many = isinstance(season, (list, tuple))
    if many and not season:
        raise ValueError("season must be a year or a non-empty list of years")
    if spec.season == "range":
        span = [int(y) for y in season] if many else [int(season)]
        return F.col(year).between(min(span), max(span))
    if spec.season == "array":
        return value_filter(df, year, list(season) if many else [season])
    if many:
        raise ValueError(f"{spec.slug!r} takes a single season, got {season!r}")
    if spec.season == "special":
        if not isinstance(season, str) or "_" not in season:
            raise ValueError(f"{spec.slug!r} takes 'YYYY_method' text, got {season!r}")
        wanted, method = season.split("_", 1)
        spin_season(int(wanted), method)
        if "method" in df.columns:
            return (F.col(year) == int(wanted)) & (F.col("method") == method)
        return F.col(year) == season
    return value_filter(df, year, season)


def regroup_seasons(
    df: DataFrame,
    keys: Sequence[str],
    weight: str,
    sums: Sequence[str],
    means: Sequence[str],
    labels: Sequence[str] = (),
    year: str = "year",
) -> DataFrame:
    """One row per player over several seasons: counts add up, means weigh by count.

    Labels come from the latest season. Everything numeric combines before the shuffle.
    """
    n = number(df, weight)
    totals = {f"_s_{c}": number(df, c) for c in sums}
    for m in means:
        x = number(df, m)
        totals[f"_x_{m}"] = n * x
        totals[f"_n_{m}"] = F.when(x.isNotNull(), n)
    grouped = sums_with_labels(df, keys, labels, year, totals, newest=True)
    return grouped.select(
        *keys,
        *labels,
        *[F.col(f"_s_{c}").alias(c) for c in sums],
        *[F.try_divide(f"_x_{m}", f"_n_{m}").alias(m) for m in means],
    )


def _other_filters(df: DataFrame, spec: Board, filters: dict[str, Any]) -> DataFrame:
    """Equality filters, secondary ``min_<column>`` floors and ``<column>_min/_max`` ends."""
    out = df
    for name, value in filters.items():
        if value is None or name in DISPLAY_PARAMS:
            continue
        column = PARAM_COLUMNS.get(name, name)
        base, _, end = name.rpartition("_")
        bound = BOUND_COLUMNS.get(base, base)
        if column in df.columns:
            out = filter_rows(out, **{column: value})
        elif name.startswith("min_") and name[4:] in df.columns:
            out = out.where(number(df, name[4:]) >= float(value))
        elif end in ("min", "max") and bound in df.columns:
            test = number(df, bound)
            out = out.where(test >= float(value) if end == "min" else test <= float(value))
        else:
            raise ValueError(f"board {spec.slug!r} has no column for the filter {name!r}")
    return out


def _count_column(df: DataFrame, spec: Board, weight: str | None, param: str | None) -> str:
    column = weight or spec.min_column
    if column is None or column not in df.columns:
        raise ValueError(f"{spec.slug!r} has no count column for {param!r}; pass weight='<column>'")
    return column


def _year_pair(df: DataFrame, spec: Board, pair: str) -> DataFrame:
    """Rows of one pair of seasons, ``"YYYY-YYYY"``, by its own column or by the two seasons."""
    years = pair.split("-")
    if len(years) != 2 or not all(len(y) == 4 and y.isdecimal() for y in years):
        raise ValueError(f"year_pair must be 'YYYY-YYYY', got {pair!r}")
    if "year_pair" in df.columns:
        return df.where(F.col("year_pair") == pair)
    if {"year", "prior_year"} <= set(df.columns):
        return df.where(value_filter(df, "prior_year", years[0]) & value_filter(df, "year", years[1]))
    raise ValueError(f"board {spec.slug!r} has neither a year_pair nor a prior_year column")


def _custom_columns(df: DataFrame, spec: Board, listed: str | Sequence[str]) -> DataFrame:
    """The columns that name a row, then the listed ones, each once."""
    wanted = [c.strip() for c in (listed.split(",") if isinstance(listed, str) else listed) if c.strip()]
    missing = [c for c in wanted if c not in df.columns]
    if missing or not wanted:
        raise ValueError(f"board {spec.slug!r} has no columns {missing}" if missing else "custom_col names no column")
    naming = [c for c in (*NAMED, "id", "name", "pitcher_id", "year", "type") if c in df.columns]
    return df.select(*dict.fromkeys([*naming, *wanted]))


def leaderboard(
    df: DataFrame,
    slug: str,
    season: Any = None,
    player_id: int | str | None = None,
    type: str | None = None,
    min_n: int | str | None = None,
    qualifier: Column | str | None = None,
    weight: str | None = None,
    sums: Sequence[str] | None = None,
    means: Sequence[str] | None = None,
    **filters: Any,
) -> DataFrame:
    """Rows of a landed board: season, view, player, threshold and equality filters.

    Span boards return one regrouped row per player without a season column; set boards
    keep one row per player and season, or one per player with ``splitYear`` off, of the seasons
    that reach ``minSplit``. ``min_n="q"`` means qualified and needs a
    ``qualifier`` column or predicate, since the boards state no number for it. ``custom_col``
    names the columns to keep, ``year_pair`` the two seasons of a board of changes.
    """
    spec = board(slug)
    for name in spec.required:
        if not filters.get(name):
            raise ValueError(f"{spec.slug!r} needs the filter {name!r}")
    out = df
    if season is not None:
        out = out.where(season_filter(df, spec, season))
    if type is not None and not spec.drop_type:
        if spec.views and type not in spec.views:
            raise ValueError(f"{type!r} is not a view of {spec.slug!r}: {spec.views}")
        if "type" not in out.columns:
            raise ValueError(f"board {spec.slug!r} has no column for the view {type!r}")
        out = out.where(F.col("type") == type)
    if spec.slug == "percentile-rankings":
        out = drop_placeholder(out)
    if player_id is not None:
        out = player_rows(out, player_id)
    least = filters.pop(spec.min_param, None) if spec.min_param else None
    least = min_n if min_n is not None else least
    special = {p: filters.pop(p, None) for p in ("minSplit", "splitYear", "year_pair", "custom_col")}
    for param, value in special.items():
        if value is not None and param not in spec.filters:
            raise ValueError(f"board {spec.slug!r} does not take {param!r}")
    out = _other_filters(out, spec, filters)
    if special["year_pair"] is not None:
        out = _year_pair(out, spec, str(special["year_pair"]))
    if special["minSplit"] is not None:
        out = out.where(number(out, _count_column(out, spec, weight, "minSplit")) >= float(special["minSplit"]))
    together = special["splitYear"] is not None and str(special["splitYear"]).lower() in OFF
    if together:
        # The count is what the means weigh by, so it is there or the call fails.
        weight = _count_column(out, spec, weight, "splitYear")
        sums = list(dict.fromkeys([weight, *(sums or spec.sums)]))
    if (spec.season == "range" or together) and "year" in out.columns:
        keys = [c for c in ("id", "player_id", "side", "type") if c in out.columns]
        labels = [c for c in ("name", "last_name", "first_name") if c in out.columns]
        count = weight or spec.weight
        out = regroup_seasons(
            out,
            keys,
            count,
            [c for c in (sums or spec.sums) if c in out.columns],
            [c for c in (means or spec.means) if c in out.columns],
            labels,
        )
    if least == "q":
        if qualifier is None:
            raise ValueError("min_n='q' needs a qualifier column or predicate")
        out = out.where(qualifier)
    elif least is not None:
        out = out.where(number(out, _count_column(out, spec, weight, spec.min_param)) >= float(least))
    listed = special["custom_col"]
    return out if listed is None else _custom_columns(out, spec, listed)


def page_rows(pages: DataFrame, spec: Board, json: str = "json") -> DataFrame:
    """The array in each page as rows, one per element, with the board's columns as text.

    Boards without stated columns give the element itself as ``row``. Pages without an array
    give no rows; ``<json>_status`` on the pages says why.
    """
    kept = [c for c in pages.columns if c not in (json, f"{json}_status", "html", *spec.columns)]
    rows = pages.select(*kept, F.explode(F.try_variant_get(json, "$", "array<variant>")).alias("row"))
    if not spec.columns:
        return rows
    fields = [F.try_variant_get("row", f"$.{c}", "string").alias(c) for c in spec.columns]
    return rows.select(*kept, *fields)
