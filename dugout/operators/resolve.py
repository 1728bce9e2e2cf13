"""Free text to codes: teams, pitch types, hands, team ids, players; labels.

Each resolver is a left equi-join with a fixed alias table (broadcast, under 200 rows). A
spelling owned by several codes goes to the one listed first.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.functions.text import strip
from dugout.sources import codes

MATCH_CUTOFF = 0.6


def _first_owner(pairs: Iterable[tuple[str, object]]) -> dict[str, object]:
    owners: dict[str, object] = {}
    for spelling, code in pairs:
        owners.setdefault(spelling, code)
    return owners


def team_spellings() -> dict[str, str]:
    return _first_owner(
        (s.lower(), code)
        for code, name, city, others in codes.TEAMS
        for s in (code, name, city, *others)
    )


def pitch_spellings() -> dict[str, str]:
    by_code = [(code.lower(), code) for code, _ in codes.PITCH_TYPES]
    by_name = [(name.lower(), code) for code, name in codes.PITCH_TYPES]
    return _first_owner([*by_code, *codes.PITCH_WORDS, *by_name])


def hand_spellings() -> dict[str, str]:
    return _first_owner(codes.HAND_WORDS)


def team_id_spellings() -> dict[str, int]:
    """Lower-cased names and abbreviations; no spelling is both, so one table serves."""
    names = [(n.lower(), i) for n, i in codes.TEAM_IDS]
    return _first_owner([*names, *[(a.lower(), i) for a, i in codes.TEAM_ABBREVS]])


SPELLINGS = {
    "team": team_spellings,
    "pitch_type": pitch_spellings,
    "hand": hand_spellings,
    "team_id": team_id_spellings,
}


def suggestion_pool(kind: str) -> list[str]:
    """Accepted spellings in their own case, the pool for suggestions."""
    teams = codes.TEAMS
    pools = {
        "team": [t[0] for t in teams] + [t[1] for t in teams] + [a for t in teams for a in t[3]],
        "pitch_type": [c for c, _ in codes.PITCH_TYPES]
        + [n for _, n in codes.PITCH_TYPES]
        + [w for w, _ in codes.PITCH_WORDS],
        "hand": [w for w, _ in codes.HAND_WORDS],
        "team_id": [n for n, _ in codes.TEAM_IDS] + [a for a, _ in codes.TEAM_ABBREVS],
    }
    return pools[kind]


def team_code(text: str) -> str:
    """Driver-side form for one argument; raises with a suggestion on a miss."""
    code = team_spellings().get(text.strip().lower())
    if code is None:
        close = difflib.get_close_matches(text, suggestion_pool("team"), n=1, cutoff=MATCH_CUTOFF)
        hint = f" Did you mean {close[0]!r}?" if close else ""
        raise ValueError(f"{text!r} is not a valid team.{hint}")
    return code


def spelling_table(spark: SparkSession, kind: str) -> DataFrame:
    rows = sorted(SPELLINGS[kind]().items())
    return F.broadcast(codes.fixed_frame(spark, rows, ("_spelling", "_code")))


def resolve(df: DataFrame, text: str, kind: str, out: str) -> DataFrame:
    """Adds ``out``: the code for free text in ``text``; a miss or blank gives NULL."""
    table = spelling_table(df.sparkSession, kind).withColumnRenamed("_code", out)
    joined = df.join(table, F.lower(strip(text)) == F.col("_spelling"), "left")
    return joined.drop("_spelling")


def unresolved(df: DataFrame, text: str, kind: str) -> DataFrame:
    """Distinct non-blank texts without a code, with their row counts."""
    table = spelling_table(df.sparkSession, kind)
    misses = df.join(table, F.lower(strip(text)) == F.col("_spelling"), "left_anti")
    counted = misses.groupBy(F.col(text).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.length(strip("value")) > 0)


def label(df: DataFrame, code: str, table: str, out: str, side: str = "pitch") -> DataFrame:
    """Adds the label of a code; unknown codes give NULL."""
    dim = codes.code_table(df.sparkSession, table, side).select(
        F.col("code").alias("_key"), F.col("label").alias(out)
    )
    return df.join(dim, F.col(code).cast("string") == F.col("_key"), "left").drop("_key")


def outside_table(df: DataFrame, code: str, table: str, side: str = "pitch") -> DataFrame:
    """Values of a column that its code table does not know, with row counts."""
    dim = codes.code_table(df.sparkSession, table, side).select(F.col("code").alias("_key"))
    counts = df.groupBy(F.col(code).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(dim, F.col("value") == F.col("_key"), "left_anti").where("value != ''")


def best_player(people: DataFrame, by: Sequence[Column], player_id: str, active: str) -> DataFrame:
    """Per key the active player with the largest id, else the largest id of all."""
    ident = F.col(player_id)
    best = F.coalesce(F.max(F.when(F.col(active), ident)), F.max(ident))
    return people.groupBy(*by).agg(best.alias("_best"))


def resolve_players(
    names: DataFrame,
    people: DataFrame,
    *,
    query: str,
    name: str,
    player_id: str,
    active: str,
    out: str = "resolved_id",
) -> DataFrame:
    """Adds the id each queried name resolves to, or NULL.

    People are reduced to one row per name before the join, so a common name costs one
    shuffled row; names match without regard to case and outer blanks.
    """
    keyed = best_player(people, [F.lower(strip(name)).alias("_name")], player_id, active)
    hits = keyed.withColumnRenamed("_best", out)
    return names.join(hits, F.lower(strip(query)) == F.col("_name"), "left").drop("_name")
