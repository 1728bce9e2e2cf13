"""What landed payloads hold: paths and their types over time, and a typed table of the whole.

Both read VARIANT, so no field is named by hand. The inventory counts leaves per path and type in a hash aggregate;
the merged type of all bodies is one aggregate that combines in every task before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dugout.operators.feed_diffs import leaf_rows

MISSING = "VOID"


def _parsed(df: DataFrame, body: str) -> Column:
    return F.col(body) if isinstance(df.schema[body].dataType, T.VariantType) else F.try_parse_json(F.col(body))


def path_inventory(df: DataFrame, body: str, ts: str, depth: int | None = None) -> DataFrame:
    """(path, type, n, first_seen, last_seen) of all leaves; positions in arrays are ``*`` in a path.

    A JSON null has the type ``VOID``; empty objects and arrays are leaves of type ``OBJECT<>`` and ``ARRAY<VOID>``.
    """
    leaves = leaf_rows(df, [ts], body, depth)
    # Pointers escape what a name may hold, so a star of its own is told by its missing name.
    part = F.transform("steps", lambda s: F.coalesce(F.replace(F.replace(s["name"], F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")), F.lit("*")))
    path = F.when(F.size("steps") > 0, F.concat(F.lit("/"), F.array_join(part, "/"))).otherwise("")
    kind = F.schema_of_variant(F.try_parse_json("value"))
    return (
        leaves.select(path.alias("path"), kind.alias("type"), F.col(ts).alias("_at"))
        .groupBy("path", "type")
        .agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first_seen"), F.max("_at").alias("last_seen"))
    )


def drifting_paths(inventory: DataFrame) -> DataFrame:
    """Paths that have held more than one type besides null: path, types, n, changed (when the newest type came)."""
    typed = inventory.where(F.col("type") != MISSING)
    return (
        typed.groupBy("path")
        .agg(
            F.array_sort(F.collect_set("type")).alias("types"),
            F.sum("n").alias("n"),
            F.max("first_seen").alias("changed"),
        )
        .where(F.size("types") > 1)
    )


def payload_type(df: DataFrame, body: str) -> str:
    """The type that fits all bodies, as DDL; parts that disagree stay VARIANT. Runs a job; one text reaches the driver."""
    found = df.agg(F.schema_of_variant_agg(_parsed(df, body)).alias("s")).first()["s"] or MISSING
    # Variant types write objects as OBJECT; names stand in backquotes if they need to.
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    bare = [p if p.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", p).replace(MISSING, "STRING") for p in parts]
    return "".join(bare)


def typed_payloads(df: DataFrame, body: str, keep: Sequence[str] = (), kind: str | None = None) -> DataFrame:
    """``keep`` and the fields of each body as typed columns, shredded by the type of all bodies.

    Give ``kind`` to keep a type fixed; a body that does not fit it has NULL in that place.
    """
    ddl = kind or payload_type(df, body)
    if not ddl.startswith("STRUCT<"):
        raise ValueError(f"bodies are no objects but {ddl}")
    typed = df.select(*keep, F.try_variant_get(_parsed(df, body), "$", ddl).alias("_typed"))
    return typed.select(*keep, "_typed.*")
