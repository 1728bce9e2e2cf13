"""Registered queries over the driver's tables, each beside the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dugout.functions import spin, text
from dugout.operators import (
    arsenal,
    derived,
    entities,
    leaderboard,
    pitch_search,
    ranking,
    register,
    resolve,
    streaks,
)
from dugout.plans import endpoints
from dugout.plans.endpoints import Settings
from dugout.plans.pitches import ORACLE_PITCHES, pitches, table
from dugout.plans.registry import board
from dugout.session import shared_path
from dugout.sources import codes, files
from dugout.streaming import feeds

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """``run`` rounds its doubles for the comparison, ``raw`` is the query alone."""

    run: Run
    sql: str | None
    raw: Run


QUERIES: dict[str, Query] = {}
# Doubles are compared at six places; the same half-even step on both engines, and + 0 turns
# a negative zero into zero.
SCALE = 1e6


# So many rounded columns would make a stage's method too large to be compiled.
WIDE = 20


def query(sql: str | None = None, doubles: str = ""):
    """Registers a query; ``doubles`` names the columns both sides round."""

    def add(run: Run) -> Run:
        checked = sql
        if sql and doubles:
            rounded = ", ".join(
                f'round_even("{c}" * {SCALE}, 0) / {SCALE} + 0e0 AS "{c}"' for c in doubles.split()
            )
            checked = f"SELECT * REPLACE ({rounded}) FROM ({sql}) AS result"

        def rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = run(spark, sf_dir)
            rounded = {c: F.rint(F.col(c) * SCALE) / SCALE + F.lit(0.0) for c in doubles.split()}
            return df.withColumns(spin.apart(rounded, next(iter(rounded))) if len(rounded) > WIDE else rounded)

        QUERIES[run.__name__] = Query(rounding if doubles else run, checked, run)
        return run

    return add


def with_pitches(sql: str) -> str:
    return f"WITH p AS ({ORACLE_PITCHES}) {sql}"


# The team at bat and in the field, by half inning.
BATTING = "CASE inning_topbot WHEN 'Top' THEN away_team WHEN 'Bot' THEN home_team END"
PITCHING = "CASE inning_topbot WHEN 'Top' THEN home_team WHEN 'Bot' THEN away_team END"


def num(c: str) -> str:
    return f"TRY_CAST(NULLIF({c}, '') AS DOUBLE)"


def clock_sql(x: str) -> str:
    total = f"(({x}) % 360e0 / 360e0 * 12 * 60)"
    hour = f"floor({total} / 60)"
    minute = f"CAST(round_even({total} - {hour} * 60, 0) AS INT)"
    rolled = f"CAST(CASE WHEN {minute} = 60 THEN {hour} + 1 ELSE {hour} END AS INT) % 12"
    face = f"CASE WHEN {rolled} = 0 THEN 12 ELSE {rolled} END"
    return f"CAST({face} AS VARCHAR) || ':' || lpad(CAST({minute} % 60 AS VARCHAR), 2, '0')"


# --------------------------------------------------------------------------------------
# Arsenals
# --------------------------------------------------------------------------------------

IN_VIEW = ("release_speed", "release_spin_rate", "release_extension", "launch_speed", "launch_angle", "spin_axis")
AVERAGES = " ".join(f"avg_{m}" for m in arsenal.ARSENAL_METRICS)


def arsenal_sql(keys: tuple[str, ...], source: str = "p", carried: tuple[str, ...] = ("player_name", "p_throws")) -> str:
    means = ", ".join(
        f"avg({num(m)}) AS avg_{m}" if m in IN_VIEW else f"CAST(NULL AS DOUBLE) AS avg_{m}"
        for m in arsenal.ARSENAL_METRICS
    )
    order = "CAST(game_date - DATE '1970-01-01' AS BIGINT) * 10000000000 + game_pk"
    firsts = ", ".join(f"arg_min({c}, {order}) AS {c}" for c in carried)
    share = ""
    if "pitcher" in keys:
        share = "100e0 * n_pitches / sum(n_pitches) OVER (PARTITION BY pitcher) AS usage_pct,"
    names = ", ".join(keys)
    return f"""
        SELECT *, {share} {clock_sql('avg_spin_axis')} AS avg_tilt
        FROM (SELECT {names}, {firsts}, count(*) AS n_pitches, {means} FROM {source} GROUP BY {names})
    """


@query(with_pitches(arsenal_sql(("pitcher", "pitch_type"))), f"usage_pct {AVERAGES}")
def arsenal_per_pitcher(spark, sf):
    return arsenal.aggregate_arsenal(pitches(spark, sf))


@query(
    with_pitches(
        "SELECT * EXCLUDE (player_name, p_throws) FROM ("
        + arsenal_sql(("pitch_type",))
        + ")"
    ),
    AVERAGES,
)
def arsenal_per_type(spark, sf):
    rows = pitches(spark, sf).drop("player_name", "p_throws")
    return arsenal.aggregate_arsenal(rows, ("pitch_type",))


@query(with_pitches(arsenal_sql(("pitcher", "away_team", "pitch_type"))), f"usage_pct {AVERAGES}")
def arsenal_per_opponent(spark, sf):
    return arsenal.aggregate_arsenal(pitches(spark, sf), ("pitcher", "away_team", "pitch_type"))


@query(
    with_pitches(
        arsenal_sql(
            ("pitcher", "pitch_type"),
            "(SELECT * FROM p WHERE pitcher = '7' AND level = 'mlb' "
            "AND game_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31')",
        )
    ),
    f"usage_pct {AVERAGES}",
)
def arsenal_of_one_pitcher(spark, sf):
    return arsenal.pitcher_arsenal(pitches(spark, sf), 7, "1996-01-01", "1999-12-31")


# --------------------------------------------------------------------------------------
# Scalar functions
# --------------------------------------------------------------------------------------

SPIN_SQL = with_pitches(f"""
, i AS (SELECT game_pk, pitcher, pitch_type,
    {", ".join(f"{num(c)} AS i_{c}" for c in spin.SPIN_INPUTS)} FROM p),
l1 AS (SELECT *, nullif(sqrt(i_spinx*i_spinx + i_spiny*i_spiny + i_spinz*i_spinz), 0) AS spin_rate,
    60.5e0 - i_release_extension AS release_pos_y FROM i),
l2 AS (SELECT *, i_vy0*i_vy0 + i_ay*(release_pos_y - 50e0)*2 AS d1 FROM l1),
l3 AS MATERIALIZED (SELECT *, CASE WHEN d1 >= 0 AND i_ay <> 0 THEN (-i_vy0 - sqrt(greatest(d1, 0)))/i_ay END AS tR FROM l2),
l4 AS (SELECT *, i_vx0 + i_ax*tR AS vxR, i_vy0 + i_ay*tR AS vyR, i_vz0 + i_az*tR AS vzR FROM l3),
l5 AS (SELECT *, vyR*vyR - i_ay*(release_pos_y - 17e0/12e0)*2 AS d2 FROM l4),
l6 AS MATERIALIZED (SELECT *, CASE WHEN d2 >= 0 AND i_ay <> 0 THEN (-vyR - sqrt(greatest(d2, 0)))/i_ay END AS tF FROM l5),
l7 AS (SELECT *, (vxR*2 + i_ax*tF)/2 AS vxbar, (vyR*2 + i_ay*tF)/2 AS vybar, (vzR*2 + i_az*tF)/2 AS vzbar FROM l6),
l8 AS MATERIALIZED (SELECT *, nullif(sqrt(vxbar*vxbar + vybar*vybar + vzbar*vzbar), 0) AS vbar FROM l7),
l9 AS (SELECT *, vxbar/vbar AS vx_hat, vybar/vbar AS vy_hat, vzbar/vbar AS vz_hat,
    i_spinx/spin_rate AS wx_hat, i_spiny/spin_rate AS wy_hat, i_spinz/spin_rate AS wz_hat FROM l8),
l10 AS (SELECT *, -(i_ax*vx_hat + i_ay*vy_hat + (i_az + 32.174e0)*vz_hat) AS aD,
    wy_hat*vz_hat - wz_hat*vy_hat AS c_x, wz_hat*vx_hat - wx_hat*vz_hat AS c_y, wx_hat*vy_hat - wy_hat*vx_hat AS c_z FROM l9),
l11 AS MATERIALIZED (SELECT *, i_ax + aD*vx_hat AS aTx, i_ay + aD*vy_hat AS aTy, i_az + aD*vz_hat + 32.174e0 AS aTz,
    nullif(sqrt(c_x*c_x + c_y*c_y + c_z*c_z), 0) AS spin_eff, spin_rate*9.125e0/(vbar*720) AS S FROM l10),
l12 AS (SELECT *, nullif(sqrt(aTx*aTx + aTy*aTy + aTz*aTz), 0) AS "aT",
    aTx*5e-1*(tF*tF)*12e0 AS MTx, aTz*5e-1*(tF*tF)*12e0 AS MTz,
    c_x/spin_eff AS aLx_hat, c_y/spin_eff AS aLy_hat, c_z/spin_eff AS aLz_hat, S*spin_eff AS eff_S,
    pow(S, 1.401e0)*0.4152e0/(pow(S, 1.401e0) + pow(0.1904e0, 1.401e0))*spin_eff AS CL FROM l11),
l13 AS MATERIALIZED (SELECT *, aTx/"aT" AS aTx_hat, aTy/"aT" AS aTy_hat, aTz/"aT" AS aTz_hat, sqrt(MTx*MTx + MTz*MTz) AS MT,
    degrees(atan2(aLz_hat, aLx_hat)) AS phiL, 0.005383e0*CL*(vbar*vbar) AS aM FROM l12),
l14 AS (SELECT *, degrees(atan2(aTz_hat, aTx_hat)) AS phiT,
    aTx_hat*aLx_hat + aTy_hat*aLy_hat + aTz_hat*aLz_hat AS L_align, aM/"aT" AS M_prop,
    aLx_hat AS aMx_hat, aLy_hat AS aMy_hat, aLz_hat AS aMz_hat, phiL AS phiM FROM l13),
l15 AS (SELECT *, phiT - phiL AS axis_shift, MT*L_align AS ML, MT*M_prop AS MM FROM l14),
l16 AS (SELECT *, sqrt(greatest(MT*MT - ML*ML, 0)) AS MS, aLx_hat*ML AS MLx, aLz_hat*ML AS MLz,
    MM*cos(radians(phiM)) AS MMx, MM*sin(radians(phiM)) AS MMz FROM l15),
l17 AS (SELECT *, MTx - MLx AS MSx, MTz - MLz AS MSz, MTx - MMx AS MNx, MTz - MMz AS MNz FROM l16),
l18 AS (SELECT *, degrees(atan2(MSz, MSx)) AS phiS, sqrt(MNx*MNx + MNz*MNz) AS MN,
    degrees(atan2(MNz, MNx)) AS phiN FROM l17)
SELECT game_pk, pitcher, pitch_type,
    {", ".join(f'CASE WHEN M_prop IS NOT NULL THEN "{c}" END AS "{c}"' for c in spin.SPIN_COLUMNS)} FROM l18
""")


@query(SPIN_SQL, " ".join(spin.SPIN_COLUMNS))
def spin_physics(spark, sf):
    rows = pitches(spark, sf).select("game_pk", "pitcher", "pitch_type", *spin.SPIN_INPUTS)
    return spin.add_spin_columns(rows).drop(*spin.SPIN_INPUTS)


@query(with_pitches(f"SELECT game_pk, spin_axis, {clock_sql(num('spin_axis'))} AS clock FROM p"))
def spin_axis_clock(spark, sf):
    rows = pitches(spark, sf)
    return rows.select("game_pk", "spin_axis", spin.axis_to_clock("spin_axis", numeric=False).alias("clock"))


@query(
    with_pitches(f"""
    , n AS (SELECT game_pk, {num('vy0')} AS v, {num('ay')} AS a, 60.5e0 - {num('release_extension')} - 50e0 AS d FROM p)
    SELECT game_pk, CASE WHEN v*v + a*d*2 >= 0 AND a <> 0 THEN (-v - sqrt(greatest(v*v + a*d*2, 0)))/a END AS seconds FROM n"""),
    "seconds",
)
def release_air_time(spark, sf):
    rows = pitches(spark, sf)
    v, a = text.to_float("vy0"), text.to_float("ay")
    distance = spin.MOUND_FT - text.to_float("release_extension") - spin.MEASURED_AT_FT
    return rows.select("game_pk", spin.air_time(v, a, distance, forward=False).alias("seconds"))


SPELLED = """
    SELECT l_orderkey, l_linenumber, CASE l_linenumber
        WHEN 1 THEN CAST(l_quantity AS STRING) WHEN 2 THEN CAST(l_quantity AS STRING) || 'd'
        WHEN 3 THEN '0x' || CAST(l_linenumber AS STRING) WHEN 4 THEN '1_' || CAST(l_orderkey AS STRING)
        WHEN 5 THEN '  ' || CAST(l_quantity AS STRING) || ' ' WHEN 6 THEN '' ELSE 'n/a' END AS cell
    FROM {lineitem}
"""


@query(f"""
    SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN CAST(cell AS DOUBLE)
        WHEN 4 THEN CAST(replace(cell, '_', '') AS DOUBLE) WHEN 5 THEN CAST(trim(cell) AS DOUBLE) END AS number
    FROM ({SPELLED.format(lineitem='lineitem')})""")
def text_to_number(spark, sf):
    cells = spark.sql(SPELLED, lineitem=table(spark, sf, "lineitem"))
    return cells.select("l_orderkey", "l_linenumber", text.to_float("cell").alias("number"))


@query(
    with_pitches(f"""SELECT game_pk, NULLIF(release_speed, '') AS release_speed, {num('launch_speed')} AS launch_speed,
        {num('qoc')} AS qoc, NULLIF(pitch_type, '') AS pitch_type FROM p""")
)
def numeric_columns(spark, sf):
    rows = pitches(spark, sf).select("game_pk", "release_speed", "launch_speed", "qoc", "pitch_type")
    return text.cast_numeric(rows)


DATE_TEXTS = """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN day WHEN '2-HIGH' THEN us
        WHEN '3-MEDIUM' THEN day || 'T10:20:30' WHEN '4-NOT SPECIFIED' THEN ' ' || day || ' ' ELSE 'TBD ' || o_orderstatus END AS cell
    FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
        substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 6, 2) || '/' || substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 9, 2)
        || '/' || substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4) AS us FROM {orders})
"""


@query("""
    SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'TBD ' || o_orderstatus
        ELSE strftime(o_orderdate, '%m/%d/%Y') END AS formatted,
        CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def date_texts(spark, sf):
    cells = spark.sql(DATE_TEXTS, orders=table(spark, sf, "orders"))
    return cells.select(
        "o_orderkey", text.format_date("cell").alias("formatted"), text.parse_date("cell").alias("parsed")
    )


@query("SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS timecode, date_trunc('second', ts) AS moment FROM events")
def timecodes(spark, sf):
    stamped = table(spark, sf, "events").select("event_id", text.format_timecode("ts").alias("timecode"))
    return stamped.withColumn("moment", text.parse_timecode("timecode"))


@query("""
    SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '_spin-based' AS season,
        CAST(year(o_orderdate) AS INTEGER) AS season_year, 'spin-based' AS method FROM orders""")
def spin_seasons(spark, sf):
    rows = table(spark, sf, "orders")
    tagged = rows.select("o_orderkey", text.spin_season(F.year("o_orderdate")).alias("season"))
    year, method = text.split_spin_season("season")
    return tagged.select("*", year.alias("season_year"), method.alias("method"))


# --------------------------------------------------------------------------------------
# Pitch search
# --------------------------------------------------------------------------------------

FOUND = "game_pk, game_date, level, pitcher, batter, pitch_type, events, home_team, away_team"


def found(df: DataFrame) -> DataFrame:
    return df.select(*FOUND.split(", "))


@query(
    with_pitches(f"""SELECT {FOUND} FROM p WHERE game_date BETWEEN DATE '1996-03-01' AND DATE '1998-10-31'
        AND level = 'mlb' AND pitch_type IN ('FF', 'CU') AND events = 'home_run'""")
)
def search_by_filters(spark, sf):
    return found(
        pitch_search.search_pitches(
            pitches(spark, sf), "1996-03-01", "1998-10-31", hfPT="FF|CU|", hfAB="home_run|"
        )
    )


@query(
    with_pitches(f"""SELECT {FOUND} FROM p WHERE game_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
        AND level = 'milb' AND batter = '25'""")
)
def search_batter(spark, sf):
    return found(
        pitch_search.statcast_search(pitches(spark, sf), "1995-01-01", "2001-12-31", "batter", 25, "milb")
    )


@query(
    with_pitches(f""", q AS (SELECT * FROM p WHERE game_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' AND level = 'mlb')
        SELECT {FOUND} FROM q WHERE pitcher IN (SELECT pitcher FROM q GROUP BY pitcher HAVING count(*) >= 300)""")
)
def search_min_pitches(spark, sf):
    return found(
        pitch_search.search_pitches(pitches(spark, sf), "1995-01-01", "2001-12-31", min_pitches=300)
    )


@query(with_pitches(f"SELECT {FOUND} FROM p WHERE game_pk = 4242 AND level = 'mlb'"))
def search_one_game(spark, sf):
    return found(pitch_search.search_game(pitches(spark, sf), 4242))


@query(
    with_pitches(f"""SELECT {FOUND} FROM p WHERE game_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
        AND level = 'mlb' AND pitcher = '7' AND batter = '25'""")
)
def search_matchups(spark, sf):
    return found(pitch_search.search_matchup(pitches(spark, sf), 7, 25, "1995-01-01", "2001-12-31"))


@query(
    with_pitches(f"""SELECT {FOUND} FROM p WHERE game_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
        AND level = 'mlb' AND (home_team = 'T5' OR away_team = 'T5')""")
)
def search_team_any_side(spark, sf):
    return found(
        pitch_search.search_team(pitches(spark, sf), "T5", "1995-01-01", "2001-12-31", resolve=False)
    )


@query(
    with_pitches(f"""SELECT {FOUND} FROM p WHERE game_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
        AND level = 'milb' AND away_team = 'T5'""")
)
def search_team_away(spark, sf):
    return found(
        pitch_search.search_team(
            pitches(spark, sf), "T5", "1995-01-01", "2001-12-31", "away", "milb", resolve=False
        )
    )


@query(
    with_pitches("SELECT level, game_date, count(*) AS n_pitches FROM p GROUP BY level, game_date HAVING count(*) >= 15")
)
def days_at_cap(spark, sf):
    return pitch_search.capped_days(pitches(spark, sf), 15)


@query(with_pitches("SELECT pitcher, count(*) AS pitches FROM p GROUP BY pitcher"))
def pitches_per_player(spark, sf):
    return pitch_search.by_pitches(pitches(spark, sf))


# --------------------------------------------------------------------------------------
# Register, ids, names, codes
# --------------------------------------------------------------------------------------

REGISTER = """
    SELECT CAST(c_custkey AS STRING) AS key_mlbam,
        CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'x' || CAST(CAST(floor(c_custkey / 2e0) AS BIGINT) AS STRING) END AS key_fangraphs,
        CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'b' || CAST(CAST(floor(c_custkey / 3e0) AS BIGINT) AS STRING) END AS key_bbref,
        '' AS key_bbref_minors, 'r' || CAST(c_custkey AS STRING) AS key_retro,
        substr(c_name, 1, 8) AS name_first, substr(c_name, 10) AS name_last,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE '1995' END AS mlb_played_first,
        CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN '' ELSE '2001' END AS mlb_played_last,
        c_custkey AS row_order FROM {customer}
"""
REGISTER_SQL = REGISTER.format(customer="customer")
REGISTER_COLUMNS = (
    "key_mlbam", "key_fangraphs", "key_bbref", "key_bbref_minors", "key_retro", "name_first",
    "name_last", "mlb_played_first", "mlb_played_last",
)


def players(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(REGISTER, customer=table(spark, sf, "customer"))


@query(f"""SELECT * FROM ({REGISTER_SQL}) WHERE (mlb_played_first <> '' OR mlb_played_last <> '')
    AND (contains(lower(name_first), 'r#0000007') OR contains(lower(name_last), '0000007')
    OR contains(lower(name_first || ' ' || name_last), '0000007'))""")
def register_by_name(spark, sf):
    return register.lookup(players(spark, sf), name="0000007")


@query(f"SELECT * FROM ({REGISTER_SQL}) WHERE key_fangraphs = 'x11'")
def register_by_id(spark, sf):
    return register.lookup(players(spark, sf), fangraphs="x11", mlb_only=False)


def crosswalk_sql(source: str, target: str, order: str = "row_order") -> str:
    key, value = register.ID_COLUMNS[source], register.ID_COLUMNS[target]
    return f"""SELECT {key} AS id, NULLIF(arg_min({value}, {order}), '') AS found
        FROM ({REGISTER_SQL}) WHERE {key} <> '' GROUP BY {key}"""


@query(f"""
    WITH o AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS mlbam, 'x' || CAST(o_custkey AS VARCHAR) AS fg,
        'b' || CAST(o_custkey AS VARCHAR) AS bb FROM orders)
    SELECT o_orderkey, a.found AS fangraphs, b.found AS bbref, c.found AS from_fangraphs, d.found AS from_bbref FROM o
    LEFT JOIN ({crosswalk_sql("mlbam", "fangraphs")}) a ON o.mlbam = a.id
    LEFT JOIN ({crosswalk_sql("mlbam", "bbref")}) b ON o.mlbam = b.id
    LEFT JOIN ({crosswalk_sql("fangraphs", "mlbam")}) c ON o.fg = c.id
    LEFT JOIN ({crosswalk_sql("bbref", "mlbam")}) d ON o.bb = d.id""")
def id_conversions(spark, sf):
    reg = players(spark, sf)
    ids = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("mlbam"),
        F.concat(F.lit("x"), "o_custkey").alias("fg"),
        F.concat(F.lit("b"), "o_custkey").alias("bb"),
    )
    out = register.convert_ids(ids, "mlbam", reg, "mlbam", "fangraphs", "fangraphs")
    out = register.convert_ids(out, "mlbam", reg, "mlbam", "bbref", "bbref")
    out = register.convert_ids(out, "fg", reg, "fangraphs", "mlbam", "from_fangraphs")
    out = register.convert_ids(out, "bb", reg, "bbref", "mlbam", "from_bbref")
    return out.drop("mlbam", "fg", "bb")


TEXTS = {
    "team": {0: "LAD", 1: " los angeles ", 2: "Chicago", 3: "Yankees", 4: "new york", 5: "d-backs", 6: "ATH", 7: "Gotham"},
    "pitch_type": {0: "ff", 1: "4-Seam Fastball", 2: " Sweeper", 3: "knuckle", 4: "Curveball", 5: "split-finger", 6: "xx", 7: ""},
    "hand": {0: "R", 1: "lefty", 2: " Switch ", 3: "both", 4: "RHP", 5: "left-handed", 6: "neither", 7: ""},
    "team_id": {0: "Dodgers", 1: "lad", 2: "Los Angeles Dodgers", 3: "AZ", 4: "red sox", 5: "KCR", 6: "Gotham", 7: ""},
}
ANSWERS = {
    "team": {0: "'LAD'", 1: "'LAA'", 2: "'CHC'", 3: "'NYY'", 4: "'NYM'", 5: "'ARI'", 6: "'OAK'"},
    "pitch_type": {0: "'FF'", 1: "'FF'", 2: "'ST'", 3: "'KN'", 4: "'CU'", 5: "'FS'"},
    "hand": {0: "'R'", 1: "'L'", 2: "'S'", 3: "'S'", 4: "'R'", 5: "'L'"},
    "team_id": {0: "119", 1: "119", 2: "119", 3: "109", 4: "111", 5: "118"},
}


def spoken(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Every customer with a free text that depends on its nation."""
    cell = F.lit(None).cast("string")
    for n, value in TEXTS[kind].items():
        cell = F.when(F.col("c_nationkey") % 8 == n, value).otherwise(cell)
    return table(spark, sf, "customer").select("c_custkey", cell.alias("spoken"))


def spoken_sql(kind: str) -> str:
    cells = " ".join(f"WHEN {n} THEN '{v}'" for n, v in TEXTS[kind].items())
    codes_ = " ".join(f"WHEN {n} THEN {v}" for n, v in ANSWERS[kind].items())
    return f"""SELECT c_custkey, CASE c_nationkey % 8 {cells} END AS spoken,
        CASE c_nationkey % 8 {codes_} END AS code FROM customer"""


@query(spoken_sql("team"))
def resolved_teams(spark, sf):
    return resolve.resolve(spoken(spark, sf, "team"), "spoken", "team", "code")


@query(spoken_sql("pitch_type"))
def resolved_pitch_types(spark, sf):
    return resolve.resolve(spoken(spark, sf, "pitch_type"), "spoken", "pitch_type", "code")


@query(spoken_sql("hand"))
def resolved_hands(spark, sf):
    return resolve.resolve(spoken(spark, sf, "hand"), "spoken", "hand", "code")


@query(f"SELECT c_custkey, spoken, CAST(code AS BIGINT) AS code FROM ({spoken_sql('team_id')})")
def resolved_team_ids(spark, sf):
    return resolve.resolve(spoken(spark, sf, "team_id"), "spoken", "team_id", "code")


@query(f"SELECT spoken AS value, count(*) AS n_rows FROM ({spoken_sql('team')}) WHERE code IS NULL AND trim(spoken) <> '' GROUP BY spoken")
def unresolved_teams(spark, sf):
    return resolve.unresolved(spoken(spark, sf, "team"), "spoken", "team")


@query("""
    WITH people AS (SELECT 'nation ' || CAST(c_nationkey AS VARCHAR) AS name, c_custkey AS id, c_acctbal > 5000 AS active FROM customer),
    best AS (SELECT name, coalesce(max(id) FILTER (WHERE active), max(id)) AS id FROM people GROUP BY name)
    SELECT s_suppkey, best.id AS resolved_id FROM supplier LEFT JOIN best ON best.name = 'nation ' || CAST(s_nationkey + 2 AS VARCHAR)""")
def resolved_players(spark, sf):
    people = table(spark, sf, "customer").select(
        F.concat(F.lit("nation "), "c_nationkey").alias("name"),
        F.col("c_custkey").alias("id"),
        (F.col("c_acctbal") > 5000).alias("active"),
    )
    asked = table(spark, sf, "supplier").select(
        "s_suppkey", F.concat(F.lit(" NATION "), F.col("s_nationkey") + 2).alias("asked")
    )
    out = resolve.resolve_players(asked, people, query="asked", name="name", player_id="id", active="active")
    return out.drop("asked")


def values_sql(rows: list[tuple]) -> str:
    quoted = ["(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r[:2]) + ")" for r in rows]
    return f"(VALUES {', '.join(quoted)})"


@query(
    with_pitches(f"""SELECT game_pk, pitch_type, t.label AS pitch_name, e.label AS result, b.label AS batted, q.label AS contact
        FROM p LEFT JOIN {values_sql(codes.PITCH_TYPES)} t(code, label) ON pitch_type = t.code
        LEFT JOIN {values_sql(codes.PA_RESULTS)} e(code, label) ON events = e.code
        LEFT JOIN {values_sql(codes.BATTED_BALLS)} b(code, label) ON bb_type = b.code
        LEFT JOIN {values_sql(codes.CONTACT_QUALITY)} q(code, label) ON qoc = q.code""")
)
def labelled_pitches(spark, sf):
    rows = pitches(spark, sf).select("game_pk", "pitch_type", "events", "bb_type", "qoc")
    for code, name, out in (
        ("pitch_type", "pitch_types", "pitch_name"),
        ("events", "pa_results", "result"),
        ("bb_type", "batted_balls", "batted"),
        ("qoc", "contact_quality", "contact"),
    ):
        rows = resolve.label(rows, code, name, out)
    return rows.drop("events", "bb_type", "qoc")


@query(
    f"""SELECT CAST(month(o_orderdate) AS VARCHAR) AS code, label, count(*) AS n FROM orders
    JOIN {values_sql(codes.SITUATIONS["month"])} t(c, label) ON CAST(month(o_orderdate) AS VARCHAR) = c GROUP BY ALL"""
)
def labelled_months(spark, sf):
    months = table(spark, sf, "orders").select(F.month("o_orderdate").cast("string").alias("code"))
    counts = months.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    return resolve.label(counts, "code", "situations", "label", "api").select("code", "label", "n")


@query("SELECT event_type AS value, count(*) AS n_rows FROM events WHERE event_type NOT IN ('error', 'balk', 'walk', 'single') GROUP BY event_type")
def values_outside_codes(spark, sf):
    return resolve.outside_table(table(spark, sf, "events"), "event_type", "event_types", "api")


# --------------------------------------------------------------------------------------
# Landed boards
# --------------------------------------------------------------------------------------

BOARD = """
    SELECT CAST(o_custkey AS STRING) AS id, 'P' || CAST(o_custkey AS STRING) AS name, CAST(year(o_orderdate) AS INT) AS year,
        CASE WHEN o_custkey % 2 = 0 THEN 'batter' ELSE 'pitcher' END AS type, count(*) AS swings_competitive,
        count(*) AS n_swings, avg(o_totalprice / 997) AS avg_bat_speed, sum(o_totalprice) AS batter_run_value
    FROM {orders} GROUP BY o_custkey, year(o_orderdate)
"""
BOARD_SQL = BOARD.format(orders="orders")


def season_board(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(BOARD, orders=table(spark, sf, "orders"))


BOARD_DOUBLES = "avg_bat_speed batter_run_value"


@query(f"SELECT * FROM ({BOARD_SQL}) WHERE year = 1997 AND n_swings >= 2", BOARD_DOUBLES)
def board_one_year(spark, sf):
    """Lands the board by season, then reads the one season folder through an alias."""
    root = shared_path(spark, "boards")
    leaderboard.land_board(season_board(spark, sf), root, "running-splits-alt")
    landed = leaderboard.scan_board(spark, root, "running-splits")
    rows = leaderboard.leaderboard(landed, "running-splits", 1997, weight="n_swings", min_n=2)
    return rows.select(*season_board(spark, sf).columns)


@query(
    f"""SELECT id, type, arg_max(name, year) AS name, sum(swings_competitive)::DOUBLE AS swings_competitive,
        sum(batter_run_value) AS batter_run_value, sum(swings_competitive * avg_bat_speed) / sum(swings_competitive) AS avg_bat_speed
        FROM ({BOARD_SQL}) WHERE year BETWEEN 1996 AND 1999 GROUP BY id, type HAVING sum(swings_competitive) >= 5""",
    BOARD_DOUBLES,
)
def board_season_range(spark, sf):
    board = season_board(spark, sf).drop("n_swings")
    return leaderboard.leaderboard(board, "bat-tracking", (1999, 1996), minSwings=5)


@query(f"SELECT * FROM ({BOARD_SQL}) WHERE year IN (1996, 1999) AND type = 'batter' AND n_swings >= 3", BOARD_DOUBLES)
def board_season_array(spark, sf):
    slug = "bat-tracking/swing-timing-miss-distance"
    return leaderboard.leaderboard(season_board(spark, sf), slug, [1996, 1999], type="batter", min=3)


@query(f"SELECT * FROM ({BOARD_SQL}) WHERE id = '77'", BOARD_DOUBLES)
def board_one_player(spark, sf):
    return leaderboard.leaderboard(season_board(spark, sf), "sprint_speed", player_id=77)


@query(f"""SELECT id AS pitcher_id, season AS year, avg_bat_speed AS active_spin FROM
    (SELECT *, CAST(year AS VARCHAR) || CASE WHEN type = 'batter' THEN '_spin-based' ELSE '_observed' END AS season FROM ({BOARD_SQL}))
    WHERE season = '1998_observed'""", "active_spin")
def board_spin_season(spark, sf):
    method = F.when(F.col("type") == "batter", "spin-based").otherwise("observed")
    board = season_board(spark, sf).select(
        F.col("id").alias("pitcher_id"),
        F.concat_ws("_", F.col("year").cast("string"), method).alias("year"),
        F.col("avg_bat_speed").alias("active_spin"),
    )
    return leaderboard.leaderboard(board, "active-spin", "1998_observed")


@query(f"SELECT id AS player_id, year, avg_bat_speed AS xba FROM ({BOARD_SQL}) WHERE year = 2000 AND id <> '999999'", "xba")
def board_percentile_rows(spark, sf):
    board = season_board(spark, sf).select(
        F.col("id").alias("player_id"), "year", F.col("avg_bat_speed").alias("xba")
    )
    return leaderboard.leaderboard(board, "percentile-rankings", 2000)


@query(f"SELECT * FROM ({BOARD_SQL}) WHERE year = 2000", BOARD_DOUBLES)
def board_type_ignored(spark, sf):
    return leaderboard.leaderboard(season_board(spark, sf), "pitch-timer-infractions", 2000, type="batter")


@query(f"SELECT * FROM ({BOARD_SQL}) WHERE year = 2000 AND n_swings >= 2 AND avg_bat_speed > 250", BOARD_DOUBLES)
def board_qualified(spark, sf):
    good = (F.col("n_swings") >= 2) & (F.col("avg_bat_speed") > 250)
    return leaderboard.leaderboard(season_board(spark, sf), "game-scores", 2000, min_n="q", qualifier=good)


# --------------------------------------------------------------------------------------
# Boards derived from pitches
# --------------------------------------------------------------------------------------


@query(
    with_pitches(f"""SELECT batter, attempts, avg_hit_speed, max_hit_speed, barrels, 100e0 * barrels / attempts AS brl_percent FROM
        (SELECT batter, count(*) AS attempts, avg({num('launch_speed')}) AS avg_hit_speed, max({num('launch_speed')}) AS max_hit_speed,
        count(*) FILTER (WHERE {num('qoc')} = 6) AS barrels FROM p WHERE {num('launch_speed')} IS NOT NULL GROUP BY batter)"""),
    "avg_hit_speed max_hit_speed brl_percent",
)
def exit_velocity_board(spark, sf):
    return derived.exit_velocity(pitches(spark, sf), ["batter"])


@query(
    with_pitches("""SELECT batter, year, pa, bip, hits::DOUBLE / ab AS ba, total_bases::DOUBLE / ab AS slg FROM
        (SELECT batter, CAST(year(game_date) AS INTEGER) AS year, count(*) AS pa, count(*) FILTER (WHERE events <> 'strikeout') AS bip,
        count(*) AS ab, count(*) FILTER (WHERE events IN ('home_run', 'single')) AS hits,
        sum(CASE events WHEN 'home_run' THEN 4 WHEN 'single' THEN 1 ELSE 0 END) AS total_bases
        FROM p WHERE events <> '' GROUP BY ALL)"""),
    "ba slg",
)
def observed_stats_board(spark, sf):
    return derived.observed_stats(derived.with_season(pitches(spark, sf)), ["batter", "year"])


@query(
    with_pitches(f"""SELECT {BATTING} AS batting_team, p_throws, count(*) AS swings_competitive, avg({num('launch_speed')}) AS avg_launch_speed,
        avg({num('launch_angle')}) AS avg_launch_angle FROM p WHERE {num('launch_speed')} IS NOT NULL GROUP BY ALL"""),
    "avg_launch_speed avg_launch_angle",
)
def swing_path_board(spark, sf):
    keys = [*derived.view_key("batting-team"), "p_throws"]
    return derived.bat_tracking(derived.with_teams(pitches(spark, sf)), keys, ("launch_speed", "launch_angle"), "launch_speed")


@query(
    with_pitches(f"""SELECT batter, year, n_swings, miss_distance, 100e0 * missed / n_swings AS whiff_rate FROM
        (SELECT batter, CAST(year(game_date) AS INTEGER) AS year, count(*) AS n_swings, avg({num('launch_speed')}) AS miss_distance,
        count({num('launch_speed')}) AS missed FROM p GROUP BY ALL)"""),
    "miss_distance whiff_rate",
)
def miss_distance_board(spark, sf):
    rows = derived.with_season(pitches(spark, sf))
    return derived.miss_distance(rows, ["batter", "year"], "launch_speed")


KINDS = ("ground_ball", "line_drive", "fly_ball", "popup")


@query(
    with_pitches(f"""SELECT pitcher, bbe, la_avg, {", ".join(f"100e0 * n_{k} / bbe AS {k}_percent" for k in KINDS)} FROM
        (SELECT pitcher, count(*) AS bbe, avg({num('launch_angle')}) AS la_avg,
        {", ".join(f"count(*) FILTER (WHERE bb_type = '{k}') AS n_{k}" for k in KINDS)} FROM p GROUP BY pitcher)"""),
    "la_avg " + " ".join(f"{k}_percent" for k in KINDS),
)
def batted_ball_board(spark, sf):
    return derived.batted_ball(pitches(spark, sf), ["pitcher"])


PERCENTILE_SQL = with_pitches(f"""
    , m AS (SELECT CAST(year(game_date) AS INTEGER) AS year, batter, count(*) AS n, avg({num('launch_speed')}) AS launch_speed,
        avg({num('launch_angle')}) AS launch_angle FROM p GROUP BY ALL)
    SELECT *, CASE WHEN launch_speed IS NOT NULL THEN 100 * percent_rank() OVER (PARTITION BY year, launch_speed IS NULL ORDER BY launch_speed) END AS launch_speed_pct,
        CASE WHEN launch_angle IS NOT NULL THEN 100 * percent_rank() OVER (PARTITION BY year, launch_angle IS NULL ORDER BY launch_angle) END AS launch_angle_pct FROM m""")
PERCENTILE_DOUBLES = "launch_speed launch_angle launch_speed_pct launch_angle_pct"


@query(PERCENTILE_SQL, PERCENTILE_DOUBLES)
def percentile_board(spark, sf):
    rows = derived.with_season(pitches(spark, sf))
    return derived.percentile_board(rows, "batter", ["launch_speed", "launch_angle"])


@query(PERCENTILE_SQL, PERCENTILE_DOUBLES)
def percentile_board_hot_season(spark, sf):
    """The same board by the way taken when a season outgrows one task."""
    rows = derived.with_season(pitches(spark, sf))
    return derived.percentile_board(rows, "batter", ["launch_speed", "launch_angle"], limit=200)


@query(
    with_pitches(f"""SELECT pitcher, pitch_type, pitches, pa, 100e0 * whiffs / pitches AS whiff_percent, run_value,
        100e0 * run_value / pitches AS run_value_per100 FROM
        (SELECT pitcher, pitch_type, count(*) AS pitches, count(*) FILTER (WHERE events <> '') AS pa,
        count(*) FILTER (WHERE events = 'strikeout') AS whiffs, sum({num('launch_angle')}) AS run_value FROM p GROUP BY ALL)"""),
    "whiff_percent run_value run_value_per100",
)
def arsenal_stats_board(spark, sf):
    rows = pitches(spark, sf)
    return derived.arsenal_stats(
        rows, ["pitcher", "pitch_type"], F.col("events") == "strikeout", text.to_float("launch_angle")
    )


@query(
    with_pitches(f"""SELECT batter, count(*) AS total_home_runs, avg({num('launch_speed')}) AS avg_launch_speed,
        avg({num('launch_angle')}) AS avg_launch_angle FROM p WHERE events = 'home_run' GROUP BY batter"""),
    "avg_launch_speed avg_launch_angle",
)
def home_run_board(spark, sf):
    return derived.home_runs(pitches(spark, sf), ["batter"])


YEARLY = """SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year, avg(o_totalprice) AS price, count(*) * 1e0 AS games
    FROM {orders} GROUP BY o_custkey, year(o_orderdate)"""
YEARLY_SQL = YEARLY.format(orders="orders")


def yearly(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(YEARLY, orders=table(spark, sf, "orders"))


YEAR_CHANGE_SQL = f"""
    SELECT a.*, a.price - b.price AS price_change, a.games - b.games AS games_change FROM ({YEARLY_SQL}) a
    LEFT JOIN ({YEARLY_SQL}) b ON a.o_custkey = b.o_custkey AND a.year = b.year + 1"""


@query(YEAR_CHANGE_SQL, "price games price_change games_change")
def year_to_year_board(spark, sf):
    return derived.year_changes(yearly(spark, sf), "o_custkey", ["price", "games"])


@query(YEAR_CHANGE_SQL, "price games price_change games_change")
def year_to_year_hot_player(spark, sf):
    return derived.year_changes(yearly(spark, sf), "o_custkey", ["price", "games"], limit=2)


@query(
    f"""SELECT a.o_custkey, b.price - a.price AS price_change, b.games - a.games AS games_change FROM ({YEARLY_SQL}) a
    JOIN ({YEARLY_SQL}) b ON a.o_custkey = b.o_custkey AND a.year = 1996 AND b.year = 1999""",
    "price_change games_change",
)
def year_pair_board(spark, sf):
    return derived.year_pair_changes(yearly(spark, sf), "o_custkey", ["price", "games"], 1996, 1999)


TEMPO_SQL = """SELECT user_id, count(*) AS pitches, sum(gap)::DOUBLE / count(gap) / 1e6 AS avg_time_between_pitches FROM
    (SELECT user_id, date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts), ts) AS gap FROM events)
    GROUP BY user_id"""


@query(TEMPO_SQL, "avg_time_between_pitches")
def pitch_tempo_board(spark, sf):
    return derived.pitch_tempo(table(spark, sf, "events"), ["event_type"], "user_id", "ts")


@query(TEMPO_SQL, "avg_time_between_pitches")
def pitch_tempo_hot_game(spark, sf):
    return derived.pitch_tempo(table(spark, sf, "events"), ["event_type"], "user_id", "ts", limit=5)


@query(
    f"""SELECT pitcher, pitch_type, count(spin_eff) AS n_pitches, 100 * avg(spin_eff) AS active_spin, avg(spin_rate) AS spin_rate
    FROM ({SPIN_SQL}) GROUP BY ALL""",
    "active_spin spin_rate",
)
def active_spin_board(spark, sf):
    return derived.active_spin(pitches(spark, sf)).drop("velocity")


@query(
    with_pitches(f"""SELECT pitcher, pitch_type, p_throws, count(*) AS pitches, avg({num('release_speed')}) AS avg_speed,
        avg({num('release_spin_rate')}) AS avg_spin FROM p WHERE pitch_type = 'FF' GROUP BY ALL"""),
    "avg_speed avg_spin",
)
def pitch_movement_board(spark, sf):
    return derived.pitch_movement(pitches(spark, sf), "FF")


@query(
    with_pitches(f"""SELECT *, {clock_sql('spin_axis')} AS spin_direction FROM (SELECT pitcher, pitch_type, count(*) AS pitches,
        avg({num('release_spin_rate')}) AS spin_rate, avg({num('spin_axis')}) AS spin_axis FROM p GROUP BY ALL)"""),
    "spin_rate spin_axis",
)
def spin_direction_board(spark, sf):
    return derived.spin_direction(pitches(spark, sf), None)


@query(
    with_pitches(f"""SELECT pitcher, p_throws, count(*) AS pitches, avg({num('release_extension')}) AS arm_angle FROM p GROUP BY ALL"""),
    "arm_angle",
)
def arm_angle_board(spark, sf):
    return derived.arm_angles(pitches(spark, sf), angle="release_extension")


MIX = ("FF", "SI", "SL", "CH", "CU")


@query(
    with_pitches(f"""SELECT *, {", ".join(f"100e0 * n_{t.lower()} / pitches AS {t.lower()}_pct" for t in MIX)} FROM
        (SELECT pitcher, count(*) AS pitches, {", ".join(f"count(*) FILTER (WHERE pitch_type = '{t}') AS n_{t.lower()}" for t in MIX)}
        FROM p GROUP BY pitcher)"""),
    " ".join(f"{t.lower()}_pct" for t in MIX),
)
def pitch_mix_board(spark, sf):
    return derived.pitch_mix(pitches(spark, sf), ["pitcher"], MIX)


@query(
    with_pitches(f"""SELECT pitch_type, bb_type, count(*) AS n, avg({num('release_speed')}) AS avg_release_speed,
        avg({num('spin_axis')}) AS avg_spin_axis FROM p GROUP BY ALL"""),
    "avg_release_speed avg_spin_axis",
)
def custom_board(spark, sf):
    return derived.metric_means(pitches(spark, sf), ["pitch_type", "bb_type"], ["release_speed", "spin_axis"])


@query(
    with_pitches(f""", s AS (SELECT home_team AS team, true AS h, {num('launch_speed')} AS v FROM p
        UNION ALL SELECT away_team, false, {num('launch_speed')} FROM p),
        r AS (SELECT team, count(*) FILTER (WHERE h) AS n_home, count(*) FILTER (WHERE NOT h) AS n_road,
        avg(v) FILTER (WHERE h) AS home_rate, avg(v) FILTER (WHERE NOT h) AS road_rate FROM s GROUP BY team)
        SELECT *, 100 * home_rate / road_rate AS park_factor FROM r"""),
    "home_rate road_rate park_factor",
)
def park_factor_board(spark, sf):
    return derived.park_factors(pitches(spark, sf), text.to_float("launch_speed"))


@query(
    with_pitches(f"""SELECT n, speed, 'batter' AS view, batter AS id FROM (SELECT count(*) AS n, avg({num('launch_speed')}) AS speed, batter FROM p GROUP BY batter)
        UNION ALL SELECT count(*), avg({num('launch_speed')}), 'pitcher', pitcher FROM p GROUP BY pitcher
        UNION ALL SELECT count(*), avg({num('launch_speed')}), 'batting-team', {BATTING} FROM p GROUP BY {BATTING}
        UNION ALL SELECT count(*), avg({num('launch_speed')}), 'pitching-team', {PITCHING} FROM p GROUP BY {PITCHING}
        UNION ALL SELECT count(*), avg({num('launch_speed')}), 'league', NULL FROM p"""),
    "speed",
)
def board_all_views(spark, sf):
    def build():
        return [F.count(F.lit(1)).alias("n"), F.avg("_speed").alias("speed")]

    # Parsed before the rows are repeated once per view.
    keys = [k for k in derived.VIEWS.values() if k]
    rows = derived.with_teams(pitches(spark, sf)).select(*keys, text.to_float("launch_speed").alias("_speed"))
    return derived.all_views(rows, list(derived.VIEWS), build)


ROLLING_SQL = """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, avg(o_totalprice) OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS rolling FROM orders"""


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query(ROLLING_SQL, "rolling")
def rolling_board(spark, sf):
    return derived.rolling_mean(
        order_rows(spark, sf), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 5
    )


@query(ROLLING_SQL, "rolling")
def rolling_hot_player(spark, sf):
    return derived.rolling_mean(
        order_rows(spark, sf), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 5, limit=8
    )


@query(
    """SELECT o_custkey, day, n, sum(s) OVER w / sum(n) OVER w AS rolling FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day,
    count(*) AS n, sum(o_totalprice) AS s FROM orders GROUP BY ALL) WINDOW w AS (PARTITION BY o_custkey ORDER BY day
    RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW)""",
    "rolling",
)
def rolling_days_board(spark, sf):
    return derived.rolling_days(order_rows(spark, sf), "o_custkey", "o_orderdate", "o_totalprice", 90)


# --------------------------------------------------------------------------------------
# Ranks, pages, records
# --------------------------------------------------------------------------------------

STATS = """SELECT o_custkey, sum(o_totalprice) AS total, max(o_totalprice) AS best, count(*) * 1e0 AS games
    FROM {orders} GROUP BY o_custkey"""
STATS_SQL = STATS.format(orders="orders")


def career_stats(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(STATS, orders=table(spark, sf, "orders"))


def long_stats(spark: SparkSession, sf: str) -> DataFrame:
    wide = career_stats(spark, sf)
    stats = ["total", "best", "games"]
    # Sums add in no fixed order; rounding first keeps equal totals equal on both sides.
    wide = wide.withColumns({s: F.round(s, 2) for s in stats})
    return ranking.unpivot_stats(wide, ["o_custkey"], stats)


LONG_SQL = f"""SELECT o_custkey, category, round(value, 2) AS value FROM ({STATS_SQL})
    UNPIVOT (value FOR category IN (total, best, games))"""


@query(
    f"""SELECT * FROM (SELECT *, rank() OVER (PARTITION BY category ORDER BY value DESC) AS rank FROM ({LONG_SQL})) WHERE rank <= 10""",
    "value",
)
def stat_leaders(spark, sf):
    return ranking.leaders(long_stats(spark, sf), ["category"], "value", 10, groups=3)


@query(
    f"""SELECT o_custkey, category, value, 'high' AS record FROM ({LONG_SQL}) a WHERE value = (SELECT max(value) FROM ({LONG_SQL}) b WHERE a.category = b.category)
    UNION ALL SELECT o_custkey, category, value, 'low' AS record FROM ({LONG_SQL}) a WHERE value = (SELECT min(value) FROM ({LONG_SQL}) b WHERE a.category = b.category)""",
    "value",
)
def high_low_records(spark, sf):
    return ranking.high_low(long_stats(spark, sf), ["category"], "value", groups=3)


@query(f"SELECT o_custkey, round(total, 2) AS total FROM ({STATS_SQL}) ORDER BY total DESC, o_custkey LIMIT 25 OFFSET 50")
def stats_page(spark, sf):
    rows = career_stats(spark, sf).select("o_custkey", F.round("total", 2).alias("total"))
    return ranking.page(rows, "total", ["o_custkey"], 25, 50)


# --------------------------------------------------------------------------------------
# Streaks
# --------------------------------------------------------------------------------------

GAMES = """SELECT o_custkey, o_orderdate, o_orderkey, CAST(year(o_orderdate) AS INT) AS season,
    o_totalprice > 200000 AS hit, o_totalprice > 120000 AS on_base, o_orderstatus = 'F' AS at_home FROM {orders}"""
GAMES_SQL = GAMES.format(orders="orders")


def streak_sql(flag: str, keys: str = "o_custkey", where: str = "true", keep: str = "true") -> str:
    order = f"PARTITION BY {keys} ORDER BY o_orderdate, o_orderkey"
    return f"""SELECT {keys}, length, started, ended, is_current FROM (
        SELECT {keys}, run, count(*) FILTER (WHERE {flag}) AS length, min(o_orderdate) FILTER (WHERE {flag}) AS started,
            max(o_orderdate) FILTER (WHERE {flag}) AS ended, run = max(last_run) AS is_current
        FROM (SELECT *, max(run) OVER (PARTITION BY {keys}) AS last_run FROM (
            SELECT *, CAST(sum(CASE WHEN {flag} THEN 0 ELSE 1 END) OVER ({order}) AS BIGINT) AS run FROM ({GAMES_SQL}) WHERE {where}))
        GROUP BY {keys}, run) WHERE length > 0 AND {keep}"""


def run_streaks(spark, sf, kind: str, span: str, **more) -> DataFrame:
    return streaks.streaks(
        spark.sql(GAMES, orders=table(spark, sf, "orders")),
        kind,
        span,
        player="o_custkey",
        order=["o_orderdate", "o_orderkey"],
        season="season",
        flags={"hit": F.col("hit"), "on_base": F.col("on_base")},
        home=F.col("at_home"),
        **more,
    )


@query(streak_sql("hit"))
def streaks_career(spark, sf):
    return run_streaks(spark, sf, "hittingStreakOverall", "career")


@query(streak_sql("hit"))
def streaks_hot_player(spark, sf):
    return run_streaks(spark, sf, "hittingStreakOverall", "career", limit=5)


@query(streak_sql("on_base", "o_custkey, season", "at_home"))
def streaks_home_by_season(spark, sf):
    return run_streaks(spark, sf, "onBaseHome", "season")


@query(streak_sql("hit", keep="is_current"))
def streaks_current(spark, sf):
    return run_streaks(spark, sf, "hittingStreakOverall", "currentStreak")


@query(streak_sql("on_base", "o_custkey, season", "season = 2000 AND NOT at_home", "is_current"))
def streaks_current_in_season(spark, sf):
    return run_streaks(spark, sf, "onBaseAway", "currentStreakInSeason", only_season=2000)


@query(streak_sql("on_base", keep="length >= 6"))
def streaks_notable(spark, sf):
    return run_streaks(spark, sf, "onBaseOverall", "notable", least=6)


@query(streak_sql("hit", "o_custkey, season", "season = 1998", "length >= 3"))
def streaks_notable_in_season(spark, sf):
    return run_streaks(spark, sf, "hittingStreakOverall", "notableInSeason", least=3, only_season=1998)


# --------------------------------------------------------------------------------------
# Entities and endpoints
# --------------------------------------------------------------------------------------


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')")
def entity_rows(spark, sf):
    return entities.entity_filter(
        table(spark, sf, "orders"), o_orderstatus="F", o_orderpriority=["1-URGENT", "5-LOW"], o_custkey=None
    )


@query("SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-04-01' AND TIMESTAMP '1997-06-30'")
def entity_dates(spark, sf):
    return entities.date_window(table(spark, sf, "orders"), "o_orderdate", start="1997-04-01", end="1997-06-30")


@query("""SELECT o.* FROM orders o JOIN (SELECT o_custkey, max(o_orderdate) AS d FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30'
    GROUP BY o_custkey) m ON o.o_custkey = m.o_custkey AND o.o_orderdate = m.d""")
def entity_as_of(spark, sf):
    return entities.as_of_date(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", "1998-06-30")


@query(
    """SELECT o_custkey, sit_code, count(*) AS n, sum(o_totalprice) AS total FROM (
    SELECT o_custkey, o_totalprice, unnest(list_filter([CASE WHEN o_orderstatus = 'F' THEN 'h' END, CASE WHEN o_orderstatus <> 'F' THEN 'a' END,
        CASE WHEN month(o_orderdate) = 7 THEN '7' END, CASE WHEN month(o_orderdate) <= 6 THEN 'h1' END], lambda c: c IS NOT NULL)) AS sit_code FROM orders)
    GROUP BY ALL""",
    "total",
)
def situation_splits(spark, sf):
    tests = {
        "h": F.col("o_orderstatus") == "F",
        "a": F.col("o_orderstatus") != "F",
        "7": F.month("o_orderdate") == 7,
        "h1": F.month("o_orderdate") <= 6,
    }
    sums = [F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")]
    return entities.situation_splits(table(spark, sf, "orders"), tests, ["o_custkey"], sums)


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00'")
def changed_entities(spark, sf):
    return entities.changed_since(table(spark, sf, "events"), "ts", "2024-01-20 12:00:00")


FEED_AT_SQL = """SELECT e.* FROM events e JOIN (SELECT user_id, max(ts) AS ts FROM events WHERE ts <= TIMESTAMP '2024-01-15 08:30:00'
    GROUP BY user_id) m ON e.user_id = m.user_id AND e.ts = m.ts"""


@query(FEED_AT_SQL)
def feed_at_time(spark, sf):
    return entities.feed_at(table(spark, sf, "events"), "user_id", "ts", "20240115_083000")


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-11 06:00:00'")
def feed_between_times(spark, sf):
    return entities.feed_between(table(spark, sf, "events"), "ts", "20240110_000000", "20240111_060000")


@query("SELECT DISTINCT user_id, strftime(ts, '%Y%m%d_%H%M%S') AS timecode FROM events")
def feed_timecodes(spark, sf):
    return entities.feed_timecodes(table(spark, sf, "events"), "user_id", "ts")


PROBE_SQL = """
    WITH probes AS (SELECT o_orderkey, o_custkey % 150 AS user_id,
        TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST((o_orderkey * 7919) % 2592000 AS BIGINT)) AS ts FROM orders)
    SELECT probes.user_id, probes.ts, o_orderkey, e.props AS body_at FROM probes
    ASOF LEFT JOIN events e ON probes.user_id = e.user_id AND probes.ts >= e.ts"""


def run_probes(spark, sf, **more) -> DataFrame:
    seconds = (F.col("o_orderkey") * 7919) % 2592000
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    probes = table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_custkey") % 150).alias("user_id"),
        (start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).alias("ts"),
    )
    feed = table(spark, sf, "events")
    return entities.feed_at_probes(feed, probes, "user_id", "ts", "props", "o_orderkey", **more)


@query(PROBE_SQL)
def feed_at_many_times(spark, sf):
    return run_probes(spark, sf)


@query(PROBE_SQL)
def feed_at_many_times_hot_game(spark, sf):
    return run_probes(spark, sf, limit=20)


@query("""SELECT event_id, unnest([0, 1])::BIGINT AS pos, json_extract(props, '$.k')::BIGINT AS k, event_type AS kind FROM events""")
def nested_payload_rows(spark, sf):
    body = F.format_string('{"plays":[%s,%s],"kind":"%s"}', "props", "props", "event_type")
    rows = table(spark, sf, "events").select("event_id", F.parse_json(body).alias("payload"))
    rows = rows.withColumn("kind", F.try_variant_get("payload", "$.kind", "string"))
    out = entities.nested_rows(rows, "payload", "$.plays", {"k": "k:bigint"}, ["event_id", "kind"])
    return out.select("event_id", "pos", "k", "kind")


@query("SELECT o_orderkey, o_custkey, c_name AS customer_c_name, c_acctbal AS customer_c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def hydrated_fields(spark, sf):
    people = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    rows = entities.hydrate(table(spark, sf, "orders"), people, "o_custkey", as_struct="customer")
    return entities.sparse_fields(rows, "o_orderkey,o_custkey,customer.c_name,customer.c_acctbal")


@query("""
    WITH c AS (SELECT CASE n_regionkey WHEN 0 THEN 1 WHEN 1 THEN 11 WHEN 2 THEN 12 WHEN 3 THEN 13 ELSE 17 END::BIGINT AS sport_id,
        c_custkey, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT s.sport_id, c_custkey, c_name FROM (VALUES (1), (11), (12), (13), (14), (16)) s(sport_id) LEFT JOIN c ON s.sport_id = c.sport_id""")
def merged_sports(spark, sf):
    region = F.col("n_regionkey")
    sport = F.lit(17)
    for key, sid in enumerate((1, 11, 12, 13)):
        sport = F.when(region == key, sid).otherwise(sport)
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), sport.alias("sport_id"))
    rows = table(spark, sf, "customer").join(nations, "c_nationkey")
    return entities.merge_sports(rows, codes.MERGE_SPORT_IDS, ["c_custkey", "c_name"])


@query("SELECT * FROM customer WHERE contains(lower(c_name), '00012') OR contains(lower(c_name), '#00000009')")
def people_by_name(spark, sf):
    return entities.name_search(table(spark, sf, "customer"), ["00012", "CUSTOMER#00000009"], "c_name")


ORDER_COLUMNS = {"teamId": "o_custkey", "gameTypes": "o_orderstatus", "gamePks": "o_orderkey"}


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P')
    AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""")
def endpoint_schedule(spark, sf):
    return endpoints.query_endpoint(
        "get_schedule",
        table(spark, sf, "orders"),
        Settings(columns=ORDER_COLUMNS, day="o_orderdate"),
        gameTypes=["F", "P"],
        startDate="1996-01-01",
        endDate="1996-12-31",
        fields="o_orderkey,o_totalprice",
    )


@query(f"""SELECT * FROM (SELECT *, rank() OVER (PARTITION BY category ORDER BY value DESC) AS rank FROM ({LONG_SQL}))
    WHERE rank <= 5 AND category IN ('best', 'games')""", "value")
def endpoint_stat_leaders(spark, sf):
    return endpoints.query_endpoint(
        "get_stat_leaders", long_stats(spark, sf), leaderCategories=["best", "games"], limit=5
    )


@query(FEED_AT_SQL)
def endpoint_gamefeed(spark, sf):
    return endpoints.query_endpoint(
        "get_gamefeed", table(spark, sf, "events"), Settings(game="user_id"), timecode="20240115_083000"
    )


@query("SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' ORDER BY ts, event_id LIMIT 40 OFFSET 20")
def endpoint_player_changes(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return endpoints.query_endpoint(
        "get_player_changes",
        rows,
        Settings(updated="ts", ties=("event_id",)),
        updatedSince="2024-01-05",
        limit=40,
        offset=20,
    )


@query("""SELECT o.o_custkey, o.o_orderkey, o.o_orderdate FROM orders o JOIN (SELECT o_custkey, max(o_orderdate) AS d FROM orders
    WHERE o_orderdate <= TIMESTAMP '1999-01-31' AND o_orderstatus = 'O' GROUP BY o_custkey) m
    ON o.o_custkey = m.o_custkey AND o.o_orderdate = m.d WHERE o.o_orderstatus = 'O'""")
def endpoint_standings(spark, sf):
    return endpoints.query_endpoint(
        "get_standings",
        table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"),
        Settings(columns={"standingsTypes": "o_orderstatus"}, key=("o_custkey",), day="o_orderdate"),
        standingsTypes="O",
        date="1999-01-31",
    ).drop("o_orderstatus")


SEASONS_SQL = "SELECT *, CAST(year(o_orderdate) AS INT) AS season FROM orders"


def season_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders")
    return rows.withColumn("season", F.year("o_orderdate"))


@query(f"SELECT o_orderkey, o_custkey, season FROM ({SEASONS_SQL}) WHERE season = 1997 AND o_orderstatus = 'O'")
def endpoint_standings_season(spark, sf):
    at = Settings(columns={"standingsTypes": "o_orderstatus"})
    rows = season_rows(spark, sf).select("o_orderkey", "o_custkey", "season", "o_orderstatus")
    return endpoints.query_endpoint("get_standings", rows, at, season=1997, standingsTypes="O").drop("o_orderstatus")


@query("""SELECT o_orderkey, o_custkey, c_name AS currentTeam_c_name, n AS games_n FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) ON k = o_custkey""")
def endpoint_hydrated(spark, sf):
    people = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    games = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    related = {"currentTeam": (people, ["o_custkey"]), "games": (games, ["o_custkey"])}
    return endpoints.query_endpoint(
        "get_people",
        table(spark, sf, "orders"),
        Settings(related=related),
        hydrate="currentTeam(team(x,y)),games",
        fields="o_orderkey,o_custkey,currentTeam.c_name,games.n",
    )


@query(f"""SELECT o_orderkey, o_totalprice FROM ({SEASONS_SQL}) WHERE season = 1996 AND o_orderstatus = 'F' OR season = 1996 AND o_orderstatus = 'O'
    ORDER BY o_totalprice, o_orderkey LIMIT 30 OFFSET 10""")
def endpoint_stats_page(spark, sf):
    at = Settings(columns={"sortStat": "o_totalprice", "group": "o_orderstatus"}, ties=("o_orderkey",))
    rows = endpoints.query_endpoint(
        "get_stats", season_rows(spark, sf), at, season=1996, group=["F", "O"], sortStat="price", order="asc", limit=30, offset=10
    )
    return rows.select("o_orderkey", "o_totalprice")


@query(f"SELECT * FROM ({streak_sql('hit', 'o_custkey, season', 'season = 1996')}) ORDER BY length DESC, o_custkey, season, started LIMIT 20")
def endpoint_streaks(spark, sf):
    games = spark.sql(GAMES, orders=table(spark, sf, "orders"))
    flags = {"hit": F.col("hit"), "on_base": F.col("on_base")}
    at = Settings(streak={"player": "o_custkey", "order": ["o_orderdate", "o_orderkey"], "flags": flags})
    return endpoints.query_endpoint(
        "get_streaks", games, at, streakType="hittingStreakOverall", streakSpan="season", season=1996, limit=20
    )


# --------------------------------------------------------------------------------------
# Hot, NULL and blank keys
# --------------------------------------------------------------------------------------

# Players who are missing (NULL) or blank hold many rows each.
HOLES = """SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_custkey AS {text}) END AS player,
    o_orderkey, o_orderdate, o_totalprice, o_totalprice > 200000 AS hit FROM {orders}"""
HOLES_SQL = HOLES.format(text="VARCHAR", orders="orders")


def holed(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(HOLES.replace("{text}", "STRING"), orders=table(spark, sf, "orders"))


@query(
    f"""SELECT *, avg(o_totalprice) OVER (PARTITION BY player ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS rolling
    FROM ({HOLES_SQL})""",
    "rolling",
)
def rolling_hot_missing_player(spark, sf):
    return derived.rolling_mean(holed(spark, sf), "player", ["o_orderdate", "o_orderkey"], "o_totalprice", 5, limit=40)


@query(f"""SELECT player, length, started, ended, is_current FROM (
    SELECT player, run, count(*) FILTER (WHERE hit) AS length, min(o_orderdate) FILTER (WHERE hit) AS started,
        max(o_orderdate) FILTER (WHERE hit) AS ended, run = max(last_run) AS is_current
    FROM (SELECT *, max(run) OVER (PARTITION BY player) AS last_run FROM (SELECT *,
        sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY player ORDER BY o_orderdate, o_orderkey) AS run FROM ({HOLES_SQL})))
    GROUP BY player, run) WHERE length > 0""")
def streaks_hot_missing_player(spark, sf):
    return streaks.islands(holed(spark, sf), ["player"], ["o_orderdate", "o_orderkey"], F.col("hit"), limit=40)


@query(
    f"""SELECT player, o_orderkey, o_totalprice, 100 * percent_rank() OVER (PARTITION BY player ORDER BY o_totalprice) AS o_totalprice_pct
    FROM ({HOLES_SQL})""",
    "o_totalprice_pct",
)
def percentiles_hot_missing_group(spark, sf):
    rows = holed(spark, sf).select("player", "o_orderkey", "o_totalprice")
    return ranking.percentiles(rows, ["player"], ["o_totalprice"], limit=40)


@query(f"""SELECT * FROM (SELECT *, rank() OVER (PARTITION BY category ORDER BY value DESC) AS rank FROM ({LONG_SQL}))
    WHERE rank <= 5000""", "value")
def stat_leaders_deep(spark, sf):
    return ranking.leaders(long_stats(spark, sf), ["category"], "value", 5000)


@query(f"SELECT *, rank() OVER (PARTITION BY category ORDER BY value) AS rank FROM ({LONG_SQL})", "value")
def stat_leaders_all(spark, sf):
    return ranking.leaders(long_stats(spark, sf), ["category"], "value", None, descending=False)


@query(f"SELECT o_custkey, round(total, 2) AS total FROM ({STATS_SQL}) ORDER BY total DESC, o_custkey OFFSET 50")
def stats_after_offset(spark, sf):
    rows = career_stats(spark, sf).select("o_custkey", F.round("total", 2).alias("total"))
    return ranking.page(rows, "total", ["o_custkey"], None, 50)


# --------------------------------------------------------------------------------------
# Files
# --------------------------------------------------------------------------------------


@query(
    with_pitches("""SELECT CAST(game_pk AS VARCHAR) AS game_pk, pitcher, CASE WHEN level = 'mlb' THEN NULL ELSE NULLIF(bb_type, '') END AS bb_type,
        NULL AS file FROM p UNION ALL SELECT NULL, NULL, NULL, 'html_body'""")
)
def csv_by_header(spark, sf):
    """Pulls with columns in two orders and an HTML page among them, read back by header."""
    path = shared_path(spark, "pulls")
    rows = pitches(spark, sf)
    files.write_rows(rows.where("level = 'mlb'").select("game_pk", "pitcher"), f"{path}/pull=a")
    files.write_rows(rows.where("level <> 'mlb'").select("pitcher", "bb_type", "game_pk"), f"{path}/pull=b")
    page = table(spark, sf, "pages").select("html").where("html LIKE '<!DOCTYPE%'").orderBy("page_id").limit(1)
    page.coalesce(1).write.text(f"{path}/pull=c")
    found, aside = files.read_csv_folder(spark, f"{path}/pull=*")
    rows = found.select("game_pk", "pitcher", "bb_type", F.lit(None).cast("string").alias("file"))
    none = F.lit(None).cast("string")
    lost = aside.select(none.alias("game_pk"), none.alias("pitcher"), none.alias("bb_type"), F.col("reason").alias("file"))
    return rows.unionByName(lost)


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS venue_id, event_type AS venue_name, NULL AS park_factor FROM events
    UNION ALL SELECT event_id, '7', 'second', CAST(event_id AS VARCHAR) FROM events""")
def park_factor_pages(spark, sf):
    """Arrays in pages as rows of a board."""
    first = F.concat(F.lit('{"venue_id": '), F.get_json_object("props", "$.k"), F.lit(', "venue_name": "'), "event_type", F.lit('"}'))
    second = F.concat(F.lit('{"venue_id": "7", "venue_name": "second", "park_factor": '), F.col("event_id").cast("string"), F.lit("}"))
    html = F.concat(F.lit("<html><script>var data = ["), first, F.lit(", "), second, F.lit("];</script></html>"))
    pages = table(spark, sf, "events").select("event_id", html.alias("html"))
    rows = leaderboard.page_rows(files.embedded_json(pages, "html"), board("statcast-park-factors"))
    return rows.select("event_id", "venue_id", "venue_name", "park_factor")


@query(
    with_pitches("""SELECT CAST(game_pk AS VARCHAR) AS game_pk, player_name, NULLIF(pitch_type, '') AS pitch_type,
        '"' || player_name || '", says ' || p_throws AS note FROM p""")
)
def csv_files(spark, sf):
    """Pitches written as CSV, quotes and commas included, and read back as text."""
    note = F.format_string('"%s", says %s', "player_name", "p_throws").alias("note")
    path = shared_path(spark, "csv")
    files.write_rows(pitches(spark, sf).select("game_pk", "player_name", "pitch_type", note), path)
    return files.read_csv(spark, path, ["game_pk", "player_name", "pitch_type", "note"])


@query("""SELECT page_id AS id, 'html_body' AS verdict FROM pages WHERE regexp_matches(lower(ltrim(html)), '^(<!doctype|<html)')
    UNION ALL SELECT doc_id, CASE WHEN regexp_matches(lower(ltrim(text)), '^(<!doctype|<html)') THEN 'html_body' ELSE 'csv' END FROM documents""")
def html_in_place_of_csv(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("body"))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"))
    good, bad = files.split_html(pages.unionByName(docs), "body")
    return good.select("id", F.lit("csv").alias("verdict")).unionByName(bad.select("id", F.col("reason").alias("verdict")))


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN 'missing_var' WHEN 'view' THEN 'bad_json' ELSE 'ok' END AS status,
    CASE WHEN event_type NOT IN ('error', 'view') THEN json_extract(props, '$.k')::BIGINT END AS k FROM events""")
def page_json(spark, sf):
    name = F.when(F.col("event_type") == "error", "other").otherwise("data")
    body = F.when(F.col("event_type") == "view", F.lit("['x']")).otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    html = F.concat(F.lit("<html><script>var "), name, F.lit(" = "), body, F.lit("; var z = [1];</script></html>"))
    pages = table(spark, sf, "events").select("event_id", html.alias("html"))
    out = files.embedded_json(pages, "html")
    first = F.try_variant_get("json", "$[0].k", "bigint").alias("k")
    return out.select("event_id", F.col("json_status").alias("status"), first)


@query("SELECT page_id, 'missing_var' AS status FROM pages")
def page_without_json(spark, sf):
    out = files.embedded_json(table(spark, sf, "pages"), "html", "t")
    return out.select("page_id", F.col("json_status").alias("status"))


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN 'not_object' WHEN 'view' THEN 'bad_json' WHEN 'click' THEN 'bad_json' ELSE 'ok' END AS status,
    CASE WHEN event_type NOT IN ('error', 'view', 'click') THEN json_extract(props, '$.k')::BIGINT END AS k FROM events""")
def payload_bodies(spark, sf):
    kind = F.col("event_type")
    body = (
        F.when(kind == "error", F.concat(F.lit("["), "props", F.lit("]")))
        .when(kind == "view", F.concat(F.lit("{"), "props"))
        .when(kind == "click", F.concat("props", F.lit(" trailing")))
        .otherwise(F.col("props"))
    )
    out = files.payload_objects(table(spark, sf, "events").select("event_id", body.alias("body")), "body")
    return out.select(
        "event_id", F.col("json_status").alias("status"), F.try_variant_get("json", "$.k", "bigint").alias("k")
    )


@query("SELECT " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in REGISTER_COLUMNS) + f" FROM ({REGISTER_SQL})")
def register_shards(spark, sf):
    """The register written as 16 shards and read back as one table."""
    path = shared_path(spark, "register")
    shard = F.lower(F.hex(F.col("row_order") % 16)).alias("shard")
    rows = players(spark, sf).select(*REGISTER_COLUMNS, shard)
    rows.write.options(**files.CSV_OPTIONS, emptyValue="").partitionBy("shard").csv(path)
    return files.read_register(spark, path, REGISTER_COLUMNS, "shard=*").select(*REGISTER_COLUMNS)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, NULL::VARCHAR AS segment FROM orders
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, c_mktsegment FROM customer""")
def ragged_rows(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    path = shared_path(spark, "ragged")
    files.write_rows([orders, people], path)
    return files.read_csv(spark, path, ["id", "status", "segment"])


# --------------------------------------------------------------------------------------
# Streams
# --------------------------------------------------------------------------------------

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed in four files, read one per batch. Files hold all times, so rows come late."""
    path = shared_path(spark, "landing")
    table(spark, sf, "events").repartition(4, "event_id").write.parquet(path)
    return feeds.landing_stream(spark, path, EVENT_SCHEMA, files=1)


@query("""SELECT e.event_id, e.ts, e.user_id, e.value FROM events e
    JOIN (SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id) m ON e.user_id = m.user_id AND e.ts = m.ts""")
def stream_of_changes(spark, sf):
    home = shared_path(spark, "changes")
    rows = event_stream(spark, sf).select("event_id", "ts", "user_id", "value")
    feeds.follow_changes(rows, ["user_id"], "ts", f"{home}/table", f"{home}/state", ["event_id"])
    return feeds.current_versions(spark, f"{home}/table", ["user_id"], "ts", ["event_id"])


@query("""SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, user_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts,
    arg_max(props, ts) AS last_body FROM events GROUP BY ALL""")
def stream_of_increments(spark, sf):
    home = shared_path(spark, "windows")
    feeds.follow_windows(
        event_stream(spark, sf), "user_id", "ts", "1 day", f"{home}/table", f"{home}/state", "props", ["event_id"]
    )
    return feeds.current_windows(spark, f"{home}/table", "user_id")


@query(
    with_pitches(f"""SELECT game_pk, pitcher, pitch_type, {num('release_speed')} AS release_speed, level, game_date FROM p
        WHERE game_date BETWEEN DATE '1998-05-01' AND DATE '1998-05-31' AND level = 'mlb'""")
)
def landed_pitches(spark, sf):
    """Pitches landed typed, by level and year, then searched there."""
    path = shared_path(spark, "pitches")
    rows = pitches(spark, sf).select("game_pk", "pitcher", "pitch_type", "release_speed", "level", "game_date")
    pitch_search.land_pitches(rows, path)
    found_rows = pitch_search.search_pitches(spark.read.parquet(path), "1998-05-01", "1998-05-31")
    return found_rows.select(*rows.columns)


from dugout.plans import history_queries  # noqa: E402, F401
