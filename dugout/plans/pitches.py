"""Pitch-shaped stand-in view over the order tables; one SQL text for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("lineitem", "orders", "customer", "supplier")

PITCHES_SQL = """
SELECT
  l.l_orderkey                                   AS game_pk,
  CAST(l.l_shipdate AS DATE)                     AS game_date,
  CASE WHEN l.l_linestatus = 'F' THEN 'mlb' ELSE 'milb' END AS level,
  CAST(l.l_suppkey AS STRING)                    AS pitcher,
  CAST(o.o_custkey AS STRING)                    AS batter,
  s.s_name                                       AS player_name,
  CASE WHEN l.l_suppkey % 3 = 0 THEN 'L' ELSE 'R' END AS p_throws,
  'T' || CAST(s.s_nationkey AS STRING)           AS home_team,
  'T' || CAST(c.c_nationkey AS STRING)           AS away_team,
  CASE WHEN l.l_linenumber % 2 = 1 THEN 'Top' WHEN l.l_linenumber = 6 THEN '' ELSE 'Bot' END AS inning_topbot,
  CASE l.l_returnflag || l.l_linestatus
    WHEN 'AF' THEN 'FF' WHEN 'AO' THEN 'SL' WHEN 'NF' THEN 'SI'
    WHEN 'NO' THEN 'CH' WHEN 'RF' THEN 'CU' ELSE '' END AS pitch_type,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'home_run' WHEN '2-HIGH' THEN 'single'
    WHEN '3-MEDIUM' THEN 'field_out' WHEN '4-NOT SPECIFIED' THEN 'strikeout' ELSE '' END AS events,
  CASE CAST(l.l_partkey % 4 AS INT) WHEN 0 THEN 'ground_ball' WHEN 1 THEN 'line_drive'
    WHEN 2 THEN 'fly_ball' ELSE 'popup' END      AS bb_type,
  CASE WHEN l.l_linenumber = 7 THEN '' WHEN l.l_quantity = 50 THEN 'abc'
    ELSE CAST(70 + l.l_quantity * 5e-1 AS STRING) END AS release_speed,
  CASE WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'O' THEN ''
    ELSE CAST(1800 + l.l_partkey % 900 AS STRING) END AS release_spin_rate,
  CASE WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'O' THEN ''
    ELSE CAST((l.l_partkey * 7) % 360 AS STRING) END AS spin_axis,
  CASE WHEN l.l_linenumber <= 3 THEN CAST(50 + l.l_quantity AS STRING) ELSE '' END AS launch_speed,
  CASE WHEN l.l_linenumber <= 3 THEN CAST(l.l_partkey % 90 - 30 AS STRING) ELSE '' END AS launch_angle,
  CASE WHEN l.l_linenumber <= 3 THEN CAST(l.l_partkey % 6 + 1 AS STRING) ELSE '' END AS qoc,
  CASE WHEN l.l_linenumber = 5 THEN '' ELSE CAST(55e-1 + l.l_quantity * 4e-2 AS STRING) END AS release_extension,
  CAST(l.l_linenumber - 4e0 AS STRING)           AS vx0,
  CAST(-(120 + l.l_quantity * 5e-1) AS STRING)   AS vy0,
  CAST(-5 - l.l_linenumber * 5e-1 AS STRING)     AS vz0,
  CAST(l.l_partkey % 20 - 1e1 AS STRING)         AS ax,
  CAST(CASE WHEN l.l_quantity = 1 THEN 0e0 WHEN l.l_quantity = 2 THEN 5e2 WHEN l.l_quantity = 4 THEN -3e3 ELSE 25 + l.l_quantity * 1e-1 END AS STRING) AS ay,
  CAST(-20 + l.l_linenumber * 1e0 AS STRING)     AS az,
  CAST(CASE WHEN l.l_quantity = 3 THEN 0e0 ELSE l.l_partkey % 300 + 1e0 END AS STRING) AS spinx,
  CAST(CASE WHEN l.l_quantity = 3 THEN 0e0 ELSE -22e2 + l.l_quantity END AS STRING) AS spiny,
  CAST(CASE WHEN l.l_quantity = 3 THEN 0e0 ELSE l.l_suppkey * 1e0 END AS STRING) AS spinz
FROM {lineitem} l
JOIN {orders}   o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
"""

ORACLE_PITCHES = PITCHES_SQL.format(**{t: t for t in TABLES})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed-pitch stand-in; the tables are bound as query arguments, not as views."""
    return spark.sql(PITCHES_SQL, **{t: table(spark, sf_dir, t) for t in TABLES})
