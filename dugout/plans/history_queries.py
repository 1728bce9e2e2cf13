"""Registered queries over histories: feed differences, indexes, logs, validity, spans of seasons and pulls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.operators import entities, feed_diffs, file_index, name_index, payload_schema, pitch_search, spans, streaks, validity
from dugout.plans.pitches import pitches, table
from dugout.plans.queries import FOUND, GAMES, event_stream, found, query, streak_sql, with_pitches
from dugout.session import shared_path
from dugout.streaming import change_log

# --------------------------------------------------------------------------------------
# Feed differences: a customer is a game, each order with its lines a snapshot
# --------------------------------------------------------------------------------------

SHOTS = """
    lines AS (SELECT l_orderkey, string_agg('{' || CASE WHEN l_returnflag <> 'N' THEN '"flag":"' || l_returnflag || '",' ELSE '' END
        || '"n":' || l_linenumber || ',"qty":' || CAST(floor(l_quantity) AS INT) || '}', ',' 
        ORDER BY l_linenumber, nullif(l_returnflag, 'N') NULLS FIRST, floor(l_quantity)) AS listed
      FROM lineitem GROUP BY 1),
    shots AS (SELECT o_custkey AS game, o_orderdate + to_seconds(o_orderkey % 86400) AS ts, '{"lines":[' || listed || '],"status":"'
        || o_orderstatus || '","total":' || CAST(floor(o_totalprice) AS BIGINT) || '}' AS body
      FROM orders JOIN lines ON o_orderkey = l_orderkey
      QUALIFY row_number() OVER (PARTITION BY o_custkey, ts ORDER BY o_orderkey DESC) = 1)"""


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    line = F.struct(F.col("l_linenumber").alias("at"), flag.alias("flag"), F.floor("l_quantity").alias("qty"))
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    listed = F.transform("lines", lambda x: F.struct(x["flag"].alias("flag"), x["at"].alias("n"), x["qty"].alias("qty")))
    body = F.struct(listed.alias("lines"), F.col("o_orderstatus").alias("status"), F.floor("o_totalprice").alias("total"))
    seconds = (F.col("o_orderkey") % 86400).cast("decimal(18,6)")
    return (
        table(spark, sf, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.col("o_custkey").alias("game"),
            (F.col("o_orderdate") + F.make_dt_interval(secs=seconds)).alias("ts"),
            F.col("o_orderkey").alias("version"),
            F.to_json(body).alias("body"),
        )
    )


@query(f"""
    WITH {SHOTS},
    placed AS (SELECT *, lead(ts) OVER (PARTITION BY game ORDER BY ts) AS next FROM shots),
    leaves AS (SELECT game, ts, next, replace(replace(replace(substr(fullkey, 2), '[', '/'), ']', ''), '.', '/') AS path, atom::VARCHAR AS value
      FROM placed, json_tree(body::JSON) WHERE type NOT IN ('OBJECT', 'ARRAY')),
    old AS (SELECT game, next AS ts, path, value AS old FROM leaves WHERE next IS NOT NULL)
    SELECT game, ts, path, value, old, CASE WHEN old IS NULL THEN 'add' WHEN value IS NULL THEN 'remove' ELSE 'replace' END AS op
    FROM leaves FULL JOIN old USING (game, ts, path) WHERE value IS DISTINCT FROM old""")
def feed_diff_ops(spark, sf):
    """What changed from each snapshot of a game to the next."""
    return feed_diffs.feed_diffs(snapshots(spark, sf), "game", "ts", "body", ["version"]).drop("steps")


@query(f"WITH {SHOTS} SELECT game, arg_max(body, ts) AS body FROM shots WHERE ts <= TIMESTAMP '1998-06-01 12:00:00' GROUP BY 1")
def feed_replayed(spark, sf):
    """Bodies in force at a time, from the operations alone."""
    diffs = feed_diffs.feed_diffs(snapshots(spark, sf), "game", "ts", "body", ["version"])
    return feed_diffs.feed_replayed(diffs, "game", "ts", "19980601_120000")


# --------------------------------------------------------------------------------------
# Indexes: files by player, names by fragments
# --------------------------------------------------------------------------------------


def landed(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Landed pitches and their file index, in two lots, so that the index is brought up to date once."""
    path, index = shared_path(spark, "pitches"), shared_path(spark, "pitch-index")
    rows = pitches(spark, sf).select(*FOUND.split(", "))
    for lot in (F.col("game_pk") % 2 == 0, F.col("game_pk") % 2 == 1):
        pitch_search.land_pitches(rows.where(lot), path)
        file_index.update_index(spark, path, index)
    return path, index


@query(
    with_pitches(f"""SELECT {FOUND} FROM p WHERE game_date BETWEEN DATE '1993-01-01' AND DATE '2003-12-31'
        AND level = 'milb' AND batter = '25'""")
)
def search_batter_indexed(spark, sf):
    """One batter over many seasons, opening only the files that may hold them."""
    path, index = landed(spark, sf)
    return found(file_index.search_indexed(spark, path, index, "1993-01-01", "2003-12-31", "batter", 25, "milb"))


@query(
    with_pitches(f"""SELECT {FOUND} FROM p WHERE game_date BETWEEN DATE '1995-01-01' AND DATE '1999-12-31'
        AND level = 'mlb' AND pitcher IN ('7', '9') AND batter IN ('25', '31', '100')""")
)
def search_matchups_indexed(spark, sf):
    path, index = landed(spark, sf)
    both = {"pitchers_lookup[]": "7|9|", "batters_lookup[]": "25|31|100|"}
    return found(file_index.search_indexed(spark, path, index, "1995-01-01", "1999-12-31", **both))


@query("""
    WITH asked AS (SELECT DISTINCT substr(c_name, CAST(6 + c_custkey % 10 AS INT), CAST(1 + c_custkey % 7 AS INT)) AS fragment FROM customer)
    SELECT fragment, c_custkey AS key, lower(c_name) AS name FROM customer JOIN asked ON contains(lower(c_name), lower(fragment))""")
def names_by_fragments(spark, sf):
    """Thousands of name fragments against all names, by their rarest short substrings."""
    people = table(spark, sf, "customer")
    start, size = (6 + F.col("c_custkey") % 10).cast("int"), (1 + F.col("c_custkey") % 7).cast("int")
    asked = people.select(F.substring("c_name", start, size).alias("fragment"))
    path = shared_path(spark, "postings")
    name_index.name_postings(people, "c_name", "c_custkey").write.parquet(path)
    return name_index.names_with(spark.read.parquet(path), asked, "fragment")


# --------------------------------------------------------------------------------------
# Compacted change log
# --------------------------------------------------------------------------------------


@query("""SELECT e.event_id, e.ts, e.user_id, e.value FROM events e
    JOIN (SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id) m ON e.user_id = m.user_id AND e.ts = m.ts""")
def changes_after_compaction(spark, sf):
    """The latest event of each user from a log that merged its batches; files hold late rows, the last batch comes twice."""
    home = shared_path(spark, "change-log")
    rows = event_stream(spark, sf).select("event_id", "ts", "user_id", "value")
    log = change_log.versions_log(spark, f"{home}/log", ["user_id"], "ts", ["event_id"], fan=2)
    change_log.follow(rows, log, f"{home}/state")
    again = table(spark, sf, "events").select("event_id", "ts", "user_id", "value").where(F.col("event_id") % 4 == 3)
    log.add(again, 3)
    return log.read()


@query("""SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, user_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events GROUP BY ALL""")
def increments_after_compaction(spark, sf):
    """Counts per user and day from a merged log; a batch that comes again after its merge is not counted twice."""
    home = shared_path(spark, "window-log")
    log = change_log.windows_log(spark, f"{home}/log", "user_id", fan=2)

    def parts(batch: DataFrame) -> DataFrame:
        return change_log.window_parts(batch, "user_id", "ts", "1 day")

    change_log.follow(event_stream(spark, sf), log, f"{home}/state", parts)
    log.add(parts(table(spark, sf, "events")), 0)
    return log.read()


# --------------------------------------------------------------------------------------
# Affiliates, states at many dates, streaks by parts, spans of seasons, coverage of pulls
# --------------------------------------------------------------------------------------


@query("""
    WITH RECURSIVE links AS (SELECT c_custkey AS team, CASE WHEN c_custkey = 0 THEN 1 ELSE c_custkey // 5 END AS parent FROM customer),
    chain(team, ancestor, depth, trail) AS (SELECT team, parent, 1, [team, parent] FROM links WHERE parent <> team
      UNION ALL SELECT c.team, l.parent, c.depth + 1, list_append(c.trail, l.parent) FROM chain c JOIN links l ON c.ancestor = l.team
        WHERE NOT list_contains(c.trail, l.parent))
    SELECT team, ancestor, CAST(min(depth) AS INT) AS depth FROM chain GROUP BY 1, 2""")
def affiliates_tree(spark, sf):
    """All clubs above each team; teams 0 and 1 are each other's parents."""
    parent = F.when(F.col("c_custkey") == 0, 1).otherwise(F.floor(F.col("c_custkey") / 5)).cast("long")
    teams = table(spark, sf, "customer").select("c_custkey", parent.alias("parent"))
    return entities.affiliate_tree(teams, "c_custkey", "parent")


@query("""
    WITH changes AS (SELECT o_custkey AS player, o_orderpriority AS team, CAST(o_orderdate AS DATE) AS day FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1),
    held AS (SELECT *, lead(day) OVER (PARTITION BY player ORDER BY day) AS until FROM changes),
    asked AS (SELECT DISTINCT o_orderpriority AS team, CAST(date_trunc('month', o_orderdate) AS DATE) AS asked FROM orders)
    SELECT a.team, a.asked, h.player, h.day FROM asked a JOIN held h ON h.team = a.team AND h.day <= a.asked AND (h.until IS NULL OR a.asked < h.until)""")
def rosters_at_many_dates(spark, sf):
    """Who belongs to each team on the first of every month; an order moves its customer to a team."""
    orders = table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    changes = orders.select(F.col("o_custkey").alias("player"), F.col("o_orderpriority").alias("team"), day.alias("day"), "o_orderkey")
    held = validity.intervals(changes, ["player"], "day", ["o_orderkey"])
    asked = orders.select(F.col("o_orderpriority").alias("team"), F.trunc(day, "month").alias("asked"))
    return validity.at_dates(held, asked, ["team"], "asked").select("team", "asked", "player", "day")


def game_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(GAMES, orders=table(spark, sf, "orders"))


@query(streak_sql("hit"))
def streaks_by_summaries(spark, sf):
    """Career streaks joined from summaries of quarters."""
    quarter = F.year("o_orderdate") * 4 + F.quarter("o_orderdate")
    parts = streaks.streak_summary(game_rows(spark, sf), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("hit"), quarter)
    return streaks.join_summaries(parts, ["o_custkey"])


@query(streak_sql("hit"))
def streaks_after_increment(spark, sf):
    """Career streaks after the games of the last years came in: summaries of the old games are read, not the games."""
    path = shared_path(spark, "streak-parts")
    games, order = game_rows(spark, sf), ["o_orderdate", "o_orderkey"]
    for new in ("season < 1998", "season >= 1998"):
        rows = games.where(new)
        streaks.streak_summary(rows, ["o_custkey"], order, F.col("hit"), F.col("season")).write.mode("append").parquet(path)
    return streaks.join_summaries(spark.read.parquet(path), ["o_custkey"])


@query(
    """
    WITH asked AS (SELECT DISTINCT CAST(1993 + o_custkey % 9 AS INT) AS first, CAST(1994 + o_custkey % 7 + o_orderkey % 3 AS INT) AS last FROM orders)
    SELECT o_custkey, first, last, CAST(count(*) AS DOUBLE) AS games, sum(o_totalprice) AS price
    FROM asked JOIN orders ON year(o_orderdate) BETWEEN first AND last WHERE first <= last GROUP BY 1, 2, 3""",
    "games price",
)
def board_many_spans(spark, sf):
    """Sums of every player over many spans of seasons, two look-ups each."""
    orders = table(spark, sf, "orders")
    games = orders.select("o_custkey", F.year("o_orderdate").alias("season"), F.lit(1).alias("games"), F.col("o_totalprice").alias("price"))
    asked = orders.select(
        (1993 + F.col("o_custkey") % 9).alias("first"), (1994 + F.col("o_custkey") % 7 + F.col("o_orderkey") % 3).alias("last")
    )
    totals = spans.season_sums(games, ["o_custkey"], "season", ["games", "price"])
    return spans.over_spans(totals, asked, ["o_custkey"], "season", ["games", "price"], "first", "last")


PULLED = """
    pulls AS (SELECT o_custkey % 150 AS level, CAST(o_orderdate AS DATE) AS first, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INT) AS last FROM orders),
    wanted AS (SELECT level, min(first) AS low, max(last) AS high FROM pulls GROUP BY 1),
    days AS (SELECT DISTINCT level, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS day FROM pulls),
    every AS (SELECT level, CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS day FROM wanted),
    missing AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY level ORDER BY day) AS INT) AS run FROM (SELECT * FROM every EXCEPT SELECT * FROM days))"""


def pulled(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    last = F.date_add(day, (F.col("o_orderkey") % 9).cast("int"))
    return table(spark, sf, "orders").select((F.col("o_custkey") % 150).alias("level"), day.alias("first"), last.alias("last"))


@query(f"WITH {PULLED} SELECT level, min(day) AS first, max(day) AS last FROM missing GROUP BY level, run")
def pull_gaps(spark, sf):
    """Spans of days that no pull of a level covers, between its first and last."""
    pulls = pulled(spark, sf)
    wanted = pulls.groupBy("level").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return spans.gaps(spans.covered(pulls, ["level"], "first", "last"), wanted, ["level"], "first", "last")


@query(f"""WITH {PULLED}, gap AS (SELECT level, min(day) AS first, max(day) AS last FROM missing GROUP BY level, run),
    cut AS (SELECT level, CAST(unnest(generate_series(first, last, INTERVAL 6 DAY)) AS DATE) AS first, last FROM gap)
    SELECT level, first, least(first + 5, last) AS last FROM cut""")
def pull_plan(spark, sf):
    """The same gaps as pulls of at most six days."""
    return spans.pull_plan(pull_gaps(spark, sf), ["level"], "first", "last")


# --------------------------------------------------------------------------------------
# Payloads by their own types
# --------------------------------------------------------------------------------------


def mixed_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots whose total is a text in later years, and whose status is missing for some."""
    rows = snapshots(spark, sf)
    text = F.regexp_replace("body", r'"total":(\d+)', '"total":"$1"')
    later = F.when(F.col("ts") >= F.lit("1998-01-01").cast("timestamp_ntz"), text).otherwise(F.col("body"))
    return rows.withColumn("body", F.when(F.col("version") % 10 == 0, F.regexp_replace(later, '"status":"."', '"status":null')).otherwise(later))


MIXED = SHOTS.replace("QUALIFY row_number() OVER (PARTITION BY o_custkey, ts ORDER BY o_orderkey DESC) = 1", "") + r""",
    later AS (SELECT ts, o_orderkey, CASE WHEN ts >= TIMESTAMP '1998-01-01' THEN regexp_replace(body, '"total":(\d+)', '"total":"\1"') ELSE body END AS body
      FROM shots),
    mixed AS (SELECT ts, CASE WHEN o_orderkey % 10 = 0 THEN regexp_replace(body, '"status":"."', '"status":null') ELSE body END AS body FROM later),
    leaves AS (SELECT ts, regexp_replace(replace(replace(substr(fullkey, 2), '[', '.'), ']', ''), '\.\d+', '/*', 'g') AS path, type
      FROM mixed, json_tree(body::JSON) WHERE type NOT IN ('OBJECT', 'ARRAY')),
    inventory AS (SELECT replace(path, '.', '/') AS path, CASE type WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'VOID' ELSE 'BIGINT' END AS type,
        count(*) AS n, min(ts) AS first_seen, max(ts) AS last_seen FROM leaves GROUP BY 1, 2)"""
MIXED = MIXED.replace("AS ts, '{\"lines\"", "AS ts, o_orderkey, '{\"lines\"")


@query(f"WITH {MIXED} SELECT * FROM inventory")
def payload_paths(spark, sf):
    """Every path of the payloads with its types, and when each was seen."""
    return payload_schema.path_inventory(mixed_payloads(spark, sf), "body", "ts")


@query(f"""WITH {MIXED} SELECT path, array_to_string(list(type ORDER BY type), ',') AS types, CAST(sum(n) AS BIGINT) AS n, max(first_seen) AS changed
    FROM inventory WHERE type <> 'VOID' GROUP BY 1 HAVING count(*) > 1""")
def payload_schema_drift(spark, sf):
    """Paths that changed their type."""
    found = payload_schema.drifting_paths(payload_schema.path_inventory(mixed_payloads(spark, sf), "body", "ts"))
    return found.withColumn("types", F.array_join("types", ","))


@query("""
    SELECT o_orderkey AS version, o_orderstatus AS status, CAST(floor(o_totalprice) AS BIGINT) AS total, count(*) AS n_lines,
      CAST(sum(floor(l_quantity)) AS BIGINT) AS quantity, count(nullif(l_returnflag, 'N')) AS n_flags
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""")
def payload_typed(spark, sf):
    """Payloads as a table by the type of all of them, no field named."""
    typed = payload_schema.typed_payloads(snapshots(spark, sf), "body", ["version"])
    each = F.transform("lines", lambda x: x["qty"])
    flags = F.filter("lines", lambda x: x["flag"].isNotNull())
    total = F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)
    return typed.select(
        "version", "status", "total", F.size("lines").cast("long").alias("n_lines"), total.alias("quantity"), F.size(flags).cast("long").alias("n_flags")
    )
