"""Feed diffs, file and name indexes, the compacted log: edge cases and what they read."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from dugout.operators import (
    entities,
    feed_diffs,
    file_index,
    leaderboard,
    name_index,
    payload_schema,
    pitch_search,
    ranking,
    spans,
    streaks,
    validity,
)
from dugout.plans.endpoints import Settings, query_endpoint
from dugout.session import shared_path
from dugout.streaming import change_log, feeds


def at(second):
    return dt.datetime(2024, 5, 1, 12, 0, second)


# ------------------------------------------------------------------ feed diffs


def leaves_of(value, path=""):
    if isinstance(value, dict) and value:
        return {k: v for n, x in value.items() for k, v in leaves_of(x, f"{path}/{n.replace('~', '~0').replace('/', '~1')}").items()}
    if isinstance(value, list) and value:
        return {k: v for n, x in enumerate(value) for k, v in leaves_of(x, f"{path}/{n}").items()}
    return {path: json.dumps(value, separators=(",", ":"), sort_keys=True, ensure_ascii=False)}


def random_body(rng, depth=3):
    kind = rng.choice(["object", "array", "leaf"]) if depth else "leaf"
    if kind == "object":
        return {n: random_body(rng, depth - 1) for n in rng.sample(["a", "b/c", "~d", 'q"', "é", "", "x y"], rng.randint(0, 3))}
    if kind == "array":
        return [random_body(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([None, True, False, 0, -7, "text", "", 'a "quote" \\ and {bracket]', "ü"])


def test_diffs_and_replay_of_random_bodies(spark):
    rng = random.Random(11)
    rows, expected = [], []
    for game in [1, 2, None]:
        shots = sorted(rng.sample(range(50), 6))
        before = {}
        for second in shots:
            body = random_body(rng)
            now = leaves_of(body)
            rows.append((game, at(second), json.dumps(body)))
            for p in sorted(before.keys() | now.keys()):
                if p not in before:
                    expected.append((game, at(second), "add", p, now[p], None))
                elif p not in now:
                    expected.append((game, at(second), "remove", p, None, before[p]))
                elif now[p] != before[p]:
                    expected.append((game, at(second), "replace", p, now[p], before[p]))
            before = now
    feed = spark.createDataFrame([*rows, (3, at(1), None), (3, None, "{}"), (4, at(1), "not json")], "game long, ts timestamp_ntz, body string")
    diffs = feed_diffs.feed_diffs(feed, "game", "ts", "body")
    got = [tuple(r) for r in diffs.drop("steps").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    for second in (0, 20, 49):
        force = {}
        for game, ts, body in sorted(rows, key=lambda r: r[1]):
            if ts <= at(second):
                force[game] = json.loads(body)
        bodies = feed_diffs.feed_replayed(diffs, "game", "ts", f"20240501_1200{second:02d}").collect()
        assert {r["game"]: json.loads(r["body"]) for r in bodies} == force


def test_diffs_of_hot_games_and_ties(spark):
    rows = [(1, at(n), n % 3, json.dumps({"n": n // 4, "list": list(range(n % 5))})) for n in range(30)]
    rows += [(1, at(5), 9, '{"n":99}')]
    feed = spark.createDataFrame(rows, "game long, ts timestamp_ntz, version int, body string").repartition(4)
    plain = feed_diffs.feed_diffs(feed, "game", "ts", "body", ["version"]).collect()
    hot = feed_diffs.feed_diffs(feed, "game", "ts", "body", ["version"], limit=4).collect()
    assert sorted(map(str, plain)) == sorted(map(str, hot))
    assert {r["value"] for r in plain if r["path"] == "/n" and r["ts"] == at(5)} == {"99"}


def test_leaves_are_compared_in_the_row_and_operations_pass_once(spark):
    feed = spark.createDataFrame([(1, at(n), json.dumps({"n": [n, None, {}]})) for n in range(3)], "game long, ts timestamp_ntz, body string")
    diffs = feed_diffs.feed_diffs(feed, "game", "ts", "body")
    bodies = feed_diffs.feed_replayed(diffs, "game", "ts")
    assert json.loads(bodies.first()["body"]) == {"n": [2, None, {}]}
    # Neither leaves nor operations are joined: only bodies by (game, time).
    plan = diffs._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "path" not in "".join(line for line in plan.splitlines() if "Join" in line)
    assert "Join" not in bodies._jdf.queryExecution().optimizedPlan().toString()


def test_diff_endpoint(spark):
    feed = spark.createDataFrame([(7, at(n), json.dumps({"inning": n // 2, "outs": n})) for n in range(6)], "game_pk long, ts timestamp_ntz, body string")
    ops = query_endpoint("get_gamefeed_diffpatch", feed, Settings(), game_pk=7, startTimecode="20240501_120001", endTimecode="20240501_120003")
    got = {(r["ts"].second, r["op"], r["path"], r["value"], r["old"]) for r in ops.collect()}
    assert got == {(2, "replace", "/inning", "1", "0"), (2, "replace", "/outs", "2", "1"), (3, "replace", "/outs", "3", "2")}
    with pytest.raises(ValueError, match="bodies"):
        query_endpoint("get_gamefeed_diffpatch", feed.drop("body"), Settings(), game_pk=7)


def test_bodies_stay_out_of_aggregates(spark):
    feed = spark.createDataFrame([(1, at(1), "{}")], "game long, ts timestamp_ntz, body string")
    probes = spark.createDataFrame([(1, at(2), 5)], "game long, ts timestamp_ntz, probe long")
    for plan in (
        entities.feed_at(feed, "game", "ts"),
        entities.feed_at_probes(feed, probes, "game", "ts", "body", "probe"),
    ):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in text and "first(body" not in text


def test_snapshots_of_one_time_go_by_ties(spark):
    rows = [(1, at(1), 1, "old"), (1, at(1), 3, "new"), (1, at(1), 2, "mid"), (None, at(1), 1, "none")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        feed = spark.createDataFrame(rows, "game long, ts timestamp_ntz, version int, body string").repartition(3)
        got = {r["game"]: r["body"] for r in entities.feed_at(feed, "game", "ts", ties=["version"]).collect()}
        assert got == {1: "new", None: "none"}


# ------------------------------------------------------------------ file index


def test_index_opens_few_files(spark):
    path, index = shared_path(spark, "pitches"), shared_path(spark, "index")
    days = [dt.date(2023, 4, 1) + dt.timedelta(days=n) for n in range(40)]
    rows = [(n, day, "mlb" if k % 2 else "milb", str(n), str(1000 + (n * 7 + k) % 40)) for n, day in enumerate(days) for k in range(20)]
    table = spark.createDataFrame(rows, "game_pk long, game_date date, level string, pitcher string, batter string")
    for n in range(6):
        pitch_search.land_pitches(table.where(f"game_pk between {5 * n} and {5 * n + 4}"), path)
    first = file_index.update_index(spark, path, index)
    assert first == len(file_index.landed_files(spark, path)) and file_index.update_index(spark, path, index) == 0
    found = file_index.search_indexed(spark, path, index, days[0], days[-1], "pitcher", 12)
    assert first == 12 and len(found.inputFiles()) == 1
    assert found.count() == 10 and {r["pitcher"] for r in found.collect()} == {"12"}
    none = file_index.search_indexed(spark, path, index, days[0], days[-1], "pitcher", 99999)
    assert none.count() == 0 and none.columns == found.columns
    # Files that the index does not know are read.
    pitch_search.land_pitches(table.where("game_date >= date'2023-05-01'"), path)
    late = file_index.search_indexed(spark, path, index, days[0], days[-1], "batter", 1020, "milb")
    assert late.count() == table.where("batter = '1020' and level = 'milb'").count()
    assert file_index.update_index(spark, path, index) > 0
    again = file_index.search_indexed(spark, path, index, days[0], days[-1], "batter", 1020, "milb")
    assert sorted(map(str, again.collect())) == sorted(map(str, late.collect()))


def test_search_without_an_index(spark):
    path = shared_path(spark, "pitches")
    rows = [(1, dt.date(2023, 4, 1), "mlb", None, "5"), (2, dt.date(2023, 4, 2), "mlb", "4", "5")]
    pitch_search.land_pitches(spark.createDataFrame(rows, "game_pk long, game_date date, level string, pitcher string, batter string"), path)
    index = shared_path(spark, "index")
    assert file_index.search_indexed(spark, path, index, "2023-01-01", "2023-12-31", "pitcher", 4).count() == 1
    file_index.update_index(spark, path, index)
    assert file_index.search_indexed(spark, path, index, "2023-01-01", "2023-12-31").count() == 2


# ------------------------------------------------------------------ name index


def test_fragments_against_comparison_of_all(spark):
    names = [(1, "Mike Trout"), (2, "José Ramírez"), (3, "Al"), (4, ""), (5, None), (6, "Mike Trout"), (7, "ÅÄÖ o"), (8, "A")]
    asked = ["trout", "TROUT", "é r", "l", "A", "", None, "zzz", "mike trout jr", " ", "ike", "ö o", "trout"]
    people = spark.createDataFrame(names, "id long, name string")
    fragments = spark.createDataFrame([(a,) for a in asked], "part string")
    got = name_index.names_with(name_index.name_postings(people, "name", "id"), fragments, "part")
    expected = {(a, i) for a in set(asked) if a for i, n in names if n and a.lower() in n.lower()}
    rows = [(r["fragment"], r["key"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


# ------------------------------------------------------------------ change log


def test_log_opens_few_folders_and_survives_replays(spark):
    log = change_log.versions_log(spark, shared_path(spark, "log"), ["k"], "ts", ["v"], fan=3)
    with pytest.raises(ValueError, match="no batch"):
        log.read()
    schema = "k long, ts timestamp_ntz, v long"
    rng, best = random.Random(2), {}
    batches = [[(rng.choice([1, 2, 3, None]), at(rng.randint(0, 59)), 100 * n + i) for i in range(4)] for n in range(11)]
    for n, rows in enumerate(batches):
        log.add(spark.createDataFrame(rows, schema).coalesce(1), n)
        for k, ts, v in rows:
            best[k] = max(best.get(k, (at(0), -1)), (ts, v))
        levels = [f.level for f in log.folders()]
        assert all(levels.count(level) < 3 for level in levels)
        assert sorted(b for f in log.folders() for b in f.batches) == list(range(n + 1))
    # A merged batch that comes again changes nothing; one with a folder of its own replaces it.
    log.add(spark.createDataFrame([(1, at(59), 10**9)], schema), 0)
    log.add(spark.createDataFrame(batches[-1], schema), 10)
    assert {r["k"]: (r["ts"], r["v"]) for r in log.read().collect()} == best
    assert log.vacuum() > 0 and {r["k"]: (r["ts"], r["v"]) for r in log.read().collect()} == best


def test_log_counts_each_batch_once(spark):
    log = change_log.windows_log(spark, shared_path(spark, "log"), "g", fan=2)
    rows = spark.createDataFrame([(1, at(n)) for n in range(10)], "g long, ts timestamp_ntz")
    for number in (0, 1, 1, 0, 2, 3, 2):
        log.add(change_log.window_parts(rows, "g", "ts", "1 day"), number)
    got = log.read().collect()
    assert [(r["n"], r["first_ts"], r["last_ts"]) for r in got] == [(40, at(0), at(9))]


# ------------------------------------------------------------------ parameters that apply or are refused


def test_board_parameters_apply_or_are_refused(spark):
    slug = "bat-tracking/swing-timing-miss-distance"
    rows = [(1, "a", 2023, 10, 1.0), (1, "a", 2024, 30, 2.0), (2, "b", 2023, 5, 3.0), (2, "b", 2024, 50, 4.0)]
    board = spark.createDataFrame(rows, "id long, name string, year int, swings long, miss double")
    more = {"weight": "swings", "means": ["miss"]}
    assert leaderboard.leaderboard(board, slug, [2023, 2024], minSplit=10, **more).count() == 3
    one = leaderboard.leaderboard(board, slug, [2023, 2024], splitYear="false", minSplit=10, min_n=40, **more).collect()
    assert {(r["id"], r["swings"], r["miss"]) for r in one} == {(1, 40, 1.75), (2, 50, 4.0)}
    with pytest.raises(ValueError, match="count column"):
        leaderboard.leaderboard(board, slug, [2023], minSplit=10)
    with pytest.raises(ValueError, match="does not take"):
        leaderboard.leaderboard(board, "custom", 2023, minSplit=10)
    picked = leaderboard.leaderboard(board, "custom", 2023, custom_col="miss, swings")
    assert picked.columns == ["id", "name", "year", "miss", "swings"]
    with pytest.raises(ValueError, match="no columns"):
        leaderboard.leaderboard(board, "custom", 2023, custom_col="miss,other")
    pairs = spark.createDataFrame([(1, 2024, 2023, 0.1), (1, 2024, 2022, 0.2)], "player_id long, year int, prior_year int, delta double")
    got = leaderboard.leaderboard(pairs, "statcast-year-to-year", year_pair="2022-2024").collect()
    assert [r["delta"] for r in got] == [0.2]
    with pytest.raises(ValueError, match="YYYY-YYYY"):
        leaderboard.leaderboard(pairs, "statcast-year-to-year", year_pair="2022")
    with pytest.raises(ValueError, match="neither"):
        leaderboard.leaderboard(board, "statcast-year-to-year", year_pair="2022-2024")


def test_endpoint_parameters_apply_or_are_refused(spark):
    people = spark.createDataFrame([(1, "Bo", 2024), (2, "Al", 2024), (3, "Cy", 2023)], "id long, full_name string, season int")
    for order, ids in (("asc", [2, 1]), ("desc", [1, 2]), ("id", [1, 2]), (None, {1, 2})):
        got = [r["id"] for r in query_endpoint("get_free_agents", people, season=2024, order=order).collect()]
        assert got == ids or set(got) == ids
    with pytest.raises(ValueError, match="order"):
        query_endpoint("get_free_agents", people, season=2024, order="salary")
    for name, param in (("get_people", "appContext"), ("get_schedule", "useLatestGames"), ("get_seasons", "withGameTypeDates")):
        with pytest.raises(ValueError, match=param):
            query_endpoint(name, people, **{param: "x"})
    table = spark.createDataFrame([(1, dt.date(2024, 5, 1)), (2, dt.date(2024, 5, 1)), (None, dt.date(2024, 4, 1))], "team_id long, date date")
    with pytest.raises(ValueError, match="state"):
        query_endpoint("get_standings", table, date="2024-06-01")
    assert query_endpoint("get_standings", table, Settings(key=("team_id",)), date="2024-06-01").count() == 3
    with pytest.raises(ValueError, match="ties|tie keys"):
        ranking.page(people, "id", [], limit=1)


def test_leaf_rows_bounds_depth(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":[1,{"c":2}]},"s":"{[not nested"}')], "id long, body string")
    assert feed_diffs.body_depth(df, "body") == 4
    assert {r["path"]: r["value"] for r in feed_diffs.leaf_rows(df, ["id"], "body", 1).collect()} == {"/a": '{"b":[1,{"c":2}]}', "/s": '"{[not nested"'}
    variant = df.select("id", F.parse_json("body").alias("body"))
    assert feed_diffs.leaf_rows(variant, ["id"], "body").count() == 3


# ------------------------------------------------------------------ trees, validity, streak parts, spans


def test_affiliates_with_circles_and_two_parents(spark):
    links = [(1, None), (2, 1), (3, 2), (4, 3), (4, 1), (5, 6), (6, 5), (7, 7), (8, 99), (None, 1)]
    teams = spark.createDataFrame(links, "team_id long, parent_org_id long")
    got = {tuple(r) for r in entities.affiliate_tree(teams, "team_id", "parent_org_id").collect()}
    assert got == {(2, 1, 1), (3, 2, 1), (3, 1, 2), (4, 3, 1), (4, 2, 2), (4, 1, 1), (5, 6, 1), (6, 5, 1), (8, 99, 1)}
    season = teams.withColumn("season", F.lit(2024))
    below = query_endpoint("get_team_affiliates", season, season=2024, teamIds="2,5")
    assert {r["team_id"] for r in below.collect()} == {2, 3, 4, 5, 6}
    with pytest.raises(ValueError, match="parent"):
        query_endpoint("get_team_affiliates", season.drop("parent_org_id"), teamIds=1)


def test_affiliates_beyond_the_limits_of_a_recursive_query(spark):
    teams = spark.createDataFrame([(n, n - 1) for n in range(1, 151)], "team long, parent long")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "1000")
    try:
        got = {(r["team"], r["ancestor"]): r["depth"] for r in entities.affiliate_tree(teams, "team", "parent").collect()}
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
    assert got == {(n, m): n - m for n in range(1, 151) for m in range(n)}


@pytest.mark.parametrize("limit", [None, 2])
def test_states_at_many_dates(spark, limit):
    rng = random.Random(4)
    day0 = dt.date(2024, 1, 1)
    rows = [(rng.choice([1, 2, None]), rng.choice(["A", "B", None]), day0 + dt.timedelta(days=rng.randint(0, 90)), n) for n in range(40)]
    rows.append((1, "A", None, 99))
    changes = spark.createDataFrame(rows, "player long, team string, day date, version long")
    held = validity.intervals(changes, ["player"], "day", ["version"], limit=limit)
    dates = [(t, day0 + dt.timedelta(days=d)) for t in ("A", "B", None) for d in range(-3, 100, 7)]
    asked = spark.createDataFrame([*dates, dates[0], ("A", None)], "team string, asked date")
    got = [(r["team"], r["asked"], r["player"]) for r in validity.at_dates(held, asked, ["team"], "asked", width=8).collect()]
    expected = []
    for team, date in dates:
        for player in (1, 2, None):
            own = [r for r in rows if r[0] == player and r[2] is not None and r[2] <= date]
            if own and max(own, key=lambda r: (r[2], r[3]))[1] == team:
                expected.append((team, date, player))
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_streak_summaries_join_like_whole_histories(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1, 2, None]), dt.date(2024, 1, 1) + dt.timedelta(days=n), n, rng.random() < 0.7) for n in range(120)]
    rows += [(5, dt.date(2024, 1, 1) + dt.timedelta(days=n), n, False) for n in range(9)]
    rows += [(6, dt.date(2024, 1, 1) + dt.timedelta(days=n), n, None if n == 4 else True) for n in range(9)]
    games = spark.createDataFrame(rows, "player long, day date, n long, hit boolean")
    whole = streaks.islands(games, ["player"], ["day", "n"], F.col("hit")).select("player", "length", "started", "ended", "is_current")
    expected = sorted(map(str, whole.collect()))
    for width, limit in ((1, None), (4, None), (4, 3), (1000, None)):
        parts = streaks.streak_summary(games, ["player"], ["day", "n"], F.col("hit"), F.floor(F.col("n") / width), limit)
        assert sorted(map(str, streaks.join_summaries(parts, ["player"], limit).collect())) == expected


def test_streaks_after_an_increment_read_new_games_only(spark):
    rows = [(1, dt.date(2024, 1, 1) + dt.timedelta(days=n), n, n % 5 != 0) for n in range(20)]
    games = spark.createDataFrame(rows, "player long, day date, n long, hit boolean")
    part = F.floor(F.col("n") / 10)
    old, new = games.where("n < 10"), games.where("n >= 10")
    path = shared_path(spark, "parts")
    for some in (old, new):
        streaks.streak_summary(some, ["player"], ["day", "n"], F.col("hit"), part).write.mode("append").parquet(path)
    kept = spark.read.parquet(path)
    # Four runs a slice at most, whatever the number of games.
    assert kept.count() <= 6 and all(path in f for f in streaks.join_summaries(kept, ["player"]).inputFiles())
    got = streaks.join_summaries(kept, ["player"]).collect()
    whole = streaks.islands(games, ["player"], ["day", "n"], F.col("hit")).select("player", "length", "started", "ended", "is_current")
    assert sorted(map(str, got)) == sorted(map(str, whole.collect()))


def test_sums_over_spans(spark):
    rows = [(1, 2019, "3"), (1, 2021, "4"), (1, 2021, ""), (2, 2020, "5"), (None, 2018, "1"), (1, None, "9"), (3, 2022, "x")]
    df = spark.createDataFrame(rows, "id long, year int, hits string")
    asked = [(2019, 2021), (2020, 2020), (2000, 2030), (2022, 2019), (2021, 2025), (2019, 2021)]
    table = spark.createDataFrame(asked, "a int, b int")
    got = spans.over_spans(spans.season_sums(df, ["id"], "year", ["hits"]), table, ["id"], "year", ["hits"], "a", "b").collect()
    expected = set()
    for a, b in set(asked):
        for player in {r[0] for r in rows}:
            own = [r for r in rows if r[0] == player and r[1] is not None and a <= r[1] <= b]
            if own:
                expected.add((player, a, b, float(sum(int(r[2]) for r in own if r[2].isdigit()))))
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


@pytest.mark.parametrize("limit", [None, 3])
def test_coverage_gaps_and_plan(spark, limit):
    rng = random.Random(9)
    day0, days = dt.date(2024, 1, 1), range(-10, 140)
    pulls = [(rng.choice(["mlb", "milb", None]), *sorted(day0 + dt.timedelta(days=rng.randint(0, 120)) for _ in range(2))) for _ in range(14)]
    pulls = [(k, a, min(b, a + dt.timedelta(days=9))) for k, a, b in pulls] + [("mlb", day0, None), ("mlb", day0 + dt.timedelta(days=5), day0)]
    table = spark.createDataFrame([*pulls, pulls[0]], "level string, a date, b date")
    wanted = [(k, day0 - dt.timedelta(days=4), day0 + dt.timedelta(days=130)) for k in ("mlb", "milb", None, "new")]
    open_days = set()
    for k, a, b in wanted:
        for n in days:
            d = day0 + dt.timedelta(days=n)
            if a <= d <= b and not any(p[0] == k and p[1] <= d and p[2] is not None and d <= p[2] for p in pulls):
                open_days.add((k, d))
    held = spans.covered(table, ["level"], "a", "b", limit)
    missing = spans.gaps(held, spark.createDataFrame(wanted, "level string, a date, b date"), ["level"], "a", "b", limit)

    def days_of(df):
        return [(r["level"], r["a"] + dt.timedelta(days=n)) for r in df.collect() for n in range((r["b"] - r["a"]).days + 1)]

    found = days_of(missing)
    assert len(found) == len(set(found)) and set(found) == open_days
    # Neighbouring days are one gap, and one covered stretch.
    for df in (missing, held):
        rows = {(r["level"], r["a"]): r["b"] for r in df.collect()}
        assert not any((k, b + dt.timedelta(days=1)) in rows for (k, _), b in rows.items())
    plan = spans.pull_plan(missing, ["level"], "a", "b")
    assert sorted(days_of(plan), key=str) == sorted(found, key=str)
    assert all((r["b"] - r["a"]).days < spans.PULL_DAYS for r in plan.collect())


# ------------------------------------------------------------------ payload types


def test_inventory_and_drift_of_types(spark):
    bodies = ['{"a":1,"b":[{"c":"x"},{"c":null}],"d":{}}', '{"a":"1","b":[],"d":{"e/f":1.5}}', '{"a":null,"*":true}', "junk", None]
    df = spark.createDataFrame([(b, at(n)) for n, b in enumerate(bodies)], "body string, ts timestamp_ntz")
    found = {(r["path"], r["type"]): (r["n"], r["first_seen"].second, r["last_seen"].second) for r in payload_schema.path_inventory(df, "body", "ts").collect()}
    assert found == {
        ("/a", "BIGINT"): (1, 0, 0),
        ("/a", "STRING"): (1, 1, 1),
        ("/a", "VOID"): (1, 2, 2),
        ("/b/*/c", "STRING"): (1, 0, 0),
        ("/b/*/c", "VOID"): (1, 0, 0),
        ("/b", "ARRAY<VOID>"): (1, 1, 1),
        ("/d", "OBJECT<>"): (1, 0, 0),
        ("/d/e~1f", "DECIMAL(2,1)"): (1, 1, 1),
        ("/*", "BOOLEAN"): (1, 2, 2),
    }
    drift = payload_schema.drifting_paths(payload_schema.path_inventory(df, "body", "ts")).collect()
    assert [(r["path"], r["types"], r["n"], r["changed"]) for r in drift] == [("/a", ["BIGINT", "STRING"], 2, at(1))]


def test_typed_payloads_take_the_type_of_all(spark):
    rows = [(1, '{"a":1,"list":[{"x":1}],"OBJECT<":"odd"}'), (2, '{"a":2.5,"list":[{"x":2,"y":"t"}],"only":null}'), (3, "junk")]
    df = spark.createDataFrame(rows, "id long, body string")
    typed = payload_schema.typed_payloads(df, "body", ["id"])
    got = {r["id"]: r.asDict(recursive=True) for r in typed.collect()}
    assert float(got[1]["a"]) == 1.0 and float(got[2]["a"]) == 2.5 and got[3]["a"] is None
    assert got[2]["list"] == [{"x": 2, "y": "t"}] and got[1]["list"] == [{"x": 1, "y": None}] and got[1]["OBJECT<"] == "odd"
    fixed = payload_schema.typed_payloads(df, "body", ["id"], "STRUCT<a: BIGINT>")
    assert fixed.columns == ["id", "a"]
    with pytest.raises(ValueError, match="no objects"):
        payload_schema.typed_payloads(df.where("id = 3"), "body")


def test_keys_whose_times_are_all_missing_stay(spark):
    rows = [(1, None, "a"), (2, at(1), "b"), (2, None, "c"), (None, at(3), "d"), (None, at(4), "e")]
    got = feeds.latest(spark.createDataFrame(rows, "k long, ts timestamp_ntz, v string"), ["k"], "ts")
    assert {r["k"]: r["v"] for r in got.collect()} == {1: "a", 2: "b", None: "e"}
