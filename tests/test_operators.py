import inspect
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from dugout.operators import arsenal, derived, entities, leaderboard, ordered, pitch_search, ranking, register, resolve, streaks
from dugout.plans import endpoints, registry
from dugout.sources import codes
from dugout.streaming import feeds

ARSENAL_COLUMNS = "pitcher string, pitch_type string, player_name string, p_throws string, release_speed string, release_spin_rate string, spin_axis string"
ARSENAL_ROWS = [
    ("1", "FF", "Doe", "R", "97", "2400", "200"),
    ("1", "FF", "Doe", "R", "98", "2500", "210"),
    ("1", "FF", "Doe", "R", "99", "2600", "220"),
    ("1", "SL", "Doe", "R", "87", "", ""),
    ("1", "SL", "Doe", "R", "", "", None),
]


@pytest.fixture()
def thrown(spark):
    return spark.createDataFrame(ARSENAL_ROWS, ARSENAL_COLUMNS)


def test_arsenal_golden(thrown):
    rows = {r["pitch_type"]: r for r in arsenal.aggregate_arsenal(thrown).collect()}
    ff, sl = rows["FF"], rows["SL"]
    assert (ff["n_pitches"], ff["usage_pct"], sl["n_pitches"], sl["usage_pct"]) == (3, 60.0, 2, 40.0)
    assert (ff["avg_release_speed"], ff["avg_release_spin_rate"], ff["avg_spin_axis"]) == (98.0, 2500.0, 210.0)
    assert (sl["avg_release_speed"], sl["avg_release_spin_rate"], sl["avg_tilt"]) == (87.0, None, None)
    assert ff["avg_tilt"] == "7:00" and ff["player_name"] == "Doe" and ff["avg_pfx_x"] is None


def test_arsenal_without_pitcher_has_no_usage(thrown):
    assert "usage_pct" not in arsenal.aggregate_arsenal(thrown, ("pitch_type",)).columns


def test_arsenal_missing_key_and_first_row(spark):
    rows = [(2, "FF", "Late"), (1, "FF", ""), (3, None, "Other")]
    df = spark.createDataFrame(rows, "row_order long, pitch_type string, player_name string")
    got = {r["pitch_type"]: r for r in arsenal.aggregate_arsenal(df, ("team", "pitch_type"), ()).collect()}
    assert got["FF"]["player_name"] == "" and got["FF"]["team"] == ""
    assert got[""]["player_name"] == "Other"


def test_search_arguments(spark, thrown):
    days = thrown.withColumn("game_date", F.lit("2024-06-01").cast("date"))
    assert pitch_search.search_pitches(days, "2024-06-01", "2024-06-07", hfPT="FF|SL|").count() == 5
    assert pitch_search.search_pitches(days, "2024-05-26", "2024-06-01", player_id=1, hfPT="SL|").count() == 2
    assert pitch_search.search_pitches(days, "2024-06-02", "2024-06-07").count() == 0
    for bad in (("2024-6-1", "2024-06-02"), ("2024-06-02", "2024-06-01")):
        with pytest.raises(ValueError):
            pitch_search.search_pitches(days, *bad)
    with pytest.raises(ValueError):
        pitch_search.search_pitches(days, "2024-06-01", "2024-06-02", level="high")
    with pytest.raises(ValueError, match="Did you mean 'Dodgers'"):
        pitch_search.search_team(days, "Dodgrs", "2024-06-01", "2024-06-02")


def test_search_filter_reaches_scan(spark, tmp_path):
    path = str(tmp_path / "pitches")
    spark.range(100).selectExpr(
        "id as pitcher", "date_add(date'2024-06-01', cast(id % 10 as int)) as game_date", "'mlb' as level"
    ).write.partitionBy("level", "game_date").parquet(path)
    found = pitch_search.search_pitches(spark.read.parquet(path), "2024-06-02", "2024-06-03", player_id=11)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(pitcher,11)" in plan and "game_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert found.count() == 1


REGISTER = "key_mlbam string, key_fangraphs string, key_bbref string, key_bbref_minors string, key_retro string, name_first string, name_last string, mlb_played_first string, mlb_played_last string, row_order int"
PEOPLE = [
    ("545361", "10155", "troutmi01", "trout-001", "troum001", "Mike", "Trout", "2011", "2024", 1),
    ("111", "", "", "doe---001", "", "John", "Doe", "", "", 2),
    ("545361", "999", "other01", "", "", "Mike", "Double", "2012", "", 3),
    ("", "", "", "", "", "No", "Id", "2000", "", 4),
]


@pytest.fixture()
def people(spark):
    return spark.createDataFrame(PEOPLE, REGISTER)


def test_lookup(people):
    last = lambda df: sorted(r["name_last"] for r in df.collect())
    assert last(register.lookup(people, name="TROUT")) == ["Trout"]
    assert last(register.lookup(people, name="mike d")) == ["Double"]
    assert last(register.lookup(people, name="doe")) == []
    assert last(register.lookup(people, name="doe", mlb_only=False)) == ["Doe"]
    assert last(register.lookup(people, mlbam=545361, bbref="troutmi01")) == ["Trout"]
    assert last(register.lookup(people, mlbam="", mlb_only=False)) == []
    assert len(last(register.lookup(people, name=""))) == 3


def test_id_conversion(spark, people):
    ids = spark.createDataFrame([("545361",), ("111",), ("",), ("7",)], "id string")
    got = {r["id"]: r["fg"] for r in register.convert_ids(ids, "id", people, "mlbam", "fangraphs", "fg").collect()}
    assert got == {"545361": "10155", "111": None, "": None, "7": None}


@pytest.mark.parametrize(
    ("kind", "asked"),
    [
        ("team", {" dodgers ": "LAD", "Chicago": "CHC", "New York": "NYM", "los angeles": "LAA", "o's": "BAL", "x": None}),
        ("pitch_type", {"ff": "FF", "Sweeper": "ST", "4-SEAM": "FF", "Split-Finger": "FS", "": None}),
        ("hand", {"RHP": "R", "lefty": "L", "both": "S", "?": None}),
        ("team_id", {"Dodgers": 119, "lad": 119, "st. louis cardinals": 138, "": None, "zzz": None}),
    ],
)
def test_resolvers(spark, kind, asked):
    df = spark.createDataFrame([(a,) for a in asked], "asked string")
    assert {r[0]: r[1] for r in resolve.resolve(df, "asked", kind, "code").collect()} == asked


def test_team_id_names_and_abbreviations_never_clash():
    names = {n.lower() for n, _ in codes.TEAM_IDS}
    assert not names & {a.lower() for a, _ in codes.TEAM_ABBREVS}
    assert len(names) == len(codes.TEAM_IDS)


def test_player_resolution(spark):
    people = spark.createDataFrame(
        [("A B", 100, True), ("A B", 592450, True), ("a b", 999999, False), ("C", 5, None), ("C", 4, False)],
        "name string, id long, active boolean",
    )
    asked = spark.createDataFrame([(" a B ",), ("c",), ("d",)], "q string")
    got = resolve.resolve_players(asked, people, query="q", name="name", player_id="id", active="active")
    assert {r["q"]: r["resolved_id"] for r in got.collect()} == {" a B ": 592450, "c": 5, "d": None}


def skewed(spark, n=600):
    """A third of the rows have no key, a third a blank one."""
    random.seed(11)
    keys = [None, "", *"abcdefg"]
    rows = [
        (keys[i % 3] if i % 3 < 2 else keys[2 + i % 7], i, random.choice([0, 1, 1]), float(random.randint(0, 9)))
        for i in range(n)
    ]
    random.shuffle(rows)
    return spark.createDataFrame(rows, "k string, o int, hit int, v double"), rows


def by_name(row):
    return (row[0] is not None, row[0] or "", *row[1:])


@pytest.mark.parametrize("limit", [ordered.GROUP_LIMIT, 25])
def test_ordered_work_plain_and_sliced(spark, limit):
    df, rows = skewed(spark)
    by_key = {k: [r for r in sorted(rows, key=lambda r: r[1]) if r[0] == k] for k in {r[0] for r in rows}}

    total = {(r["k"], r["o"]): r["t"] for r in ordered.running_total(df, ["k"], ["o"], F.col("hit"), "t", limit).collect()}
    assert total == {(k, r[1]): sum(x[2] for x in rs[: i + 1]) for k, rs in by_key.items() for i, r in enumerate(rs)}

    rolled = derived.rolling_mean(df, "k", ["o"], "v", 4, limit=limit).collect()
    want = {}
    for k, rs in by_key.items():
        for i, r in enumerate(rs):
            last = [x[3] for x in rs[max(0, i - 3) : i + 1]]
            want[k, r[1]] = sum(last) / len(last)
    assert {(r["k"], r["o"]): pytest.approx(r["rolling"]) for r in rolled} == want

    sparse = df.withColumn("s", F.when(F.col("o") % 50 == 0, F.col("v")))
    filled = ordered.fill_forward(sparse, ["k"], ["o"], "s", "f", limit).collect()
    for r in filled:
        seen = [x[3] for x in by_key[r["k"]] if x[1] <= r["o"] and x[1] % 50 == 0]
        assert r["f"] == (seen[-1] if seen else None)

    runs = streaks.islands(df, ["k"], ["o"], F.col("hit") == 1, limit).collect()
    found = sorted([(r["k"], r["started"], r["ended"], r["length"], r["is_current"]) for r in runs], key=by_name)
    expected = []
    for k, rs in by_key.items():
        for hit, run in groupby(rs, key=lambda r: r[2]):
            run = list(run)
            if hit:
                expected.append((k, run[0][1], run[-1][1], len(run), run[-1] is rs[-1]))
    assert found == sorted(expected, key=by_name)


@pytest.mark.parametrize("limit", [ordered.GROUP_LIMIT, 25])
def test_percentiles_plain_and_by_counts(spark, limit):
    df, rows = skewed(spark)
    gaps = df.withColumn("v", F.when(F.col("o") % 10 != 0, F.col("v")))
    out = ranking.percentiles(gaps, ["k"], ["v"], limit=limit).collect()
    for r in out:
        if r["v"] is None:
            assert r["v_pct"] is None
            continue
        peers = [x[3] for x in rows if x[0] == r["k"] and x[1] % 10]
        want = 0.0 if len(peers) == 1 else 100 * sum(p < r["v"] for p in peers) / (len(peers) - 1)
        assert r["v_pct"] == pytest.approx(want)


def test_leaders_keep_ties(spark):
    df = spark.createDataFrame([("hr", 5, "a"), ("hr", 5, "b"), ("hr", 4, "c"), ("hr", 3, "d"), ("avg", 1, "e")], "cat string, v int, who string")
    got = sorted((r["cat"], r["rank"], r["who"]) for r in ranking.leaders(df, ["cat"], "v", 3).collect())
    assert got == [("avg", 1, "e"), ("hr", 1, "a"), ("hr", 1, "b"), ("hr", 3, "c")]


def test_streak_arguments(spark):
    df, _ = skewed(spark, 10)
    args = {"player": "k", "order": ["o"], "season": "k", "flags": {"hit": F.col("hit") == 1}}
    with pytest.raises(ValueError):
        streaks.streaks(df, "walkingStreak", "career", **args)
    with pytest.raises(ValueError):
        streaks.streaks(df, "hittingStreakOverall", "forever", **args)
    with pytest.raises(ValueError):
        streaks.streaks(df, "hittingStreakHome", "career", **args)


def landed(spark, spec):
    """Two seasons of two players in a board's own columns."""
    names = [c for c in (spec.columns or ("player_id", "metric")) if c != "year"]
    rows = [
        tuple(str(p) if c == spec.id_column else ("FF" if c == "pitch_type" else float(p + y)) for c in names) + (y,)
        for p in (1, 2)
        for y in (2024, 2025)
    ]
    kinds = ["string" if c in (spec.id_column, "pitch_type") else "double" for c in names]
    schema = ", ".join(f"`{c}` {k}" for c, k in zip(names, kinds, strict=True)) + ", year int"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("slug", sorted(registry.BOARDS))
def test_every_board(spark, slug):
    spec = registry.board(slug)
    df = landed(spark, spec)
    more = {"pitch_type": "FF"} if "pitch_type" in spec.required else {}
    if spec.season == "special":
        df = df.withColumn("year", F.concat("year", F.lit("_observed")))
        season = "2025_observed"
    else:
        season = 2025
    assert leaderboard.leaderboard(df, slug, season, **more).count() == 2
    if spec.id_column not in df.columns:
        with pytest.raises(ValueError):
            leaderboard.leaderboard(df, slug, season, player_id=2)
        return
    mine = leaderboard.leaderboard(df, slug, season, player_id=2, **more)
    assert [r[spec.id_column] for r in mine.collect()] == ["2"]
    if spec.season in ("int", "special"):
        with pytest.raises(ValueError):
            leaderboard.leaderboard(df, slug, [2024, 2025], **more)
    if spec.required:
        with pytest.raises(ValueError):
            leaderboard.leaderboard(df, slug, season)


def test_season_range_weighs_by_count(spark):
    df = spark.createDataFrame([("1", 2023, 10.0, 70.0), ("1", 2024, 30.0, 74.0)], "id string, year int, swings_competitive double, avg_bat_speed double")
    rows = leaderboard.leaderboard(df, "bat-tracking", (2024, 2023)).collect()
    assert len(rows) == 1 and rows[0]["avg_bat_speed"] == 73.0 and rows[0]["swings_competitive"] == 40.0
    assert leaderboard.leaderboard(df, "bat-tracking", 2023, minSwings=11).count() == 0
    with pytest.raises(ValueError):
        leaderboard.leaderboard(df, "bat-tracking", [])
    array = leaderboard.leaderboard(df, "bat-tracking/swing-timing-miss-distance", [2023, 2024])
    assert array.count() == 2


def test_board_edge_rules(spark):
    df = spark.createDataFrame([("999999", 2024, "batter"), ("5", 2024, "batter")], "player_id string, year int, type string")
    assert leaderboard.leaderboard(df, "percentile-rankings", 2024).count() == 1
    assert leaderboard.leaderboard(df, "pitch-timer-infractions", 2024, type="anything").count() == 2
    with pytest.raises(ValueError):
        leaderboard.leaderboard(df, "home-runs", 2024, type="umpire")
    with pytest.raises(ValueError):
        leaderboard.leaderboard(df, "home-runs", 2024, shoe_size=11)
    with pytest.raises(ValueError):
        leaderboard.leaderboard(df, "sprint_speed", 2024, min_n="q")
    with pytest.raises(ValueError):
        registry.board("nope")
    spun = spark.createDataFrame([("9", "2024_observed")], "pitcher_id string, year string")
    assert leaderboard.leaderboard(spun, "active-spin", "2024_observed", player_id=9).count() == 1


def test_registry_shape(spark):
    rows = registry.registry_frame(spark)
    assert rows.count() == 41 and rows.where("season = 'int'").count() == 37
    assert len(registry.list_boards("batting")) == 11
    assert registry.board("sprint-speed-alt").slug == "sprint_speed"


def test_code_tables(spark):
    sizes = {n: len(r) for n, (r, _) in codes.API_SIDE.items()}
    assert (sizes["stat_types"], sizes["leader_categories"], sizes["team_ids"], sizes["team_abbrevs"]) == (61, 70, 61, 38)
    assert (sizes["situations"], sizes["transactions"], sizes["schedule_events"], sizes["pitch_types"]) == (58, 21, 14, 24)
    for side, tables in codes.NAMESPACES.items():
        for name in tables:
            assert codes.code_table(spark, name, side).count() == len(tables[name][0])


def test_every_endpoint_takes_its_parameters(spark):
    assert len(endpoints.ENDPOINTS) == 84
    rows = [(1, 2023), (1, 2024), (1, 2025)]
    df = spark.createDataFrame(rows, "id int, season int")
    with pytest.raises(ValueError):
        endpoints.query_endpoint("get_schedule", df, nonsense=1)
    with pytest.raises(ValueError):
        endpoints.query_endpoint("get_schedule", df, venueIds=3)
    seasons = 0
    for spec in endpoints.ENDPOINTS.values():
        # Settings are one positional argument, so no parameter can be taken for one.
        kinds = inspect.signature(endpoints.query_endpoint).parameters
        named = {n for n, p in kinds.items() if p.kind not in (p.POSITIONAL_ONLY, p.VAR_KEYWORD)}
        assert not named & {*spec.params, *spec.path_params}
        if "season" in spec.params and spec.name != "get_streaks":
            stats = df.selectExpr("*", "'c' as category", "1 as value")
            got = endpoints.query_endpoint(spec.name, stats, season=2024).collect()
            # the record endpoint answers with a high and a low
            assert len(got) == (2 if spec.name == "get_high_low" else 1), spec.name
            assert {r["season"] for r in got} == {2024}, spec.name
            seasons += 1
        if "hydrate" in spec.params and spec.name not in ("get_streaks", "get_gamefeed"):
            with pytest.raises(ValueError, match="hydrate"):
                endpoints.query_endpoint(spec.name, df.selectExpr("*", "'c' as category", "1 as value"), hydrate="team")
    assert seasons >= 27


def test_endpoint_hydrates_through_the_landed_api(spark, tmp_path):
    spark.createDataFrame([(1, 7), (2, None)], "id int, team_id int").write.parquet(str(tmp_path / "get_people"))
    teams = spark.createDataFrame([(7, "Seven")], "team_id int, name string")
    settings = {"get_people": endpoints.Settings(related={"currentTeam": (teams, ["team_id"])})}
    api = endpoints.LandedApi(spark, str(tmp_path), settings)
    got = {r["id"]: r["currentTeam"] for r in api.get_people(hydrate="currentTeam").collect()}
    assert got[1]["name"] == "Seven"
    assert got[2] is None or got[2]["name"] is None


def test_streak_endpoint_orders_by_length(spark):
    games = [(1, 2024, i, int(i > 1)) for i in range(11)] + [(2, 2024, i, int(i < 3)) for i in range(5)]
    df = spark.createDataFrame(games, "player int, season int, day int, hit int")
    at = endpoints.Settings(streak={"player": "player", "order": ["day"], "flags": {"hit": F.col("hit") == 1}})
    asked = {"streakType": "hittingStreakOverall", "streakSpan": "career"}
    assert endpoints.query_endpoint("get_streaks", df, at, limit=1, **asked).first()["length"] == 9
    with pytest.raises(ValueError):
        endpoints.query_endpoint("get_streaks", df, limit=1, **asked)


def test_nothing_is_ignored(spark):
    df = spark.createDataFrame([(1, 2)], "pitcher int, n int")
    with pytest.raises(ValueError):
        pitch_search.filter_rows(df, min_results=3)
    assert pitch_search.filter_rows(df, min_results=0).count() == 1
    with pytest.raises(ValueError):
        leaderboard.leaderboard(df, "exit-velocity-barrels", type="batter")
    with pytest.raises(ValueError):
        derived.with_teams(df)
    rows = spark.createDataFrame([(1, 60), (2, 40)], "player_id int, bbe int")
    assert leaderboard.leaderboard(rows, "batted-ball", min_bbe=50).first()["player_id"] == 1


def test_leaders_of_a_missing_category_and_without_top(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 5.0), ("a", 5.0), ("a", 4.0)], "cat string, v double")
    one = ranking.leaders(df, ["cat"], "v", 1).collect()
    assert sorted((str(r["cat"]), r["v"]) for r in one) == [("None", 2.0), ("a", 5.0), ("a", 5.0)]
    every = ranking.leaders(df, ["cat"], "v").collect()
    assert sorted((str(r["cat"]), r["rank"]) for r in every) == [("None", 1), ("None", 2), ("a", 1), ("a", 1), ("a", 3)]
    ends = ranking.high_low(df, ["cat"], "v").collect()
    assert sorted((str(r["cat"]), r["record"]) for r in ends) == [("None", "high"), ("None", "low"), ("a", "high"), ("a", "high"), ("a", "low")]


def test_deep_page_is_the_rest_in_order(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as v")
    want = sorted(((i % 7, i) for i in range(1000)), key=lambda x: (-x[0], x[1]))
    got = [(r["v"], r["id"]) for r in ranking.page(df, "v", ["id"], None, 900).collect()]
    assert got == want[900:]


def test_late_changes_count(spark, tmp_path):
    day = "timestamp_ntz'2024-01-{:02d} 00:00:00'"
    for n, rows in enumerate([[(1, 9), (3, 9)], [(2, 1), (1, 1)], [(3, 10)]]):
        sql = " UNION ALL ".join(f"SELECT {k} AS id, {day.format(d)} AS updated, '{n}' AS v" for k, d in rows)
        spark.sql(sql).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = feeds.landing_stream(spark, str(tmp_path / "in"), schema, files=1)
    feeds.follow_changes(stream, ["id"], "updated", str(tmp_path / "t"), str(tmp_path / "c"))
    now = feeds.current_versions(spark, str(tmp_path / "t"), ["id"], "updated")
    assert {(r["id"], r["v"]) for r in now.collect()} == {(1, "0"), (2, "1"), (3, "2")}


def test_landed_api(spark, tmp_path):
    rows = [(1, "T", "2024-06-01"), (1, "U", "2024-06-02"), (2, "V", "2024-06-01")]
    spark.createDataFrame(rows, "sport_id int, name string, day string").selectExpr(
        "sport_id", "name", "cast(day as date) as date"
    ).write.parquet(str(tmp_path / "get_schedule"))
    api = endpoints.LandedApi(spark, str(tmp_path))
    assert [r["name"] for r in api.get_schedule(sportId=1, date="2024-06-01").collect()] == ["T"]
    assert api.get_schedule(sportId=[1, 2], startDate="2024-06-01", endDate="2024-06-01").count() == 2
    assert api.get_pitch_types().count() == 24
    with pytest.raises(AttributeError):
        api.get_lunch  # noqa: B018


def test_merge_sports_keeps_every_asked_sport(spark):
    df = spark.createDataFrame([(1, "a"), (11, "b"), (99, "c")], "sport_id int, who string")
    got = sorted((r["sport_id"], r["who"]) for r in entities.merge_sports(df, (1, 11, 12), ["who"]).collect())
    assert got == [(1, "a"), (11, "b"), (12, None)]


def test_text_pitch_rows_with_blank_dates(spark):
    rows = [("745001", "2024-06-01", "1", "FF"), ("", "", "1", "FF"), ("745002", "06/02/2024", "1", "FF")]
    df = spark.createDataFrame(rows, "game_pk string, game_date string, pitcher string, pitch_type string")
    assert pitch_search.search_pitches(df, "2024-06-01", "2024-06-30").count() == 2
    assert arsenal.aggregate_arsenal(df).first()["n_pitches"] == 3
    assert sorted(str(r["year"]) for r in derived.with_season(df).collect()) == ["2024", "2024", "None"]


def test_commas_are_text_in_pitch_filters(spark):
    df = spark.createDataFrame([("Lee, Ann", "FF"), ("Lee", "SL")], "player_name string, pitch_type string")
    assert pitch_search.filter_rows(df, player_name="Lee, Ann").count() == 1
    assert pitch_search.filter_rows(df, pitch_type="FF|SL|").count() == 2
    people = spark.createDataFrame([(1,), (2,), (3,)], "person_id int")
    assert endpoints.query_endpoint("get_people", people, personIds="1,2").count() == 2
    assert endpoints.query_endpoint("get_people", people, personIds=[3]).count() == 1


def test_leaders_ignore_missing_values(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), ("a", 1)], "cat string, v int")
    got = ranking.leaders(df, ["cat"], "v", 1, descending=False).collect()
    assert [(r["v"], r["rank"]) for r in got] == [(1, 1)]
