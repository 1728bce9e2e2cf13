import pytest

from dugout.landed import BOARD_CALLS, Landed
from dugout.operators import leaderboard, pitch_search
from dugout.plans.registry import BOARDS


def test_board_calls_cover_the_registry():
    assert sorted(BOARD_CALLS.values()) == sorted(BOARDS)


def test_landed_folder(spark, tmp_path):
    root = str(tmp_path)
    pitches = spark.createDataFrame(
        [
            (1, "2024-06-01", "mlb", "10", "20", "FF", "98.1", "LAD", "SF"),
            (1, "2024-06-01", "mlb", "10", "21", "SL", "", "LAD", "SF"),
            (2, "2025-04-01", "mlb", "11", "20", "FF", "junk", "SD", "LAD"),
        ],
        "game_pk long, game_date string, level string, pitcher string, batter string, pitch_type string, "
        "release_speed string, home_team string, away_team string",
    )
    pitch_search.land_pitches(pitches, f"{root}/pitches")
    shards = tmp_path / "register"
    shards.mkdir()
    (shards / "people-0.csv").write_text("key_mlbam,key_fangraphs,key_bbref,name_first,name_last,mlb_played_first,mlb_played_last\n10,x10,,Ann,Lee,2020,\n")
    (shards / "people-1.csv").write_text("")
    board = spark.createDataFrame([("10", 2024, 28.1), ("11", 2024, 27.0)], "player_id string, year int, sprint_speed double")
    leaderboard.land_board(board, f"{root}/boards", "sprint_speed")
    venues = '<script>var data = [{"venue_id":1,"park_factor":112},{"venue_id":2}];</script>'
    pages = spark.createDataFrame([(2024, "R", venues), (2024, "L", "<p>none</p>")], "year int, bat_side string, html string")
    pages.write.parquet(f"{root}/pages/statcast-park-factors")

    data = Landed(spark, root)
    june = data.search_pitches("2024-06-01", "2024-06-30")
    assert june.count() == 2 and dict(june.dtypes)["release_speed"] == "double"
    assert "pitch_year" in june._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
    assert data.search_team("Dodgers", "2024-01-01", "2025-12-31").count() == 3
    assert data.search_team("dodgers", "2024-01-01", "2025-12-31", "away").count() == 1
    assert data.search_game(1, hfPT="SL").count() == 1
    assert data.search_matchup(10, 20, "2024-01-01", "2025-12-31").count() == 1
    arsenal = {r["pitch_type"]: r["avg_release_speed"] for r in data.get_pitcher_arsenal(10, "2024-01-01", "2024-12-31").collect()}
    assert arsenal == {"FF": 98.1, "SL": None}
    assert data.lookup("lee").count() == 1
    assert data.mlbam_to_fangraphs(10) == "x10" and data.mlbam_to_bbref(10) is None and data.bbref_to_mlbam("") is None
    assert [r["player_id"] for r in data.get_sprint_speed(2024, player_id=11).collect()] == ["11"]
    parks = data.get_park_factors(2024, bat_side="R").collect()
    assert [(r["venue_id"], r["park_factor"]) for r in parks] == [("1", "112"), ("2", None)]
    assert data.get_park_factors(2024, bat_side="L").count() == 0
    with pytest.raises(ValueError):
        data.get_park_factors(2024, roof="open")
