import pytest
from pyspark.sql import functions as F

from dugout.session import shared_dir
from dugout.sources import files
from dugout.streaming import feeds


def put(tmp_path, name, content):
    path = tmp_path / name
    path.write_bytes(content.encode("utf-8"))
    return str(path)


def test_csv_cells(spark, tmp_path):
    path = put(tmp_path, "a.csv", '﻿name,note,blank\n"Doe, John","says ""hi""",\n"two\nlines",x,""\n')
    rows = [tuple(r) for r in files.read_csv(spark, path).orderBy("name").collect()]
    assert rows == [("Doe, John", 'says "hi"', None), ("two\nlines", "x", None)]
    assert files.read_csv(spark, path).columns[0] == "name"
    assert files.read_csv(spark, put(tmp_path, "b.csv", ""), ["a"]).count() == 0


def test_register_shards(spark, tmp_path):
    put(tmp_path, "people-0.csv", "key_mlbam,name_last\n1,A\n2,B\n")
    put(tmp_path, "people-1.csv", "key_mlbam,name_last\n")
    put(tmp_path, "people-2.csv", "")
    put(tmp_path, "people-f.csv", "key_mlbam,name_last\n1,C\n")
    got = files.read_register(spark, str(tmp_path), ["key_mlbam", "name_last"])
    assert [r["name_last"] for r in got.orderBy("row_order").collect()] == ["A", "B", "C"]


def test_html_split(spark, tmp_path):
    put(tmp_path, "x.csv", "  <!DOCTYPE html><html></html>")
    put(tmp_path, "y.csv", "a,b\n1,2\n")
    put(tmp_path, "z.csv", "\n<HTML>no</HTML>")
    good, bad = files.split_html(files.read_bodies(spark, str(tmp_path)), "body")
    assert good.count() == 1 and bad.count() == 2
    assert {r["reason"] for r in bad.collect()} == {"html_body"}


PAGES = [
    ("array", '<script>var data = [{"venue":"Park","pf":112}];</script>', "data", "ok", '[{"pf":112,"venue":"Park"}]'),
    ("object", 'const rolling = {"windows":[{"label":"7"}],"meta":{"s":"f"}};</script> more', "rolling", "ok", '{"meta":{"s":"f"},"windows":[{"label":"7"}]}'),
    ("hostile", 'let data = [{"name":"A ] close","note":"quote \\" and { brace","values":[1,2,3]}];', "data", "ok", '[{"name":"A ] close","note":"quote \\" and { brace","values":[1,2,3]}]'),
    ("absent", "<html></html>", "data", "missing_var", None),
    ("quotes", "var data = ['x'];", "data", "bad_json", None),
    ("open", "var data = [1, 2", "data", "bad_json", None),
    ("number", "var data = 5;", "data", "missing_var", None),
]


@pytest.mark.parametrize(("name", "html", "variable", "status", "json"), PAGES)
def test_embedded_json(spark, name, html, variable, status, json):
    df = spark.createDataFrame([(html,)], "html string")
    row = files.embedded_json(df, "html", variable).select("json_status", F.to_json("json")).first()
    assert tuple(row) == (status, json)


@pytest.mark.parametrize(
    ("body", "status"),
    [
        ('{"a": 1}', "ok"),
        (' {"a": [1, {"b": 2}]} ', "ok"),
        ("[1, 2]", "not_object"),
        ("3", "not_object"),
        ('{"a": 1} tail', "bad_json"),
        ('{"a": 1}, {"b": 2}', "bad_json"),
        ('{"a": 1}], [{"b": 2}', "bad_json"),
        ('{"a": 1}, "c": {"x": 1}', "bad_json"),
        ('{"a": ', "bad_json"),
        ("", "bad_json"),
    ],
)
def test_payload_bodies(spark, body, status):
    df = spark.createDataFrame([(body,)], "body string")
    row = files.payload_objects(df, "body").first()
    assert row["json_status"] == status
    assert (row["json"] is not None) == (status == "ok")


def test_sink_rules(spark, tmp_path):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, 3)], "x int, y int")
    out = str(tmp_path / "rows")
    assert files.union_rows([a, b]).columns == ["x", "y"]
    assert files.write_rows([a, b], out)
    rows = sorted(tuple(r) for r in files.read_csv(spark, out).collect())
    assert rows == [("1", None), ("2", "3")]
    nested = a.select(F.struct("x").alias("s"))
    with pytest.raises(ValueError):
        files.write_rows(nested, str(tmp_path / "n"))
    assert files.write_rows(nested, str(tmp_path / "j"), "json")
    assert not files.write_rows(a.where("x > 5"), str(tmp_path / "e"))
    assert not (tmp_path / "e").exists()


def test_shared_dir_follows_the_setting(spark, tmp_path):
    before = shared_dir(spark)
    spark.conf.set("spark.checkpoint.dir", str(tmp_path)) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    assert before


def test_stream_replay_is_idempotent(spark, tmp_path):
    landing, table, state = (str(tmp_path / d) for d in ("landing", "table", "state"))
    schema = "player long, updated timestamp_ntz, name string"

    def land(rows):
        df = spark.createDataFrame(rows, "player long, updated string, name string")
        df.selectExpr("player", "cast(updated as timestamp_ntz) updated", "name").coalesce(1).write.mode("append").parquet(landing)

    def follow():
        from pyspark.sql.types import _parse_datatype_string

        stream = feeds.landing_stream(spark, landing, _parse_datatype_string(schema))
        feeds.follow_changes(stream, ["player"], "updated", table, state)
        now = feeds.current_versions(spark, table, ["player"], "updated")
        return sorted((r["player"], r["name"]) for r in now.collect())

    land([(1, "2024-06-01 10:00:00", "old"), (1, "2024-06-01 10:30:00", "new"), (2, "2024-06-01 10:10:00", "two")])
    assert follow() == [(1, "new"), (2, "two")]
    land([(2, "2024-06-01 11:00:00", "two again"), (3, "2024-06-01 11:00:00", "three")])
    assert follow() == [(1, "new"), (2, "two again"), (3, "three")]
    assert follow() == [(1, "new"), (2, "two again"), (3, "three")]


def test_csv_folder_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("game_pk,pitcher\n1,200\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text('\ufeffpitcher,game_pk,"bat,speed"\n200,2,"7""1"\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text("\n <!DOCTYPE html><p>busy</p>")
    (tmp_path / "d.csv").write_text("\n")
    (tmp_path / "e.csv").write_text("game_pk,pitcher\n")
    rows, aside = files.read_csv_folder(spark, str(tmp_path / "*.csv"))
    got = sorted((r["game_pk"], r["pitcher"], r["bat,speed"]) for r in rows.collect())
    assert got == [("1", "200", None), ("2", "200", '7"1')]
    assert sorted((r["file"][-5:], r["reason"]) for r in aside.collect()) == [("c.csv", "html_body"), ("d.csv", "empty")]
