import math
import re

import pytest
from pyspark.sql import functions as F

from dugout.functions import spin, text


def one_column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("o")).collect()]


def test_to_float(spark):
    cells = ["98.5", "0", "", None, "abc", "93.4d", "93.4f", "0x1p3", "1_000", "1__0", "_1", " 7 ", "1e3", "-inf", "Infinity", "5F", "1_0d"]
    got = one_column(spark, cells, text.to_float("c"))
    want = [98.5, 0.0, None, None, None, None, None, None, 1000.0, None, None, 7.0, 1000.0, -math.inf, math.inf, None, None]
    assert got == want
    assert math.isnan(one_column(spark, ["nan"], text.to_float("c"))[0])


def test_cast_numeric(spark):
    df = spark.createDataFrame([("A", "3", "1.5", ""), ("B", "", "junk", "")], "name string, barrels string, rate string, blank string")
    out = text.cast_numeric(df)
    assert dict(out.dtypes) == {"name": "string", "barrels": "double", "rate": "string", "blank": "double"}
    assert [tuple(r) for r in out.collect()] == [("A", 3.0, "1.5", None), ("B", None, "junk", None)]
    named = text.cast_numeric(df, ["barrels", "absent"])
    assert dict(named.dtypes)["blank"] == "string"


def test_dates(spark):
    cells = ["2024-06-01", "06/01/2024", "2024-06-01T10:20:30", "20240601", " 2024-06-01 ", "soon", "2024-13-45", None]
    first = "06/01/2024"
    assert one_column(spark, cells, text.format_date("c")) == [first] * 5 + ["soon", "2024-13-45", None]
    parsed = one_column(spark, cells, text.parse_date("c"))
    assert [str(p) if p else None for p in parsed] == ["2024-06-01"] * 5 + [None] * 3


def test_timecode_and_season(spark):
    assert str(one_column(spark, ["20240601_191503"], text.parse_timecode("c"))[0]) == "2024-06-01 19:15:03"
    assert one_column(spark, ["bad"], text.parse_timecode("c")) == [None]
    assert one_column(spark, ["x"], text.spin_season(2024, "observed")) == ["2024_observed"]
    with pytest.raises(ValueError):
        text.spin_season(2024, "guessed")


def test_clock(spark):
    degrees = [0.0, 45.0, 90.0, 180.0, 270.0, 29.8, None, 359.9, 360.0, -90.0, math.nan]
    faces = ["12:00", "1:30", "3:00", "6:00", "9:00", "1:00", None, "12:00", "12:00", "9:00", None]
    assert one_column(spark, degrees, spin.axis_to_clock("c"), "double") == faces
    assert one_column(spark, ["90", "", "x"], spin.axis_to_clock("c", numeric=False)) == ["3:00", None, None]


# A known input row and some of its results.
GOOD = {
    "release_extension": "6.5", "vx0": "5.0", "vy0": "-135.0", "vz0": "-5.0", "ax": "-10.0", "ay": "30.0",
    "az": "-15.0", "spinx": "50.0", "spiny": "-2200.0", "spinz": "600.0",
}
KNOWN = {"spin_rate": 2280.90, "vbar": 130.07, "tF": 0.4051, "spin_eff": 0.3189}


def spun(spark, **changes):
    row = {**GOOD, **changes}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    return spin.add_spin_columns(df).first()


def by_hand(row):
    """The flight model step by step in plain Python, for one row."""
    v = {k: float(x) for k, x in row.items()}
    w = math.hypot(v["spinx"], v["spiny"], v["spinz"])
    y = 60.5 - v["release_extension"]
    t_r = (-v["vy0"] - math.sqrt(v["vy0"] ** 2 + 2 * v["ay"] * (y - 50))) / v["ay"]
    rel = [v[f"v{k}0"] + v[f"a{k}"] * t_r for k in "xyz"]
    t_f = (-rel[1] - math.sqrt(rel[1] ** 2 - 2 * v["ay"] * (y - 17 / 12))) / v["ay"]
    bar = [r + v[f"a{k}"] * t_f / 2 for r, k in zip(rel, "xyz", strict=True)]
    speed = math.hypot(*bar)
    unit = [b / speed for b in bar]
    spin_unit = [v[f"spin{k}"] / w for k in "xyz"]
    cross = [
        spin_unit[1] * unit[2] - spin_unit[2] * unit[1],
        spin_unit[2] * unit[0] - spin_unit[0] * unit[2],
        spin_unit[0] * unit[1] - spin_unit[1] * unit[0],
    ]
    return {"spin_rate": w, "tF": t_f, "vbar": speed, "spin_eff": math.hypot(*cross)}


def test_spin_columns_by_hand(spark):
    got = spun(spark)
    for name, value in KNOWN.items():
        assert got[name] == pytest.approx(value, abs=5e-3 if value > 1 else 5e-5)
    for name, value in by_hand(GOOD).items():
        assert got[name] == pytest.approx(value, rel=1e-12)
    assert all(got[c] is not None for c in spin.SPIN_COLUMNS)
    assert got["MT"] ** 2 == pytest.approx(got["MTx"] ** 2 + got["MTz"] ** 2)
    assert got["MMx"] + got["MNx"] == pytest.approx(got["MTx"])


@pytest.mark.parametrize(
    "changes",
    [
        {"ay": None},
        {"vx0": ""},
        {"spinz": "junk"},
        {"spinx": "0", "spiny": "0", "spinz": "0"},
        {"ay": "0"},
        {"ay": "-3000"},
        {"ay": "500"},
        # spin along the flight line has no cross product
        {"vx0": "0", "vz0": "0", "ax": "0", "az": "0", "spinx": "0", "spiny": "-2000", "spinz": "0"},
    ],
)
def test_spin_guards_blank_everything(spark, changes):
    got = spun(spark, **changes)
    assert [got[c] for c in spin.SPIN_COLUMNS] == [None] * len(spin.SPIN_COLUMNS)
    assert got["release_extension"] == "6.5"


@pytest.mark.parametrize(
    "changes",
    [
        {"vx0": "0", "vy0": "0", "vz0": "0"},
        {"vx0": "10", "vy0": "0", "vz0": "0", "ax": "1", "ay": "0", "az": "-32.174"},
    ],
)
def test_unreachable_guards_with_no_flight_time(spark, monkeypatch, changes):
    monkeypatch.setattr(spin, "air_time", lambda *args, **kwargs: F.lit(0.0))
    got = spun(spark, **changes)
    assert [got[c] for c in spin.SPIN_COLUMNS] == [None] * len(spin.SPIN_COLUMNS)


def test_spin_stage_is_compiled_without_a_flag(spark):
    cells = F.lit("1.5")
    df = spark.range(3).select("id", *[F.concat(F.col("id").cast("string"), cells).alias(n) for n in spin.SPIN_INPUTS])
    plan = spin.add_spin_columns(df)._jdf.queryExecution().executedPlan()
    code = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package").codegenString(plan)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    # The JVM leaves methods over 8000 bytes to the interpreter.
    assert sizes and max(sizes) < 8000


def test_filter_on_spin_column_stays_above(spark):
    df = spark.createDataFrame([tuple(GOOD.values())], ", ".join(f"{k} string" for k in GOOD))
    assert spin.add_spin_columns(df).where("vbar > 100 AND MN > 0").count() == 1


def test_name_text(spark):
    df = spark.createDataFrame([("Mike", "Trout"), (None, "Trout"), ("", "")], "f string, l string")
    assert [r[0] for r in df.select(text.full_name("f", "l")).collect()] == ["mike trout", "trout", ""]
    assert df.where(text.name_matches("E TRO", "f", "l")).count() == 1
    assert df.select(F.count_if(text.blank_to_null("f").isNull())).first()[0] == 2


def test_to_float_agrees_with_python_on_random_cells(spark):
    import random

    random.seed(5)
    parts = ["0", "1", "42", ".", "e", "E", "+", "-", "_", " ", "d", "f", "x", "inf", "nan", "Infinity", "1_0", "\t", "NaN"]
    cells = sorted({"".join(random.choices(parts, k=random.randint(1, 5))) for _ in range(4000)})

    def python(cell):
        try:
            return float(cell)
        except ValueError:
            return None

    got = one_column(spark, cells, text.to_float("c"))
    wrong = [
        (c, g, python(c)) for c, g in zip(cells, got, strict=True) if repr(g) != repr(python(c))
    ]
    assert wrong == []


def test_clock_agrees_with_python_on_many_axes(spark):
    def python(axis):
        total = axis % 360.0 / 360.0 * 12 * 60
        hour = int(total // 60) % 12 or 12
        minute = round(total - (total // 60) * 60)
        if minute == 60:
            hour, minute = hour % 12 + 1, 0
        return f"{hour}:{minute:02d}"

    axes = [i * 0.25 - 400 for i in range(4000)]
    assert one_column(spark, axes, spin.axis_to_clock("c"), "double") == [python(a) for a in axes]
