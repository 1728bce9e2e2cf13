"""Spin axis to clock face, time in air, and the spin-physics columns (Nathan 2021)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.functions.text import as_col, number, to_float

# Fixed values of the flight model (ft, s, in).
DRAG_K = 0.005383
GRAVITY = 32.174
MOUND_FT = 60.5
MEASURED_AT_FT = 50.0
PLATE_FT = 17.0 / 12.0
CIRCUMFERENCE_IN = 9.125
HILL_A = 0.4152
HILL_B = 0.1904
HILL_N = 1.401

# Fixed names: the input columns and, in order, the derived ones.
SPIN_INPUTS = (
    "release_extension", "vx0", "vy0", "vz0", "ax", "ay", "az", "spinx", "spiny", "spinz",
)
SPIN_COLUMNS = (
    "spin_rate", "release_pos_y", "tR", "vxR", "vyR", "vzR", "tF", "vxbar", "vybar", "vzbar",
    "vbar", "vx_hat", "vy_hat", "vz_hat", "aD", "aTx", "aTy", "aTz", "aT", "aTx_hat",
    "aTy_hat", "aTz_hat", "phiT", "MTx", "MTz", "MT", "wx_hat", "wy_hat", "wz_hat",
    "spin_eff", "aLx_hat", "aLy_hat", "aLz_hat", "phiL", "axis_shift", "L_align", "ML", "MS",
    "MLx", "MLz", "MSx", "MSz", "phiS", "S", "aMx_hat", "aMy_hat", "aMz_hat", "phiM", "eff_S",
    "CL", "aM", "M_prop", "MM", "MMx", "MMz", "MNx", "MNz", "MN", "phiN",
)


def axis_to_clock(c: Column | str, numeric: bool = True) -> Column:
    """Axis in degrees to a clock face such as ``1:30``; minutes round half to even."""
    degrees = as_col(c) if numeric else to_float(c)
    turn = F.pmod(degrees, F.lit(360.0))
    total = F.when(~F.isnan(turn), turn) / 360.0 * 12 * 60
    hour = F.floor(total / 60)
    minute = F.bround(total - hour * 60, 0).cast("int")
    rolled = F.when(minute == 60, hour + 1).otherwise(hour) % 12
    face = F.when(rolled == 0, F.lit(12)).otherwise(rolled).cast("int")
    return F.concat(
        face.cast("string"), F.lit(":"), F.lpad((minute % 60).cast("string"), 2, "0")
    )


def air_time(velocity: Column, acceleration: Column, distance: Column, forward: bool) -> Column:
    """Root of the flight quadratic; NULL for a negative discriminant or no acceleration."""
    sign = 1.0 if forward else -1.0
    disc = velocity * velocity - acceleration * distance * (2.0 * sign)
    return F.when(disc >= 0, F.try_divide(-velocity - F.sqrt(disc), acceleration))


def _norm(*parts: Column) -> Column:
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    return F.sqrt(total)


def _angle(z: Column, x: Column) -> Column:
    return F.degrees(F.atan2(z, x))


def _positive(c: Column) -> Column:
    """NULL instead of zero, so a failed guard empties everything built on it."""
    return F.when(c != 0, c)


def apart(layer: dict[str, Column], through: str) -> dict[str, Column]:
    """A wide layer whose column ``through`` passes a lambda, which changes no value.

    Spark fuses no projection with a lambda into the stage's one method: it generates it as many small
    methods instead. The fused one was beyond the size the JVM compiles and ran interpreted.
    """
    return {**layer, through: F.transform(F.array(layer.get(through, F.col(through))), lambda x: x)[0]}


def add_spin_columns(df: DataFrame, columns: Sequence[str] = SPIN_COLUMNS) -> DataFrame:
    """``df`` plus the derived columns (all 59, or those named); NULL where a guard fails.

    Layers follow the data flow, one projection each, so no layer is recomputed. A failed
    guard turns into NULL and travels down to ``CL``; the last projection blanks the whole
    set by that one column. No shuffle and no Python. The closing one-row ``inline`` keeps
    a filter on a derived column above the layers: pushed through them it would repeat
    every formula once per use.
    """
    c = F.col
    keep = [n for n in df.columns if n not in SPIN_COLUMNS]
    raw = {f"_{n}": number(df, n) for n in SPIN_INPUTS}
    e, vx, vy, vz, ax, ay, az, sx, sy, sz = (c(f"_{n}") for n in SPIN_INPUTS)
    start = F.lit(MOUND_FT) - e
    vyr = vy + ay * c("tR")
    bars = {k: (c(f"v{k}R") * 2 + a * c("tF")) / 2 for k, a in (("x", ax), ("y", ay), ("z", az))}
    vbar = _positive(_norm(*bars.values()))
    drag = -(ax * c("vx_hat") + ay * c("vy_hat") + (az + GRAVITY) * c("vz_hat"))
    cross = {
        "x": c("wy_hat") * c("vz_hat") - c("wz_hat") * c("vy_hat"),
        "y": c("wz_hat") * c("vx_hat") - c("wx_hat") * c("vz_hat"),
        "z": c("wx_hat") * c("vy_hat") - c("wy_hat") * c("vx_hat"),
    }
    half_square = c("tF") * c("tF")
    thrust = _positive(_norm(c("aTx"), c("aTy"), c("aTz")))
    eff = c("spin_eff")
    s_pow = F.pow(c("S"), F.lit(HILL_N))
    lift_x, lift_z = c("aLx_hat") * c("ML"), c("aLz_hat") * c("ML")
    magnus = c("MT") * c("M_prop")
    magnus_x = magnus * F.cos(F.radians(c("phiM")))
    magnus_z = magnus * F.sin(F.radians(c("phiM")))

    layers: list[dict[str, Column]] = [
        raw,
        {
            "spin_rate": _positive(_norm(sx, sy, sz)),
            "release_pos_y": start,
            "tR": air_time(vy, ay, start - MEASURED_AT_FT, forward=False),
        },
        {
            "vxR": vx + ax * c("tR"),
            "vyR": vyr,
            "vzR": vz + az * c("tR"),
            "tF": air_time(vyr, ay, c("release_pos_y") - PLATE_FT, forward=True),
            **{f"w{k}_hat": s / c("spin_rate") for k, s in (("x", sx), ("y", sy), ("z", sz))},
        },
        {
            **{f"v{k}bar": bar for k, bar in bars.items()},
            "vbar": vbar,
            **{f"v{k}_hat": bar / vbar for k, bar in bars.items()},
        },
        {
            "aD": drag,
            "aTx": ax + drag * c("vx_hat"),
            "aTy": ay + drag * c("vy_hat"),
            "aTz": az + drag * c("vz_hat") + GRAVITY,
            **{f"_c{k}": v for k, v in cross.items()},
            "spin_eff": _positive(_norm(*cross.values())),
            "S": c("spin_rate") * CIRCUMFERENCE_IN / (c("vbar") * 720),
        },
        {
            "aT": thrust,
            **{f"aT{k}_hat": c(f"aT{k}") / thrust for k in "xyz"},
            **{f"a{m}{k}_hat": c(f"_c{k}") / eff for m in "LM" for k in "xyz"},
            "MTx": c("aTx") * 0.5 * half_square * 12.0,
            "MTz": c("aTz") * 0.5 * half_square * 12.0,
            "eff_S": c("S") * eff,
            "CL": s_pow * HILL_A / (s_pow + HILL_B**HILL_N) * eff,
        },
        {
            "phiT": _angle(c("aTz_hat"), c("aTx_hat")),
            "phiL": _angle(c("aLz_hat"), c("aLx_hat")),
            "MT": _norm(c("MTx"), c("MTz")),
            "L_align": c("aTx_hat") * c("aLx_hat")
            + c("aTy_hat") * c("aLy_hat")
            + c("aTz_hat") * c("aLz_hat"),
            "aM": c("CL") * DRAG_K * (c("vbar") * c("vbar")),
        },
        {
            "axis_shift": c("phiT") - c("phiL"),
            "phiM": c("phiL"),
            "ML": c("MT") * c("L_align"),
            "M_prop": c("aM") / c("aT"),
        },
        {
            "MS": F.sqrt(F.greatest(c("MT") * c("MT") - c("ML") * c("ML"), F.lit(0.0))),
            "MLx": lift_x,
            "MLz": lift_z,
            "MSx": c("MTx") - lift_x,
            "MSz": c("MTz") - lift_z,
            "MM": magnus,
            "MMx": magnus_x,
            "MMz": magnus_z,
            "MNx": c("MTx") - magnus_x,
            "MNz": c("MTz") - magnus_z,
        },
        {
            "phiS": _angle(c("MSz"), c("MSx")),
            "MN": _norm(c("MNx"), c("MNz")),
            "phiN": _angle(c("MNz"), c("MNx")),
        },
    ]
    out = df.drop(*SPIN_COLUMNS)
    for n, layer in enumerate(layers):
        # A column that later layers or the result still need.
        out = out.withColumns(apart(layer, "_ax" if n < 4 else "spin_rate"))
    solved = c("M_prop").isNotNull()
    result = F.struct(*[F.when(solved, c(n)).alias(n) for n in columns])
    return out.select(*keep, F.inline(F.transform(F.array(result), lambda x: x)))
