"""Geometry as Column expressions. Vectors are tuples of three Columns, quaternions of four (x, y, z, w), matrices
of three rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.functions.calibration import Calibration

Vec = Sequence[Column]


def lit3(v: Sequence[float]) -> tuple[Column, ...]:
    return tuple(F.lit(float(x)) for x in v)


def cols(*names: str) -> tuple[Column, ...]:
    return tuple(F.col(n) for n in names)


def of_array(a: Column, n: int) -> tuple[Column, ...]:
    return tuple(a[i].cast("double") for i in range(n))


def add(a: Vec, b: Vec) -> tuple[Column, ...]:
    return tuple(x + y for x, y in zip(a, b))


def sub(a: Vec, b: Vec) -> tuple[Column, ...]:
    return tuple(x - y for x, y in zip(a, b))


def dot(a: Vec, b: Vec) -> Column:
    out = a[0] * b[0]
    for x, y in zip(a[1:], b[1:]):
        out = out + x * y
    return out


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def scale(a: Vec, s: Column) -> tuple[Column, ...]:
    return tuple(x * s for x in a)


def cross(a: Vec, b: Vec) -> tuple[Column, ...]:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def finite(*values: Column) -> Column:
    out = F.lit(True)
    for v in values:
        out = out & v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return out


def round_signed(x: Column, places: int) -> Column:
    """Half away from zero, with the sign of what is rounded: Spark's own gives 0.0 for -0.0 and small negative values, SQL engines and numpy -0.0."""
    return F.round(F.abs(x), places) * F.signum(x)


# Rigid transforms


def rotate(r: Sequence[Sequence], p: Vec) -> tuple[Column, ...]:
    return tuple(dot([c if isinstance(c, Column) else F.lit(float(c)) for c in row], p) for row in r)


def transpose(r: Sequence[Sequence]) -> tuple[tuple, ...]:
    return tuple(zip(*r))


def transform(r: Sequence[Sequence], t: Sequence, p: Vec) -> tuple[Column, ...]:
    return add(rotate(r, p), [c if isinstance(c, Column) else F.lit(float(c)) for c in t])


def multiply(a: Sequence[Sequence], b: Sequence[Sequence]) -> tuple[tuple[Column, ...], ...]:
    """Matrix product; entries may be numbers or Columns."""
    as_col = lambda c: c if isinstance(c, Column) else F.lit(float(c))
    return tuple(tuple(dot([as_col(x) for x in row], [as_col(x) for x in col]) for col in transpose(b)) for row in a)


def world_to_camera(cal: Calibration, r_world: Sequence[Sequence], t_world: Sequence) -> tuple[tuple, tuple]:
    """(R, t) that take world points to the camera, from the sensor's pose in the world."""
    r = multiply(cal.rotation, transpose(r_world))
    return r, sub(lit3(cal.shift), rotate(r, t_world))


def camera_in_map(cal: Calibration, r_map: Sequence[Sequence], t_map: Sequence) -> tuple[tuple, tuple]:
    """(R, t) of the camera in the map, from the sensor's pose in the map."""
    back = transpose(cal.rotation)
    centre = [-dot(lit3(row), lit3(cal.shift)) for row in back]
    return multiply(r_map, back), add(rotate(r_map, centre), t_map)


# Quaternions


def quat_unit(q: Vec) -> tuple[Column, ...]:
    """The unit quaternion; raises for one of norm below 1e-12."""
    n = norm(q)
    safe = F.when(n < 1e-12, F.raise_error(F.lit("quaternion of zero length")).cast("double")).otherwise(n)
    return tuple(x / safe for x in q)


def with_unit(df: DataFrame, quat: str, out: str) -> DataFrame:
    """`out`: the unit quaternion of an array column. In steps, so that the norm is computed once."""
    df = df.withColumn("_norm", norm(of_array(F.col(quat), 4)))
    safe = F.when(F.col("_norm") < 1e-12, F.raise_error(F.lit("quaternion of zero length")).cast("double")).otherwise(F.col("_norm"))
    return df.withColumn("_norm", safe).withColumn(
        out, F.when(F.col(quat).isNotNull(), F.array(*[F.col(quat)[i] / F.col("_norm") for i in range(4)]))
    ).drop("_norm")


def with_slerp(df: DataFrame, a: str, b: str, u: str, out: str) -> DataFrame:
    """`out`: the quaternion from a to b (arrays, unit) along the shorter arc at u; linear where they are closer than
    1e-12. In steps, as one expression would repeat its terms many times over."""
    qa, qb = of_array(F.col(a), 4), of_array(F.col(b), 4)
    df = df.withColumn("_dot", dot(qa, qb)).withColumn("_sign", F.when(F.col("_dot") < 0, -1.0).otherwise(1.0)).withColumn("_dot", F.abs("_dot"))
    df = df.withColumn(
        "_angle", F.atan2(norm(sub(scale(qb, F.col("_sign")), scale(qa, F.col("_dot")))), F.col("_dot"))
    ).withColumn("_sin", F.sin("_angle"))
    near, safe = F.col("_sin") < 1e-12, F.when(F.col("_sin") < 1e-12, 1.0).otherwise(F.col("_sin"))
    df = df.withColumn("_wa", F.when(near, 1 - F.col(u)).otherwise(F.sin((1 - F.col(u)) * F.col("_angle")) / safe))
    df = df.withColumn("_wb", F.when(near, F.col(u)).otherwise(F.sin(F.col(u) * F.col("_angle")) / safe) * F.col("_sign"))
    df = df.withColumn("_mixed", F.array(*add(scale(qa, F.col("_wa")), scale(qb, F.col("_wb")))))
    df = df.withColumn("_mixed", F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col("_mixed")))
    return with_unit(df, "_mixed", out).drop("_dot", "_sign", "_angle", "_sin", "_wa", "_wb", "_mixed")


def lerp(a: Vec, b: Vec, u: Column) -> tuple[Column, ...]:
    return tuple(x + u * (y - x) for x, y in zip(a, b))


def quat_matrix(q: Vec) -> tuple[tuple[Column, ...], ...]:
    x, y, z, w = q
    return (
        (1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)),
        (2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)),
        (2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)),
    )


def matrix_quat(m: Sequence[Sequence[Column]]) -> tuple[Column, ...]:
    """The quaternion of a rotation matrix, from its largest component, with w >= 0 or the largest positive."""
    (a, b, c), (d, e, f), (g, h, i) = m
    trace = a + e + i
    four = {
        "w": (trace, (h - f, c - g, d - b, 1 + trace)),
        "x": (a - e - i, (1 + a - e - i, b + d, c + g, h - f)),
        "y": (e - a - i, (b + d, 1 + e - a - i, f + h, c - g)),
        "z": (i - a - e, (c + g, f + h, 1 + i - a - e, d - b)),
    }
    best = F.greatest(*[k for k, _ in four.values()])
    rows = list(four.values())
    out = []
    for j in range(4):
        pick = F.when(rows[0][0] == best, rows[0][1][j])
        for key, row in rows[1:]:
            pick = pick.when(key == best, row[j])
        out.append(pick)
    return quat_unit(out)


def axis_angle_matrix(axis: Vec, angle: Column) -> tuple[tuple[Column, ...], ...]:
    n = norm(axis)
    x, y, z = (c / n for c in axis)
    s, c = F.sin(angle), F.cos(angle)
    k = 1 - c
    return (
        (c + x * x * k, x * y * k - z * s, x * z * k + y * s),
        (y * x * k + z * s, c + y * y * k, y * z * k - x * s),
        (z * x * k - y * s, z * y * k + x * s, c + z * z * k),
    )


# Cameras


def pinhole(cal: Calibration, p: Vec) -> tuple[Column, Column]:
    return (cal.fx * p[0] + cal.cx * p[2]) / p[2], (cal.fy * p[1] + cal.cy * p[2]) / p[2]


def project(cal: Calibration, p: Vec) -> tuple[Column, Column]:
    """Pixel of a camera point with radial and tangential distortion."""
    k1, k2, p1, p2, k3 = cal.distortion
    x, y = p[0] / p[2], p[1] / p[2]
    r2 = x * x + y * y
    radial = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
    xd = x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x)
    yd = y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y
    return cal.fx * xd + cal.cx, cal.fy * yd + cal.cy


def pixel(cal: Calibration, p: Vec) -> Column:
    """struct(u, v, z, inside) of a camera point; null for points not in front.

    Binds its steps as lambda variables: as one expression the point's own terms would be repeated dozens of times, and again in
    each filter that is pushed below."""
    point = F.array(F.struct(p[0].alias("x"), p[1].alias("y"), p[2].alias("z")))
    plane = F.transform(
        point,
        lambda q: F.when(q["z"] > 0, F.struct((q["x"] / q["z"]).alias("x"), (q["y"] / q["z"]).alias("y"), F.lit(1.0).alias("w"), q["z"].alias("z")))
    )
    bent = F.transform(
        plane,
        lambda n: F.when(n.isNotNull(), F.struct(*[c.alias(a) for c, a in zip(project(cal, (n["x"], n["y"], n["w"])), "uv")], n["z"].alias("z")))
    )
    return F.transform(
        bent,
        lambda m: F.when(
            m.isNotNull(),
            F.struct(m["u"].alias("u"), m["v"].alias("v"), m["z"].alias("z"), in_frame(cal, m["u"], m["v"]).alias("inside"))
        )
    )[0]


def in_frame(cal: Calibration, u: Column, v: Column) -> Column:
    return (u >= 0) & (u < cal.width) & (v >= 0) & (v < cal.height)


def in_frame_rounded(cal: Calibration, u: Column, v: Column) -> Column:
    """After rounding half to even."""
    return in_frame(cal, F.rint(u), F.rint(v))


def texel(x: Column, size: int) -> Column:
    """Clamped, then truncated. A millionth of a pixel is added, so that rounding doesn't decide where a texel lies on a whole number."""
    return F.least(F.greatest((x + 1e-6).cast("int"), F.lit(0)), F.lit(size - 1))


def pack_rgb(r: Column, g: Column, b: Column) -> Column:
    """0xFF, r, g, b in one number."""
    return F.lit(0xFF << 24).cast("long") + F.shiftleft(r.cast("long"), 16) + F.shiftleft(g.cast("long"), 8) + b.cast("long")


def depth_colour(d: Column, low: Column, high: Column, steady: bool = False) -> tuple[Column, Column, Column]:
    """Blue, green, red of a depth between low and high. With `steady` to six places before they are truncated, so that the last bits of a
    depth don't decide."""
    ratio = (d - low) / F.greatest(high - low, F.lit(1e-3))
    cut = (lambda x: ((x * 1e6 + 0.5).cast("long") / 1e6).cast("int")) if steady else (lambda x: x.cast("int"))
    return cut(255 * ratio), F.lit(0), cut(255 * (1 - ratio))


def face_normal(a: Vec, b: Vec, c: Vec) -> tuple[Column, ...]:
    n = cross(sub(b, a), sub(c, a))
    length = norm(n) + 1e-12
    return tuple(x / length for x in n)


def barycentric(p0: Vec, p1: Vec, p2: Vec, x: Column, y: Column, d: Column) -> tuple[Column, Column, Column]:
    """Weights of the corners at (x, y); d is `barycentric_base`."""
    a = ((p1[1] - p2[1]) * (x - p2[0]) + (p2[0] - p1[0]) * (y - p2[1])) / d
    b = ((p2[1] - p0[1]) * (x - p2[0]) + (p0[0] - p2[0]) * (y - p2[1])) / d
    return a, b, 1 - a - b


def barycentric_base(p0: Vec, p1: Vec, p2: Vec) -> Column:
    return (p1[1] - p2[1]) * (p0[0] - p2[0]) + (p2[0] - p1[0]) * (p0[1] - p2[1])


# Stamps


def seconds(sec: Column, nanosec: Column) -> Column:
    return sec.cast("double") + nanosec.cast("double") * 1e-9


def nanoseconds(sec: Column, nanosec: Column) -> Column:
    return sec.cast("long") * 1_000_000_000 + nanosec.cast("long")
