"""Normals of point clouds: the direction in which a point's neighbours spread least.

Neighbours are found by a join of grid cells as wide as the radius; each point keeps its nearest `most`. Their covariance is an
aggregation, its smallest eigenvector a closed form of Columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanloom.functions import geo

RADIUS = 0.05
MOST = 30
ENTRIES = ("xx", "xy", "xz", "yy", "yz", "zz")


def neighbours(points: DataFrame, radius: float = RADIUS, most: int = MOST) -> DataFrame:
    """(id, x, y, z) of each neighbour of a point, itself included: its nearest `most` within the radius (inclusive), ties to the
    smaller id. points: id, x, y, z."""
    place = [F.floor(F.col(a) / radius).alias(f"c{a}") for a in "xyz"]
    cells = points.select("id", "x", "y", "z", *place)
    around = F.array(*[F.struct(*[F.lit(d).alias(n) for d, n in zip((i, j, k), "ijk")]) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    asking = cells.withColumn("d", F.explode(around))
    asking = asking.select(
        F.col("id").alias("of"), *[F.col(a).alias(f"q{a}") for a in "xyz"],
        *[(F.col(f"c{a}") + F.col("d")[n]).alias(f"c{a}") for a, n in zip("xyz", "ijk")]
    )
    square = sum((F.col(a) - F.col(f"q{a}")) ** 2 for a in "xyz")
    near = asking.join(cells, ["cx", "cy", "cz"]).withColumn("s", square).filter(F.col("s") <= radius * radius)
    place = F.row_number().over(Window.partitionBy("of").orderBy("s", "id"))
    return near.withColumn("k", place).filter(F.col("k") <= most).select(F.col("of").alias("id"), "x", "y", "z")


def covariances(points: DataFrame, radius: float = RADIUS, most: int = MOST) -> DataFrame:
    """(id, n, xx, xy, xz, yy, yz, zz): neighbours and their population covariance."""
    pairs = [F.covar_pop(a, b).alias(a + b) for i, a in enumerate("xyz") for b in "xyz"[i:]]
    return neighbours(points, radius, most).groupBy("id").agg(F.count("*").alias("n"), *pairs)


def smallest_eigenvector(df: DataFrame, out: str) -> DataFrame:
    """df with `out`: the unit eigenvector of the smallest eigenvalue of the symmetric matrix in columns xx .. zz; null where the two
    smallest are equal, as points on a line have it. In steps, so that nothing is computed twice."""
    scale = F.greatest(*[F.abs(F.col(c)) for c in ENTRIES])
    df = df.withColumn("_size", F.when(scale > 0, scale))
    df = df.withColumns({f"_{c}": F.col(c) / F.col("_size") for c in ENTRIES})
    xx, xy, xz, yy, yz, zz = (F.col(f"_{c}") for c in ENTRIES)
    df = df.withColumn("_m", (xx + yy + zz) / 3)
    m = F.col("_m")
    df = df.withColumn("_p", F.sqrt(((xx - m) ** 2 + (yy - m) ** 2 + (zz - m) ** 2 + 2 * (xy**2 + xz**2 + yz**2)) / 6))
    half = ((xx - m) * ((yy - m) * (zz - m) - yz * yz) - xy * (xy * (zz - m) - yz * xz) + xz * (xy * yz - (yy - m) * xz)) / 2
    safe = F.when(F.col("_p") > 0, F.col("_p"))
    df = df.withColumn("_c", F.least(F.greatest(half / safe**3, F.lit(-1.0)), F.lit(1.0)))
    df = df.withColumn("_low", m + 2 * F.col("_p") * F.cos(F.acos("_c") / 3 + 2 * math.pi / 3))
    low = F.col("_low")
    rows = ((xx - low, xy, xz), (xy, yy - low, yz), (xz, yz, zz - low))
    crosses = [geo.cross(rows[i], rows[j]) for i, j in ((0, 1), (0, 2), (1, 2))]
    df = df.withColumn("_v", F.array(*[F.struct(geo.norm(v).alias("n"), *[c.alias(a) for c, a in zip(v, "xyz")]) for v in crosses]))
    df = df.withColumn("_v", F.array_max("_v"))
    unit = F.array(*[F.col("_v")[a] / F.col("_v")["n"] for a in "xyz"])
    df = df.withColumn(out, F.when(F.col("_v")["n"] > 1e-6, unit))
    return df.drop("_size", *[f"_{c}" for c in ENTRIES], "_m", "_p", "_c", "_low", "_v")


def normals(points: DataFrame, sensor: tuple[float, float, float] = (0.0, 0.0, 0.0), radius: float = RADIUS, most: int = MOST) -> DataFrame:
    """(id, n, normal): normals turned towards the sensor; null for points with fewer than three neighbours or neighbours on a
    line."""
    found = smallest_eigenvector(covariances(points, radius, most), "v").join(points.select("id", *[F.col(a).alias(f"p{a}") for a in "xyz"]), "id")
    v = geo.of_array(F.col("v"), 3)
    to: list[Column] = [F.lit(s) - F.col(f"p{a}") for s, a in zip(sensor, "xyz")]
    sign = F.when(geo.dot(v, to) < 0, -1.0).otherwise(1.0)
    return found.select("id", "n", F.when(F.col("v").isNotNull() & (F.col("n") >= 3), F.array(*[c * sign for c in v])).alias("normal"))
