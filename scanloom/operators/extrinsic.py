"""LiDAR-to-camera transform from planes that both sensors see: rotation from their normals, translation from their centroids.

The sums of outer products are an aggregation with map-side combine; only its one row of 16 numbers reaches the driver, for the
decomposition of a 3 x 3 matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.functions import geo

#: Below this share of the largest singular value the second one counts as none: all normals are parallel.
PARALLEL = 1e-6


def outer_sums(planes: DataFrame) -> DataFrame:
    """One row: n, h (sums of the products of LiDAR and camera normals, by row), and the mean centroids a and b. planes: n_lidar, c_lidar,
    n_cam, c_cam, arrays of three. Normals are scaled to one and turned towards their sensor first."""

    def turned(n: str, c: str) -> list:
        v, at = geo.of_array(F.col(n), 3), geo.of_array(F.col(c), 3)
        sign = F.when(geo.dot(v, at) > 0, -1.0).otherwise(1.0)
        return [x * sign / geo.norm(v) for x in v]

    held = planes.select(F.array(*turned("n_lidar", "c_lidar")).alias("p"), F.array(*turned("n_cam", "c_cam")).alias("q"), "c_lidar", "c_cam")
    sums = [F.sum(F.col("p")[i] * F.col("q")[j]) for i in range(3) for j in range(3)]
    mean = lambda c: F.array(*[F.avg(F.col(c)[i]) for i in range(3)])
    return held.agg(F.count("*").alias("n"), F.array(*sums).alias("h"), mean("c_lidar").alias("a"), mean("c_cam").alias("b"))


def rotation_of(h: np.ndarray) -> np.ndarray:
    """The rotation R with the largest trace(R h); the guard turns a reflection into the nearest rotation."""
    u, s, vt = np.linalg.svd(h)
    if not s[0] > 0 or s[1] < PARALLEL * s[0]:
        raise ValueError("the planes' normals are parallel: they fix no rotation")
    guard = np.diag([1.0, 1.0, np.sign(np.linalg.det(vt.T @ u.T))])
    return vt.T @ guard @ u.T


def extrinsic(planes: DataFrame) -> DataFrame:
    """One row: n, r (rotation by row), t, and residual_deg, the mean angle between turned LiDAR normals and the camera's. Raises
    ValueError without two planes whose normals differ."""
    row = outer_sums(planes).first()
    if not row["n"]:
        raise ValueError("no planes")
    r = rotation_of(np.array(row["h"]).reshape(3, 3))
    t = np.array(row["b"]) - r @ np.array(row["a"])
    turned = geo.rotate(r.tolist(), geo.of_array(F.col("n_lidar"), 3))
    other = geo.of_array(F.col("n_cam"), 3)
    cosine = F.abs(geo.dot(turned, other)) / (geo.norm(turned) * geo.norm(other))
    angle = F.degrees(F.acos(F.least(cosine, F.lit(1.0))))
    out = planes.agg(F.count("*").alias("n"), F.avg(angle).alias("residual_deg"))
    literal = lambda x: F.array(*[F.lit(float(v)) for v in x])
    return out.select("n", literal(r.reshape(-1)).alias("r"), literal(t).alias("t"), "residual_deg")
