"""The composite queries with the guards that their users rely on: each stops with a ValueError that says what is missing, before the dear part
runs. Guards look at as many rows as they need only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.functions.calibration import Calibration
from scanloom.operators import asof, imu, tau, texture
from scanloom.sources.messages import at_least

#: Least detections of either sensor, and least inertial samples. Fixed values.
DETECTIONS, SAMPLES = 15, 10


def measure_tau(camera: DataFrame, lidar: DataFrame, **grid) -> DataFrame:
    """Time offset of a recording and of its halves; needs 15 detections of each sensor. Curves: t, x."""
    return tau.shift_with_halves(at_least(camera, DETECTIONS, "camera detections"), at_least(lidar, DETECTIONS, "LiDAR detections"), **grid)


def match_recording(odometry: DataFrame, images: DataFrame, max_gap_s: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Poses of images; needs odometry. No image is no error: the result is empty."""
    return asof.match_poses(at_least(odometry, 1, "odometry messages"), images, max_gap_s, by)


def imu_health(samples: DataFrame, order: str, us: str, gap_ms: float = 10.0) -> DataFrame:
    """Health of an inertial sensor; needs 10 samples that could be decoded."""
    return imu.health(at_least(samples, SAMPLES, "inertial samples"), order, us, gap_ms)


def texture_bridge(faces: DataFrame, vertices: DataFrame, images: DataFrame, cal: Calibration, view: int = 0, shrink: int = 2) -> DataFrame:
    """A render of the mesh from the pose of image number `view`, in order of idx; a number beyond the images is the first. Needs a matched
    image."""
    at_least(images, 1, "matched images")
    first = images.agg(F.min("idx")).first()[0]
    shown = images.orderBy("idx").select("idx").limit(view + 1).agg(F.count("*").alias("n"), F.max("idx").alias("idx")).first() if view >= 0 else None
    chosen = shown["idx"] if shown and shown["n"] == view + 1 else first
    assignment = texture.best_images(faces, vertices, images, cal)
    return texture.render(faces, vertices, assignment, images, cal, chosen, shrink)
