"""Guards of the composite queries, and offsets by velocities."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.functions.calibration import IDENTITY, NO_SHIFT, Calibration
from scanloom.operators import commands, velocity

FLAT = Calibration(rotation=IDENTITY, shift=NO_SHIFT)


def curve(spark, t, x):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(t, x)], "t double, x double")


def test_guards(spark):
    few, enough = (curve(spark, np.arange(n) * 0.1, np.sin(np.arange(n))) for n in (14, 15))
    with pytest.raises(ValueError, match="14 camera detections"):
        commands.measure_tau(few, enough)
    with pytest.raises(ValueError, match="14 LiDAR detections"):
        commands.measure_tau(enough, few)
    assert commands.measure_tau(enough, enough).filter("part = 'all'").first()["tau"] == pytest.approx(0, abs=1e-9)
    odom = spark.createDataFrame([], "ns long, seq long, quat array<double>, pos array<double>")
    with pytest.raises(ValueError, match="odometry"):
        commands.match_recording(odom, spark.createDataFrame([(1, 5)], "idx long, ns long"))
    samples = spark.createDataFrame([(i, i * 1000) for i in range(9)], "seq long, us long")
    with pytest.raises(ValueError, match="9 inertial samples"):
        commands.imu_health(samples, "seq", "us")


def test_the_view_of_a_render_is_clamped(spark):
    one = [float(i % 4 == 0) for i in range(9)]
    v = spark.createDataFrame([(0, -1.0, -1.0, 3.0), (1, 1.0, -1.0, 3.0), (2, -1.0, 1.0, 3.0)], "vid long, x double, y double, z double")
    f = spark.createDataFrame([(0, 0, 1, 2)], "fid long, i0 long, i1 long, i2 long")
    images = spark.createDataFrame([(7, one, [0.0, 0.0, 0.0]), (9, one, [0.3, 0.0, 0.0])], "idx long, r array<double>, t array<double>")
    pixels = {k: {(r["yy"], r["xx"]) for r in commands.texture_bridge(f, v, images, FLAT, k, 16).collect()} for k in (0, 1, 2, -1)}
    assert pixels[0] == pixels[2] == pixels[-1] != pixels[1] and pixels[1]
    with pytest.raises(ValueError, match="matched images"):
        commands.texture_bridge(f, v, images.limit(0), FLAT)


def test_velocities_find_the_offset_and_refuse_a_flat_peak(spark):
    rng = np.random.default_rng(4)
    knots = np.cumsum(rng.normal(0, 1, 400))  # a jerky motion, whose velocity is like itself for a moment only
    motion = lambda t: np.interp(t, np.arange(400) * 0.05, knots)
    t = np.arange(0.5, 18, 0.02)
    camera = curve(spark, t, motion(t))
    lidar = curve(spark, t, 3 * motion(t - 0.12) + 40)
    got = velocity.velocity_offset(camera, lidar).first()
    assert got["tau"] == pytest.approx(0.12, abs=0.011) and got["accepted"] and got["width"] < 0.1 and got["corr"] > 0.9
    slow = lambda t: np.sin(0.3 * t)
    flat = velocity.velocity_offset(curve(spark, t, slow(t)), curve(spark, t, slow(t - 0.1))).first()
    assert not flat["accepted"]
    assert not velocity.velocity_offset(camera, lidar.limit(0)).first()["accepted"]


def test_velocities_equal_numpy(spark):
    t = np.sort(np.random.default_rng(1).uniform(0, 3, 40))
    x = np.cos(3 * t)
    got = {r["k"]: r["v"] for r in velocity.velocities(curve(spark, t, x), 0.05).collect()}
    k = np.arange(int(np.ceil(t[0] / 0.05 - 1e-9)), int(np.ceil(t[-1] / 0.05 - 1e-9)))
    want = np.diff(np.interp(k * 0.05, t, x)) / 0.05
    assert list(sorted(got)) == k[:-1].tolist() and [got[i] for i in sorted(got)] == pytest.approx(want)
