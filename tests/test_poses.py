"""A body that moves and turns at constant rates: interpolation must be exact."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.functions import geo
from scanloom.functions.calibration import Calibration
from scanloom.operators.asof import bracket, match_poses

P0, V, AXIS, RATE = np.array([-3, 0.25, 7]), np.array([-0.7, 0.55, 0.2]), np.array([1.0, -0.6, 0.4]), 0.35
AXIS = AXIS / np.linalg.norm(AXIS)


def quat(t):
    return [float(x) for x in (*(AXIS * math.sin(RATE * t / 2)), math.cos(RATE * t / 2))]


@pytest.fixture(scope="module")
def track(spark):
    stamps = sorted(set((np.random.default_rng(917).uniform(0, 8, 410) * 1e9).astype(int).tolist()))
    rows = [(i, ns, quat(ns / 1e9), (P0 + V * ns / 1e9).tolist()) for i, ns in enumerate(stamps)]
    return stamps, spark.createDataFrame(rows, "seq long, ns long, quat array<double>, pos array<double>")


def test_interpolation_is_exact(spark, track):
    stamps, odom = track
    times = np.random.default_rng(1).integers(stamps[0], stamps[-1], 200).tolist()
    got = match_poses(odom, spark.createDataFrame(list(enumerate(times)), "idx long, ns long")).collect()
    assert len(got) == 200 and all(r["ok"] for r in got)
    for r in got:
        t = r["ns"] / 1e9
        assert np.allclose([r["px"], r["py"], r["pz"]], P0 + V * t, atol=1e-9)
        assert abs(abs(np.dot([r["qx"], r["qy"], r["qz"], r["qw"]], quat(t))) - 1) < 1e-12


def test_exact_hit_span_and_gap(spark):
    odom = spark.createDataFrame(
        [(i, int(t * 1e9), [0.0, 0.0, 0.0, 2.0], [float(t), 0.0, 0.0]) for i, t in enumerate((0, 0.25, 3, 3.5))],
        "seq long, ns long, quat array<double>, pos array<double>"
    )
    shots = spark.createDataFrame([(0, -1), (1, 0), (2, 50_000_000), (3, 1_000_000_000), (4, 3_000_000_000), (5, 3_700_000_000)], "idx long, ns long")
    got = {r["idx"]: (r["reason"], r["ok"], r["px"], r["qw"]) for r in match_poses(odom, shots, 0.5).collect()}
    assert got[0][:2] == ("out of span", False) and got[5][:2] == ("out of span", False)
    assert got[1] == ("exact", True, 0.0, 1.0) and got[4] == ("exact", True, 3.0, 1.0)
    assert got[2][0] == "interp" and got[2][2] == pytest.approx(0.05)
    assert got[3][:3] == ("gap", False, None)


def test_queries_without_a_stamp_or_group_stay(spark):
    odom = spark.createDataFrame(
        [("a", 0, 0, [0.0, 0.0, 0.0, 1.0], [1.0, 0.0, 0.0]), (None, 1, 5, [0.0, 0.0, 0.0, 1.0], [2.0, 0.0, 0.0])],
        "run string, seq long, ns long, quat array<double>, pos array<double>"
    )
    shots = spark.createDataFrame([("a", 0, 0), ("a", 1, None), (None, 2, 5), ("b", 3, 5), (None, 4, None)], "run string, idx long, ns long")
    got = {r["idx"]: (r["ok"], r["reason"], r["px"]) for r in match_poses(odom, shots, by=["run"]).collect()}
    assert got == {0: (True, "exact", 1.0), 1: (False, "empty", None), 2: (True, "exact", 2.0), 3: (False, "empty", None), 4: (False, "empty", None)}


def test_empty_odometry_and_duplicate_stamps(spark):
    schema = "seq long, ns long, quat array<double>, pos array<double>"
    shots = spark.createDataFrame([(0, 5)], "idx long, ns long")
    assert match_poses(spark.createDataFrame([], schema), shots).collect()[0]["reason"] == "empty"
    twice = spark.createDataFrame([(1, 5, [0.0, 0.0, 0.0, 1.0], [2.0, 0.0, 0.0]), (0, 5, [0.0, 0.0, 0.0, 1.0], [1.0, 0.0, 0.0])], schema)
    assert match_poses(twice, shots).collect()[0]["px"] == 1.0


def test_both_covers_of_a_rotation_give_one_midpoint(spark):
    q = [0.0, 0.0, math.sin(0.1), math.cos(0.1)]
    df = spark.createDataFrame(
        [([0.0, 0.0, 0.0, 1.0], q, 0.5), ([0.0, 0.0, 0.0, 1.0], [-x for x in q], 0.5)],
        "a array<double>, b array<double>, u double"
    )
    one, two = (r["q"] for r in geo.with_slerp(df, "a", "b", "u", "q").collect())
    assert np.allclose(one, two) and one[2] == pytest.approx(math.sin(0.05))


def test_buckets_give_the_same_brackets(spark, track):
    _, odom = track
    shots = spark.range(0, 8_200_000_000, 37_000_000).select(F.col("id").alias("idx"), F.col("id").alias("ns"))
    of = lambda bucket: sorted((r["idx"], r["before"] and r["before"]["ns"], r["after"] and r["after"]["ns"]) for r in bracket(odom.select("ns", "seq"), shots, bucket=bucket).collect())
    assert of(10**12) == of(100_000_000) == of(7_000_000)


def test_camera_pose_is_the_inverse_of_world_to_camera(spark):
    cal = Calibration()
    df = spark.createDataFrame([([0.1, 0.2, 0.3, 0.9], [0.3, -1.0, 2.0])], "quat array<double>, t array<double>")
    df = geo.with_unit(df, "quat", "q")
    m, t = geo.quat_matrix(geo.of_array(F.col("q"), 4)), geo.of_array(F.col("t"), 3)
    r1, t1 = geo.world_to_camera(cal, m, t)
    r2, t2 = geo.camera_in_map(cal, m, t)
    p = geo.lit3((1.2, -0.4, 2.5))
    back = geo.transform(r2, t2, geo.transform(r1, t1, p))
    assert np.allclose(df.select(*back).collect()[0], (1.2, -0.4, 2.5), atol=1e-9)
    back = geo.quat_matrix(geo.matrix_quat(m))
    assert np.allclose(df.select(*[c for row in back for c in row]).collect()[0], df.select(*[c for row in m for c in row]).collect()[0], atol=1e-12)


def test_zero_quaternion_raises(spark):
    with pytest.raises(Exception, match="zero length"):
        geo.with_unit(spark.createDataFrame([([0.0, 0.0, 0.0, 0.0],)], "q array<double>"), "q", "u").collect()


def test_calibration_guard():
    with pytest.raises(ValueError, match="cx"):
        Calibration(cx=970.0)
    assert Calibration(paired_intrinsics="a.yaml").provenance_warning("/x/b.yaml") and not Calibration(paired_intrinsics="a.yaml").provenance_warning("/x/a.yaml")


def test_many_buckets_are_looked_at_once(spark):
    """Queries far beyond the samples, a bucket for each: a window that reaches to the last bucket would see all later ones again for each."""
    rng = np.random.default_rng(3)
    stamps, asked = np.unique(rng.integers(10**6, 10**8, 300)), rng.integers(0, 4 * 10**8, 20_000)
    samples = spark.createDataFrame([(int(t),) for t in stamps], "ns long")
    near = bracket(samples, spark.createDataFrame([(i, int(t)) for i, t in enumerate(asked)], "idx long, ns long"), bucket=20_000)
    assert "unboundedfollowing" not in near._jdf.queryExecution().toString().lower()
    got = {r["idx"]: (r["before"] and r["before"]["ns"], r["after"] and r["after"]["ns"]) for r in near.collect()}
    left, right = np.searchsorted(stamps, asked, "right") - 1, np.searchsorted(stamps, asked, "left")
    assert got == {i: (int(stamps[a]) if a >= 0 else None, int(stamps[b]) if b < len(stamps) else None) for i, (a, b) in enumerate(zip(left, right))}
