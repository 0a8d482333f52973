"""Transforms from planes, and normals of clouds."""

import numpy as np
import pytest

from scanloom.functions import calibration as C
from scanloom.operators import extrinsic, normals

R, T = np.array(C.LIDAR_TO_CAM), np.array(C.LIDAR_TO_CAM_SHIFT)
SCHEMA = "n_lidar array<double>, c_lidar array<double>, n_cam array<double>, c_cam array<double>"


def seen(rng, n, noise, flip=False):
    rows = []
    for _ in range(n):
        normal = rng.normal(size=3)
        normal /= np.linalg.norm(normal)
        centre = -3 * normal + rng.normal(size=3) * 0.3
        jitter = lambda v, s: v + rng.normal(size=3) * s
        sign = -1 if flip and rng.random() < 0.5 else 1  # a fit gives either side
        rows.append([x.tolist() for x in (sign * normal * 2, centre, jitter(R @ normal, noise), jitter(R @ centre + T, noise))])
    return rows


def test_a_known_transform_comes_back(spark):
    rng = np.random.default_rng(9)
    exact = extrinsic.extrinsic(spark.createDataFrame(seen(rng, 6, 0.0, True), SCHEMA)).first()
    assert np.allclose(np.array(exact["r"]).reshape(3, 3), R, atol=1e-6) and np.allclose(exact["t"], T, atol=1e-5) and exact["residual_deg"] < 1e-3
    noisy = extrinsic.extrinsic(spark.createDataFrame(seen(rng, 200, 0.01, True), SCHEMA)).first()
    r = np.array(noisy["r"]).reshape(3, 3)
    angle = np.degrees(np.arccos(np.clip((np.trace(r @ R.T) - 1) / 2, -1, 1)))
    assert angle < 0.3 and np.linalg.norm(np.array(noisy["t"]) - T) < 0.02 and 0 < noisy["residual_deg"] < 2
    assert np.linalg.det(r) == pytest.approx(1)


def test_two_planes_do_and_parallel_ones_don_t(spark):
    rows = [[[0.0, 0.0, 1.0], [0.1, 0.0, -3.0]], [[1.0, 0.0, 0.0], [-3.0, 0.0, 0.1]]]
    full = [[n, c, (R @ n).tolist(), (R @ c + T).tolist()] for n, c in rows]
    two = extrinsic.extrinsic(spark.createDataFrame(full, SCHEMA)).first()
    assert np.allclose(np.array(two["r"]).reshape(3, 3), R, atol=1e-6)
    with pytest.raises(ValueError, match="parallel"):
        extrinsic.extrinsic(spark.createDataFrame(full[:1] * 3, SCHEMA))
    with pytest.raises(ValueError, match="no planes"):
        extrinsic.extrinsic(spark.createDataFrame([], SCHEMA))


def test_normals_equal_eigenvectors(spark):
    rng = np.random.default_rng(3)
    wall = np.column_stack((rng.uniform(-0.2, 0.2, 250), rng.uniform(-0.2, 0.2, 250), 1 + rng.normal(0, 0.004, 250)))
    line = np.column_stack((5 + np.arange(6) * 0.01, np.zeros(6), np.zeros(6)))
    alone = np.array([[9.0, 9.0, 9.0], [9.01, 9.0, 9.0]])
    p = np.vstack((wall, line, alone))
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(p)], "id long, x double, y double, z double")
    got = {r["id"]: r for r in normals.normals(df, radius=0.05, most=12).collect()}
    assert len(got) == len(p)
    for i in range(len(wall)):
        d = np.linalg.norm(p - p[i], axis=1)
        near = [j for j in np.lexsort((np.arange(len(p)), d)) if d[j] <= 0.05][:12]
        assert got[i]["n"] == len(near)
        if len(near) < 3:
            assert got[i]["normal"] is None
            continue
        values, vectors = np.linalg.eigh(np.cov(p[near].T, bias=True))
        if values[1] - values[0] > 1e-3 * values[2]:
            mine = np.array(got[i]["normal"])
            assert abs(mine @ vectors[:, 0]) == pytest.approx(1, abs=1e-6)
            assert mine @ -p[i] >= 0  # towards the sensor
    assert all(got[len(wall) + i]["normal"] is None for i in range(8))
