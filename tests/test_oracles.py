import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.functions import calibration as C
from scanloom.operators import scan
from scanloom.plans import catalog
from scanloom.sources import proxy, proxy_mesh
from tests.oracle import SF, compare

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_query_equals_oracle(spark, name):
    compare(spark, catalog.QUERIES[name], catalog.ORACLES[name])


def test_queries_without_sql_are_these():
    assert catalog.QUERIES.keys() - catalog.ORACLES.keys() == {"krn1_board_plane", "srt4_downsample", "doc7_outliers", "doc2_extrinsic"}


def test_the_rig_s_transform_comes_back(spark):
    row = catalog.QUERIES["doc2_extrinsic"](spark, SF).first()
    assert row["n"] == proxy.table(spark, SF, "embeddings").count() and row["residual_deg"] < 0.01
    assert np.allclose(np.array(row["r"]).reshape(3, 3), C.LIDAR_TO_CAM, atol=1e-5) and np.allclose(row["t"], C.LIDAR_TO_CAM_SHIFT, atol=1e-4)


def test_downsample_takes_the_lowest_hashes(spark):
    whole = [tuple(r) for r in proxy.points(spark, SF).withColumn("h", F.xxhash64(F.lit(0), "scan_id", "x", "y", "z", "time")).collect()]
    want = sorted(whole, key=lambda r: (r[-1], r[:-1]))[:1000]
    got = [tuple(r) for r in catalog.QUERIES["srt4_downsample"](spark, SF).collect()]
    assert len(got) == 1000
    assert np.allclose(np.array(sorted(got)), np.array(sorted(r[:-1] for r in want)), atol=1e-5)


def test_outliers_equal_brute_force(spark):
    rows = proxy_mesh.vertices(spark, SF).collect()
    xyz = np.array([[r["x"], r["y"], r["z"]] for r in rows])
    mean = np.array([np.sort(np.linalg.norm(xyz - p, axis=1))[1:21].mean() for p in xyz])
    limit = mean.mean() + 2 * mean.std()
    got = {r["id"]: r for r in catalog.QUERIES["doc7_outliers"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r, m in zip(rows, mean):
        assert abs(got[r["vid"]]["mean_distance"] - m) < 1e-5 and (abs(m - limit) < 1e-6 or got[r["vid"]]["keep"] == (m <= limit))


def test_board_planes_equal_counting_all_points(spark):
    points = scan.to_camera(proxy.points(spark, SF), catalog.FLAT).filter("scan_id < 6")
    planes = {r["scan_id"]: np.array(r["planes"]) for r in scan.drawn_planes(points, "scan_id").collect()}
    xyz = {k: np.array([[r["x"], r["y"], r["z"]] for r in points.filter(f"scan_id = {k}").collect()]) for k in planes}
    got = {r["scan_id"]: r for r in scan.dominant_plane(points, 0.02, chunk_rows=50).collect()}
    assert got.keys() == planes.keys() and len(got) == 6
    for k, p in planes.items():
        near = (np.abs(xyz[k] @ p[:, :3].T + p[:, 3]) < 0.02).sum(axis=0)
        assert got[k]["support"] == near.max() and np.allclose(got[k]["plane"], p[near.argmax()])
    assert catalog.QUERIES["krn1_board_plane"](spark, SF).columns == ["scan_id", "board_x", "depth", "n", "mean_time"]


def test_entry_points_without_text_operators(monkeypatch):
    import __spark_entry__ as e

    monkeypatch.setattr(e, "text", None)
    monkeypatch.setattr(e, "pipeline", None)
    assert set(e.queries()) == set(catalog.QUERIES)
    assert set(e.oracle_sql()) <= set(e.queries())
