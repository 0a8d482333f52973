"""Queries against their SQL on small tables of odd values, to the sign of a zero and null apart from an empty list."""

import datetime as dt

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from scanloom.functions import calibration as C
from scanloom.plans import catalog


def exact(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    return tuple(exact(x) for x in v) if isinstance(v, list | tuple) else repr(v)


def differing(spark, folder, name, **tables):
    """Rows that only the query gives, and rows that only its SQL gives, columns by name."""
    con = duckdb.connect()
    for t, columns in tables.items():
        pq.write_table(columns if isinstance(columns, pa.Table) else pa.table(columns), f"{folder}/{t}.parquet", coerce_timestamps="us")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df, got = catalog.QUERIES[name](spark, str(folder)), con.execute(catalog.ORACLES[name])
    names = sorted(df.columns)
    at = [[d[0] for d in got.description].index(n) for n in names]
    mine, theirs = ([exact(r) for r in rows] for rows in (df.select(*names).collect(), [[r[i] for i in at] for r in got.fetchall()]))
    assert mine and len(mine) == len(theirs)
    return sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))


def events(minutes, kinds, values=None):
    start = dt.datetime(2024, 1, 1)
    n = len(minutes)
    return {"event_id": pa.array(range(n), pa.int64()), "ts": pa.array([start + dt.timedelta(minutes=m) for m in minutes], pa.timestamp("us")), "event_type": list(kinds), "value": values or [1.5] * n}


def test_streams_with_and_without_gaps(spark, tmp_path):
    table = events([0, 1, 2, 4, 5, 6, 61, 62, 200, 201], "ababccaabb")
    assert differing(spark, tmp_path, "agg3_normal_gaps", events=table) == ([], [])


def embeddings(*rows):
    """vec_id, and embeddings of ten floats from the first ones given."""
    filled = [[*r, *([0.25] * (10 - len(r)))] for r in rows]
    return pa.table({"vec_id": pa.array(range(len(rows)), pa.int64()), "embedding": pa.array(filled, pa.list_(pa.float32())), "label": pa.array([0] * len(rows), pa.int32())})


#: Quaternion and position. Products of their terms are zeros of either sign, and values that round to them.
SMALL = [
    (0.0, 0.0, 0.0, 1.0, 1.0, 0.0, 0.0), (-1e-8, 0.0, 0.0, 1.0, 1.0, -1e-8, 0.0), (1e-8, 1e-8, -1e-8, 1.0, -1.0, 1e-8, -1e-8),
    (0.3, -0.3, 1e-8, -0.9, 0.5, -0.0, -0.5), (-0.3, 1e-8, 0.0, 0.9, -1e-8, 1.0, 1e-8), (0.7, 0.1, -0.2, 0.6, -0.1, 0.4, 0.3),
]


def test_axis_angles_keep_the_sign_of_zero(spark, tmp_path):
    assert differing(spark, tmp_path, "geo11_axis_angle", embeddings=embeddings(*SMALL)) == ([], [])


def rig_poses():
    """Poses at which the camera stands in the world's origin and looks along its axes, up to the floats' last digits and a little more."""
    r = np.array(C.LIDAR_TO_CAM)
    w = np.sqrt(1 + np.trace(r)) / 2
    q = np.array([r[2, 1] - r[1, 2], r[0, 2] - r[2, 0], r[1, 0] - r[0, 1], 4 * w * w]) / (4 * w)
    off = [np.zeros(4), *(s * 1e-7 * np.eye(4)[k] for s in (1, -1) for k in range(3))]
    return [(*(q + o).tolist(), *C.LIDAR_TO_CAM_SHIFT) for o in off]


def test_camera_transforms_keep_the_sign_of_zero(spark, tmp_path):
    assert differing(spark, tmp_path, "geo8_world_to_camera", embeddings=embeddings(*rig_poses(), *SMALL)) == ([], [])


def test_cameras_in_the_map_keep_the_sign_of_zero(spark, tmp_path):
    assert differing(spark, tmp_path, "geo9_camera_in_map", embeddings=embeddings(*rig_poses(), *SMALL)) == ([], [])


def curve_tables():
    """Rates that round to zero from below, camera values halfway between two texts or missing, a scan whose depth is 1.0005."""
    values = [0.015625, 0.046875, 0.2500625, -0.000025, -0.015625, 0.0, None, 1.1]
    scan = {"l_orderkey": [7] * 60, "l_quantity": [20.0, 31.0] * 30, "l_extendedprice": [40020.0] * 60, "l_discount": [0.05] * 60, "l_tax": [0.0012345] * 60}
    rates = [(0.1, 0.2, 0.3, 0.9, *r) for r in ((-1e-7, 1e-7, -0.0), (-4e-6, 0.5, -6e-6), (0.0, -0.1, 0.1))]
    return {"events": events(range(8), "a" * 8, values), "lineitem": scan, "embeddings": embeddings(*rates)}


def test_curves_are_written_as_by_printf(spark, tmp_path):
    assert differing(spark, tmp_path, "q2_dump_curves", **curve_tables()) == ([], [])


def test_curves_of_layout_3_are_written_as_by_printf(spark, tmp_path):
    assert differing(spark, tmp_path, "q2_dump_curves_v3", **curve_tables()) == ([], [])
    rows = catalog.QUERIES["q2_dump_curves_v3"](spark, str(tmp_path)).filter("kind = 'LID'").collect()
    assert [r["b"] for r in rows] == ["1.000"]


def near_whole_colours():
    """One scan, each point on pixels of its own, with colours 3e-7 beside whole numbers: some round up to them, and are then not cut to the one below."""
    colours = np.array([0.0, *(k + s for k in range(5, 250, 10) for s in (-3e-7, 3e-7)), 255.0])
    n, r, t = len(colours), np.array(C.LIDAR_TO_CAM), C.LIDAR_TO_CAM_SHIFT
    quantity = 20.0 + 10 * np.arange(n) / n
    x, depth = (quantity - 25.5) / 50, 1 + colours / 255
    z = (depth - t[2] - r[2, 0] * x) / r[2, 2]
    return {"l_orderkey": [8] * n, "l_linenumber": pa.array(range(n), pa.int32()), "l_quantity": quantity, "l_extendedprice": z * 40000, "l_discount": [0.05] * n, "l_tax": [0.0] * n}


def test_overlay_colours_are_rounded_before_they_are_cut(spark, tmp_path):
    assert differing(spark, tmp_path, "q7_overlay", lineitem=near_whole_colours()) == ([], [])
    row = catalog.QUERIES["q7_overlay"](spark, str(tmp_path)).first()
    k = np.repeat(np.arange(5, 250, 10), 2)
    assert (row["n"], row["b"], row["red"]) == (len(k) + 2, k.sum() + 255, (255 - k).sum() + 255)


def test_colours_of_overlay_frames_are_rounded_before_they_are_cut(spark, tmp_path):
    assert differing(spark, tmp_path, "q7_overlay_frames", lineitem=near_whole_colours()) == ([], [])
