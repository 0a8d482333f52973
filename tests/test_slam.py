"""SLAM databases: a made one comes back, whole and broken scans are told apart."""

import sqlite3
import struct
import zlib

import numpy as np
import pytest

from scanloom.sources import frames, slam


def pose_blob(turn, shift):
    return np.column_stack((turn, shift)).astype("<f4").tobytes()


def scan_blob(xyz, colour):
    rows = np.zeros((len(xyz), 4), "<f4")
    rows[:, :3] = xyz
    rows.view("<u4")[:, 3] = colour
    return zlib.compress(rows.tobytes())


def turn_about_z(angle):
    c, s = np.cos(angle), np.sin(angle)
    return np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    """(folder, what each keyframe of the first file holds)"""
    rng, where, wanted = np.random.default_rng(9), tmp_path_factory.mktemp("slam"), {}
    picture = rng.integers(0, 256, (6, 8, 3), dtype=np.uint8)
    png = frames.png_of([frames.deflated(picture[:, :, ::-1])], 8, 6)
    db = sqlite3.connect(where / "a.db")
    db.execute("CREATE TABLE Node (id INTEGER PRIMARY KEY, map_id INTEGER, weight INTEGER, stamp FLOAT, pose BLOB)")
    db.execute("CREATE TABLE Data (id INTEGER PRIMARY KEY, image BLOB, scan BLOB)")
    for i in (1, 2, 3, 5, 8, 9, 14):
        xyz = rng.normal(size=(40 + i, 3)).astype("<f4")
        colour = rng.integers(0, 1 << 32, len(xyz), dtype=np.uint64).astype("<u4")  # all bits, as those of a float that is no number
        turn, shift = turn_about_z(i).astype("<f4"), rng.normal(size=3).astype("<f4")
        if i == 3:
            xyz[4, 1] = np.nan
        blob = scan_blob(xyz, colour) + (struct.pack("<3i", len(xyz), 1, 0) if i == 5 else b"")
        db.execute("INSERT INTO Node VALUES (?, 0, 0, ?, ?)", (i, i / 4, pose_blob(turn, shift)))
        db.execute("INSERT INTO Data VALUES (?, ?, ?)", (i, png if i == 2 else b"\xff\xd8" if i == 8 else None, blob))
        wanted[i] = (xyz, colour, turn, shift)
    good = scan_blob(np.ones((3, 3)), [1, 2, 3])
    broken = {20: good[:-5], 21: b"none", 22: b"", 23: zlib.compress(b"x" * 20), 24: None}
    for i, blob in broken.items():
        db.execute("INSERT INTO Node VALUES (?, 1, 0, 9, ?)", (i, pose_blob(np.eye(3), np.zeros(3))))
        db.execute("INSERT INTO Data VALUES (?, NULL, ?)", (i, blob))
    for i, pose in {30: None, 31: b"short", 32: bytes(48), 33: pose_blob(np.eye(3), [np.nan, 0, 0])}.items():
        db.execute("INSERT INTO Node VALUES (?, 1, 0, NULL, ?)", (i, pose))
        db.execute("INSERT INTO Data VALUES (?, NULL, ?)", (i, good))
    db.execute("INSERT INTO Node VALUES (40, 1, 0, 9, ?)", (pose_blob(np.eye(3), np.zeros(3)),))  # without a Data row
    db.execute("INSERT INTO Node VALUES (41, 1, 0, 9, ?)", (pose_blob(np.eye(3), np.zeros(3)),))
    db.execute("INSERT INTO Data VALUES (41, NULL, ?)", (zlib.compress(b""),))
    db.commit()
    other = sqlite3.connect(where / "b.db")
    other.execute("CREATE TABLE Node (id INTEGER PRIMARY KEY, map_id INTEGER, stamp FLOAT, pose BLOB)")
    other.execute("CREATE TABLE Data (id INTEGER PRIMARY KEY, scan BLOB)")
    other.commit()
    return where, wanted, picture


def test_scans_come_back_in_the_world_and_in_the_sensor(spark, made):
    where, wanted, _ = made
    nodes = slam.read_slam(spark, str(where), rowsPerTask="3")
    assert nodes.rdd.getNumPartitions() == 6
    own, world = (f(nodes).filter("node_id < 20").collect() for f in (slam.scan_points, slam.world_points))
    assert len(own) == len(world) == sum(len(w[0]) for w in wanted.values()) - 1
    moved = {(r["node_id"], r["point_id"]): r for r in world}
    for r in own:
        xyz, colour, turn, shift = wanted[r["node_id"]]
        at, bits = r["point_id"], int(colour[r["point_id"]])
        assert (r["x"], r["y"], r["z"]) == tuple(map(float, xyz[at]))
        assert (r["r"], r["g"], r["b"]) == (bits >> 16 & 255, bits >> 8 & 255, bits & 255)
        m = moved[r["node_id"], at]
        assert np.allclose([m["x"], m["y"], m["z"]], turn.astype(float) @ xyz[at].astype(float) + shift.astype(float), atol=1e-12)
        assert (m["r"], m["g"], m["b"]) == (r["r"], r["g"], r["b"])


def test_broken_scans_and_poses_are_counted(spark, made):
    nodes = slam.read_slam(spark, str(made[0] / "a.db"))
    told = {r["node_id"]: r for r in slam.scan_status(nodes).collect()}
    assert len(told) == 18 and (told[3]["n"], told[3]["finite"]) == (43, 42)
    assert {i: told[i]["reason"] for i in (20, 21, 22, 23, 24, 40)} == {20: "cut off", 21: "damaged", 22: "no scan", 23: "layout", 24: "no scan", 40: "no scan"}
    assert [told[i]["posed"] for i in (1, 30, 31, 32, 33)] == [True, False, False, False, False] and told[30]["n"] == 3
    assert {r["reason"]: r["nodes"] for r in slam.rejects(nodes).collect()} == {"cut off": 1, "damaged": 1, "no scan": 3, "layout": 1, "no pose": 4}
    assert {r["node_id"] for r in slam.world_points(nodes).select("node_id").distinct().collect()} == set(made[1])
    assert slam.scan_points(nodes).filter("node_id IN (30, 31, 32, 33)").count() == 12
    assert told[41]["reason"] is None and told[41]["n"] == 0


def test_poses_and_images_of_keyframes(spark, made):
    where, wanted, picture = made
    nodes = slam.read_slam(spark, str(where / "a.db"), images="true")
    poses = {r["idx"]: r for r in slam.sensor_poses(nodes).collect()}
    assert set(wanted) <= set(poses) and not {30, 31, 32, 33} & set(poses)
    for i, (_, _, turn, shift) in wanted.items():
        assert np.allclose(np.array(poses[i]["r"]).reshape(3, 3), turn) and np.allclose(poses[i]["t"], shift) and poses[i]["stamp"] == i / 4
    images = {r["idx"]: r for r in slam.node_images(nodes).collect()}
    assert {i: r["ok"] for i, r in images.items()} == {2: True, 8: False}
    assert (np.frombuffer(images[2]["data"], np.uint8).reshape(6, 8, 3) == picture).all()
    assert slam.node_images(slam.read_slam(spark, str(where / "a.db"))).count() == 0


def test_no_database_no_rows(spark, made, tmp_path):
    assert slam.world_points(slam.read_slam(spark, str(tmp_path))).count() == 0
    assert slam.rejects(slam.read_slam(spark, str(made[0] / "b.db"))).count() == 0
