"""Frames of the live overlay equal those drawn point by point, whatever the cuts into batches."""

import os

import numpy as np
import pytest

from scanloom.operators import cloud
from scanloom.sources import frames
from scanloom.sources.bag import stream_bag
from scanloom.streaming import overlay
from tests.test_live import SMALL, new_bag, run
from tests.test_messages import cloud_message, image_message

SLOP, WINDOW = 40_000, 5


def plain_dots(scans):
    """(u, v) to colour, by drawing all points of the scans one after another."""
    front = [(p, p[2]) for s in scans for p in s if p[2] > 0]
    if not front:
        return None
    lo, hi = min(d for _, d in front), max(d for _, d in front)
    out = {}
    for (x, y, z), d in front:
        u, v = round(SMALL.fx * x / z + SMALL.cx), round(SMALL.fy * y / z + SMALL.cy)
        if 0 <= u < SMALL.width and 0 <= v < SMALL.height:
            ratio = (d - lo) / max(hi - lo, 1e-3)
            for at in ((u, v), (u - 1, v), (u + 1, v), (u, v - 1), (u, v + 1)):
                if 0 <= at[0] < SMALL.width and 0 <= at[1] < SMALL.height:
                    out[at] = (int(255 * ratio), 0, int(255 * (1 - ratio)))
    return out


def plain_pairs(scans, images):
    near = lambda us, others: min(((abs(us - t), t, i) for t, i in others if abs(us - t) <= SLOP), default=(0, None, None))[1:]
    out = []
    for us, i in sorted(scans):
        image = near(us, images)
        if image[1] is not None and near(image[0], scans) == (us, i):
            out.append(((us, i), image))
    return out


def messages(seed):
    """(topic, us, payload, points or image) in order of arrival: out of order within the delay, some twice, an empty scan and one behind
    the camera."""
    rng = np.random.default_rng(seed)
    out = []
    for k in range(34):
        xyz = np.column_stack((rng.uniform(-1, 1, (30, 2)), rng.uniform(-0.5, 3, 30))).astype("<f4")
        xyz = xyz[:0] if k in (3, 17) else -np.abs(xyz) if k == 9 else xyz
        us = int(rng.integers(0, 3_000_000))
        out.append((1, us, cloud_message(us * 1000, xyz, np.zeros(len(xyz))), xyz.astype(float).tolist()))
    for k in range(34):
        us = out[k][1] + int(rng.integers(-50_000, 50_000)) if k % 2 else int(rng.integers(0, 3_000_000))
        image = rng.integers(0, 256, (24, 32, 3), dtype=np.uint8)
        out.append((2, max(us, 0), image_message(max(us, 0) * 1000, 24, 32, "bgr8", 96, image.tobytes()), image))
    out += [out[4], out[20], out[40]]
    out.sort(key=lambda m: m[1] + int(rng.integers(0, 50_000)))
    return out + [(t, 60_000_000, d(60_000_000_000), x) for t, d, x in ((1, lambda ns: cloud_message(ns, np.zeros((0, 3)), []), []), (2, lambda ns: image_message(ns, 1, 1, "mono8", 1, b"x"), None))]


def wanted(arrived):
    """((scan, image) to (us, scans drawn, frame)), and the pairs in order with their points."""
    seq, numbered = {1: 0, 2: 0}, {}
    for topic, us, _, held in arrived:
        numbered[topic, seq[topic]] = (us, held)
        seq[topic] += 1
    side = lambda t: [(us, i) for (topic, i), (us, _) in numbered.items() if topic == t and us < 50_000_000]
    buffer, out, paired = [], {}, []
    for (_, scan), (us, image) in plain_pairs(side(1), side(2)):
        points = numbered[1, scan][1]
        paired.append((scan, points))
        buffer = ([*buffer, points] if points else buffer)[-WINDOW:]
        dots = plain_dots(buffer) if buffer else None
        if dots is not None:
            frame = numbered[2, image][1].copy()
            for (u, v), colour in dots.items():
                frame[v, u] = colour
            out[scan, image] = (us, len(buffer), frame)
    return out, paired


@pytest.mark.parametrize("cuts", [(200,), (9, 27, 40, 61, 200)])
def test_live_frames_equal_plain_ones(spark, tmp_path, cuts):
    arrived, at, held = messages(6), 0, []
    (tmp_path / "bags").mkdir()
    db = new_bag(tmp_path / "bags" / "ride.db3")
    db.executemany("INSERT INTO topics VALUES (?, ?, 'T')", [(1, "/cloud"), (2, "/image")])
    read = lambda: overlay.live_overlay(stream_bag(spark, str(tmp_path / "bags")), "/cloud", "/image", SMALL, SLOP, "100 milliseconds", WINDOW)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        # the last one comes when the watermark is a minute past it
        for part in [arrived[lo:hi] for lo, hi in zip((0, *cuts), cuts)] + [[(1, 5_000, cloud_message(5_000_000, np.ones((3, 3)), np.zeros(3)), None)]]:
            db.executemany("INSERT INTO messages VALUES (?, ?, ?)", [(t, us, d) for t, us, d, _ in part])
            db.commit()
            query = run(read(), tmp_path, "out")
            held += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    want, _ = wanted(arrived)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    got = {(r["scan_id"], r["image_id"]): (r["us"], r["scans"], np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], 3)) for r in rows}
    assert len(rows) == len(got) and got.keys() == want.keys() and len(got) > 12
    for k, (us, n, frame) in want.items():
        assert got[k][:2] == (us, n) and (got[k][2] == frame).all()
    if len(cuts) > 1:
        # messages of the delay and four slops, and the window
        assert max(held) <= 50 and held[-1] <= WINDOW + 4
        written = spark.readStream.schema(overlay.OUT).parquet(str(tmp_path / "out"))
        overlay.write_overlay(written, str(tmp_path / "png"), str(tmp_path / "png-at"), availableNow=True).awaitTermination()
        names = {f"ride_{us:020d}_{scan:06d}.png": frame for (scan, _), (us, _, frame) in want.items()}
        assert {f for f in os.listdir(tmp_path / "png") if f.endswith(".png")} == set(names)
        for name, frame in names.items():
            assert (frames.decode_png((tmp_path / "png" / name).read_bytes()) == frame).all()


def test_pixels_of_a_table_equal_plain_ones(spark):
    _, paired = wanted(messages(8))
    held = [points for _, points in paired if points]
    rows = [(k * 3, i, *p) for k, points in enumerate(held) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "scan_id long, point_id long, x double, y double, z double").repartition(5)
    got = {}
    for r in cloud.overlay_pixels(table, SMALL, WINDOW).collect():
        got.setdefault(r["frame"] // 3, {})[r["u"], r["v"]] = (r["b"], r["g"], r["r"])
    for k in range(len(held)):
        assert got.get(k, {}) == (plain_dots(held[max(0, k - WINDOW + 1) : k + 1]) or {})
    assert len(got) > 8
    dense = cloud.accumulated(table, 4).groupBy("frame").count().collect()
    assert {r["frame"] // 3: r["count"] for r in dense} == {k: sum(map(len, held[max(0, k - 3) : k + 1])) for k in range(len(held))}


def test_frames_of_no_scans(spark):
    empty = spark.createDataFrame([], "scan_id long, point_id long, x double, y double, z double")
    assert cloud.overlay_pixels(empty, SMALL).count() == 0 and cloud.accumulated(empty).count() == 0
