"""Recordings that grow while they are read, and scans coloured as they come."""

import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.functions.calibration import IDENTITY, NO_SHIFT, Calibration
from scanloom.operators import cloud
from scanloom.operators.pair import pair_nearest
from scanloom.sources import messages
from scanloom.sources.bag import read_bag, stream_bag
from scanloom.streaming.live import live_colours, stamped
from tests.test_messages import cloud_message, image_message

SMALL = Calibration(fx=20.0, fy=20.0, cx=15.0, cy=12.0, distortion=(0.0,) * 5, rotation=IDENTITY, shift=NO_SHIFT, width=32, height=24)


def new_bag(path):
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE topics (id INTEGER, name TEXT, type TEXT)")
    db.execute("CREATE TABLE messages (topic_id INTEGER, timestamp INTEGER, data BLOB)")
    db.commit()
    return db


def run(df, where, name):
    query = df.writeStream.format("parquet").option("path", f"{where}/{name}").option("checkpointLocation", f"{where}/{name}-at").start()
    try:
        query.processAllAvailable()  # with the batch without data that a new watermark starts
    finally:
        query.stop()
    return query


def test_a_growing_recording_is_read_once(spark, tmp_path):
    (tmp_path / "bags").mkdir()
    db = new_bag(tmp_path / "bags" / "a.db3")
    add = lambda topic, lo, hi: db.executemany("INSERT INTO messages VALUES (?, ?, ?)", [(topic, i * 10 + topic, bytes([topic, i % 256])) for i in range(lo, hi)])
    db.executemany("INSERT INTO topics VALUES (?, ?, 'T')", [(1, "/a"), (2, "/b"), (3, "/none")])
    add(1, 0, 25), add(2, 0, 3), db.commit()
    bags = str(tmp_path / "bags")
    read = lambda: run(stream_bag(spark, bags, rowsPerTask="7", topics="/a,/b"), tmp_path, "out")
    read()
    add(2, 3, 30), add(1, 25, 26), db.commit()
    other = new_bag(tmp_path / "bags" / "b.db3")
    other.execute("INSERT INTO topics VALUES (5, '/b', 'T')")
    other.execute("INSERT INTO messages VALUES (5, 1, x'00')")
    other.commit()
    read()  # a new query from the checkpoint
    read()  # nothing new
    add(1, 26, 40), db.commit()
    read()
    got = sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(str, read_bag(spark, bags, topics="/a,/b").collect())) and len(got) == 71


@pytest.mark.parametrize("cuts", [(60,), (5, 12, 19, 20, 28, 41, 50, 60)])
def test_live_colours_equal_the_batch_query(spark, tmp_path, cuts):
    rng = np.random.default_rng(4)
    stamps = sorted([(int(t), 1) for t in rng.integers(0, 3_000_000, 32)] + [(int(t), 2) for t in rng.integers(0, 3_000_000, 26)])
    stamps += [(60_000_000, 1), (60_000_000, 2)]  # moves the watermark past all others
    (tmp_path / "bags").mkdir()
    db = new_bag(tmp_path / "bags" / "a.db3")
    db.executemany("INSERT INTO topics VALUES (?, ?, 'T')", [(1, "/cloud"), (2, "/image")])
    rows = []
    for us, topic in stamps:
        if topic == 1:
            xyz = np.column_stack((rng.uniform(-1, 1, (30, 2)), rng.uniform(-0.5, 3, 30)))
            data = cloud_message(us * 1000, xyz, np.arange(30) / 100)
        else:
            data = image_message(us * 1000, 24, 32, "bgr8", 96, rng.integers(0, 256, 24 * 96, dtype=np.uint8).tobytes())
        rows.append((topic, us, data))
    bags, slop, at, held = str(tmp_path / "bags"), 40_000, 0, []
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for to in cuts:
            db.executemany("INSERT INTO messages VALUES (?, ?, ?)", rows[at:to])
            db.commit()
            at = to
            query = run(live_colours(stream_bag(spark, bags), "/cloud", "/image", SMALL, slop, "100 milliseconds"), tmp_path, "out")
            held += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = spark.read.parquet(str(tmp_path / "out"))
    bag = read_bag(spark, bags)
    told = stamped(bag, "/cloud", "/image").filter("us < 50000000")
    side = lambda kind: told.filter(F.col("kind") == kind).select(F.col("id").alias("seq"), "us")
    pairs = pair_nearest(side("scan"), side("image"), slop).select(F.col("l_id").alias("scan"), F.col("r_id").alias("image_id"))
    points = messages.decode_points(bag.filter("topic = '/cloud'")).select(F.col("seq").alias("scan"), "point_id", "x", "y", "z", "time")
    points = points.join(pairs, "scan")
    images = messages.decode_images(bag.filter("topic = '/image'")).withColumnRenamed("seq", "image_id").select("image_id", "data", "height", "width", "encoding")
    want = cloud.colourise_frames(points, images, SMALL).select("scan", "image_id", "point_id", "x", "y", "z", "time", "rgb")
    columns = ["scan_id", "image_id", "point_id", "x", "y", "z", "time", "rgb"]
    mine, theirs = sorted(tuple(r) for r in got.select(*columns).collect()), sorted(tuple(r) for r in want.collect())
    assert mine == theirs and len({r[0] for r in mine}) > 8
    if len(cuts) > 6:  # the state holds what came within the delay and four slops, not the stream
        assert max(held) <= 40 and held[-1] <= 6
