"""A written recording: points, poses and images come back, and the time offset is found from its scans."""

import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.functions.calibration import IDENTITY, NO_SHIFT, Calibration
from scanloom.operators import cloud, curves, scan, tau
from scanloom.sources import frames, messages
from scanloom.sources.bag import read_bag

FLAT = Calibration(rotation=IDENTITY, shift=NO_SHIFT)


class Writer:
    def __init__(self):
        self.out = b""

    def put(self, kind, *values):
        self.out += b"\0" * (-len(self.out) % struct.calcsize("<" + kind)) + struct.pack(f"<{len(values)}{kind}", *values)
        return self

    def blob(self, data):
        self.put("I", len(data))
        self.out += data
        return self

    def header(self, ns, frame="lidar"):
        return self.put("i", ns // 10**9).put("I", ns % 10**9).blob(frame.encode() + b"\0")

    def done(self):
        return b"\0\1\0\0" + self.out


def cloud_message(ns, xyz, time):
    w = Writer().header(ns).put("I", 1, len(xyz), 4)
    for i, name in enumerate(("x", "y", "z", "time")):
        w.blob(name.encode() + b"\0").put("I", 4 * i).put("B", 7).put("I", 1)
    data = np.column_stack((xyz, time)).astype("<f4").tobytes()
    return w.put("B", 0).put("I", 16, 16 * len(xyz)).blob(data).put("B", 1).done()


def odometry_message(ns, pos, quat):
    return Writer().header(ns, "map").blob(b"base\0").put("d", *pos, *quat, *[0.0] * 36).done()


def image_message(ns, height, width, encoding, step, data):
    return Writer().header(ns, "cam").put("I", height, width).blob(encoding.encode() + b"\0").put("B", 0).put("I", step).blob(data).done()


X = lambda t: 0.25 * np.sin(1.7 * t) + 0.03 * t
OFFSET = 0.12


@pytest.fixture(scope="module")
def bag(tmp_path_factory):
    path = tmp_path_factory.mktemp("bag")
    rng = np.random.default_rng(8)
    with sqlite3.connect(path / "a.db3") as db:
        db.execute("CREATE TABLE topics (id INTEGER, name TEXT, type TEXT)")
        db.execute("CREATE TABLE messages (topic_id INTEGER, timestamp INTEGER, data BLOB)")
        db.executemany("INSERT INTO topics VALUES (?, ?, ?)", [(1, "/cloud", "PointCloud2"), (2, "/odom", "Odometry"), (3, "/image", "Image")])
        for i in range(50):
            t = 0.1 * i
            board = np.column_stack((X(t) + rng.uniform(-0.2, 0.2, 400), rng.uniform(-0.2, 0.2, 400), rng.normal(1.5, 0.002, 400)))
            board[:, 0] += X(t) - board[:, 0].mean()
            far = np.column_stack((rng.uniform(-1, 1, (50, 2)), np.full(50, 5.0)))
            xyz = np.vstack((board, far, [[np.nan, 0, 1.5]]))
            ns = int(round((t + OFFSET) * 1e9))
            db.execute("INSERT INTO messages VALUES (1, ?, ?)", (ns, cloud_message(ns, xyz, np.zeros(len(xyz)))))
        for i in range(4):
            db.execute("INSERT INTO messages VALUES (2, ?, ?)", (i, odometry_message(i * 10, (i, 2, 3), (0, 0, 0, 1))))
        db.execute("INSERT INTO messages VALUES (2, 9, ?)", (b"\0\1\0\0short",))
        pixels = bytes([1, 2, 3, 4, 5, 6, 0, 0, 7, 8, 9, 10, 11, 12, 0, 0])
        db.execute("INSERT INTO messages VALUES (3, 5, ?)", (image_message(77, 2, 2, "rgb8", 8, pixels),))
    return str(path)


def test_odometry_images_and_rejects(spark, bag):
    held = read_bag(spark, bag, topics="/odom")
    got = messages.decode_odometry(held)
    assert [
        (r["seq"], r["ns"], r["pos"], r["quat"]) for r in got.orderBy("seq").collect()
    ] == [(i, i * 10, [float(i), 2.0, 3.0], [0.0, 0.0, 0.0, 1.0]) for i in range(4)]
    assert tuple(messages.rejects(held, "odometry").collect()[0]) == ("/odom", 5, 4, 1)
    image = messages.decode_images(read_bag(spark, bag, topics="/image")).collect()[0]
    assert (image["header_ns"], image["height"], image["width"], bytes(image["data"])) == (77, 2, 2, bytes(range(1, 13)))
    messages.at_least(got, 4, "poses")
    with pytest.raises(ValueError, match="4 poses"):
        messages.at_least(got, 10, "poses")


def test_valid_scans_without_points_and_unknown_encodings(spark):
    schema = "file string, topic string, msg_type string, record_ns long, seq long, data binary"
    empty = cloud_message(5, np.full((3, 3), np.nan), np.zeros(3))
    bag = spark.createDataFrame([("f", "/cloud", "PointCloud2", 1, 0, bytearray(empty)), ("f", "/cloud", "PointCloud2", 2, 1, bytearray(b"\0\1\0\0x"))], schema)
    assert tuple(messages.rejects(bag, "points").collect()[0]) == ("/cloud", 2, 1, 1)
    assert messages.decode_points(bag).count() == 0
    odd = bytearray(image_message(1, 2, 2, "bayer_rggb8", 2, bytes(4)))
    with pytest.raises(Exception, match="bayer_rggb8"):
        messages.decode_images(spark.createDataFrame([("f", "/i", "Image", 1, 0, odd)], schema)).collect()
    cut = bytearray(image_message(1, 200, 2, "bgr8", 6, bytes(4)))
    assert messages.decode_images(spark.createDataFrame([("f", "/i", "Image", 1, 0, cut)], schema)).count() == 0


def test_compressed_images(spark):
    schema = "file string, topic string, msg_type string, record_ns long, seq long, data binary"
    picture = np.random.default_rng(3).integers(0, 256, (5, 4, 3), dtype=np.uint8)
    png = frames.png_of([frames.deflated(np.ascontiguousarray(picture[:, :, ::-1]))], 4, 5)
    message = lambda kind, data: bytearray(Writer().header(42, "cam").blob(kind + b"\0").blob(data).done())
    kind = "sensor_msgs/msg/CompressedImage"
    rows = [(kind, message(b"png", png)), (kind, message(b"png", png[:-9])), (kind, message(b"png", b"")), (kind, bytearray(b"x"))]
    rows.append(("sensor_msgs/msg/Image", bytearray(image_message(43, 5, 4, "bgr8", 12, picture.tobytes()))))
    bag = spark.createDataFrame([("f", "/i", k, i, i, d) for i, (k, d) in enumerate(rows)], schema)
    got = {r["seq"]: r for r in messages.decode_images(bag).collect()}
    assert {i: r["header_ns"] for i, r in got.items()} == {0: 42, 4: 43}
    assert all((r["height"], r["width"], r["encoding"], bytes(r["data"])) == (5, 4, "bgr8", picture.tobytes()) for r in got.values())
    assert tuple(messages.rejects(bag.filter("seq < 4"), "compressed").collect()[0]) == ("/i", 4, 1, 3)
    jpeg = spark.createDataFrame([("f", "/i", kind, 1, 0, message(b"jpeg", b"\xff\xd8\xff"))], schema)
    with pytest.raises(Exception, match="compressed images in jpeg"):
        messages.decode_images(jpeg).collect()


def test_from_a_recording_to_the_time_offset(spark, bag):
    points = messages.decode_points(read_bag(spark, bag, topics="/cloud", splits="4"))
    assert points.count() == 50 * 450
    found = scan.core_centroid(points.withColumnRenamed("seq", "scan_id"), FLAT)
    stamps = points.select(F.col("seq").alias("scan_id"), (F.col("header_ns") / 1e9).alias("t")).distinct()
    lidar = found.join(stamps, "scan_id").select("t", F.col("board_x").alias("x"), "depth", "mean_time")
    t = np.arange(-0.5, 6, 0.02)
    camera = spark.createDataFrame([(float(a), float(FLAT.fx * X(a) / 1.5 + FLAT.cx)) for a in t], "t double, x double")
    best = tau.best_shift(camera, lidar.select("t", "x")).collect()[0]
    assert best["tau"] == pytest.approx(OFFSET, abs=0.002) and best["n"] == 50
    rows = curves.tagged_curves(camera.withColumn("spread", F.lit(0.0)), lidar, layout=1).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in rows} == {"CAM": len(t), "LID": 50}


def test_whole_images_colour_like_a_pixel_table(spark):
    rng = np.random.default_rng(1)
    pixels = rng.integers(0, 256, (8, 10, 3), dtype=np.uint8)
    cal = Calibration(rotation=IDENTITY, shift=NO_SHIFT, distortion=(0.0, 0.0, 0.0, 0.0, 0.0))
    wide = np.zeros((cal.height, cal.width, 3), np.uint8)
    wide[500:508, 900:910] = pixels
    p = [
        (1, float((900 + i % 10 - cal.cx) / cal.fx), float((500 + i // 10 - cal.cy) / cal.fy), 1.0) for i in range(80)
    ] + [(1, 9.0, 9.0, 1.0), (1, 0.0, 0.0, -1.0)]
    points = spark.createDataFrame(p, "image_id long, x double, y double, z double")
    image = spark.createDataFrame(
        [(1, bytearray(wide.tobytes()), cal.height, cal.width, "bgr8")],
        "image_id long, data binary, height int, width int, encoding string"
    )
    at = [(1, 900 + x, 500 + y, *map(int, pixels[y, x])) for y in range(8) for x in range(10)]
    table = spark.createDataFrame(at, "image_id long, u int, v int, b int, g int, r int")
    whole = cloud.colourise_frames(points, image, cal).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, cloud.colourise(points, table, cal).collect())) and len(whole) == 80
    assert cloud.colourise_frames(points, image, cal, keep_all=True).count() == 81
