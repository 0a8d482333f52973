import io
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.sources.bag import decode_imu, decode_imu_bytes, imu_topic, read_bag, read_calibration, stamp
from scanloom.sources.clouds import decode_image, parse_npy, parse_pcd, pixel_table, read_clouds
from scanloom.sources.sinks import write_curves


def imu_message(sec, nano, frame, values):
    name = frame.encode() + b"\0"
    body = struct.pack("<iII", sec, nano, len(name)) + name
    body += b"\0" * (-len(body) % 8)
    return b"\0\1\0\0" + body + struct.pack("<37d", *values)


@pytest.fixture
def bag(tmp_path):
    with sqlite3.connect(tmp_path / "a.db3") as db:
        db.execute("CREATE TABLE topics (id INTEGER, name TEXT, type TEXT)")
        db.execute("CREATE TABLE messages (topic_id INTEGER, timestamp INTEGER, data BLOB)")
        db.executemany("INSERT INTO topics VALUES (?, ?, ?)", [(1, "/x/IMU", "Imu"), (2, "/cloud", "PointCloud2")])
        values = [float(i) for i in range(37)]
        for i in range(10):
            db.execute("INSERT INTO messages VALUES (1, ?, ?)", (1000 - i, imu_message(5, i, "imu_link", values)))
        db.execute("INSERT INTO messages VALUES (1, 5000, ?)", (b"bad",))
        db.execute("INSERT INTO messages VALUES (2, 7, ?)", (b"zz",))
    return str(tmp_path)


def test_bag_topics_filters_and_order(spark, bag):
    df = read_bag(spark, bag)
    assert df.count() == 12 and imu_topic(spark, bag) == "/x/IMU"
    assert read_bag(spark, bag, topics="/cloud").count() == 1
    got = read_bag(spark, bag, pushdown="true").filter((F.col("topic") == "/x/IMU") & (F.col("record_ns") > 995)).orderBy("seq").collect()
    assert [r["record_ns"] for r in got] == [996, 997, 998, 999, 1000, 5000]
    assert read_bag(spark, bag, topics="/x/IMU", fromNs="996", toNs="5001").count() == 6
    both = df.filter("record_ns = 7").union(df.filter("record_ns = 991"))
    assert sorted(r["record_ns"] for r in both.collect()) == [7, 991] and df.count() == 12  # one frame, several queries
    assert [r["seq"] for r in got] == [5, 6, 7, 8, 9, 10]  # places in the whole topic
    split = read_bag(spark, bag, splits="3")
    assert split.rdd.getNumPartitions() > 2 and sorted(map(tuple, split.drop("data").collect())) == sorted(map(tuple, df.drop("data").collect()))
    with pytest.raises(Exception, match="/cloud"):
        read_bag(spark, bag, must="/nothing").count()


def test_imu_decode_drops_what_is_malformed(spark, bag):
    got = decode_imu(read_bag(spark, bag, topics="/x/IMU")).orderBy("record_ns")
    rows = got.collect()
    assert len(rows) == 10
    assert rows[0]["quat"] == [0.0, 1.0, 2.0, 3.0] and rows[0]["gyro"] == [13.0, 14.0, 15.0] and rows[0]["accel"] == [25.0, 26.0, 27.0]
    assert rows[0]["header_ns"] == 5_000_000_009
    assert got.select(stamp(got, "record").alias("t")).first()["t"] == 991
    assert decode_imu_bytes(b"") is None
    for frame in ("", "a", "abcdefg", "abcdefgh"):
        assert decode_imu_bytes(imu_message(1, 2, frame, range(37)))[1:5] == (0.0, 1.0, 2.0, 3.0)


def test_clouds_and_images(spark, tmp_path):
    xyz = np.array([[1, 2, 3], [4, 5, np.nan], [7, 8, 9]], "<f4")
    head = "VERSION .7\nFIELDS x y z\nSIZE 4 4 4\nTYPE F F F\nCOUNT 1 1 1\nWIDTH 3\nHEIGHT 1\nPOINTS 3\n"
    (tmp_path / "a.pcd").write_bytes(head.encode() + b"DATA binary\n" + xyz.tobytes())
    (tmp_path / "b.pcd").write_text(head + "DATA ascii\n1 2 3\n4 5 nan\n7 8 9\n")
    got = sorted((r["file"][-5:], r["x"], r["z"]) for r in read_clouds(spark, str(tmp_path)).collect())
    assert got == [("a.pcd", 1, 3), ("a.pcd", 7, 9), ("b.pcd", 1, 3), ("b.pcd", 7, 9)]
    assert decode_image(bytes([1, 2, 3]), 1, 1, "rgb8").tolist() == [[[3, 2, 1]]]
    with pytest.raises(ValueError):
        decode_image(b"", 1, 1, "yuv")
    with pytest.raises(ValueError, match="compressed"):
        parse_pcd(head.encode() + b"DATA binary_compressed\n" + xyz.tobytes())
    np.save(tmp_path / "c.npy", np.arange(6000.0).reshape(1500, 4))
    assert read_clouds(spark, str(tmp_path / "c.npy")).count() == 1500
    with pytest.raises(ValueError, match="needs 1000"):
        parse_npy((lambda b: (np.save(b, np.zeros((3, 3))), b.getvalue())[1])(io.BytesIO()))
    df = spark.createDataFrame([(1, bytearray([1, 2, 3, 4]), 2, 2, "mono8")], "image_id long, data binary, height int, width int, encoding string")
    assert sorted(tuple(r) for r in pixel_table(df).collect())[1] == (1, 0, 1, 3, 3, 3)


def test_calibration_file():
    text = "K: !!opencv-matrix\n  rows: 3\n  cols: 3\n  dt: d\n  data: [800., 0., 900.,\n 0., 801., 500., 0., 0., 1.]\nD: !!opencv-matrix\n  data: [1, 2, 3, 4, 5]\n"
    cal = read_calibration(text)
    assert (cal.fx, cal.cx, cal.cy, cal.distortion) == (800.0, 900.0, 500.0, (1.0, 2.0, 3.0, 4.0, 5.0))
    with pytest.raises(ValueError, match="camera matrix"):
        read_calibration("D: 1")


def test_curve_csv(spark, tmp_path):
    df = spark.createDataFrame([(2, "LID", 1.5), (1, "CAM", 0.25)], "seq long, kind string, stamp double")
    write_curves(df, str(tmp_path / "c"), {"stamp": 6}, "seq")
    lines = [x for f in sorted((tmp_path / "c").glob("part-*")) for x in f.read_text().splitlines() if x != "kind,stamp"]
    assert lines == ["CAM,0.250000", "LID,1.500000"]
