"""Recordings as tables: messages of a sqlite bag, decoded inertial samples, calibration files.

A bag is one sqlite file with topics(id, name, type) and messages(topic_id, timestamp, data). The data source plans one partition for
each file and topic and pushes filters on topic and record time into the file's own query. Files must be where executors can
open them."""

from __future__ import annotations

import glob
import os
import re
import sqlite3
import struct
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
)

from scanloom.functions.calibration import Calibration
from scanloom.sources.bag_stream import ROWS, BagStreamReader

SCHEMA = "file string, topic string, msg_type string, record_ns long, seq long, data binary"


@dataclass
class _Part(InputPartition):
    file: str
    topic_id: int
    topic: str
    kind: str
    low: int | None = None
    high: int | None = None


class _Reader(DataSourceReader):
    def __init__(
        self, path: str, topics: set[str] | None, must: str | None, splits: int = 1, only_topics: bool = False,
        pushdown: bool = False
    ) -> None:
        self.path, self.topics, self.must, self.splits, self.only_topics = path, topics, must, splits, only_topics
        self.pushdown, self.where = pushdown, []  # where: (sign, record time)

    def pushFilters(self, filters):  # noqa: N802
        if not self.pushdown:
            yield from filters
            return
        signs = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("topic",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.topics = values if self.topics is None else self.topics & values
            elif type(f) in signs and f.attribute == ("record_ns",):
                self.where.append((signs[type(f)], int(f.value)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        files = [self.path] if os.path.isfile(self.path) else sorted(glob.glob(os.path.join(self.path, "**", "*.db3"), recursive=True))
        parts, seen = [], set()
        for file in files:
            with sqlite3.connect(f"file:{file}?mode=ro", uri=True) as db:
                for topic_id, name, kind in db.execute("SELECT id, name, type FROM topics ORDER BY id"):
                    seen.add(name)
                    if self.topics is None or name in self.topics:
                        parts += self.split(db, _Part(file, topic_id, name, kind))
        if self.must and self.must not in seen:
            raise ValueError(f"no topic {self.must}; there are: {', '.join(sorted(seen))}")
        return parts or [_Part("", 0, "", "")]

    def split(self, db: sqlite3.Connection, part: _Part) -> list[InputPartition]:
        """The topic in `splits` parts of equal time."""
        if self.splits < 2 or self.only_topics:
            return [part]
        low, high = db.execute("SELECT min(timestamp), max(timestamp) FROM messages WHERE topic_id = ?", (part.topic_id,)).fetchone()
        if low is None or low == high:
            return [part]
        cuts = sorted({low + (high - low) * i // self.splits for i in range(1, self.splits)} - {low})
        return [replace(part, low=a, high=b) for a, b in zip([None, *cuts], [*cuts, None])]

    def read(self, part: _Part) -> Iterator[tuple]:
        if not part.file:
            return
        if self.only_topics:
            yield part.file, part.topic, part.kind, None, part.topic_id, None
            return
        # A message's number is its place in the whole topic, whatever is filtered.
        sql = """SELECT timestamp, seq, data FROM messages JOIN
            (SELECT rowid AS r, row_number() OVER (ORDER BY timestamp, rowid) - 1 AS seq FROM messages WHERE topic_id = ?) n
            ON messages.rowid = n.r WHERE true"""
        where = [*self.where, *([(">=", part.low)] if part.low is not None else []), *([("<", part.high)] if part.high is not None else [])]
        sql += "".join(f" AND timestamp {sign} ?" for sign, _ in where)
        with sqlite3.connect(f"file:{part.file}?mode=ro", uri=True) as db:
            for ns, seq, data in db.execute(sql, (part.topic_id, *[v for _, v in where])):
                yield part.file, part.topic, part.kind, ns, seq, bytearray(data)


class BagDataSource(DataSource):
    """spark.read.format("bag").load(path); options topics (comma-separated), must (a topic that has to exist),
    fromNs and toNs (record times, the latter exclusive), splits (parts by time that a topic is read in), onlyTopics (a row for each
    topic, its id as seq, no messages). pushdown="true" takes topics and times from filters of the frame as well; as Spark 4.1
    keeps one reader for a frame, such a frame must serve one query only."""

    @classmethod
    def name(cls) -> str:
        return "bag"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        topics = {x for x in self.options.get("topics", "").split(",") if x} or None
        splits, only = int(self.options.get("splits", "1")), self.options.get("onlyTopics", "false").lower() == "true"
        reader = _Reader(self.options["path"], topics, self.options.get("must"), splits, only, self.options.get("pushdown", "") == "true")
        reader.where = [(sign, int(self.options[name])) for name, sign in (("fromNs", ">="), ("toNs", "<")) if name in self.options]
        return reader


    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        """Of spark.readStream; options path, topics and rowsPerTask. Messages are numbered as they were written."""
        topics = {x for x in self.options.get("topics", "").split(",") if x} or None
        return BagStreamReader(self.options["path"], topics, int(self.options.get("rowsPerTask", ROWS)))


def stream_bag(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(BagDataSource)
    return spark.readStream.format("bag").options(**options).load(path)


def read_bag(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(BagDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("bag").options(**options).load(path)


def imu_topic(spark: SparkSession, path: str) -> str | None:
    """The last topic in the recording's own order with imu in its name whatever the case. Reads no messages."""
    topics = read_bag(spark, path, onlyTopics="true").filter(F.lower("topic").contains("imu"))
    return topics.agg(F.max_by("topic", F.struct("file", "seq")).alias("t")).collect()[0]["t"]


def decode_imu_bytes(data: bytes) -> tuple | None:
    """(header_ns, orientation x y z w, gyro x y z, accel x y z) of a little-endian message; None if it can't be one. Numbers are
    aligned to their size counted from after the four bytes of encapsulation."""
    try:
        sec, nano, n = struct.unpack_from("<iII", data, 4)
        at = 12 + n
        at += -at % 8
        values = struct.unpack_from("<37d", data, at + 4)
    except struct.error:
        return None
    return (sec * 1_000_000_000 + nano, *values[0:4], *values[13:16], *values[25:28])


IMU_FIELDS = ("header_ns", "qx", "qy", "qz", "qw", "gx", "gy", "gz", "ax", "ay", "az")


def decode_imu(bag: DataFrame) -> DataFrame:
    """seq, record_ns, quat, gyro, accel and header_ns of messages that decode; others are dropped."""

    @F.pandas_udf("header_ns long, " + ", ".join(f"{c} double" for c in IMU_FIELDS[1:]))
    def decode(data: pd.Series) -> pd.DataFrame:
        rows = [decode_imu_bytes(bytes(x)) or (None,) * 11 for x in data]
        return pd.DataFrame(rows, columns=list(IMU_FIELDS)).astype({"header_ns": "Int64"} | {c: "float64" for c in IMU_FIELDS[1:]})

    got = bag.withColumn("m", decode("data")).filter("m.header_ns IS NOT NULL")
    return got.select(
        "seq", "record_ns", F.col("m.header_ns").alias("header_ns"),
        F.array(*[F.col(f"m.{c}") for c in ("qx", "qy", "qz", "qw")]).alias("quat"),
        F.array("m.gx", "m.gy", "m.gz").alias("gyro"), F.array("m.ax", "m.ay", "m.az").alias("accel")
    )


def stamp(df: DataFrame, basis: str = "header") -> Column:
    """The clock to match on: header (when measured) or record (when written, for drivers whose header clock stands still)."""
    return {"header": df["header_ns"], "record": df["record_ns"]}[basis]


def read_calibration(text: str) -> Calibration:
    """From the text of a YAML file with matrices in rows, cols and data; the camera matrix must be there."""
    found = {
        m[1]: [float(x) for x in m[2].replace("\n", " ").split(",")] for m in re.finditer(r"(\w+):\s*!!opencv-matrix.*?data:\s*\[(.*?)\]", text, re.S)
    }
    k = next((found[n] for n in ("K", "camera_matrix") if n in found), None)
    if k is None:
        raise ValueError("no camera matrix K")
    d = next((found[n] for n in ("D", "dist_coeffs", "distortion_coefficients") if n in found), None)
    paired = re.search(r"paired_intrinsics:\s*\"?([^\s\"]+)", text)
    own = {"distortion": tuple(d)} if d else {}
    if "R_lidar_to_cam" in found and "t_lidar_to_cam" in found:
        r = found["R_lidar_to_cam"]
        own |= {"rotation": tuple(tuple(r[3 * i : 3 * i + 3]) for i in range(3)), "shift": tuple(found["t_lidar_to_cam"])}
    return Calibration(fx=k[0], fy=k[4], cx=k[2], cy=k[5], paired_intrinsics=paired[1] if paired else "", **own)
