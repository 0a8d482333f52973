"""Recorded messages to points, poses and images. Payloads are little-endian CDR: four bytes of encapsulation, then fields
aligned to their size. What can't be decoded is dropped; `rejects` counts it by topic. Images in an encoding or a compressed format that
isn't read fail the job: a whole topic would vanish otherwise."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.sources.frames import MAGIC, decode_png

#: PointField datatype codes of the public message definition to numpy types. Fixed values.
POINT_KINDS = {1: "i1", 2: "u1", 3: "<i2", 4: "<u2", 5: "<i4", 6: "<u4", 7: "<f4", 8: "<f8"}


#: Bytes of a pixel of the encodings that are read. Fixed values.
PIXEL_BYTES = {"mono8": 1, "bgr8": 3, "rgb8": 3}


class UnknownEncoding(RuntimeError):
    """A whole image in an encoding or format that isn't read; no malformed message."""


class Cursor:
    """Reads CDR fields one after another; too short a payload raises ValueError."""

    def __init__(self, data: bytes) -> None:
        if len(data) < 4 or data[1] != 1:
            raise ValueError("not little-endian CDR")
        self.data, self.at = data, 4

    def numbers(self, kind: str, n: int = 1) -> tuple:
        size = struct.calcsize("<" + kind)
        self.at += -(self.at - 4) % size
        try:
            out = struct.unpack_from(f"<{n}{kind}", self.data, self.at)
        except struct.error as e:
            raise ValueError("cut off") from e
        self.at += n * size
        return out

    def number(self, kind: str):
        return self.numbers(kind)[0]

    def blob(self) -> bytes:
        n = self.number("I")
        if self.at + n > len(self.data):
            raise ValueError("cut off")
        self.at += n
        return self.data[self.at - n : self.at]

    def text(self) -> str:
        return self.blob().rstrip(b"\0").decode("utf-8", "replace")

    def stamp(self) -> int:
        """Nanoseconds of a header, whose frame is passed over."""
        ns = self.number("i") * 1_000_000_000 + self.number("I")
        self.text()
        return ns


def cloud_points(data: bytes) -> tuple[int, np.ndarray]:
    """(header_ns, rows of x, y, z, time): points with finite coordinates; time is 0 where the sensor gives none."""
    c = Cursor(data)
    ns, height, width = c.stamp(), c.number("I"), c.number("I")
    fields = {}
    for _ in range(c.number("I")):
        name, offset, kind, _count = c.text(), c.number("I"), c.number("B"), c.number("I")
        fields[name] = (offset, POINT_KINDS.get(kind))
    big, step, row = c.number("B"), c.number("I"), c.number("I")
    raw = c.blob()
    if big or any(fields.get(a, (0, None))[1] is None for a in "xyz") or len(raw) < height * row or row < width * step:
        raise ValueError("layout")
    lines = np.frombuffer(raw, np.uint8, height * row).reshape(height, row)[:, : width * step].reshape(-1, step)
    column = lambda f: np.ascontiguousarray(lines[:, f[0] : f[0] + np.dtype(f[1]).itemsize]).view(f[1]).ravel().astype(float)
    time = next((fields[n] for n in ("time", "t", "timestamp", "stamps") if n in fields), None)
    xyz = [column(fields[a]) for a in "xyz"]
    table = np.column_stack((*xyz, column(time) if time else np.zeros(len(lines))))
    return ns, table[np.isfinite(table[:, :3]).all(axis=1)]


def odometry_pose(data: bytes) -> tuple[int, list[float], list[float]]:
    """(header_ns, position, quaternion x y z w)."""
    c = Cursor(data)
    ns = c.stamp()
    c.text()
    values = c.numbers("d", 7)
    return ns, list(values[:3]), list(values[3:])


def raw_image(data: bytes) -> tuple[int, bytes, int, int, str]:
    """(header_ns, pixels without row padding, height, width, encoding)."""
    c = Cursor(data)
    ns, height, width, encoding = c.stamp(), c.number("I"), c.number("I"), c.text()
    c.number("B")
    step, raw = c.number("I"), c.blob()
    if len(raw) < height * step:
        raise ValueError("layout")
    if encoding not in PIXEL_BYTES:
        raise UnknownEncoding(f"images in {encoding} aren't read, only {', '.join(PIXEL_BYTES)}")
    used = width * PIXEL_BYTES[encoding]
    if step < used:
        raise ValueError("layout")
    rows = np.frombuffer(raw, np.uint8, height * step).reshape(height, step)[:, :used]
    return ns, rows.tobytes(), height, width, encoding


def compressed_image(data: bytes) -> tuple[int, bytes, int, int, str]:
    """The same of a compressed image message. PNG is read; a whole payload of another kind is no malformed message."""
    c = Cursor(data)
    ns, kind, raw = c.stamp(), c.text(), c.blob()
    if not raw:
        raise ValueError("no image")
    if raw[: len(MAGIC)] != MAGIC:
        if raw[:4] == MAGIC[:4]:
            raise ValueError("cut off")
        raise UnknownEncoding(f"compressed images in {kind} aren't read, only png")
    image = decode_png(raw)
    return ns, image.tobytes(), *image.shape[:2], "bgr8"


def _decoded(bag: DataFrame, schema: str, rows_of: Callable[..., Iterator[dict]], *more: str) -> DataFrame:
    """rows_of: from a payload, and the bag's columns `more`, to columns, as dicts of equal-length lists; ValueError drops the message."""
    names = [x.split()[0] for x in schema.split(", ")]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for message in batch.itertuples():
                try:
                    columns = rows_of(bytes(message.data), *[getattr(message, c) for c in more])
                except ValueError:
                    continue
                out = pd.DataFrame(columns)
                for name in ("file", "topic", "seq", "record_ns"):
                    out[name] = getattr(message, name)
                yield out[["file", "topic", "seq", "record_ns", *names]]

    held = bag.select("file", "topic", "seq", "record_ns", "data", *more)
    return held.mapInPandas(decode, f"file string, topic string, seq long, record_ns long, {schema}")


def decode_points(bag: DataFrame) -> DataFrame:
    """file, topic, seq, record_ns, header_ns, point_id, x, y, z, time of point cloud messages; a message is a scan."""

    def rows(data: bytes) -> dict:
        ns, p = cloud_points(data)
        return {"header_ns": np.full(len(p), ns), "point_id": np.arange(len(p))} | {c: p[:, i] for i, c in enumerate(("x", "y", "z", "time"))}

    return _decoded(bag, "header_ns long, point_id long, x double, y double, z double, time double", rows)


def decode_odometry(bag: DataFrame) -> DataFrame:
    """file, topic, seq, record_ns, ns (header), pos, quat of odometry messages."""

    def rows(data: bytes) -> dict:
        ns, pos, quat = odometry_pose(data)
        return {"ns": [ns], "pos": [pos], "quat": [quat]}

    return _decoded(bag, "ns long, pos array<double>, quat array<double>", rows)


def decode_images(bag: DataFrame) -> DataFrame:
    """file, topic, seq, record_ns, header_ns, data, height, width, encoding of image messages, raw ones and, by their type, compressed ones
    (PNG; other formats fail the job)."""

    def rows(data: bytes, kind: str | None) -> dict:
        image = (compressed_image if "CompressedImage" in (kind or "") else raw_image)(data)
        return {name: [value] for name, value in zip(("header_ns", "data", "height", "width", "encoding"), image)}

    return _decoded(bag, "header_ns long, data binary, height int, width int, encoding string", rows, "msg_type")


#: What tells whether a payload is whole, by what it should be.
READERS = {"points": cloud_points, "odometry": odometry_pose, "images": raw_image, "compressed": compressed_image}


def rejects(bag: DataFrame, kind: str) -> DataFrame:
    """(topic, messages, decoded, rejected) of messages that should be points, odometry, images or compressed images. A message that can be read counts as
    decoded, whether it holds a point or not."""
    reader = READERS[kind]

    def status(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = []
            for data in batch["data"]:
                try:
                    reader(bytes(data))
                    ok.append(True)
                except ValueError:
                    ok.append(False)
            yield pd.DataFrame({"topic": batch["topic"], "ok": pd.Series(ok, dtype=bool)})

    told = bag.select("topic", "data").mapInPandas(status, "topic string, ok boolean")
    counts = told.groupBy("topic").agg(F.count("*").alias("messages"), F.count_if("ok").alias("decoded"))
    return counts.withColumn("rejected", F.col("messages") - F.col("decoded"))


def at_least(df: DataFrame, n: int, what: str) -> DataFrame:
    """df, if it has n rows or more; else ValueError. Looks at n rows only."""
    found = df.limit(n).count()
    if found < n:
        raise ValueError(f"{found} {what}, needs {n}")
    return df
