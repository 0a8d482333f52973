"""SLAM databases as tables: keyframes with their poses, coloured scans in the world, and images.

A database is one sqlite file with Node(id, map_id, stamp, pose) and Data(id, scan, image). A pose is twelve float32, a matrix of three rows and
four columns; a scan is deflated float32 in rows of four: x, y, z and a colour, the bits of which are 0xAARRGGBB. Bytes after the
deflated part are passed over. Files must be where executors can open them; a task reads a range of keyframes.

Cases: a keyframe without a Data row, or with an empty scan, has no points; a scan that is cut off, damaged or not in rows of four is
left out whole; points that aren't finite are left out, others keep their number; a pose of another length, not finite or all zero
(a keyframe that the optimiser left out) is null, and such a keyframe has no points in the world. `scan_status` tells all of these apart."""

from __future__ import annotations

import glob
import os
import sqlite3
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from scanloom.sources.frames import decode_png

#: Keyframes that one task reads, and points of a slice.
ROWS, SLICE = 1000, 100_000
SCHEMA = "file string, node_id long, map_id long, stamp double, pose array<double>, scan binary, image binary"


@dataclass
class _Nodes(InputPartition):
    """Keyframes from id `low` up to, but without, `high`."""

    file: str
    low: int = 0
    high: int | None = None


def pose_of(blob: bytes | None) -> list[float] | None:
    if blob is None or len(blob) != 48:
        return None
    values = struct.unpack("<12f", blob)
    return list(values) if np.isfinite(values).all() and any(values) else None


class _Reader(DataSourceReader):
    def __init__(self, path: str, rows: int, images: bool) -> None:
        self.path, self.rows, self.images = path, rows, images

    def partitions(self) -> list[InputPartition]:
        files = [self.path] if os.path.isfile(self.path) else sorted(glob.glob(os.path.join(self.path, "**", "*.db"), recursive=True))
        parts: list[InputPartition] = []
        for file in files:
            with sqlite3.connect(f"file:{file}?mode=ro", uri=True) as db:
                cuts = "SELECT id FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM Node) WHERE place % ? = 0 ORDER BY id"
                lows = [i for (i,) in db.execute(cuts, (self.rows,))]
            parts += [_Nodes(file, low, high) for low, high in zip(lows, [*lows[1:], None])]
        return parts or [_Nodes("")]

    def read(self, part: _Nodes) -> Iterator[tuple]:
        if not part.file:
            return
        image = "d.image" if self.images else "NULL"
        sql = f"SELECT n.id, n.map_id, n.stamp, n.pose, d.scan, {image} FROM Node n LEFT JOIN Data d ON d.id = n.id WHERE n.id >= ?"
        sql += " AND n.id < ?" if part.high is not None else ""
        with sqlite3.connect(f"file:{part.file}?mode=ro", uri=True) as db:
            for node, session, stamp, pose, scan, picture in db.execute(sql, (part.low, *([part.high] if part.high is not None else []))):
                held = [None if x is None else bytearray(x) for x in (scan, picture)]
                yield part.file, node, session, stamp, pose_of(pose), *held


class SlamDataSource(DataSource):
    """spark.read.format("slam").load(path), a file or a folder of .db files; options rowsPerTask (keyframes), images ("true" reads them,
    else they are null)."""

    @classmethod
    def name(cls) -> str:
        return "slam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("rowsPerTask", ROWS)), self.options.get("images", "false").lower() == "true")


def read_slam(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Keyframes: file, node_id, map_id, stamp, pose, scan, image."""
    spark.dataSource.register(SlamDataSource)
    return spark.read.format("slam").options(**options).load(path)


def scan_rows(blob: bytes | None) -> np.ndarray:
    """(points, 4) of float32; a ValueError's text is the reason why there are none."""
    if not blob:
        raise ValueError("no scan")
    press = zlib.decompressobj()
    try:
        raw = press.decompress(blob)
    except zlib.error as e:
        raise ValueError("damaged") from e
    if not press.eof:
        raise ValueError("cut off")
    if len(raw) % 16:
        raise ValueError("layout")
    return np.frombuffer(raw, "<f4").reshape(-1, 4)


def coloured_points(rows: np.ndarray) -> dict[str, np.ndarray]:
    """Columns of the finite points: place, coordinates, and red, green and blue from the bits of the fourth number."""
    kept = np.flatnonzero(np.isfinite(rows[:, :3]).all(axis=1))
    bits = rows.view("<u4")[kept, 3].astype(np.int64)
    out = {"point_id": kept} | {a: rows[kept, i].astype(float) for i, a in enumerate("xyz")}
    return out | {c: bits >> shift & 255 for c, shift in (("r", 16), ("g", 8), ("b", 0))}


POINTS = "file string, node_id long, point_id long, x double, y double, z double, r long, g long, b long"


def together(parts: list[dict[str, np.ndarray]]) -> pd.DataFrame:
    return pd.DataFrame({c: np.concatenate([p[c] for p in parts]) for c in parts[0]})


def _points(nodes: DataFrame, world: bool) -> DataFrame:
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held: list[dict] = []
            size = 0
            for n in batch.itertuples():
                try:
                    columns = coloured_points(scan_rows(None if n.scan is None else bytes(n.scan)))
                except ValueError:
                    continue
                if world:
                    turn = np.asarray(n.pose, float).reshape(3, 4)
                    own = [columns[a] for a in "xyz"]
                    columns |= {a: sum(turn[i, j] * own[j] for j in range(3)) + turn[i, 3] for i, a in enumerate("xyz")}
                for at in range(0, len(columns["x"]), SLICE):
                    part = {c: v[at : at + SLICE] for c, v in columns.items()}
                    held.append({"file": np.full(len(part["x"]), n.file, object), "node_id": np.full(len(part["x"]), n.node_id)} | part)
                    size += len(part["x"])
                    if size >= SLICE:
                        yield together(held)
                        held, size = [], 0
            if held:
                yield together(held)

    taken = nodes.filter("pose IS NOT NULL") if world else nodes
    return taken.select("file", "node_id", "scan", *(["pose"] if world else [])).mapInPandas(decode, POINTS)


def scan_points(nodes: DataFrame) -> DataFrame:
    """file, node_id, point_id, x, y, z, r, g, b in the sensor's coordinates."""
    return _points(nodes, False)


def world_points(nodes: DataFrame) -> DataFrame:
    """The same in the world, by each keyframe's pose."""
    return _points(nodes, True)


def scan_status(nodes: DataFrame) -> DataFrame:
    """(file, node_id, n, finite, posed, reason) of each keyframe: points in its scan, finite ones, whether it has a pose, and why its scan
    isn't read, else null."""

    def status(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = []
            for scan in batch["scan"]:
                try:
                    rows = scan_rows(None if scan is None else bytes(scan))
                    told.append((len(rows), int(np.isfinite(rows[:, :3]).all(axis=1).sum()), None))
                except ValueError as e:
                    told.append((0, 0, str(e)))
            yield batch[["file", "node_id", "posed"]].assign(**{c: [t[i] for t in told] for i, c in enumerate(("n", "finite", "reason"))})

    held = nodes.select("file", "node_id", F.col("pose").isNotNull().alias("posed"), "scan")
    return held.mapInPandas(status, "file string, node_id long, posed boolean, n long, finite long, reason string")


def rejects(nodes: DataFrame) -> DataFrame:
    """(file, reason, nodes): keyframes by why they have no points in the world; 'no pose' if the scan can be read."""
    reason = F.coalesce("reason", F.when(~F.col("posed"), F.lit("no pose")))
    return scan_status(nodes).withColumn("reason", reason).filter("reason IS NOT NULL").groupBy("file", "reason").agg(F.count("*").alias("nodes"))


def _entries(*places: int) -> Column:
    return F.array(*[F.col("pose")[i] for i in places])


def sensor_poses(nodes: DataFrame) -> DataFrame:
    """(file, idx, stamp, r, t) of keyframes with a pose, as texturing takes them."""
    posed = nodes.filter("pose IS NOT NULL")
    return posed.select("file", F.col("node_id").alias("idx"), "stamp", _entries(0, 1, 2, 4, 5, 6, 8, 9, 10).alias("r"), _entries(3, 7, 11).alias("t"))


def node_images(nodes: DataFrame) -> DataFrame:
    """(file, idx, ok, data, height, width, encoding) of keyframes that hold an image; PNG ones are read, others are not ok. Needs
    images="true"."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n in batch.itertuples():
                try:
                    image = decode_png(bytes(n.image))
                    row = (n.file, n.idx, True, image.tobytes(), *image.shape[:2], "bgr8")
                except ValueError:
                    row = (n.file, n.idx, False, None, None, None, None)
                yield pd.DataFrame([row], columns=["file", "idx", "ok", "data", "height", "width", "encoding"]).astype({"height": "Int32", "width": "Int32"})

    held = nodes.filter("image IS NOT NULL AND length(image) > 0").select("file", F.col("node_id").alias("idx"), "image")
    return held.mapInPandas(decode, "file string, idx long, ok boolean, data binary, height int, width int, encoding string")
