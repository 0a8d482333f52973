"""Live colouring of scans from images as one stateful step: recorded messages in, coloured points out, each scan once.

A scan and an image are a pair if each is the other's nearest within the slop, the rule of `pair_nearest`. Rivals of a pair are at most two
slops away, so a scan is settled when the watermark has passed it by that much; a timer waits for it. What is four slops old goes,
so the state of a rig is the messages of the watermark's delay and four slops, however long the stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from scanloom.functions.calibration import Calibration
from scanloom.sources.clouds import decode_image
from scanloom.sources.messages import Cursor, cloud_points, raw_image

OUT = "rig string, scan_id long, image_id long, point_id long, x double, y double, z double, time double, rgb long"


def projected(points: np.ndarray, cal: Calibration) -> tuple[np.ndarray, ...]:
    """(row, u, v, depth) of points (x, y, z) in front of the camera; pixels rounded half to even, whether or not they are in the image."""
    x, y, z = (sum(points[:, j] * float(turn[j]) for j in range(3)) + float(shift) for turn, shift in zip(cal.rotation, cal.shift))
    row = np.flatnonzero(z > 0)
    z = z[row]
    x, y = x[row] / z, y[row] / z
    k1, k2, p1, p2, k3 = cal.distortion
    r2 = x * x + y * y
    radial = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
    u = np.rint(cal.fx * (x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x)) + cal.cx)
    v = np.rint(cal.fy * (y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y) + cal.cy)
    return row, u, v, z


def coloured(points: np.ndarray, image: np.ndarray, cal: Calibration) -> tuple[np.ndarray, np.ndarray]:
    """(row, rgb) of points (x, y, z) in front of the camera that fall into the image after rounding half to even."""
    row, u, v, _ = projected(points, cal)
    inside = (u >= 0) & (u < cal.width) & (v >= 0) & (v < cal.height)
    row, u, v = row[inside], u[inside].astype(int), v[inside].astype(int)
    rgb = np.zeros(len(row), np.int64)
    there = (u < image.shape[1]) & (v < image.shape[0])
    b, g, r = image[v[there], u[there]].astype(np.int64).T
    rgb[there] = (255 << 24) | (r << 16) | (g << 8) | b
    return row, rgb


def nearest_of(us: int, others: list[tuple[int, int]], slop_us: int) -> tuple[int, int] | None:
    """Of (us, id) the nearest within the slop; ties go to the earlier, then the smaller id."""
    near = [(abs(us - t), t, i) for t, i in others if abs(us - t) <= slop_us]
    return min(near)[1:] if near else None


class LivePairs(StatefulProcessor):
    """Gives each pair of a scan and an image once, in order of the scans' stamps, as soon as it is settled, to `paired` of the class that is
    made of this one. State: messages by kind and number, with their stamps and payloads. A message that comes again is passed over."""

    columns = OUT

    def __init__(self, cal: Calibration, slop_us: int) -> None:
        self.cal, self.slop = cal, slop_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "kind string, id long", "us long, done boolean, data binary")

    def paired(self, rig: str, scan: tuple[int, int], image: tuple[int, int], cloud: bytes, picture: bytes) -> Iterator[pd.DataFrame]:
        """Rows of a pair; scan and image: (us, id)."""
        raise NotImplementedError

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for pdf in rows:
            for r in pdf.itertuples():
                if self.held.containsKey((r.kind, int(r.id))):
                    continue
                self.held.updateValue((r.kind, int(r.id)), (int(r.us), False, bytes(r.data)))
                if r.kind == "scan":
                    self.handle.registerTimer(self.settled_ms(int(r.us)))
        yield pd.DataFrame({c.split()[0]: [] for c in self.columns.split(", ")}).astype({"rig": "object"})

    def settled_ms(self, us: int) -> int:
        return (us + 2 * self.slop) // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs()
        held = {k: (v[0], v[1]) for k, v in self.held.iterator()}
        scans = sorted((us, i) for (kind, i), (us, _) in held.items() if kind == "scan")
        images = sorted((us, i) for (kind, i), (us, _) in held.items() if kind == "image")
        for us, i in scans:
            if held["scan", i][1] or self.settled_ms(us) > now:
                continue
            _, _, data = self.held.getValue(("scan", i))
            self.held.updateValue(("scan", i), (us, True, b""))
            best = nearest_of(us, images, self.slop)
            if best and nearest_of(best[0], scans, self.slop) == (us, i):
                yield from self.paired(key[0], (us, i), best, bytes(data), bytes(self.held.getValue(("image", best[1]))[2]))
        for (kind, i), (us, _) in held.items():
            if us + 4 * self.slop < now * 1000:
                self.held.removeKey((kind, i))

    def close(self) -> None:
        pass


class LiveColours(LivePairs):
    """A scan's points with the colours of its image."""

    def paired(self, rig: str, scan: tuple[int, int], image: tuple[int, int], cloud: bytes, picture: bytes) -> Iterator[pd.DataFrame]:
        points = cloud_points(cloud)[1]
        _, raw, height, width, encoding = raw_image(picture)
        row, rgb = coloured(points, decode_image(raw, height, width, encoding), self.cal)
        columns = {"rig": rig, "scan_id": scan[1], "image_id": image[1], "point_id": row}
        yield pd.DataFrame(columns | {c: points[row, k] for k, c in enumerate(("x", "y", "z", "time"))} | {"rgb": rgb})


def stamped(bag: DataFrame, cloud_topic: str, image_topic: str) -> DataFrame:
    """(rig, kind, id, us, ts, data) of the two topics' messages by header stamp; a rig is a file. Messages that can't be read are
    dropped. bag: batch or stream."""

    def stamps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for m in batch.itertuples():
                data, kind = bytes(m.data), "scan" if m.topic == cloud_topic else "image"
                try:
                    (cloud_points if kind == "scan" else raw_image)(data)
                    rows.append((m.file, kind, m.seq, Cursor(data).stamp() // 1000, data))
                except ValueError:
                    continue
            yield pd.DataFrame(rows, columns=["rig", "kind", "id", "us", "data"])

    both = bag.filter(F.col("topic").isin(cloud_topic, image_topic)).select("file", "topic", "seq", "data")
    out = both.mapInPandas(stamps, "rig string, kind string, id long, us long, data binary")
    return out.withColumn("ts", F.timestamp_micros("us"))


def live_colours(bag: DataFrame, cloud_topic: str, image_topic: str, cal: Calibration, slop_us: int, late: str) -> DataFrame:
    """Coloured points of a stream of messages: rig, scan_id, image_id (numbers of the messages), point_id (place among the scan's finite
    points), x, y, z, time, rgb. late: the watermark's delay; what comes later than that is dropped."""
    rows = stamped(bag, cloud_topic, image_topic).withWatermark("ts", late)
    return rows.groupBy("rig").transformWithStateInPandas(LiveColours(cal, slop_us), OUT, "Append", "EventTime")
