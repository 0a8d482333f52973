"""Live overlay: images with the last scans drawn over them, one frame for each pair of a scan and an image, and a sink of PNG files.

Pairs and their order are those of `live.LivePairs`. Beside its messages a rig's state holds the finite points of the last scans that had
a pair and any such point, by stamp and number, so that it doesn't grow with the stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BinaryType

from scanloom.functions.calibration import Calibration
from scanloom.operators.cloud import DOT
from scanloom.sources.clouds import decode_image
from scanloom.sources.frames import deflated, png_of, write_files
from scanloom.sources.messages import cloud_points, raw_image
from scanloom.streaming.live import LivePairs, projected, stamped

OUT = "rig string, scan_id long, image_id long, us long, scans long, height long, width long, data binary"


def drawn(image: np.ndarray, scans: Sequence[np.ndarray], cal: Calibration) -> np.ndarray | None:
    """The image (blue, green, red) with dots of radius 1 for the points of the scans, later ones over earlier ones, near red and far blue
    between the nearest and farthest in front; None if no point is in front."""
    _, u, v, d = projected(np.concatenate(scans), cal)
    if not len(d):
        return None
    ratio = (d - d.min()) / max(d.max() - d.min(), 1e-3)
    height, width = image.shape[:2]
    inside = (u >= 0) & (u < width) & (v >= 0) & (v < height)
    u, v, ratio = u[inside].astype(int), v[inside].astype(int), ratio[inside]
    colour = np.column_stack(((255 * ratio).astype(np.uint8), np.zeros(len(ratio), np.uint8), (255 * (1 - ratio)).astype(np.uint8)))
    shift = np.array(DOT)
    x, y = (u[:, None] + shift[:, 0]).ravel(), (v[:, None] + shift[:, 1]).ravel()
    kept = (x >= 0) & (x < width) & (y >= 0) & (y < height)
    x, y, colour = x[kept], y[kept], np.repeat(colour, len(DOT), axis=0)[kept]
    # the last dot on a pixel: the first in reverse
    place, last = np.unique((y * width + x)[::-1], return_index=True)
    out = image.copy()
    out.reshape(-1, 3)[place] = colour[::-1][last]
    return out


class LiveOverlay(LivePairs):
    columns = OUT

    def __init__(self, cal: Calibration, slop_us: int, scans: int) -> None:
        super().__init__(cal, slop_us)
        self.scans = scans

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.recent = handle.getMapState("recent", "us long, id long", "points binary")

    def paired(self, rig: str, scan: tuple[int, int], image: tuple[int, int], cloud: bytes, picture: bytes) -> Iterator[pd.DataFrame]:
        points = np.ascontiguousarray(cloud_points(cloud)[1][:, :3], "<f8")
        if len(points):
            self.recent.updateValue(scan, (points.tobytes(),))
        held = sorted(tuple(k) for k in self.recent.keys())
        for k in held[: -self.scans]:
            self.recent.removeKey(k)
        held = held[-self.scans :]
        _, raw, height, width, encoding = raw_image(picture)
        stack = [np.frombuffer(bytes(self.recent.getValue(k)[0]), "<f8").reshape(-1, 3) for k in held]
        frame = drawn(decode_image(raw, height, width, encoding), stack, self.cal) if held else None
        if frame is not None:
            row = (rig, scan[1], image[1], image[0], len(held), height, width, frame.tobytes())
            yield pd.DataFrame([row], columns=[c.split()[0] for c in OUT.split(", ")])


def live_overlay(bag: DataFrame, cloud_topic: str, image_topic: str, cal: Calibration, slop_us: int, late: str, scans: int = 25) -> DataFrame:
    """Frames of a stream of messages: rig, scan_id, image_id, us (the image's stamp), scans (how many are drawn), height, width, data (blue,
    green, red). late: the watermark's delay; what comes later than that is dropped."""
    rows = stamped(bag, cloud_topic, image_topic).withWatermark("ts", late)
    return rows.groupBy("rig").transformWithStateInPandas(LiveOverlay(cal, slop_us, scans), OUT, "Append", "EventTime")


def frame_files(frames: DataFrame) -> DataFrame:
    """(file, content): a PNG for each frame, named by its recording's name, its image's stamp and its scan's number."""

    def png(height: pd.Series, width: pd.Series, data: pd.Series) -> pd.Series:
        images = (np.frombuffer(bytes(d), np.uint8).reshape(h, w, 3)[:, :, ::-1] for h, w, d in zip(height, width, data))
        return pd.Series([png_of([deflated(np.ascontiguousarray(x))], x.shape[1], x.shape[0]) for x in images])

    base = F.regexp_replace(F.element_at(F.split("rig", "/"), -1), r"\.[^.]*$", "")
    name = F.format_string("%s_%020d_%06d.png", base, F.col("us"), F.col("scan_id"))
    return frames.select(name.alias("file"), F.pandas_udf(png, BinaryType())("height", "width", "data").alias("content"))


def write_overlay(frames: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Starts a query that writes each frame as a file below path. A batch that runs again writes the same files under the same names."""
    sink = lambda batch, _: write_files(frame_files(batch), path)
    out = frames.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (out.trigger(**trigger) if trigger else out).start()
