"""Streaming twins of the live operators.

Pairing joins two streams within the slop under watermarks of at least the slop, and keeps the pairs that are each other's nearest; rolling
overlay keeps the last N scans of a sensor as state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def pair_streams(left: DataFrame, right: DataFrame, slop_ms: int, late_ms: int, ts: str = "ts", id_col: str = "seq") -> DataFrame:
    """All pairs at most `slop_ms` apart: l_id, r_id, l_ts, r_ts, dt_us. State of either side is dropped once the watermark, `late_ms`
    behind, has passed it by the slop. Nearest pairs are chosen from what the sink holds, by `settled`."""
    # A join of streams needs an equality: buckets as wide as the slop, of which a left message looks into three.
    bucket = lambda c: F.floor(F.unix_micros(c) / (slop_ms * 1000))
    a = left.select(F.col(id_col).alias("l_id"), F.col(ts).alias("l_ts")).withWatermark("l_ts", f"{late_ms} milliseconds")
    a = a.withColumn("l_b", F.explode(F.array(*[bucket("l_ts") + k for k in (-1, 0, 1)])))
    b = right.select(
        F.col(id_col).alias("r_id"), F.col(ts).alias("r_ts")
    ).withWatermark("r_ts", f"{late_ms} milliseconds").withColumn("r_b", bucket("r_ts"))
    slop = F.expr(f"INTERVAL {slop_ms} MILLISECONDS")
    joined = a.join(
        b, (F.col("l_b") == F.col("r_b")) & (F.col("r_ts") >= F.col("l_ts") - slop) & (F.col("r_ts") <= F.col("l_ts") + slop)
    ).drop("l_b", "r_b")
    return joined.withColumn("dt_us", F.abs(F.unix_micros("l_ts") - F.unix_micros("r_ts")))


def nearest(pairs: DataFrame) -> DataFrame:
    """Of candidate pairs (l_id, r_id, l_ts, r_ts, dt_us), those that are each other's nearest."""
    by_left = Window.partitionBy("l_id").orderBy("dt_us", "r_ts", "r_id")
    by_right = Window.partitionBy("r_id").orderBy("dt_us", "l_ts", "l_id")
    return pairs.withColumn("x", F.row_number().over(by_left)).withColumn("y", F.row_number().over(by_right)).filter("x = 1 AND y = 1").drop("x", "y")


def settled(pairs: DataFrame, until_us: int, slop_ms: int) -> DataFrame:
    """Of all candidate pairs so far, those that are each other's nearest and stay so: messages up to `until_us`, the watermark, have
    all been seen, so a message has all its candidates if it is older than that by the slop."""
    done = lambda c: F.unix_micros(c) + slop_ms * 1000 <= until_us
    return nearest(pairs).filter(done("l_ts") & done("r_ts"))


class LastScans(StatefulProcessor):
    """For each scan of a sensor the scans of the rolling window that ends with it, as (sensor, frame, scan_id)."""

    def __init__(self, scans: int = 25) -> None:
        self.scans = scans

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", "scan_id long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        held = [r[0] for r in self.held.get()] if self.held.exists() else []
        fresh = {int(x) for pdf in rows for x in pdf["scan_id"]} - set(held)
        # what comes again, or for the first time, after a full window has passed it has no frame any more
        fresh = sorted(x for x in fresh if len(held) < self.scans or x > held[0])
        out = []
        for scan in fresh:
            held = sorted([*held, scan])[-self.scans :]
            out += [(key[0], scan, s) for s in held if s <= scan]
        self.held.put([(s,) for s in held])
        yield pd.DataFrame(out, columns=["sensor", "frame", "scan_id"])

    def close(self) -> None:
        pass


def rolling_frames(scans: DataFrame, window: int = 25) -> DataFrame:
    """scans: stream of (sensor, scan_id), each scan once or more."""
    return scans.groupBy("sensor").transformWithStateInPandas(LastScans(window), "sensor string, frame long, scan_id long", "Append", "None")
