"""Point clouds: extents, colouring from an image, overlay of the last scans."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.functions import geo
from scanloom.functions.calibration import Calibration
from scanloom.operators.ordered import numbered, quantiles
from scanloom.operators.scan import nearest_k
from scanloom.sources.clouds import decode_image


def finite_points(points: DataFrame) -> DataFrame:
    return points.filter(geo.finite(*geo.cols("x", "y", "z")))


def extents(points: DataFrame, room: float = 3.5) -> DataFrame:
    """One row: points, robust (1st to 99th percentile, exact) and full extent per axis, and whether the least robust extent is
    that of a room."""
    kept = finite_points(points)
    q = quantiles(kept, {f"{a}{p}": (F.col(a), p / 100) for a in "xyz" for p in (1, 99)})
    robust = q.select(*[(F.col(f"{a}99") - F.col(f"{a}1")).alias(f"robust_{a}") for a in "xyz"])
    out = kept.agg(F.count("*").alias("n"), *[(F.max(a) - F.min(a)).alias(f"full_{a}") for a in "xyz"])
    out = out.join(F.broadcast(robust), F.lit(True), "left").select("n", *[f"robust_{a}" for a in "xyz"], *[f"full_{a}" for a in "xyz"])
    return out.withColumn("plausible", F.least("robust_x", "robust_y", "robust_z") < room)


def range_shares(points: DataFrame) -> DataFrame:
    """Shares of points within 5 and 10 of the origin and beyond 50."""
    d = geo.norm(geo.cols("x", "y", "z"))
    return points.agg(
        F.avg((d < 5).cast("double")).alias("within_5"), F.avg((d < 10).cast("double")).alias("within_10"),
        F.avg((d > 50).cast("double")).alias("beyond_50")
    )


def downsample(points: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """At most `most` points, by seeded hash of their values: the same ones on every run. A top-k, kept per task before it meets."""
    return points.orderBy(F.xxhash64(F.lit(seed), *points.columns), *points.columns).limit(most)


def time_field(columns: list[str]) -> str | None:
    """The first of the names under which drivers give a point's time."""
    return next((c for c in ("time", "t", "timestamp", "stamps") if c in columns), None)


def colourise(points: DataFrame, pixels: DataFrame, cal: Calibration, keep_all: bool = False) -> DataFrame:
    """Points with rgb from the pixel they fall on, rounded half to even, and with a time (0 if the driver gives none). pixels: image_id, u, v, b, g, r; points have image_id.
    Points behind the camera go; those outside the image go too, or keep rgb 0 and `inside` false with `keep_all`."""
    t = time_field(points.columns)
    q = geo.transform(cal.rotation, cal.shift, geo.cols("x", "y", "z"))
    p = points.withColumn("_time", F.col(t).cast("double") if t else F.lit(0.0)).withColumn("_p", geo.pixel(cal, q)).filter("_p IS NOT NULL")
    p = p.withColumns({"u": F.rint("_p.u").try_cast("int"), "v": F.rint("_p.v").try_cast("int")})
    if not keep_all:  # a point without a pixel number lies far outside
        p = p.filter(geo.in_frame(cal, F.col("u"), F.col("v")))
    joined = p.join(pixels, ["image_id", "u", "v"], "left" if keep_all else "inner")
    rgb = F.when(F.col("r").isNull(), F.lit(0).cast("long")).otherwise(geo.pack_rgb(F.col("r"), F.col("g"), F.col("b")))
    kept = [c for c in points.columns if c not in ("image_id", t)]
    inside = [geo.in_frame(cal, F.col("u"), F.col("v")).alias("inside")] if keep_all else []
    return joined.select("image_id", *kept, F.col("_time").alias("time"), rgb.alias("rgb"), *inside)


def colourise_frames(points: DataFrame, images: DataFrame, cal: Calibration, keep_all: bool = False) -> DataFrame:
    """The same from whole images (image_id, data, height, width, encoding), one for each scan: an image travels as one row
    and meets its scan's points once, and three of its bytes are read for each."""
    t = time_field(points.columns)
    q = geo.transform(cal.rotation, cal.shift, geo.cols("x", "y", "z"))
    p = points.withColumns({"_time": F.col(t).cast("double") if t else F.lit(0.0), "_p": geo.pixel(cal, q)}).filter("_p IS NOT NULL")
    p = p.withColumns({"u": F.rint("_p.u").try_cast("int"), "v": F.rint("_p.v").try_cast("int")}).drop("_p")
    if not keep_all:
        p = p.filter(geo.in_frame(cal, F.col("u"), F.col("v")))
    kept = [c for c in points.columns if c not in ("image_id", t)]
    p = p.select("image_id", *kept, F.col("_time").alias("time"), F.coalesce("u", F.lit(-1)).alias("u"), F.coalesce("v", F.lit(-1)).alias("v"))
    names = ["image_id", *kept, "time"]
    kinds = ", ".join(f"`{c}` {p.schema[c].dataType.simpleString()}" for c in names)

    def gather(part: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        rgb = np.zeros(len(part), np.int64)
        if len(part) and len(frame):
            f = frame.iloc[0]
            image = decode_image(bytes(f["data"]), int(f["height"]), int(f["width"]), f["encoding"])
            u, v = part["u"].to_numpy(), part["v"].to_numpy()
            ok = (u >= 0) & (v >= 0) & (u < image.shape[1]) & (v < image.shape[0])
            b, g, r = image[v[ok], u[ok]].astype(np.int64).T
            rgb[ok] = (255 << 24) | (r << 16) | (g << 8) | b
        return part[names].assign(rgb=rgb)

    return p.groupBy("image_id").cogroup(images.groupBy("image_id")).applyInPandas(gather, f"{kinds}, rgb long")


def rolling_overlay(points: DataFrame, cal: Calibration, scans: int = 25, by: str = "scan_id") -> DataFrame:
    """For each scan the points of the last `scans` non-empty scans, projected, in frame after rounding, coloured by depth between the nearest
    and farthest of them in front: frame, u, v, b, g, red.

    The window runs over scans, not points; points are joined to the frames that hold their scan."""
    frames = frames_of(points, scans, by).drop("place")
    front, ranges = _in_front(points, cal, frames, by)
    dots = front.filter(geo.in_frame(cal, F.col("u"), F.col("v"))).select(by, "u", "v", "d").join(frames, by).join(ranges, "frame")
    b, g, r = geo.depth_colour(F.col("d"), F.col("lo"), F.col("hi"), steady=True)
    return dots.select("frame", "u", "v", b.alias("b"), g.alias("g"), r.alias("red"))


def frames_of(points: DataFrame, scans: int, by: str) -> DataFrame:
    """(by, place, frame): for each scan, itself and the `scans` - 1 that come before it; place counts scans from 0."""
    ids = numbered(points.select(by).distinct(), by, "place")
    last = ids.agg(F.max("place").alias("last"))
    held = ids.crossJoin(F.broadcast(last)).withColumn(
        "m", F.explode(F.sequence("place", F.least(F.col("place") + scans - 1, F.col("last"))))
    ).select(by, "place", "m")
    return held.join(ids.select(F.col(by).alias("frame"), F.col("place").alias("m")), "m").select(by, "place", "frame")


def _in_front(points: DataFrame, cal: Calibration, frames: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """Points in front with pixel u, v and depth d, and for each frame the nearest and farthest of its points, lo and hi."""
    q = geo.transform(cal.rotation, cal.shift, geo.cols("x", "y", "z"))
    front = points.withColumn("_p", geo.pixel(cal, q)).filter("_p IS NOT NULL").withColumns(
        {"u": F.rint("_p.u").try_cast("int"), "v": F.rint("_p.v").try_cast("int"), "d": F.col("_p.z")}
    )
    ranges = front.groupBy(by).agg(F.min("d").alias("lo"), F.max("d").alias("hi")).join(frames, by).groupBy("frame").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    return front, ranges


#: A filled circle of radius 1 as it is drawn: the pixel and its four neighbours.
DOT = ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))


def overlay_pixels(points: DataFrame, cal: Calibration, scans: int = 25, by: str = "scan_id", order: str = "point_id") -> DataFrame:
    """The rolling overlay as it is seen: (frame, u, v, b, g, r) of pixels under a dot of radius 1, cut at the image's edge. Of dots on one
    pixel that of the latest scan is on top, in a scan that of the largest `order`, then the farther one.

    A scan's pixels are settled before they meet the frames that hold it, as neither order nor depth depends on the frame."""
    frames = frames_of(points, scans, by)
    front, ranges = _in_front(points, cal, frames, by)
    dots = front.filter(geo.in_frame(cal, F.col("u"), F.col("v"))).select(
        by, order, "d", F.inline(F.array(*[F.struct((F.col("u") + x).alias("u"), (F.col("v") + y).alias("v")) for x, y in DOT]))
    ).filter(geo.in_frame(cal, F.col("u"), F.col("v")))
    top = dots.groupBy(by, "u", "v").agg(F.max(F.struct(order, "d")).alias("t")).select(by, "u", "v", F.col("t.d").alias("d"))
    seen = top.join(frames, by).groupBy("frame", "u", "v").agg(F.max(F.struct("place", "d"))["d"].alias("d")).join(ranges, "frame")
    b, g, r = geo.depth_colour(F.col("d"), F.col("lo"), F.col("hi"), steady=True)
    return seen.select("frame", "u", "v", b.alias("b"), g.alias("g"), r.alias("r"))


def accumulated(points: DataFrame, scans: int = 30, by: str = "scan_id") -> DataFrame:
    """Each scan made denser by those before it: the points of the last `scans` scans, with `frame`, the scan that they end with. For a
    sensor that stands still."""
    return points.join(frames_of(points, scans, by).select(by, "frame"), by)


def nearest_distance(queries: DataFrame, points: DataFrame, cell: float) -> DataFrame:
    """(id, distance) to the nearest point, however far; null if there are no points. Cells should hold tens of points."""
    found = nearest_k(queries, points, cell, 1, False)
    return found.select("id", F.get("distances", F.lit(0)).alias("distance"))


def distance_quantiles(distances: DataFrame) -> DataFrame:
    d = F.col("distance")
    q = quantiles(distances, {"median": (d, 0.5), "p95": (d, 0.95), "max": (d, 1.0)})
    return distances.limit(0).agg(F.count("*").alias("_n")).join(F.broadcast(q), F.lit(True), "left").drop("_n")


def yaw_spread(poses: DataFrame, quat: str = "quat") -> DataFrame:
    """Largest minus smallest yaw, in degrees."""
    poses = geo.with_unit(poses, quat, "_unit")
    x, y, z, w = geo.of_array(F.col("_unit"), 4)
    yaw = F.degrees(F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z)))
    return poses.agg((F.max(yaw) - F.min(yaw)).alias("yaw_spread"))


def quantile_trim(df: DataFrame, value: str, q: float = 0.05) -> DataFrame:
    """Rows whose value isn't below the exact quantile."""
    limit = quantiles(df, {"_q": (F.col(value), q)})
    return df.crossJoin(F.broadcast(limit)).filter(F.col(value) >= F.col("_q")).drop("_q")
