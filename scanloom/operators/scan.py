"""Reductions of a LiDAR scan to where the board stands: depth band, median core or plane, centroid, pixel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanloom.functions import geo
from scanloom.functions.calibration import Calibration
from scanloom.shared import materialise

#: (nearest, farthest, least points) of the depth bands in use.
BANDS = {"near": (0.4, 1.2, 40), "mid": (0.8, 2.2, 40), "far": (1.0, 2.4, 30)}


def to_camera(points: DataFrame, cal: Calibration) -> DataFrame:
    """x, y, z in the camera's frame, points in front of it only."""
    p = geo.transform(cal.rotation, cal.shift, geo.cols("x", "y", "z"))
    out = points.withColumns({"_x": p[0], "_y": p[1], "_z": p[2]}).drop("x", "y", "z")
    return out.withColumnsRenamed({"_x": "x", "_y": "y", "_z": "z"}).filter("z > 0")


def in_band(points: DataFrame, low: float, high: float, least: int, by: str = "scan_id") -> DataFrame:
    """Points strictly between the depths, of scans with at least `least` of them."""
    band = points.filter((F.col("z") > low) & (F.col("z") < high))
    enough = band.groupBy(by).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).drop("_n")
    return band.join(enough, by)


def core_centroid(
    points: DataFrame, cal: Calibration, band: tuple[float, float, int] = BANDS["far"], core: float = 0.15,
    by: str = "scan_id"
) -> DataFrame:
    """Per scan: median depth of the band, points within `core` of it, their centroid, mean time, and the undistorted column of the
    centroid. Scans with too few points in band or core are left out.

    Two aggregations by scan with map-side combine: both counts and the median, which come back by one join, then sums."""
    low, high, least = band
    front = to_camera(points, cal)
    inside = (F.col("z") > low) & (F.col("z") < high)
    told = front.groupBy(by).agg(F.count_if(inside).alias("_n"), F.median(F.when(inside, F.col("z"))).alias("depth"))
    inner = front.filter(inside).join(told.filter(F.col("_n") >= least).drop("_n"), by).filter(F.abs(F.col("z") - F.col("depth")) < core)
    out = inner.groupBy(by).agg(
        F.max("depth").alias("depth"), F.count("*").alias("n"),
        *[F.avg(c).alias(n) for c, n in (("x", "cx"), ("y", "cy"), ("z", "cz"), ("time", "mean_time"))],
    )
    return out.filter(F.col("n") >= least).withColumn("board_x", geo.pinhole(cal, geo.cols("cx", "cy", "cz"))[0])


def drawn_planes(points: DataFrame, by: str, planes: int = 300, pool: int = 64, seed: int = 0) -> DataFrame:
    """(by, planes: array of (nx, ny, nz, d)): planes through three points each. A scan's points are dealt to `pool` places by
    a seeded hash of their values, and the lowest hash of a place stays: the same ones however the points are partitioned,
    by an aggregation with map-side combine. Triples that span no plane give none."""
    h = F.xxhash64(F.lit(seed), "x", "y", "z")
    lowest = points.groupBy(by, F.pmod(h, F.lit(pool)).alias("place")).agg(F.min(F.struct(h.alias("h"), "x", "y", "z")).alias("p"))
    pools = lowest.groupBy(by).agg(F.sort_array(F.collect_list(F.struct("p.h", "p.x", "p.y", "p.z"))).alias("pool"))
    kind = points.schema[by].dataType.simpleString()

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for held in batch["pool"]:
                xyz = np.array([[p["x"], p["y"], p["z"]] for p in held])
                picks = np.random.default_rng(seed).random((planes, len(xyz))).argsort(axis=1)[:, :3]
                if picks.shape[1] < 3:
                    out.append([])
                    continue
                corner = xyz[picks]
                sides = corner[:, 1:] - corner[:, :1]
                normal = np.cross(sides[:, 0], sides[:, 1])
                size = np.sqrt((normal**2).sum(axis=1))
                flat = size > 1e-9 * np.sqrt((sides**2).sum(axis=(1, 2)))
                unit = normal[flat] / size[flat, None]
                out.append(np.column_stack((unit, -(unit * corner[flat, 0]).sum(axis=1))).tolist())
            yield pd.DataFrame({by: batch[by], "planes": out})

    return pools.mapInPandas(fit, f"{by} {kind}, planes array<array<double>>")


def dominant_plane(points: DataFrame, threshold: float, by: str = "scan_id", chunk_rows: int = 50_000, **draw: int) -> DataFrame:
    """(by, plane, support): of a scan's drawn planes the one with the most points within `threshold`, the first drawn of
    several. Points are counted in chunks, so that no task holds a whole scan, and counts are added up."""
    planes = drawn_planes(points, by, **draw)
    sizes = points.groupBy(by).agg(F.ceil(F.count("*") / chunk_rows).alias("chunks"))
    chunk = F.pmod(F.xxhash64("x", "y", "z", "time"), F.col("chunks"))
    dealt = points.join(sizes, by).withColumn("chunk", chunk).select(by, "chunk", "x", "y", "z")
    each = planes.join(sizes, by).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")
    kind = points.schema[by].dataType.simpleString()

    def count(part: pd.DataFrame, drawn: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(drawn) or not len(drawn["planes"].iloc[0]):
            return pd.DataFrame({by: drawn[by].iloc[:0], "near": pd.Series([], dtype=object)})
        p, xyz = np.stack(drawn["planes"].iloc[0]), part[["x", "y", "z"]].to_numpy()
        near = np.zeros(len(p), np.int64)
        for at in range(0, len(xyz), 4096):
            near += (np.abs(xyz[at : at + 4096] @ p[:, :3].T + p[:, 3]) < threshold).sum(axis=0)
        return pd.DataFrame({by: [drawn[by].iloc[0]], "near": [near]})

    counted = dealt.groupBy(by, "chunk").cogroup(each.groupBy(by, "chunk")).applyInPandas(count, f"{by} {kind}, near array<long>")
    sums = counted.select(by, F.posexplode("near").alias("i", "c")).groupBy(by, "i").agg(F.sum("c").alias("c"))
    best = sums.groupBy(by).agg(F.max(F.struct("c", (-F.col("i")).alias("neg"))).alias("b"))
    return best.join(planes, by).select(by, F.get("planes", -F.col("b.neg")).alias("plane"), F.col("b.c").alias("support"))


def board_plane(
    points: DataFrame,
    cal: Calibration,
    band: tuple[float, float, int] = BANDS["mid"],
    threshold: float = 0.02,
    widest: float = 1.6,
    fallback: float = 0.10,
    by: str = "scan_id",
) -> DataFrame:
    """Per scan: the board as the band's dominant plane; if that is wider than `widest`, the part of it within `fallback` of
    its median depth. Scans whose board has too few points are left out."""
    low, high, least = band
    held = in_band(to_camera(points, cal), low, high, max(least, 20), by).select(by, "x", "y", "z", "time")
    found = dominant_plane(held, threshold, by).filter(F.col("support") >= least)
    p = [F.col("plane")[i] for i in range(4)]
    off = F.abs(F.col("x") * p[0] + F.col("y") * p[1] + F.col("z") * p[2] + p[3])
    board = held.join(found, by).filter(off < threshold).select(by, "x", "y", "z", "time")
    shape = board.groupBy(by).agg(
        F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("wide"), F.median("z").alias("middle")
    )
    close = (F.col("wide") <= widest) | (F.abs(F.col("z") - F.col("middle")) < fallback)
    out = board.join(shape, by).filter(close).groupBy(by).agg(
        F.avg("x").alias("cx"), F.avg("z").alias("cz"), F.median("z").alias("depth"), F.count("*").alias("n"), F.avg("time").alias("mean_time")
    )
    column = (cal.fx * F.col("cx") + cal.cx * F.col("cz")) / F.col("cz")
    return out.filter(F.col("n") >= least).select(by, column.alias("board_x"), "depth", "n", "mean_time")


def _near_cells(rows: DataFrame, ring: int) -> DataFrame:
    """Each row for every cell within `ring` cells of its own (cx, cy, cz)."""
    for a in "xyz":
        around = F.explode(F.sequence(F.col(f"c{a}") - ring, F.col(f"c{a}") + ring))
        rows = rows.withColumn("_c", around).drop(f"c{a}").withColumnRenamed("_c", f"c{a}")
    return rows


def nearest_k(queries: DataFrame, points: DataFrame, cell: float, k: int, other_than_self: bool) -> DataFrame:
    """(id, distances): each query's distances to its k nearest points, ascending; fewer only if there are fewer points.

    Queries meet the points of the cells around theirs, by joins. Those that have not found k within the radius that these
    cells surely cover go on with cells twice as wide, until all are settled or a cell spans everything. A query keeps a bounded
    number of distances for each cell it meets."""
    grid = lambda df, size: df.withColumns({f"c{a}": F.floor(F.col(a) / size) for a in "xyz"})
    span = points.agg(
        *[(F.max(a) - F.min(a)).alias(a) for a in "xyz"], F.max(F.greatest(*[F.abs(F.col(a)) for a in "xyz"])).alias("far")
    ).collect()[0]
    reach = queries.agg(F.max(F.greatest(*[F.abs(F.col(a)) for a in "xyz"])).alias("far")).collect()[0]["far"]
    widest = 2 * max(span["far"] or 0.0, reach or 0.0) + cell
    left, done, size = queries.select("id", "x", "y", "z"), None, cell
    other = points.select(F.col("id").alias("id2") if other_than_self else F.lit(None).cast("long").alias("id2"), "x", "y", "z")
    d = geo.norm(geo.sub(geo.cols("x", "y", "z"), geo.cols("x2", "y2", "z2")))
    while True:
        held = grid(other, size).withColumnsRenamed({a: f"{a}2" for a in "xyz"})
        met = _near_cells(grid(left, size), 1).join(held, ["cx", "cy", "cz"]).filter("id2 IS NULL OR id <> id2").withColumn("d", d)
        # the k smallest of each cell, then of all cells around
        low = F.row_number().over(Window.partitionBy("id", "cx", "cy", "cz").orderBy("d"))
        few = met.withColumn("_n", low).filter(F.col("_n") <= k).groupBy("id").agg(
            F.slice(F.sort_array(F.collect_list("d")), 1, k).alias("distances")
        )
        got = left.join(few, "id", "left").withColumn("distances", F.coalesce("distances", F.array().cast("array<double>")))
        got = materialise(got, "nearest")
        settled = F.coalesce(F.try_element_at("distances", F.lit(k)) <= size, F.lit(False))
        last = size > widest
        new = got.select("id", "distances") if last else got.filter(settled).select("id", "distances")
        done = new if done is None else done.unionByName(new)
        if last:
            return done
        left = got.filter(~settled).select("id", "x", "y", "z")
        if left.isEmpty():
            return done
        size *= 2


def outlier_removal(points: DataFrame, cell: float, nearest: int = 20, deviations: float = 2.0) -> DataFrame:
    """Points with `mean_distance` to their `nearest` neighbours, and `keep` where it is at most the mean plus `deviations`
    population deviations. Points: id, x, y, z. Cells should hold tens of points."""
    found = nearest_k(points, points, cell, nearest, True)
    mean = F.try_divide(F.aggregate("distances", F.lit(0.0), lambda s, x: s + x), F.size("distances"))
    scored = points.join(found.select("id", mean.alias("mean_distance")), "id", "left")
    limit = scored.agg((F.avg("mean_distance") + deviations * F.stddev_pop("mean_distance")).alias("_limit"))
    return scored.crossJoin(F.broadcast(limit)).withColumn("keep", F.coalesce(F.col("mean_distance") <= F.col("_limit"), F.lit(False))).drop("_limit")
