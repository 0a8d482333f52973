"""Time offset between two curves of the same motion: the shift with the least mean squared difference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.operators.ordered import beside


def segments(camera: DataFrame, t: str = "t", x: str = "x") -> DataFrame:
    """(t0, x0, t1, x1): neighbouring samples of the curve, by time; the last one ends where it begins."""
    near = beside(camera.select(F.col(t).alias("t0"), F.col(x).alias("x0")), "t0", {"t1": "t0", "x1": "x0"}, after=True)
    return near.select("t0", "x0", F.coalesce("t1", "t0").alias("t1"), F.coalesce("x1", "x0").alias("x1"))


def errors_by_shift(camera: DataFrame, lidar: DataFrame, low: float = -0.3, step: float = 0.001, count: int = 601, least: int = 10) -> DataFrame:
    """(tau_idx, tau, n, mse) of shifts with at least `least` LiDAR samples inside the camera's span. Curves: t, x.

    LiDAR samples times shifts is the work; the camera's segments, one row per camera sample of one recording, are joined on buckets of time
    one segment wide, not by comparing all with all."""
    segs = segments(camera)
    wide = segs.agg(F.greatest(F.max(F.col("t1") - F.col("t0")), F.lit(1e-6)).alias("w"), F.min("t0").alias("lo"), F.max("t1").alias("hi"))
    taus = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    moved = lidar.select(
        F.col("t").alias("tl"), F.col("x").alias("xl"), taus.alias("tau_idx")
    ).withColumn("tau", F.lit(low) + F.col("tau_idx") * F.lit(step))
    moved = moved.withColumn("t", F.col("tl") - F.col("tau")).crossJoin(F.broadcast(wide)).filter("t >= lo AND t <= hi").withColumn(
        "b", F.floor((F.col("t") - F.col("lo")) / F.col("w"))
    )
    spans = segs.crossJoin(F.broadcast(wide)).withColumn(
        "b",
        F.explode(F.sequence(F.floor((F.col("t0") - F.col("lo")) / F.col("w")), F.floor((F.col("t1") - F.col("lo")) / F.col("w"))))
    ).select("b", "t0", "x0", "t1", "x1")
    # Half-open segments, so that a sample on a joint meets one; the last segment is a point.
    hits = moved.join(spans, "b").filter("t >= t0 AND (t < t1 OR (t1 = t0 AND t = t0))")
    x = F.col("x0") + F.coalesce(F.try_divide(F.col("t") - F.col("t0"), F.col("t1") - F.col("t0")), F.lit(0.0)) * (F.col("x1") - F.col("x0"))
    return hits.groupBy("tau_idx", "tau").agg(
        F.count("*").alias("n"), F.avg((F.col("xl") - x) * (F.col("xl") - x)).alias("mse")
    ).filter(F.col("n") >= least)


def best_shift(camera: DataFrame, lidar: DataFrame, **grid) -> DataFrame:
    """One row: tau_idx, tau, mse, n; the smallest shift of those with the least error. Without any, tau is 0 and mse infinite."""
    best = errors_by_shift(camera, lidar, **grid).agg(F.min(F.struct(F.round("mse", 9).alias("mse"), "tau_idx", "tau", "n")).alias("b"))
    return best.select(
        F.col("b.tau_idx"), F.coalesce("b.tau", F.lit(0.0)).alias("tau"),
        F.coalesce("b.mse", F.lit(float("inf"))).alias("mse"), F.coalesce("b.n", F.lit(0)).alias("n")
    )


def shift_with_halves(camera: DataFrame, lidar: DataFrame, least_half: int = 10, **grid) -> DataFrame:
    """The whole recording's shift and those of its halves, cut at the middle of the camera's span; a half needs more than
    `least_half` samples of both. Stamps are rebased to the first sample of either."""
    t0 = camera.agg(F.min("t").alias("a")).crossJoin(F.broadcast(lidar.agg(F.min("t").alias("b")))).select(F.least("a", "b").alias("t0"))
    mid = camera.agg((F.min("t") + (F.max("t") - F.min("t")) / 2).alias("mid"))
    based = lambda df: df.crossJoin(F.broadcast(t0)).crossJoin(F.broadcast(mid)).select((F.col("t") - F.col("t0")).alias("t"), "x", (F.col("t") < F.col("mid")).alias("first"))
    c, lid = based(camera), based(lidar)
    out = best_shift(c, lid, **grid).withColumn("part", F.lit("all"))
    for name, cond in (("first", F.col("first")), ("second", ~F.col("first"))):
        hc, hl = c.filter(cond), lid.filter(cond)
        enough = hc.agg(F.count("*").alias("nc")).crossJoin(F.broadcast(hl.agg(F.count("*").alias("nl")))).filter(
            (F.col("nc") > least_half) & (F.col("nl") > least_half)
        ).select(F.lit(name).alias("part"))
        out = out.unionByName(best_shift(hc, hl, **grid).crossJoin(F.broadcast(enough)))
    return out
