"""Time offset between two curves of the same motion by the correlation of their velocities, with gates that refuse a doubtful peak.

Unlike the least error of positions (tau.py), velocities need no common origin or scale. Curves are resampled to one grid, which
is an explosion of their segments; a correlation for each lag is one aggregation of an equi-join on the grid's number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.operators.ordered import beside
from scanloom.operators.tau import segments

STEP, REACH = 0.01, 50
#: A peak is as wide as the lags around it whose correlation is at least this share of its own.
LEVEL = 0.95
#: Seconds: the widest peak, and the largest difference of the halves, that are accepted.
WIDEST, APART = 0.1, 0.03


def velocities(curve: DataFrame, step: float = STEP) -> DataFrame:
    """(k, v): velocity from k to k + 1 times `step`, of the curve (t, x) between its samples."""
    segs = segments(curve).filter("t1 > t0")
    low, high = F.ceil(F.col("t0") / step - 1e-9), F.ceil(F.col("t1") / step - 1e-9) - 1
    grid = segs.withColumn("k", F.explode(F.when(low <= high, F.sequence(low, high))))
    at = grid.select("k", (F.col("x0") + (F.col("k") * step - F.col("t0")) / (F.col("t1") - F.col("t0")) * (F.col("x1") - F.col("x0"))).alias("x"))
    near = beside(at, "k", {"k1": "k", "x1": "x"}, after=True)
    return near.filter("k1 = k + 1").select("k", ((F.col("x1") - F.col("x")) / step).alias("v"))


def correlations(camera: DataFrame, lidar: DataFrame, step: float = STEP, reach: int = REACH) -> DataFrame:
    """(lag, n, corr): correlation of LiDAR velocities with those of the camera `lag` steps before, for lags up to `reach` either way."""
    a = velocities(lidar, step).withColumn("lag", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
    a = a.select("lag", F.col("v").alias("va"), (F.col("k") - F.col("lag")).alias("k"))
    met = a.join(velocities(camera, step), "k")
    return met.groupBy("lag").agg(F.count("*").alias("n"), F.corr("va", "v").alias("corr"))


def peak(lags: DataFrame, step: float = STEP, level: float = LEVEL, least: int = 10) -> DataFrame:
    """One row: lag of the largest correlation (ties to the smallest lag), corr, n, and width in seconds. Lags of fewer than `least`
    velocities don't count; without any, all are null."""
    told = lags.filter((F.col("n") >= least) & F.col("corr").isNotNull() & ~F.isnan("corr"))
    best = told.agg(F.max(F.struct(F.round("corr", 9).alias("corr"), (-F.col("lag")).alias("neg"), "n")).alias("b"))
    best = best.select((-F.col("b.neg")).alias("best"), F.col("b.corr").alias("top"), F.col("b.n").alias("most"))
    both = lags.crossJoin(F.broadcast(best))
    # the nearest lags on either side that are below the level end the peak
    below = (F.col("n") < least) | F.col("corr").isNull() | (F.col("corr") < level * F.col("top"))
    ends = both.agg(
        F.first("best").alias("lag"), F.first("top").alias("corr"), F.first("most").alias("n"),
        F.max(F.when(below & (F.col("lag") < F.col("best")), F.col("lag"))).alias("left"),
        F.min(F.when(below & (F.col("lag") > F.col("best")), F.col("lag"))).alias("right")
    )
    # a peak that runs to the end of the lags has no width that could be told
    return ends.select("lag", "corr", "n", ((F.col("right") - F.col("left") - 1) * step).alias("width"))


def velocity_offset(camera: DataFrame, lidar: DataFrame, step: float = STEP, reach: int = REACH, level: float = LEVEL) -> DataFrame:
    """One row: tau (positive: the LiDAR lags), corr, width, tau_first and tau_second of the halves of the camera's span, and accepted:
    whether the peak is positive, narrow, and where both halves have theirs."""
    mid = camera.agg(((F.min("t") + F.max("t")) / 2).alias("mid"))

    def half(df: DataFrame, first: bool) -> DataFrame:
        return df.crossJoin(F.broadcast(mid)).filter(F.col("t") < F.col("mid") if first else F.col("t") >= F.col("mid")).drop("mid")

    out = peak(correlations(camera, lidar, step, reach), step, level).select((F.col("lag") * step).alias("tau"), "corr", "width")
    for name, first in (("tau_first", True), ("tau_second", False)):
        lag = peak(correlations(half(camera, first), half(lidar, first), step, reach), step, level).select((F.col("lag") * step).alias(name))
        out = out.crossJoin(F.broadcast(lag))
    ok = (F.col("corr") > 0) & (F.col("width") < WIDEST) & (F.abs(F.col("tau_first") - F.col("tau_second")) < APART)
    return out.withColumn("accepted", F.coalesce(ok, F.lit(False)))
