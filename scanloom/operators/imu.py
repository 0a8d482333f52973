"""Inertial sensor health, as one summary row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.functions import geo
from scanloom.operators.ordered import laid_out


def magnitudes(df: DataFrame, vector: str, prefix: str) -> DataFrame:
    """Norm statistics and axis means of a three-vector column."""
    v = geo.of_array(F.col(vector), 3)
    n = geo.norm(v)
    return df.agg(
        F.avg(n).alias(f"{prefix}_mean"), F.stddev_pop(n).alias(f"{prefix}_std"), F.min(n).alias(f"{prefix}_min"), F.max(n).alias(f"{prefix}_max"),
        *[F.avg(c).alias(f"{prefix}_{axis}") for c, axis in zip(v, "xyz")],
    )


def quaternion_norms(df: DataFrame, quat: str = "quat") -> DataFrame:
    q = geo.of_array(F.col(quat), 4)
    n = geo.norm(q)
    still = (F.abs(q[0]) < 1e-6) & (F.abs(q[1]) < 1e-6) & (F.abs(q[2]) < 1e-6)
    return df.agg(
        F.avg(n).alias("quat_mean"), F.stddev_pop(n).alias("quat_std"), F.min(n).alias("quat_min"),
        F.max(n).alias("quat_max"), F.count_if(still).alias("degenerate")
    )


def orientation_changes(df: DataFrame, order: str, quat: str = "quat", every: int = 20, live_above: float = 1e-3) -> DataFrame:
    """Largest angle between a sample and the one before it, looked at for every 20th sample; live above the limit."""
    near = laid_out(df.select(order, quat), order, number="i", before={"_before": quat})
    q, p = geo.of_array(F.col(quat), 4), geo.of_array(F.col("_before"), 4)
    steps = near.select("i", F.abs(geo.dot(q, p)).alias("d")).filter((F.col("i") % every == 1 % every) & F.col("d").isNotNull())
    angle = 2 * F.acos(F.least(F.greatest("d", F.lit(0.0)), F.lit(1.0)))
    return steps.agg(F.max(angle).alias("largest_angle")).withColumn("live", F.coalesce(F.col("largest_angle") > live_above, F.lit(False)))


def gravity_gate(summary: DataFrame, column: str = "accel_mean", low: float = 5.0, high: float = 15.0) -> DataFrame:
    return summary.withColumn("plausible", (F.col(column) > low) & (F.col(column) < high))


def health(df: DataFrame, order: str, us: str, gap_ms: float = 10.0) -> DataFrame:
    """Rate, dropouts, magnitudes, quaternion norms and liveness in one row. Each part is an aggregate of one row, so joining
    them is free."""
    from scanloom.operators.interval import rate_and_dropout

    rate = rate_and_dropout(df.withColumn("_all", F.lit(0)), ["_all"], order, us, gap_ms).drop("_all")
    out = gravity_gate(magnitudes(df, "accel", "accel"))
    for part in (magnitudes(df, "gyro", "gyro"), quaternion_norms(df), orientation_changes(df, order), rate):
        out = out.crossJoin(F.broadcast(part))
    return out
