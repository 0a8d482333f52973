"""Bracketing as-of join: for each query stamp the samples before and after it, and the pose between them.

The join is two ordered windows over a union. To keep a single long stream from becoming one task, stamps are cut into
buckets of time, windows run in a bucket, and each bucket gets the last sample before and the first after it from a table
of one row per bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanloom.functions import geo


def dedupe_stamps(df: DataFrame, stamp: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per stamp: that with the smallest `order`."""
    w = Window.partitionBy(*by, stamp).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def bracket(samples: DataFrame, queries: DataFrame, stamp: str = "ns", by: Sequence[str] = (), bucket: int = 60_000_000_000) -> DataFrame:
    """Queries with `before` and `after`: structs of the sample at or before, and at or after, the query's stamp; null where there is none.
    Stamps of samples must be unique within `by`. Queries without a stamp stay, with nothing around them."""
    by = list(by)
    names = [stamp, *[c for c in samples.columns if c not in (stamp, *by)]]
    kept = [c for c in queries.columns if c not in by]
    kind = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in (queries.schema[c] for c in kept))
    of_sample = F.struct(*names)
    left = samples.select(
        *by, F.col(stamp).alias("_t"), F.lit(0).alias("_kind"), of_sample.alias("_s"),
        F.lit(None).cast(f"struct<{kind}>").alias("_q")
    )
    right = queries.select(
        *by, F.col(stamp).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(left.schema["_s"].dataType).alias("_s"),
        F.struct(*kept).alias("_q")
    )
    both = left.filter("_t IS NOT NULL").unionByName(right).withColumn("_b", F.floor(F.col("_t") / bucket))
    rows = Window.partitionBy(*by, "_b")
    past = rows.orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    coming = rows.orderBy(F.desc("_t"), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("before", F.last("_s", ignorenulls=True).over(past)).withColumn(
        "after", F.last("_s", ignorenulls=True).over(coming)
    ).filter("_kind = 1")
    # samples alone are aggregated by row; queries tell their bucket only
    told = both.filter("_kind = 0").groupBy(*by, "_b").agg(F.min("_s").alias("_low"), F.max("_s").alias("_high"))
    asked = both.filter("_kind = 1").select(*by, "_b").distinct().select(*by, "_b", *[F.lit(None).cast(told.schema[c].dataType).alias(c) for c in ("_low", "_high")])
    ends = told.unionByName(asked).groupBy(*by, "_b").agg(F.max("_low").alias("_low"), F.max("_high").alias("_high"))
    # both windows end before their row: one that begins after it would look at all later buckets again for each of them
    across, back = Window.partitionBy(*by).orderBy("_b"), Window.partitionBy(*by).orderBy(F.desc("_b"))
    ends = ends.select(
        *by, "_b",
        F.last("_high", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"),
        F.last("_low", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("_later"),
    )
    # a query without a stamp has nothing around it; one without `by` belongs with samples without it
    near = near.withColumns({"before": F.when(F.col("_t").isNotNull(), F.col("before")), "after": F.when(F.col("_t").isNotNull(), F.col("after"))})
    ends = ends.select(*[F.col(c).alias(f"_{c}_") for c in by], F.col("_b").alias("_at"), "_earlier", "_later")
    same = F.col("_b") == F.col("_at")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}_"))
    joined = near.join(ends, same, "left")
    return joined.select(*by, "_q.*", F.coalesce("before", "_earlier").alias("before"), F.coalesce("after", "_later").alias("after"))


def match_poses(samples: DataFrame, queries: DataFrame, max_gap_s: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """samples: ns, seq, quat, pos. Every query with ok, reason, u, gap_s, position and unit quaternion at its stamp: the sample itself on an
    exact hit whatever the gap, else position by linear and rotation by spherical interpolation between the two
    samples around it, unless these are more than `max_gap_s` apart."""
    near = bracket(dedupe_stamps(samples, "ns", "seq", by), queries, "ns", by)
    b, a, t = F.col("before"), F.col("after"), F.col("ns")
    gap = (a["ns"] - b["ns"]) / 1e9
    none, outside = b.isNull() & a.isNull(), b.isNull() | a.isNull()
    exact = b["ns"] == t
    reason = F.when(none, "empty").when(outside, "out of span").when(exact, "exact")
    if max_gap_s is not None:
        reason = reason.when(gap > max_gap_s, "gap")
    near = near.withColumn("reason", reason.otherwise("interp")).withColumn("gap_s", F.when(F.col("reason").isin("gap", "interp"), gap))
    near = near.withColumn("u", F.when(F.col("reason") == "interp", F.try_divide((t - b["ns"]).cast("double"), (a["ns"] - b["ns"]).cast("double"))))
    ok = F.col("reason").isin("exact", "interp")
    near = near.withColumn("ok", ok).withColumn("_u", F.coalesce("u", F.lit(0.0)))
    other = F.when(F.col("reason") == "interp", a).otherwise(b)
    near = near.withColumn("_raw0", F.when(F.col("ok"), b["quat"])).withColumn("_raw1", F.when(F.col("ok"), other["quat"]))
    near = geo.with_slerp(geo.with_unit(geo.with_unit(near, "_raw0", "_q0"), "_raw1", "_q1"), "_q0", "_q1", "_u", "_q")
    pos = geo.lerp(geo.of_array(b["pos"], 3), geo.of_array(other["pos"], 3), F.col("_u"))
    return near.select(
        *by, *[c for c in queries.columns if c not in by], "reason", "gap_s", "u", "ok",
        *[F.when(F.col("ok"), c).alias(n) for n, c in zip(("px", "py", "pz"), pos)],
        *[F.col("_q")[i].alias(n) for i, n in enumerate(("qx", "qy", "qz", "qw"))],
    )


def match_summary(matched: DataFrame) -> DataFrame:
    return matched.agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok"), (100.0 * F.count_if("ok") / F.count("*")).alias("ok_percent"))


def span_summary(samples: DataFrame, stamp: str = "ns") -> DataFrame:
    """Count, span in seconds, and count by span."""
    out = samples.agg(F.count("*").alias("n"), ((F.max(stamp) - F.min(stamp)) / 1e9).alias("span_s"))
    return out.withColumn("rate_hz", F.col("n") / F.greatest(F.lit(1e-9), "span_s"))


def rebase(df: DataFrame, origin: DataFrame, stamp: str = "ns", out: str = "t") -> DataFrame:
    """Seconds since the smallest stamp of `origin`."""
    return df.crossJoin(F.broadcast(origin.agg(F.min(stamp).alias("_t0")))).withColumn(out, (F.col(stamp) - F.col("_t0")) / 1e9).drop("_t0")
