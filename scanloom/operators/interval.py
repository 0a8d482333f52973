"""Health of timestamped streams: gaps between messages, rates, liveness. A stream's order is
explicit; a long stream is many tasks (ordered.py)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanloom.operators.ordered import beside, first_rows, numbered, quantiles


def with_intervals(df: DataFrame, by: Sequence[str], order: str, us: str, out: str = "dt_ms") -> DataFrame:
    """First difference of `us` in milliseconds, in order of `order`; null for a stream's first row."""
    near = beside(df, order, {"_before": us}, by)
    return near.withColumn(out, (F.col(us) - F.col("_before")) / 1000.0).drop("_before")


def interval_stats(df: DataFrame, by: Sequence[str], order: str, us: str, limits_ms: dict[str, float]) -> DataFrame:
    """Per stream: intervals, mean, population deviation, smallest, largest, and how many exceed each limit."""
    d = F.col("dt_ms")
    return with_intervals(df, by, order, us).filter(d.isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(d).alias("mean_ms"), F.stddev_pop(d).alias("std_ms"), F.min(d).alias("min_ms"), F.max(d).alias("max_ms"),
        *[F.count_if(d > limit).alias(name) for name, limit in limits_ms.items()],
    )


def normal_and_gaps(df: DataFrame, by: Sequence[str], order: str, us: str, gap_ms: float, period_ms: float) -> DataFrame:
    """Intervals below `gap_ms` by count, mean and deviation; the others as a sorted list, and in periods: null for a stream without any."""
    d = F.col("dt_ms")
    normal = F.when(d < gap_ms, d)
    out = with_intervals(df, by, order, us).filter(d.isNotNull()).groupBy(*by).agg(
        F.count(normal).alias("n_normal"), F.avg(normal).alias("mean_normal_ms"), F.stddev_pop(normal).alias("std_normal_ms"),
        F.count_if(d >= gap_ms).alias("n_gaps"), F.sort_array(F.collect_list(F.when(d >= gap_ms, d))).alias("gaps_ms"),
    )
    out = out.withColumn("gaps_ms", F.when(F.col("n_gaps") > 0, F.col("gaps_ms")))
    return out.withColumn("gap_periods", F.transform("gaps_ms", lambda x: F.bround(x / period_ms, 1)))


def rate_and_dropout(df: DataFrame, by: Sequence[str], order: str, us: str, gap_ms: float) -> DataFrame:
    """Median interval and its rate, extremes, and the share of intervals above `gap_ms`."""
    d = F.col("dt_ms")
    steps = with_intervals(df, by, order, us).filter(d.isNotNull())
    out = steps.groupBy(*by).agg(
        F.count("*").alias("n"), F.min(d).alias("min_ms"), F.max(d).alias("max_ms"), F.count_if(d > gap_ms).alias("n_gaps")
    )
    out = out.join(quantiles(steps, {"median_ms": (d, 0.5)}, by), list(by))
    return out.withColumn("rate_hz", F.try_divide(F.lit(1000.0), "median_ms")).withColumn("gap_percent", 100.0 * F.col("n_gaps") / F.col("n"))


def first_intervals(df: DataFrame, by: Sequence[str], order: str, us: str, n: int = 15) -> DataFrame:
    """The first n intervals of each stream. Looks at the first n + 1 rows of each only."""
    first = first_rows(df, order, n + 1, by)
    before = F.lag(us).over(Window.partitionBy(*by).orderBy("place"))
    return first.withColumn("dt_ms", (F.col(us) - before) / 1000.0).filter("place >= 1").select(*by, "place", "dt_ms")


def gap_rows(df: DataFrame, by: Sequence[str], order: str, us: str, gap_ms: float, period_ms: float) -> DataFrame:
    """A row for each interval of `gap_ms` and more: its place among its stream's gaps by length (from 0), where it ends (`order`),
    its length and that in periods, to one decimal. A stream may have any number of gaps."""
    d = F.col("dt_ms")
    gaps = with_intervals(df, by, order, us).filter(d >= gap_ms).select(*by, order, "dt_ms")
    return numbered(gaps, "dt_ms", "place", by).withColumn("gap_periods", F.bround(d / period_ms, 1))


def gates(df: DataFrame, stream: str, us: str, wanted: Sequence[str], window_us: int) -> DataFrame:
    """For each wanted stream: messages in the last `window_us` of the recording, distinct stamps as a share of the messages, and whether
    it is live. A stream that never spoke is a row too."""
    spark = df.sparkSession
    last = df.agg(F.max(us).alias("_last"))
    found = df.crossJoin(F.broadcast(last)).groupBy(stream).agg(
        F.count_if(F.col(us) > F.col("_last") - window_us).alias("n"),
        (F.count_distinct(us) / F.count("*")).alias("distinct_share")
    )
    names = spark.createDataFrame([(x,) for x in wanted], f"{stream} string")
    return names.join(found, stream, "left").select(
        stream, F.coalesce("n", F.lit(0)).alias("n"), "distinct_share", (F.coalesce("n", F.lit(0)) > 0).alias("live")
    )
