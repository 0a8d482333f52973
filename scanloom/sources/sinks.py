"""Sinks: curve CSV with fixed decimals, posed images as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_curves(curves: DataFrame, path: str, decimals: dict[str, int], order: str) -> None:
    """CSV with a header, numbers as text with the given decimals, in order of `order` within and across files."""
    text = [F.format_string(f"%.{decimals[c]}f", c).alias(c) if c in decimals else F.col(c) for c in curves.columns if c != order]
    curves.repartitionByRange(order).sortWithinPartitions(order).select(*text).write.csv(path, header=True)


def write_posed_images(matched: DataFrame, path: str, convention: str = "lidar_in_map") -> None:
    """Matched poses with the convention they are in."""
    matched.withColumn("convention", F.lit(convention)).write.parquet(path)


def read_posed_images(spark, path: str, only_ok: bool = True) -> DataFrame:
    out = spark.read.parquet(path)
    return out.filter("ok") if only_ok else out
