"""Keyframes of a SLAM database derived from the tables: one for each order, a point for each of its lines."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from scanloom.sources.proxy import table


@F.pandas_udf(BinaryType())
def deflated_scan(points: pd.Series) -> pd.Series:
    """Scans as a database holds them, from arrays of (x, y, z, colour)."""

    def one(rows) -> bytes:
        out = np.zeros((len(rows), 4), "<f4")
        for i, p in enumerate(rows):
            out[i, :3] = p["x"], p["y"], p["z"]
        out.view("<u4")[:, 3] = [p["colour"] for p in rows]
        return zlib.compress(out.tobytes())

    return points.map(one)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, node_id, pose, scan: quarter turns about the vertical, moved by the order's number."""
    line = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("node_id"), ((F.col("l_quantity") - 25.5) / 50).alias("x"),
        ((F.col("l_discount") - 0.05) * 10).alias("y"), (F.col("l_extendedprice") / 40000).alias("z"),
        (F.lit(0xFF000000) + F.col("l_linenumber") * 30 * 65536 + F.col("l_quantity").cast("long") * 256 + F.col("l_suppkey") % 256).alias("colour"),
    )
    kept = line.groupBy("node_id").agg(F.collect_list(F.struct("x", "y", "z", "colour")).alias("points"))
    at = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("node_id") % 4 + 1).cast("int"))
    cos, sin = at((1, 0, -1, 0)), at((0, 1, 0, -1))
    zero, one = F.lit(0.0), F.lit(1.0)
    pose = F.array(
        cos, -sin, zero, (F.col("node_id") % 100).cast("double"), sin, cos, zero, (F.col("node_id") % 7).cast("double"), zero, zero, one, one,
    )
    return kept.select(F.lit("tables").alias("file"), "node_id", pose.alias("pose"), deflated_scan("points").alias("scan"))


SQL = """p AS (SELECT l_orderkey AS node_id, ((l_quantity - 25.5) / 50)::FLOAT::DOUBLE AS x, ((l_discount - 0.05) * 10)::FLOAT::DOUBLE AS y, (l_extendedprice / 40000)::FLOAT::DOUBLE AS z,
  l_linenumber * 30 AS r, trunc(l_quantity)::BIGINT AS g, l_suppkey % 256 AS b, [1, 0, -1, 0][(l_orderkey % 4 + 1)::INT] AS c, [0, 1, 0, -1][(l_orderkey % 4 + 1)::INT] AS s FROM lineitem),
world AS (SELECT node_id, c * x - s * y + node_id % 100 AS x, s * x + c * y + node_id % 7 AS y, z + 1 AS z, r, g, b FROM p)"""
