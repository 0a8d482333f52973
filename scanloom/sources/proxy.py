"""Sensor-shaped views of the test tables, and the same views as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stream, seq, us, value"""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stream"), F.col("event_id").alias("seq"),
        F.expr("unix_micros(CAST(ts AS timestamp))").alias("us"), "value"
    )


def odom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, ns, quat (x, y, z, w, not yet unit), pos"""
    return table(spark, sf_dir, "embeddings").filter("vec_id % 100 NOT BETWEEN 40 AND 59").select(
        F.col("vec_id").alias("seq"), (F.col("vec_id") * 4_000_000).alias("ns"),
        F.slice("embedding", 1, 4).cast("array<double>").alias("quat"), F.slice("embedding", 5, 3).cast("array<double>").alias("pos"),
    )


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """idx, ns"""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("idx"),
        F.expr("CASE WHEN event_id % 10 = 0 THEN event_id * 4000000 ELSE event_id * 3700001 END").alias("ns")
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scan_id, x, y, z, time"""
    return points_of(table(spark, sf_dir, "lineitem"))


def points_of(lineitem: DataFrame, *more: Column) -> DataFrame:
    """The same, with more columns."""
    return lineitem.select(
        (F.col("l_orderkey") % 40).alias("scan_id"),
        ((F.col("l_quantity") - 25.5) / 50).alias("x"), ((F.col("l_discount") - 0.05) * 10).alias("y"),
        (F.col("l_extendedprice") / 40000).alias("z"), F.col("l_tax").alias("time"), *more,
    ).withColumns({c: F.col(c).cast("double") for c in ("x", "y", "z", "time")})


def imu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, us, quat, gyro, accel: the accelerometer scaled to about gravity"""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq"), (F.col("vec_id") * 4_000 + (F.col("vec_id") % 7) * 300).alias("us"),
        F.slice("embedding", 1, 4).cast("array<double>").alias("quat"), F.slice("embedding", 5, 3).cast("array<double>").alias("gyro"),
        F.transform(F.slice("embedding", 8, 3).cast("array<double>"), lambda x: x * 40).alias("accel"),
    )


def camera_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t, x: a camera's board positions, one for every tenth of a second"""
    return table(spark, sf_dir, "events").select((F.col("event_id") * 0.1).cast("double").alias("t"), (F.col("value") * 4).cast("double").alias("x"))


SQL = {
    "ticks": "ticks AS (SELECT event_type AS stream, event_id AS seq, epoch_us(ts) AS us, value FROM events)",
    "odom": "odom AS (SELECT vec_id AS seq, vec_id * 4000000 AS ns, embedding[1:4]::DOUBLE[] AS quat, embedding[5:7]::DOUBLE[] AS pos FROM embeddings WHERE vec_id % 100 NOT BETWEEN 40 AND 59)",
    "shots": "shots AS (SELECT event_id AS idx, CASE WHEN event_id % 10 = 0 THEN event_id * 4000000 ELSE event_id * 3700001 END AS ns FROM events)",
    "points": """points AS (SELECT l_orderkey % 40 AS scan_id, ((l_quantity - 25.5) / 50)::DOUBLE AS x, ((l_discount - 0.05) * 10)::DOUBLE AS y,
       (l_extendedprice / 40000)::DOUBLE AS z, l_tax::DOUBLE AS "time" FROM lineitem)""",
    "imu": """imu AS (SELECT vec_id AS seq, vec_id * 4000 + (vec_id % 7) * 300 AS us, embedding[1:4]::DOUBLE[] AS quat, embedding[5:7]::DOUBLE[] AS gyro,
       [x * 40 FOR x IN embedding[8:10]::DOUBLE[]] AS accel FROM embeddings)""",
    "camera": "camera AS (SELECT (event_id * 0.1)::DOUBLE AS t, (value * 4)::DOUBLE AS x FROM events)",
}


def prelude(*names: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names)
