"""Pairing messages of two streams by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanloom.operators.ordered import numbered


def pair_nearest(left: DataFrame, right: DataFrame, slop_us: int, left_id: str = "seq", right_id: str = "seq", us: str = "us") -> DataFrame:
    """(left_id, right_id, left_us, right_us, dt_us): pairs at most `slop_us` apart that are each other's nearest; ties go to
    the earlier message, then the smaller id.

    Stamps are cut into buckets as wide as the slop, so a message meets only its own and the two neighbouring buckets: an
    equi-join on the bucket, not a join of all with all."""
    a = left.select(F.col(left_id).alias("l_id"), F.col(us).alias("l_us")).withColumn(
        "b", F.explode(F.array(*[F.floor(F.col("l_us") / slop_us) + k for k in (-1, 0, 1)]))
    )
    b = right.select(F.col(right_id).alias("r_id"), F.col(us).alias("r_us")).withColumn("b", F.floor(F.col("r_us") / slop_us))
    near = a.join(b, "b").withColumn("dt_us", F.abs(F.col("l_us") - F.col("r_us"))).filter(F.col("dt_us") <= slop_us).drop("b")
    by_left = Window.partitionBy("l_id").orderBy("dt_us", "r_us", "r_id")
    by_right = Window.partitionBy("r_id").orderBy("dt_us", "l_us", "l_id")
    return near.withColumn("x", F.row_number().over(by_left)).withColumn("y", F.row_number().over(by_right)).filter("x = 1 AND y = 1").drop("x", "y")


def pair_exact(left: DataFrame, right: DataFrame, us: str = "us", id_col: str = "seq") -> DataFrame:
    """Pairs with the same stamp."""
    return left.select(F.col(id_col).alias("l_id"), us).join(right.select(F.col(id_col).alias("r_id"), us), us)


def zip_by_order(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Row i of one with row i of the other, as far as the shorter goes."""
    return numbered(left, left_order).join(numbered(right, right_order), "idx")


def count_check(left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts of both and whether they differ."""
    out = left.agg(F.count("*").alias("n_left")).crossJoin(F.broadcast(right.agg(F.count("*").alias("n_right"))))
    return out.withColumn("differ", F.col("n_left") != F.col("n_right"))


def decorate(df: DataFrame, constants: dict[str, float]) -> DataFrame:
    """A static calibration beside every row."""
    return df.select("*", *[F.lit(float(v)).alias(k) for k, v in constants.items()])
