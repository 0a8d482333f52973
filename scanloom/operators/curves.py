"""Curve dumps: rows of camera, LiDAR and inertial curves tagged by kind, in the four layouts of the CSV files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from scanloom.functions import geo

#: Columns after kind and stamp.
LAYOUTS = {1: ("board_x", "extra"), 2: ("board_x", "extra"), 3: ("a", "b", "c"), 4: ("a", "b")}


def _fixed(x: Column | str, decimals: int) -> Column:
    """Text with so many decimals as C and Python write it, which is the double's exact value to the nearest; Java takes its shortest decimal
    form, half up. Null stays null."""

    def text(x: pd.Series) -> pd.Series:
        return x.map(f"%.{decimals}f".__mod__)

    x = F.col(x) if isinstance(x, str) else x
    return F.when(x.isNotNull(), F.pandas_udf(text, StringType())(geo.round_signed(x, 9)))


def tagged_curves(camera: DataFrame, lidar: DataFrame, inertial: DataFrame | None = None, layout: int = 4) -> DataFrame:
    """kind, stamp and the layout's columns, as text with fixed decimals.

    camera: t, x, and spread for layouts 1 and 2; lidar: t (header), x, depth, mean_time; inertial: t, wx, wy, wz (layouts 3 and
    4). Layout 4 stamps LiDAR rows with the header plus the board's mean point time and keeps the header beside it."""
    zero, none = F.lit("0"), F.lit("0")
    if layout in (1, 2):
        cam, lid = ("x", _fixed("spread", 3)), (_fixed("t", 6), _fixed("depth", 3))
    elif layout == 3:
        cam, lid = ("x", zero), (_fixed("t", 6), _fixed("depth", 3))
    else:
        cam, lid = ("x", zero), (_fixed(F.col("t") + F.col("mean_time"), 6), _fixed("t", 6))
    names = LAYOUTS[layout]

    def row(df: DataFrame, kind: str, stamp: Column, *values: Column) -> DataFrame:
        filled = (*values, none)[: len(names)]
        return df.select(F.lit(kind).alias("kind"), stamp.alias("stamp"), *[v.alias(n) for v, n in zip(filled, names)])

    out = row(camera, "CAM", _fixed("t", 6), _fixed(cam[0], 3), cam[1])
    out = out.unionByName(row(lidar, "LID", lid[0], _fixed("x", 3), lid[1]))
    if layout in (3, 4) and inertial is not None:
        rates = [_fixed(c, 5) for c in ("wx", "wy", "wz")]
        out = out.unionByName(row(inertial, "IMU", _fixed("t", 6), *rates[: len(names)]))
    return out


def corner_spread(corners: DataFrame, by: str = "image_id") -> DataFrame:
    """(by, t, x, spread): mean column of the board's corners, and their largest column less the smallest. corners: by, t, u."""
    return corners.groupBy(by).agg(F.min("t").alias("t"), F.avg("u").alias("x"), (F.max("u") - F.min("u")).alias("spread"))
