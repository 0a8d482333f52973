"""Point cloud and image files as tables. Files come through Spark's own binaryFile source, so they may lie in any storage
that Spark reads; each file is decoded in one task in slices of rows."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: PCD type letter and size to numpy type.
_KINDS = {("F", 4): "<f4", ("F", 8): "<f8", ("U", 1): "u1", ("U", 2): "<u2", ("U", 4): "<u4", ("I", 1): "i1", ("I", 2): "<i2", ("I", 4): "<i4"}


def parse_pcd(content: bytes) -> np.ndarray:
    """(points, 3) of x, y, z, finite ones only, from an ascii or packed binary file."""
    head: dict[str, list[str]] = {}
    stream = io.BytesIO(content)
    while "DATA" not in head:
        line = stream.readline()
        if not line:
            raise ValueError("PCD header without DATA")
        name, *values = line.decode("ascii", "replace").split()
        head[name] = values
    fields = head["FIELDS"]
    if head["DATA"][0] == "ascii":
        table = np.loadtxt(stream, ndmin=2)
        xyz = np.stack([table[:, fields.index(a)] for a in "xyz"], axis=1) if table.size else np.zeros((0, 3))
    elif head["DATA"][0] != "binary":
        raise ValueError(f"PCD data {head['DATA'][0]}")
    else:
        row = np.dtype([(f, _KINDS[k, int(s)]) for f, k, s in zip(fields, head["TYPE"], head["SIZE"])])
        table = np.frombuffer(stream.read(), row, count=int(head["POINTS"][0]))
        xyz = np.stack([table[a].astype(float) for a in "xyz"], axis=1)
    return xyz[np.isfinite(xyz).all(axis=1)]


def parse_npy(content: bytes, least: int = 1000) -> np.ndarray:
    """The first three columns; fewer than `least` points are an error."""
    xyz = np.load(io.BytesIO(content), allow_pickle=False)[:, :3].astype(float)
    if len(xyz) < least:
        raise ValueError(f"{len(xyz)} points, needs {least}")
    return xyz


def read_clouds(spark: SparkSession, path: str) -> DataFrame:
    """file, point_id, x, y, z of .pcd and .npy files."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                xyz = parse_npy(bytes(content)) if file.endswith(".npy") else parse_pcd(bytes(content))
                for at in range(0, len(xyz), 100_000):
                    part = xyz[at : at + 100_000]
                    yield pd.DataFrame({"file": file, "point_id": np.arange(at, at + len(part)), "x": part[:, 0], "y": part[:, 1], "z": part[:, 2]})

    files = spark.read.format("binaryFile").load(path).filter(F.col("path").rlike(r"\.(pcd|npy)$")).select("path", "content")
    return files.mapInPandas(decode, "file string, point_id long, x double, y double, z double")


def decode_image(data: bytes, height: int, width: int, encoding: str) -> np.ndarray:
    """(height, width, 3) in blue, green, red."""
    if encoding == "mono8":
        return np.repeat(np.frombuffer(data, np.uint8).reshape(height, width, 1), 3, axis=2)
    if encoding not in ("bgr8", "rgb8"):
        raise ValueError(f"encoding {encoding}")
    image = np.frombuffer(data, np.uint8).reshape(height, width, 3)
    return image[:, :, ::-1] if encoding == "rgb8" else image


def pixel_table(images: DataFrame) -> DataFrame:
    """image_id, u, v, b, g, r of images (image_id, data, height, width, encoding)."""

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                image = decode_image(bytes(row.data), row.height, row.width, row.encoding)
                for v in range(0, row.height, 256):
                    part = image[v : v + 256]
                    y, x = np.mgrid[v : v + len(part), 0 : row.width]
                    yield pd.DataFrame(
                        {
                            "image_id": row.image_id, "u": x.ravel(), "v": y.ravel(), "b": part[:, :, 0].ravel(),
                            "g": part[:, :, 1].ravel(), "r": part[:, :, 2].ravel()
                        }
                    )

    return images.select("image_id", "data", "height", "width", "encoding").mapInPandas(explode, "image_id long, u int, v int, b int, g int, r int")
