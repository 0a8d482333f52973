"""Image files: what is written is read again, by this reader and by another one."""

import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.sources import frames


def other_png(image, filters, colour=2):
    """A file with the given row filters, by plain definition."""
    h, w, n = image.shape
    flat = image.reshape(h, w * n).astype(int)
    raw = b""
    for y in range(h):
        kind = filters[y % len(filters)]
        row = []
        for i in range(w * n):
            left, up = flat[y, i - n] if i >= n else 0, flat[y - 1, i] if y else 0
            corner = flat[y - 1, i - n] if y and i >= n else 0
            p = left + up - corner
            paeth = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
            row.append((flat[y, i] - (0, left, up, (left + up) // 2, paeth)[kind]) % 256)
        raw += bytes([kind, *row])
    head = struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)
    return frames.MAGIC + frames.chunk(b"IHDR", head) + frames.chunk(b"IDAT", zlib.compress(raw)) + frames.chunk(b"IEND", b"")


def test_all_row_filters_are_read():
    rng = np.random.default_rng(5)
    rgb = rng.integers(0, 256, (11, 7, 3), dtype=np.uint8)
    assert (frames.decode_png(other_png(rgb, [0, 1, 2, 3, 4])) == rgb[:, :, ::-1]).all()
    grey = rng.integers(0, 256, (4, 5, 1), dtype=np.uint8)
    assert (frames.decode_png(other_png(grey, [4, 3], 0)) == np.repeat(grey, 3, axis=2)).all()
    whole = other_png(rgb, [1])
    for broken in (b"", whole[:-20], whole[:60] + b"x" + whole[61:], b"\xff\xd8jpeg"):
        with pytest.raises(ValueError):
            frames.decode_png(broken)


def test_pixels_to_files_and_back(spark, tmp_path):
    rng = np.random.default_rng(2)
    w, h = 40, 150
    wanted, rows = {}, []
    for i in (0, 1, 12):
        image = np.zeros((h, w, 3), np.uint8)
        for y, x in rng.integers(0, (h, w), (300, 2)) if i else []:
            image[y, x] = rng.integers(0, 256, 3)
        ys, xs = np.nonzero(image.any(axis=2))
        rows += [(i, int(y), int(x), *map(int, image[y, x])) for y, x in zip(ys, xs)]
        wanted[i] = image
    rows.append((0, 149, 39, 0, 0, 0))  # a black image is a file, too
    pixels = spark.createDataFrame(rows, "idx long, yy int, xx int, b int, g int, r int").withColumn("file", frames.frame_name("idx"))
    frames.write_files(frames.images_of(pixels, w, h), f"{tmp_path}/out")
    assert sorted(os.listdir(tmp_path / "out")) == ["img_00000.png", "img_00001.png", "img_00012.png"]
    (tmp_path / "out" / "img_00001a.jpg").write_bytes(b"\xff\xd8")
    (tmp_path / "out" / "img_00003.png").write_bytes((tmp_path / "out" / "img_00012.png").read_bytes()[:-30])
    got = {r["idx"]: r for r in frames.read_frames(spark, f"{tmp_path}/out").collect()}
    assert [got[i]["file"].rsplit("/", 1)[1] for i in range(5)] == ["img_00000.png", "img_00001.png", "img_00001a.jpg", "img_00003.png", "img_00012.png"]
    assert [got[i]["ok"] for i in range(5)] == [True, True, False, False, True]
    for i, k in ((0, 0), (1, 1), (4, 12)):
        assert (np.frombuffer(got[i]["data"], np.uint8).reshape(h, w, 3) == wanted[k]).all()
    matched = spark.createDataFrame([(0, True, 1.0), (1, False, 2.0), (2, True, 3.0), (4, True, 4.0), (9, True, 5.0)], "idx long, ok boolean, px double")
    assert sorted((r["idx"], r["px"]) for r in frames.posed_frames(frames.read_frames(spark, f"{tmp_path}/out"), matched).collect()) == [(0, 1.0), (4, 4.0)]


def test_a_failed_job_leaves_no_file(spark, tmp_path):
    files = spark.range(6).repartition(3).select(
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("file"),
        F.when(F.col("id") == 5, F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.lit(b"x")).alias("content")
    )
    with pytest.raises(Exception, match="broken"):
        frames.write_files(files, f"{tmp_path}/out")
    assert not os.path.exists(tmp_path / "out") or os.listdir(tmp_path / "out") == []
    outside = spark.createDataFrame([("a.png", 9, 0, 1, 1, 1)], "file string, yy int, xx int, b int, g int, r int")
    with pytest.raises(Exception, match="outside"):
        frames.images_of(outside, 4, 4).collect()
