"""Texturing a mesh from posed images: best image per face, and a z-buffer render as an aggregation.

Tables: vertices (vid, x, y, z); faces (fid, i0, i1, i2); images (idx, r: nine numbers by row, t: three), the sensor's pose in
the world; pixels (idx, u, v, b, g, r). Faces meet those images only whose view reaches their cell of space (frustum.py); assigned
images, vertices and pixels are joined on their keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.functions import geo
from scanloom.functions.calibration import Calibration
from scanloom.operators import frustum

#: Faces to a cell of space, if they cover a surface evenly; faces and cameras of a block; pairs that are in arrays at once.
CELL_FACES = 256
CHUNK = 4096
PAIRS = 1 << 18
MAX_TRIANGLE_PIXELS = 8000


def _pose(cal: Calibration) -> tuple[tuple, tuple]:
    """World to camera, of the columns r and t."""
    r = tuple(tuple(F.col("r")[3 * i + j] for j in range(3)) for i in range(3))
    return geo.world_to_camera(cal, r, tuple(F.col("t")[i] for i in range(3)))


def gather_corners(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """Faces with their corners' coordinates x0, y0, z0, .. z2."""
    out = faces
    for k in range(3):
        corner = vertices.select(F.col("vid").alias(f"i{k}"), *[F.col(a).alias(f"{a}{k}") for a in "xyz"])
        out = out.join(corner, f"i{k}")
    return out


def world_to_camera_table(images: DataFrame, cal: Calibration) -> DataFrame:
    """(idx, w: twelve numbers): each image's world-to-camera rotation by row, then its translation."""
    r, t = _pose(cal)
    return images.select("idx", F.array(*[c for row in r for c in row], *t).alias("w"))


def _camera(w: str, p: geo.Vec) -> tuple:
    m = F.col(w)
    return geo.transform([[m[3 * i + j] for j in range(3)] for i in range(3)], [m[9 + i] for i in range(3)], p)


def _scores(c: np.ndarray, n: np.ndarray, w: np.ndarray, cal: Calibration) -> np.ndarray:
    """Of faces (centres c, normals n) by cameras (w): the absolute cosine between the normal and the direction to the camera, -1 where
    the centre isn't in front and in frame."""
    turn, shift = w[:, :9].reshape(-1, 3, 3), w[:, 9:]
    x, y, z = (c[:, 0:1] * turn[:, i, 0] + c[:, 1:2] * turn[:, i, 1] + c[:, 2:3] * turn[:, i, 2] + shift[:, i] for i in range(3))
    front = z > 0
    safe = np.where(front, z, 1.0)
    x, y = x / safe, y / safe
    k1, k2, p1, p2, k3 = cal.distortion
    r2 = x * x + y * y
    radial = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
    u = cal.fx * (x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x)) + cal.cx
    v = cal.fy * (y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y) + cal.cy
    inside = front & (u >= 0) & (u < cal.width) & (v >= 0) & (v < cal.height)
    eye = -(turn * shift[:, :, None]).sum(axis=1)
    to = [eye[:, i] - c[:, i : i + 1] for i in range(3)]
    far = 1 / (np.sqrt(to[0] * to[0] + to[1] * to[1] + to[2] * to[2]) + 1e-12)
    headon = np.abs(sum(n[:, i : i + 1] * (to[i] * far) for i in range(3)))
    return np.where(inside, headon, -1.0)


def _best_of(faces: pa.Table, cameras: pa.Table, cal: Calibration) -> pa.Table:
    """(fid, idx, score): each face's best camera; of scores equal to nine places the lowest idx."""
    array = lambda t, name, width: np.array(t[name].to_pylist(), float).reshape(-1, width)
    order = np.argsort(cameras["idx"].to_numpy(), kind="stable")
    idx, w = cameras["idx"].to_numpy()[order], array(cameras, "w", 12)[order]
    c, n = array(faces, "c", 3), array(faces, "n", 3)
    best, at = np.full(len(c), -1.0), np.zeros(len(c), np.int64)
    for lo in range(0, len(c), max(1, PAIRS // max(1, len(idx)))):
        part = slice(lo, lo + max(1, PAIRS // max(1, len(idx))))
        if len(idx):
            score = np.floor(_scores(c[part], n[part], w, cal) * 1e9 + 0.5)
            at[part] = score.argmax(axis=1)
            best[part] = np.take_along_axis(score, at[part][:, None], 1)[:, 0] / 1e9
    seen = best >= 0
    kept = idx[at[seen]] if len(idx) else idx
    return pa.table([faces["fid"].filter(pa.array(seen)), pa.array(kept, pa.int64()), pa.array(best[seen])], names=["fid", "idx", "score"])


def seen_pairs(faces: DataFrame, vertices: DataFrame, images: DataFrame, cal: Calibration, cell_faces: int = CELL_FACES) -> tuple[DataFrame, DataFrame]:
    """Faces (fid, c, n, cell) and cameras (cell, idx, w): a face can be seen by the cameras of its cell only."""
    corners = gather_corners(faces, vertices)
    p = [geo.cols(f"x{k}", f"y{k}", f"z{k}") for k in range(3)]
    centre = geo.scale(geo.add(geo.add(p[0], p[1]), p[2]), F.lit(1 / 3))
    flat = corners.select("fid", F.array(*centre).alias("c"), F.array(*geo.face_normal(*p)).alias("n"))
    placed, levels = frustum.with_cells(flat, "c", cell_faces)
    cameras = frustum.seen_cells(placed, "c", levels, world_to_camera_table(images, cal), cal)
    return placed.select("fid", "c", "n", frustum.cell_of(0, "_ix", "_iy", "_iz").alias("cell")), cameras


def best_images(faces: DataFrame, vertices: DataFrame, images: DataFrame, cal: Calibration, cell_faces: int = CELL_FACES, chunk: int = CHUNK) -> DataFrame:
    """Per face: best_img (-1 if none sees it) and best_score, the absolute cosine between the face's normal and the direction to
    the camera, over images with the face's centre in front and in frame. Of equal scores the lowest image wins.

    Faces meet the cameras of their cell, in blocks of about `chunk` of either; each block gives a face's best, an aggregation the
    best of all."""
    flat, cameras = seen_pairs(faces, vertices, images, cal, cell_faces)
    parts = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count("*") / chunk).cast("int").alias(name))
    sizes = parts(flat, "nf").join(parts(cameras, "nc"), "cell")
    part = lambda by, of: F.pmod(F.xxhash64(by), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    mine = flat.join(sizes, "cell").withColumn("fc", part("fid", "nf")).withColumn("cc", every("nc"))
    theirs = cameras.join(sizes, "cell").withColumn("cc", part("idx", "nc")).withColumn("fc", every("nf"))
    key = ["cell", "fc", "cc"]
    blocks = mine.select(*key, "fid", "c", "n").groupBy(*key).cogroup(theirs.select(*key, "idx", "w").groupBy(*key))
    found = blocks.applyInArrow(lambda f, c: _best_of(f, c, cal), "fid long, idx long, score double")
    best = found.groupBy("fid").agg(F.max(F.struct(F.round("score", 9).alias("score"), (-F.col("idx")).alias("neg"))).alias("b"))
    return faces.select("fid").join(best, "fid", "left").select(
        "fid", F.coalesce(-F.col("b.neg"), F.lit(-1)).cast("long").alias("best_img"),
        F.coalesce("b.score", F.lit(-1.0)).alias("best_score")
    )


def render(
    faces: DataFrame,
    vertices: DataFrame,
    assignment: DataFrame,
    images: DataFrame,
    cal: Calibration,
    view: int,
    shrink: int = 4,
) -> DataFrame:
    """(yy, xx, z, fid, img, u, v): for each covered pixel of the view's image the nearest face and the texel that colours it.
    Of equal depths the lowest face wins. Guards come before pixels are made, so a triangle makes at most `MAX_TRIANGLE_PIXELS`."""
    corners = gather_corners(faces, vertices).join(assignment.filter("best_img >= 0").select("fid", F.col("best_img").alias("img")), "fid")
    poses = world_to_camera_table(images, cal)
    source = poses.select(F.col("idx").alias("img"), F.col("w").alias("ws"))
    target = F.broadcast(poses.filter(F.col("idx") == view).select(F.col("w").alias("wr")))
    t = corners.join(source, "img").crossJoin(target)
    seen = {}
    for k in range(3):
        p = geo.cols(f"x{k}", f"y{k}", f"z{k}")
        seen |= {f"r{k}": geo.pixel(cal, _camera("wr", p)), f"s{k}": geo.pixel(cal, _camera("ws", p))}
    t = t.select("fid", "img", *[c.alias(n) for n, c in seen.items()])
    t = t.filter(" AND ".join(f"r{k} IS NOT NULL AND s{k}.inside" for k in range(3)))
    pix = {}
    for k in range(3):
        pix |= {
            f"pu{k}": F.col(f"r{k}.u") / shrink, f"pv{k}": F.col(f"r{k}.v") / shrink, f"tu{k}": F.col(f"s{k}.u"),
            f"tv{k}": F.col(f"s{k}.v"), f"rz{k}": F.col(f"r{k}.z")
        }
    t = t.select("fid", "img", *[c.alias(n) for n, c in pix.items()])
    return rasterise(t, cal.width // shrink, cal.height // shrink, cal)


def rasterise(t: DataFrame, width: int, height: int, cal: Calibration) -> DataFrame:
    """t: fid, img, and for the corners k = 0, 1, 2 pixel (puk, pvk), texel (tuk, tvk) and depth rzk."""
    pu, pv = [F.col(f"pu{k}") for k in range(3)], [F.col(f"pv{k}") for k in range(3)]
    corner = [(pu[k], pv[k]) for k in range(3)]
    t = t.withColumn(
        "box",
        F.struct(
            F.greatest(F.floor(F.least(*pu)), F.lit(0)).alias("minx"), F.least(F.ceil(F.greatest(*pu)), F.lit(width - 1)).alias("maxx"),
            F.greatest(F.floor(F.least(*pv)), F.lit(0)).alias("miny"), F.least(F.ceil(F.greatest(*pv)), F.lit(height - 1)).alias("maxy"),
            geo.barycentric_base(*corner).alias("d"),
        ),
    ).select("*", "box.*")
    t = t.filter("maxx >= minx AND maxy >= miny").filter(
        (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny")) <= MAX_TRIANGLE_PIXELS
    ).filter(F.abs("d") >= 1e-6)
    t = t.withColumn("yy", F.explode(F.sequence("miny", "maxy"))).withColumn("xx", F.explode(F.sequence("minx", "maxx")))
    a, b, g = geo.barycentric(*corner, F.col("xx"), F.col("yy"), F.col("d"))
    t = t.withColumns({"a": a, "b": b, "g": g}).filter("a >= 0 AND b >= 0 AND g >= 0")
    mixed = lambda n: F.col("a") * F.col(f"{n}0") + F.col("b") * F.col(f"{n}1") + F.col("g") * F.col(f"{n}2")
    t = t.select(
        "yy", "xx", "fid", "img", mixed("rz").alias("z"), geo.texel(mixed("tu"), cal.width).alias("u"),
        geo.texel(mixed("tv"), cal.height).alias("v")
    )
    nearest = t.groupBy("yy", "xx").agg(F.min(F.struct(F.round("z", 9).alias("z"), "fid", "img", "u", "v")).alias("p"))
    return nearest.select("yy", "xx", "p.*")


def colour(rendered: DataFrame, pixels: DataFrame) -> DataFrame:
    """Rendered pixels with b, g, r of their texel; those without one are left out."""
    return rendered.join(pixels.withColumnRenamed("idx", "img"), ["img", "u", "v"])


def coverage(coloured: DataFrame, width: int, height: int) -> DataFrame:
    """Share of the image's pixels that aren't black; a truly black texel counts as uncovered."""
    return coloured.agg((F.count_if(F.col("b") + F.col("g") + F.col("r") > 0) / float(width * height)).alias("coverage"))


def seen_share(assignment: DataFrame) -> DataFrame:
    return assignment.agg(F.avg((F.col("best_img") >= 0).cast("double")).alias("seen_share"))


def top_view(vertices: DataFrame, cal: Calibration) -> DataFrame:
    """Vertices seen from above: x and y scaled to the image, depth from the lowest."""
    ends = vertices.agg(*[f(a).alias(f"{n}{a}") for a in "xyz" for n, f in (("lo", F.min), ("hi", F.max))])
    x = vertices.crossJoin(F.broadcast(ends))
    place = lambda a, size: (F.col(a) - F.col(f"lo{a}")) / (F.col(f"hi{a}") - F.col(f"lo{a}") + 1e-9) * size
    return x.select("vid", place("x", cal.width).alias("u"), place("y", cal.height).alias("v"), (F.col("z") - F.col("loz") + 0.1).alias("depth"))


def render_top(faces: DataFrame, vertices: DataFrame, images: DataFrame, cal: Calibration, source: int, shrink: int = 4) -> DataFrame:
    """The mesh seen from above, as `top_view` lays it out, with the colours of image number `source`: (yy, xx, z, fid, img, u, v) for each
    covered pixel, the lowest point on it wins. Triangles stay out if a corner falls outside the image. As depth counts from the lowest
    vertex here, corners behind the camera are mirrored into the image and take part.

    Vertices are placed once, before faces gather them."""
    pose = F.broadcast(world_to_camera_table(images, cal).filter(F.col("idx") == source).select("w"))
    seen = vertices.crossJoin(pose).select("vid", F.array(F.struct(*[c.alias(a) for c, a in zip(_camera("w", geo.cols("x", "y", "z")), "xyz")])).alias("c"))
    texel = F.transform("c", lambda c: F.struct(*[t.alias(n) for t, n in zip(geo.project(cal, (c["x"], c["y"], F.nullif(c["z"], F.lit(0.0)))), "uv")]))[0]
    placed = top_view(vertices, cal).join(seen.select("vid", texel.alias("t")), "vid")
    placed = placed.filter(geo.in_frame(cal, F.col("t.u"), F.col("t.v")))
    out = faces
    for k in range(3):
        corner = placed.select(
            F.col("vid").alias(f"i{k}"), (F.col("u") / shrink).alias(f"pu{k}"), (F.col("v") / shrink).alias(f"pv{k}"),
            F.col("t.u").alias(f"tu{k}"), F.col("t.v").alias(f"tv{k}"), F.col("depth").alias(f"rz{k}")
        )
        out = out.join(corner, f"i{k}")
    return rasterise(out.drop("i0", "i1", "i2").withColumn("img", F.lit(source).cast("long")), cal.width // shrink, cal.height // shrink, cal)
