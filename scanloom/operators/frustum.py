"""Which images can see which cells of space: an octree of the occupied cells, descended by equi-joins from each image.

A cell is the sphere around what it holds. An image's frustum is five planes in camera coordinates, wide enough for every ray
that the lens can bend into the frame; a cell that lies outside of one of them can't be seen, and nor can its children."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.functions import geo
from scanloom.functions.calibration import Calibration

#: Parts of a cell along each axis.
PARTS = 4
#: Cells per axis of the top level, at most; so many to the third power are broadcast.
TOP = 4
#: Levels below the top whose tables are broadcast: at most (TOP * PARTS ** LEVELS) ** 3 cells, 4,096 with one.
LEVELS = 1


def ray_bounds(cal: Calibration, far: float = 50.0) -> tuple[float, float] | None:
    """Bounds of |x / z| and |y / z| of points that are in frame; None if the lens' polynomial doesn't bound them.

    A distorted ray is at least r |radial| - 3 (|p1| + |p2|) r^2 long, which has to reach beyond the frame's corner for all r from
    some r on; below that r, the smallest radial factor turns the frame's half sides into bounds of x and y."""
    k1, k2, p1, p2, k3 = cal.distortion
    half_x, half_y = max(cal.cx, cal.width - cal.cx) / cal.fx, max(cal.cy, cal.height - cal.cy) / cal.fy
    tangent = 3 * (abs(p1) + abs(p2))
    r = np.linspace(0, far, 200_001)
    radial = np.abs(1 + r**2 * (k1 + r**2 * (k2 + r**2 * k3)))
    beyond = r * radial - tangent * r**2 > math.hypot(half_x, half_y) * 1.01
    # past `far` the leading term has to outgrow the others
    lead = next(((n, abs(k)) for n, k in ((7, k3), (5, k2), (3, k1)) if k), (1, 1.0))
    rest = sum(abs(k) * far**n for n, k in ((5, k2), (3, k1), (1, 1.0)) if n < lead[0]) + tangent * far**2
    if not beyond[-1] or (lead[0] > 1 or tangent) and lead[1] * far ** lead[0] < 2 * rest:
        return None
    last = int(np.flatnonzero(~beyond)[-1]) + 1
    step = r[1] * np.abs(np.gradient(radial[: last + 1], r[1])).max()
    least = radial[: last + 1].min() - step
    if least <= 0:
        return None
    slack = tangent * r[last] ** 2
    return (half_x + slack) / least, (half_y + slack) / least


def may_see(bounds: tuple[float, float] | None, w: Column, centre: Column, radius: Column) -> Column:
    """Whether a sphere reaches into the frustum of a camera (w: world to camera, twelve numbers)."""
    c = [F.lit(0.0)] * 3
    for i in range(3):
        c[i] = w[3 * i] * centre[0] + w[3 * i + 1] * centre[1] + w[3 * i + 2] * centre[2] + w[9 + i]
    reach = radius * (1 + 1e-9) + 1e-9
    out = c[2] > -reach
    for along, bound in zip(c[:2], bounds or ()):
        out &= F.abs(along) - bound * c[2] <= reach * math.sqrt(1 + bound * bound)
    return out


def cell_of(level: int, *at: str) -> Column:
    """The key of the level's cell from the finest level's indices."""
    x, y, z = (F.floor(F.col(a) / PARTS**level) for a in at)
    return (F.shiftleft(x, 42) + F.shiftleft(y, 21) + z).cast("long")


def with_cells(df: DataFrame, at: str, per_cell: int) -> tuple[DataFrame, int]:
    """df with indices _ix, _iy, _iz of cubes of one size, and the number of levels above them. The size is the largest at which about
    as many cubes are occupied as hold `per_cell` rows each, whatever the shape of what the rows cover."""
    p = geo.of_array(F.col(at), 3)
    ends = df.agg(F.count("*").alias("n"), *[f(c).alias(f"{name}{a}") for c, a in zip(p, "xyz") for name, f in (("lo", F.min), ("hi", F.max))]).first()
    low = [ends[f"lo{a}"] or 0.0 for a in "xyz"]
    widest = max((ends[f"hi{a}"] or 0.0) - lo for a, lo in zip("xyz", low)) or 1.0
    index = lambda along: [F.least(F.floor((c - lo) / (widest / along)), F.lit(along)).cast("long") for c, lo in zip(p, low)]
    halvings = range(min(20, 2 + max(1, ends["n"]).bit_length()))
    occupied = df.agg(*[F.approx_count_distinct(F.xxhash64(*index(1 << d))).alias(str(d)) for d in halvings]).first()
    along = 1 << next((d for d in halvings if occupied[str(d)] * per_cell >= ends["n"]), halvings[-1])
    levels = 0
    while (along + 1) / PARTS**levels > TOP:
        levels += 1
    return df.withColumns({f"_i{a}": c for a, c in zip("xyz", index(along))}), levels


def seen_cells(placed: DataFrame, at: str, levels: int, cameras: DataFrame, cal: Calibration) -> DataFrame:
    """(cell, idx, w): the finest cells of `placed` (with_cells) that each camera (idx, w) may see."""
    bounds, ixs = ray_bounds(cal), ("_ix", "_iy", "_iz")
    p = geo.of_array(F.col(at), 3)
    boxes = placed.groupBy(*ixs).agg(*[f(c).alias(f"{n}{a}") for c, a in zip(p, "xyz") for n, f in (("lo", F.min), ("hi", F.max))])
    tables = []
    for level in range(levels + 1):
        key, above = cell_of(level, *ixs), cell_of(level + 1, *ixs)
        ends = [f(f"{n}{a}").alias(f"{n}{a}") for a in "xyz" for n, f in (("lo", F.min), ("hi", F.max))]
        cells = boxes.groupBy(key.alias("cell"), above.alias("above")).agg(*ends)
        radius = F.sqrt(sum((F.col(f"hi{a}") - F.col(f"lo{a}")) ** 2 for a in "xyz")) / 2
        tables.append(cells.select("cell", "above", F.array(*[(F.col(f"hi{a}") + F.col(f"lo{a}")) / 2 for a in "xyz"]).alias("centre"), radius.alias("radius")))
    sees = may_see(bounds, F.col("w"), F.col("centre"), F.col("radius"))
    # the top level has TOP cells to an axis at most, so the product is a bounded number of rows for each camera
    met = cameras.crossJoin(F.broadcast(tables[-1].drop("above"))).filter(sees).select("cell", "idx", "w")
    for level in range(levels - 1, -1, -1):
        below = tables[level]
        below = F.broadcast(below) if levels - level <= LEVELS else below
        met = met.withColumnRenamed("cell", "above").join(below, "above").filter(sees).select("cell", "idx", "w")
    return met
