"""A textured test scene derived from the tables: a wavy grid mesh with one vertex per embedding, images posed around it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.sources.proxy import table

SIDE = 20


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vid, x, y, z: grid of SIDE columns and as many full rows as there are embeddings for, at a depth of about 3"""
    e = table(spark, sf_dir, "embeddings")
    col, row = F.col("vec_id") % SIDE, F.floor(F.col("vec_id") / SIDE)
    return e.select(
        F.col("vec_id").alias("vid"), (col * 0.1 - 0.95).cast("double").alias("x"),
        (row * 0.1 - 1.2).cast("double").alias("y"), (F.col("embedding")[0].cast("double") * 0.2 + 3.0).alias("z")
    )


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fid, i0, i1, i2: two triangles to a cell"""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("v"))
    cells = e.filter(F.col("v") % SIDE < SIDE - 1).join(e.select((F.col("v") - SIDE).alias("v")), "v")
    two = F.explode(
        F.array(
            F.struct((F.col("v") * 2).alias("fid"), F.col("v").alias("i0"), (F.col("v") + 1).alias("i1"), (F.col("v") + SIDE).alias("i2")),
            F.struct(
                (F.col("v") * 2 + 1).alias("fid"), (F.col("v") + 1).alias("i0"), (F.col("v") + SIDE + 1).alias("i1"),
                (F.col("v") + SIDE).alias("i2")
            )
        )
    )
    return cells.select(two.alias("f")).select("f.*")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """idx, r, t: identity-rotation poses that move with the embeddings"""
    e = table(spark, sf_dir, "embeddings")
    one = F.array(*[F.lit(float(i % 4 == 0)) for i in range(9)])
    return e.select(
        F.col("vec_id").alias("idx"), one.alias("r"),
        F.transform(F.slice("embedding", 5, 3).cast("array<double>"), lambda x: x * 0.5).alias("t")
    )


SQL = {
    "vertices": f"vertices AS (SELECT vec_id AS vid, ((vec_id % {SIDE}) * 0.1 - 0.95)::DOUBLE AS x, ((vec_id // {SIDE}) * 0.1 - 1.2)::DOUBLE AS y, embedding[1]::DOUBLE * 0.2 + 3.0 AS z FROM embeddings)",
    "faces": f"""cells AS (SELECT vec_id AS v FROM embeddings WHERE vec_id % {SIDE} < {SIDE - 1} AND vec_id + {SIDE} IN (SELECT vec_id FROM embeddings)),
faces AS (SELECT v * 2 AS fid, v AS i0, v + 1 AS i1, v + {SIDE} AS i2 FROM cells UNION ALL SELECT v * 2 + 1, v + 1, v + {SIDE} + 1, v + {SIDE} FROM cells)""",
    "images": "images AS (SELECT vec_id AS idx, [x * 0.5 FOR x IN embedding[5:7]::DOUBLE[]] AS t FROM embeddings)",
}
