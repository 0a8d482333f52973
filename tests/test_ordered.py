"""Row numbers, rows beside and quantiles against plain versions, in buckets of few rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.operators import ordered
from scanloom.operators.scan import nearest_k


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [(i % 3, v, f"x{v}") for i, v in enumerate(rng.sample(range(-500, 5000), 300))] + [(9, 7, "alone")]


def test_numbers_and_neighbours(spark, rows):
    df = spark.createDataFrame(rows, "g long, v long, s string")
    for n in (7, 10**6):
        number = {(r["g"], r["v"]): r["idx"] for r in ordered.numbered(df, "v", by=["g"], rows=n).collect()}
        near = {(r["g"], r["v"]): (r["p"], r["q"]) for r in ordered.beside(df, "v", {"p": "s", "q": "v"}, ["g"], rows=n).collect()}
        next_ = {(r["g"], r["v"]): r["p"] for r in ordered.beside(df, "v", {"p": "v"}, ["g"], after=True, rows=n).collect()}
        for g in {r[0] for r in rows}:
            own = sorted(r[1] for r in rows if r[0] == g)
            assert [number[g, v] for v in own] == list(range(len(own)))
            assert [near[g, v] for v in own] == [(None, None), *[(f"x{v}", v) for v in own[:-1]]]
            assert [next_[g, v] for v in own] == [*own[1:], None]
    whole = {r["v"]: r["idx"] for r in ordered.numbered(df.filter("g < 9"), "v", rows=11).collect()}
    assert [whole[v] for v in sorted(whole)] == list(range(300))


def test_one_far_value_leaves_buckets_even(spark):
    """A zero among stamps since the epoch, and a clock that stands still."""
    n, rows = 20_000, 500
    base = spark.range(n).select(F.when(F.col("id") == 77, 0).otherwise(1_700_000_000_000_000 + F.col("id") * 1000).alias("us"))
    cut, several = ordered.bucketed(base, "us", rows)
    sizes = [r["n"] for r in cut.groupBy("_bucket").agg(F.count("*").alias("n")).collect()]
    assert several and sum(sizes) == n and max(sizes) <= 2 * rows
    got = ordered.laid_out(base, "us", number="i", before={"b": "us"}, after={"a": "us"}, rows=rows).orderBy("i").collect()
    us = [0, *(1_700_000_000_000_000 + i * 1000 for i in range(n) if i != 77)]
    assert [(r["i"], r["us"], r["b"], r["a"]) for r in got] == list(zip(range(n), us, [None, *us], [*us[1:], None]))
    q = ordered.quantiles(base, {"low": (F.col("us"), 0.0001), "mid": (F.col("us"), 0.5)}, rows=300).collect()[0]
    assert (q["low"], q["mid"]) == pytest.approx(tuple(np.quantile(us, (0.0001, 0.5))), rel=1e-15)
    still = spark.range(3000).select(F.when(F.col("id") < 2900, 5).otherwise(F.col("id")).alias("v"), F.lit(None).cast("string").alias("g"))
    assert ordered.quantiles(still, {"m": (F.col("v"), 0.5), "x": (F.col("v"), 0.99)}, ["g"], rows=100).collect()[0]["m"] == 5
    numbers = ordered.numbered(still, "v", "i", ["g"], rows=100).select("i").collect()
    assert sorted(r["i"] for r in numbers) == list(range(3000))


def test_more_buckets_than_split_points(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SPLITS", 4)
    df = spark.range(1000).select((F.col("id") * F.col("id")).alias("v"))
    cut, _ = ordered.bucketed(df, "v", 10)
    assert cut.select("_bucket").distinct().count() > 50
    got = ordered.laid_out(df, "v", number="i", before={"b": "v"}, rows=10).orderBy("i").collect()
    assert [(r["v"], r["b"]) for r in got] == [(i * i, (i - 1) ** 2 if i else None) for i in range(1000)]


@pytest.mark.parametrize("rows_", [10, 10**6])
def test_quantiles_in_bins_of_few_rows(spark, rows_):
    rng = np.random.default_rng(6)
    data = {g: v for g, v in (("a", rng.lognormal(0, 4, 1500)), ("b", rng.integers(0, 3, 400) * 1.0), ("c", np.array([2.0])))}
    df = spark.createDataFrame([(g, float(x)) for g, v in data.items() for x in v], "g string, v double")
    got = {r["g"]: r for r in ordered.quantiles(df, {"p1": (F.col("v"), 0.01), "p50": (F.col("v"), 0.5), "p99": (-F.col("v"), 0.99)}, ["g"], rows_).collect()}
    for g, v in data.items():
        assert [got[g][c] for c in ("p1", "p50", "p99")] == pytest.approx([np.quantile(v, 0.01), np.quantile(v, 0.5), np.quantile(-v, 0.99)])


def test_quantiles(spark, rows):
    df = spark.createDataFrame([*rows, (9, None, "null"), (8, None, "none")], "g long, v long, s string")
    wanted = {"a": (F.col("v"), 0.01), "b": (F.col("v"), 0.5), "c": (F.col("v") * 0 + 3, 0.7), "d": (F.col("v"), 1.0)}
    got = {r["g"]: r for r in ordered.quantiles(df, wanted, ["g"]).collect()}
    for g in (0, 1, 2, 9):
        own = [r[1] for r in rows if r[0] == g]
        assert [got[g][c] for c in "abd"] == pytest.approx([np.quantile(own, q) for q in (0.01, 0.5, 1.0)]) and got[g]["c"] == 3
    assert 8 not in got or got[8]["a"] is None
    assert ordered.quantiles(df, wanted).collect()[0]["b"] == pytest.approx(np.median([r[1] for r in rows]))


def test_nearest_points_however_far(spark):
    rng = np.random.default_rng(2)
    p = [(i, *map(float, rng.uniform(0, 1, 3))) for i in range(120)] + [(500, 40.0, 0.0, 0.0), (501, 40.1, 0.0, 0.0)]
    df = spark.createDataFrame(p, "id long, x double, y double, z double")
    xyz = np.array([r[1:] for r in p])
    got = {r["id"]: r["distances"] for r in nearest_k(df, df, 0.2, 5, True).collect()}
    for i, (key, *_) in enumerate(p):
        want = np.sort(np.delete(np.linalg.norm(xyz - xyz[i], axis=1), i))[:5]
        assert got[key] == pytest.approx(want)
    few = nearest_k(df.limit(3), df.limit(2), 0.2, 5, False).collect()
    assert all(len(r["distances"]) == 2 for r in few)
