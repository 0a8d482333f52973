"""Row numbers, the rows beside and exact quantiles of tables of any length, without one task that sees all rows.

Rows are cut into buckets of the ordering column. Windows run in a bucket; what a bucket needs from those before it (a
count, a last row) comes from a table of one row per bucket. Where buckets end is told by a mergeable quantile summary of one pass
over the data, so that a few far values (a clock that stood at zero, say) don't put all others into one bucket. Rows of one
value are one bucket."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: About so many rows to a bucket; tables of fewer aren't cut.
BUCKET_ROWS = 100_000
#: Split points at most. Of more buckets than that, several of equal width lie between two split points.
SPLITS = 1000
#: Ranks of a summary are right up to this share.
ACCURACY = 10_000


def split_points(n: int, summary: list[float] | None, rows: int) -> list[float]:
    """Of a summary's values those between which about `rows` of n rows lie, ascending, SPLITS of them at most."""
    wanted, points = math.ceil(n / rows), [p for p in summary or [] if math.isfinite(p)]
    if wanted < 2 or not points:
        return []
    each = len(points) / wanted
    taken = points if wanted > len(points) else [points[min(len(points) - 1, int(i * each))] for i in range(1, wanted)]
    return sorted(set(taken))


def summary_of(x: Column) -> Column:
    return F.percentile_approx(x, [i / SPLITS for i in range(1, SPLITS)], ACCURACY)


def cut_at(df: DataFrame, x: str, points: list[float], out: str, inner: int = 1) -> DataFrame:
    """df with `out`: between which of the points x (double) lies, ascending; `inner` parts of equal width between two of them. Null is
    below all, NaN above."""
    if not points:
        return df.withColumn(out, F.lit(0).cast("long"))
    found = Bucketizer(splits=[-math.inf, *points, math.inf], inputCol=x, outputCol="_at", handleInvalid="keep").transform(df)
    at = F.coalesce(F.col("_at").cast("long"), F.lit(-1))
    if inner > 1:
        ends = F.array(*[F.lit(p) for p in (points[0], *points, points[-1])])
        low, high = F.get(ends, at.cast("int")), F.get(ends, at.cast("int") + 1)
        share = F.try_divide(F.col(x) - low, high - low) * inner
        within = F.greatest(F.least(F.floor(F.coalesce(share, F.lit(0.0))), F.lit(inner - 1)), F.lit(0)).cast("long")
        at = at * inner + F.when(at >= 0, within).otherwise(0)
    return found.withColumn(out, at).drop("_at")


def bucketed(df: DataFrame, order: str, rows: int = BUCKET_ROWS) -> tuple[DataFrame, bool]:
    """df with `_bucket`, ascending in `order`, a numeric column, and whether there are several. Null is in the first bucket, where
    it sorts."""
    x = F.col(order).cast("double")
    told = df.agg(F.count("*").alias("n"), summary_of(x).alias("s")).first()
    points = split_points(told["n"], told["s"], rows)
    inner = math.ceil(told["n"] / rows / (len(points) + 1))
    return cut_at(df.withColumn("_x", x), "_x", points, "_bucket", inner).drop("_x"), bool(points)


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """left joined with right's other columns on equal names, null being equal to null."""
    renamed = right.select(*[F.col(c).alias(f"_of_{c}" if c in names else c) for c in right.columns])
    on = F.lit(True)
    for c in names:
        on = on & left[c].eqNullSafe(renamed[f"_of_{c}"])
    return left.join(renamed, on).drop(*[f"_of_{c}" for c in names])


def laid_out(
    df: DataFrame, order: str, by: Sequence[str] = (), number: str | None = None, before: dict[str, str] | None = None,
    after: dict[str, str] | None = None, rows: int = BUCKET_ROWS
) -> DataFrame:
    """df with, per group and in order of `order`: `number`, each row's place from 0; and columns of the row before it and of the row
    after it (names of new columns to those they are read from). One summary, one window, one join for all of them."""
    cut, several = bucketed(df, order, rows)
    kept = lambda columns: F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    own = Window.partitionBy(*by, "_bucket").orderBy(order)
    near, parts = {}, []
    if number:
        near["_own"], start = F.row_number().over(own) - 1, F.lit(0)
        parts.append(F.count("*").alias("_n"))
    if before:
        near["_left"] = F.lag(kept(before)).over(own)
        parts.append(F.max_by(kept(before), order).alias("_last"))
    if after:
        near["_right"] = F.lead(kept(after)).over(own)
        parts.append(F.min_by(kept(after), order).alias("_first"))
    out = cut.withColumns(near)
    if several:
        along = Window.partitionBy(*by).orderBy("_bucket")
        told = {}
        if number:
            told["_start"] = F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        if before:
            told["_last"] = F.lag("_last").over(along)
        if after:
            told["_first"] = F.lead("_first").over(along)
        ends = cut.groupBy(*by, "_bucket").agg(*parts).select(*by, "_bucket", *[c.alias(n) for n, c in told.items()])
        out, start = same(out, ends, [*by, "_bucket"]), F.col("_start")
    new = {number: F.col("_own") + start} if number else {}
    for columns, inside, edge in ((before, "_left", "_last"), (after, "_right", "_first")):
        row = F.coalesce(inside, edge) if several else F.col(inside)
        new |= {n: row[n] for n in columns or {}}
    return out.withColumns(new).drop("_own", "_left", "_right", "_start", "_last", "_first", "_bucket")


def numbered(df: DataFrame, order: str, out: str = "idx", by: Sequence[str] = (), rows: int = BUCKET_ROWS) -> DataFrame:
    """df with the place of each row in its group, from 0, in order of `order`."""
    return laid_out(df, order, by, number=out, rows=rows)


def beside(df: DataFrame, order: str, columns: dict[str, str], by: Sequence[str] = (), after: bool = False, rows: int = BUCKET_ROWS) -> DataFrame:
    """df with columns of the row before it in its group (or after it): names of new columns to those they are read from."""
    return laid_out(df, order, by, **{"after" if after else "before": columns}, rows=rows)


def first_rows(df: DataFrame, order: str, n: int, by: Sequence[str] = ()) -> DataFrame:
    """The first n rows of each group with `place`, from 0. Each task keeps n rows of a group before they meet."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1
    return df.withColumn("place", place).filter(F.col("place") < n)


def quantiles(df: DataFrame, wanted: dict[str, tuple[Column, float]], by: Sequence[str] = (), rows: int = BUCKET_ROWS) -> DataFrame:
    """Per group exact quantiles by linear interpolation: names to (value, share). Null values don't count; a group without any
    has nulls.

    A summary of one pass cuts the values into bins; a count of each bin tells which bin holds a wanted rank, and of those bins only
    the values are counted one by one. Equal values are one row there."""
    by, names = list(by), list(wanted)
    held = df.select(*by, *[c.cast("double").alias(f"_v{i}") for i, (c, _) in enumerate(wanted.values())])
    told = held.agg(F.count("*").alias("n"), *[summary_of(F.col(f"_v{i}")).alias(f"s{i}") for i in range(len(names))]).first()
    each = []
    for i, (_, p) in enumerate(wanted.values()):
        points = split_points(told["n"], told[f"s{i}"], rows)
        held = cut_at(held, f"_v{i}", points, f"_bin{i}", math.ceil(told["n"] / rows / (len(points) + 1)))
        each.append(F.struct(F.lit(i).alias("q"), F.lit(float(p)).alias("p"), F.col(f"_v{i}").alias("v"), F.col(f"_bin{i}").alias("bin")))
    binned = held.select(*by, F.explode(F.array(*each)).alias("x")).select(*by, "x.*").filter("v IS NOT NULL")
    key = [*by, "q"]
    counts = binned.groupBy(*key, "bin").agg(F.count("*").alias("c"), F.max("p").alias("p"))
    group = Window.partitionBy(*key)
    counts = counts.withColumns({"total": F.sum("c").over(group), "upto": F.sum("c").over(group.orderBy("bin"))})
    rank = F.col("p") * (F.col("total") - 1)
    ranks = counts.withColumn("share", rank - F.floor(rank)).withColumn("rank", F.explode(F.array(F.floor(rank), F.ceil(rank))))
    ranks = ranks.filter("rank < upto AND rank >= upto - c").withColumn("within", F.col("rank") - F.col("upto") + F.col("c"))
    ranks = ranks.select(*key, "bin", "share", "rank", "within").distinct()
    values = same(binned, ranks.select(*key, "bin").distinct().withColumn("_hit", F.lit(True)), [*key, "bin"])
    values = values.filter("_hit").groupBy(*key, "bin", "v").agg(F.count("*").alias("c"))
    values = values.withColumn("upto", F.sum("c").over(Window.partitionBy(*key, "bin").orderBy("v")))
    hit = same(values, ranks, [*key, "bin"]).filter("within < upto AND within >= upto - c")
    one = hit.groupBy(*key).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max("share").alias("share"))
    one = one.withColumn("at", F.col("low") + F.col("share") * (F.col("high") - F.col("low")))
    return one.groupBy(*by).agg(*[F.max(F.when(F.col("q") == i, F.col("at"))).alias(n) for i, n in enumerate(names)])
