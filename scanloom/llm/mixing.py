"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a target number of words. Whole copies of the source cover as much of the target as they
can; for the rest the documents are counted by exact length, each length gives the same share of its
documents, and a bounded-knapsack dynamic program over the lengths still unused fills what is left, nearly
always to the word. Which documents of a length are taken follows a seeded hash.

Data flow: one scan of the texts for (id, source, length) rows, kept as a table; (source, length, salt) counts, aggregated map-side; one small group per source
(distinct lengths, not documents) for the dynamic program; one shuffle of (id, source, size) rows by
(source, length, salt) for the seeded choice. A source or length that holds a third of all rows is spread
over `salts` groups, as many as the table has millions of rows, each with its own quota, so that no task sees it whole.

Cases: a null text has size 0, a null source is a source of its own (last in order), documents of size 0 take
0 words, repeated rows are separate documents, an empty table gives an empty result. Columns of the input
other than those named are ignored, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanloom.llm.common import materialise, n_words, scratch, text_of

#: Sources whose totals are fitted on the driver, one small row each; more than that raises.
MAX_SOURCES = 200_000
#: Rows of all lengths to a salt: a length that a third of all rows have is as many rows a group at most.
SALT_ROWS = 1_000_000
#: Lengths of sources up to which they are broadcast to the documents.
BROADCAST_LENGTHS = 200_000


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, cap: float) -> list[float]:
    """Targets that add up to `total` (or to all caps, if less), proportional to weight except where a source
    stops at cap * size and its excess goes to the others by weight."""
    targets = [0.0] * len(sizes)
    left, open_ = float(total), [i for i, s in enumerate(sizes) if s > 0]
    while open_ and left > 0:
        per_weight = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * per_weight > cap * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = weights[i] * per_weight
            break
        for i in full:
            targets[i] = float(cap * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = 4) -> np.ndarray:
    """How many documents of each length to take so that their lengths sum to `budget`, or to the largest sum
    below it that the search finds.

    An even share of every length comes first. Then single documents, longest first, until less than `window`
    times the longest length is open; the bounded-knapsack program decides the rest over reachable sums, kept
    as the bits of one integer per length."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    usable = lengths > 0
    whole = int((lengths * counts).sum())
    if budget <= 0 or whole == 0:
        return np.zeros_like(counts)
    if budget >= whole:
        return np.where(usable, counts, 0)
    take = np.where(usable, (counts * (budget / whole)).astype(np.int64), 0)
    left = budget - int((take * lengths).sum())
    while left < 0:  # rounding of very large counts
        i = int(np.argmax(take * lengths))
        take[i] -= 1
        left += int(lengths[i])
    order = [int(i) for i in np.argsort(-lengths, kind="stable") if usable[i]]
    keep_open = window * int(lengths.max())
    for i in order:
        if left <= keep_open:
            break
        n = min(int(counts[i] - take[i]), (left - keep_open) // int(lengths[i]) + 1, left // int(lengths[i]))
        take[i] += n
        left -= n * int(lengths[i])
    # Reachable sums after each item; an item is a power-of-two bundle of one length.
    mask, reach, seen = (1 << (left + 1)) - 1, 1, []
    for i in order:
        spare, bundle = min(int(counts[i] - take[i]), left // int(lengths[i])), 1
        while spare > 0 and not reach >> left & 1:
            n = min(bundle, spare)
            seen.append((i, n, reach))
            reach |= reach << (n * int(lengths[i])) & mask
            spare, bundle = spare - n, bundle * 2
    best = reach.bit_length() - 1
    for i, n, before in reversed(seen):
        if not before >> best & 1:
            take[i] += n
            best -= n * int(lengths[i])
    return take


def _named_source(source_col: str) -> Column:
    return F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))


def _ranked(sized: DataFrame, seed: int) -> DataFrame:
    return sized.withColumn("rank", F.xxhash64(F.lit(seed), F.col("id").cast("string"), "src", "size"))


def _salted(ranked: DataFrame, salts: int) -> DataFrame:
    return ranked.withColumn("salt", F.pmod(F.shiftright("rank", 32), F.lit(salts)).cast("int"))


def _decided(
    docs: DataFrame, weights: Sequence[float], share: float, cap: float, seed: int, salts: int | None, id_col: str, text_col: str, source_col: str
) -> tuple[DataFrame, int]:
    """Per document: id, src, size, rank, salt, source_size, target, whole (copies that all of its source have) and more (whether it is
    taken once more); and the number of salts. Of a source's length those come first whose (salt, rank, id) is least."""
    spark = docs.sparkSession
    sized = docs.select(
        F.col(id_col).alias("id"),
        _named_source(source_col).alias("src"),
        n_words(text_of(text_col)).alias("size"),
    )
    # the words are counted once; what follows reads (id, source, size) rows
    sized = _ranked(materialise(sized, "mix-sizes"), seed)
    if salts is None:
        salts = max(16, -(-sized.count() // SALT_ROWS))
    sized = _salted(sized, salts)
    counts = sized.groupBy("src", "size", "salt").agg(F.count("*").alias("n"))

    totals = counts.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("words"))
    found = sorted(totals.limit(MAX_SOURCES + 1).collect(), key=lambda r: (r["src"] == "n", r["src"].encode()))
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = [int(r["words"] or 0) for r in found]
    by_weight = [float(weights[i % len(weights)]) for i in range(len(found))]
    targets = water_fill(sizes, by_weight, share * sum(sizes), cap)
    plan = spark.createDataFrame(
        [(r["src"], s, t, int(t // s) if s else 0, int(t - (t // s) * s) if s else 0) for r, s, t in zip(found, sizes, targets)],
        "src string, source_size long, target double, whole long, rest long",
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        pdf["quota"] = fit_budget(pdf["size"].to_numpy(), pdf["n"].to_numpy(), int(pdf["rest"].iloc[0]))
        return pdf[["src", "size", "source_size", "target", "whole", "quota"]]

    lengths = counts.groupBy("src", "size").agg(F.sum("n").alias("n")).join(F.broadcast(plan), "src")
    fitted = lengths.groupBy("src").applyInPandas(fit, "src string, size long, source_size long, target double, whole long, quota long")
    before = Window.partitionBy("src", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    quotas = (
        counts.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(fitted, ["src", "size"])
        .select(
            "src", "size", "salt", "source_size", "target", "whole",
            F.least("n", F.greatest(F.lit(0), F.col("quota") - F.col("earlier"))).alias("quota")
        )
    )
    place = Window.partitionBy("src", "size", "salt").orderBy("rank", "id")
    decided = sized.withColumn("place", F.row_number().over(place)).join(quotas, ["src", "size", "salt"])
    return decided.withColumn("more", F.col("place") <= F.col("quota")), salts


def mix_to_weights(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 17,
    salts: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per document: id, source, size, source_size, target (of its source), copies, taken (= copies * size).

    Sources by code point, null last, take the weights in turn. All targets together are `share` of all words;
    none exceeds `cap` times its source."""
    decided, _ = _decided(docs, weights, share, cap, seed, salts, id_col, text_col, source_col)
    return decided.withColumn("copies", F.col("whole") + F.col("more").cast("long")).select(
        F.col("id").alias(id_col),
        F.when(F.col("src") != "n", F.expr("substr(src, 2)")).alias(source_col),
        "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 17,
    salts: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: the rows that it takes, with the input's columns and `copies`, how often each is taken.

    The texts stay where they are: of each length of a source those rows are taken once more that come up to its last one, and
    that is a row for each length. Rows with the same id, source and size are one place in that order; where it ends among such
    rows, they are told apart by their text's hash, and which of them counts as which is all the same to the mix."""
    spark = docs.sparkSession
    with scratch(spark) as tables:
        decided, salts = _decided(docs, weights, share, cap, seed, salts, id_col, text_col, source_col)
        places = decided.groupBy("src", "size", "salt", "rank", "id").agg(
            F.max("whole").alias("whole"), F.count("*").alias("alike"), F.count_if("more").alias("upto")
        )
        last = F.struct(F.struct("salt", "rank", "id").alias("at"), "upto", "alike")
        lengths = places.groupBy("src", "size").agg(F.max("whole").alias("whole"), F.max(F.when(F.col("upto") > 0, last)).alias("last"))
        lengths = tables.result(lengths.withColumnsRenamed({"src": "_src", "size": "_size"}), "mix-lengths")
    few = lengths.count() <= BROADCAST_LENGTHS
    whole_row = F.struct(*[F.col(c) for c in docs.columns])
    own = docs.select(
        whole_row.alias("row"), F.xxhash64(text_col).alias("hash"),
        F.col(id_col).alias("id"), _named_source(source_col).alias("src"), n_words(text_of(text_col)).alias("size"),
    )
    own = _salted(_ranked(own, seed), salts).withColumn("at", F.struct("salt", "rank", "id"))
    same = (F.col("src") == F.col("_src")) & (F.col("size") == F.col("_size"))
    own = own.join(F.broadcast(lengths) if few else lengths, same)
    within = F.col("at") < F.col("last.at")
    among = F.col("at") == F.col("last.at")
    split = F.coalesce(among & (F.col("last.upto") < F.col("last.alike")), F.lit(False))
    out = own.withColumn("more", F.coalesce(within | among, F.lit(False)))
    if not lengths.filter("last.upto < last.alike").isEmpty():
        place = F.row_number().over(Window.partitionBy("src", "size").orderBy("hash"))
        tied = own.filter(split).withColumn("more", place > F.col("last.alike") - F.col("last.upto"))
        out = out.filter(~split).unionByName(tied)
    return out.withColumn("copies", F.col("whole") + F.col("more").cast("long")).filter("copies > 0").select("row.*", "copies")
