"""Quality rules as a short-circuit cascade of Column expressions.

Each rule is a predicate that rejects. On a sample every rule's cost and selectivity are estimated; the cascade then runs the
rules by rejections per cost, most first, inside one CASE expression, so that a row leaves at its first failing rule and
the dear rules see what the cheap ones kept. The verdict is the conjunction of all rules and doesn't depend on the order; only the
name of the first failing rule does.

Everything is built-in functions; no Python runs on the executors and no shuffle is needed beside the sample's.

Cases: a null text counts as empty (no words); the empty text fails the rule on the fewest words; very long texts are judged
whole; repeated rows are judged each on its own; an empty table gives an empty result; other columns of the input, whatever
their names, are passed on by keep_quality and not read.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import BLANK, n_words, text_of

#: Rows of the sample on which costs and selectivities are estimated. It never decides on a row.
SAMPLE_ROWS = 2_000
#: Bits of a window's place: 16 million words in a text; of longer texts, as many as an array can hold.
PLACE_BITS = 24
LONG_PLACE_BITS = 31


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.regexp_replace(text, rf"[{BLANK}]+", "")).cast("long")


def n_symbols(text: Column) -> Column:
    """Characters of #*$%&|<>."""
    return (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(rf"[^{BLANK}]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(text: Column, width: int = 3) -> Column:
    """Words inside windows of `width` words that occur twice or more in the text.

    A window is one long, the upper bits of its hash and its place below them, so that sorting is that of plain numbers and
    equal windows are neighbours; neighbours with equal hashes are compared word by word. The gaps between the repeated
    places, each at most `width`, add up to the words covered: n log n per text, whatever repeats."""

    def bound(value: Column, body) -> Column:
        # transform over one element: evaluates `value` once and lets `body` use it many times.
        return F.element_at(F.transform(F.array(value), body), 1)

    def places(w: Column) -> Column:
        def covered(h: Column, bits: int) -> Column:
            low = F.lit((1 << bits) - 1).cast("long")
            window = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])
            packed = F.transform(
                F.sequence(F.lit(0), F.size(h) - width), lambda i: window(i).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))
            )

            def same(x: Column, y: Column) -> Column:
                # null beside the first and the last
                equal = x.bitwiseXOR(y) <= low
                equal &= x.bitwiseXOR(y) >= 0
                for k in range(width):
                    equal &= F.get(w, x.bitwiseAND(low).cast("int") + k) == F.get(w, y.bitwiseAND(low).cast("int") + k)
                return F.coalesce(equal, F.lit(False))

            repeated = bound(
                F.sort_array(packed), lambda s: F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
            )
            return F.aggregate(
                F.sort_array(F.transform(repeated, lambda x: x.bitwiseAND(low))),
                F.struct(F.lit(-width).cast("long").alias("last"), F.lit(0).cast("long").alias("n")),
                lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(width).cast("long"), i - acc["last"])).alias("n")),
                lambda acc: acc["n"],
            )

        hashes = F.transform(w, lambda x: F.xxhash64(x))
        usual, long = bound(hashes, lambda h: covered(h, PLACE_BITS)), bound(hashes, lambda h: covered(h, LONG_PLACE_BITS))
        return F.when(F.size(w) > 1 << PLACE_BITS, long).when(F.size(w) > width, usual).otherwise(F.lit(0).cast("long"))

    words = F.split(F.trim(F.regexp_replace(text, rf"[{BLANK}]+", " ")), " ", -1)
    return bound(words, places).cast("long")


@dataclass(frozen=True)
class Rule:
    """`rejects` is true for texts that the rule turns away. It must not be null."""

    name: str
    rejects: Column


def counts_of(text: Column) -> dict[str, Column]:
    """What the rules look at, by name."""
    return {
        "n_words": n_words(text),
        "word_chars": word_chars(text),
        "n_symbols": n_symbols(text),
        "n_dup_lines": n_dup_lines(text),
        "n_repeat_words": n_repeat_words(text),
    }


def base_rules(c: dict[str, Column]) -> list[Rule]:
    """c: as counts_of, or columns that hold the counts."""
    return [
        Rule("few_words", c["n_words"] < 50),
        Rule("repeated_windows", 100 * c["n_repeat_words"] > 50 * c["n_words"]),
    ]


def further_rules(c: dict[str, Column], text: Column) -> list[Rule]:
    """Rules beside the base: wide bounds that ordinary prose in any language stays within."""
    n, chars = c["n_words"], c["word_chars"]
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return [
        Rule("symbols", 2 * c["n_symbols"] > n),
        Rule("word_length", (chars < 2 * n) | (chars > 25 * n)),
        Rule("repeated_lines", 2 * c["n_dup_lines"] > F.size(F.split(text, "\n", -1))),
        Rule("no_letters", 2 * letters < chars),
    ]


def order_rules(texts: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per cost, most first. texts: all columns that the rules read, among them `text`.

    Both are estimated on the rows with the lowest hash of their text. A rule's cost is the least of three timings on the
    cached sample less that of a job which only reads it, in powers of two, as finer differences are noise; the name decides ties."""
    if len(rules) < 2:
        return rules
    sample = texts.orderBy(F.xxhash64("text")).limit(sample_rows).coalesce(1).persist()
    try:
        rows = sample.count()
        if not rows:
            return rules

        def timed(cond: Column) -> tuple[float, int]:
            job, took = sample.agg(F.count_if(cond).alias("hits")), []
            for _ in range(3):
                began = time.perf_counter()
                hits = job.collect()[0]["hits"]
                took.append(time.perf_counter() - began)
            return min(took), hits

        empty, _ = timed(F.length("text") < 0)
        scored = []
        for rule in rules:
            took, rejected = timed(rule.rejects)
            cost = 2.0 ** round(math.log2(max(took - empty, empty / 16)))
            scored.append((-(rejected + 1) / (rows + 2) / cost, rule.name, rule))
        return [rule for _, _, rule in sorted(scored, key=lambda x: x[:2])]
    finally:
        sample.unpersist()


def first_failing(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, else null; later rules are not evaluated."""
    chain = F
    for rule in rules:
        chain = chain.when(rule.rejects, F.lit(rule.name))
    return chain.otherwise(F.lit(None).cast("string"))


def all_rules(text: Column) -> list[Rule]:
    c = counts_of(text)
    return base_rules(c) + further_rules(c, text)


def ordered_rules(docs: DataFrame, text_col: str, rules: list[Rule] | None) -> list[Rule]:
    """Rules over the column `text_col` of docs, ordered on a sample of them."""
    texts = docs.select(text_of(text_col).alias("text"))
    by_name = {r.name: r for r in (all_rules(text_of(text_col)) if rules is None else rules)}
    if rules is None:
        return [by_name[r.name] for r in order_rules(texts, all_rules(F.col("text")))]
    return order_rules(docs.withColumn("text", text_of(text_col)), rules)


def quality_cascade(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None, out: str = "failed_rule") -> DataFrame:
    """The input with `out`: the rule that turned the row away, null for rows to keep. rules: over columns of docs."""
    return docs.withColumn(out, first_failing(ordered_rules(docs, text_col, rules)))


def keep_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, with the input's columns."""
    return docs.filter(first_failing(ordered_rules(docs, text_col, None)).isNull())


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the base counts, base_failed and the verdict. The counts are computed once, and all rules read them."""
    texts = docs.select(F.col(id_col).alias(id_col), text_of(text_col).alias("text"))
    counted = texts.select(id_col, "text", *[c.alias(n) for n, c in counts_of(F.col("text")).items()])
    held = {n: F.col(n) for n in counts_of(F.col("text"))}
    # ordered on the sampled texts, before anything is counted, so that a rule costs what it costs from the text on
    order = order_rules(texts.select("text"), further_rules(counts_of(F.col("text")), F.col("text")))
    by_name = {r.name: r for r in further_rules(held, F.col("text"))}
    rules = [by_name[r.name] for r in order]
    base = base_rules(held)
    failed = base[0].rejects | base[1].rejects
    return counted.select(
        id_col, *held, failed.alias("base_failed"), F.when(failed, F.lit(False)).otherwise(first_failing(rules).isNull()).alias("kept")
    )
