"""Line dedup by a segment-partition edit join (Li et al. 2011, Pass-Join).

Two lines within `edits` edits share one of `edits` + 1 segments unchanged, at a place that differs by at most the
edits around it. Each distinct line therefore owns one key for each of its segments (length, segment, text), and
probes the keys that lines as long or up to `edits` shorter would own. Lines that meet are compared by banded
bit-parallel edit distance; classes are the connected components of the links.

Data flow: exact copies meet first, aggregated map-side to one row (digest, line, copies) each, so that a line which
a third of all documents share is one row from there on; one join on the key follows. All lines of a block are compared
with one of them, then all pairs that are still in different classes, in cells of bounded size (blocks.py). With one edit, a block of very many lines is first split again by the same rule on
what the shared segment leaves of the lines, which halves it each round; that finds the same links. Pairs, links and
classes are tables in the shared folder, and go as soon as what follows from them is written.

Every line whose class occurs more than once is reported, with its class and the class's number of copies. A class with
a line of more than `long_words` words keeps only its first line, by (document id, place), from the second copy on; one
of shorter lines does if it occurs more than `max_copies` times, as boilerplate. Two lines of at least 200 characters are
the same up to two edits. Lines of fewer than `min_chars` characters are the same if they are equal; they are reported,
but stay, as short answers and closing brackets repeat without being copies. Lines without a word are no lines here.

Cases: a null text is empty and has one empty line; a document that loses all lines with a word keeps its row, with what
is left; very long lines are compared whole; rows are told apart by id and text, so that rows with one id and different texts keep
their own lines; equal rows share their fate; rows without id come last where the first line of a class is chosen; an empty table gives an empty result; columns of the input are passed on as they are, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm import blocks
from scanloom.llm.common import WORD, materialise, n_words, scratch, text_of
from scanloom.llm.components import components

MIN_CHARS = 16
MAX_COPIES = 6
LONG_WORDS = 50
#: (least characters of both lines, edits): from there on more edits than by default count as the same.
LONGER = ((200, 2),)


def segment_keys(line: Column, n: Column, edits: int, under: Column | None = None) -> list[tuple[Column, bool, Column, Column]]:
    """For each key of a line of n characters: (key or null, whether the line owns it, start and length of the
    segment that it is made of)."""
    out = []
    for short in range(edits + 1):
        m = n - short
        for i in range(1, edits + 2):
            start, stop = F.floor((i - 1) * m / (edits + 1)).cast("int"), F.floor(i * m / (edits + 1)).cast("int")
            lowest, highest = max(-(i - 1), short - (edits + 1 - i)), min(i - 1, short + (edits + 1 - i))
            for shift in range(lowest, highest + 1):
                at, size = start + shift, stop - start
                fits = (m > 0) & (at >= 0) & (at + size <= n)
                parts = [m, F.lit(i), F.substring(line, at + 1, size)]
                key = F.xxhash64(*([under] if under is not None else []), *parts)
                out.append((F.when(fits, key), short == 0 and shift == 0, at, size))
    return out


def row_of(text_col: str) -> Column:
    """What tells rows with one id apart: a hash of the text."""
    return F.xxhash64(text_of(text_col))


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, pos, line, digest, n) of lines with a word; id and row tell a row of docs."""
    held = docs.select(F.col(id_col).alias("id"), row_of(text_col).alias("row"), text_of(text_col).alias("text"))
    lines = held.select("id", "row", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.filter(F.col("line").rlike(WORD)).withColumn("n", F.length("line"))
    return lines.withColumn("digest", F.unhex(F.md5(F.col("line").cast("binary"))))


def words_of(line: Column) -> Column:
    """Number of words where there may be more than LONG_WORDS, else 0: n characters hold (n + 1) / 2 words at most."""
    return F.when(F.length(line) >= 2 * LONG_WORDS, n_words(line)).otherwise(F.lit(0).cast("long"))


def distinct_lines(lines: DataFrame) -> DataFrame:
    """(digest, line, n, copies, words). The words of a line without a copy only matter if it is linked, and are left to `line_links`."""
    # the line is a part of the key, as aggregations sort if they have to keep a string beside it
    held = lines.groupBy("digest", "line").agg(F.count("*").alias("copies")).withColumn("n", F.length("line"))
    return held.withColumn("words", F.when(F.col("copies") > 1, words_of(F.col("line"))).otherwise(F.lit(0).cast("long")))


def _halves(large: DataFrame) -> DataFrame:
    """Keys within blocks for one edit. large: (key, node, rest), rest being what the block's keys leave of the
    line. Gives (key, node, owns, rest, last): last where the block can't be split further."""
    rest, n = F.col("rest"), F.length("rest")
    made = [
        F.struct(F.when(n - short > 1, key).alias("key"), F.lit(owns).alias("owns"), left.alias("rest"), F.lit(False).alias("last"))
        for (key, owns, at, size), short, left in zip(
            segment_keys(rest, n, 1, F.col("key")),
            (0, 0, 1, 1),
            # the first segment leaves what follows it, the second what precedes it
            [
                F.substring(rest, at + size + 1, n) if i % 2 == 0 else F.substring(rest, F.lit(1), at) for i,
                (_, _, at, size) in enumerate(segment_keys(rest, n, 1))
            ],
        )
    ]
    end = lambda cond, owns, *parts: F.struct(F.when(cond, F.xxhash64("key", *parts)).alias("key"), F.lit(owns).alias("owns"), F.lit("").alias("rest"), F.lit(True).alias("last"))
    made += [
        end(n <= 1, True, F.lit("one")),
        end(n == 1, True, F.lit("two"), rest),
        end(n == 2, False, F.lit("two"), F.substring(rest, 1, 1)),
        end((n == 2) & (F.substring(rest, 1, 1) != F.substring(rest, 2, 1)), False, F.lit("two"), F.substring(rest, 2, 1)),
    ]
    return large.select("node", F.explode(F.array(*made)).alias("x")).select("node", "x.*").filter("key IS NOT NULL")


def line_links(distinct: DataFrame, edits: int, split_rows: int = blocks.SPLIT_ROWS) -> DataFrame:
    """(a, b, words): digests of different lines, with the classes that all links within `edits` give, and the most words of a line
    of the class. distinct: (digest, line, n).

    Keys are made once and kept as numbers; what follows reads lines of blocks of two and more only."""
    with scratch(distinct.sparkSession) as tables:
        keys = segment_keys(F.col("line"), F.col("n"), edits)
        numbers = distinct.select(F.col("digest").alias("node"), *[key.alias(f"k{j}") for j, (key, _, _, _) in enumerate(keys)])
        each = [F.struct(F.col(f"k{j}").alias("key"), F.lit(owns).alias("owns"), F.lit(j).alias("j")) for j, (_, owns, _, _) in enumerate(keys)]
        with scratch(distinct.sparkSession) as inner:
            numbers = materialise(numbers, "line-keys")
            rows = numbers.select("node", F.explode(F.array(*each)).alias("x")).select("node", "x.*").filter("key IS NOT NULL")
            first = inner.result(blocks.sized(rows), "line-blocks")
        needed = materialise(first.select(F.col("node").alias("digest")).distinct(), "line-needed")
        texts = distinct.select("digest", "line").join(_few(needed), "digest", "left_semi")
        texts = materialise(texts.withColumn("words", words_of(F.col("line"))), "line-texts")

        held = first.select("key", "node", "owns", "n")
        huge = first.filter(F.col("n") > split_rows)
        if edits == 1 and not huge.isEmpty():
            held, text, n = held.filter(F.col("n") <= split_rows), F.col("line"), F.length("line")
            spans = F.array(*[F.struct(at.alias("at"), size.alias("size")) for _, _, at, size in segment_keys(text, n, 1)])
            at, size = F.get(spans, F.col("j"))["at"], F.get(spans, F.col("j"))["size"]
            rest = F.when(F.col("j") % 2 == 0, F.substring(text, at + size + 1, n)).otherwise(F.substring(text, F.lit(1), at))
            level = huge.join(texts.withColumnRenamed("digest", "node"), "node").select("key", "node", rest.alias("rest"))
            while not level.isEmpty():
                now = materialise(blocks.sized(_halves(level)), "line-halves")
                small = (F.col("n") <= split_rows) | F.col("last")
                held = held.unionByName(now.filter(small).select("key", "node", "owns", "n"))
                level = now.filter(~small).select("key", "node", "rest")
        held = materialise(blocks.with_middle(held.withColumn("part", F.lit(0))), "line-middles")
        items = texts.select(F.col("digest").alias("node"), F.encode("line", "UTF-32").alias("codes"))
        items = items.withColumns({"band": F.lit(0).cast("long"), "sketch": F.lit(None).cast("array<long>")})
        most = lambda longer, shorter: 0 * longer + edits
        links = materialise(blocks.aligned(materialise(blocks.star_pairs(held), "line-pairs"), items, most), "line-links")
        roots = blocks.classes(held, items, links, most)
        long = texts.filter("words > 0").select(F.col("digest").alias("node"), "words")
        longest = roots.join(long, "node").groupBy("root").agg(F.max("words").alias("words"))
        merged = roots.filter("node <> root").join(longest, "root", "left")
        words = F.coalesce("words", F.lit(0).cast("long")).alias("words")
        return tables.result(merged.select(F.col("node").alias("a"), F.col("root").alias("b"), words), "line-merged")


def _few(table: DataFrame) -> DataFrame:
    """The table, broadcast while it has few rows, so that the lines that it is joined to needn't be shuffled."""
    return F.broadcast(table) if table.count() <= blocks.BROADCAST_KEYS else table


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    edits: int = 1,
    min_chars: int = MIN_CHARS,
    max_copies: int = MAX_COPIES,
    long_words: int = LONG_WORDS,
) -> DataFrame:
    """Per document (id, row) with a repeated line: id, row, n_linked (its lines within `edits` of a different line),
    removed (places of the lines to remove, from 0, ascending) and repeated (place, class and number of copies of each line
    whose class occurs more than once; a class is named by the md5 of one of its lines)."""
    lines = occurrences(docs, id_col, text_col)
    with scratch(docs.sparkSession) as tables:
        distinct = materialise(distinct_lines(lines), "line-digests")
        # two lines of which the shorter has `least` characters and more are left to the larger number of edits
        longer = [(least, more) for least, more in LONGER if more > edits]
        links = line_links(distinct.filter(F.col("n").between(min_chars, min((x + edits for x, _ in longer), default=1 << 31))), edits)
        for i, (least, more) in enumerate(longer):
            upto = longer[i + 1][0] + more if i + 1 < len(longer) else 1 << 31
            links = links.unionByName(line_links(distinct.filter(F.col("n").between(max(least, min_chars), upto)), more))
        roots = materialise(components(links).withColumnRenamed("node", "digest"), "line-roots")

        # a line without a copy or a link is alone in its class
        classes = distinct.join(_few(roots), "digest", "left").filter("copies > 1 OR root IS NOT NULL").select(
            "digest", "copies", "words", "n", F.coalesce("root", "digest").alias("class"), F.col("root").isNotNull().alias("linked")
        )
        classes = materialise(classes, "line-classes")
        long = links.filter("words > 0").select(F.col("a").alias("digest"), "words").join(roots, "digest")
        each = classes.select("class", "copies", "words").unionAll(long.select("root", F.lit(0).cast("long"), "words"))
        totals = each.groupBy("class").agg(F.sum("copies").alias("total"), F.max("words").alias("longest"))
        totals = materialise(totals, "line-totals")
        often = F.col("total") > F.when(F.col("longest") > long_words, 1).otherwise(max_copies)
        often &= F.col("n") >= min_chars
        marks = classes.join(totals, "class").select("digest", "class", "linked", "total", often.alias("often"))
        marked = lines.select("id", "row", "pos", "digest").join(_few(materialise(marks, "line-marks")), "digest")
        marked = tables.result(marked, "line-marked")
    at = F.struct(F.col("id").isNull().alias("none"), "id", "row", "pos")
    first = marked.filter("often").groupBy("class").agg(F.min(at).alias("first"))
    decided = marked.join(materialise(first, "line-first"), "class", "left")
    gone = F.col("often") & F.col("first").isNotNull() & ~at.eqNullSafe(F.col("first"))
    place = F.struct("pos", F.lower(F.hex("class")).alias("class"), F.col("total").alias("copies"))
    places = lambda c: F.array_distinct(F.collect_list(c))
    return decided.groupBy("id", "row").agg(
        F.size(places(F.when(F.col("linked"), F.col("pos")))).cast("long").alias("n_linked"),
        F.array_sort(places(F.when(gone, F.col("pos")))).alias("removed"),
        F.array_sort(places(place)).alias("repeated"),
    ).withColumnRenamed("id", id_col)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: id, n_lines, n_linked, n_removed, removed, repeated."""
    found = repeated_lines(docs, id_col, text_col, **options)
    of = F.col("__line_doc").eqNullSafe(F.col(id_col)) & (F.col("__line_row") == F.col("row"))
    return (
        docs.select(
            F.col(id_col).alias("__line_doc"),
            row_of(text_col).alias("__line_row"),
            F.size(F.split(text_of(text_col), "\n", -1)).cast("long").alias("n_lines"),
        )
        .join(found, of, "left")
        .select(
            F.col("__line_doc").alias(id_col), "n_lines",
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
            F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
            F.coalesce("repeated", F.array().cast("array<struct<pos:int,class:string,copies:bigint>>")).alias("repeated"),
        )
    )


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input with repeated lines removed from the text; documents without any to remove are unchanged."""
    of, row, gone = (f"{name}_{uuid.uuid4().hex}" for name in ("of", "row", "gone"))  # names that no input has
    with scratch(docs.sparkSession) as tables:
        found = repeated_lines(docs, id_col, text_col, **options).filter(F.size("removed") > 0)
        found = found.select(F.col(id_col).alias(of), F.col("row").alias(row), F.col("removed").alias(gone))
        found = tables.result(found, "line-removed")
    kept = F.filter(F.split(F.col(text_col), "\n", -1), lambda x, i: ~F.array_contains(F.col(gone), i))
    text = F.when(F.col(gone).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text_col))
    same = F.col(id_col).eqNullSafe(F.col(of)) & (row_of(text_col) == F.col(row))
    return docs.join(found, same, "left").withColumn(text_col, text).drop(of, row, gone)
