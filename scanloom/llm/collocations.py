"""Collocations of each language, by best-first growth of phrases under admissible bounds.

Within pieces (texts cut at punctuation and line ends), a phrase of 2 to MAX_WORDS words that occurs a >= LEAST times is a
candidate. Cut after k words into parts that occur l and r times it scores floor(1000 * a * n / (l * r)), n being the
language's words; its lowest-scoring cut counts. A candidate that stands in a longer one as frequent as itself is
dropped. The result is each language's first TOP by score, a, phrase.

Search: a phrase occurs at most as often as its part after any cut, so that its score is at most 1000 * n / f of its first
word: the bound. First words are expanded best bound (rarest) first, in bands. A band's phrases grow from their prefixes:
first the pairs of words that are frequent, then what starts with these. When a language has TOP survivors, first words whose
bound is below the TOP-th score can't matter any more; those that can, ties included, are expanded, and the language is
settled when none is left. Parts that start with another word, which no band may have reached, are counted by name.

That a longer candidate is as frequent means that a word beside all occurrences of the phrase is the same one, so each
phrase's count travels with the lowest and highest hash of its left and right neighbours; phrases of MAX_WORDS can't be dropped.

Data flow: passes over the texts with arrays in Arrow batches, each followed by an aggregation with map-side combine. What a
pass looks for is broadcast as a bitmap of hashes, of fixed size (8 MB); other phrases that hit a bit cost rows, not exactness,
as counts are grouped by the phrase itself. Counts, states and survivors are tables in the shared folder. Products are decimals
of 38 digits: exact up to 10^17 words.

Cases: a null text is empty; a null language is `und`, together with texts of that language; texts without words add nothing; very
long texts are read whole; equal rows count each; ties go by a, then phrase in byte order; an empty table gives an empty
result; other columns aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scanloom.llm.common import materialise, text_of
from scanloom.llm.tokens import Words, mix, not_of, steps, words

LEAST = 100
MAX_WORDS = 5
TOP = 2000
#: Bits of a bitmap's index.
BITS = 26
#: A band reaches up to so many times the frequency of the one before it.
WIDER = 64
#: Above all frequencies.
FAR = (1 << 63) - 1
ENDS = b".,;:!?\n\x0b\x0c\r"
_IS_END = ~not_of(ENDS)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bytes with a bit for each value of the column `key`: its upper BITS."""
    place = F.shiftrightunsigned("key", 64 - BITS)
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    found = keys.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint8)


def hit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - BITS)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


@dataclass
class Step:
    """Some texts' words. key: hash of language and word; piece: equal for words of one piece; tongue: place in `langs`."""

    w: Words
    key: np.ndarray
    piece: np.ndarray
    tongue: np.ndarray
    langs: list[str]

    def fits(self, k: int, at: np.ndarray) -> np.ndarray:
        """Of places `at`, those where k words of one piece start."""
        at = at[at + k <= len(self.piece)]
        return at[self.piece[at + k - 1] == self.piece[at]]

    def keys(self, k: int, at: np.ndarray) -> np.ndarray:
        """Hashes of language and k words from each place."""
        out = self.key[at]
        for j in range(1, k):
            out = mix(out * _ODD + self.w.hashes[at + j])
        return out

    def phrases(self, k: int, at: np.ndarray) -> pa.Array:
        """k words from each place, with one space between them."""
        word = (at[:, None] + np.arange(k)).reshape(-1)
        size = self.w.end[word] - self.w.first[word]
        stops = np.cumsum(size + 1)
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out = np.full(len(word) + len(within), 32, np.uint8)
        out[np.repeat(stops - size - 1, size) + within] = self.w.data[np.repeat(self.w.first[word], size) + within]
        # the space after each phrase's last word goes
        last = stops[k - 1 :: k] - 1
        ends = np.concatenate(([0], last + 1 - np.arange(1, len(at) + 1)))
        kept = np.delete(out, last).tobytes()
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(kept)]).cast(pa.string())


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Step]:
    """Batches of (lang, text) as steps."""
    for batch in batches:
        for at, texts in steps(batch.column("text")):
            w = words(texts, not_of(b" \t" + ENDS))
            langs, tongue = np.unique(np.array(batch.column("lang").slice(at, len(texts)).to_pylist(), object), return_inverse=True)
            salt = np.array([int.from_bytes(hashlib.md5(x.encode()).digest()[:8], "big") for x in langs], np.uint64)
            of = np.repeat(tongue, np.diff(w.bounds))
            piece = np.cumsum(_IS_END[w.data])[w.first] + w.text_of_word if len(w.first) else w.first
            yield Step(w, mix(w.hashes ^ salt[of]), piece, of, list(langs))


def grouped(step: Step, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of k words that start at `at`: (order that brings equal ones together, first of each, counts)."""
    keys = step.keys(k, at)
    order = np.argsort(keys)
    first = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])) if len(at) else np.zeros(0, np.int64)
    return order, first, np.diff(np.append(first, len(at)))


def long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def over(docs: DataFrame, shape: str, each: Callable[[Step], Iterator[pa.RecordBatch]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in read(batches):
            if len(step.key):
                yield from each(step)

    return docs.mapInArrow(run, shape)


def named(step: Step, k: int, at: np.ndarray, more: dict[str, pa.Array]) -> pa.RecordBatch:
    langs = pa.array(step.langs, pa.string()).take(pa.array(step.tongue[at]))
    columns = {"lang": langs, "phrase": step.phrases(k, at)} | more
    return pa.record_batch(list(columns.values()), names=list(columns))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, key, f) of all words."""

    def each(step: Step) -> Iterator[pa.RecordBatch]:
        order, first, counts = grouped(step, 1, np.arange(len(step.key)))
        at = order[first]
        yield named(step, 1, at, {"key": long(step.key[at]), "f": long(counts)})

    return over(docs, "lang string, phrase string, key long, f long", each).groupBy("lang", "phrase", "key").agg(F.sum("f").alias("f"))


def pair_keys(docs: DataFrame, frequent, seeds, least: int) -> DataFrame:
    """(key) of pairs of frequent words, the first of the band, that are counted `least` times or more. By hash alone: two pairs of
    one hash count together, which lets more through, not less."""

    def each(step: Step) -> Iterator[pa.RecordBatch]:
        at = step.fits(2, np.flatnonzero(hit(seeds.value, step.key)))
        at = at[hit(frequent.value, step.key[at + 1])]
        order, first, counts = grouped(step, 2, at)
        yield pa.record_batch([long(step.keys(2, at[order[first]])), long(counts)], names=["key", "f"])

    return over(docs, "key long, f long", each).groupBy("key").agg(F.sum("f").alias("f")).filter(F.col("f") >= least).select("key")


SIDES = ("left_low", "left_high", "right_low", "right_high")


def grown(docs: DataFrame, frequent, seeds, pairs, least: int, max_words: int) -> DataFrame:
    """(lang, phrase, size, a, inside) of phrases that start with such a pair and occur `least` times or more; inside: whether a word
    beside all its occurrences is the same."""

    def each(step: Step) -> Iterator[pa.RecordBatch]:
        at = step.fits(2, np.flatnonzero(hit(seeds.value, step.key)))
        at = at[hit(pairs.value, step.keys(2, at))]
        for k in range(2, max_words + 1):
            at = step.fits(k, at)
            at = at[hit(frequent.value, step.key[at + k - 1])]
            order, first, counts = grouped(step, k, at)
            if not len(first):
                break
            more = {"size": pa.array(np.full(len(first), k, np.int32)), "a": long(counts)}
            i = at[order]
            for side, by in (("left", -1), ("right", k)):
                there = np.clip(i + by, 0, len(step.key) - 1)
                beside = step.w.hashes[there].view(np.int64)
                edge = (step.piece[there] != step.piece[i]) | (there != i + by)
                more[f"{side}_low"] = long(np.minimum.reduceat(np.where(edge, -FAR, beside), first))
                more[f"{side}_high"] = long(np.maximum.reduceat(np.where(edge, FAR, beside), first))
            yield named(step, k, i[first], more)

    kinds = "lang string, phrase string, size int, a long, left_low long, left_high long, right_low long, right_high long"
    ends = [(F.min if s.endswith("low") else F.max)(s).alias(s) for s in SIDES]
    out = over(docs, kinds, each).groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a"), *ends).filter(F.col("a") >= least)
    inside = (F.col("left_low") == F.col("left_high")) | (F.col("right_low") == F.col("right_high"))
    return out.select("lang", "phrase", "size", "a", (inside & (F.col("size") < max_words)).alias("inside"))


def with_keys(phrases: DataFrame) -> DataFrame:
    """(lang, phrase) with the key that `Step.keys` gives it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            step = next(read([pa.record_batch([batch.column("lang"), batch.column("phrase")], names=["lang", "text"])]), None)
            size = np.diff(step.w.bounds) if step else []
            for k in np.unique(size):
                rows = np.flatnonzero(size == k)
                out[rows] = step.keys(int(k), step.w.bounds[:-1][rows])
            yield pa.record_batch([*batch.select(["lang", "phrase"]).columns, long(out)], names=["lang", "phrase", "key"])

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # a batch is one step
            for at, part in steps(batch.column("phrase")):
                yield from each([batch.slice(at, len(part))])

    return phrases.select("lang", "phrase").mapInArrow(small, "lang string, phrase string, key long")


def named_counts(docs: DataFrame, wanted: DataFrame, max_words: int) -> DataFrame:
    """(lang, phrase, f) of the phrases of 2 words and more in wanted (lang, phrase), fewer than max_words."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(bitmap(with_keys(wanted)))

    def each(step: Step) -> Iterator[pa.RecordBatch]:
        every = np.arange(len(step.key))
        for k in range(2, max_words):
            every = step.fits(k, every)
            at = every[hit(bits.value, step.keys(k, every))]
            order, first, counts = grouped(step, k, at)
            if len(first):
                yield named(step, k, at[order[first]], {"f": long(counts)})

    counted = over(docs, "lang string, phrase string, f long", each).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    out = materialise(counted.join(wanted, ["lang", "phrase"], "left_semi"), "collocation-named")
    bits.destroy()
    return out


def join_words(c: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(c, start, length), " ")


def cuts_of(candidates: DataFrame) -> DataFrame:
    """A row for each cut: its place k and the two parts."""
    out = candidates.withColumn("ws", F.split("phrase", " ")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    k, n = F.col("k"), F.col("size")
    return out.withColumns({"head": join_words(F.col("ws"), F.lit(1), k), "tail": join_words(F.col("ws"), k + 1, n - k)}).drop("ws")


def scored(cuts: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) by the lowest-scoring cut. counts: (lang, phrase, f) of all parts."""
    part = lambda name, out: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(out))
    rows = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(totals, "lang")
    wide = "cast(%s AS decimal(17, 0))"
    score = F.expr(f"cast(1000 AS decimal(4, 0)) * {wide % 'a'} * {wide % 'n'} div ({wide % 'l'} * {wide % 'r'})").cast("long")
    low = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    return rows.groupBy("lang", "phrase", "a", "n").agg(low).select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")


def first_of_each(scores: DataFrame, top: int) -> DataFrame:
    """With `rank`: each language's first `top`. In two steps, so that no task sees all of a language."""
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = F.pmod(F.xxhash64("phrase"), F.lit(int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    some = scores.withColumn("part", parts).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*by)))
    some = some.filter(F.col("rank") <= top).drop("part")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).filter(F.col("rank") <= top)


def frontier(words_: DataFrame, state: DataFrame) -> DataFrame:
    """Languages that aren't settled: (lang, n, reach, next): first words up to a frequency of `reach` are expanded, those up to
    `next` are to be. state: (lang, n, reach, floor), floor being the score that still counts (0: any)."""
    rest = words_.join(state, "lang").filter(F.col("f") > F.col("reach")).filter(F.expr("floor = 0 OR cast(f AS decimal(17, 0)) * floor <= cast(1000 AS decimal(4, 0)) * n"))
    wide = F.when(F.col("reach") > FAR // WIDER, F.lit(FAR)).otherwise(F.col("reach") * WIDER)
    out = rest.groupBy("lang", "n", "reach").agg(F.min("f").alias("low"), F.max("f").alias("high"))
    return out.select("lang", "n", "reach", F.least("high", F.greatest(wide, "low")).alias("next"))


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, max_words: int = MAX_WORDS, top: int = TOP
) -> DataFrame:
    """Per language its first `top`: lang, rank (from 1), phrase, a, l, r, n, score."""
    spark: SparkSession = docs.sparkSession
    sc = spark.sparkContext
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    every = materialise(word_counts(docs), "collocation-words")
    totals = materialise(every.groupBy("lang").agg(F.sum("f").alias("n")), "collocation-totals")
    words_ = materialise(every.filter(F.col("f") >= least), "collocation-frequent")
    frequent = sc.broadcast(bitmap(words_))
    counts = words_.select("lang", "phrase", "f")
    scores = spark.createDataFrame([], "lang string, phrase string, a long, l long, r long, n long, score long")
    state = totals.select("lang", "n", F.lit(least // 2).cast("long").alias("reach"), F.lit(0).cast("long").alias("floor"))
    while not (todo := materialise(frontier(words_, state), "collocation-frontier")).isEmpty():
        band = words_.join(todo, "lang").filter("f > reach AND f <= next")
        seeds = sc.broadcast(bitmap(band))
        pairs = sc.broadcast(bitmap(pair_keys(docs, frequent, seeds, least)))
        found = grown(docs, frequent, seeds, pairs, least, max_words)
        # bits that other words hit let phrases of other bands through
        first = F.split("phrase", " ")[0]
        own = band.select("lang", F.col("phrase").alias("first"))
        found = materialise(found.withColumn("first", first).join(own, ["lang", "first"], "left_semi").drop("first"), "collocation-grown")
        counts = counts.unionByName(found.select("lang", "phrase", F.col("a").alias("f")))
        cuts = materialise(cuts_of(found.filter("NOT inside")), "collocation-cuts")
        tails = cuts.filter("size - k > 1").select("lang", F.col("tail").alias("phrase")).distinct()
        tails = materialise(tails.join(counts, ["lang", "phrase"], "left_anti"), "collocation-tails")
        counts = materialise(counts.unionByName(named_counts(docs, tails, max_words)).distinct(), "collocation-counts")
        scores = materialise(scores.unionByName(scored(cuts, counts, totals)), "collocation-scores")
        best = first_of_each(scores, top).filter(F.col("rank") == top).select("lang", F.col("score").alias("floor"))
        reached = todo.select("lang", F.col("next").alias("reach"))
        state = state.drop("floor").withColumnRenamed("reach", "before").join(reached, "lang", "left").join(best, "lang", "left")
        state = state.select("lang", "n", F.coalesce("reach", "before").alias("reach"), F.coalesce("floor", F.lit(0)).alias("floor"))
        state = materialise(state, "collocation-state")
        seeds.destroy()
        pairs.destroy()
    frequent.destroy()
    return first_of_each(scores, top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: All phrases counted, whatever their bounds.
ORACLE = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k)) GROUP BY ALL
), n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang
), c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE k > 1 AND f >= 100
), cut AS (SELECT *, unnest(range(1, k)) AS cut FROM c
), s AS (
  SELECT cut.lang, cut.phrase, a, cut.k, n, cut, x.f AS l, y.f AS r, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut JOIN n ON n.lang = cut.lang
  JOIN g x ON x.lang = cut.lang AND x.phrase = array_to_string(ws[1:cut], ' ')
  JOIN g y ON y.lang = cut.lang AND y.phrase = array_to_string(ws[cut + 1:], ' ')
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), kept AS (
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.lang = b.lang AND c.k > b.k AND c.a >= b.a AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')
  )
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
