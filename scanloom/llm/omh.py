"""Near-duplicate documents by Order MinHash (Marçais et al. 2019), verified by banded alignment.

A text's k-mers are its runs of five words without regard to case, each labelled with its occurrence number. A sample
ranks them by a seeded hash, takes the two lowest and keeps those in text order; two texts agree in a sample if both
k-mers and their order agree, so that moved passages count as differences, as they do for the edit distance. Texts that
agree in a sample are candidates. A candidate pair is a link if its word-level edit similarity, 1 - distance / words of
the longer, is at least 0.8, by a banded bit-parallel alignment of the whole texts. Classes are the connected components
of the links.

Data flow: one pass in Python gives each row's digest, sketch and word codes (32-bit hashes in text order); all that
follows works on distinct texts, so a text that a third of all rows share is one node. Samples are (hash, digest) rows.
Texts of a block are compared with one of them; then all pairs that are still in different classes are, in cells of bounded
size, with a bound on the words in common before the alignment (blocks.py). No block is passed over, and all blocks go the
same way: a pair that agrees in one sample ends in one class if it is similar, however large the block is. Pairs, links
and classes are tables in the shared folder, and go as soon as the classes are known.

With 60 samples, a pair with Jaccard similarity J of its k-mers is a candidate with a probability of about
1 - (1 - J^2)^60. Edits that are spread evenly over the text are the worst case: at an edit similarity of 0.80 that is
0.9, at 0.85 0.99. tests/llm/test_groups.py measures it against brute force.

Cases: a null text is empty; texts that are equal, empty ones included, share a class; texts of fewer than five
words have one k-mer of all their words; very long texts are aligned whole, in a band as wide as the similarity asks; rows
with a null id count, and a class is named by its smallest id (null if it has none); rows with one id are rows of their own, equal
ones stay together; an empty table
gives an empty result; columns beside id and text are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm import blocks
from scanloom.llm.common import materialise, scratch, text_of
from scanloom.llm.tokens import Words, mix, steps, words

K = 5
SAMPLES = 60
SIMILARITY = 0.8
#: K-mers whose arrays stay in a core's cache.
PIECE = 1 << 15
_ODD = np.random.default_rng(7).integers(0, 1 << 63, 64 + SAMPLES, dtype=np.uint64) | np.uint64(1)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def kmers(w: Words, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(hash, bounds): the k-mers of each text, with their occurrence label mixed in."""
    n = np.diff(w.bounds)
    place = w.place
    left = np.repeat(n, n) - place
    h = np.zeros(len(place), np.uint64)
    for j in range(k):
        at = w.hashes[j:] if j else w.hashes
        h[: len(at)] += np.where(left[: len(at)] > j, at, np.uint64(0)) * _ODD[40 + j]
    count = np.where(n > 0, np.maximum(n - k + 1, 1), 0)
    h = mix(h[place < np.repeat(count, n)])
    text = np.repeat(np.arange(len(n)), count)
    order = np.argsort(h ^ mix(text.astype(np.uint64), 3))
    tagged = h[order]
    twin = (tagged[1:] == tagged[:-1]) & (text[order[1:]] == text[order[:-1]])
    if twin.any():
        again = np.flatnonzero(np.isin(h, np.unique(tagged[1:][twin])))
        by = again[np.lexsort((again, h[again], text[again]))]
        fresh = np.ones(len(by), bool)
        fresh[1:] = (h[by[1:]] != h[by[:-1]]) | (text[by[1:]] != text[by[:-1]])
        start = np.flatnonzero(fresh)
        nth = np.arange(len(by)) - np.repeat(start, np.diff(np.append(start, len(by))))
        h[by] = np.where(nth > 0, mix(h[by] + nth.astype(np.uint64) * _ODD[50]), h[by])
    return h, np.concatenate(([0], np.cumsum(count)))


def sketches(w: Words, samples: int = SAMPLES) -> np.ndarray:
    """(texts, samples) of 64-bit values; texts without words get zeros. A k-mer's rank is the upper bits of a product with
    an odd number, which leaves the lower ones for its place."""
    h, bounds = kmers(w)
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(w), samples), np.int64)
    starts, at = bounds[:-1][full], 0
    while at < len(full):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + PIECE)))
        texts, lo = full[at:to], starts[at]
        x = h[lo : bounds[texts[-1] + 1]]
        place, first = np.arange(len(x), dtype=np.uint64), starts[at:to] - lo
        low = np.uint64((1 << len(x).bit_length()) - 1)
        for s in range(samples):
            rank = x * _ODD[64 + s % SAMPLES]
            if s >= SAMPLES:
                rank = mix(rank, s)
            rank = (rank & ~low) | place
            one = (np.minimum.reduceat(rank, first) & low).astype(np.int64)
            rank[one] = _NONE
            two = np.minimum.reduceat(rank, first)
            two = np.where(two == _NONE, one, (two & low).astype(np.int64))
            out[texts, s] = mix(x[np.minimum(one, two)] * _ODD[60] + mix(x[np.maximum(one, two)], 5)).view(np.int64)
        at = to
    return out


def most_edits(similarity: float) -> blocks.Most:
    return lambda longer, shorter: np.floor((1 - similarity) * longer + 1e-9)


def sketch_table(docs: DataFrame, id_col: str, text_col: str, samples: int) -> DataFrame:
    """(id, digest, words, sketch, codes) per row."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), digest_of(text).alias("digest"), F.lower(text).alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in steps(batch.column("text")):
                w, n = words(texts), len(texts)
                flat = pa.array(sketches(w, samples).reshape(-1))
                codes = w.hashes.astype(np.uint32)
                columns = {
                    "id": batch.column("id").slice(at, n),
                    "digest": batch.column("digest").slice(at, n),
                    "words": pa.array(np.diff(w.bounds), pa.int64()),
                    "sketch": pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * samples, pa.int32()), flat),
                    "codes": pa.array([codes[i:j].tobytes() for i, j in zip(w.bounds, w.bounds[1:])], pa.binary()),
                }
                yield pa.record_batch(list(columns.values()), names=list(columns))

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(sketch, f"id {kind}, digest binary, words long, sketch array<long>, codes binary")


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    samples: int = SAMPLES,
    **cells: int,
) -> DataFrame:
    """Per row: id, class_id (smallest id of its class), digest of the text (md5) and class_digest, which names the class whatever its
    ids. cells: sizes, as blocks.classes has them; they change the cost only."""
    rows = materialise(sketch_table(docs, id_col, text_col, samples), "omh-sketches")
    most = most_edits(similarity)

    with scratch(docs.sparkSession) as tables:
        nodes = rows.filter("words > 0").groupBy("digest").agg(F.any_value("sketch").alias("sketch"))
        agree = nodes.select(F.posexplode("sketch").alias("part", "value"), F.col("digest").alias("node"))
        agree = agree.select(F.xxhash64("part", "value").alias("key"), "part", "node", F.lit(True).alias("owns"))
        with scratch(docs.sparkSession) as inner:
            held = materialise(blocks.sized(agree), "omh-agree")
            held = inner.result(blocks.with_middle(held), "omh-blocks")

        met = held.select(F.col("node").alias("digest")).distinct()
        copies = rows.filter("words > 0").groupBy("digest")  # copies of a text come together before it travels
        items = copies.agg(*[F.any_value(c).alias(c) for c in ("words", "sketch", "codes")]).join(met, "digest", "left_semi")
        band = F.floor(F.log("words") / -math.log(min(similarity, 0.999)))
        items = materialise(items.select(F.col("digest").alias("node"), "codes", "sketch", band.alias("band")), "omh-items")

        links = blocks.aligned(materialise(blocks.star_pairs(held), "omh-pairs"), items, most)
        roots = blocks.classes(held, items, materialise(links, "omh-links"), most, 1 - similarity, **cells)

        lowest = rows.groupBy("digest").agg(F.min("id").alias("low")).join(roots.withColumnRenamed("node", "digest"), "digest", "left")
        lowest = lowest.withColumn("root", F.coalesce("root", "digest"))
        named = materialise(lowest.groupBy("root").agg(F.min("low").alias("class_id")), "omh-named")
        of = tables.result(lowest.join(named, "root").select("digest", "class_id", "root"), "omh-classes")
    name = lambda c: F.lower(F.hex(c))
    return rows.join(of, "digest").select(F.col("id").alias(id_col), "class_id", name("digest").alias("digest"), name("root").alias("class_digest"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input without near duplicates: of each class the row with the smallest id stays, rows without id coming last. Rows are told
    apart by id and text: one of several texts under one id may go while the others stay; rows equal in both stay together."""
    with scratch(docs.sparkSession) as tables:
        found = near_duplicates(docs, id_col, text_col)
        row = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "digest")
        kept = found.groupBy("class_digest").agg(F.min(row).alias("kept"))
        gone = found.select("class_digest", row.alias("row")).distinct().join(kept, "class_digest").filter(~F.col("row").eqNullSafe(F.col("kept")))
        gone = tables.result(gone.select(F.col("row.id").alias("__near_id"), F.unhex("row.digest").alias("__near_text")).distinct(), "omh-gone")
    # while these are few they are broadcast, so that the texts needn't be shuffled to drop some
    few = gone.count() <= blocks.BROADCAST_KEYS
    same = docs[id_col].eqNullSafe(gone["__near_id"]) & (digest_of(text_of(docs[text_col])) == gone["__near_text"])
    return docs.join(F.broadcast(gone) if few else gone, same, "left_anti")
