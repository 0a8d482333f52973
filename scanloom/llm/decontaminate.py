"""Benchmark decontamination: every training passage is a BM25 query against the benchmark items.

Passages are windows of `WIDTH` words that overlap by half, over whole documents. Items are cut into parts of at most
`PART` words, so that each part lies whole in some passage; the inverted index holds for each term its impact on each
part, as a share of the score that the part gives itself, so that one threshold serves items of all lengths. Document
frequencies and lengths are those of the whole benchmark, however it is cut into shards.

Search is block-max WAND. Parts are ordered by their rarest term and cut into blocks; per term the index keeps its largest
impact in each block where it has one. A first pass over all passages of a batch adds up block maxima of the essential
terms, those without which no part can reach the threshold, and drops passages without a block that could. Passages with few
such blocks are scored by arrays over the postings of these blocks; others are searched part by part: the terms' cursors stand in order of their parts; the pivot is the first at which the terms'
largest impacts add up to the threshold; if the maxima of the pivot's block don't, all cursors skip that block. All parts at or
above the threshold are retrieved, not a top k.

A retrieved item counts if `overlap` of its question's and of its answer's word runs stand in the document near the passage,
within the item's length. The question is the text up to the last question mark, else up to the last line or sentence break,
else all of it. Items of fewer than 8 words must stand there word for word.

Data flow: the index is made by Spark aggregations and collected in shards of `shard_items` texts, a few MB each; documents are
read once for as many shards as `INDEX_BYTES` allow, and no row of them is shuffled.

Cases: a null text or item is empty and never matches; items of fewer than `min_item_words` words are left out, as they are
everyday phrases; case is ignored; equal items all match; very long documents and items are searched whole; repeated documents
are judged each; empty tables give an empty result; only id and text are read, whatever else the tables have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import materialise, text_of
from scanloom.llm.tokens import mix, steps, words

WIDTH = 128
PART = 48
THRESHOLD = 0.6
OVERLAP = 0.6
RUN = 3
SHORT = 8
BLOCK = 4
#: Terms whose block maxima together stay below this are not essential.
SLACK = 0.2
K1, B = 1.2, 0.75
#: Terms times live blocks of a passage up to which it is scored by arrays.
ARRAY_WORK = 1 << 12
#: Shards that are searched in one pass over the documents, in bytes.
INDEX_BYTES = 256 << 20


def split_item(text: str) -> tuple[str, str]:
    """(question, answer) of an item."""
    at = text.rfind("?") + 1
    if not at:
        breaks = [m.end() for m in re.finditer(r"\n|[.!?]\s", text.rstrip())]
        at = breaks[-1] if breaks else len(text)
    return text[:at], text[at:]


def _runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    if len(hashes) < k or not k:
        return hashes[:0]
    out = np.zeros(len(hashes) - k + 1, np.uint64)
    for j in range(k):
        out = mix(out + hashes[j : len(hashes) - k + 1 + j], j)
    return out


@dataclass
class Index:
    """One shard. Terms are sorted by hash; term t has postings at[t]:at[t+1] (part, impact), parts ascending, and block
    maxima block_at[t]:block_at[t+1] (block, top). Items have word hashes words_at[i]:words_at[i+1]."""

    terms: np.ndarray
    at: np.ndarray
    part: np.ndarray
    impact: np.ndarray
    block_at: np.ndarray
    block: np.ndarray
    top: np.ndarray
    peak: np.ndarray
    essential: np.ndarray
    rest: np.ndarray
    item_of_part: np.ndarray
    ids: np.ndarray
    hashes: np.ndarray
    words_at: np.ndarray
    question: np.ndarray

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in vars(self).values())


def make_index(
    ids: np.ndarray, hashes: list[np.ndarray], question: np.ndarray, item: np.ndarray, number: np.ndarray, term: np.ndarray,
    impact: np.ndarray
) -> Index:
    """From items (id, word hashes, words of the question) and postings (place of the item, number of the part, term, impact)."""
    key = item * (int(number.max(initial=0)) + 1) + number
    keys, part = np.unique(key, return_inverse=True)
    # Parts whose rarest terms are the same come together, so that block maxima are close to what a part holds.
    rarest = np.zeros(len(keys), np.uint64)
    by = np.lexsort((term, impact))
    rarest[part[by]] = term[by]
    place = np.empty(len(keys), np.int64)
    place[np.lexsort((np.arange(len(keys)), rarest))] = np.arange(len(keys))
    item_of_part = np.empty(len(keys), np.int64)
    item_of_part[place[part]] = item
    order = np.lexsort((place[part], term))
    part, term, impact = place[part][order], term[order], impact[order]
    terms, at = np.unique(term, return_index=True)
    slot = np.searchsorted(terms, term)
    n_blocks = -(-len(keys) // BLOCK) or 1
    cell = slot * n_blocks + part // BLOCK
    cells, first = np.unique(cell, return_index=True)
    top = np.maximum.reduceat(impact, first) if len(cells) else impact
    block_at = np.searchsorted(cells, np.arange(len(terms) + 1) * n_blocks)
    block = cells % n_blocks
    peak = np.maximum.reduceat(impact, at) if len(terms) else impact
    # The most frequent terms carry little of any score: as long as their maxima add up to little in every block, no part reaches
    # the threshold by them alone.
    essential, rest = np.ones(len(terms), bool), np.zeros(n_blocks)
    for t in np.argsort(-np.diff(block_at), kind="stable"):
        s = slice(block_at[t], block_at[t + 1])
        if (rest[block[s]] + top[s]).max() > SLACK:
            break
        rest[block[s]] += top[s]
        essential[t] = False
    words_at = np.concatenate(([0], np.cumsum([len(h) for h in hashes]))).astype(np.int64)
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return Index(
        terms, np.append(at, len(term)), part, impact, block_at, block, top, peak, essential, rest, item_of_part, ids, flat,
        words_at, question
    )


def wand(index: Index, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """(part, score) of all parts at or above the threshold for a passage with these terms (places in the index)."""
    ends = index.at[terms + 1].tolist()
    cursors = index.at[terms].tolist()
    peak = index.peak[terms].tolist()
    part, impact = index.part, index.impact
    done = 1 << 62
    now = [int(part[c]) for c in cursors]
    maxima: dict[int, dict[int, float]] = {}

    def block_top(k: int, block: int) -> float:
        held = maxima.get(k)
        if held is None:
            s = slice(index.block_at[terms[k]], index.block_at[terms[k] + 1])
            held = maxima[k] = dict(zip(index.block[s].tolist(), index.top[s].tolist()))
        return held.get(block, 0.0)

    def advance(k: int, to: int) -> None:
        at = cursors[k] + int(np.searchsorted(part[cursors[k] : ends[k]], to))
        cursors[k], now[k] = at, int(part[at]) if at < ends[k] else done

    out, floor = [], threshold - 1e-9
    order = sorted(range(len(now)), key=now.__getitem__)
    while True:
        bound, pivot = 0.0, -1
        for i, k in enumerate(order):
            if now[k] == done:
                break
            bound += peak[k]
            if bound >= floor:
                pivot = i
                break
        if pivot < 0:
            return out
        target = now[order[pivot]]
        while pivot + 1 < len(order) and now[order[pivot + 1]] == target:
            pivot += 1
        block = target // BLOCK
        if sum(block_top(k, block) for k in order[: pivot + 1]) < floor:
            # nothing before the next block, or the next part of a term not yet counted, can reach the threshold
            beyond = now[order[pivot + 1]] if pivot + 1 < len(order) else done
            target = min((block + 1) * BLOCK, beyond)
            moved = order[: pivot + 1]
        elif now[order[0]] == target:
            score = float(sum(impact[cursors[k]] for k in order[: pivot + 1]))
            if score >= floor:
                out.append((target, score))
            target += 1
            moved = order[: pivot + 1]
        else:
            moved = [k for k in order[:pivot] if now[k] < target]
        for k in moved:
            if now[k] < target:
                advance(k, target)
        order.sort(key=now.__getitem__)


def scored(index: Index, p: np.ndarray, t: np.ndarray, live: np.ndarray, threshold: float) -> Iterator[tuple[int, list[tuple[int, float]]]]:
    """(passage, its parts at or above the threshold with their scores). p, t: passages and their terms, ascending; live: passage and
    block, as passage * blocks + block, of the blocks whose bound reaches the threshold, ascending.

    Passages with few live blocks are scored together, by arrays over the postings in those blocks; those with many go through the
    index with a pivot, which skips most of them."""
    n_blocks = len(index.rest)
    passages, start = np.unique(p, return_index=True)
    terms = np.diff(np.append(start, len(p)))
    lo, hi = np.searchsorted(live, passages * n_blocks), np.searchsorted(live, (passages + 1) * n_blocks)
    small = terms * (hi - lo) <= ARRAY_WORK
    for a, n, passage in zip(start[~small].tolist(), terms[~small].tolist(), passages[~small].tolist()):
        yield passage, wand(index, t[a : a + n], threshold)
    cell_key = np.repeat(np.arange(len(index.terms)), np.diff(index.block_at)) * n_blocks + index.block
    posting = np.repeat(np.arange(len(index.terms)), np.diff(index.at)) * n_blocks + index.part // BLOCK
    cell_at = np.append(np.searchsorted(posting, cell_key), len(posting))
    rows = np.flatnonzero(small)
    for first in range(0, len(rows), 256):
        some = rows[first : first + 256]
        # all terms of a passage with all its live blocks
        pairs = terms[some] * (hi - lo)[some]
        of = np.repeat(some, pairs)
        within = np.arange(len(of)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        term, block = t[start[of] + within % terms[of]], live[lo[of] + within // terms[of]] % n_blocks
        at = np.minimum(np.searchsorted(cell_key, term * n_blocks + block), len(cell_key) - 1)
        there = cell_key[at] == term * n_blocks + block
        at, of = at[there], of[there]
        many = cell_at[at + 1] - cell_at[at]
        place = np.repeat(cell_at[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
        key, back = np.unique(np.repeat(of, many) * (len(index.item_of_part) + 1) + index.part[place], return_inverse=True)
        score = np.bincount(back, index.impact[place], len(key))
        good = score >= threshold - 1e-9
        key, score = key[good], score[good]
        found: dict[int, list[tuple[int, float]]] = {}
        for k, x in zip(key.tolist(), score.tolist()):
            found.setdefault(k // (len(index.item_of_part) + 1), []).append((k % (len(index.item_of_part) + 1), x))
        for r, parts in found.items():
            yield int(passages[r]), parts


def search(
    texts: pa.Array, index: Index, width: int = WIDTH, threshold: float = THRESHOLD, overlap: float = OVERLAP
) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question overlap, answer overlap): of each text and item the passage with the best score among
    those that hold enough of the item."""
    w = words(texts)
    half = width // 2
    if not len(w.hashes) or not len(index.terms):
        return []
    slot = np.minimum(np.searchsorted(index.terms, w.hashes), len(index.terms) - 1)
    term = np.where(index.terms[slot] == w.hashes, slot, -1)
    # Each half window is a cell; a passage is a cell and the next one of the same text.
    n = np.diff(w.bounds)
    cells = np.maximum(-(-n // half), 1)
    first_cell = np.concatenate(([0], np.cumsum(cells)))
    cell = np.repeat(first_cell[:-1], n) + w.place // half
    text_of_cell = np.repeat(np.arange(len(n)), cells)
    size, n_blocks = len(index.terms), len(index.rest)
    last = np.zeros(first_cell[-1], bool)
    last[first_cell[1:] - 1] = True

    # First bound: block maxima of essential terms, of a cell and the next one, and all that the other terms can add.
    held = (term >= 0) & index.essential[term]
    here = np.unique(cell[held] * size + term[held])
    if not len(here):
        return []
    c, t = here // size, here % size
    many = index.block_at[t + 1] - index.block_at[t]
    at = np.repeat(index.block_at[t] - np.cumsum(many) + many, many) + np.arange(many.sum())
    key = np.repeat(c, many) * n_blocks + index.block[at]
    top = index.top[at]
    before = np.repeat((c > 0) & ~last[np.maximum(c - 1, 0)], many)
    keys, back = np.unique(np.concatenate((key, key[before] - n_blocks)), return_inverse=True)
    bound = np.bincount(back, np.concatenate((top, top[before])), len(keys)) + index.rest[keys % n_blocks]
    wanted = np.zeros(first_cell[-1], bool)
    wanted[keys[bound >= threshold - 1e-6] // n_blocks] = True
    if not wanted.any():
        return []

    # Then the passages that are left, with all their terms, each once.
    mine = (term >= 0) & (wanted[cell] | (wanted[np.maximum(cell - 1, 0)] & (cell > 0)))
    c, t = cell[mine], term[mine]
    earlier = (c > 0) & ~last[np.maximum(c - 1, 0)]
    own = np.unique(np.concatenate((c * size + t, (c[earlier] - 1) * size + t[earlier])))
    own = own[wanted[own // size]]
    p, t = own // size, own % size
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for passage, parts in scored(index, p, t, keys[bound >= threshold - 1e-6], threshold):
        doc = int(text_of_cell[passage])
        k = int(passage - first_cell[doc])
        for part, score in parts:
            i = int(index.item_of_part[part])
            if (doc, i) in best and best[doc, i][0] >= score:
                continue
            item = index.hashes[index.words_at[i] : index.words_at[i + 1]]
            reach = max(len(item), half)
            near = w.hashes[max(w.bounds[doc], w.bounds[doc] + k * half - reach) : min(w.bounds[doc + 1], w.bounds[doc] + (k + 2) * half + reach)]
            share = [1.0, 1.0]
            for j, x in enumerate((item[: index.question[i]], item[index.question[i] :]) if len(item) >= SHORT else (item,)):
                run = min(RUN, len(x)) if len(item) >= SHORT else len(x)
                if len(x):
                    share[j] = float(np.isin(np.unique(_runs(x, run)), _runs(near, run)).mean())
            if min(share) >= overlap:
                best[doc, i] = (score, *share)
    return [(d, i, *x) for (d, i), x in best.items()]


def item_table(benchmark: DataFrame, item_col: str, text_col: str, shards: int) -> tuple[DataFrame, DataFrame]:
    """(items: item, text_id; texts: text_id, shard, hashes, question): equal texts are one row of `texts`."""
    rows = benchmark.select(F.col(item_col).alias("item"), F.lower(text_of(text_col)).alias("text"))
    rows = rows.withColumn("text_id", F.xxhash64("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            w, q = words(texts), words(pa.array([split_item(t or "")[0] for t in texts.to_pylist()], pa.string()))
            lists = pa.ListArray.from_arrays(pa.array(w.bounds, pa.int32()), pa.array(w.hashes.view(np.int64)))
            columns = [batch.column("text_id"), lists, pa.array(np.diff(q.bounds), pa.int64())]
            yield pa.record_batch(columns, names=["text_id", "hashes", "question"])

    texts = rows.groupBy("text_id").agg(F.any_value("text").alias("text"))
    texts = texts.mapInArrow(cut, "text_id long, hashes array<long>, question long")
    return rows.select("item", "text_id"), texts.withColumn("shard", F.pmod("text_id", F.lit(shards)).cast("int"))


def posting_table(texts: DataFrame, min_item_words: int) -> DataFrame:
    """(shard, text_id, number, term, impact): BM25 impacts as shares of what each part gives itself."""
    n = F.size("hashes")
    parts = F.ceil(n / PART)
    cut = texts.filter(n >= min_item_words).withColumn("parts", parts).withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    lo, hi = (F.floor((F.col("number") + k) * n / F.col("parts")).cast("int") for k in (0, 1))
    cut = cut.select("shard", "text_id", "number", F.slice("hashes", lo + 1, hi - lo).alias("terms"))
    whole = cut.agg(F.count("*").alias("n"), F.avg(F.size("terms")).alias("mean"))
    long = cut.select("shard", "text_id", "number", F.size("terms").alias("size"), F.explode("terms").alias("term"))
    tf = long.groupBy("shard", "text_id", "number", "size", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log1p((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    raw = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.col("mean")))
    scored = tf.join(df, "term").crossJoin(F.broadcast(whole)).withColumn("raw", raw)
    own = scored.groupBy("text_id", "number").agg(F.sum("raw").alias("own"))
    return scored.join(own, ["text_id", "number"]).select("shard", "text_id", "number", "term", (F.col("raw") / F.col("own")).alias("impact"))


def build_indexes(benchmark: DataFrame, item_col: str, text_col: str, min_item_words: int, shard_items: int) -> tuple[DataFrame, list[Index]]:
    """(items: item, text_id; an index for each shard of about `shard_items` texts)."""
    shards = max(1, -(-benchmark.count() // shard_items))
    items, texts = item_table(benchmark, item_col, text_col, shards)
    texts = materialise(texts, "leak-texts")
    postings = materialise(posting_table(texts, min_item_words), "leak-postings")
    out = []
    for k in range(shards):
        held = texts.filter((F.col("shard") == k) & (F.size("hashes") >= min_item_words)).orderBy("text_id").toArrow()
        found = postings.filter(F.col("shard") == k).toArrow()
        ids = held["text_id"].to_numpy()
        hashes = [np.array(x, np.int64).view(np.uint64) for x in held["hashes"].to_pylist()]
        item = np.searchsorted(ids, found["text_id"].to_numpy())
        term = found["term"].to_numpy().view(np.uint64)
        out.append(make_index(ids, hashes, held["question"].to_numpy(), item, found["number"].to_numpy(), term, found["impact"].to_numpy()))
    return items, out


def leaks_by_row(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    shard_items: int = 5_000,
    min_item_words: int = 4,
) -> DataFrame:
    """One row per document and item found in it: id, row (a hash of the text, which tells rows with one id apart), item, score,
    question_overlap, answer_overlap."""
    if width < 2 * PART:
        raise ValueError(f"passages of {width} words don't hold parts of {PART} whole")
    items, indexes = build_indexes(benchmark, item_col, item_text_col, min_item_words, shard_items)
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_of(text_col)).alias("row"), F.lower(text_of(text_col)).alias("text"))
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, row long, text_id long, score double, question_overlap double, answer_overlap double"
    passes: list[list[Index]] = [[]]
    for index in indexes:
        if passes[-1] and sum(x.nbytes for x in passes[-1]) + index.nbytes > INDEX_BYTES:
            passes.append([])
        passes[-1].append(index)
    out = None
    for group in passes:
        # plain arrays, as workers need not have this package
        shared = docs.sparkSession.sparkContext.broadcast([vars(x) for x in group])

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = [Index(**x) for x in shared.value]
            for batch in batches:
                for at, texts in steps(batch.column("text")):
                    for index in held:
                        if hits := search(texts, index, width, threshold, overlap):
                            where = pa.array([at + h[0] for h in hits])
                            docs_ = [batch.column(c).take(where) for c in ("doc", "row")]
                            numbers = [pa.array([h[j] for h in hits], pa.float64()) for j in (2, 3, 4)]
                            columns = [*docs_, pa.array([int(index.ids[h[1]]) for h in hits], pa.int64()), *numbers]
                            yield pa.record_batch(columns, names=["doc", "row", "text_id", "score", "question_overlap", "answer_overlap"])

        found = rows.mapInArrow(scan, schema)
        out = found if out is None else out.unionByName(found)
    named = out.join(items, "text_id")
    return named.select(F.col("doc").alias(id_col), "row", F.col("item").alias(item_col), "score", "question_overlap", "answer_overlap")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document and item found in it: id, item, score, question_overlap, answer_overlap. options: of leaks_by_row."""
    return leaks_by_row(docs, benchmark, id_col, text_col, **options).drop("row")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input without rows in which an item was found. Rows are told apart by id and text, null ids being equal."""
    found = leaks_by_row(docs, benchmark, id_col, text_col)
    leaked = materialise(found.select(F.col(id_col).alias("__leaked"), F.col("row").alias("__row")).distinct(), "leaked")
    same = docs[id_col].eqNullSafe(leaked["__leaked"]) & (F.xxhash64(text_of(docs[text_col])) == leaked["__row"])
    return docs.join(leaked, same, "left_anti")
