"""Toxic spans and document scores from a linear-chain conditional random field.

Tokens are words (tokens.py); a token is toxic or not. Its features, hashed into one weight table, are the word, its
first three, four and five bytes and its last four. The chain has one weight for each pair of neighbouring labels.
Forward-backward gives each token's marginal; a document's score is a logistic function of the largest marginal and of
the expected number of toxic tokens, and its spans are the runs of tokens with a marginal of at least one half.

Labels mark documents, so token labels for training come from them: a token of a toxic document is toxic if one of its
word and prefix features occurs nearly only in toxic documents, by a likelihood ratio against chance.

Training runs on the driver on a bounded sample: at most `per_class` labelled documents of each label, by seeded hash,
each of at most `max_train_chars` characters. Scoring is one pass over all documents, with whole texts and no shuffle;
in a batch the recursions run over all texts side by side, one word at a time.

Cases: a null text is empty; texts without words get the score of no toxic token; labels other than 0 and 1 and labels
without a document are ignored; without labels of both kinds every score is the share of toxic labels; repeated
documents are scored each; an empty table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import text_of
from scanloom.llm.tokens import Words, mix, steps, words

BITS = 18
PREFIXES = (3, 4, 5)
SUFFIX = 4
#: Nats by which a feature's documents must speak against chance, and the share of them that must be toxic.
EVIDENCE, PURITY = 9.0, 0.9


def features(w: Words) -> np.ndarray:
    """(features, tokens) slots in the weight table: the word, its prefixes, its suffix."""
    n = w.end - w.first
    out = [mix(w.hashes, 11)]
    packed = np.zeros(len(n), np.uint64)
    for i in range(max(PREFIXES)):
        byte = np.where(n > i, w.data[np.minimum(w.first + i, len(w.data) - 1)], 0).astype(np.uint64) if len(n) else packed
        packed = packed << np.uint64(8) | byte
        if i + 1 in PREFIXES:
            out.append(mix(packed, 20 + i))
    packed = np.zeros(len(n), np.uint64)
    for i in range(SUFFIX):
        byte = np.where(n > i, w.data[np.maximum(w.end - 1 - i, 0)], 0).astype(np.uint64) if len(n) else packed
        packed = packed << np.uint64(8) | byte
    out.append(mix(packed, 31))
    return (np.array(out) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class Lanes:
    """Tokens of many texts in order of their place, longest text first, so that the tokens at one place are one
    slice and the texts that still have a token there are its first ones."""

    bounds: np.ndarray
    slot: np.ndarray = field(init=False)
    at: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = np.diff(self.bounds)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(n), np.int64)
        rank[order] = np.arange(len(n))
        alive = len(n) - np.searchsorted(np.sort(n), np.arange(n.max() if len(n) else 0), side="right")
        self.at = np.concatenate(([0], np.cumsum(alive)))
        place = np.arange(self.bounds[-1]) - np.repeat(self.bounds[:-1], n)
        self.slot = self.at[place] + np.repeat(rank, n)


def odds(e: np.ndarray, at: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds of toxic against not. e: exp of token scores in lane order; t[a, b]: exp of the
    weight of label b after a."""
    fore, back = e.copy(), np.ones_like(e)
    (t00, t01), (t10, t11) = t.tolist()
    where = at.tolist()
    for p in range(1, len(where) - 1):
        a, b, k = where[p - 1], where[p], where[p + 1] - where[p]
        r = fore[a : a + k]
        fore[b : b + k] *= (r * t11 + t01) / (r * t10 + t00)
    for p in range(len(where) - 3, -1, -1):
        a, b, k = where[p], where[p + 1], where[p + 2] - where[p + 1]
        s = e[b : b + k] * back[b : b + k]
        back[a : a + k] = (s * t11 + t10) / (s * t01 + t00)
    return fore, back


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    chain: np.ndarray
    document: np.ndarray

    def marginals(self, w: Words, slots: np.ndarray | None = None) -> np.ndarray:
        if not len(w.hashes):
            return np.zeros(0)
        slots = features(w) if slots is None else slots
        lanes = Lanes(w.bounds)
        e = np.empty(len(w.hashes))
        e[lanes.slot] = np.exp(np.clip(self.bias + self.weights[slots].sum(axis=0), -30, 30))
        fore, back = odds(e, lanes.at, np.exp(self.chain))
        both = (fore * back)[lanes.slot]
        return both / (1 + both)

    def scores(self, w: Words, m: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_document_features(w, m) @ self.document, -30, 30)))


def _document_features(w: Words, m: np.ndarray) -> np.ndarray:
    n = np.diff(w.bounds)
    most, total = np.zeros(len(n)), np.zeros(len(n))
    full = np.flatnonzero(n)
    if len(full):
        most[full] = np.maximum.reduceat(m, w.bounds[:-1][full])
        total[full] = np.add.reduceat(m, w.bounds[:-1][full])
    return np.stack([np.ones(len(n)), most, np.log1p(total)], axis=1)


def token_labels(w: Words, slots: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which tokens of toxic texts have a feature that speaks for toxic texts beyond chance."""
    text, n_tox, n_all = w.text_of_word, int(toxic.sum()), len(toxic)
    chance = n_tox / n_all
    out = np.zeros(len(w.hashes), bool)
    for row in slots[: 1 + len(PREFIXES)]:
        pairs = np.unique(row.astype(np.int64) * n_all + text)
        slot, doc = pairs // n_all, pairs % n_all
        hit = np.bincount(slot, toxic[doc].astype(float), 1 << BITS)
        seen = np.bincount(slot, minlength=1 << BITS)
        share = np.clip(hit / np.maximum(seen, 1), 1e-9, 1 - 1e-9)
        nats = seen * (share * np.log(share / chance) + (1 - share) * np.log((1 - share) / (1 - chance)))
        out |= ((nats >= EVIDENCE) & (share >= PURITY))[row]
    return out & toxic[text]


def train(texts: list[str], toxic: np.ndarray, prior: float, rounds: int = 30, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """prior: share of toxic documents outside the sample."""
    model = Model(np.zeros(1 << BITS, np.float32), -4.0, np.zeros((2, 2)), np.array([np.log(max(prior, 1e-4) / max(1 - prior, 1e-4)), 0.0, 0.0]))
    toxic = np.asarray(toxic, bool)
    w = words(pa.array(texts, pa.string()))
    if not toxic.any() or toxic.all() or not len(w.hashes):
        return model
    slots = features(w)
    y = token_labels(w, slots, toxic).astype(float)
    lanes = Lanes(w.bounds)
    yl = np.empty(len(y))
    yl[lanes.slot] = y
    # Tokens at place 1 and on, and the token before each, in lane order.
    now = np.arange(lanes.at[1], lanes.at[-1])
    step = np.searchsorted(lanes.at, now, side="right") - 1
    before = lanes.at[step - 1] + now - lanes.at[step]
    g2, b2, c2 = np.full(1 << BITS, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    seen_pairs = np.array(
        [
            [((1 - yl[before]) * (1 - yl[now])).sum(), ((1 - yl[before]) * yl[now]).sum()],
            [(yl[before] * (1 - yl[now])).sum(), (yl[before] * yl[now]).sum()]
        ]
    )
    scale = 1.0 / max(1.0, y.sum())
    for _ in range(rounds):
        e = np.empty(len(y))
        e[lanes.slot] = np.exp(np.clip(model.bias + model.weights[slots].sum(axis=0), -30, 30))
        t = np.exp(model.chain)
        fore, back = odds(e, lanes.at, t)
        both = (fore * back)[lanes.slot]
        miss = y - both / (1 + both)
        r, s = fore[before], (e * back)[now]
        cells = np.array([[np.full(len(r), t[0, 0]), t[0, 1] * s], [t[1, 0] * r, t[1, 1] * r * s]])
        pairs = (cells / cells.sum(axis=(0, 1))).sum(axis=2)
        gw = sum(np.bincount(row, miss, 1 << BITS) for row in slots) * scale - decay * model.weights
        gb, gc = miss.sum() * scale, (seen_pairs - pairs) * scale
        g2, b2, c2 = g2 + gw**2, b2 + gb**2, c2 + gc**2
        model.weights += (rate * gw / np.sqrt(g2)).astype(np.float32)
        model.bias += rate * gb / np.sqrt(b2)
        model.chain += 0.3 * rate * gc / np.sqrt(c2)
    x = _document_features(w, model.marginals(w, slots))
    weight = np.where(toxic, prior / toxic.mean(), (1 - prior) / (1 - toxic.mean()))
    v = model.document
    for _ in range(50):  # Newton steps of a weighted, slightly damped logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        grad = x.T @ (weight * (toxic - p)) - 0.1 * v * np.array([0, 1, 1])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 0.1, 0.1])
        move = np.linalg.solve(curve, grad)
        v = v + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    model.document = v
    return model


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def fit_sample(
    docs: DataFrame, labels: DataFrame, per_class: int, max_train_chars: int, id_col: str, text_col: str, seed: int
) -> tuple[list[str], np.ndarray, float]:
    """Texts and labels of a bounded sample of rows that are not held out, and the share of toxic labels."""
    learn = labels.filter(
        F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col))
    ).select(F.col(id_col).alias("_key"), F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in learn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    by_hash = [F.xxhash64(F.lit(seed), F.col("_key").cast("string")), F.col("_key")]
    chosen = learn.filter("toxic = 1").orderBy(*by_hash).limit(per_class).unionAll(learn.filter("toxic = 0").orderBy(*by_hash).limit(per_class))
    texts = docs.select(F.col(id_col).alias("_key"), F.lower(text_of(text_col)).alias("text")).filter(F.length("text") <= max_train_chars)
    got = texts.join(F.broadcast(chosen), "_key").limit(4 * per_class).collect()  # the broadcast has at most 2 * per_class ids
    got.sort(key=lambda r: (str(r["_key"]), r["text"]))
    return [r["text"] for r in got], np.array([r["toxic"] == 1 for r in got], bool), prior


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 1_200,
    max_train_chars: int = 30_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 5,
) -> DataFrame:
    """Per document: id, held_out, score, predicted (score >= 0.5), spans: array of (start, end) code points of the
    lower-cased text."""
    model = train(*fit_sample(docs, labels, per_class, max_train_chars, id_col, text_col, seed))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays, as workers need not have this package
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in batches:
            for at, texts in steps(batch.column("text"), 4 << 20):
                w = words(texts)
                m = model.marginals(w)
                yield pa.record_batch(
                    [batch.column("id").slice(at, len(texts)), pa.array(model.scores(w, m)), spans_of(w, m)],
                    names=["id", "score", "spans"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.lower(text_of(text_col)).alias("text"))
    scored = rows.mapInArrow(score, f"id {kind}, score double, spans array<struct<start:int,end:int>>")
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(is_held_out(F.col("id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )


def spans_of(w: Words, m: np.ndarray) -> pa.Array:
    """Runs of toxic tokens of each text, as code point offsets."""
    hot = np.flatnonzero(m >= 0.5)
    text = np.searchsorted(w.bounds, hot, side="right") - 1
    fresh = np.ones(len(hot), bool)
    fresh[1:] = (np.diff(hot) > 1) | (np.diff(text) > 0)
    first, last = hot[fresh], hot[np.append(fresh[1:], True)] if len(hot) else hot
    points = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80)))
    base = points[w.base[:-1][text[fresh]]]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(text[fresh], minlength=len(w)))))
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(points[w.first[first]] - base, pa.int32()), pa.array(points[w.end[last]] - base, pa.int32())],
            ["start", "end"]
        ),
    )
