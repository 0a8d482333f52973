"""Periodic runs of words in texts, by an online sparse diagonal program.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at least
max(LEAST_WORDS, LEAST_PERIODS * q) words that no neighbouring word extends with that period. Reading word by word, each
active lag has a match length: an earlier occurrence of the word at that lag adds one, any other word ends the diagonal,
which is emitted at once if it is long enough. What isn't active costs nothing.

A frequent word has many earlier occurrences, nearly all of which start diagonals that end at once. Those of blocks of
words are followed instead: a lag d in (m/2, m], m a power of two, is started where the latest earlier occurrence of the last
m words is d words before. In a run of smallest period d every such block recurs d words later and not sooner, else the
run would have a smaller period (Fine and Wilf), and as the run holds four periods, this is so at m/2 ends of blocks and
more in a row; every m/2-th word is looked at. So each run's lag is started, its match length is then counted back to where
the diagonal begins, and every long diagonal has its smallest period. At most one lag of each m is active at a time, so
a text of n words takes n log n steps, also if it is one word n times.

Data flow: one pass of Arrow batches, nothing is shuffled. Long texts are steps of their own.

Cases: a null or empty text has no runs and an empty collapsed text; fewer words than LEAST_WORDS can't hold a run; very
long texts are read whole; rows with equal or null ids count each; an empty table gives an empty result; other columns
aren't read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import text_of
from scanloom.llm.tokens import Words, mix, not_of, steps, words

LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Lags that one comparison of arrays looks at.
PIECE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
BLANKS = b" \t\n\x0b\x0c\r"

#: (id, words) to words: a change to a text's words before they are searched.
Edit = Callable[[object, list[bytes]], list[bytes]]


def starts(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word, lag) at which a lag may become active, ascending; words are numbered through all texts."""
    n = np.diff(w.bounds)
    size, place = np.repeat(n, n), w.place
    block, m, found = w.hashes, 1, []
    while len(block) and LEAST_PERIODS * (m // 2 + 1) <= n.max():
        least = max(LEAST_WORDS, LEAST_PERIODS * (m // 2 + 1))
        ends = np.arange(0, len(block), max(1, m // 2))
        ends = ends[(size[ends] >= least) & (place[ends] >= m + m // 2)]
        for at in range(0, len(ends), max(1, PIECE // m)):
            i = ends[at : at + max(1, PIECE // m)]
            same = block[np.maximum(i[:, None] - np.arange(1, m + 1), 0)] == block[i][:, None]
            lag = same.argmax(axis=1) + 1
            ok = same.any(axis=1) & (lag > m // 2) & (place[i] >= m - 1 + lag)
            found.append(np.stack([i[ok], lag[ok]]))
        longer = block.copy()
        longer[m:] = mix(block[:-m] * _ODD + block[m:])
        block, m = longer, 2 * m
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, lag = np.concatenate(found, axis=1)
    order = np.lexsort((lag, i))
    return i[order], lag[order]


def runs_of(word: list, proposed: dict[int, list[int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of one text's runs, by start, then period. proposed: place to lags that may start there."""
    active: dict[int, int] = {}
    out: list[tuple[int, int, int]] = []

    def end(lag: int, matches: int, stop: int) -> None:
        if matches + lag >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            out.append((stop - matches - lag, matches + lag, lag))

    todo = sorted(proposed)
    at = i = 0
    while at < len(todo) or active:
        if not active:
            i = todo[at]
        if i == len(word):
            break
        for lag in list(active):
            if word[i] == word[i - lag]:
                active[lag] += 1
            else:
                end(lag, active.pop(lag), i)
        if at < len(todo) and todo[at] == i:
            for lag in proposed[i]:
                if lag not in active:
                    matches = 0
                    while i - matches >= lag and word[i - matches] == word[i - matches - lag]:
                        matches += 1
                    active[lag] = matches
            at += 1
        i += 1
    for lag, matches in active.items():
        end(lag, matches, len(word))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(word: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run contains after its first period."""
    keep = [True] * len(word)
    for start, length, period in runs:
        keep[start + period : start + length] = [False] * (length - period)
    return [x for x, k in zip(word, keep) if k]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: Edit | None = None) -> DataFrame:
    """Per row: id, n_words, runs (array of start, length, period, by start, then period; words are numbered from 0) and
    collapsed, the kept words joined by one space."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in steps(batch.column("text")):
                ids = batch.column("id").slice(at, len(texts))
                split = [x.split() for x in texts.cast(pa.binary()).to_pylist()]
                if edit:
                    split = [edit(i, x) for i, x in zip(ids.to_pylist(), split)]
                w = words(pa.array([b" ".join(x) for x in split], pa.large_binary()), not_of(BLANKS), lower=False)
                spots, lags = starts(w)
                proposed: dict[int, dict[int, list[int]]] = {}
                for text, i, lag in zip((np.searchsorted(w.bounds, spots, side="right") - 1).tolist(), spots.tolist(), lags.tolist()):
                    proposed.setdefault(text, {}).setdefault(i - int(w.bounds[text]), []).append(lag)
                found = [runs_of(x, proposed[t]) if t in proposed else [] for t, x in enumerate(split)]
                kept = [b" ".join(collapse(x, r) if r else x) for x, r in zip(split, found)]
                flat = [x for r in found for x in r]
                parts = [pa.array([x[k] for x in flat], pa.int64()) for k in range(3)]
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in found]))), pa.int32())
                columns = {
                    "id": ids,
                    "n_words": pa.array(np.diff(w.bounds), pa.int64()),
                    "runs": pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, ["start", "length", "period"])),
                    "collapsed": pa.array(kept, pa.binary()).cast(pa.string()),
                }
                yield pa.record_batch(list(columns.values()), names=list(columns))

    kind = rows.schema["id"].dataType.simpleString()
    shape = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(search, shape).withColumnRenamed("id", id_col)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of `find_runs`: id, n_runs, the longest run (ties: smallest start, then period) with its exponent in thousandths, and the
    SHA-256 of the runs, a line each, and of the collapsed text."""
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("a"), (-r["start"]).alias("b"), (-r["period"]).alias("c"))))
    number = lambda c: c.cast("string")
    line = lambda r: F.concat(number(r["start"]), F.lit(","), number(r["length"]), F.lit(","), number(r["period"]), F.lit("\n"))
    sha: Callable[[Column], Column] = lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("top", top).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("top.b")).alias("start"), F.col("top.a").alias("length"),
        (-F.col("top.c")).alias("period"), F.expr("1000 * top.a div -top.c").alias("exponent_milli"),
        sha(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256")
    )
