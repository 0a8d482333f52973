"""Words of many texts at once, as numpy arrays.

Words are runs of digits, letters a-z (A-Z lower-cased) and all code points from 0x80, found on the UTF-8 bytes of
an Arrow column without decoding. Each gets a 64-bit hash; equal words have equal hashes everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_IS_WORD = np.zeros(256, bool)
_IS_WORD[ord("0") : ord("9") + 1] = _IS_WORD[ord("A") : ord("Z") + 1] = _IS_WORD[ord("a") : ord("z") + 1] = _IS_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: One random number per (place in a word mod 32, byte); fixed seed, so that hashes agree on all executors.
_TABLE = np.random.default_rng(20240101).integers(0, 1 << 63, (32, 256), dtype=np.uint64) | np.uint64(1)
#: Bytes of text that one step holds as arrays of 8 bytes each; long texts make a step of their own.
STEP_BYTES = 2 << 20


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser, different for each seed."""
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of n texts: text i has words bounds[i]:bounds[i+1]. first and end are byte offsets in `data`, which
    holds the lower-cased bytes of the texts one after another; base[i] is where text i begins."""

    hashes: np.ndarray
    first: np.ndarray
    end: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    base: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    @property
    def place(self) -> np.ndarray:
        return np.arange(len(self.hashes)) - np.repeat(self.bounds[:-1], np.diff(self.bounds))


def not_of(separators: bytes) -> np.ndarray:
    """Words that are runs of all bytes but these."""
    out = np.ones(256, bool)
    out[list(separators)] = False
    return out


def words(texts: pa.Array, inside_word: np.ndarray = _IS_WORD, lower: bool = True) -> Words:
    """`texts`: string or binary array; null counts as empty. inside_word: which of the 256 byte values words are made of."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    lo, hi = int(ends[0]), int(ends[-1])
    raw = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
    raw = _LOWER[raw] if lower else raw
    base = ends - lo
    inside = inside_word[raw]
    edge = np.empty(len(raw) + 1, bool)
    edge[0], edge[-1] = len(raw) > 0 and inside[0], False
    edge[1:-1] = inside[1:] & ~inside[:-1]
    cut = base[:-1][np.diff(base) > 0]  # a word never runs on into the next text
    edge[cut] = inside[cut]
    first = np.flatnonzero(edge[:-1])
    if not len(first):
        return Words(np.zeros(0, np.uint64), first, first, np.zeros(len(texts) + 1, np.int64), raw, base)
    starts_inside = np.cumsum(inside)
    length = np.diff(np.append(starts_inside[first], starts_inside[-1] + 1))
    bytes_ = raw[inside]
    place = np.arange(len(bytes_)) - np.repeat(np.cumsum(length) - length, length)
    value = _TABLE[place & 31, bytes_]
    if length.max() > 32:
        value *= (place >> 5).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C16) + np.uint64(1)
    hashes = mix(np.add.reduceat(value, np.cumsum(length) - length))
    return Words(hashes, first, first + length, np.searchsorted(first, base), raw, base)


def steps(texts: pa.Array, step_bytes: int = STEP_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) of rows whose texts together hold about `step_bytes`."""
    if not len(texts):
        return
    sizes = np.cumsum(np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(float)))
    at = 0
    while at < len(texts):
        reach = sizes[at - 1] if at else 0.0
        to = max(at + 1, int(np.searchsorted(sizes, reach + step_bytes, side="right")))
        yield at, texts.slice(at, to - at)
        at = to
