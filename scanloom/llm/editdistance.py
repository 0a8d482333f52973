"""Banded bit-parallel edit distance over any sequences of hashable items (Hyyrö 2003): the cells within `most` of the
diagonal are the bits of one integer, which slides down the diagonal by one item a step."""

from __future__ import annotations

from collections.abc import Hashable, Sequence


def _same_start(a: Sequence, b: Sequence) -> int:
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def distance_within(a: Sequence[Hashable], b: Sequence[Hashable], most: int) -> int:
    """The edit distance (insert, delete, replace) if it is at most `most`, else -1."""
    if abs(len(a) - len(b)) > most:
        return -1
    k = _same_start(a, b)
    a, b = a[k:], b[k:]
    if k := _same_start(a[::-1], b[::-1]):
        a, b = a[: len(a) - k], b[: len(b) - k]
    if len(a) < len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if not n:
        return m if m <= most else -1
    if most == 0:
        return -1
    k = min(most, m)
    places: dict[Hashable, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    mask = (1 << (2 * k + 1)) - 1
    bottom, row = 1 << (2 * k), 1 << (m - 1 + k) if m <= k else 1 << (2 * k - 1)
    up, down, dist, slack = (mask << k) & mask, 0, k, k + n - (m - k)
    for j, x in enumerate(b):
        p = places.get(x, 0)
        p = (p >> (j - k) if j >= k else p << (k - j)) & mask
        diagonal = (((p & up) + up) ^ up) | p | down
        right_up = down | ~(diagonal | up) & mask
        right_down = diagonal & up
        if j < m - k:
            dist += not diagonal & bottom
            if dist > slack:
                return -1
        else:
            dist += bool(right_up & row) - bool(right_down & row)
            row >>= 1
        half = (diagonal & mask) >> 1
        up, down = right_down & mask | ~(half | right_up) & mask, half & right_up
    return dist if dist <= most else -1
