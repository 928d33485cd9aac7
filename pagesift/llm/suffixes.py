"""Suffix arrays by induced sorting, and permuted common prefixes.

``suffix_array`` classifies suffixes as larger (L) or smaller (S) than the next,
sorts the substrings between leftmost S suffixes (LMS) by induction, names them,
sorts the string of names and induces all suffixes from the LMS ones (Nong, Zhang
and Chan). Buckets of bytes are scanned as arrays, a bucket at a time. Names have
tiny buckets, so their string is sorted by doubled prefixes instead of by
recursion: only equals are sorted again, all at once (Larsson and Sadakane).
"""

from __future__ import annotations

import numpy as np

# Larger alphabets are not scanned bucket by bucket but sorted by doubled prefixes.
SMALL_ALPHABET = 300


def _s_types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last one, a unique smallest symbol, is S."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64)))
    # Equal neighbours have the type of the next unequal ones.
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    inside = at < n - 1
    out[:-1][inside] = step[at[inside]] > 0
    return out


class _Queues:
    """What is induced into each bucket, in order."""

    def __init__(self, k: int):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(k)]

    def put(self, at: np.ndarray, symbols: np.ndarray) -> None:
        if not len(at):
            return
        order = np.argsort(symbols, kind="stable")
        at, symbols = at[order], symbols[order]
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        for part, symbol in zip(np.split(at, cuts), symbols[np.concatenate(([0], cuts))].tolist()):
            self.parts[symbol].append(part)

    def take(self, symbol: int) -> np.ndarray:
        parts = self.parts[symbol]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _induce_buckets(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """All suffixes in the order that the order of ``lms`` induces."""
    starts = _Queues(k)
    starts.put(lms, s[lms])
    larger = _Queues(k)
    bucket_l: list[np.ndarray] = []
    for c in range(k):
        waves, current = [], larger.take(c)
        while len(current):
            waves.append(current)
            before = current[current > 0] - 1
            before = before[~is_s[before]]
            symbols = s[before]
            same = symbols == c
            larger.put(before[~same], symbols[~same])
            current = before[same]
        bucket_l.append(np.concatenate(waves) if waves else np.zeros(0, np.int32))
        before = starts.take(c)
        before = before[before > 0] - 1
        before = before[~is_s[before]]
        larger.put(before, s[before])
    smaller = _Queues(k)
    out = []
    for c in range(k - 1, -1, -1):
        waves, current = [], smaller.take(c)
        while len(current):
            waves.append(current)
            before = current[current > 0] - 1
            before = before[is_s[before]]
            symbols = s[before]
            same = symbols == c
            smaller.put(before[~same], symbols[~same])
            current = before[same]
        before = bucket_l[c][::-1]
        before = before[before > 0] - 1
        before = before[is_s[before]]
        smaller.put(before, s[before])
        if waves:
            out.append(np.concatenate(waves)[::-1])
        out.append(bucket_l[c])
    # The last suffix is the smallest and is induced by none.
    out.append(np.array([len(s) - 1], np.int32))
    return np.concatenate(out[::-1])


def _names(s: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings in sorted order: equal ones share a name."""
    m = len(ordered)
    ends = np.full(len(s), len(s) - 1, np.int64)
    ends[lms[:-1]] = lms[1:]
    length = ends[ordered] - ordered + 1
    new = np.ones(m, bool)
    pair = np.flatnonzero(length[1:] == length[:-1]) + 1
    a, b, left = ordered[pair - 1].astype(np.int64), ordered[pair].astype(np.int64), length[pair].copy()
    k = 0
    while len(pair):
        same = s[a + k] == s[b + k]
        done = same & (left == k + 1)
        new[pair[done]] = False
        go = same & ~done
        pair, a, b, left = pair[go], a[go], b[go], left[go]
        k += 1
    return np.cumsum(new) - 1


def _by_doubling(ordered: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a string of names, from its places in the
    order of their first names, and these. The last name is the only one of its kind."""
    order, m = ordered.copy(), len(ordered)
    at, key, h = np.arange(m), names, 1
    rank = np.empty(m, np.int64)
    while True:
        # A place's rank is where its group of equals starts.
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        rank[order[at]] = np.repeat(at[first], size)
        at = at[np.repeat(size > 1, size)]
        if not len(at):
            return order
        # Equals have none of the last name among their h names, so there is one behind.
        place = order[at]
        key = rank[place] * m + rank[place + h]
        by = np.argsort(key)
        order[at], key = place[by], key[by]
        h *= 2


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Of symbols below ``k``; the last symbol is 0 and the only 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    if k > SMALL_ALPHABET:
        order = np.argsort(s, kind="stable").astype(np.int32)
        return _by_doubling(order, s[order])
    is_s = _s_types(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]).astype(np.int32) + np.int32(1)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    rough = _induce_buckets(s, is_s, lms, k)
    ordered = rough[is_lms[rough]]
    names = _names(s, ordered, lms)
    if names[-1] + 1 < len(lms):
        place = np.empty(n, np.int32)
        place[lms] = np.arange(len(lms), dtype=np.int32)
        ordered = lms[_by_doubling(place[ordered], names)]
    return _induce_buckets(s, is_s, ordered, k)


def permuted_lcp(s: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """For each place, the prefix it shares with the suffix before it in the
    array, up to ``cap``.

    A value is one less than the one before it unless the symbols before both
    suffixes differ (Karkkainen, Manzini and Puglisi); those are compared eight
    symbols at a time.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n, dtype=np.int64)
    fresh = np.ones(n, bool)
    inner = (at > 0) & (before > 0)
    fresh[inner] = s[at[inner] - 1] != s[before[inner] - 1]
    padded = np.concatenate([s.astype(np.uint8), np.zeros(8, np.uint8)])
    packed = np.zeros(n, np.uint64)
    for b in range(8):
        packed |= padded[b : n + b].astype(np.uint64) << np.uint64(8 * b)
    start = np.flatnonzero(fresh)
    value = np.zeros(len(start), np.int64)
    live = np.flatnonzero(before[start] >= 0)
    x, y = start[live], before[start[live]]
    while len(live):
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        differ = packed[x] ^ packed[y]
        equal = differ == 0
        low = differ & (~differ + np.uint64(1))
        value[live] += np.where(equal, 8, np.bitwise_count(low - np.uint64(1)) // 8)
        go = equal & (value[live] < cap)
        live, x, y = live[go], x[go] + 8, y[go] + 8
    last = np.maximum.accumulate(np.where(fresh, at, -1))
    of = np.zeros(n, np.int64)
    of[start] = value
    return np.maximum(of[last] - (at - last), 0)
