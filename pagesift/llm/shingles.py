"""Word shingles of many texts at once, as sorted sets of 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np

# Words end at white space (0x20, 0x09 to 0x0D); A-Z fold to lower case.
_FOLD = np.arange(256, dtype=np.int64)
_FOLD[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (Stafford's mix 13)."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)[_FOLD]


# _ODD has an inverse among 64-bit numbers, so a word's sum can be cut from a running one.
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _powers(of: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), of, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


# Bytes that are summed at once, which a processor's cache holds.
_WINDOW = 1 << 15
_RISING, _FALLING = _powers(_ODD, _WINDOW), _powers(_INVERSE, _WINDOW)


def _word_sums(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        low = int(starts[a])
        # Whole words; one that is longer than the window is summed by itself.
        b = max(a + 1, int(np.searchsorted(stops, low + _WINDOW, "right")))
        size = int(stops[b - 1]) - low
        rising, falling = (_RISING, _FALLING) if size <= _WINDOW else (_powers(_ODD, size), _powers(_INVERSE, 1))
        running = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE[data[low : low + size]] * rising[:size], out=running[1:])
        first = starts[a:b] - low
        out[a:b] = (running[stops[a:b] - low] - running[first]) * falling[first]
        a = b
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words start (one more entry)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = (data != 0x20) & (data - np.uint8(0x09) > 4)
    breaks = np.ones(len(data) + 1, bool)
    np.not_equal(inside[1:], inside[:-1], out=breaks[1:-1])
    breaks[offsets[(offsets > 0) & (offsets < len(data))]] = True
    starts, stops = np.flatnonzero(inside & breaks[:-1]), np.flatnonzero(inside & breaks[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    sums = _word_sums(data, starts, stops)
    return mix(sums + (stops - starts).astype(np.uint64) * _M2), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``size`` words, sorted; fewer
    words are one shingle, no words none."""
    words, at = word_hashes(data, offsets)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64))
    n = len(words) - size + 1
    grams = np.zeros(0, np.uint64)
    if n > 0:
        grams = words[:n] * factors[0]
        for k in range(1, size):
            grams += words[k : n + k] * factors[k]
        grams = mix(grams)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            whole = (words[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(whole + np.full(1, b - a, np.uint64) * _M1))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)
