"""64-bit token hashes and bit operations on hashes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift import fixed

_ALL = (1 << 64) - 1
# Bytes of a word that are hashed for all words of a batch at once.
_LONG = 64


def signed64(value: int) -> int:
    """An unsigned 64-bit value as the bigint with the same bits."""
    return value - (1 << 64) if value >= 1 << 63 else value


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def _fnv1a64_of(words: pa.Array) -> np.ndarray:
    """FNV-1a of each word's bytes, place by place over all words together;
    what words have beyond ``_LONG`` bytes is added word by word."""
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    starts, lengths = offsets[:-1], np.diff(offsets)
    raw = words.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    order = np.argsort(-lengths, kind="stable")
    ranked = lengths[order]
    found = np.full(len(words), fixed.FNV_OFFSET_BASIS, np.uint64)
    for place in range(min(int(ranked[0]) if len(ranked) else 0, _LONG)):
        longer = int(np.searchsorted(-ranked, -place, "left"))
        found[:longer] = (found[:longer] ^ data[starts[order[:longer]] + place]) * np.uint64(fixed.FNV_PRIME)
    for i in range(int(np.searchsorted(-ranked, -_LONG, "left"))):
        value, start = int(found[i]), int(starts[order[i]])
        for byte in data[start + _LONG : start + int(ranked[i])].tobytes():
            value = (value ^ byte) * fixed.FNV_PRIME & _ALL
        found[i] = value
    out = np.empty(len(words), np.uint64)
    out[order] = found
    return out.view(np.int64)


@F.arrow_udf(T.LongType())
def _fnv1a64(text: pa.Array) -> pa.Array:
    coded = text.dictionary_encode()
    hashes = pa.array(_fnv1a64_of(coded.dictionary.cast(pa.large_binary())), pa.int64())
    return hashes.take(coded.indices)


def fnv1a64(text: Column) -> Column:
    """64-bit FNV-1a of the UTF-8 bytes; null stays null.

    In Arrow batches, each distinct word of a batch once: as a fold over an
    array of characters it took a thousand times as long.
    """
    return _fnv1a64(text)


def md5_64(text: Column) -> Column:
    """The first 64 bits of the md5 digest."""
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("bigint")


def _md5_64_of(words: pa.Array) -> np.ndarray:
    """``md5_64`` of each word's bytes."""
    digests = b"".join(hashlib.md5(w, usedforsecurity=False).digest() for w in words.to_pylist())
    return np.frombuffer(digests, ">i8")[::2].astype(np.int64)


def xxh64(text: Column) -> Column:
    """Spark's own xxhash64: compiled and by far the cheapest of the three."""
    return F.when(text.isNotNull(), F.xxhash64(text))


# Hashes that tasks can take of the distinct words of a batch, as large_binary.
OF_WORDS = {fnv1a64: _fnv1a64_of, md5_64: _md5_64_of}


def mask_block(hash_: Column, block: int) -> Column:
    """The hash with one of its four 16-bit blocks cleared."""
    if not 0 <= block < len(fixed.BLOCK_MASKS):
        raise ValueError(f"no block {block}")
    return hash_.bitwiseAND(F.lit(signed64(fixed.BLOCK_MASKS[block])).cast("bigint"))


def within_bits(a: Column, b: Column, k: int) -> Column:
    """True if the hashes differ in at most ``k`` bits."""
    return F.bit_count(a.bitwiseXOR(b)) <= k
