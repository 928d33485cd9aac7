"""64-bit similarity hash of token bags."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.functions.hashing import OF_WORDS, xxh64
from pagesift.operators.words import ROW, keyword_rows, row_key, token_rows

# Bits j and j + 32 of a token hash are counted in the two halves of one long:
# half the sums, half the shuffled bytes. A text has fewer than 2**31 tokens
# (a string holds less than 2 GiB), so neither half can overflow.
_HALF = 32
_PAIR = (1 << _HALF) | 1
_LOW = (1 << _HALF) - 1
# In Arrow batches the bits are counted in 16-bit lanes, four to a number, for
# runs of tokens that cannot overflow them; so many tokens are spread at once.
_LANES = 0x0001_0001_0001_0001
_LONGEST = 0xFFFF
_AT_ONCE = 1 << 14


def simhash_rows(
    rows: DataFrame,
    ids: Sequence[str] = ("fid",),
    token_hash: Callable[[Column], Column] = xxh64,
) -> DataFrame:
    """Similarity hash from one row per token ``(ids, token)``.

    A bit is 1 if more than half of the tokens, repeats counted, have it. A
    null token marks an empty text, whose hash is 0. All tokens of a text meet
    in the map-side aggregation, so only one row per text is shuffled.
    """
    hashed = rows.select(*ids, token_hash(F.col("token")).alias("_h"))
    counts = hashed.groupBy(*ids).agg(
        F.count("_h").alias("_n"),
        *[F.expr(f"sum(shiftrightunsigned(_h, {j}) & {_PAIR}L)").alias(f"_s{j}") for j in range(_HALF)],
    )

    def bit(ones: Column, place: Column) -> Column:
        one = F.when(ones * 2 > F.col("_n"), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        return F.call_function("shiftleft", one, place)

    def two_bits(pair: Column, j: Column) -> Column:
        low = bit(pair.bitwiseAND(F.lit(_LOW)), j)
        return low.bitwiseOR(bit(F.shiftrightunsigned(pair, _HALF), j + _HALF))

    bits = F.transform(F.array(*[F.col(f"_s{j}") for j in range(_HALF)]), two_bits)
    value = F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
    return counts.select(*ids, value.alias("hash"))


def _bit_counts(hashes: np.ndarray, code: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many of each text's tokens have each bit: one row of 64 per text, from
    the hashes of the distinct tokens and the tokens' places there, text by text."""
    spread = (hashes.view(np.uint64)[:, None] >> np.arange(16, dtype=np.uint64)) & np.uint64(_LANES)
    counts = np.zeros((len(lengths), 64), np.int64)
    ends = np.cumsum(lengths)
    for low in range(0, len(code), _AT_ONCE):
        high = min(low + _AT_ONCE, len(code))
        first, last = np.searchsorted(ends, [low, high - 1], "right")
        # Runs begin where a text does, and within a long one.
        begin = np.unique(np.concatenate([np.arange(low, high, _LONGEST), ends[first:last]]))
        text = np.searchsorted(ends, begin, "right")
        lanes = np.add.reduceat(spread[code[low:high]], begin - low, axis=0)
        lanes = (lanes[:, None, :] >> (np.arange(4, dtype=np.uint64) * np.uint64(16))[:, None]) & np.uint64(0xFFFF)
        np.add.at(counts, text, lanes.reshape(len(begin), 64).astype(np.int64))
    return counts


def _hashing(of_words: Callable[[pa.Array], np.ndarray]):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for tokens in batches:
            flat = tokens.flatten().dictionary_encode()
            lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
            code = pc.fill_null(flat.indices, -1).to_numpy(zero_copy_only=False)
            if flat.null_count:
                there = code >= 0
                lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[there], minlength=len(lengths))
                code = code[there]
            counts = _bit_counts(of_words(flat.dictionary.cast(pa.large_binary())), code, lengths)
            bits = np.packbits(counts * 2 > lengths[:, None], axis=1, bitorder="little")
            yield pa.array(bits.view("<i8").reshape(-1), pa.int64())

    return run


def simhash64(
    df: DataFrame,
    ids: Sequence[str] = ("fid",),
    tokens: str = "tokens",
    token_hash: Callable[[Column], Column] = xxh64,
) -> DataFrame:
    """Similarity hash of each row's token array: ``(ids, hash)``.

    Rows that share their ids but not their tokens are kept apart; rows equal in
    both give one row. A costly ``token_hash`` is taken in Arrow batches, of each
    distinct token of a batch once; xxhash64 costs less than the way there.
    """
    rows = df.select(*ids, tokens, row_key(tokens).alias(ROW))
    if token_hash not in OF_WORDS:
        return simhash_rows(token_rows(rows, [*ids, ROW], tokens), [*ids, ROW], token_hash).drop(ROW)
    hash_ = F.arrow_udf(_hashing(OF_WORDS[token_hash]), T.LongType())
    return rows.select(*ids, ROW, hash_(tokens).alias("hash")).groupBy(*ids, ROW).agg(F.first("hash").alias("hash")).drop(ROW)


def simhash_keywords(
    tokens: DataFrame,
    lexicon: DataFrame,
    ids: Sequence[str] = ("fid",),
    token_hash: Callable[[Column], Column] = xxh64,
    **rule,
) -> DataFrame:
    """Similarity hash of the lexicon's keywords: ``(ids, hash)``, 0 for a text
    without any. Each text gets a null token besides, which no bag counts."""
    row = row_key().alias(ROW)
    none = tokens.select(*ids, row, F.lit(None).cast("string").alias("token"))
    kept = keyword_rows(tokens, lexicon, ids, extra=[row], **rule).select(*ids, ROW, "token")
    return simhash_rows(kept.unionByName(none), [*ids, ROW], token_hash).drop(ROW)
