"""Pairs of hashes that differ in up to ``k`` bits, for any small ``k``.

The free bits of a hash, at first all 64, are cut into k + 1 blocks. Two hashes
within k bits agree in one block at least, so hashes are filed under each of
their blocks. A bucket of more than ``MAX_BUCKET`` hashes is cut again, by k + 1
blocks of the bits in which its hashes are not all alike, so that each cut splits
it. Hashes are distinct: a bucket of more than 2**k has more than k such bits, so
no block is empty and the cutting ends. No bucket is cut off, and no list is
longer than ``MAX_BUCKET``, however many hashes there are.

A pair is given by the first block in which it agrees, at every cut, so each
comes once and needs no distinct.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.functions.hashing import signed64
from pagesift.session import stage

MAX_BUCKET = 256
MAX_BITS = 7


def _mask(places: Column) -> Column:
    """The places (0 to 63) as a bigint with those bits."""
    bits = F.array(*[F.lit(signed64(1 << b)).cast("bigint") for b in range(64)])
    return F.aggregate(places, F.lit(0).cast("bigint"), lambda mask, b: mask.bitwiseOR(F.get(bits, b)))


def _cut(rows: DataFrame, keep: Sequence[str], k: int) -> DataFrame:
    """Each hash under each of k + 1 blocks of its free bits: ``path`` names the
    blocks so far, ``fixed`` has their bits, ``earlier`` the masks of blocks
    that a pair must differ in to count here."""
    n = F.size("free")
    start = lambda j: F.floor(n * j / (k + 1)).cast("int")
    rows = rows.withColumn("_parts", F.array(*[F.slice("free", start(j) + 1, start(j + 1) - start(j)) for j in range(k + 1)]))
    rows = rows.withColumn("_masks", F.transform("_parts", _mask))
    child = lambda part, j: F.struct(
        F.concat(F.col("path"), j.cast("string")).alias("path"),
        F.col("fixed").bitwiseOR(F.get("_masks", j)).alias("fixed"),
        F.array_except("free", part).alias("free"),
        F.concat("earlier", F.slice("_masks", 1, j)).alias("earlier"),
    )
    return rows.select(*keep, F.explode_outer(F.transform("_parts", child)).alias("_c")).select(*keep, "_c.*")


def _pairs_of(k: int, by: Sequence[str]):
    """The pairs within each bucket, ``_rows`` of at most ``MAX_BUCKET`` hashes,
    compared all at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.names.index("_rows"))
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
            rows = lists.flatten()
            hashes, earlier = rows.field("hash").to_numpy(zero_copy_only=False), rows.field("earlier")
            left, right, of = [], [], []
            for i in range(batch.num_rows):
                start, end = int(ends[i]), int(ends[i + 1])
                h = hashes[start:end].view(np.uint64)
                unlike = h[:, None] ^ h[None, :]
                near = np.bitwise_count(unlike) <= k
                # Hashes of a bucket have been cut alike.
                for mask in earlier[start].as_py():
                    near &= unlike & np.int64(mask).view(np.uint64) != 0
                a, b = np.nonzero(np.triu(near, 1))
                left.append(a + start)
                right.append(b + start)
                of.append(np.full(len(a), i))
            sides = [pa.array(np.concatenate(x)) for x in (left, right)] if left else [pa.array([], pa.int64())] * 2
            at = pa.array(np.concatenate(of)) if of else pa.array([], pa.int64())
            columns = [batch.column(batch.schema.names.index(c)).take(at) for c in by]
            columns += [rows.field(name).take(side) for name in ("fid", "hash") for side in sides]
            yield pa.RecordBatch.from_arrays(columns, names=[*by, "fid_a", "fid_b", "hash_a", "hash_b"])

    return run


def pairs_within(groups: DataFrame, k: int, by: Sequence[str] = (), max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Every pair of hashes within ``k`` bits, once, the smaller fid first:
    ``(by, fid_a, fid_b, hash_a, hash_b)``. ``groups`` has one row per hash.

    A round per cut; each is stored, and the next one reads only what is left in
    large buckets.
    """
    if not 1 <= k <= MAX_BITS:
        raise ValueError(f"k from 1 to {MAX_BITS}")
    if not 2**k <= max_bucket <= MAX_BUCKET:
        raise ValueError(f"buckets of 2**k to {MAX_BUCKET}")
    by = list(by)
    keep = [*by, "fid", "hash"]
    left = groups.select(
        *keep, F.lit("").alias("path"), F.lit(0).cast("bigint").alias("fixed"),
        F.sequence(F.lit(0), F.lit(63)).alias("free"), F.array().cast("array<bigint>").alias("earlier"),
    )
    kinds = {f.name: f.dataType for f in groups.schema.fields}
    sides = [(c, kinds[c.split("_")[0]]) for c in ("fid_a", "fid_b", "hash_a", "hash_b")]
    shown = T.StructType([T.StructField(c, kind) for c, kind in [*((c, kinds[c]) for c in by), *sides]])
    found = []
    while True:
        bucket = [*by, "path", "key"]
        filed = stage(_cut(left, keep, k).withColumn("key", F.col("hash").bitwiseAND(F.col("fixed"))), "near_bits")
        unlike = F.bit_or("hash").bitwiseXOR(F.bit_and("hash")).alias("_unlike")
        counts = filed.groupBy(*bucket).agg(F.count("*").alias("_n"), unlike).where(F.col("_n") > 1)
        counts = stage(counts, "near_bits_counts")
        small = filed.join(counts.where(F.col("_n") <= max_bucket).select(*bucket), bucket, "left_semi")
        lists = small.groupBy(*bucket).agg(F.array_sort(F.collect_list(F.struct("fid", "hash", "earlier"))).alias("_rows"))
        found.append(lists.select(*by, "_rows").mapInArrow(_pairs_of(k, by), shown))
        large = counts.where(F.col("_n") > max_bucket).drop("_n")
        if large.isEmpty():
            break
        left = filed.join(large, bucket).drop("key")
        left = left.withColumn("free", F.filter("free", lambda b: F.getbit("_unlike", b) == 1)).drop("_unlike")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
