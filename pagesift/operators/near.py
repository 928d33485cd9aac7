"""Groups of hashes that differ in one bit.

All operators take groups, one row per distinct hash, never raw texts. Hashes
that agree on all but one 16-bit block form a bucket, and since they are
distinct a bucket has at most 65,536 of them however large the table is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.functions.hashing import let, mask_block, signed64, within_bits
from pagesift.operators.lookup import HOT_KEYS, attach
from pagesift.operators.near_bits import pairs_within
from pagesift.session import stage

BLOCKS = range(len(fixed.BLOCK_MASKS))
_BLOCK_BITS = 16
# Larger buckets are merged by neighbour look-up instead of a fold.
SMALL_BUCKET = 512


def _check(k: int) -> None:
    # One free block of four finds every pair only if all differing bits are in
    # one block, which is certain for a single bit.
    if k != 1:
        raise ValueError("three equal blocks of four find all pairs for k = 1 only")


def near_pairs(groups: DataFrame, k: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Every pair of hashes one bit apart, once: ``(by, fid_a, fid_b, hash_a, hash_b)``;
    for more bits see ``near_bits``.

    Buckets with one hash are dropped right after the shuffle. In the others
    each hash is filed under each bit of the free block cleared; two hashes
    share such a key exactly if they differ in that bit. So a key has at most
    two rows and no pair is formed only to be thrown away. The keys lie within
    buckets, so this needs no second shuffle.
    """
    if k > 1:
        return pairs_within(groups, k, by)
    _check(k)
    by = list(by)
    blocks = F.explode_outer(
        F.array(
            *[
                F.struct(F.lit(b).alias("block"), mask_block(F.col("hash"), b).alias("masked"))
                for b in BLOCKS
            ]
        )
    )
    filed = groups.select(*by, "fid", "hash", blocks.alias("b")).select(*by, "fid", "hash", "b.*")
    bucket = Window.partitionBy(*by, "block", "masked")
    shared = filed.withColumn("_rows", F.count("*").over(bucket)).where(F.col("_rows") > 1)

    # Block b is the b-th from the top.
    lowest = 64 - _BLOCK_BITS * (F.col("block") + 1)
    in_block = F.sequence(lowest, lowest + _BLOCK_BITS - 1)
    powers = F.array(*[F.lit(signed64(1 << bit)).cast("bigint") for bit in range(64)])
    keyed = shared.select(*by, "block", "masked", "fid", "hash", F.explode_outer(in_block).alias("bit"))
    cleared = F.col("hash").bitwiseAND(F.bitwise_not(powers[F.col("bit")]))
    row = F.struct("fid", "hash")
    pairs = (
        keyed.groupBy(*by, "block", "masked", "bit", cleared.alias("_cleared"))
        .agg(F.min(row).alias("a"), F.max(row).alias("b"), F.count("*").alias("_rows"))
        .where(F.col("_rows") == 2)
    )
    return pairs.select(
        *by,
        F.col("a.fid").alias("fid_a"),
        F.col("b.fid").alias("fid_b"),
        F.col("a.hash").alias("hash_a"),
        F.col("b.hash").alias("hash_b"),
    )


def group_top(groups: DataFrame, block: int, by: Sequence[str] = ()) -> DataFrame:
    """The largest group of each bucket (smaller fid on a tie)."""
    return (
        groups.withColumn("masked", mask_block(F.col("hash"), block))
        .groupBy(*by, "masked")
        .agg(F.min(F.struct((-F.col("samelen")).alias("neg"), "fid", "hash")).alias("top"))
        .select(*by, "masked", "top.fid", "top.hash", (-F.col("top.neg")).alias("samelen"))
    )


def _merge_small(hashes: Column, k: int) -> Column:
    """For hashes in greedy order, the positions of each merged group, its
    leader's first: a fold over the array."""
    none = F.array().cast("array<bigint>")

    def take(leaders: Column, h: Column) -> Column:
        near = F.exists(leaders, lambda lead: within_bits(lead, h, k))
        return F.when(near, leaders).otherwise(F.concat(leaders, F.array(h)))

    def place(leaders: Column) -> Column:
        # A hash belongs to the first leader it is near to; a leader to itself.
        return F.transform(hashes, lambda h: F.filter(leaders, lambda lead: within_bits(lead, h, k))[0])

    def gather(leads: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(leads) - 1)
        return F.transform(
            F.array_distinct(leads), lambda lead: F.filter(places, lambda i: F.get(leads, i) == lead)
        )

    return let(let(F.aggregate(hashes, none, take), place), gather)


def _merge_large(block: int):
    """The same for large buckets, where the fold would be quadratic.

    A hash has 16 neighbours inside its bucket, so each row asks 16 times
    whether a leader is there instead of searching the list of leaders.
    """
    low = 64 - _BLOCK_BITS * (block + 1)
    flips = [signed64(1 << bit) for bit in range(low, low + _BLOCK_BITS)]

    @F.pandas_udf("array<array<int>>")
    def merge(buckets: pd.Series) -> pd.Series:
        def one(hashes):
            if hashes is None:
                return None
            group_of: dict[int, int] = {}
            groups: list[list[int]] = []
            for i, h in enumerate(hashes.tolist()):
                near = [group_of[x] for x in (h, *(h ^ f for f in flips)) if x in group_of]
                if near:
                    groups[min(near)].append(i)
                else:
                    group_of[h] = len(groups)
                    groups.append([i])
            return groups

        return buckets.map(one)

    return merge


def absorb_block(
    groups: DataFrame, block: int, k: int = 1, by: Sequence[str] = (), small_bucket: int = SMALL_BUCKET
) -> DataFrame:
    """Merge the groups of each bucket greedily, largest first.

    In the order of size (then fid) a group joins the first leader within ``k``
    bits, or else becomes a leader. Returns ``(by, fid, hash, absorbed,
    samelen)``: the leader, the fids of the groups it took in this pass (its
    own first, 17 at most) and their total size.

    One shuffle brings a bucket together; the rest happens inside its row, of
    24 bytes per hash and so below 2 MB.
    """
    _check(k)
    by = list(by)
    row = F.struct((-F.col("samelen")).alias("neg"), "fid", "hash")
    buckets = groups.groupBy(*by, mask_block(F.col("hash"), block).alias("_masked")).agg(
        F.array_sort(F.collect_list(row)).alias("_rows")
    )
    rows, in_order = F.col("_rows"), F.col("_rows.hash")
    # The two kinds are branches of their own over one shuffle, so that only
    # large buckets go to Python workers.
    is_large = F.size(rows) > max(small_bucket, 1)
    single = F.array(F.array(F.lit(0)))
    in_row = F.when(F.size(rows) == 1, single).otherwise(_merge_small(in_order, k))
    parts = (
        buckets.where(~is_large).withColumn("_merged", in_row),
        buckets.where(is_large).withColumn("_merged", _merge_large(block)(in_order)),
    )
    # Never empty; the outer explode keeps Catalyst from merging a second time
    # for a non-empty filter.
    taken = parts[0].unionByName(parts[1]).select(
        *by, F.explode_outer(F.transform("_merged", lambda g: F.transform(g, lambda i: F.get(rows, i)))).alias("_taken")
    )
    size = F.aggregate("_taken", F.lit(0).cast("bigint"), lambda total, r: total - r["neg"])
    return taken.select(
        *by,
        F.col("_taken.fid")[0].alias("fid"),
        F.col("_taken.hash")[0].alias("hash"),
        F.col("_taken.fid").alias("absorbed"),
        size.alias("samelen"),
    )


def near_passes(
    groups: DataFrame,
    k: int = 1,
    by: Sequence[str] = (),
    store: Callable[[DataFrame, str], DataFrame] = stage,
) -> list[DataFrame]:
    """The four passes, one per block, each over the leaders of the one before.

    Each is stored, since the next pass and the membership both read it.
    """
    passes = []
    for block in BLOCKS:
        groups = store(absorb_block(groups, block, k, by), f"near_{block}")
        passes.append(groups)
    return passes


def near_groups(groups: DataFrame, k: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """The groups after the last pass; each pass is stored, so that the plan of
    the next one reads its input once."""
    return near_passes(stage(groups, "near_input"), k, by)[-1]


def near_members(
    hashes: DataFrame,
    exact: DataFrame,
    passes: Sequence[DataFrame],
    by: Sequence[str] = (),
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """``(by, leader, samelen, fid)``: every text with the leader of its near group.

    Each pass lists only leaders of the pass before, so the lists are followed
    back from the last pass to the exact groups, by joins on unique ids.
    """
    by = list(by)
    below = passes[-1].select(
        *by, F.col("fid").alias("leader"), F.col("samelen").alias("_total"), F.explode_outer("absorbed").alias("fid")
    )
    for earlier in reversed(passes[:-1]):
        below = below.join(earlier.select(*by, "fid", "absorbed"), [*by, "fid"]).select(
            *by, "leader", "_total", F.explode_outer("absorbed").alias("fid")
        )
    named = exact.join(below, [*by, "fid"]).select(*by, "hash", "samelen", "leader", "_total")
    return attach(hashes.select(*by, "hash", "fid"), named, [*by, "hash"], "samelen", hot_keys).select(
        *by, "leader", F.col("_total").alias("samelen"), "fid"
    )
