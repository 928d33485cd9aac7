"""Hashes and duplicate groups against plain Python on small inputs."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagesift.functions.hashing import fnv1a64, md5_64, signed64, xxh64
from pagesift.operators import exact, near, near_bits, simhash
from pagesift.operators.simhash import simhash64

GROUP = "fid long, hash long, samelen long"


def shown(df):
    return sorted((r.fid, r.hash, r.samelen, r.absorbed) for r in df.collect())


def greedy(rows, block, k=1):
    """rows: (fid, hash, samelen, any) -> (fid, hash, samelen, absorbed) after one pass."""
    mask = ~(0xFFFF << (48 - 16 * block)) & (2**64 - 1)
    buckets = {}
    for r in rows:
        buckets.setdefault(r[1] & mask, []).append(r)
    out = []
    for bucket in buckets.values():
        left = sorted(bucket, key=lambda r: (-r[2], r[0]))
        while left:
            lead = left[0]
            taken = [r for r in left if ((lead[1] ^ r[1]) & (2**64 - 1)).bit_count() <= k]
            out.append((lead[0], lead[1], sum(r[2] for r in taken), [r[0] for r in taken]))
            left = [r for r in left if r not in taken]
    return sorted(out)


def random_rows(n, seed):
    rng = random.Random(seed)
    hashes = set()
    while len(hashes) < n:
        base = rng.choice([0, 0x0123456789ABCDEF, -1, 1 << 40])
        for _ in range(rng.randint(0, 4)):
            base ^= 1 << rng.randint(0, 63)
        hashes.add(signed64(base & (2**64 - 1)))
    return [(i, h, rng.randint(1, 4)) for i, h in enumerate(sorted(hashes))]


CASES = [
    ([(1, 0, 1), (2, 1, 5), (3, 3, 2), (4, 12, 1)], {2: 8, 4: 1}),
    ([(7, 0, 3), (5, 1, 3)], {5: 6}),
    ([(1, 0, 9), (2, 1, 4), (3, 65536, 2)], {1: 15}),
    ([(1, 0, 1), (2, 3, 1)], {1: 1, 2: 1}),
    ([(1, 0, 2), (2, -(2**63), 1)], {1: 3}),
]


@pytest.mark.parametrize("rows,sizes", CASES)
def test_fixture_groups(spark, rows, sizes):
    got = near.near_groups(spark.createDataFrame(rows, GROUP)).collect()
    assert {r.fid: r.samelen for r in got} == sizes


def test_as_built_members_are_the_leaders_of_the_pass_before(spark):
    rows = [(1, 0, 9), (2, 1, 4), (3, 65536, 2)]
    third = near.absorb_block(spark.createDataFrame(rows, GROUP), 2)
    fourth = near.absorb_block(third, 3).collect()
    assert [(r.fid, r.absorbed, r.samelen) for r in fourth] == [(1, [1, 2], 15)]


@pytest.mark.parametrize("small_bucket", [0, 512])
def test_passes_match_brute_force(spark, small_bucket):
    rows = random_rows(600, 11)
    df, model = spark.createDataFrame(rows, GROUP), rows
    for block in near.BLOCKS:
        df = near.absorb_block(df, block, small_bucket=small_bucket)
        model = greedy(model, block)
        assert shown(df) == model


def test_full_buckets_take_both_ways(spark):
    # A whole 13-bit cube in one bucket, larger than a small bucket may be.
    df = spark.range(8192).select(
        F.col("id").alias("fid"), (F.col("id") + 5 * 65536).alias("hash"), (F.pmod(F.xxhash64("id"), F.lit(3)) + 1).alias("samelen")
    )
    rows = [(r.fid, r.hash, r.samelen) for r in df.collect()]
    rows = [r for r in rows if r[0] < 1024]
    part = df.where("fid < 1024")
    assert shown(near.absorb_block(part, 3)) == greedy(rows, 3)
    whole = near.absorb_block(df, 3)
    again = near.absorb_block(df, 3, small_bucket=10000)
    assert shown(whole) == shown(again)


@pytest.mark.parametrize("small_bucket", [0, 512])
def test_equal_hashes_merge_either_way(spark, small_bucket):
    df = spark.createDataFrame([(1, 5, 3), (2, 5, 2), (3, 4, 1)], GROUP)
    got = near.absorb_block(df, 3, small_bucket=small_bucket).collect()
    assert [(r.fid, r.hash, r.samelen) for r in got] == [(1, 5, 6)]


def test_only_large_buckets_go_to_python(spark):
    plan = near.absorb_block(spark.createDataFrame([(1, 5, 3)], GROUP), 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Union" in plan


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_invariants(spark, seed):
    rows = random_rows(400, seed)
    rng = random.Random(seed)
    texts = [(1000 * i + j, h) for i, h, n in rows for j in range(n)]
    rng.shuffle(texts)
    hashes = spark.createDataFrame(texts, "fid long, hash long")
    groups = exact.exact_groups(hashes)
    passes = near.near_passes(groups)
    leaders = passes[-1].collect()
    assert shown(passes[-1]) == shown(near.near_groups(groups))
    assert sum(r.samelen for r in leaders) == len(texts)
    for i, a in enumerate(leaders):
        for b in leaders[i + 1 :]:
            assert ((a.hash ^ b.hash) & (2**64 - 1)).bit_count() > 1
    hash_of, size_of = dict(texts), {r.fid: r.samelen for r in leaders}
    for hot_keys in (1, 1024):
        members = near.near_members(hashes, groups, passes, hot_keys=hot_keys).collect()
        assert sorted(r.fid for r in members) == sorted(hash_of)
        assert all(r.samelen == size_of[r.leader] for r in members)
        assert Counter(r.leader for r in members) == size_of
        for r in members:
            assert ((hash_of[r.leader] ^ hash_of[r.fid]) & (2**64 - 1)).bit_count() <= 4


def test_near_pairs_match_brute_force(spark):
    rows = random_rows(500, 5)
    got = {(r.fid_a, r.fid_b) for r in near.near_pairs(spark.createDataFrame(rows, GROUP)).collect()}
    want = {
        (a[0], b[0])
        for i, a in enumerate(rows)
        for b in rows[i + 1 :]
        if ((a[1] ^ b[1]) & (2**64 - 1)).bit_count() == 1
    }
    assert got == want and want
    with pytest.raises(ValueError):
        near.near_groups(spark.createDataFrame(rows, GROUP), k=2)


@pytest.mark.parametrize("k, max_bucket", [(2, 256), (3, 256), (3, 8), (5, 32)])
def test_pairs_within_more_bits(spark, k, max_bucket):
    """Small buckets make the cutting go on to the last bits."""
    r = random.Random(k)
    hashes = {0, -1}
    for _ in range(25):
        base = r.getrandbits(64)
        hashes |= {signed64(base ^ sum(1 << b for b in r.sample(range(64), r.randrange(k + 2)))) for _ in range(6)}
    # Hashes that agree in all but a few neighbouring bits.
    hashes |= {signed64((0xABCDEF << 40) | x) for x in range(70)}
    rows = [(i, h, 1) for i, h in enumerate(sorted(hashes))]
    days = [(d, *row) for d in ("a", "b") for row in rows]
    got = near_bits.pairs_within(spark.createDataFrame(days, "day string, " + GROUP), k, ["day"], max_bucket)
    want = [
        (d, a[0], b[0], a[1], b[1])
        for d in ("a", "b")
        for i, a in enumerate(rows)
        for b in rows[i + 1 :]
        if ((a[1] ^ b[1]) & (2**64 - 1)).bit_count() <= k
    ]
    assert sorted(map(tuple, got.collect())) == want and len(want) > 1000


def test_pairs_of_many_bits_are_refused(spark):
    rows = spark.createDataFrame([(1, 0, 1)], GROUP)
    assert near.near_pairs(rows, k=3).count() == 0
    for k in (0, 8):
        with pytest.raises(ValueError):
            near.near_pairs(rows, k=k)
    assert near.near_pairs(rows.where("false"), k=3).count() == 0


def test_days_do_not_mix(spark):
    rows = [("d1", 1, 0), ("d1", 2, 1), ("d2", 1, 0), ("d2", 3, 3)]
    hashes = spark.createDataFrame(rows, "stat_date string, fid long, hash long")
    got = near.near_groups(exact.exact_groups(hashes, ("stat_date",)), by=("stat_date",)).collect()
    assert sorted((r.stat_date, r.fid, r.samelen) for r in got) == [("d1", 1, 2), ("d2", 1, 1), ("d2", 3, 1)]


def test_empty_documents(spark):
    hashes = spark.createDataFrame([(3, 0), (1, 0), (2, 0), (4, 9)], "fid long, hash long")
    got = {(r.hash, r.fid, r.samelen) for r in exact.exact_groups(hashes).collect()}
    assert got == {(0, 1, 3), (9, 4, 1)}
    assert exact.exact_groups(hashes, drop_empty=True).count() == 1


def test_members_of_a_hot_group_come_in_parts(spark):
    hashes = spark.range(3000).select(
        F.col("id").alias("fid"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 10 + 100).cast("long").alias("hash")
    )
    groups = exact.exact_groups(hashes)
    for hot_keys in (1, 5, 1024):
        members = exact.exact_members(hashes, groups, hot_keys=hot_keys)
        parts = exact.members_csv(members, per_string=250).collect()
        assert max(len(r.samefid.split(",")) for r in parts) <= 250
        seen = {}
        for r in parts:
            seen.setdefault(r.leader, []).extend(int(x) for x in r.samefid.split(","))
        want = {}
        for r in hashes.collect():
            want.setdefault(r.hash, []).append(r.fid)
        assert {k: sorted(v) for k, v in seen.items()} == {min(v): sorted(v) for v in want.values()}


def _simhash(tokens, hash_of):
    bits = [0] * 64
    for t in tokens:
        h = hash_of(t)
        for j in range(64):
            bits[j] += 1 if h >> j & 1 else -1
    return signed64(sum(1 << j for j in range(64) if bits[j] > 0))


def test_simhash_matches_definition(spark):
    rng = random.Random(4)
    words = [f"w{i}é" for i in range(40)]
    texts = [(i, [rng.choice(words) for _ in range(rng.randint(0, 30))]) for i in range(60)] + [(60, None)]
    df = spark.createDataFrame(texts, "fid long, tokens array<string>")
    md5 = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:16], 16)
    got = {r.fid: r.hash for r in simhash64(df, token_hash=md5_64).collect()}
    assert got == {i: _simhash(t or [], md5) for i, t in texts}
    # Equal bags give equal hashes with every token hash.
    for token_hash in (xxh64, fnv1a64):
        pair = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a", "a", "b"]), (3, [])], "fid long, tokens array<string>")
        h = {r.fid: r.hash for r in simhash64(pair, token_hash=token_hash).collect()}
        assert h[1] == h[2] and h[3] == 0


def test_simhash_of_costly_hashes_unrolls_no_tokens(spark, monkeypatch):
    """Hashes of distinct tokens, counted in batches, give what one row per token
    gives: with null tokens, rows that come twice, and texts longer than a run."""
    texts = [(1, ["a", None, "b"]), (1, ["b"]), (1, ["b"]), (2, []), (3, None), (4, [None]), (None, ["é", "", "a"]),
             (6, ["y"])]
    df = spark.createDataFrame(texts, "fid long, tokens array<string>").coalesce(1)
    for token_hash in (md5_64, fnv1a64):
        made = simhash64(df, token_hash=token_hash)
        assert "Generate" not in made._jdf.queryExecution().optimizedPlan().toString()
        rows = df.select("fid", "tokens", F.xxhash64("tokens").alias("row")).select("fid", "row", F.explode_outer("tokens").alias("token"))
        wanted = simhash.simhash_rows(rows, ["fid", "row"], token_hash).select("fid", "hash")
        assert sorted(map(str, made.collect())) == sorted(map(str, wanted.collect()))
    lengths, code = np.array([0, 3, 9, 0, 1]), np.array([0, 1, 1, 0, 0, 0, 2, 1, 2, 0, 1, 1, 2])
    hashes = np.array([5, -1, 1 << 40])
    bits = (hashes.view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    right = [bits[code[e - n : e]].sum(axis=0).tolist() for n, e in zip(lengths, np.cumsum(lengths))]
    for at_once, run in ((4, 2), (1, 1), (100, 3)):
        monkeypatch.setattr(simhash, "_AT_ONCE", at_once)
        monkeypatch.setattr(simhash, "_LONGEST", run)
        assert simhash._bit_counts(hashes, code, lengths).tolist() == right


@pytest.mark.parametrize("partitions", ["1", "200"])
def test_same_result_for_any_partitioning(spark, partitions):
    rows = random_rows(200, 8)
    texts = [(100 * i + j, h) for i, h, n in rows for j in range(n)]
    before = shown(near.near_groups(exact.exact_groups(spark.createDataFrame(texts, "fid long, hash long"))))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        after = shown(near.near_groups(exact.exact_groups(spark.createDataFrame(texts[::-1], "fid long, hash long"))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert before == after


def test_bucket_of_near_bits_is_compared_at_once(spark):
    """A full bucket has 32,640 pairs: no fold over arrays goes through them."""
    rows = [(i, i << 40, 1) for i in range(256)]
    df = spark.createDataFrame(rows, GROUP)
    made = near_bits.pairs_within(df, 3)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "forall" not in plan
    got = {(r.fid_a, r.fid_b) for r in made.collect()}
    assert got == {(a, b) for a in range(256) for b in range(a + 1, 256) if (a ^ b).bit_count() <= 3}
