"""Groups of equal hashes and their members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.operators.lookup import HOT_KEYS, attach


def exact_groups(hashes: DataFrame, by: Sequence[str] = (), drop_empty: bool = False) -> DataFrame:
    """``(by, hash, fid, samelen)``: smallest member and size of each hash.

    Empty texts all have hash 0 and form one group unless ``drop_empty``. Both
    aggregates combine before the shuffle, so a group of any size is one row
    per map task.
    """
    if drop_empty:
        hashes = hashes.where(F.col("hash") != 0)
    return hashes.groupBy(*by, "hash").agg(F.min("fid").alias("fid"), F.count("*").alias("samelen"))


def exact_members(
    hashes: DataFrame, groups: DataFrame, by: Sequence[str] = (), hot_keys: int = HOT_KEYS
) -> DataFrame:
    """``(by, hash, leader, samelen, fid)``: one row per text, never an array."""
    named = groups.select(*by, "hash", F.col("fid").alias("leader"), "samelen")
    return attach(hashes.select(*by, "hash", "fid"), named, [*by, "hash"], "samelen", hot_keys).select(
        *by, "hash", "leader", "samelen", "fid"
    )


def members_csv(
    members: DataFrame,
    by: Sequence[str] = (),
    per_string: int = fixed.MEMBERS_PER_STRING,
) -> DataFrame:
    """``(by, leader, samelen, part, samefid)``: members as comma strings.

    A group is spread by a hash of the member over as many parts as keep each
    about half full, so nothing is cut off and no task holds a whole large group.
    """
    parts = F.ceil(F.col("samelen") * 2 / per_string)
    part = F.conv(F.substring(F.md5(F.col("fid").cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % parts
    return (
        members.withColumn("part", part.cast("int"))
        .groupBy(*by, "leader", "samelen", "part")
        .agg(F.array_sort(F.collect_list("fid")).alias("_fids"))
        .select(
            *by, "leader", "samelen", "part", F.concat_ws(",", F.col("_fids").cast("array<string>")).alias("samefid")
        )
    )
