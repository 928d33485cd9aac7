"""Placement of documents on shards by a weighted hash tree.

Regions hold racks, racks hold shards. A document descends the tree: at each
node every child draws ``-ln(u) / weight``, where ``u`` is a hash of the
document's id and the child's name, and the smallest draw wins. A draw depends
on its own child alone, so a changed weight moves documents only into or out of
that child's subtree. A new shard joins as a region of its own: documents move
only to it.

Defined results: a null id is placed like an empty one; rows of one id share a
shard; a null text has 8 bytes and the checksum 0; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.llm.tasks import number, staged

LAW = "key"
ROW_OVERHEAD = 8  # bytes a row takes besides its text


@dataclass(frozen=True)
class ShardTree:
    """``regions[r][k][s]`` is the weight of a shard; shards are numbered in that order."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    @staticmethod
    def even(regions: int, racks: int, shards: int) -> ShardTree:
        return ShardTree((((1.0,) * shards,) * racks,) * regions)

    @property
    def n_shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def with_shard(self, weight: float = 1.0) -> ShardTree:
        """One more shard, as a region and rack of its own."""
        return ShardTree((*self.regions, ((weight,),)))


def _draw(key: Column, node: Column) -> Column:
    """``-ln(u)`` of a child for a key."""
    # 52 bits of an MD5, which every engine has; the half keeps ln finite.
    bits = F.conv(F.substring(F.md5(F.concat_ws("/", node, key).cast("binary")), 1, 13), 16, 10)
    return -F.ln((bits.cast("double") + 0.5) / F.lit(float(16**13)))


def _winner(key: Column, prefix: Column | None, weights: Column, n: int) -> Column:
    """The child with the smallest draw; ``weights`` are those of the children."""
    draws = []
    for i in range(n):
        name = F.lit(str(i)) if prefix is None else F.concat(prefix, F.lit(f".{i}"))
        weight = F.get(weights, F.lit(i))
        draws.append(F.struct(F.when(weight > 0, _draw(key, name) / weight).otherwise(F.lit(float("inf"))).alias("draw"), F.lit(i).alias("i")))
    return (F.least(*draws) if n > 1 else draws[0])["i"]


def _literal(values) -> Column:
    if isinstance(values, (tuple, list)):
        return F.array(*[_literal(v) for v in values])
    return F.lit(values)


def with_shard_of(docs: DataFrame, key: Column, tree: ShardTree, name: str) -> DataFrame:
    """Adds the shard that the key (a string column) falls on."""
    regions = tree.regions
    n_racks = max(len(r) for r in regions)
    n_leaves = max(len(k) for r in regions for k in r)
    padded = [[[*k, *[0.0] * (n_leaves - len(k))] for k in r] + [[0.0] * n_leaves] * (n_racks - len(r)) for r in regions]
    rack_weights = [[float(sum(k)) for k in r] for r in padded]
    firsts, at = [], 0
    for r in regions:
        firsts.append([])
        for k in r:
            firsts[-1].append(at)
            at += len(k)
        firsts[-1] += [at] * (n_racks - len(r))
    # One projection per level, so that a level's draws are made once.
    region, rack, leaf = f"_{name}_region", f"_{name}_rack", f"_{name}_leaf"
    out = docs.withColumn(region, _winner(key, None, _literal([float(sum(r)) for r in rack_weights]), len(regions)))
    of_region = F.get(_literal(rack_weights), F.col(region))
    out = out.withColumn(rack, _winner(key, F.col(region).cast("string"), of_region, n_racks))
    of_rack = F.get(F.get(_literal([[[float(w) for w in k] for k in r] for r in padded]), F.col(region)), F.col(rack))
    out = out.withColumn(leaf, _winner(key, F.concat_ws(".", region, rack), of_rack, n_leaves))
    first = F.get(F.get(_literal(firsts), F.col(region)), F.col(rack))
    return out.withColumn(name, (first + F.col(leaf)).cast("int")).drop(region, rack, leaf)


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def place(docs: DataFrame, tree: ShardTree) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with its shard, its slot in
    the shard, and its shard once the tree has one shard more."""
    placed = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_OVERHEAD).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit(LAW).alias("law"),
    )
    placed = with_shard_of(with_shard_of(placed, _key(), tree, "shard"), _key(), tree.with_shard(), "grown_shard")
    placed = staged(placed, "placed")
    return number(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot", max(1, placed.count() // tree.n_shards)).select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )


def write_shards(docs: DataFrame, tree: ShardTree, path: str) -> None:
    """The documents as Parquet, one folder per shard."""
    with_shard_of(docs, _key(), tree, "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
