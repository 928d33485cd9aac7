"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.llm.tasks import lean, staged

# Links that a task contracts at once. Tables of no more are done with that.
CHUNK = 20_000


def _stars(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Of each ``chunk`` links their components, as links to the smallest node."""

    def contracted(table: pa.Table) -> pa.RecordBatch:
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while parent.setdefault(c, c) != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        for a, b in zip(table.column("a").to_pylist(), table.column("b").to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        found = [(node, root(node)) for node in list(parent)]
        found = [(node, top) for node, top in found if node != top]
        a, b = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        while batch.num_rows:
            held.append(batch.slice(0, chunk - size))
            size += held[-1].num_rows
            batch = batch.slice(held[-1].num_rows)
            if size == chunk:
                yield contracted(pa.Table.from_batches(held))
                held, size = [], 0
    if held:
        yield contracted(pa.Table.from_batches(held))


def _contracted(links: DataFrame, chunk: int) -> DataFrame:
    return staged(links.mapInArrow(lean(lambda b: _stars(b, chunk)), "a long, b long"), "contracted")


def _done(links: DataFrame) -> bool:
    """Is every node hung on one, which hangs on none?"""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where(F.col("up") + F.col("down") > 1).isEmpty()


def components(links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(node, component)`` of links ``(a, b)``; a component is named by its
    smallest node. Nodes without a link to another are not listed.

    Every task first contracts the links that it reads, ``chunk`` at a time, and
    a table of no more than that is done then. Others go on by large and small
    stars in turn (Kiveris et al.): all neighbours above a node are hung on its
    smallest neighbour, then all below; the rounds grow with the logarithm of
    the nodes. A node's neighbours are only aggregated and joined, never listed,
    so a hub is no hot task.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = _contracted(links.where(F.col("a") != F.col("b")).select("a", "b"), chunk)
    if links.count() <= chunk:
        # One partition, as told to Spark once more, which needs no shuffle then.
        links = _contracted(links.coalesce(1), chunk).coalesce(1)
    else:
        links = staged(links.distinct(), "links")
        while not _done(links):
            both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            large = staged(large.where(F.col("a") != F.col("b")).distinct(), "large_star")
            least = large.groupBy("a").agg(F.min("b").alias("m"))
            small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            small = small.unionByName(least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b"))
            links = staged(small.select(high, low).distinct(), "small_star")
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
