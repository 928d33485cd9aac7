"""Documents that share most of their word shingles, by signature trees.

Two documents link when 100 * intersection >= 85 * union of their shingle sets.
Exact: no link between different sets is missed.

1. Each distinct set is one node. It has a bitmap of its shingles (a large set a
   second one, wide enough for it) and a prefix,
   the first n - ceil(0.85 n) + 1 shingles in one order that all sets share.
   Two linked sets have a prefix shingle in common (each lacks too few of the
   other's), so a cell per prefix shingle holds every linked pair. Shingles
   that many sets have come last in that order, so passages and phrases that
   documents share do not fill cells.
2. Every cell's first set, its hub, is compared with the cell's other sets: a
   number of pairs that grows with the sets. The links give components.
3. What the cells of a hub hold beyond one component is joined with itself: the
   sets are the leaves of a signature tree, whose nodes hold the OR of their bitmaps and
   the range of their sizes; pairs of nodes are followed down together as long
   as the largest possible overlap, the common bits and the shingles that share
   a bit, can reach the least overlap that their sizes ask for. Pairs of nodes
   inside one component are dropped. More sets than one task should hold are
   dealt over pairs of blocks. A first pass, by bitmaps alone, tells which sets have
   a possible partner in another component; only their texts are sent.
4. The task that finds a pair compares the sets, unless links that it found before
   join their components already; so a cell gives fewer links than it has sets,
   however many of its pairs are near.

Defined results: a null or empty text has no shingles and links with nothing;
fewer words than a shingle has make one shingle; equal sets are one node, so
copies link; a component is named by its smallest id that is not null (null if
there is none); repeated rows give a row each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.llm.components import components
from pagesift.llm.shingles import set_id, shingle_sets
from pagesift.llm.tasks import buffers, free_names, groups_of, lean, rows_of, small_batches, staged, utf8

WORDS = 4
PERCENT = 85
BITS = 2048
SLICE_BYTES = 1 << 20
# Frequent shingles, by order of frequency. Which are known changes the work,
# not the result.
MAX_FREQUENT = 1 << 18
MIN_FREQUENT = 32
CHUNK_SHINGLES = 500_000
CHUNK_MIN = 2
# Names of sets that a task remembers, so as to describe a set once.
MAX_MET = 100_000
# Sets of one cell in one task.
CELL = 1024
FANOUT = 8
# Sets of one block of pairs that are compared.
BLOCK_NODES = 1000
# Rows of a table that is broadcast after it was counted.
MAX_BROADCAST = 200_000
MAX_DROPPED = 1_000_000
NULL_ID = -(2**63)


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for whole in batches:
        for batch in rows_of(whole, SLICE_BYTES, "text"):
            yield batch, shingle_sets(*buffers(batch.column("text")), words)


def frequent_shingles(texts: DataFrame, words: int) -> np.ndarray:
    """The most frequent shingles, the rarest of them first. Chunks of a few
    million shingles are counted by themselves and their frequent ones summed."""

    def count(values: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(values), return_counts=True)
        keep = n >= CHUNK_MIN
        return pa.RecordBatch.from_arrays([pa.array(found[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], names=["shingle", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, sets in _sets(batches, words):
            # Copies within a batch count once, as they will be one node.
            new = {s.tobytes(): s for s in sets if len(s)}.values()
            held += new
            size += sum(map(len, new))
            if size >= CHUNK_SHINGLES:
                yield count(held)
                held, size = [], 0
        if held:
            yield count(held)

    sums = texts.select("text").mapInArrow(lean(run), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_FREQUENT)
    top = sums.orderBy(F.desc("n"), "shingle").limit(MAX_FREQUENT).toPandas()
    return top["shingle"].to_numpy(np.int64).view(np.uint64)[::-1].copy()


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def _bitmap(shingles: np.ndarray, size: int) -> bytes:
    bits = np.zeros(size, np.uint8)
    bits[(shingles & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _signature(shingles: np.ndarray) -> bytes:
    """A bitmap of ``BITS``, and for a set that would fill it half one of two
    bits a shingle or more behind it."""
    own = _bitmap(shingles, BITS)
    return own if 2 * len(shingles) <= BITS else own + _bitmap(shingles, 1 << (2 * len(shingles) - 1).bit_length())


class Signatures:
    """The signatures of a batch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        at = offsets[:-1, None] + np.arange(BITS // 8)
        self.maps = data[at].reshape(len(at), BITS // 8).view(np.uint64)
        self.wide = np.diff(offsets) > BITS // 8

    def _folded(self, i: int, size: int) -> np.ndarray:
        own = self.data[self.offsets[i] + BITS // 8 : self.offsets[i + 1]]
        return np.bitwise_or.reduce(own.reshape(-1, size), axis=0)


def _wide_enough(x: Signatures, i: np.ndarray, nx: np.ndarray, y: Signatures, j: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs can be linked by their wide bitmaps, where both have one."""
    keep = np.ones(len(i), bool)
    for k in np.flatnonzero(x.wide[i] & y.wide[j]).tolist():
        a, b = i[k], j[k]
        size = int(min(x.offsets[a + 1] - x.offsets[a], y.offsets[b + 1] - y.offsets[b])) - BITS // 8
        u, v = x._folded(a, size), y._folded(b, size)
        spare = min(int(nx[a] - np.bitwise_count(u).sum()), int(ny[b] - np.bitwise_count(v).sum()))
        most = int(np.bitwise_count(u & v).sum()) + spare
        keep[k] = (100 + percent) * most >= percent * (nx[a] + ny[b])
    return keep


def nodes(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``(doc_id, key, node, n, signature, prefix)`` of all documents, where
    ``key`` is a hash of the text; the last two are null for a set that the task
    has met before."""
    common = frequent_shingles(texts, words)
    order = np.argsort(common)
    shared = texts.sparkSession.sparkContext.broadcast((common[order], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = shared.value
        met: set[int] = set()
        for batch, sets in _sets(batches, words):
            names, sizes, signatures, prefixes = [], [], [], []
            for s in sets:
                name = set_id(s) if len(s) else None
                names.append(name)
                sizes.append(len(s))
                if name is None or name in met:
                    signatures.append(None)
                    prefixes.append(None)
                    continue
                if len(met) >= MAX_MET:
                    met.clear()
                met.add(name)
                want = prefix_size(len(s), percent)
                first = s
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    known = frequent[at] == s
                    if known.any():
                        last = s[known][np.argsort(rank[at[known]])]
                        first = np.concatenate([s[~known], last])
                signatures.append(_signature(s))
                prefixes.append(first[:want].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "key", "node", "n", "signature", "prefix"],
            )

    return texts.mapInArrow(lean(run), "doc_id long, key long, node long, n long, signature binary, prefix array<long>")


CELLS = "cell long, node long, n long, hub long, hub_n long, size long"
# Sizes above are alike.
MANY = 3


def cells(made: DataFrame) -> DataFrame:
    """The nodes of prefix shingles that two nodes or more have, with the first
    as hub; ``size`` counts to ``MANY``. A cell is sorted by Spark and passes
    through its task, which holds no more than a batch of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the cell that goes on: its name, hub, the hub's size and the last node.
        going = None
        held = [np.zeros(0, np.int64)] * 3

        def passed(cell, node, n, last: bool):
            nonlocal going, held
            cell, node, n = (np.concatenate([h, v]) for h, v in zip(held, (cell, node, n)))
            held = [np.zeros(0, np.int64)] * 3
            if not len(cell):
                return None
            # A node comes once per task that met it.
            keep = np.ones(len(cell), bool)
            keep[1:] = (cell[1:] != cell[:-1]) | (node[1:] != node[:-1])
            if going and cell[0] == going[0] and node[0] == going[3]:
                keep[0] = False
            cell, node, n = cell[keep], node[keep], n[keep]
            if not len(cell):
                return None
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            size = np.diff(np.append(first, len(cell)))
            hub, hub_n, more = node[first], n[first], size.copy()
            if going and cell[0] == going[0]:
                hub[0], hub_n[0], more[0] = going[1], going[2], MANY
            end = len(cell)
            going = None
            if not last and more[-1] < MANY:
                # The last cell is too short to tell its size.
                end = int(first[-1])
                held = [v[end:] for v in (cell, node, n)]
            elif not last:
                going = (cell[-1], hub[-1], hub_n[-1], node[-1])
            out = (cell, node, n, np.repeat(hub, size), np.repeat(hub_n, size), np.minimum(np.repeat(more, size), MANY))
            several = out[5][:end] > 1
            return pa.RecordBatch.from_arrays([pa.array(c[:end][several]) for c in out], names=[f.split()[0] for f in CELLS.split(", ")])

        for batch in batches:
            made = passed(*(batch.column(c).to_numpy() for c in ("cell", "node", "n")), last=False)
            if made is not None:
                yield made
        made = passed(*[np.zeros(0, np.int64)] * 3, last=True)
        if made is not None:
            yield made

    postings = made.where(F.col("prefix").isNotNull()).select(F.explode("prefix").alias("cell"), "node", "n")
    return postings.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(lean(run), CELLS)


def least_overlap(n, m, percent: int):
    """Smallest intersection of linked sets of sizes n and m (times 100 + percent, to stay whole)."""
    return percent * (n + m)


class SignatureTree:
    """Levels of nodes over sets that are sorted by size: OR of bitmaps, sizes,
    most shingles that share a bit, and the component if there is only one."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        spare = sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
        self.levels = [(bitmaps, sizes, sizes, spare, comps, np.ones(len(sizes), bool))]
        while len(self.levels[-1][0]) > 1:
            b, lo, hi, s, c, one = self.levels[-1]
            at = np.arange(0, len(b), FANOUT)
            same = np.logical_and.reduceat(one, at) & (np.minimum.reduceat(c, at) == np.maximum.reduceat(c, at))
            self.levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(s, at), c[at], same))

    @property
    def height(self) -> int:
        return len(self.levels) - 1


def _possible(x, i: np.ndarray, y, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of nodes can hold a pair of linked sets of two components."""
    bx, lox, hix, sx, cx, onex = (v[i] for v in x)
    by, loy, hiy, sy, cy, oney = (v[j] for v in y)
    sized = (100 * hix >= percent * loy) & (100 * hiy >= percent * lox)
    most = np.bitwise_count(bx & by).sum(axis=1, dtype=np.int64) + np.minimum(sx, sy)
    apart = ~(onex & oney & (cx == cy))
    return sized & apart & ((100 + percent) * most >= percent * (lox + loy))


def tree_pairs(x: SignatureTree, y: SignatureTree | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that can be linked: of two trees, or within one."""
    own = y is None
    y = x if own else y
    lx, ly = x.height, y.height
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        found_i, found_j = [], []
        for a in range(0, len(i), 4096):
            p, q = i[a : a + 4096], j[a : a + 4096]
            keep = _possible(x.levels[lx], p, y.levels[ly], q, percent)
            if own and lx > 0:
                keep |= (p == q) & ~x.levels[lx][5][p]
            found_i.append(p[keep])
            found_j.append(q[keep])
        i, j = np.concatenate(found_i), np.concatenate(found_j)
        if not len(i) or lx == ly == 0:
            break
        # Go down in the higher tree, in both when they are level.
        down_x, down_y = lx >= ly, ly >= lx
        kids = np.arange(FANOUT)
        if down_x:
            lx -= 1
            i = (i[:, None] * FANOUT + kids).ravel()
            j = np.repeat(j, FANOUT)
            ok = i < len(x.levels[lx][0])
            i, j = i[ok], j[ok]
        if down_y:
            ly -= 1
            j = (j[:, None] * FANOUT + kids).ravel()
            i = np.repeat(i, FANOUT)
            ok = j < len(y.levels[ly][0])
            i, j = i[ok], j[ok]
        if own:
            ok = i <= j
            i, j = i[ok], j[ok]
    if own:
        i, j = i[i < j], j[i < j]
    return i, j


def _possible_pairs(table: pa.Table, at: np.ndarray, signatures: Signatures, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each cell of two blocks the pairs of rows that may be links."""
    n, comp, side = (table.column(c).to_numpy() for c in ("n", "component", "side"))
    crossed, maps = table.column("crossed").to_numpy(), signatures.maps
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        order = a + np.argsort(n[a:b], kind="stable")
        sides = [order[side[order] == s] for s in (0, 1)]
        trees = [SignatureTree(maps[s], n[s], comp[s]) if len(s) else None for s in sides]
        if trees[0] is None or (crossed[a] and trees[1] is None):
            continue
        p, q = tree_pairs(trees[0], trees[1] if crossed[a] else None, percent)
        p, q = sides[0][p], sides[1 if crossed[a] else 0][q]
        keep = _wide_enough(signatures, p, n, signatures, q, n, percent)
        yield p[keep], q[keep]


DEALT = "cell long, i int, j int, side int, crossed boolean, node long, n long, component long"


def _with_partner(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The rows of cells, without bitmaps, that are in a possible pair."""
    for table, at in groups_of(batches, ["cell", "i", "j"]):
        signatures = Signatures(*buffers(table.column("signature").combine_chunks()))
        wanted = np.zeros(table.num_rows, bool)
        for a, b in _possible_pairs(table, at, signatures, percent):
            wanted[a] = wanted[b] = True
        yield from table.select([f.split()[0] for f in DEALT.split(", ")]).filter(pa.array(wanted)).combine_chunks().to_batches()


def _cell_links(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of each cell links that join whatever its links join, from texts."""
    for table, at in groups_of(batches, ["cell", "i", "j"]):
        sets: list[np.ndarray] = []
        for batch in table.to_batches():
            for part in rows_of(batch, SLICE_BYTES, "text"):
                sets += shingle_sets(*buffers(part.column("text")), words)
        signatures = Signatures(*buffers(pa.array(map(_signature, sets), pa.large_binary())))
        node, comp = (table.column(c).to_pylist() for c in ("node", "component"))
        found_a, found_b = [], []
        for left, right in _possible_pairs(table, at, signatures, percent):
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while parent.setdefault(c, c) != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            for a, b in zip(left.tolist(), right.tolist()):
                ra, rb = root(comp[a]), root(comp[b])
                if ra != rb and linked(sets[a], sets[b], percent):
                    parent[max(ra, rb)] = min(ra, rb)
                    found_a.append(node[a])
                    found_b.append(node[b])
        yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])


def linked(u: np.ndarray, v: np.ndarray, percent: int) -> bool:
    """Do two sorted sets share enough? Decided by looking the smaller one up."""
    u, v = (u, v) if len(u) <= len(v) else (v, u)
    common = int((v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u).sum())
    return 100 * common >= percent * (len(u) + len(v) - common)


def _deal(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of each hub's cells without the hub, with components, dealt
    over blocks. Near copies share a hub in most of their cells, so a pair comes
    up once and not in every cell. Where there are many, the sets of the hub's
    component meet only the others."""
    named = (
        members.where(F.col("size") > 2)
        .join(labels.select("node", "component"), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(labels.select(F.col("node").alias("hub"), F.col("component").alias("hub_component")), "hub", "left")
        .withColumn("own", F.col("component") == F.coalesce("hub_component", "hub"))
    )
    rows = named.where(F.col("node") != F.col("hub")).select(F.col("hub").alias("cell"), "node", "n", "component", "own")
    rows = staged(rows.distinct(), "cell_rows")
    counts = rows.groupBy("cell").agg(F.sum(F.col("own").cast("long")).alias("n_own"), F.count("*").alias("n_all"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    counts = counts.where(F.col("c0") != F.col("c1")).drop("c0", "c1")
    rows = rows.join(counts, "cell")
    others = F.greatest(F.ceil((F.col("n_all") - F.col("n_own")) / CELL), F.lit(1)).cast("int")
    owns = F.ceil(F.col("n_own") / CELL).cast("int")
    block = lambda n: F.pmod(F.xxhash64("node"), F.greatest(n, F.lit(1))).cast("int")
    key = lambda i, j, side, crossed: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"), crossed.cast("boolean").alias("crossed"))
    zero, no, yes = F.lit(0), F.lit(False), F.lit(True)
    mine = block(others)
    each_other = F.transform(F.sequence(zero, others - 1), lambda o: key(F.least(mine, o), F.greatest(mine, o), (o < mine).cast("int"), o != mine))
    each_own = F.when(owns > 0, F.transform(F.sequence(zero, owns - 1), lambda a: key(mine, -1 - a, zero, yes))).otherwise(F.array().cast("array<struct<i:int,j:int,side:int,crossed:boolean>>"))
    of_own = F.transform(F.sequence(zero, others - 1), lambda o: key(o, -1 - block(owns), F.lit(1), yes))
    keys = F.when(F.col("n_all") <= CELL, F.array(key(zero, zero, zero, no))).when(F.col("own"), of_own).otherwise(F.concat(each_other, each_own))
    return rows.select("cell", "node", "n", "component", F.explode(keys).alias("k")).select("cell", "k.*", "node", "n", "component")


class Join:
    """The steps over one table of documents."""

    def __init__(self, docs: DataFrame, words: int = WORDS, percent: int = PERCENT):
        small_batches(docs.sparkSession)
        self.words, self.percent = words, percent
        self.texts = docs.select("doc_id", F.xxhash64("text").alias("key"), utf8().alias("text"))
        self.made = staged(nodes(self.texts, words, percent), "nodes")

    def texts_of(self, nodes: DataFrame, count: int) -> DataFrame:
        """``nodes`` (a row per ``node``, ``count`` of them) with a text that has the node's set."""
        met = self.made.where(F.col("signature").isNotNull()).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "key", "node")
        one = met.groupBy("node").agg(F.min("doc").alias("doc"), F.min_by("key", F.struct("doc", "key")).alias("key"))
        chosen = nodes.join(one, "node")
        chosen = F.broadcast(chosen) if count <= MAX_BROADCAST else chosen
        texts = self.texts.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "key", "text").join(chosen, ["doc", "key"])
        # Rows that repeat both id and text are one; a set of several texts has one of them.
        return texts.dropDuplicates(["node"]).drop("doc", "key")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Of pairs ``(a, b, ca, cb)`` of nodes and their components enough
        links ``(a, b)`` to connect whatever the pairs' links connect.

        Nodes fall into blocks, pairs into cells of two blocks. A cell gets the
        texts of its nodes, each once, and then its pairs; a pair whose
        components its links have joined already is not compared.
        """
        words, percent = self.words, self.percent
        small = ["a", "b", "ca", "cb"]
        n_nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct().count()
        blocks = max(1, round((n_nodes / BLOCK_NODES) ** 0.5 + 0.5))
        block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
        first, second = block("a"), block("b")
        placed = pairs.select(F.least(first, second).alias("i"), F.greatest(first, second).alias("j"), *small)
        wanted = placed.select("i", "j", F.col("a").alias("node")).unionByName(placed.select("i", "j", F.col("b").alias("node")))
        wanted = wanted.groupBy("node").agg(F.collect_set(F.struct("i", "j")).alias("at"))
        texts = self.texts_of(wanted, n_nodes)
        none = F.lit(None).cast("long")
        sets = texts.select("node", "text", F.explode("at").alias("k")).select(
            "k.*", F.col("node").alias("a"), none.alias("b"), none.alias("ca"), none.alias("cb"), "text"
        )
        both = sets.unionByName(placed.withColumn("text", F.lit(None).cast("binary")))
        both = both.repartition("i", "j").sortWithinPartitions("i", "j", F.col("text").isNull())

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell, known, parent = None, {}, {}

            def root(c: int) -> int:
                while parent.setdefault(c, c) != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            for whole in batches:
                for batch in rows_of(whole, SLICE_BYTES, "text"):
                    found_a, found_b = [], []
                    texts = batch.column("text")
                    sets = iter(shingle_sets(*buffers(texts), words))
                    is_pair = texts.is_null().to_pylist()
                    for i, j, a, b, ca, cb, pair, own in zip(*(batch.column(c).to_pylist() for c in ("i", "j", *small)), is_pair, sets):
                        if (i, j) != cell:
                            cell, known, parent = (i, j), {}, {}
                        if not pair:
                            known[a] = own
                            continue
                        ra, rb = root(ca), root(cb)
                        if ra == rb:
                            continue
                        if linked(known[a], known[b], percent):
                            parent[max(ra, rb)] = min(ra, rb)
                            found_a.append(a)
                            found_b.append(b)
                    yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

        return both.mapInArrow(lean(compare), "a long, b long")

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Links ``(a, b)`` that connect every component, and the components."""
        members = staged(cells(self.made), "cells")
        percent = self.percent
        signatures = self.made.where(F.col("signature").isNotNull()).select("node", "signature").dropDuplicates(["node"])
        hubs = members.where((F.col("node") != F.col("hub")) & (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")))
        hubs = hubs.select(F.col("hub").alias("a"), F.col("node").alias("b"), F.col("hub_n").alias("na"), F.col("n").alias("nb")).distinct()
        hubs = hubs.join(signatures.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a").join(signatures.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")

        def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
                sa, sb = (Signatures(*buffers(batch.column(c))) for c in ("sa", "sb"))
                spare = [n - np.bitwise_count(s.maps).sum(axis=1, dtype=np.int64) for n, s in ((na, sa), (nb, sb))]
                most = np.bitwise_count(sa.maps & sb.maps).sum(axis=1, dtype=np.int64) + np.minimum(*spare)
                keep = (100 + percent) * most >= percent * (na + nb)
                at = np.flatnonzero(keep)
                keep[at] = _wide_enough(sa, at, na, sb, at, nb, percent)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

        near = hubs.mapInArrow(lean(leaves), "a long, b long").withColumns({"ca": F.col("a"), "cb": F.col("b")})
        near = staged(near, "hub_pairs")
        first = staged(self.verify(near), "hub_links")
        labels = staged(components(first), "hub_components")
        dealt = _deal(members, labels).join(signatures, "node").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
        wanted = staged(dealt.mapInArrow(lean(lambda b: _with_partner(b, percent)), DEALT), "cell_partners")
        partners = wanted.select("node").distinct()
        texts = self.texts_of(partners, partners.count())
        words = self.words
        whole = wanted.join(texts, "node").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
        second = whole.select(*wanted.columns, "text").mapInArrow(lean(lambda b: _cell_links(b, words, percent)), "a long, b long")
        second = staged(second.distinct(), "tree_links")
        return first.unionByName(second), components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(second))

    def groups(self) -> DataFrame:
        """``(doc_id, key, node, n_shingles, component_id)`` of all documents."""
        _, comps = self.links()
        reps = self.made.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("rep"))
        named = reps.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
        named = staged(named, "named")
        linked = named.join(comps.select("node"), "node", "left_semi").groupBy("component").agg(F.min("rep").alias("linked"))
        of_node = named.join(linked, "component", "left").select("node", F.coalesce("linked", "rep").alias("component_id"))
        rows = self.made.select("doc_id", "key", "node", F.col("n").alias("n_shingles"))
        return rows.join(of_node, "node", "left").select(
            "doc_id", "key", "node", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
        )


def judge(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: its number of shingles and its component."""
    return Join(docs, words, percent).groups().select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Of each component the document with its name, the smallest id; documents
    without words stay. Rows equal in id and text are one document."""
    found = Join(docs, words, percent).groups()
    gone = found.where((F.col("n_shingles") > 0) & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    doc, key = free_names(docs, "id", "key")
    gone = staged(gone.select(F.col("doc_id").alias(doc), F.col("key").alias(key)).distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= MAX_DROPPED else gone
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(key)), "left_anti")
