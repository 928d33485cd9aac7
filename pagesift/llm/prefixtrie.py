"""The trie of all conversations' common beginnings, by ROLLUP.

Every conversation is rebuilt as in a chat log whose sessions were forked: its
first ``h`` turns are those of the first conversation of its block of five, the
rest is its own. A node of the trie is a distinct sequence of first turns.

Turns stand in positional columns, ``WIDTH`` to a block, each with the turn's
id (128 bits of role and text) and length. One ``GROUP BY block, key,
ROLLUP(turn columns)`` counts all prefixes of all blocks together; its
``grouping_id`` says how many turns a prefix has. A long conversation goes on in
further blocks, whose ``key`` names the node where the block before ended: the
exclusive or of hashes of (place, turn), which a running window gives without a
round of jobs for each block.

What a node needs of its subtree comes from its members, so no walk of the tree
is needed. A node belongs to its smallest member, its owner. The nodes of one
owner are the end of its path, from the place where it leaves all smaller
conversations. So sums over a subtree's nodes are sums over its members of what
they own, in a second ROLLUP, less what the owner has above the node.

Hot keys: turns are dealt by ranges of (conversation, turn), so one conversation
may hold any share of the rows; equal conversations are counted before the
shuffle; a node's ends are listed in chunks of ``CHUNK`` ids and hashed one
chunk after the other.

Defined results: rows without ``conv_id`` belong to no conversation and are left
out. Turns come in the order of ``turn``, nulls first, ties by the MD5 of role
and text, so that repeated rows stay. A null role or text is empty. A conversation
left without turns ends at the root. An empty table has no node. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesift.llm.tasks import drop_shuffles, staged
from pagesift.operators.lookup import attach

WIDTH = 8
FAMILY, MAX_HEAD = 5, 8
# Blocks of one conversation that one window orders.
STRIDE = 4096
# Ids of one chunk of a node's ends.
CHUNK = 8192


def _role_and_text() -> Column:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, a, b, n)``: turns by place from 1, with two halves of an
    id and the text's bytes.

    Places are counted inside ranges of (conversation, turn) and the ranges
    before, so no task sorts a whole conversation. Staged.
    """
    text = F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", _role_and_text().alias("tie"), F.octet_length(text).cast("long").alias("n")
    )
    # The last column splits rows that are equal in all others.
    turns = turns.withColumn("any", F.monotonically_increasing_id())
    ranged = turns.repartitionByRange("conv_id", "turn", "tie", "any").withColumn("part", F.spark_partition_id())
    ranged = staged(ranged.drop("any"), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("m"))
    parts = parts.select("conv_id", "part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "tie")
    placed = ranged.withColumn("row", F.row_number().over(inside)).join(parts, ["conv_id", "part"])
    return staged(
        placed.select(
            "conv_id", (F.col("start") + F.col("row")).alias("pos"),
            F.xxhash64(F.lit(1), "tie", "n").alias("a"), F.xxhash64(F.lit(2), "tie", "n").alias("b"), "n",
        ),
        "places",
    )


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations, and the turns of the rebuilt ones, of ordered turns."""
    ids = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MAX_HEAD + 1)
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    ids = ids.select("conv_id", "own", head.alias("h"), first.alias("first"))
    firsts = ids.where(F.col("conv_id") == F.col("first")).select("first", F.col("own").alias("there"))
    ids = staged(
        ids.join(firsts, "first", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0)))).drop("there"), "conversations"
    )
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") <= MAX_HEAD)).withColumnRenamed("conv_id", "first")
    heads = heads.join(ids.select("conv_id", "first", "taken"), "first").where(F.col("pos") <= F.col("taken"))
    rest = turns.join(ids.select("conv_id", "h", "taken"), "conv_id").where(F.col("pos") > F.col("h"))
    rest = rest.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "pos", "a", "b", "n"]
    return ids.select("conv_id"), heads.select(columns).unionByName(rest.select(columns))


def _name(pos: Column, a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """What a turn at a place adds to the name of a node: two halves."""
    return F.xxhash64(pos, a, b), F.xxhash64(b, pos, a)


def blocks(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per conversation and block: ``a0, b0, n0, a1, ...`` with the turns,
    the node ``(k1, k2)`` before the block, the bytes ``above`` it, and the
    conversation's ``turns``, ``total`` bytes and end ``(e1, e2)``. Every
    conversation has block 0, also one without turns. Staged."""
    pos = F.col("pos").cast("long")
    x, y = _name(pos, "a", "b")
    slotted = turns.select("conv_id", F.floor((pos - 1) / WIDTH).alias("block"), ((pos - 1) % WIDTH).alias("slot"), "a", "b", "n", x.alias("x"), y.alias("y"))
    slots = [F.max(F.when(F.col("slot") == i, F.col(c))).alias(f"{c}{i}") for i in range(WIDTH) for c in "abn"]
    wide = slotted.groupBy("conv_id", "block").agg(
        *slots, F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("n").alias("size"), F.count("*").alias("m")
    )
    wide = staged(wide.withColumn("stride", F.floor(F.col("block") / STRIDE)), "blocks")
    sums = [F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("size").alias("size")]
    strides = wide.groupBy("conv_id", "stride").agg(*sums, F.sum("m").alias("m"))
    earlier = Window.partitionBy("conv_id").orderBy("stride").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    starts = strides.select(
        "conv_id", "stride", *[zero(f(c).over(earlier)).alias(f"s_{c}") for f, c in ((F.bit_xor, "x"), (F.bit_xor, "y"), (F.sum, "size"))]
    )
    ends = strides.groupBy("conv_id").agg(
        F.bit_xor("x").alias("e1"), F.bit_xor("y").alias("e2"), F.sum("size").alias("total"), F.sum("m").alias("turns")
    )
    inside = Window.partitionBy("conv_id", "stride").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    named = wide.join(starts, ["conv_id", "stride"]).select(
        "conv_id", "block", *[f"{c}{i}" for i in range(WIDTH) for c in "abn"],
        zero(F.bit_xor("x").over(inside)).bitwiseXOR(F.col("s_x")).alias("k1"),
        zero(F.bit_xor("y").over(inside)).bitwiseXOR(F.col("s_y")).alias("k2"),
        (zero(F.sum("size").over(inside)) + F.col("s_size")).alias("above"),
    )
    counted = ids.join(ends, "conv_id", "left").join(named, "conv_id", "left")
    return staged(counted.fillna(0, ["e1", "e2", "total", "turns", "block", "k1", "k2", "above"]), "named_blocks")


def rollup(rows: DataFrame, **sums: str) -> DataFrame:
    """All nodes: ``depth``, name ``(i1, i2)`` and parent's name ``(p1, p2)``,
    bytes of the last turn and of all turns before it, smallest member, members,
    and the sums of ``sums`` over the members."""
    turn_columns = ", ".join(f"(a{i}, b{i}, n{i})" for i in range(WIDTH))
    more = "".join(f", sum({column}) AS {name}" for name, column in sums.items())
    grouped = rows.sparkSession.sql(
        f"""SELECT block, k1, k2, {", ".join(f"a{i}, b{i}, n{i}" for i in range(WIDTH))}, grouping_id() AS rolled,
            min(conv_id) AS conv_id, count(*) AS n_convs, max(above) AS above{more}
        FROM {{rows}} GROUP BY block, k1, k2, ROLLUP({turn_columns})""",
        rows=rows,
    )
    level = (WIDTH - F.bit_count("rolled") / 3).cast("int")
    grouped = grouped.withColumn("level", level)
    here = F.expr("CASE level " + " ".join(f"WHEN {i + 1} THEN n{i} IS NOT NULL" for i in range(WIDTH)) + " ELSE block = 0 END")
    grouped = grouped.where(here)
    i1, i2, before = F.col("k1"), F.col("k2"), F.col("above")
    last1, last2, last = F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long")
    for i in range(WIDTH):
        x, y = _name(F.col("block") * WIDTH + i + 1, f"a{i}", f"b{i}")
        there = F.col("level") > i
        i1, i2 = i1.bitwiseXOR(F.when(there, x).otherwise(0)), i2.bitwiseXOR(F.when(there, y).otherwise(0))
        before = before + F.when(F.col("level") > i + 1, F.col(f"n{i}")).otherwise(0)
        top = F.col("level") == i + 1
        last1, last2, last = F.when(top, x).otherwise(last1), F.when(top, y).otherwise(last2), F.when(top, F.col(f"n{i}")).otherwise(last)
    return grouped.select(
        "conv_id", (F.col("block") * WIDTH + F.col("level")).cast("long").alias("depth"), i1.alias("i1"), i2.alias("i2"),
        i1.bitwiseXOR(last1).alias("p1"), i2.bitwiseXOR(last2).alias("p2"), last.alias("bytes"), before.alias("before"), "n_convs", *sums,
    )


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's chunks, which come in order: one state, no list."""
    node, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"i1": [node[0]], "i2": [node[1]], "ends_sha256": [state.hexdigest()]})

    for batch in batches:
        for i1, i2, ids in zip(*(batch.column(c).to_pylist() for c in ("i1", "i2", "ids"))):
            if (i1, i2) != node:
                if node:
                    yield done()
                node, state = (i1, i2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if node:
        yield done()


def ends(members: DataFrame) -> DataFrame:
    """``(i1, i2, ends_sha256)`` of the nodes where conversations end, of
    ``(conv_id, e1, e2)``: ids ascending and joined by commas."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = members.groupBy(F.col("e1").alias("i1"), F.col("e2").alias("i2"), F.floor(F.col("conv_id") / CHUNK).alias("chunk"))
    chunks = staged(chunks.agg(F.array_join(ids, ",").alias("ids")), "chunks")
    counts = chunks.groupBy("i1", "i2").agg(F.count("*").alias("m"))
    counted = chunks.join(counts, ["i1", "i2"])
    one = counted.where("m = 1").select("i1", "i2", F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    several = counted.where("m > 1").repartition("i1", "i2").sortWithinPartitions("i1", "i2", "chunk").select("i1", "i2", "ids")
    return one.unionByName(several.mapInArrow(_hash_chunks, "i1 long, i2 long, ends_sha256 string"))


def nodes(conversations: DataFrame) -> DataFrame:
    """A row per node of the trie of the rebuilt conversations."""
    drop_shuffles(conversations.sparkSession)
    ids, turns = rebuild(ordered_turns(conversations))
    rows = blocks(ids, turns)
    members = rows.where("block = 0").select("conv_id", "turns", "total", "e1", "e2")

    found = staged(rollup(rows), "nodes")
    # Each owner's nodes; the first hangs on a node of another, a branch of it.
    owners = found.where("depth > 0").groupBy("conv_id").agg(
        F.sum("bytes").alias("owned"), F.min("depth").alias("first"), F.min_by("p1", "depth").alias("p1"), F.min_by("p2", "depth").alias("p2")
    )
    owners = staged(owners, "owners")
    branches = owners.groupBy(F.col("p1").alias("i1"), F.col("p2").alias("i2")).agg(F.count("*").alias("branches"))
    parents = found.select("i1", "i2", F.col("conv_id").alias("parent")).join(branches, ["i1", "i2"])
    parents = staged(parents.withColumnsRenamed({"i1": "p1", "i2": "p2"}), "parents")
    owners = attach(owners, parents, ["p1", "p2"], "branches").select("conv_id", "owned", "first", "parent")
    inner = parents.select(F.col("p1").alias("e1"), F.col("p2").alias("e2"), F.lit(True).alias("inner"))
    each = members.join(owners, "conv_id", "left").join(inner, ["e1", "e2"], "left")
    leaf = F.col("first").isNotNull() & F.col("inner").isNull()
    each = staged(each.withColumns({"owned": F.coalesce("owned", F.lit(0)), "leaf": leaf.cast("long")}), "members")

    summed = rollup(rows.join(each.select("conv_id", "owned", "leaf"), "conv_id"), all_bytes="total", own_bytes="owned", leaves="leaf")
    owner = each.select("conv_id", "turns", "first", "parent", (F.col("total") - F.col("owned")).alias("base"))
    root = F.col("depth") == 0
    shared = F.when(root, 0).otherwise(F.col("before") - F.col("base"))
    return (
        summed.join(owner, "conv_id")
        .join(parents.select(F.col("p1").alias("i1"), F.col("p2").alias("i2"), "branches"), ["i1", "i2"], "left")
        .join(ends(each.select("conv_id", "e1", "e2")), ["i1", "i2"], "left")
        .select(
            "conv_id",
            "depth",
            F.when(~root, F.when(F.col("depth") == F.col("first"), F.col("parent")).otherwise(F.col("conv_id"))).alias("parent_conv_id"),
            "n_convs",
            (F.coalesce("branches", F.lit(0)) + (~root & (F.col("depth") < F.col("turns"))).cast("long")).alias("n_children"),
            F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"),
            (F.col("all_bytes") - F.col("n_convs") * F.col("before") - F.col("own_bytes") + shared).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
