"""A language model in a log-frequency Bloom filter.

Base: unigrams with a half added to every count. Model: all bigrams, whose counts
are quantised to powers of ``BASE`` and stored in a Bloom filter as the members
``(bigram, 1) .. (bigram, level)`` (Talbot and Osborne). A count is read back by
probing levels until one is missing. A discount is taken off it, and what a
history's bigrams leave goes to the base probability; so does all of a history
that is not in the training texts.

The members are counted first and the filter has ``MEMBER_BITS`` for each, so
that its share of false members (0.7 %) does not depend on the input. A bigram's
bits all lie in one block, so blocks are built by tasks of their own. Texts are
read once for every ``SLICE_BLOCKS`` blocks, which are all of the filter that a
task holds; each bigram is scored in the pass that has its block. Exact counts of
the most frequent words go to every task (``FREQUENT`` at most); tokens with
another word, as word or as history, are joined to the table of all words.

Defined results: a null text is an empty one, with its end as its only token; a
null id is learned from; rows equal in id and text get equal scores; with
nothing to learn from, N and V are 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.llm.shingles import mix, word_hashes
from pagesift.llm.tasks import buffers, groups_of, rows_of, small_batches, staged, utf8
from pagesift.session import new_path, remove

FOLDS, HELD_OUT = 5, 1
FREQUENT = 1 << 19
# Limits nothing: all words have bigrams. The name stays for those who set it.
BIGRAM_WORDS = 1 << 17
MIN_BIGRAM = 1
BASE = 1.6
# Blocks of a filter made by hand; trained ones have as many as they need. Bits
# are cut from hashes, so their number is a power of two.
BLOCKS, BLOCK_BITS = 512, 1 << 19
MEMBER_BITS = 12
SLICE_BLOCKS = 2048
HASHES = 4
# Below 1, or pairs seen once would count as not seen.
DISCOUNT = 0.75
LEAST_LEFT = 0.02
SLICE_BYTES = 2 << 20
CHUNK = 3_000_000
PAIR_ROWS = 20_000
END = np.uint64(0x5E6D0F3A1B2C4D97)
KEY, LEVEL = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
# Leading bits of a word's hash by which frequent words are found.
LEADING = 20
THRESHOLDS = [*range(1, 17), *(2**k for k in range(5, 60))]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of the texts, each text followed by an end; and the text of each."""
    words, at = word_hashes(data, offsets)
    sizes = np.diff(at) + 1
    out = np.full(len(words) + len(sizes), END, np.uint64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    if len(words):
        out[np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes - 1)] = words
    return out, text


def _counted(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    key, *others = map(np.concatenate, zip(*parts))
    # What goes with a key is the same wherever it occurs.
    order = np.argsort(key)
    at = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
    n = np.diff(np.append(at, len(key)))
    columns = [c[order[at]] for c in (key, *others)]
    return pa.RecordBatch.from_arrays([*(pa.array(c.view(np.int64)) for c in columns), pa.array(n.astype(np.int64))], names=[*names, "n"])


def _sums(texts: DataFrame, made, names: list[str]) -> DataFrame:
    """Sums over all texts of what ``made`` finds (a key and what goes with it),
    counted in chunks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for batch in rows_of(whole, SLICE_BYTES, "text"):
                found = made(*tokens(*buffers(batch.column("text"))))
                held.append(found)
                size += len(found[0])
                if size > CHUNK:
                    yield _counted(held, names)
                    held, size = [], 0
        if size:
            yield _counted(held, names)

    return texts.mapInArrow(run, ", ".join(f"{x} long" for x in [*names, "n"])).groupBy(*names).agg(F.sum("n").alias("n"))


@dataclass
class Filter:
    """The packed bits of some blocks, from the ``first`` on, of ``blocks``."""

    bits: np.ndarray
    blocks: int = BLOCKS
    first: int = 0

    @staticmethod
    def places(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """Bits of members within their block, a row per hash."""
        h = mix(keys * np.uint64(KEY) + levels.astype(np.uint64) * np.uint64(LEVEL))
        step = mix(h) | np.uint64(1)
        return np.stack([Filter.place(h + np.uint64(k) * step) for k in range(HASHES)])

    @staticmethod
    def place(h: np.ndarray) -> np.ndarray:
        return (h & np.uint64(BLOCK_BITS - 1)).view(np.int64)

    @staticmethod
    def block(keys: np.ndarray, blocks: int = BLOCKS) -> np.ndarray:
        return (mix(keys + np.uint64(0x27D4EB2F165667C5)) % np.uint64(blocks)).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether the keys' blocks are among these."""
        block = self.block(keys, self.blocks) - self.first
        return (block >= 0) & (block < len(self.bits) * 8 // BLOCK_BITS)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """How many levels of each key are members, from the first on."""
        out = np.zeros(len(keys), np.int64)
        live, level = np.arange(len(keys)), 1
        base = (self.block(keys, self.blocks) - self.first) * BLOCK_BITS
        keys = keys * np.uint64(KEY)

        def found(base: np.ndarray, h: np.ndarray) -> np.ndarray:
            at = base + self.place(h)
            return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1

        while len(live):
            h = mix(keys + np.uint64(level * LEVEL % (1 << 64)))
            # Most of the keys that stop here stop at their first bit.
            here = np.flatnonzero(found(base, h))
            live, keys, base, h = live[here], keys[here], base[here], h[here]
            step = mix(h) | np.uint64(1)
            member = np.ones(len(live), np.uint8)
            for _ in range(HASHES - 1):
                h = h + step
                member &= found(base, h)
            here = np.flatnonzero(member)
            live, keys, base = live[here], keys[here], base[here]
            out[live] = level
            level += 1
        return out


def level_of(n: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(n / MIN_BIGRAM) / np.log(BASE) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """The least count of a level; 0 of none."""
    return np.where(level > 0, MIN_BIGRAM * BASE ** (level - 1.0), 0.0)


def seen_of(level: np.ndarray) -> np.ndarray:
    """What a history's count gives to a bigram of a level."""
    return np.maximum(count_of(level) - DISCOUNT, 0.0)


@dataclass
class Model:
    frequent: np.ndarray  # sorted word hashes
    counts: np.ndarray
    left: np.ndarray  # of each of those, as a history: what its bigrams leave
    blocks: int  # of the filter
    n: int
    v: int

    @property
    def total(self) -> float:
        return self.n + 0.5 * (self.v + 1)

    @cached_property
    def _starts(self) -> np.ndarray:
        """Where the words with each leading bits start, as hashes are even."""
        heads = self.frequent >> np.uint64(64 - LEADING)
        return np.searchsorted(heads, np.arange(1 << LEADING, dtype=np.uint64)).astype(np.int32)

    def find(self, words: np.ndarray) -> np.ndarray:
        """Places among the frequent words, -1 for others."""
        if not len(self.frequent):
            return np.full(len(words), -1)
        last = len(self.frequent) - 1
        at = np.minimum(self._starts[words >> np.uint64(64 - LEADING)], last).astype(np.int64)
        met = self.frequent[at]
        behind = np.flatnonzero((met < words) & (at < last))
        while len(behind):
            at[behind] += 1
            met[behind] = self.frequent[at[behind]]
            behind = behind[(met[behind] < words[behind]) & (at[behind] < last)]
        return np.where(met == words, at, -1)


def bigram_keys(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token the key of its bigram, and its history."""
    first = np.ones(len(words), bool)
    first[1:] = text[1:] != text[:-1]
    history = np.where(first, END, np.roll(words, 1))
    return mix(history + words * np.uint64(0x9E3779B97F4A7C15)), history


def train(docs: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the table ``(word, n, left)`` of all words and the filter's
    table ``(block, bits)``."""
    small_batches(docs.sparkSession)
    texts = docs.where(~held_out(F.col("doc_id"))).select(F.coalesce(utf8(), F.lit(b"")).alias("text"))
    # The largest table; it goes when the filter is built.
    spark, path = docs.sparkSession, new_path(docs.sparkSession, "bigrams")
    sums = _sums(texts, bigram_keys, ["pair", "history"])
    sums.write.parquet(path)
    bigrams = spark.read.schema(sums.schema).parquet(path)
    level = (1 + F.floor(F.log(F.col("n") / MIN_BIGRAM) / math.log(BASE) + 1e-9)).cast("long")
    seen = F.greatest(MIN_BIGRAM * F.pow(F.lit(BASE), F.col("level") - 1) - DISCOUNT, F.lit(0.0))
    levels = bigrams.select("pair", "history", "n", level.alias("level"))
    # A word is a history as often as it occurs, since an end follows the last
    # word; the end is that of each text's first token. So words need no count.
    counted = levels.groupBy(F.col("history").alias("word")).agg(
        F.sum("n").alias("n"), F.sum(seen).alias("taken"), F.sum("level").alias("members")
    )
    left = F.greatest(1 - F.col("taken") / F.col("n"), F.lit(LEAST_LEFT))
    words = staged(counted.select("word", "n", left.alias("left"), "members"), "words")
    sums = [F.count(F.when(F.col("n") >= t, 1)) for t in THRESHOLDS]
    n, v, members, *above = words.agg(F.sum("n"), F.count("*"), F.sum("members"), *sums).collect()[0]
    least = next(t for t, k in zip(THRESHOLDS, above) if k <= FREQUENT)
    table = words.where(F.col("n") >= least).select("word", "n", "left").toArrow()
    frequent, counts, of = (table.column(c).to_numpy() for c in ("word", "n", "left"))
    frequent = frequent.view(np.uint64)
    order = np.argsort(frequent)
    blocks = max(1, -(-int(members or 0) * MEMBER_BITS // BLOCK_BITS))
    model = Model(frequent[order], counts[order], of[order], blocks, int(n or 0), int(v))

    # Pairs by the filter's blocks.
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("pair").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(Filter.block(keys, blocks)), batch.column("pair"), batch.column("level")], names=["block", "pair", "level"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, at in groups_of(batches, ["block"]):
            block, keys, levels = (rows.column(c).to_numpy() for c in ("block", "pair", "level"))
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                own, top = keys[a:b].view(np.uint64), levels[a:b]
                bits = np.zeros(BLOCK_BITS, np.uint8)
                for level in range(1, int(top.max()) + 1):
                    member = own[top >= level]
                    bits[Filter.places(member, np.full(len(member), level))] = 1
                packed = np.packbits(bits, bitorder="little").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([int(block[a])]), pa.array([packed], pa.binary())], names=["block", "bits"])

    small_batches(docs.sparkSession, PAIR_ROWS)
    keyed = levels.select("pair", "level").mapInArrow(dealt, "block long, pair long, level long").repartition("block").sortWithinPartitions("block")
    filter_ = staged(keyed.mapInArrow(build, "block long, bits binary"), "filter")
    small_batches(docs.sparkSession)
    remove(spark, path)
    return model, words, filter_


def slice_of(filter_: DataFrame, blocks: int, first: int) -> Filter:
    """``SLICE_BLOCKS`` blocks of the filter, from the ``first`` on."""
    many = min(SLICE_BLOCKS, blocks - first)
    bits = np.zeros(many * BLOCK_BITS // 8, np.uint8)
    for r in filter_.where(F.col("block").between(first, first + many - 1)).toLocalIterator():
        start = (r["block"] - first) * BLOCK_BITS // 8
        bits[start : start + BLOCK_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return Filter(bits, blocks, first)


# A token that waits for the table of words: word and history (any number where
# they are known), their counts and what the history leaves (null where they are
# not), and what the bigram takes.
RARE = [("word", pa.int64()), ("history", pa.int64()), ("n", pa.int64()), ("of", pa.int64()), ("left", pa.float64()), ("seen", pa.float64())]
SCORED = "doc_id long, key binary, held_out boolean, n_tokens long, known long, base double, score double, rare array<struct<word:long,history:long,n:long,of:long,left:double,seen:double>>"


def _rare(words: np.ndarray, history: np.ndarray, at: np.ndarray, before: np.ndarray, key: np.ndarray, seen: np.ndarray, lm: Model) -> pa.StructArray:
    # Keys of bigrams stand for words that need no join: they are spread evenly.
    known, covered = at >= 0, before >= 0
    counts = lm.counts if len(lm.counts) else np.zeros(1, np.int64)
    left = lm.left if len(lm.left) else np.ones(1)
    columns = [
        pa.array(np.where(known, key, words).view(np.int64)), pa.array(np.where(covered, mix(key), history).view(np.int64)),
        pa.array(counts[at], mask=~known), pa.array(counts[before], mask=~covered), pa.array(left[before], mask=~covered), pa.array(seen),
    ]
    return pa.StructArray.from_arrays(columns, fields=[pa.field(*f) for f in RARE])


def _scored(rows: DataFrame, model: Model, own: Filter) -> DataFrame:
    """Of each text what the bigrams of the filter's slice add; in the first
    slice with the counts and the base of all tokens."""
    shared = rows.sparkSession.sparkContext.broadcast((model, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, filter_ = shared.value
        for whole in batches:
            for batch in rows_of(whole, SLICE_BYTES, "text"):
                words, text = tokens(*buffers(batch.column("text")))
                n = batch.num_rows
                n_tokens = np.bincount(text, minlength=n)
                key, history = bigram_keys(words, text)
                of_slice = filter_.has(key)
                before = None
                if filter_.first:  # the base is of the first pass
                    words, history, key, text = (x[of_slice] for x in (words, history, key, text))
                    of_slice = np.ones(len(words), bool)
                at = lm.find(words)
                if not filter_.first and len(at):  # here a history is the token before, or the end
                    before = np.where(history == END, lm.find(np.array([END]))[0], np.roll(at, 1))
                known = at >= 0
                # Rare words have a base of 1 here; theirs is joined.
                base = np.where(known, (lm.counts[at] + 0.5) / lm.total if len(lm.counts) else 1.0, 1.0)
                words, history, key, at, inner = (x[of_slice] for x in (words, history, key, at, text))
                before = lm.find(history) if before is None else before[of_slice]
                seen = seen_of(filter_.levels(key))
                both = (at >= 0) & (before >= 0)
                left = lm.left[before[both]]
                mixed = left * base[of_slice][both] + np.minimum(seen[both] / lm.counts[before[both]], 1 - left)
                ends = np.concatenate([[0], np.cumsum(np.bincount(inner[~both], minlength=n))])
                rare = _rare(*(x[~both] for x in (words, history, at, before, key, seen)), lm)
                sums = lambda x, to: pa.array(np.bincount(to, weights=x, minlength=n).astype(float))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("key"), batch.column("held_out"), pa.array(n_tokens.astype(np.int64)),
                        pa.array(np.bincount(text[known], minlength=n).astype(np.int64)), sums(np.log10(base), text), sums(np.log10(mixed), inner[both]),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), rare),
                    ],
                    names=["doc_id", "key", "held_out", "n_tokens", "known", "base", "score", "rare"],
                )

    out = staged(rows.mapInArrow(run, SCORED), "scored")
    shared.destroy()
    return out


def score(docs: DataFrame, trained: tuple[Model, DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row per document: its tokens, known tokens, base and model scores."""
    model, words, filter_ = train(docs) if trained is None else trained
    text = F.coalesce(utf8(), F.lit(b""))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"), F.lit(b"/"), text)))
    rows = docs.select("doc_id", key.alias("key"), held_out(F.col("doc_id")).alias("held_out"), text.alias("text"))
    passes = [_scored(rows, model, slice_of(filter_, model.blocks, first)) for first in range(0, model.blocks, SLICE_BLOCKS)]
    scored = passes[0]
    # Equal rows add up under one key; the sums are shared among them.
    waiting, added = (None, scored.select("key", F.lit(1).cast("long").alias("rows"), F.lit(0.0).alias("score")))
    for k, found in enumerate(passes):
        rare = found.where(F.size("rare") > 0).select("key", F.explode("rare").alias("r")).select("key", "r.*")
        waiting = rare if k == 0 else waiting.unionByName(rare)
        if k:
            added = added.unionByName(found.select("key", F.lit(0).cast("long").alias("rows"), "score"))
    of_word = words.select("word", F.col("n").alias("word_n"))
    of_history = words.select(F.col("word").alias("history"), F.col("n").alias("history_n"), F.col("left").alias("history_left"))
    joined = waiting.join(of_word, "word", "left").join(of_history, "history", "left")
    n = F.coalesce("n", "word_n", F.lit(0))
    of = F.coalesce("of", "history_n", F.lit(0))
    left = F.when(of > 0, F.coalesce("left", "history_left")).otherwise(F.lit(1.0))
    was_rare = F.col("n").isNull()
    joined = joined.select("key", was_rare.alias("rare"), ((n + 0.5) / F.lit(model.total)).alias("base"), (n > 0).alias("known"), of.alias("of"), left.alias("left"), "seen")
    mixed = F.col("left") * F.col("base") + F.when(F.col("of") > 0, F.least(F.col("seen") / F.col("of"), 1 - F.col("left"))).otherwise(0.0)
    sums = joined.groupBy("key").agg(
        F.sum(F.when(F.col("rare"), F.log10("base")).otherwise(0.0)).alias("rare_base"),
        F.sum((F.col("rare") & F.col("known")).cast("long")).alias("rare_known"),
        F.sum(F.log10(mixed)).alias("rare_score"),
    )
    added = added.groupBy("key").agg(F.sum("rows").alias("rows"), F.sum("score").alias("more"))
    out = scored.drop("rare").join(sums, "key", "left").join(added, "key")
    share = lambda c: F.coalesce(c, F.lit(0.0)) / F.col("rows")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + share("rare_known")).cast("long").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base") + share("rare_base")).alias("base_score"),
        (F.col("score") + share("rare_score") + share("more")).alias("score"),
    )
