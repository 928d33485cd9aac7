"""Harmonic packing of documents into sequences of ``CAPACITY`` tokens.

A length L belongs to the class of its reciprocal capacity, j = CAPACITY // L:
j pieces of the class fit a sequence whatever their exact lengths, so a class
fills its sequences by counting, with j pieces each, and no worker has to know
what another one packs. A length that would leave more than ``SLACK`` of its
class's sequences empty is cut down to the next reciprocal, CAPACITY // (j + 1),
and the rest is classed again; so full sequences are all but without padding.

Of each class at most j - 1 pieces are left over when its last sequence would
not be full. They are few whatever the input (``LEFTOVERS`` bounds their sum)
and are packed together, best fit first, by one task.

Defined results: a null text is empty and has one token, the end; rows of one
id are packed row by row; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagesift.llm.tasks import held, lean, number, rows_of, small_batches, staged, utf8

CAPACITY = 2048
SLACK = 0.02
END_ID = 1
MAX_CACHED = 600_000
# Pre-tokens that the tokenizer gets as one text: a call of its own for each takes longer.
JOINED = 128
# Marks the last id of a pre-token.
WORD_END = "</w>"
SLICE_BYTES = 1 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class long"

# The pre-tokens of the vocabulary file: its pattern, with white space, letters
# and numbers of the code points below ``PLAIN`` written out. Texts with others
# (normal forms, case rules) go to the tokenizer whole.
PLAIN = 0x250
_SPACE = r"\x09-\x0d\x20\x85\xa0"
_LETTERS, _NUMBERS = (re.escape("".join(c for c in map(chr, range(PLAIN)) if unicodedata.category(c)[0] == kind)) for kind in "LN")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACE}{_LETTERS}{_NUMBERS}]+")
_OTHER = re.compile(f"[^\x00-{chr(PLAIN - 1)}]")


def leftovers(capacity: int = CAPACITY) -> int:
    """Most pieces that full sequences can leave over."""
    return sum(j - 1 for j in {capacity // n for n in range(1, capacity + 1)})


LEFTOVERS = leftovers()


def cut(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """The pieces ``(length, class)`` of a document of so many tokens."""
    pieces = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        j = capacity // rest
        if j * rest >= (1 - slack) * capacity:
            pieces.append((rest, j))
            break
        pieces.append((capacity // (j + 1), j + 1))
        rest -= capacity // (j + 1)
    return pieces


class Encoder:
    """A text's ids as little-endian 32-bit integers, pre-token by pre-token,
    since a corpus repeats its words and the tokenizer is slow."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.cache: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        """Ids of each pre-token, from texts of many with blanks between them."""
        out = []
        for k in range(0, len(words), JOINED):
            own = words[k : k + JOINED]
            (ids,) = self._ids([" ".join(own)])
            at = 4 * (np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 1)
            if len(at) == len(own) and at[-1] == len(ids):
                out += [ids[a:b] for a, b in zip([0, *at.tolist()], at.tolist())]
            else:  # no such marks, or not one of each
                out += self._ids(own)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [
            None if _OTHER.search(t) or any(s in t for s in self.special) else _PIECES.findall(t.lower()) for t in texts
        ]
        met = set().union(*filter(None, split))
        new = met.difference(self.cache)
        if len(self.cache) + len(new) > MAX_CACHED:
            self.cache.clear()
            new = met
        new = list(new)
        self.cache.update(zip(new, self._ids_of_words(new)))
        get = self.cache.__getitem__
        return [self._ids([t])[0] if pieces is None else b"".join(map(get, pieces)) for t, pieces in zip(texts, split)]


def encoder_of(path: str) -> Encoder:
    """One per worker process, which runs task after task."""
    return held(("word_bpe", path), lambda: Encoder(path))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their classes; ``with_ids`` adds the
    ids themselves, as an array."""
    small_batches(docs.sparkSession)
    end = np.asarray([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for whole in batches:
            for batch in rows_of(whole, SLICE_BYTES, "text"):
                texts = [(t or b"").decode() for t in batch.column("text").to_pylist()]
                rows = []
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                    ids += end
                    total, at = len(ids) // 4, 0
                    for length, j in cut(total, capacity):
                        own = ids[4 * at : 4 * (at + length)]
                        row = (doc_id, at, length, zlib.crc32(own), total, j)
                        rows.append((*row, np.frombuffer(own, "<u4").tolist()) if with_ids else row)
                        at += length
                columns = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:6]] or [pa.array([], pa.int64())] * 6
                names = [f.split()[0] for f in PIECES.split(", ")]
                if with_ids:
                    columns.append(pa.array([r[6] for r in rows], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", utf8().alias("text")).mapInArrow(lean(run, keeps=True), PIECES + ", ids array<long>" * with_ids)


def _best_fit(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """Give each left-over piece a sequence: the fullest that it fits."""
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    lengths = table.column("length").to_pylist()
    rooms: list[tuple[int, int]] = []  # (room, sequence), sorted
    chosen, n = [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        k = bisect.bisect_left(rooms, (lengths[i], -1))
        room, sequence = rooms.pop(k) if k < len(rooms) else (capacity, n)
        n = max(n, sequence + 1)
        chosen[i] = sequence
        if room > lengths[i]:
            bisect.insort(rooms, (room - lengths[i], sequence))
    yield from table.set_column(table.schema.get_field_index("_bin"), "_bin", pa.array(chosen, pa.int64())).to_batches()


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place pieces in sequences: adds ``sequence_id`` and ``offset``."""
    made = staged(made, "pieces")
    columns = made.columns
    sizes = made.groupBy("class").agg(F.count("*").alias("_n"))  # one row per class, at most 2 * sqrt(capacity)
    # Sequences of the classes come one class after the other, left-overs last.
    earlier = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    bins = F.floor(F.col("_n") / F.col("class"))
    bases = [
        (r["class"], r["full"], r["base"], r["_n"])
        for r in sizes.select("class", "_n", (bins * F.col("class")).alias("full"), F.coalesce(F.sum(bins).over(earlier), F.lit(0)).alias("base")).collect()
    ]
    if not bases:
        return made.select(*[c for c in columns if c != "class"], F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    known = made.sparkSession.createDataFrame([b[:3] for b in bases], "class long, _full long, _base long")
    last = max(base + full // j for j, full, base, _ in bases)
    order = [c for c in columns if c not in ("class", "ids")]
    slots = number(made, ["class"], order, "_slot", max(n for *_, n in bases))
    slots = slots.join(F.broadcast(known), "class")
    full = slots.where(F.col("_slot") < F.col("_full")).select(
        *columns, (F.col("_base") + F.floor(F.col("_slot") / F.col("class"))).cast("long").alias("_bin")
    )
    rest = slots.where(F.col("_slot") >= F.col("_full")).select(*columns, F.lit(0).cast("long").alias("_bin"))
    # Behind a shuffle, so that only the left-overs are in one task, not the numbering.
    rest = rest.repartition(1).sortWithinPartitions(F.desc("length"), *order)
    packed = rest.mapInArrow(lean(lambda batches: _best_fit(batches, capacity)), rest.schema)
    both = full.unionByName(packed.withColumn("_bin", F.col("_bin") + last))
    inside = Window.partitionBy("_bin").orderBy(F.desc("length"), *order)
    before = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return both.select(
        *[c for c in columns if c != "class"],
        F.col("_bin").alias("sequence_id"),
        F.coalesce(before, F.lit(0)).cast("long").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces with ``ids``: ids in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
