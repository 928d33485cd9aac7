"""Removal of repeated passages by suffix arrays of shards.

A byte goes when a ``LENGTH``-byte string that covers it also starts earlier: in
a document with a smaller id, or earlier in the same one. Exact, and no task
needs the whole corpus:

1. Texts that are equal as a whole are one text, its smallest id's.
2. In every window of ``LENGTH`` bytes the smallest hash of its ``ANCHOR``-byte
   strings is its anchor (Schleimer et al.); equal windows have equal anchors,
   so a window whose anchor is met once in all texts has no copy. Anchors are
   counted, and the windows of repeated ones become segments.
3. Equal segments are one segment with its earliest place.
4. Segments are dealt by anchor to shards. A shard's segments become one string,
   its suffix array is induced and the permuted common prefixes tell the runs of
   suffixes that share ``LENGTH`` bytes; all places of a run but the earliest
   are removed.
5. Each text gets its removed ranges back.

An anchor that very many texts have is dealt by its windows' contents instead,
each window a segment of its own.

Defined results: a null text is an empty one; a null id comes before all others;
rows that are equal in id and text are the same place, and so do not remove each
other; different texts of one id are ordered by a hash; texts below ``LENGTH`` bytes lose nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.llm.shingles import mix
from pagesift.llm.suffixes import permuted_lcp, suffix_array
from pagesift.llm.tasks import buffers, free_names, groups_of, lean, rows_of, small_batches, staged, utf8, with_texts

LENGTH = 100
ANCHOR = 32
SLICE_BYTES = 1 << 20  # below 2 ** PLACE_BITS
PLACE_BITS = 22
SHARD_BYTES = 2 << 20
# Texts of one anchor from which on its windows are dealt one by one.
HOT_TEXTS = 50_000
NULL_ID = -(2**63)
# Rows of a table that is broadcast after it was counted.
MAX_BROADCAST = 1_000_000

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = 0xD1342543DE82EF95


def _rolling(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all strings of ``length`` bytes, a power of two."""
    h, width, factor = _BYTE[data], 1, _FACTOR
    while width < length:
        h = h[:-width] * np.uint64(factor) + h[width:]
        width, factor = 2 * width, factor * factor % 2**64
    return mix(h)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values, done = np.minimum(values[:-done], values[done:]), 2 * done
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, start, number of windows, anchor."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.view(np.uint64)
    h = _rolling(data, ANCHOR)
    mask = np.uint64(2**PLACE_BITS - 1)
    out = []
    # A text longer than a slice is taken in pieces that overlap by a window.
    for base in range(0, len(h), SLICE_BYTES):
        part = h[base : base + SLICE_BYTES + LENGTH - ANCHOR]
        if len(part) < LENGTH - ANCHOR + 1:
            break
        # Of equal hashes the first is taken: the low bits are the place.
        key = (part & ~mask) | np.arange(len(part), dtype=np.uint64)
        out.append((_smallest(key, LENGTH - ANCHOR + 1) & mask).astype(np.int64) + base)
    place = np.concatenate(out) if out else none
    start = np.arange(len(place))
    text = np.searchsorted(offsets, start, "right") - 1
    whole = start + LENGTH <= offsets[text + 1]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
    # A run also ends with its piece.
    new[::SLICE_BYTES] = True
    new &= whole
    at = np.flatnonzero(new)
    run = np.cumsum(new)[whole] - 1
    count = np.bincount(run, minlength=len(at))
    return text[at], at - offsets[text[at]], count, h[place[at]]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(anchor, doc, several)``: the distinct anchors of each text."""
    for whole in batches:
        for batch in rows_of(whole, SLICE_BYTES, "text"):
            docs = batch.column("doc").to_numpy()
            text, _, _, anchor = anchors(*buffers(batch.column("text")))
            order = np.lexsort((anchor, text))
            text, anchor = text[order], anchor[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
            at = np.flatnonzero(new)
            several = np.diff(np.append(at, len(text))) > 1
            yield pa.RecordBatch.from_arrays([pa.array(anchor[at].view(np.int64)), pa.array(docs[text[at]]), pa.array(several)], names=["anchor", "doc", "several"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor those whose anchor comes again. One row is held back."""
    last, matched = None, False

    def rows(table: pa.Table, keep: np.ndarray):
        return table.select(["doc", "anchor"]).filter(pa.array(keep)).combine_chunks().to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if last is None else [last, batch])
        anchor = table.column("anchor").to_numpy()
        keep = table.column("several").to_numpy(zero_copy_only=False).copy()
        same = anchor[1:] == anchor[:-1]
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= matched
        yield from rows(table.slice(0, len(anchor) - 1), keep[:-1])
        last = table.slice(len(anchor) - 1).combine_chunks().to_batches()[0]
        matched = bool(keep[-1])
    if last is not None:
        yield from rows(pa.Table.from_batches([last]), np.array([matched or last.column("several")[0].as_py()]))


SEGMENTS = "shard long, segment binary, doc long, key long, start long, windows long, bytes binary"


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of repeated anchors; their bytes once per task."""
    met: set[bytes] = set()
    for whole in batches:
        for batch in rows_of(whole, SLICE_BYTES, "text"):
            docs, keys = (batch.column(c).to_pylist() for c in ("doc", "key"))
            data, offsets = buffers(batch.column("text"))
            text, start, count, anchor = anchors(data, offsets)
            wanted, hot = np.zeros(len(text), bool), np.zeros(len(text), bool)
            edges = np.searchsorted(text, np.arange(len(docs) + 1))
            for flags, name in ((wanted, "repeated"), (hot, "hot")):
                values, at = batch.column(name).values.to_numpy(), batch.column(name).offsets.to_numpy()
                for d in range(len(docs)):
                    if at[d + 1] > at[d]:
                        own = slice(edges[d], edges[d + 1])
                        flags[own] = np.isin(anchor[own].view(np.int64), values[at[d] : at[d + 1]])
            rows = []
            place = offsets[text] + start
            take = np.flatnonzero(wanted)
            for p, t, a, n, anchored, single in zip(place[take].tolist(), text[take].tolist(), start[take].tolist(), count[take].tolist(), anchor[take].view(np.int64).tolist(), hot[take].tolist()):
                for k, width in ((k, 1) for k in range(n)) if single else ((0, n),):
                    own = data[p + k : p + k + width + LENGTH - 1].tobytes()
                    name = hashlib.blake2b(own, digest_size=16).digest()
                    new = name not in met
                    if new:
                        met.add(name)
                    shard = int.from_bytes(name[:8], "little", signed=True) if single else anchored
                    rows.append((shard, name, docs[t], keys[t], a + k, width, own if new else None))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[f.split()[0] for f in SEGMENTS.split(", ")])


def repeated_places(parts: list[bytes], docs: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct segments with their places: segment and offset of every
    window that also starts at an earlier place."""
    lengths = np.array([len(p) for p in parts])
    data = np.frombuffer(b"\xff".join([*parts, b""]), np.uint8)
    s = np.where(data == 0xFF, 1, data + np.uint8(2)).astype(np.uint8)  # UTF-8 has no byte FF
    s = np.append(s, np.uint8(0))
    sa = suffix_array(s, 258)
    lcp = permuted_lcp(s, sa, 4 * LENGTH)
    first = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    segment = np.repeat(np.arange(len(parts)), lengths + 1)
    segment = np.append(segment, len(parts) - 1)
    offset = np.arange(len(s)) - first[segment]
    window = offset + LENGTH <= lengths[segment]
    window[-1] = False
    # Runs of windows that share their bytes stand together in the array.
    joined = np.zeros(len(sa), bool)
    joined[1:] = (lcp[sa[1:]] >= LENGTH) & window[sa[1:]] & window[sa[:-1]]
    run = np.cumsum(~joined)
    several = joined.copy()
    several[:-1] |= joined[1:]
    at, run = sa[several], run[several]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = segment[at]
    order = np.lexsort((starts[own] + offset[at], keys[own], docs[own], run))
    at, run = at[order], run[order]
    later = np.zeros(len(at), bool)
    later[1:] = run[1:] == run[:-1]
    at = at[later]
    return segment[at], offset[at]


RANGES = "doc long, key long, begin long, end long"


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed byte ranges of the segments' first places."""
    parts: list[bytes] = []
    held: list[pa.Table] = []

    def flush() -> pa.RecordBatch:
        doc, key, start = (np.concatenate([t.column(c).to_numpy() for t in held]) for c in ("doc", "key", "start"))
        segment, offset = repeated_places(parts, doc, key, start)
        order = np.lexsort((offset, segment))
        segment, offset = segment[order], offset[order]
        new = np.ones(len(segment), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(segment))[: len(at)] - 1
        own = segment[at]
        columns = (doc[own], key[own], start[own] + offset[at], start[own] + offset[last] + LENGTH)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in RANGES.split(", ")])

    size = 0
    for table, at in groups_of(batches, ["shard"]):
        # One segment's windows differ in where their anchor is.
        several = np.repeat(np.diff(at) > 1, np.diff(at))
        table = table.filter(pa.array(several))
        group = np.repeat(np.arange(len(at) - 1), np.diff(at))[several]
        ends = np.append(np.flatnonzero(np.diff(group)) + 1, table.num_rows) if table.num_rows else []
        values, a = table.column("bytes").to_pylist(), 0
        for b in ends:
            parts += values[a:b]
            held.append(table.slice(a, b - a))
            size += sum(map(len, values[a:b]))
            a = b
            if size > SHARD_BYTES:
                yield flush()
                parts, held, size = [], [], 0
    if parts:
        yield flush()


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(utf8(), F.lit(b""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    return docs.select("doc_id", doc.alias("doc"), text.alias("text"), F.xxhash64(text).alias("key"), F.md5(text).alias("digest"))


def removals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, ranges)``: a narrow row per document with its names ``doc`` and
    ``key``, and ``whole`` if it is a later copy of a whole text; and the
    removed byte ranges of the other documents."""
    small_batches(docs.sparkSession)
    texts = _texts(docs)
    rows = staged(texts.select("doc_id", "doc", "key", "digest", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256")), "texts")
    owners = rows.groupBy("digest").agg(F.min("doc").alias("owner"))
    whole = (F.col("doc") != F.col("owner")) & (F.col("n_bytes") >= LENGTH)
    rows = staged(rows.join(owners, "digest").withColumn("whole", whole).drop("owner", "digest"), "rows")
    # Later whole copies take no part in what follows.
    copies = rows.where("whole").select("doc", "key")
    copies = F.broadcast(copies) if copies.count() <= MAX_BROADCAST else copies
    texts = texts.where(F.octet_length("text") >= LENGTH).select("doc", "key", "text").join(copies, ["doc", "key"], "left_anti")
    found = texts.select("doc", "text").mapInArrow(lean(_anchor_rows), "anchor long, doc long, several boolean")
    repeated = found.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(lean(_repeated), "doc long, anchor long")
    repeated = staged(repeated, "repeated")
    counts = repeated.groupBy("anchor").agg(F.count("*").alias("n"))
    hot = staged(counts.where(F.col("n") > HOT_TEXTS).select("anchor", F.lit(True).alias("is_hot")), "hot")
    hot = F.broadcast(hot) if hot.count() <= MAX_BROADCAST else hot
    of_doc = repeated.join(hot, "anchor", "left").groupBy("doc").agg(
        F.collect_list("anchor").alias("repeated"), F.collect_list(F.when(F.col("is_hot"), F.col("anchor"))).alias("hot")
    )
    segments = staged(texts.join(of_doc, "doc").mapInArrow(lean(_segment_rows), SEGMENTS), "segments")
    place = F.struct("doc", "key", "start")
    first = segments.groupBy("shard", "segment").agg(F.min(place).alias("first"), F.max("bytes").alias("bytes"), F.count("*").alias("n"))
    first = staged(first.select("shard", "segment", "first.*", "bytes", "n"), "firsts")
    own = first.select("shard", "doc", "key", "start", "bytes").repartition("shard").sortWithinPartitions("shard").mapInArrow(lean(_ranges), RANGES)
    firsts = first.where(F.col("n") > 1).select("shard", "segment", place.alias("first"))
    later = segments.drop("bytes").join(firsts, ["shard", "segment"]).where(place != F.col("first"))
    later = later.select("doc", "key", F.col("start").alias("begin"), (F.col("start") + F.col("windows") + (LENGTH - 1)).alias("end"))
    return rows, staged(own.unionByName(later), "ranges")


def _cut(text: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[bytes, int]:
    """The text without the ranges, and how many runs went."""
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, np.minimum(ends, len(text)), -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), runs


def cut_texts(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """``(doc, key, kept, spans)`` of the texts that have removed ranges."""
    by_doc = ranges.groupBy("doc", "key").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, runs = [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                left, n = _cut(text, *(np.array([r[c] for r in own], np.int64) for c in ("begin", "end")))
                kept.append(left)
                runs.append(n)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("key"), pa.array(kept, pa.binary()), pa.array(runs, pa.int64())], names=["doc", "key", "kept", "spans"])

    texts = _texts(docs).select("doc", "key", "text")
    return texts.join(by_doc, ["doc", "key"]).mapInArrow(lean(run), "doc long, key long, kept binary, spans long")


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans`` and ``kept_sha256`` of the bytes that are left."""
    rows, ranges = removals(docs)
    cut = cut_texts(docs, ranges).select("doc", "key", F.octet_length("kept").cast("long").alias("left"), "spans", F.sha2("kept", 256).alias("sha"))
    cut = cut.dropDuplicates(["doc", "key"])
    whole, empty = F.col("whole"), hashlib.sha256(b"").hexdigest()
    return rows.join(cut, ["doc", "key"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.col("n_bytes") - F.coalesce("left", "n_bytes")).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(empty)).otherwise(F.coalesce("sha", "sha256")).alias("kept_sha256"),
    )


def remove(docs: DataFrame) -> DataFrame:
    """The documents without repeated passages. A document that is all passage
    goes; a character that is cut in two goes whole. ``n_chars``, if there is
    such a column, follows the text."""
    rows, ranges = removals(docs)
    columns = docs.columns
    doc, key, cuts = free_names(docs, "doc", "key", "ranges")
    copies = rows.where("whole").select(F.col("doc").alias(doc), F.col("key").alias(key)).distinct()
    copies = F.broadcast(copies) if copies.count() <= MAX_BROADCAST else copies
    by_doc = ranges.groupBy(F.col("doc").alias(doc), F.col("key").alias(key)).agg(F.collect_list(F.struct("begin", "end")).alias(cuts))
    named = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias(doc), F.xxhash64(F.coalesce(utf8(), F.lit(b""))).alias(key))
    joined = named.join(copies, [doc, key], "left_anti").join(by_doc, [doc, key], "left").select(*columns, cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column("text").to_pylist(), []
            ranges = batch.column(cuts).to_pylist()
            for i, own in enumerate(ranges):
                if own:
                    left, _ = _cut(texts[i].encode(), *(np.array([r[c] for r in own], np.int64) for c in ("begin", "end")))
                    texts[i] = left.decode("utf-8", "ignore")
                keep.append(not own or bool(texts[i].strip()))
            yield with_texts(batch, columns, texts, [bool(own) for own in ranges]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(lean(run), docs.schema)
