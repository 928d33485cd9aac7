"""Words grouped by spelling, in neighbourhoods that Bloom filters cut down.

Two words are near when one edit (a code point inserted, deleted or replaced)
turns one into the other. A word's form is its most frequent near word, if that
one is ``RATIO`` times as frequent as the word; its root is where forms end.

1. **Count.** Runs of letters are counted where the texts are, whole texts
   chunk by chunk; counts are summed by Spark.
2. **Filter.** The words' hashes fill blocked Bloom filters, one for each length
   (the longest share one): a word has one bit in each of the eight lanes
   of a 512-bit block. Segments of blocks are filled in tasks.
3. **Probe.** Filters are broadcast, a slice of segments (64 MB) at a time, so a broadcast has one size however many words there are. Words whose
   edits have a length in the slice generate them, replacements by later letters
   and deletions, as hashes: a polynomial hash takes an edit as one addition, so
   no string is made. An insertion is a deletion of the other word, a replacement
   by an earlier letter is one by a later letter.
4. **Join.** Only edits that a filter holds are spelled out, shuffled and joined
   to the vocabulary, which removes the false positives. A true pair is found
   once, from one of its words.
5. **Roots.** Forms grow in frequency, so they make no circles; each round
   doubles the steps a word has taken.

A word has at most 90 letters x its length + its length near words, so no group
grows with the corpus. A length class of over one slice is probed slice by slice.

Defined results: a null text has no words, a null id counts as an empty string;
repeated rows count each; an empty table gives no rows; other columns are not
read. The rows of the result are words, so column names never clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.llm.tasks import rows_of, small_batches, staged, utf8

LETTERS = "".join(map(chr, (*range(0x61, 0x7B), *range(0xC0, 0x100))))
_RUN = re.compile(f"[A-Z{LETTERS}]+")
_END = re.compile(f"[^A-Z{LETTERS}]")
_LOWER = {i: i + 32 for i in range(65, 91)}
SLIP_EVERY = 199
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5

SLICE_BYTES, CHUNK_CHARS, FLUSH_WORDS = 4 << 20, 1 << 20, 200_000
LANES = 8
BITS_A_WORD = 24
# Edits that are hashed at a time.
PROBES = 1 << 20
WORDS = "word string, n long"
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SALTS = [_U(zlib.crc32(b"lane %d" % i) | 1) for i in range(LANES)]


@dataclass(frozen=True)
class Layout:
    """How the filters are cut: words of ``long`` code points and more share one,
    a task fills ``segment`` blocks, and a broadcast has ``slice_segments``."""

    long: int = 64
    segment: int = 4096
    slice_segments: int = 256


def slipped(prefix: int, word: str) -> str:
    """The word, without a letter if a hash of document and word says so;
    ``prefix`` is the CRC-32 of the document's part."""
    h = zlib.crc32(word.encode(), prefix)
    if h % SLIP_EVERY:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _chunks(text: str) -> Iterator[str]:
    """Parts of a text that end where a run of letters does."""
    at = 0
    while len(text) - at > CHUNK_CHARS:
        end = _END.search(text, at + CHUNK_CHARS)
        if not end:
            break
        yield text[at : end.start()]
        at = end.start()
    yield text[at:] if at else text


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words of all documents."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for whole in batches:
            for batch in rows_of(whole, SLICE_BYTES, "text"):
                for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                    prefix = zlib.crc32(f"{doc}:".encode())
                    for part in _chunks((text or b"").decode(errors="replace")):
                        runs = Counter(_RUN.findall(part.translate(_LOWER)))
                        for run, n in runs.items():
                            if len(run) >= min_length and len(word := slipped(prefix, run)) >= min_length:
                                total[word] += n
                        if len(total) > FLUSH_WORDS:
                            yield flush()
        yield flush()

    texts = docs.where("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), utf8().alias("text"))
    return texts.mapInArrow(count, WORDS).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _points(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(_U).reshape(-1, length)


def _powers(length: int) -> np.ndarray:
    out = np.full(length, _BASE, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        yield length, np.flatnonzero(lengths == length)


def _place(hashes: np.ndarray, length: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of a hash, of so many, and the low half that sets the lanes."""
    h = hashes + _U(length)
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(29)
    return ((h >> _U(32)) * _U(blocks)) >> _U(32), h & _U(0xFFFFFFFF)


def _bit(low: np.ndarray, lane: int) -> np.ndarray:
    return _U(1) << (((low * _SALTS[lane]) & _U(0xFFFFFFFF)) >> _U(26))


def _blocks(words: int, segment: int) -> int:
    """Blocks of a filter for so many words: whole segments, or a power of two."""
    need = max(1, -(-words * BITS_A_WORD // (64 * LANES)))
    return 1 << (need - 1).bit_length() if need < segment else -(-need // segment) * segment


def _segments(words: DataFrame, sizes: dict[int, int], layout: Layout) -> DataFrame:
    """``(shard, segment, bits)``: the filters of all lengths, in segments."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for length, rows in _by_length(words):
                points = _points([words[i] for i in rows.tolist()], length)
                block, low = _place(points @ _powers(length), length, sizes[min(length, layout.long)])
                columns = {"shard": np.full(len(rows), min(length, layout.long)), "segment": (block // _U(layout.segment)).astype(np.int64)}
                columns |= {"block": (block % _U(layout.segment)).astype(np.int64), "low": low.astype(np.int64)}
                yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in columns.items()})

    def fill(table: pa.Table) -> pa.Table:
        bits = np.zeros((layout.segment, LANES), _U)
        block, low = table.column("block").to_numpy(), table.column("low").to_numpy().astype(_U)
        for lane in range(LANES):
            np.bitwise_or.at(bits[:, lane], block, _bit(low, lane))
        shard = table.column("shard")[0].as_py()
        used = bits[: min(layout.segment, sizes[shard])]
        return pa.table({"shard": pa.array([shard], pa.int64()), "segment": table.column("segment").slice(0, 1), "bits": pa.array([used.tobytes()], pa.binary())})

    rows = words.select("word").mapInArrow(hashed, "shard long, segment long, block long, low long")
    return rows.groupBy("shard", "segment").applyInArrow(fill, "shard long, segment long, bits binary")


def _probe(filters: dict, sizes: dict[int, int], hashes: np.ndarray, length: int, shard: int) -> np.ndarray:
    """Places of the hashes of words of ``length`` that the slice's filters hold."""
    first, bits = filters[shard]
    block, low = _place(hashes, length, sizes[shard])
    at = block.astype(np.int64) - first
    left = np.flatnonzero((at >= 0) & (at < len(bits))) if first or len(bits) < sizes[shard] else np.arange(len(hashes))
    for lane in range(LANES):
        left = left[(bits[at[left], lane] & _bit(low[left], lane)) != 0]
    return left


def _edits(words: list[str], length: int, filters: dict, sizes: dict[int, int], long: int) -> Iterator[tuple[int, str]]:
    """Edits of words of one length that the filters hold: ``(word's place, edit)``."""
    letters = np.array([ord(c) for c in LETTERS], _U)
    powers = _powers(length)
    step = max(1, PROBES // (length * len(letters)))
    for start in range(0, len(words), step):
        part = words[start : start + step]
        points = _points(part, length)
        terms = points * powers
        whole = terms.sum(axis=1, dtype=_U)
        if min(length, long) in filters:
            # One letter at a time over bands of places, for words of any length.
            band = max(1, PROBES // (len(part) * len(letters)))
            for lo in range(0, length, band):
                own = points[:, lo : lo + band, None]
                row, place, letter = np.nonzero(letters > own)
                hashes = whole[row] + (letters[letter] - own[row, place, 0]) * powers[lo + place]
                for k in _probe(filters, sizes, hashes, length, min(length, long)).tolist():
                    word, i = part[row[k]], lo + int(place[k])
                    yield start + int(row[k]), word[:i] + LETTERS[letter[k]] + word[i + 1 :]
        if length > 1 and min(length - 1, long) in filters:
            # Of equal letters in a row, one deletion stands for all.
            new = np.ones(points.shape, bool)
            new[:, 1:] = points[:, 1:] != points[:, :-1]
            upto = np.cumsum(terms, axis=1, dtype=_U)
            hashes = (upto - terms) + (whole[:, None] - upto) * _U(_BASE_INVERSE)
            row, place = np.nonzero(new)
            for k in _probe(filters, sizes, hashes[row, place], length - 1, min(length - 1, long)).tolist():
                word, i = part[row[k]], int(place[k])
                yield start + int(row[k]), word[:i] + word[i + 1 :]


def _slices(sizes: dict[int, int], layout: Layout) -> Iterator[list[tuple[int, int]]]:
    """Segments ``(shard, segment)`` of all filters in order, so many a slice."""
    pieces = [(shard, k) for shard in sorted(sizes) for k in range(-(-sizes[shard] // layout.segment))]
    for i in range(0, len(pieces), layout.slice_segments):
        yield pieces[i : i + layout.slice_segments]


def positives(words: DataFrame, layout: Layout = Layout()) -> DataFrame | None:
    """``(word, n, edit)``: edits that the filters hold, among them every pair of
    near words once. ``words`` is read often: stage it. None without words."""
    spark = words.sparkSession
    shard = F.least(F.length("word"), F.lit(layout.long))
    # A row per length, at most ``long``.
    sizes = {r["shard"]: _blocks(r["m"], layout.segment) for r in words.groupBy(shard.alias("shard")).agg(F.count("*").alias("m")).collect()}
    if not sizes:
        return None
    segments = staged(_segments(words, sizes, layout), "filters")
    found = []
    for pieces in _slices(sizes, layout):
        (first, low), (last, high) = pieces[0], pieces[-1]
        after = (F.col("shard") > first) | ((F.col("shard") == first) & (F.col("segment") >= low))
        upto = (F.col("shard") < last) | ((F.col("shard") == last) & (F.col("segment") <= high))
        part = segments.where(after & upto)
        # One slice of the layout.
        bits = {(r["shard"], r["segment"]): r["bits"] for r in part.toLocalIterator()}
        filters = {}
        for s in {s for s, _ in pieces}:
            own = [k for t, k in pieces if t == s]
            size = min(sizes[s], layout.segment)
            filled = b"".join(bits.get((s, k)) or bytes(8 * LANES * size) for k in own)
            filters[s] = (own[0] * layout.segment, filled)
        held = spark.sparkContext.broadcast(filters)

        def probe(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            filters = {s: (at, np.frombuffer(bits, _U).reshape(-1, LANES)) for s, (at, bits) in held.value.items()}
            for batch in batches:
                words, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
                for length, rows in _by_length(words):
                    out = [(int(rows[i]), edit) for i, edit in _edits([words[i] for i in rows.tolist()], length, filters, sizes, layout.long)]
                    columns = [pa.array([words[i] for i, _ in out], pa.string()), pa.array([counts[i] for i, _ in out], pa.int64())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([e for _, e in out], pa.string())], names=["word", "n", "edit"])

        reached = words.where((shard >= first) & (shard <= last + 1))
        found.append(staged(reached.mapInArrow(probe, WORDS + ", edit string"), "edits"))
        held.destroy()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_pairs(words: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """``(word, near, near_n)``: every pair of near words, from both sides."""
    found = positives(words, layout)
    if found is None:
        return words.sparkSession.createDataFrame([], "word string, near string, near_n long")
    known = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    pairs = staged(found.join(known, "edit"), "near_pairs")
    there = pairs.select("word", F.col("edit").alias("near"), F.col("edit_n").alias("near_n"))
    return there.unionByName(pairs.select(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form, of ``(word, form)``."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.drop("moved")
        now = step.drop("moved")


def group(docs: DataFrame, ratio: int = RATIO, layout: Layout = Layout()) -> DataFrame:
    """The words of the documents with forms, roots and counts of near words."""
    words = staged(vocabulary(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = near_pairs(words, layout).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    judged = staged(judged, "judged")
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
