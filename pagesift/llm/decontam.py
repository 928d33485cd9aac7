"""Removal of benchmark passages by a generalised suffix automaton.

The items' words build one automaton over all of them (Blumer et al.): a state
stands for the sub-sequences that end at the same places of the items, a suffix
link leads to the longest suffix that ends at more places. Documents stream
through it word by word; the state and the length of the longest match ending
at each word tell which windows of ten item words end there.

A word no item has resets the automaton, so only runs of item words that are
long enough for a window are streamed. The items go to the executors in
automata of at most ``BLOCK_WORDS`` words, so a broadcast is bounded however
many items there are; each document meets every block.

Defined results: a null or empty text has no words and is not contaminated; an
item without words has no window; equal items each count; repeated rows and ids
are judged row by row; other columns of the documents are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.llm.tasks import free_names, lean, rows_of, small_batches, with_texts

WINDOW = 10
# Words of one automaton; it has at most twice as many states.
BLOCK_WORDS = 500_000
# A span is cut when it is this long; a document whose hit words reach the
# coverage is dropped.
MIN_SPAN_WORDS = 1
MAX_COVERAGE = 0.8
SLICE_BYTES = 8 << 20
# Names that no column of the documents has.


def _names(docs: DataFrame) -> list[str]:
    """Columns for the words of a text, the bits of those hit and the items."""
    return free_names(docs, "n_words", "hit_words", "hit_items")


# A-Z to lower case; everything ASCII that is no letter or digit to a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return text.translate(_WORD_BYTES).split() if text else []


class SuffixAutomaton:
    """Of several sequences of word numbers; knows the windows of each item."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.items: list[list[bytes]] = []
        self.n_words = 0
        self.names: list = []
        self._last = 0

    def _extend(self, w: int, last: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, w, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = link[p]
        link[q] = clone
        return clone

    def add(self, name, item: list[bytes]) -> None:
        if not item:
            return
        self.items.append(item)
        self.names.append(name)
        self.n_words += len(item)
        last = 0
        for word in item:
            last = self._extend(self.vocabulary.setdefault(word, len(self.vocabulary)), last)

    def finish(self) -> SuffixAutomaton:
        """For each state, the nearest state up the links (itself included)
        that holds a window, and which items have that window."""
        n = self.window
        self.holders: list[dict[int, list[int]]] = [{} for _ in self.next]  # state -> window length -> items
        for i, item in enumerate(self.items):
            m, state = min(n, len(item)), 0
            for k, word in enumerate(item):
                state = self.next[state][self.vocabulary[word]]
                if k + 1 < m:
                    continue
                s = state
                while self.length[self.link[s]] >= m:
                    s = self.link[s]
                held = self.holders[s].setdefault(m, [])
                if not held or held[-1] != i:
                    held.append(i)
        self.shortest = min((min(n, len(i)) for i in self.items), default=n)
        self.up = [-1] * len(self.next)
        for s in sorted(range(len(self.next)), key=self.length.__getitem__):
            if s:
                p = self.link[s]
                self.up[s] = p if self.holders[p] else self.up[p]
        return self

    def match(self, numbers: list[int], at: int, hits: np.ndarray, found: set[int]) -> None:
        """Stream the word numbers of a run that starts at word ``at`` of its
        document; mark the words of windows, collect the items."""
        nxt, link, length, holders, up = self.next, self.link, self.length, self.holders, self.up
        state = matched = 0
        for i, w in enumerate(numbers, at + 1):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            if matched < self.shortest:
                continue
            s = state
            while s > 0:
                for m, items in holders[s].items():
                    if m <= matched:
                        hits[i - m : i] = True
                        found.update(items)
                s = up[s]


def automata(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> Iterator[SuffixAutomaton]:
    """Automata over all items, each of at most ``BLOCK_WORDS`` words (or one
    item). Items stream through the driver; one automaton is held at a time."""
    current = SuffixAutomaton(window)
    for name, text in items.select(id_col, F.col(text_col).cast("binary")).toLocalIterator():
        item = words(bytes(text) if text is not None else None)
        if current.n_words and current.n_words + len(item) > BLOCK_WORDS:
            yield current.finish()
            current = SuffixAutomaton(window)
        current.add(name, item)
    if current.n_words:
        yield current.finish()


def _scan(text: bytes | None, automaton: SuffixAutomaton) -> tuple[int, np.ndarray, set[int]]:
    tokens = words(text)
    n, found = len(tokens), set()
    hits = np.zeros(n, bool)
    if n >= automaton.shortest:
        known = np.fromiter(map(automaton.vocabulary.get, tokens, [-1] * n), np.int64, n)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], known >= 0, [False])).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long_enough = ends - starts >= automaton.shortest
        for a, b in zip(starts[long_enough].tolist(), ends[long_enough].tolist()):
            automaton.match(known[a:b].tolist(), a, hits, found)
    return n, hits, found


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with the number of words, the packed bits of the hit words
    and the ids of the items found (as strings)."""
    spark = docs.sparkSession
    small_batches(spark)
    kept = docs.columns
    n_words, hit_words, hit_items = _names(docs)
    out = docs.select("*", F.lit(0).cast("long").alias(n_words), F.lit(b"").alias(hit_words), F.array().cast("array<string>").alias(hit_items))
    schema = out.schema
    for automaton in automata(items, window=window):
        shared = spark.sparkContext.broadcast(automaton)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sam = shared.value
            for whole in batches:
                for batch in rows_of(whole, SLICE_BYTES, "text"):
                    counts, bits, names = [], [], []
                    for text, old_bits, old_names in zip(
                        batch.column("text"), batch.column(hit_words).to_pylist(), batch.column(hit_items).to_pylist()
                    ):
                        value = text.as_py()
                        n, hits, found = _scan(value.encode() if isinstance(value, str) else value, sam)
                        if old_bits:
                            hits |= np.unpackbits(np.frombuffer(old_bits, np.uint8), count=n).view(bool)
                        counts.append(n)
                        bits.append(np.packbits(hits).tobytes() if hits.any() else b"")
                        names.append([*(old_names or []), *(str(sam.names[i]) for i in found)])
                    columns = [batch.column(c) for c in kept]
                    columns += [pa.array(counts, pa.int64()), pa.array(bits, pa.binary()), pa.array(names, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, names=[*kept, n_words, hit_words, hit_items])

        out = out.mapInArrow(lean(run), schema)
    return out


def judge(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: how many of its words lie in windows of items."""
    docs = docs.select("doc_id", "text")
    found = scan(docs, items, window)
    n_words, hit_words, hit_items = _names(docs)
    # The bits are counted as the ones of their hexadecimal digits.
    digits = F.hex(hit_words)
    ones = sum(
        (F.length(digits) - F.length(F.translate(digits, d, ""))) * bin(int(d, 16)).count("1") for d in "123456789ABCDEF"
    )
    n_hit = F.coalesce(ones, F.lit(0)).cast("long")
    found_items = F.array_sort(hit_items)
    return found.select(
        "doc_id",
        F.coalesce(n_words, F.lit(0)).cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(hit_items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", found_items).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_ASCII_SEPARATORS = np.array([b < 128 and _WORD_BYTES[b] == 32 for b in range(256)])


def _word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    inside = ~_ASCII_SEPARATORS[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def clean_text(text: str | None, bits: bytes | None, min_span: int = MIN_SPAN_WORDS, max_coverage: float = MAX_COVERAGE) -> str | None:
    """The text without its hit spans of ``min_span`` words or more; None if
    the hit words reach the coverage."""
    if not text or not bits:
        return text
    raw = text.encode()
    starts, ends = _word_spans(raw)
    hits = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(starts)).view(bool)
    if hits.mean() >= max_coverage:
        return None
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hits, [False])).view(np.int8)))
    out, at = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if b - a >= min_span:
            out.append(raw[at : starts[a]])
            at = int(ends[b - 1])
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, min_span: int = MIN_SPAN_WORDS, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """The documents without the spans that items cover. Documents that are
    covered to ``max_coverage`` go. A cut can join words to a window that was
    not there, which ten words across one cut make all but impossible."""
    found = scan(docs, items, window)
    columns = docs.columns
    hit_words = _names(docs)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(hit_words).to_pylist()
            texts = [clean_text(t, b, min_span, max_coverage) for t, b in zip(batch.column("text").to_pylist(), bits)]
            keep = [new is not None or not own for new, own in zip(texts, bits)]
            yield with_texts(batch, columns, texts, [bool(own) for own in bits]).filter(pa.array(keep, pa.bool_()))

    return found.mapInArrow(lean(run), docs.schema)
