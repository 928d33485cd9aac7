"""Encoding and decoding with a SentencePiece BPE model, with source spans.

* **Normalising.** The model's compiled character map, a double-array trie of
  byte strings with their replacements, is read once into a table. At each place
  of a text the longest prefix that the table has is replaced, any other
  character stays. Every normalised character keeps the place it came from, so
  each piece has its span of bytes of the text itself, whatever was replaced,
  added or removed.
* **Merging.** A pair of pieces that stands next to each other is merged if the
  vocabulary has its sum, best score first, then leftmost. Two characters that
  never stand together in a piece are never merged across, so texts are cut there
  without changing a result: at spaces, and inside long runs. A corpus repeats its
  words, so each worker keeps the ids of those it met, up to ``MAX_CACHED``.
* **Bytes.** A character that no piece has becomes its UTF-8 bytes; the last of
  them has the span.

The model file is read by the driver and goes to the workers with the task, so
no executor needs the path. Texts are encoded part by part and leave in rows of
about ``PART_CHARS`` characters: neither a long text nor its ids are ever one row.

Defined results: a null text is empty and has the begin and the end only; bytes
that are not UTF-8 count as U+FFFD; rows are encoded row by row, also repeated
ones; an empty table gives no rows; of the documents ``doc_id`` and ``text`` are
read, so columns never clash. Models with user-defined or unused pieces, and
those that are not BPE, raise ``ValueError``.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pagesift.llm.tasks import rows_of, small_batches, utf8

SPACE = "▁"
MAX_CACHED = 1_000_000
LONG_RUN = 48
PART_CHARS = 1 << 18
SLICE_BYTES = 4 << 20
ENCODED = "doc_id long, part int, ids array<int>, begins array<long>, ends array<long>"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_byte_pieces long, n_span_bytes long"

# Fixed values of the model format: kinds of pieces, the BPE kind of model.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The numbered fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + size]
        at += size


def character_map(compiled: bytes) -> dict[str, str]:
    """The prefixes of a compiled character map and what replaces them.

    After four bytes with the trie's size come its 32-bit units, then the
    replacements, each ended by a zero. All nodes of a depth are walked at once.
    """
    if not compiled:
        return {}
    (size,) = struct.unpack_from("<I", compiled)
    units = np.frombuffer(compiled, "<u4", size // 4, 4)
    texts = compiled[4 + size :]

    def base(at: np.ndarray) -> np.ndarray:
        unit = units[at].astype(np.int64)
        return at ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    found: dict[str, str] = {}
    nodes, prefixes = base(np.zeros(1, np.int64)), [b""]
    labels = np.arange(1, 256)
    while len(nodes):
        at = nodes[:, None] ^ labels
        inside = at < len(units)
        row, k = np.nonzero(inside & ((units[np.where(inside, at, 0)] & 0x800000FF) == labels))
        at = at[row, k]
        prefixes = [prefixes[r] + bytes([label]) for r, label in zip(row.tolist(), labels[k].tolist())]
        leaf = (units[at] >> 8) & 1 == 1
        nodes = base(at)
        for i in np.flatnonzero(leaf).tolist():
            start = int(units[nodes[i]] & 0x7FFFFFFF)
            found[prefixes[i].decode()] = texts[start : texts.index(0, start)].decode()
    return found


@dataclass
class Model:
    """A parsed model file."""

    pieces: list[str] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    map: dict[str, str] = field(default_factory=dict)
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True
    byte_fallback: bool = False
    unknown: int = 0
    begin: int = 1
    end: int = 2
    unknown_surface: str = " ⁇ "

    @classmethod
    def parse(cls, data: bytes) -> Model:
        model, kind, suffix = cls(), 1, 0
        for number, value in _fields(data):
            if number == 1:
                piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
                model.pieces.append(piece[1].decode())
                model.scores.append(struct.unpack("<f", piece[2])[0])
                model.kinds.append(piece[3])
            elif number == 2:
                trainer = dict(_fields(value))
                kind, suffix = trainer.get(3, 1), trainer.get(24, 0)
                model.byte_fallback = bool(trainer.get(35, 0))
                model.unknown, model.begin, model.end = (trainer.get(n, d) for n, d in ((40, 0), (41, 1), (42, 2)))
                model.unknown_surface = trainer.get(44, b" \xe2\x81\x87 ").decode()
            elif number == 3:
                rules = dict(_fields(value))
                model.map = character_map(rules.get(2, b""))
                model.dummy_prefix, model.trim, model.escape = (bool(rules.get(n, 1)) for n in (3, 4, 5))
        if kind != BPE or suffix or set(model.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models of normal, control and byte pieces with spaces in front")
        return model


class Codec:
    """Encodes and decodes with a model."""

    def __init__(self, data: bytes):
        self.model = model = Model.parse(data)
        self.space = SPACE if model.escape else " "
        normal = [i for i, kind in enumerate(model.kinds) if kind == NORMAL]
        by_score = {s: r for r, s in enumerate(sorted({model.scores[i] for i in normal}, reverse=True))}
        self.rank = {model.pieces[i]: by_score[model.scores[i]] for i in normal}
        self.id = {model.pieces[i]: i for i in normal}
        self.together = {pair for i in normal for pair in zip(model.pieces[i], model.pieces[i][1:])}
        values = [int(p[3:5], 16) if kind == BYTE else -1 for p, kind in zip(model.pieces, model.kinds)]
        self.byte = {value: i for i, value in enumerate(values) if value >= 0}
        self.cuts_at_space = not any(b == self.space != a for a, b in self.together)
        self.runs = re.compile(f"{self.space}*[^{self.space}]+|{self.space}+")
        # By id: the bytes a piece decodes to, its characters, and which byte it is.
        texts = [{CONTROL: "", UNKNOWN: model.unknown_surface}.get(k, p.replace(SPACE, " ")) for p, k in zip(model.pieces, model.kinds)]
        self.surface = [t.encode() if value < 0 else bytes([value]) for t, value in zip(texts, values)]
        self.chars = np.array([{CONTROL: 0, BYTE: 1, UNKNOWN: 1}.get(k, len(p)) for p, k in zip(model.pieces, model.kinds)], np.int64)
        self.byte_of = np.array(values, np.int64)
        self.control = np.array([k == CONTROL for k in model.kinds])
        self.starts = re.compile("[" + re.escape("".join(sorted({k[0] for k in model.map}))) + "]") if model.map else None
        self.keys: dict[str, list[str]] = {}
        for key in sorted(model.map, key=len, reverse=True):
            self.keys.setdefault(key[0], []).append(key)
        self.cache: dict[str, bytes] = {}

    # Normalising

    def _units(self, text: str) -> Iterator[tuple[str, int]]:
        """What each longest prefix becomes, and the prefix's characters."""
        at = 0
        while at < len(text):
            met = self.starts.search(text, at) if self.starts else None
            stop = met.start() if met else len(text)
            for c in text[at:stop]:
                yield c, 1
            at = stop
            if met:
                key = next((k for k in self.keys[text[at]] if text.startswith(k, at)), None)
                yield (self.model.map[key], len(key)) if key is not None else (text[at], 1)
                at += len(key or " ")

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters and its end the
        character of the text that it comes from."""
        model = self.model
        if not text:
            return "", np.zeros(1, np.int64)
        if not model.map and not model.trim:
            pad = int(model.dummy_prefix)
            places = np.arange(len(text) + 1 + pad, dtype=np.int64) - pad
            return self.space * pad + text.replace(" ", self.space), np.maximum(places, 0)
        units = list(self._units(text))
        at = first = 0
        if model.trim:
            while first < len(units) and units[first][0] == " ":
                at += units[first][1]
                first += 1
            if first == len(units):
                return "", np.array([at])
        out, places = ([self.space], [at]) if model.dummy_prefix else ([], [])
        after_space = model.trim
        for new, taken in units[first:]:
            if after_space:
                new = new.lstrip(" ")
            out.extend(new.replace(" ", self.space))
            places.extend([at] * len(new))
            if new:
                after_space = model.trim and new.endswith(" ")
            at += taken
        if model.trim:
            while out and out[-1] == self.space:
                out.pop()
                at = places.pop()
        return "".join(out), np.array([*places, at], np.int64)

    # Merging

    def _merge_short(self, run: str) -> list[str]:
        """The pieces of a short run: best pair first, leftmost of equals."""
        get, none = self.rank.get, len(self.rank)
        symbols = list(run)
        ranks = [get(a + b, none) for a, b in zip(run, run[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            symbols[i] += symbols.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(symbols[i] + symbols[i + 1], none)
            if i:
                ranks[i - 1] = get(symbols[i - 1] + symbols[i], none)
        return symbols

    def _merge_long(self, run: str) -> list[str]:
        """The same for a run of any length, with a heap of pairs."""
        rank = self.rank
        symbols: list[str | None] = list(run)
        n = len(symbols)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, len(s)) for i in range(n - 1) if (r := rank.get(s := run[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            left = symbols[i]
            if left is None or (j := following[i]) >= n or len(left) + len(symbols[j]) != size:
                continue
            symbols[i] = left = left + symbols[j]
            symbols[j] = None
            following[i] = k = following[j]
            if k < n:
                before[k] = i
                if (r := rank.get(s := left + symbols[k])) is not None:
                    heapq.heappush(heap, (r, i, len(s)))
            if (h := before[i]) >= 0 and (r := rank.get(s := symbols[h] + left)) is not None:
                heapq.heappush(heap, (r, h, len(s)))
        return [s for s in symbols if s is not None]

    def _merge(self, run: str) -> list[int]:
        """The ids of a run."""
        out: list[int] = []
        for s in self._merge_short(run) if len(run) <= LONG_RUN else self._merge_long(run):
            i = self.id.get(s)
            if i is not None:
                out.append(i)
            elif self.model.byte_fallback:
                out.extend(self.byte[b] for b in s.encode())
            else:
                out.append(self.model.unknown)
        return out

    def _ids(self, run: str) -> bytes:
        if len(run) > LONG_RUN:
            cuts = [i for i, pair in enumerate(zip(run, run[1:]), 1) if pair not in self.together]
            if cuts:
                return b"".join(self._ids(run[a:b]) for a, b in zip([0, *cuts], [*cuts, len(run)]))
        ids = self.cache.get(run)
        if ids is None:
            merged = self._merge(run)
            ids = struct.pack(f"<{len(merged)}I", *merged)
            if len(run) <= LONG_RUN:
                if len(self.cache) >= MAX_CACHED:
                    self.cache.clear()
                self.cache[run] = ids
        return ids

    def _runs(self, normal: str) -> Iterator[list[str]]:
        """Runs that are merged on their own, in lists of about a part."""
        if not self.cuts_at_space:
            yield [normal]
            return
        at = 0
        while at < len(normal):
            end = at + PART_CHARS
            if end < len(normal):
                # A part ends before a space that a character stands in front of.
                met = re.compile(f"[^{self.space}]{self.space}").search(normal, end)
                end = met.start() + 1 if met else len(normal)
            yield self.runs.findall(normal[at:end])
            at = end

    def encode(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Part by part: ids and the spans of bytes of the text they stand for;
        the begin is in the first part, the end in the last."""
        model = self.model
        normal, places = self.normalize(text)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        place = np.concatenate(([0], np.cumsum(widths)))[places]
        front, done, get = [model.begin], 0, self.cache.get
        for runs in self._runs(normal):
            ids = np.frombuffer(b"".join([get(r) or self._ids(r) for r in runs]), "<u4")
            if model.byte_fallback:
                # A byte that another byte of its character follows has no length.
                byte = self.byte_of[ids]
                inner = np.zeros(len(ids), bool)
                inner[:-1] = (byte[:-1] >= 0) & (byte[1:] >= 0x80) & (byte[1:] < 0xC0)
                lengths = np.where(inner, 0, self.chars[ids])
            else:
                ids = self._one_unknown(ids)
                lengths = self._lengths(ids, runs)
            done += sum(map(len, runs))
            last = done == len(normal)
            lengths = np.concatenate(([0] * len(front), lengths, [0] * last)).astype(np.int64)
            upto = np.cumsum(lengths) + done - lengths.sum()
            yield np.concatenate((front, ids, [model.end] * last)).astype("<u4"), place[upto - lengths], place[upto]
            front = []
        if not normal:
            yield np.array([model.begin, model.end], "<u4"), place[[0, 0]], place[[0, 0]]

    def _one_unknown(self, ids: np.ndarray) -> np.ndarray:
        """Unknown characters in a row are one piece."""
        again = (ids[1:] == self.model.unknown) & (ids[:-1] == self.model.unknown)
        return np.delete(ids, np.flatnonzero(again) + 1)

    def _lengths(self, ids: np.ndarray, runs: list[str]) -> np.ndarray:
        """Characters of pieces among which an unknown one may stand for many."""
        lengths, text, at = self.chars[ids].copy(), "".join(runs), 0
        for i, k in enumerate(ids.tolist()):
            if k == self.model.unknown:
                end = at
                while end < len(text) and text[end] not in self.id:
                    end += 1
                lengths[i] = end - at
            at += int(lengths[i])
        return lengths

    # Decoding

    def decode(self, parts: Iterable[np.ndarray]) -> Iterator[bytes]:
        """The UTF-8 text of ids that come part by part.

        The space that encoding put in front goes again; bytes that are no
        character each become U+FFFD.
        """
        model = self.model
        head, held = model.dummy_prefix or model.trim, b""
        for ids, broken in self._stretches(parts):
            if broken and held:
                yield self._valid(held)
                held = b""
            front, at = b"", 0
            while head and at < len(ids):
                piece = model.pieces[ids[at]]
                if model.kinds[ids[at]] != NORMAL or not piece.startswith(SPACE):
                    head = False
                    break
                front += piece[1:].replace(SPACE, " ").encode()
                head = model.trim and not front
                at += 1
            out = held + front + b"".join(map(self.surface.__getitem__, ids[at:].tolist()))
            # A character may end in the next part.
            tail = next((k for k in range(1, min(4, len(out) + 1)) if out[-k] >= 0xC0), 0)
            if tail and tail < (2 if out[-tail] < 0xE0 else 3 if out[-tail] < 0xF0 else 4):
                out, held = out[:-tail], out[-tail:]
            else:
                held = b""
            yield self._valid(out)
        if held:
            yield self._valid(held)

    def _stretches(self, parts: Iterable[np.ndarray]) -> Iterator[tuple[np.ndarray, bool]]:
        """Ids between control pieces, and whether one stands in front."""
        for ids in parts:
            for k, own in enumerate(np.split(ids, np.flatnonzero(self.control[ids]))):
                yield (own[1:], True) if k else (own, False)

    @staticmethod
    def _valid(data: bytes) -> bytes:
        try:
            data.decode()
            return data
        except UnicodeDecodeError:
            return data.decode(errors="surrogateescape").translate(_BROKEN).encode()


_BROKEN = {0xDC00 + b: "�" for b in range(128, 256)}


@functools.lru_cache(maxsize=1)
def codec_of(data: bytes) -> Codec:
    """One per worker process, which runs task after task."""
    return Codec(data)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), utf8().alias("text"))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    for whole in batches:
        for batch in rows_of(whole, SLICE_BYTES, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                yield doc_id, (text or b"").decode(errors="replace")


def encode(docs: DataFrame, data: bytes) -> DataFrame:
    """``(doc_id, part, ids, begins, ends)``: the ids of each document in parts
    from 0, with the spans of bytes of the text that they stand for."""

    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [f.split()[0] for f in ENCODED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, rows, held = codec_of(data), [], 0
        for doc_id, text in _each(batches):
            for part, (ids, begins, ends) in enumerate(codec.encode(text)):
                rows.append((doc_id, part, ids.astype(np.int32), begins, ends))
                held += len(ids)
                if held > PART_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return _texts(docs).mapInArrow(run, ENCODED)


def decode(rows: DataFrame, data: bytes, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Each row of ``rows`` with the text of its array ``ids`` (null: null) in a
    new column ``name``."""
    names = rows.columns
    if name in names:
        raise ValueError(f"there is a column {name} already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(data)
        for batch in batches:
            texts = [None if v is None else b"".join(codec.decode([np.array(v, np.int64)])).decode() for v in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, name])

    small_batches(rows.sparkSession)
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def digest(docs: DataFrame, data: bytes) -> DataFrame:
    """A row per document: ids and decoded text as digests, the pieces that are
    single bytes, and the bytes of the text that the spans cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(data)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in DIGEST.split(", ")])

        for doc_id, text in _each(batches):
            hashed, counts = hashlib.sha256(), [0, 0, 0]

            def parts() -> Iterator[np.ndarray]:
                for ids, begins, ends in codec.encode(text):
                    hashed.update(ids.tobytes())
                    counts[0] += len(ids)
                    counts[1] += int((codec.byte_of[ids] >= 0).sum())
                    counts[2] += int((ends - begins).sum())
                    yield ids

            decoded = hashlib.sha256()
            for piece in codec.decode(parts()):
                decoded.update(piece)
            rows.append((doc_id, counts[0], hashed.hexdigest(), decoded.hexdigest(), counts[1], counts[2]))
            if len(rows) >= 1000:
                yield batch()
        if rows:
            yield batch()

    return _texts(docs).mapInArrow(run, DIGEST)

