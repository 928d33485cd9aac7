"""Languages of texts: candidates by script, word scores, Viterbi over words.

A word is a run of letters' bytes. Its script, read off the ranges of its
characters, leaves the languages that were seen in that script; each of them
scores the word by its byte trigrams and as a whole. The best path through a
text's words, where every change of language costs ``SWITCH``, labels its spans;
the text's language is the one with most of its letters, and the score the share
of letters it has.

The model is counted on a sample of each language: rows that differ in id or
text are counted, and those whose hash of both falls below ``TRAIN_DOCUMENTS``
over the count are taken, once each; so about that many of every language, or
all it has. Nothing but text and label is learned from, and nothing but the text
is used to predict. Every language is learned and takes half a MB of the model.
Counts are scaled to those of the largest one, so that a feature which languages
have not met costs each of them the same.

Defined results: a null text or one without a letter is ``und`` with score 0;
with nothing to learn from everything is ``und``; ties go to the smaller
language; rows are judged one by one, so repeated ids need no rule.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.llm.tasks import buffers, free_names, lean, rows_of, small_batches, utf8

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
TRAIN_DOCUMENTS = 5_000
BUCKETS = 1 << 15
SMOOTHING = 0.5
SWITCH = 12.0
# A script of a language has this share of its words.
SCRIPT_SHARE = 0.01
SLICE_BYTES = 1 << 20

# Scripts by the lead byte of UTF-8: 0 Latin (ASCII and U+0080..U+036F), then
# Greek, Cyrillic, Armenian and Hebrew, Arabic and Syriac, the Indic and other
# scripts of E0 and E1, kana and CJK marks, Han, Hangul, the rest.
SCRIPTS = 10
_SCRIPT = np.zeros(256, np.int8)
for _lead, _script in ((range(0xCD, 0xD0), 1), (range(0xD0, 0xD5), 2), (range(0xD5, 0xD8), 3), (range(0xD8, 0xE0), 4), (range(0xE0, 0xE2), 5), ((0xE3,), 6), (range(0xE4, 0xEA), 7), (range(0xEA, 0xEE), 8), (range(0xEE, 0xF8), 9)):
    _SCRIPT[list(_lead)] = _script
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


def held_out(doc_id: Column) -> Column:
    """Ids no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


@dataclass
class Words:
    """The words of a batch: their texts, lengths, scripts and features."""

    text: np.ndarray
    length: np.ndarray
    script: np.ndarray
    first: np.ndarray  # of each word among the letters
    trigram: np.ndarray  # of each letter
    whole: np.ndarray  # of each word


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    at = np.flatnonzero(inside)
    starts = start[at]
    first = np.flatnonzero(starts)
    byte = _FOLD[data[at]]
    before, after = np.roll(byte, 1), np.roll(byte, -1)
    before[starts] = 32
    ends = np.append(first[1:], len(at)) - 1
    if len(at):
        after[ends] = 32
    trigram = (before * np.uint32(0x9E3779B1)) ^ (byte * np.uint32(0x85EBCA77)) ^ (after * np.uint32(0xC2B2AE3D))
    trigram = (trigram ^ (trigram >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    trigram = (trigram >> np.uint32(16)) & np.uint32(BUCKETS - 1)
    length = np.diff(np.append(first, len(at)))
    place = (np.arange(len(at)) - np.repeat(first, length)).astype(np.uint32) if len(at) else np.zeros(0, np.uint32)
    mixed = (byte + np.uint32(1)) * (place * np.uint32(0x9E3779B1) + np.uint32(0x27D4EB2F))
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    none = np.zeros(0, np.uint32)
    whole = np.add.reduceat(mixed, first) if len(first) else none
    whole = ((whole ^ (whole >> np.uint32(13))) * np.uint32(0x85EBCA77)) >> np.uint32(17)
    script = np.maximum.reduceat(_SCRIPT[data[at]], first) if len(first) else none.astype(np.int8)
    text = np.searchsorted(offsets, at[first], "right") - 1
    return Words(text, length, script, first, trigram, whole & np.uint32(BUCKETS - 1))


@dataclass
class Model:
    langs: list[str]
    trigrams: np.ndarray  # bucket, language
    wholes: np.ndarray
    scripts: np.ndarray  # script, language: is it a candidate?

    def scores(self, words: Words) -> np.ndarray:
        """A row per word: how well each language explains it."""
        if not len(words.first):
            return np.zeros((0, len(self.langs)), np.float32)
        out = np.add.reduceat(self.trigrams[words.trigram], words.first, axis=0) + self.wholes[words.whole]
        out[~self.scripts[words.script]] -= 1e6
        return out


PARTS = 10**15
TRAINING = "lang string, kind int, feature int, n double"


def train(docs: DataFrame, sample: int = TRAIN_DOCUMENTS) -> Model:
    """Count the model on the labelled documents that are not held out, on
    about ``sample`` of each language."""
    small_batches(docs.sparkSession)
    told = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    told = told.select("lang", "text", F.xxhash64("doc_id", "text").alias("hash"))
    rows = told.select("lang", "hash").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    rates = rows.select("lang", (F.lit(float(sample)) / F.col("n") * F.lit(PARTS)).alias("below"))
    chosen = told.join(F.broadcast(rates), "lang").where(F.pmod("hash", F.lit(PARTS)) < F.col("below"))
    chosen = chosen.dropDuplicates(["lang", "hash"]).select("lang", utf8().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[np.ndarray]] = {}
        for whole in batches:
            for batch in rows_of(whole, SLICE_BYTES, "text"):
                words = split(*buffers(batch.column("text")))
                names, number = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
                of_word = number[words.text]
                of_letter = np.repeat(of_word, words.length)
                for k, name in enumerate(names.tolist()):
                    t, w, s, d = sums.setdefault(name, [np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(SCRIPTS), np.zeros(1)])
                    t += np.bincount(words.trigram[of_letter == k], minlength=BUCKETS)
                    w += np.bincount(words.whole[of_word == k], minlength=BUCKETS)
                    s += np.bincount(words.script[of_word == k], minlength=SCRIPTS)
                    d += (number == k).sum()
        for name, kinds in sums.items():
            for kind, counts in enumerate(kinds):
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["lang", "kind", "feature", "n"])

    counts = chosen.mapInArrow(lean(run), TRAINING).groupBy("lang", "kind", "feature").agg(F.sum("n").alias("n"))
    table = counts.toPandas()  # of the model's size
    langs = sorted(table["lang"].unique())
    found = [np.zeros((size, len(langs))) for size in (BUCKETS, BUCKETS, SCRIPTS)]
    if langs:
        number = table["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
        for kind in range(3):
            of = (table["kind"] == kind).to_numpy()
            found[kind][table["feature"].to_numpy()[of], number[of]] = table["n"].to_numpy()[of]
    if not langs:
        return Model([], *(f.astype(np.float32) for f in found[:2]), found[2] > 0)
    weights = []
    for c in found[:2]:
        size = c.sum(axis=0)
        c *= size.max(initial=1) / np.maximum(size, 1)
        logs = np.log((c + SMOOTHING) / (c.sum(axis=0) + SMOOTHING * BUCKETS))
        weights.append((logs - logs.mean(axis=1, keepdims=True)).astype(np.float32))
    scripts = found[2] >= SCRIPT_SHARE * np.maximum(found[2].sum(axis=0), 1)
    scripts[~scripts.any(axis=1)] = True
    return Model(langs, weights[0], weights[1], scripts)


def best_path(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The labels of one text's words on the best path (plain Viterbi)."""
    return _paths(scores, np.array([0, len(scores)]), switch)


def _one_language(scores: np.ndarray, at: np.ndarray, switch: float) -> tuple[np.ndarray, np.ndarray]:
    """The best single language of each text, and whether it surely is the best
    path: no other language gains more than half a change costs anywhere (a path
    of k stretches of others has k changes, or k - 1 if it is all others)."""
    sums = np.add.reduceat(scores, at[:-1], axis=0, dtype=np.float64)
    best = sums.argmax(axis=1)
    text = np.repeat(np.arange(len(best)), np.diff(at))
    gains = scores.astype(np.float64) - scores[np.arange(len(scores)), best[text]][:, None]
    gains = np.clip(gains, -4 * switch, 1e7)
    total = np.cumsum(gains, axis=0)
    total -= np.concatenate([np.zeros((1, total.shape[1])), total])[at[:-1]][text]
    before = total - gains
    # The lowest sum so far within the text; each text lies below the one before.
    drop = 4 * (np.abs(total).max() + 1) * text[:, None]
    lowest = np.minimum.accumulate(before - drop, axis=0) + drop
    most = np.maximum.reduceat((total - lowest).max(axis=1), at[:-1])
    return best, most <= switch / 2 * (1 - 1e-6)


def _paths(scores: np.ndarray, at: np.ndarray, switch: float) -> np.ndarray:
    """Viterbi of several texts side by side; ``at`` is where each starts."""
    size = np.diff(at)
    order = np.argsort(-size, kind="stable")
    starts, size = at[:-1][order], size[order]
    n, k = len(size), scores.shape[1]
    value = np.zeros((n, k))
    came = np.zeros((len(scores), k), np.int16)
    own = np.arange(k)
    alive = np.searchsorted(-size, -np.arange(1, (size[0] if n else 0) + 1), "right")
    for t, m in enumerate(alive.tolist()):
        here = starts[:m] + t
        v = value[:m]
        if t:
            top = v.argmax(axis=1)
            jump = v[np.arange(m), top] - switch
            change = v < jump[:, None]
            came[here] = np.where(change, top[:, None], own)
            v = np.where(change, jump[:, None], v)
        value[:m] = v + scores[here]
    labels = np.zeros(len(scores), np.int64)
    current = value.argmax(axis=1)
    for t in range(len(alive) - 1, -1, -1):
        m = alive[t]
        here = starts[:m] + t
        labels[here] = current[:m]
        if t:
            current[:m] = came[here, current[:m]]
    return labels


def label_words(words: Words, model: Model, switch: float = SWITCH) -> np.ndarray:
    """The language number of each word."""
    scores = model.scores(words)
    if not len(scores):
        return np.zeros(0, np.int64)
    at = np.append(np.flatnonzero(np.diff(words.text, prepend=-1)), len(scores))
    best, sure = _one_language(scores, at, switch)
    size = np.diff(at)
    labels = np.repeat(best, size)
    if not sure.all():
        rows = np.repeat(~sure, size)
        inner = np.concatenate([[0], np.cumsum(size[~sure])])
        labels[rows] = _paths(scores[rows], inner, switch)
    return labels


RESULT = ("lang_pred", "score", "n_spans", "spans")
SPANS = "array<struct<start:long,end:long,lang:string>>"


def _labelled(batch: pa.RecordBatch, model: Model, switch: float, spans: bool) -> Iterator[dict]:
    """For each text of a batch its language, score and spans."""
    data, offsets = buffers(batch.column("text"))
    words = split(data, offsets)
    labels = label_words(words, model, switch) if model.langs else np.zeros(len(words.text), np.int64)
    edges = np.searchsorted(words.text, np.arange(batch.num_rows + 1))
    for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if a == b or not model.langs or not _has_letter(data[offsets[i] : offsets[i + 1]]):
            yield {"lang_pred": UNKNOWN, "score": 0.0, "n_spans": 0, "spans": []}
            continue
        letters = np.bincount(labels[a:b], weights=words.length[a:b], minlength=len(model.langs))
        top = int(letters.argmax())
        cuts = np.flatnonzero(np.diff(labels[a:b])) + 1
        row = {"lang_pred": model.langs[top], "score": float(letters[top] / letters.sum()), "n_spans": len(cuts) + 1, "spans": []}
        if spans:
            starts, ends = [0, *cuts.tolist()], [*cuts.tolist(), b - a]
            row["spans"] = [{"start": s, "end": e, "lang": model.langs[labels[a + s]]} for s, e in zip(starts, ends)]
        yield row


def predict(docs: DataFrame, model: Model, switch: float = SWITCH, names: Sequence[str] = RESULT, spans: bool = True) -> DataFrame:
    """The documents with their language, its score, the number of labelled
    spans and, if asked for, the spans (in words), in columns of these names.

    Only the texts go to Python workers, and only labels come back.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    made = T.StructType.fromDDL(f"lang_pred string, score double, n_spans long, spans {SPANS}")
    kind = pa.struct([
        ("lang_pred", pa.string()), ("score", pa.float64()), ("n_spans", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))),
    ])

    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([texts], names=["text"])
            yield pa.array([row for part in rows_of(batch, SLICE_BYTES, "text") for row in _labelled(part, model, switch, spans)], kind)

    # Not deterministic for the planner, so that a filter does not run it again.
    labels = F.arrow_udf(lean(label), made).asNondeterministic()
    (own,) = free_names(docs, "labels")
    found = docs.withColumn(own, labels(utf8()))
    fields = [F.col(f"{own}.{field}").alias(name) for field, name in list(zip(RESULT, names))[: 3 + spans]]
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], *fields)


def _has_letter(own: np.ndarray) -> bool:
    folded = own | 0x20
    if ((folded >= 97) & (folded <= 122)).any():
        return True
    return any(c.isalpha() for c in own.tobytes().decode())


def judge(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: language and score."""
    model = train(docs) if model is None else model
    found = predict(docs.select("doc_id", "text"), model, spans=False)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_spans")


def keep_known(docs: DataFrame, min_score: float = 0.0, model: Model | None = None) -> DataFrame:
    """The documents that have a language, whatever share of their letters it
    has (``min_score`` asks for one); with no model, those with a letter.

    A document without a label in ``lang`` gets the language that most of its
    letters have; labels that are there stay."""
    model = train(docs) if model is None else model
    if not model.langs:
        return docs.where(F.col("text").rlike("\\p{L}"))
    names = free_names(docs, *RESULT[:3])
    found = predict(docs, model, names=names, spans=False)
    found = found.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= min_score))
    lang = F.coalesce("lang", names[0]).alias("lang")
    return found.select(*[lang if c == "lang" else F.col(f"`{c}`") for c in docs.columns])
