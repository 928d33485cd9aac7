"""What operators save, with the results as they were."""

import re
import sys
import zlib

import numpy as np

from pagesift.llm import bloomlm, components, packing, shingles, suffixes
from pagesift.llm.queries import word_bpe

WORDS = re.compile(rb"[^\x20\x09-\x0d]+")


def test_word_hashes_by_windows(monkeypatch):
    """Words of any length, over text borders and windows, as the sums of their bytes."""
    r = np.random.default_rng(3)
    texts = [bytes(r.choice([9, 13, 14, 32, 65, 97, 195, 255], size=n).astype(np.uint8)) for n in (0, 1, 5, 400, 0, 90)]
    texts += [b"a" * 300, b"A" * 300 + b" b", b"", b" "]
    want = []
    for t in texts:
        for w in WORDS.findall(t):
            total, power = len(w) * int(shingles._M2), 1
            for byte in w:
                total += int(shingles._BYTE[byte]) * power
                power *= int(shingles._ODD)
            want.append(total % (1 << 64))
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    whole = shingles.word_hashes(data, offsets)
    assert whole[0].tolist() == shingles.mix(np.array(want, np.uint64)).tolist()
    assert np.diff(whole[1]).tolist() == [len(WORDS.findall(t)) for t in texts]
    monkeypatch.setattr(shingles, "_WINDOW", 7)
    assert shingles.word_hashes(data, offsets)[0].tolist() == whole[0].tolist()


def test_frequent_words_are_found():
    r = np.random.default_rng(4)
    mixed = r.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)
    close = np.arange(40, dtype=np.uint64) + np.uint64(7 << 50)
    for own in (np.unique(np.concatenate([mixed, close])), close, close[:1], close[:0]):
        lm = bloomlm.Model(own, np.ones(len(own), np.int64), np.ones(len(own)), 1, 1, 1)
        asked = np.concatenate([own, own + np.uint64(1), mixed, np.array([0, (1 << 64) - 1], np.uint64)])
        place = {int(w): i for i, w in enumerate(own)}
        assert lm.find(asked).tolist() == [place.get(int(w), -1) for w in asked]


def test_words_are_counted_by_their_bigrams(spark, monkeypatch):
    """One count of the texts, and frequent words reach the driver in Arrow batches."""
    counts, sums = [], bloomlm._sums
    monkeypatch.setattr(bloomlm, "_sums", lambda *a: counts.append(a) or sums(*a))
    monkeypatch.setattr(type(spark.range(0)), "toPandas", None)
    kept, out = ([i for i in range(40) if (zlib.crc32(str(i).encode()) % 5 == 1) == held] for held in (False, True))
    rows = [*zip(kept, ("a b a", None, "", "a")), (None, "b c"), (out[0], "b d")]
    model, words, _ = bloomlm.train(spark.createDataFrame(rows, "doc_id long, text string"))
    hashes = shingles.word_hashes(np.frombuffer(b"a b c", np.uint8), np.array([0, 5]))[0]
    want = dict(zip(hashes.view(np.int64).tolist(), (3, 2, 1))) | {int(bloomlm.END.view(np.int64)): 5}
    assert {r.word: r.n for r in words.collect()} == want
    assert (model.n, model.v, len(counts)) == (11, 4, 1)


class _Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_pre_tokens_are_encoded_together():
    """Few texts for many distinct words, with the ids of the whole texts."""
    odd = "don't we'll İzmir ŉ ß Ÿ \x00 a b 1a2 <|x|> </w> ''s ' 's ½ ² é\x85f _-_ ..."
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)), odd, "", " "]
    encoder = packing.Encoder(word_bpe())
    whole = encoder.tokenizer
    encoder.tokenizer = counting = _Counting(whole)
    got = encoder.encode(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert counting.texts < 20
    encoder.cache.clear()
    encoder.ends[:] = False  # a vocabulary without the mark
    assert encoder.encode(texts) == got


def test_few_links_take_no_rounds(spark, monkeypatch):
    """Links that a task can contract at once are not gone through in rounds; more of them give the same."""
    r = np.random.default_rng(5)
    chain = list(range(40))
    r.shuffle(chain)
    links = [*zip(chain, chain[1:]), (100, 101), (101, 100), (102, 100), (7, 7), (-3, 200), *zip([300] * 30, range(400, 430))]
    want = {n: 0 for n in range(40)} | {n: 100 for n in (100, 101, 102)} | {-3: -3, 200: -3} | {n: 300 for n in (300, *range(400, 430))}
    frame = spark.createDataFrame([(int(a), int(b)) for a, b in links], "a long, b long").repartition(5)
    stages, staged = [], components.staged
    monkeypatch.setattr(components, "staged", lambda df, name: stages.append(name) or staged(df, name))
    rows = components.components(frame).collect()
    assert len(rows) == len(want) and {x.node: x.component for x in rows} == want
    assert len(stages) == 2
    for chunk in (1, 7, 60):
        rows = components.components(frame, chunk).collect()
        assert len(rows) == len(want) and {x.node: x.component for x in rows} == want


def test_names_are_not_sorted_one_by_one():
    """Repeats of repeats, whose names repeat too, are sorted without a Python step per symbol."""
    r = np.random.default_rng(6)
    block = r.integers(2, 9, 300)
    once = np.concatenate([block, block, r.integers(2, 5, 200), block[:150], block, np.full(40, 3), np.tile([2, 4, 3], 30)])
    s = np.append(np.tile(once, 4), 0).astype(np.uint8)
    want = sorted(range(len(s)), key=lambda i: s[i:].tobytes())
    assert suffixes.suffix_array(s.astype(np.int32), 1000).tolist() == want
    steps, before = [], sys.gettrace()

    def trace(frame, event, arg):
        steps.append(event)
        return trace

    sys.settrace(trace)
    try:
        found = suffixes.suffix_array(s, 10)
    finally:
        sys.settrace(before)
    assert found.tolist() == want and len(steps) < 5 * len(s)
