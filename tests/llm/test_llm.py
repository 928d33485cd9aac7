"""The training-data operators against brute force, on tables with every awkward row."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import regex
from pyspark.sql import functions as F

from pagesift.llm import bloomlm, components, decontam, langid, licenses, packing, quality, sharding, sigtree, suffixdedup, suffixes, urlfilter
from pagesift.llm.queries import word_bpe

random.seed(7)
VOCABULARY = ["the", "of", "and", "river", "stone", "Ünder", "light", "morning", "äther", "walk", "to", "in"]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + str(r.randrange(60)) * (r.random() < 0.5) for _ in range(n))


PASSAGE = prose(70, "passage")
BASE = prose(120, "base")
# Nulls, empty and long texts, copies, near copies, repeated rows, null and
# negative ids, letters of other scripts, no letters at all.
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "Word"), (6, "two words"), (7, "... 123 !!!"),
    (8, prose(300, 8)), (9, prose(300, 9)), (10, prose(300, 8)), (10, prose(300, 8)), (11, BASE), (12, BASE + " extra"),
    (13, "x " + BASE), (14, prose(40, 14) + "\n" + PASSAGE + "\n" + prose(30, 15)), (15, prose(50, 16) + " " + PASSAGE),
    (16, "same same same same " * 60), (17, "a" * 500), (18, "\n".join(["one line of text here"] * 6)), (19, prose(9000, 19)),
    (20, "Das ist die Straße und der Baum " * 4), (21, "これは 日本語 の 文章"), (22, "<|endoftext|> a\u00a0b İstanbul ΣΑΣ ﬁne café"),
    (None, prose(60, "none")), (None, None), (-5, PASSAGE), (23, "released under the MIT License. cc by-nc 4.0; Apache License, Version 2.0 under the mit license"),
    (24, "### $$$ %%% &&& " * 20), (25, "\r\x0b\x0c\x1c\x85 odd\x00spaces"), (26, prose(20, 26)),
]
# Columns of the documents, and some that the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node long, n_words int, score string, size long, shard string, at long, rule string"
SPACES = re.compile("[^\x20\x09-\x0d]+")
TERMS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def full(rows):
    return [(i, t, "en" if n % 3 else None, "s", len(t or ""), "k", n, n, "x", 1, "y", 2, "z") for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(full(ROWS), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sample(sf_dir, n=160):
    t = pq.read_table(f"{sf_dir}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"]))[:n]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# 1


def test_shards(spark, docs, empty):
    tree = sharding.ShardTree.even(3, 2, 4)
    got = sharding.place(docs, tree).collect()
    assert len(got) == len(ROWS)
    want = sorted((i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ROWS)
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.place(empty, tree).count() == 0


def test_weights_confine_movement(spark):
    ids = spark.range(20_000).selectExpr("id AS doc_id", "CAST(id AS string) AS k")
    tree = sharding.ShardTree((((1.0, 2.0), (1.0,)), ((4.0,), (0.0,))))
    heavier = sharding.ShardTree((((1.0, 2.0), (1.0,)), ((8.0,), (0.0,))))
    both = sharding.with_shard_of(sharding.with_shard_of(ids, ids["k"], tree, "a"), ids["k"], heavier, "b").select("a", "b").toPandas()
    share = both["a"].value_counts(normalize=True).to_dict()
    for shard, weight in enumerate((1, 2, 1, 4)):
        assert abs(share[shard] - weight / 8) < 0.02
    moved = both[both["a"] != both["b"]]
    assert len(moved) and (moved["b"] == 3).all() and 4 not in share


# 2


def brute_dedup(pairs):
    """{(id, text): (n_removed, n_spans, sha)}; null ids first, rows of an id and text once."""
    least, out = {}, {}
    places = sorted({(-(2**63) if i is None else i, (t or "").encode()) for i, t in pairs})
    for i, b in places:
        for k in range(len(b) - 99):
            w = b[k : k + 100]
            least[w] = min(least.get(w, (i, k)), (i, k))
    for i, b in places:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            if least[b[k : k + 100]] != (i, k):
                gone[k : k + 100] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i, b] = (int(gone.sum()), len(re.findall(b"\1+", gone.tobytes())), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(spark, docs, empty, sf_dir, monkeypatch):
    small = sample(sf_dir, 100)
    for pairs, df in ((ROWS, docs), (small, spark.createDataFrame(small, "doc_id long, text string").repartition(5))):
        want = brute_dedup(pairs)
        expected = sorted((str(i), len((t or "").encode()), *want[-(2**63) if i is None else i, (t or "").encode()]) for i, t in pairs)
        got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.dedup(df).collect())
        assert got == expected
    assert sum(e[2] for e in expected) > 0
    # Frequent anchors window by window, and texts in many slices.
    monkeypatch.setattr(suffixdedup, "HOT_TEXTS", 2)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.dedup(df).collect()) == expected
    assert suffixdedup.dedup(empty).count() == 0


def test_anchor_runs_of_sliced_texts(monkeypatch):
    data = np.frombuffer(prose(3000, 1).encode(), np.uint8)
    offsets = np.array([0, 50, 50, 5000, len(data)])

    def windows():
        text, start, count, anchor = suffixdedup.anchors(data, offsets)
        return [(t, s + k, a) for t, s, n, a in zip(text.tolist(), start.tolist(), count.tolist(), anchor.tolist()) for k in range(n)]

    whole = windows()
    assert len(whole) == 4950 - 99 + len(data) - 5000 - 99
    monkeypatch.setattr(suffixdedup, "SLICE_BYTES", 700)
    assert windows() == whole


def test_removed_passages(spark, docs, empty):
    out = suffixdedup.remove(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r for r in out.collect()}
    assert PASSAGE in texts[-5].text and PASSAGE[20:200] not in texts[14].text and PASSAGE[20:200] not in texts[15].text
    assert texts[14].n_chars == len(texts[14].text) and texts[8].text == prose(300, 8) and 10 not in texts
    assert suffixdedup.remove(empty).count() == 0


@pytest.mark.parametrize("limit", [300, 2])
def test_suffix_array(limit, monkeypatch):
    monkeypatch.setattr(suffixes, "SMALL_ALPHABET", limit)
    r = np.random.default_rng(limit)
    for _ in range(120):
        k = int(r.integers(2, 6))
        s = np.append(r.integers(1, k, int(r.integers(1, 70))), 0).astype(np.uint8)
        sa = suffixes.suffix_array(s, k)
        texts = [s[i:].tolist() for i in range(len(s))]
        assert sa.tolist() == sorted(range(len(s)), key=texts.__getitem__)
        plcp = suffixes.permuted_lcp(s, sa, 512)
        for a, b in zip(sa[:-1], sa[1:]):
            n = next(n for n, (x, y) in enumerate(zip(texts[a], texts[b])) if x != y)
            assert plcp[b] == n


# 3


def test_packing(spark, docs, empty, sf_dir):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_bpe())
    pairs = sample(sf_dir, 120)
    for given, df in ((ROWS, docs), (pairs, spark.createDataFrame(pairs, "doc_id long, text string"))):
        made = packing.pieces(df, word_bpe(), with_ids=True)
        got = packing.pack(made).collect()
        want = Counter((i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in given)
        # Whole documents come back from their pieces.
        found, by_doc = Counter(), defaultdict(list)
        for r in got:
            assert r.ids_crc32 == zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) and len(r.ids) == r.length > 0
            by_doc[r.doc_id].append(r)
        for i, own in by_doc.items():
            if sum(k[0] == i for k in want.elements()) == 1:
                ids = sum((r.ids for r in sorted(own, key=lambda r: r.start)), [])
                found[i, tuple(ids)] += 1
                assert {r.doc_tokens for r in own} == {len(ids)}
        assert all(want[k] == n for k, n in found.items()) and len(found) > len(given) * 0.7
        assert sum(r.length for r in got) == sum(len(k[1]) * n for k, n in want.items())
        filled = defaultdict(list)
        for r in got:
            filled[r.sequence_id].append((r.offset, r.length))
        for own in filled.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 2048
        total = sum(r.length for r in got)
        assert len(filled) * 2048 < total * 1.03 + 2 * 2048
    ids = {r.sequence_id: r.ids for r in packing.sequences(packing.pack(made)).collect()}
    assert {s: sum(n for _, n in own) for s, own in filled.items()} == {s: len(x) for s, x in ids.items()}
    assert packing.pack(packing.pieces(empty, word_bpe())).count() == 0


def test_left_overs_come_by_a_shuffle(spark, docs):
    """Numbering all pieces is not part of the task that fits the left-overs."""
    plan = packing.pack(packing.pieces(docs, word_bpe()))._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 1, true" in plan and "Repartition 1, false" not in plan


def test_cut_lengths():
    for n in range(1, 5000):
        pieces = packing.cut(n)
        assert sum(p for p, _ in pieces) == n and all(0 < p * j <= 2048 for p, j in pieces)


# 4


def test_bloom_scores(spark, docs, empty, sf_dir):
    pairs = sample(sf_dir)
    for given, df in ((ROWS, docs), (pairs, spark.createDataFrame(pairs, "doc_id long, text string").repartition(4))):
        tokens = [(i, [*SPACES.findall((t or "").translate(LOWER)), None]) for i, t in given]
        out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
        count = Counter(w for i, ws in tokens if not out(i) for w in ws)
        n, v = sum(count.values()), len(count)
        want = sorted(
            (str(i), out(i), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 5))
            for i, ws in tokens
        )
        got = bloomlm.score(df).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
        assert all(r.score < 0 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert bloomlm.score(empty).count() == 0


def test_bloom_rare_words_are_joined(spark, sf_dir, monkeypatch):
    df = spark.createDataFrame(sample(sf_dir), "doc_id long, text string")
    want = {r.doc_id: r.base_score for r in bloomlm.score(df).collect()}
    monkeypatch.setattr(bloomlm, "FREQUENT", 50)
    monkeypatch.setattr(bloomlm, "BIGRAM_WORDS", 20)
    for r in bloomlm.score(df).collect():
        assert math.isclose(r.base_score, want[r.doc_id], rel_tol=1e-9)


def test_bloom_has_all_bigrams(spark, monkeypatch):
    """Against the model with exact bigrams of all words, seen once or often,
    with few words broadcast and with the filter in several slices."""
    pairs = [(i, " ".join(f"w{(i * k * k + k) % 900}" for k in range(150))) for i in range(60)] + [(60, "w1 w2 new w3"), (61, None), (1, "w1"), (1, "w1")]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    texts = [(i, [None, *(t or "").split(), None], zlib.crc32(str(i).encode()) % 5 == 1) for i, t in pairs]
    count = Counter(w for _, ws, out in texts if not out for w in ws[1:])
    n, v = sum(count.values()), len(count)
    big = Counter(p for _, ws, out in texts if not out for p in zip(ws, ws[1:]))
    quantised = {p: bloomlm.seen_of(bloomlm.level_of(np.array([k])))[0] for p, k in big.items()}
    taken = Counter()
    for (h, _), k in quantised.items():
        taken[h] += k

    def probability(h, w):
        left = max(1 - taken[h] / count[h], bloomlm.LEAST_LEFT) if count[h] else 1.0
        return left * (count[w] + 0.5) / (n + 0.5 * (v + 1)) + (min(quantised.get((h, w), 0) / count[h], 1 - left) if count[h] else 0)

    assert any(k == 1 for k in big.values())
    want = sorted((i, round(sum(math.log10(probability(h, w)) for h, w in zip(ws, ws[1:])), 6)) for i, ws, _ in texts)
    monkeypatch.setattr(bloomlm, "MEMBER_BITS", 400)  # hardly a false member
    for frequent, blocks in ((1 << 19, 2048), (50, 3)):
        monkeypatch.setattr(bloomlm, "FREQUENT", frequent)
        monkeypatch.setattr(bloomlm, "SLICE_BLOCKS", blocks)
        assert sorted((r.doc_id, round(r.score, 6)) for r in bloomlm.score(df).collect()) == want


def test_filter_levels():
    keys = np.arange(1, 5001, dtype=np.uint64)
    n = np.random.default_rng(0).integers(2, 500, len(keys))
    levels = bloomlm.level_of(n)
    bits = np.zeros(bloomlm.BLOCKS * bloomlm.BLOCK_BITS, np.uint8)
    for level in range(1, levels.max() + 1):
        own = keys[levels >= level]
        bits[bloomlm.Filter.block(own) * bloomlm.BLOCK_BITS + bloomlm.Filter.places(own, np.full(len(own), level))] = 1
    made = bloomlm.Filter(np.packbits(bits, bitorder="little"))
    assert (made.levels(keys) >= levels).all() and (made.levels(keys) == levels).mean() > 0.99
    assert (made.levels(keys + np.uint64(10**9)) == 0).mean() > 0.99
    counts = bloomlm.count_of(levels)
    assert (counts <= n + 1e-9).all() and (counts * bloomlm.BASE > n - 1e-9).all()


# 5


def test_languages(spark, docs, empty, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = {r.doc_id: r.lang for r in table.select("doc_id", "lang").collect()}
    got = langid.judge(table).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in known if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.95 * len(held)
    model = langid.train(table)
    found = {(r.doc_id, r.n_spans): r for r in langid.judge(docs, model).collect()}
    assert len(langid.judge(docs, model).collect()) == len(ROWS)
    for (i, _), r in found.items():
        text = next(t for j, t in ROWS if j == i)
        letters = any(c.isalpha() for c in text or "")
        assert (r.lang_pred != "und") == letters or i is None
        assert 0 <= r.score <= 1 and (r.lang_pred in model.langs or r.lang_pred == "und")
    assert found[20, 1].lang_pred == "de"
    kept = langid.keep_known(docs, model=model)
    assert kept.columns == docs.columns and {1, 2, 3, 7}.isdisjoint({r.doc_id for r in kept.collect()})
    assert langid.judge(empty).count() == 0


def test_every_language_is_learned(spark):
    """Rare languages, and samples of rows that share an id."""
    r = random.Random(4)
    vocabulary = {x: [a + "".join(r.choice(b) for _ in range(r.randrange(2, 7))) for _ in range(300)] for x, a, b in (("aa", "k", "aeioktm"), ("bb", "w", "aeusrwn"), ("cc", "p", "oiulpdz"))}
    text = lambda x: " ".join(r.choices(vocabulary[x], k=40))
    many = [(None if i % 3 else i, text("aa"), "aa") for i in range(6000)] + [(1, text("bb"), "bb") for _ in range(3000)]
    few = [(20_000 + i, text("cc"), "cc") for i in range(8)]
    df = spark.createDataFrame(many + few, "doc_id long, text string, lang string").repartition(4)
    model = langid.train(df, 500)
    assert model.langs == ["aa", "bb", "cc"]
    told = [(30_000 + i, text(x), x) for i in range(40) for x in vocabulary]
    got = {(x.doc_id, x.lang): x["lang_pred"] for x in langid.predict(spark.createDataFrame(told, df.schema), model).collect()}
    assert all(p == lang for (_, lang), p in got.items())


def test_best_paths():
    r = np.random.default_rng(3)
    for _ in range(200):
        k, switch = int(r.integers(2, 5)), float(r.uniform(0.5, 4))
        scores = [r.normal(size=(int(r.integers(1, 9)), k)) for _ in range(4)]
        at = np.cumsum([0, *map(len, scores)])
        labels = langid._paths(np.concatenate(scores), at, switch)
        best, sure = langid._one_language(np.concatenate(scores), at, switch)

        def value(s, path):
            return sum(s[t, c] for t, c in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))

        for i, s in enumerate(scores):
            top = s[0].copy()
            for row in s[1:]:
                top = np.maximum(top, top.max() - switch) + row
            assert math.isclose(value(s, labels[at[i] : at[i + 1]].tolist()), top.max(), abs_tol=1e-9)
            if sure[i]:
                assert math.isclose(value(s, [best[i]] * len(s)), top.max(), abs_tol=1e-9)


# 6


def test_license_places(spark, docs, empty, sf_dir):
    pairs = sample(sf_dir)
    for given, df in ((ROWS, docs), (pairs, spark.createDataFrame(pairs, "doc_id long, text string"))):
        want = []
        for i, t in given:
            words = TERMS.findall((t or "").translate(LOWER))
            hits = [(k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
            starts = [k for k, _ in hits]
            want.append((str(i), len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))))
        got = licenses.judge(df).collect()
        assert sorted(map(repr, want)) == sorted(repr((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got)
        for r in got:
            assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert licenses.judge(empty).count() == 0


def test_license_diagonals_bridge_changes(spark):
    words = licenses.NOTICES[0][1].split()
    changed = words[:8] + ["really", "and"] + words[8:20] + words[21:]
    df = spark.createDataFrame([(1, "intro " + " ".join(changed)), (2, " ".join(words[:6]))], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.judge(df).collect()}
    assert got[1].labels == "mit" and got[1].n_base == 0 and 0.6 <= got[1].score < 1 and got[2].labels == ""
    plan = licenses.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 7

ITEMS = [(1, PASSAGE), (2, "only three words"), (3, None), (4, "..."), (5, PASSAGE), (6, "Only Three words"), (7, " ".join(prose(300, 8).split()[40:60]))]


def brute_hits(given, items):
    windows = defaultdict(set)
    for i, t in items:
        w = TERMS.findall((t or "").translate(LOWER))
        m = min(10, len(w))
        for k in range(len(w) - m + 1):
            if m:
                windows[tuple(w[k : k + m])].add(i)
    out = []
    for i, t in given:
        w = TERMS.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in windows:
                    hit.update(range(k, k + m))
                    found |= windows[tuple(w[k : k + m])]
        names = ",".join(sorted(map(str, found)))
        out.append((str(i), len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("block", [10**6, 5])
def test_contamination(spark, docs, empty, block, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block)
    given = [*ROWS, (30, "some only three words " + PASSAGE[:150] + " end"), (31, "only three"), (32, PASSAGE.upper())]
    df = spark.createDataFrame(full(given), SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in decontam.judge(df, items).collect())
    assert got == brute_hits(given, ITEMS)
    assert decontam.judge(empty, items).count() == 0
    assert not any(r.contaminated for r in decontam.judge(df, items.where("item_id < 0")).collect())


def test_contamination_of_random_words(spark):
    r = random.Random(5)
    text = lambda n: " ".join(r.choice("abc") for _ in range(n))
    items = [(i, text(r.randrange(1, 25))) for i in range(12)]
    given = [(i, text(r.randrange(0, 80))) for i in range(60)]
    got = decontam.judge(spark.createDataFrame(given, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in got.collect()) == brute_hits(given, items)


def test_decontaminated_texts(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontam.decontaminate(docs, items)
    texts = {r.doc_id: r for r in out.collect()}
    assert out.columns == docs.columns and -5 not in texts and 1 in texts
    assert all(not x[5] for x in brute_hits([(r.doc_id, r.text) for r in texts.values()], ITEMS))
    assert texts[9].text == prose(300, 9) and texts[14].text.startswith(prose(40, 14)) and texts[14].n_chars == len(texts[14].text)


# 8


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host) :])[0]
    host, best = host.translate(LOWER), (None, None)
    for verdict, name, start in urlfilter.RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(start) and len(name + start) > len(best[0] or ""):
            best = (name + start, verdict)
    return host, path, *best


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://NET/", "https://a.net/x?q=1", "http://xnet/", "http://example.net/en/a#b",
    "http://www.Example.net/EN/", "x://example.com/de/1", "http://example.com/de", "http://w.org/fr/", "http://w.org?u=://net/", "a://b://c.net/d",
    "http://ex.org#/fr/", "http://user@ex.net:80/", "http://ex.net:80/",
]


def test_url_rules(spark, sf_dir):
    rows_ = [(n, u, None if n % 2 else "<title>Stone River</title>", "extra") for n, u in enumerate(URLS * 2)]
    df = spark.createDataFrame(rows_, "page_id long, url string, html string, score string")
    got = {(r.page_id, r.host, r.path, r.rule): r.verdict for r in urlfilter.judge(df).collect()}
    for n, u, *_ in rows_:
        host, path, rule, verdict = brute_url(u)
        assert got[n, host, path, rule] in ({verdict} if verdict else {"allow", "block"})
    assert len(got) == len(rows_) and urlfilter.judge(df.where("page_id < 0")).count() == 0
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for r in urlfilter.judge(pages).join(pages, "page_id").collect():
        host, path, rule, verdict = brute_url(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or ("block" if r.score > 0 else "allow"))


def test_host_words():
    total = 1000.0
    known = urlfilter.Lexicon({w: math.log(n / total) for w, n in (("stone", 40), ("river", 50), ("ton", 5), ("s", 1))}, total)
    assert known.split("stoneriver") == ["stone", "river"] and known.split("riverzq") == ["river", "zq"] and known.split("") == []
    r = random.Random(2)
    for _ in range(50):
        name = "".join(r.choice("stonriv") for _ in range(8))
        cuts = [[name[a:b] for a, b in zip([0, *c], [*c, 8])] for m in range(256 // 2) for c in [[k + 1 for k in range(7) if m >> k & 1]]]
        assert math.isclose(sum(map(known.cost, known.split(name))), max(sum(map(known.cost, c)) for c in cuts))


def brute_scores(pages, rules=urlfilter.RULES):
    """Plain naive Bayes: {(host, path): log odds} of (url, html) rows."""
    counts = Counter(w for _, html in pages for t in re.findall("(?s)<title>(.*?)</title>", html or "")[:1] for w in regex.findall(r"\p{L}+", t.lower()))
    total = float(sum(counts.values()) + len(counts) + 1)
    known = urlfilter.Lexicon({w: math.log((n + 1) / total) for w, n in counts.items()}, total)
    split = functools.cache(known.split)
    parts = [brute_url(u) for u, _ in pages]
    tokens = {}
    for host, path, *_ in parts:
        if (host, path) not in tokens:
            runs = [(k, r) for k, t in (("h", host), ("p", path)) for r in regex.findall(r"\p{L}+|\p{Nd}+", t.lower())]
            tokens[host, path] = [(k, w) for k, r in runs for w in (["0"] if r[0].isdecimal() else split(r))]
    seen = {v: Counter(t for h, p, _, w in parts if w == v for t in tokens[h, p]) for v in ("block", "allow")}
    docs = Counter(p[3] for p in parts)
    both = set(seen["block"]) | set(seen["allow"])
    odds = {t: math.log((seen["block"][t] + 1) / (seen["block"].total() + len(both))) - math.log((seen["allow"][t] + 1) / (seen["allow"].total() + len(both))) for t in both}
    prior = math.log(docs["block"] / docs["allow"])
    return {hp: prior + sum(odds.get(t, 0.0) for t in own) for hp, own in tokens.items()}


@pytest.mark.parametrize("small", [200_000, 0])
def test_url_scores(spark, sf_dir, small, monkeypatch):
    monkeypatch.setattr(urlfilter, "SMALL_TABLE", small)
    monkeypatch.setattr(urlfilter, "PIECE", 8)
    given = [(r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    long, once = "donaudampfschifffahrtskapitän" * 2, "quetzalcoatl"
    title = f"<title>Stone River {long} {once} Ärger</title>"
    given += [(u, title) for u in URLS] + [(None, None)] * 40
    given += [(f"http://stone{long}river{k}.example.{t}/{once}ärger/{'riverstone' * 40}/x٣", None) for k in range(3) for t in ("net", "org", "de")]
    given += [(f"http://stoneriver.example.org/en/{once}/{k}", title) for k in range(60)]
    want = brute_scores(given)
    rows_ = [(n, u, h, "extra") for n, (u, h) in enumerate(given)]
    got = urlfilter.judge(spark.createDataFrame(rows_, "page_id long, url string, html string, part string").repartition(3)).collect()
    assert sorted(r.page_id for r in got) == list(range(len(given)))
    for r in got:
        assert math.isclose(r.score, want[r.host, r.path], abs_tol=1e-6)
        assert r.verdict == (brute_url(given[r.page_id][0])[3] or ("block" if want[r.host, r.path] > 0 else "allow"))


def test_urls_of_one_class(spark):
    schema = "page_id long, url string, html string"
    only = lambda *urls: [r.verdict for r in urlfilter.judge(spark.createDataFrame([(1, u, None) for u in urls], schema)).collect()]
    assert only("http://a.de/x", None) == ["allow"] * 2 and only("http://a.net/", "http://b.de/") == ["block"] * 2
    assert only("http://a.org/fr/", "http://b.de/") == ["allow"] * 2


# 9


def brute_groups(given, words=4, percent=85):
    sets = []
    for _, t in given:
        w = SPACES.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else []))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    groups = defaultdict(list)
    for k in range(len(sets)):
        groups[root(k)].append(given[k][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((i, len(s), least[root(k)] if s else i) for k, ((i, _), s) in enumerate(zip(given, sets))), key=repr)


def near_copies(n, seed, change):
    r = random.Random(seed)
    base = prose(90, seed).split()
    return [" ".join(r.choice(VOCABULARY) if r.random() < change else w for w in base) for _ in range(n)]


@pytest.mark.parametrize("cell", [2048, 4])
def test_near_groups(spark, docs, empty, cell, monkeypatch):
    monkeypatch.setattr(sigtree, "CELL", cell)
    monkeypatch.setattr(sigtree, "BLOCK_NODES", 3)
    texts = near_copies(25, "a", 0.02) + near_copies(25, "b", 0.03) + [f"{prose(25, i)} {PASSAGE}" for i in range(20)] + near_copies(40, "c", 0.015)
    given = [*ROWS, *((100 + n, t) for n, t in enumerate(texts))]
    df = spark.createDataFrame(full(given), SCHEMA).repartition(4)
    want = brute_groups(given)
    assert rows(sigtree.judge(df), "doc_id", "n_shingles", "component_id") == want
    assert any(c != i and c is not None for i, _, c in want)
    assert sigtree.judge(empty).count() == 0


def test_one_of_each_group(spark, docs):
    kept = sigtree.keep_one(docs, 5, 80)
    names = [r.doc_id for r in kept.collect()]
    groups = brute_groups(ROWS, 5, 80)
    assert kept.columns == docs.columns
    assert {i for i in names if i is not None} == {i for i, n, c in groups if i is not None and (not n or c == i)}


def test_tree_pairs_lose_nothing():
    r = np.random.default_rng(1)
    for size in (1, 2, 9, 70):
        base = [r.choice(2**63, 60).astype(np.uint64) for _ in range(4)]
        sets = [np.unique(np.concatenate([base[k % 4][r.random(60) > 0.04], r.choice(2**63, 2).astype(np.uint64)])) for k in range(size)]
        sizes = np.array([len(s) for s in sets])
        maps = np.frombuffer(b"".join(sigtree._signature(s) for s in sets), np.uint64).reshape(size, -1)
        order = np.argsort(sizes, kind="stable")
        comps = r.integers(0, 3, size)
        tree = sigtree.SignatureTree(maps[order], sizes[order], comps[order])
        found = {frozenset((order[i], order[j])) for i, j in zip(*sigtree.tree_pairs(tree, None, 85))}
        half = order[: size // 2]
        rest = order[size // 2 :]
        crossed = set()
        if len(half):
            trees = [sigtree.SignatureTree(maps[o], sizes[o], comps[o]) for o in (half, rest)]
            crossed = {frozenset((half[i], rest[j])) for i, j in zip(*sigtree.tree_pairs(*trees, 85))}
        for a in range(size):
            for b in range(a):
                common = len(np.intersect1d(sets[a], sets[b]))
                if comps[a] != comps[b] and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    assert frozenset((a, b)) in found
                    assert frozenset((a, b)) in crossed or (a in half) == (b in half)


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(100 + k, 101 + k) for k in range(30)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {x: root(x) for x in parent}
    assert got == {x: c for x, c in want.items() if list(want.values()).count(c) > 1}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 10


def test_quality_counts(spark, docs, empty, sf_dir):
    pairs = sample(sf_dir)
    for given, df in ((ROWS, docs), (pairs, spark.read.parquet(f"{sf_dir}/documents.parquet").where(f"doc_id <= {pairs[-1][0]}"))):
        want = []
        for i, t in given:
            t = t or ""
            w, places, covered = SPACES.findall(t), defaultdict(list), set()
            for k in range(len(w) - 4):
                places[tuple(w[k : k + 5])].append(k)
            for at in places.values():
                if len(at) > 1:
                    covered.update(j for k in at for j in range(k, k + 5))
            lines = [x for x in t.split("\n") if SPACES.search(x)]
            failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
            want.append((str(i), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed))
        got = quality.judge(df).collect()
        assert sorted(want) == sorted((str(r.doc_id), *tuple(r)[1:7]) for r in got)
        assert not any(r.kept and r.base_failed for r in got)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    told = [(r.kept, labels[r.doc_id]) for r in got if r.doc_id in labels and not r.base_failed]
    assert sum(k == bool(q) for k, q in told) >= 0.97 * len(told)
    assert quality.judge(empty).count() == 0


def test_quality_of_small_languages(spark):
    """Clean texts of languages with few documents, or without frequent words,
    are kept; texts without a language's words are not."""
    r = random.Random(5)
    text = lambda words, weights, n: " ".join(r.choices(words, weights, k=n))
    made = lambda start, n: [start + "".join(r.choice("aeioulnrst") for _ in range(6)) for _ in range(n)]
    zipf = lambda n: [1 / (k + 1) for k in range(n)]
    large, small, tiny, junk = (made(x, 3000) for x in ("b", "d", "f", "g"))
    flat = made("k", 400)  # twelve words are 3 % of its words
    rows_ = [(i, text(large, zipf(3000), 60), "large") for i in range(4000)]
    rows_ += [(5000 + i, text(small, zipf(3000), 800), "small") for i in range(3)]
    rows_ += [(6000 + i, text(flat, [1] * 400, 300), "flat") for i in range(30)]
    rows_ += [(7000, text(tiny, zipf(3000), 60), "tiny"), (8000, text(junk, [1] * 3000, 300), "large"), (8001, text(junk, [1] * 3000, 300), None)]
    # Words of this one never repeat.
    rows_ += [(9000 + i, " ".join(made("m" + str(i), 300)), "loose") for i in range(20)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, lang string").repartition(8)
    got = {x.doc_id: x.kept for x in quality.judge(df).collect()}
    assert all(got[i] for i, _, lang in rows_ if lang in ("small", "flat", "tiny", "loose"))
    assert not got[8000] and sum(got[i] for i in range(4000)) > 3900
    known = quality.references(df)
    assert set(known) == {"large", "small", "flat", "loose"} and not known["loose"].telling
    assert len(known["flat"].common) > quality.COMMON_WORDS and known["flat"].telling


def test_a_label_is_no_way_round(spark):
    """Junk with a label of its own fails by its characters; a filter ends soon."""
    r = random.Random(8)
    clean = [(i, prose(80, i), "en") for i in range(200)]
    junk = [(1000 + i, " ".join("".join(r.choice("{}[]~^+=0123456789") for _ in range(6)) for _ in range(60)), f"l{i}") for i in range(5)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    judged = quality.judge(df)
    assert judged.where("kept").count() == 200 and judged.where("kept AND doc_id >= 1000").count() == 0


def test_quality_distances(spark):
    r = np.random.default_rng(6)
    for _ in range(5):
        p, q = r.integers(0, 9, 7).astype(float), r.integers(0, 9, 7).astype(float) + 0.01
        a, b = p / p.sum(), q / q.sum()
        m = (a + b) / 2
        kl = lambda x: sum(u * math.log2(u / v) for u, v in zip(x, m) if u > 0)
        df = spark.createDataFrame([(p.tolist(),)], "c array<double>")
        got = df.select(quality.js_distance(quality.shares(df["c"]), F.array(*map(F.lit, b.tolist())))).first()[0]
        assert math.isclose(got, math.sqrt((kl(a) + kl(b)) / 2), abs_tol=1e-9)


def test_quality_is_native(docs):
    plan = quality.verdicts(docs, quality.references(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_near_copies_give_few_links(spark):
    """Links of a group of near copies are fewer than its sets, also where ids are null."""
    words = [f"w{k}" for k in range(120)]
    rows_ = []
    for i in range(300):
        r = random.Random(i)
        own = list(words)
        for k in r.sample(range(120), r.randrange(1, 4)):
            own[k] = f"x{i}_{k}"
        rows_.append((None if i % 2 else i, " ".join(own)))
    df = spark.createDataFrame(rows_, "doc_id long, text string").repartition(4)
    join = sigtree.Join(df)
    links, comps = join.links()
    assert links.count() < 2 * len(rows_)
    sets = [{tuple(t.split()[k : k + 4]) for k in range(117)} for _, t in rows_]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(sets)):
        groups[root(i)].append(rows_[i][0])
    want = sorted((min((x for x in g if x is not None), default=None) or 0) for g in groups.values() for _ in g)
    assert sorted(r.component_id or 0 for r in join.groups().collect()) == want


def test_cells_pass_in_batches(spark, monkeypatch):
    r = random.Random(4)
    nodes = [(n, 10 + n, b"s", sorted({r.randrange(40) for _ in range(r.randrange(1, 9))} | ({99} if n % 2 else set()))) for n in range(500)]
    made = spark.createDataFrame(nodes + nodes[:100], "node long, n long, signature binary, prefix array<long>").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    got = sorted(map(tuple, sigtree.cells(made).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    by = defaultdict(dict)
    for n, size, _, prefix in nodes:
        for c in prefix:
            by[c][n] = size
    want = [(c, n, s, min(of), of[min(of)], min(len(of), sigtree.MANY)) for c, of in by.items() if len(of) > 1 for n, s in of.items()]
    assert got == sorted(want)


def test_clashing_names(spark):
    """The stages keep columns whatever they are called."""
    odd = ["_id", "_key", "__id", "_doc", "_ranges", "_N_words", "_hit_words", "__hit_items", "_lang_pred", "_score", "__score", "_n_spans"]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` int" for c in odd)
    df = spark.createDataFrame([(i, prose(40, i), "en" if i % 2 else None, *range(len(odd))) for i in range(12)], schema)
    items = spark.createDataFrame([(1, "no such words here")], "item_id long, text string")
    for made in (langid.keep_known(df), sigtree.keep_one(df), suffixdedup.remove(df), decontam.decontaminate(df, items)):
        assert made.columns == df.columns and made.count() == 12
        assert tuple(made.first())[3:] == tuple(range(len(odd)))
    assert langid.keep_known(df).where("lang IS NULL").count() == 0
