"""Conversation trie, spelling groups and pieces against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import types as T

from pagesift.llm import piececodec, prefixtrie, spelling
from pagesift.llm.queries import piece_bpe

# Conversations

TALK = "conv_id long, turn long, role string, text string, n_convs long, depth string, a0 long, block string"


def talk_rows():
    r = random.Random(3)
    rows = []
    for c in [*range(-7, 40), 10**12, 10**12 + 3]:
        n = r.choice([0, 1, 2, 3, 5, 8, 9, 17, 30])
        for t in range(n):
            rows.append((c, t, r.choice(["user", "assistant", None]), r.choice(["a", "b", "", None, "é" * 3]) if t else "hello"))
    rows += [(50, None, "user", "first"), (50, 1, "user", "tie"), (50, 1, "user", "tie"), (50, 1, "bot", "tie"), (50, None, None, None)]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None)]
    # Equal conversations, over several chunks of ids.
    rows += [(100_000 + 5 * i, t, "user", f"same {t}") for i in range(300) for t in range(10)]
    return [(*row, 1, "x", 2, "y") for row in rows]


def brute_trie(rows):
    by = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append((t is not None, t or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [turn[3:] for turn in sorted(turns)] for c, turns in by.items()}
    members = defaultdict(list)
    built = {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = (*own.get(c - int(math.fmod(c, 5)), [])[:h], *own[c][h:])
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, convs in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(convs) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not children[p]
    out = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        out.append((convs[0], len(p), parent, len(convs), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("width, stride, chunk", [(8, 4096, 8192), (3, 2, 7)])
def test_trie(spark, monkeypatch, width, stride, chunk):
    monkeypatch.setattr(prefixtrie, "WIDTH", width)
    monkeypatch.setattr(prefixtrie, "STRIDE", stride)
    monkeypatch.setattr(prefixtrie, "CHUNK", chunk)
    rows = talk_rows()
    got = prefixtrie.nodes(spark.createDataFrame(rows, TALK).repartition(5))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie([row[:4] for row in rows])


def test_trie_of_nothing(spark):
    assert prefixtrie.nodes(spark.createDataFrame([], TALK)).collect() == []
    # Conversation 1 starts with the turns of 0, which is not there, and drops its own.
    none = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    got = prefixtrie.nodes(spark.createDataFrame([(none, 0, "user", "gone", 1, "x", 2, "y")], TALK)).collect()
    assert [tuple(r) for r in got] == [(none, 0, None, 1, 0, 1, 0, hashlib.sha256(str(none).encode()).hexdigest())]


def test_a_conversation_of_many_turns(spark):
    rows = [(5, t, "user", f"turn {t % 7}", 1, "x", 2, "y") for t in range(250)] + [(10, 0, "user", "z", 1, "x", 2, "y")]
    got = prefixtrie.nodes(spark.createDataFrame(rows, TALK).repartition(4))
    assert sorted(map(tuple, got.where("depth % 50 = 0").collect()), key=repr) == [
        r for r in brute_trie([row[:4] for row in rows]) if r[1] % 50 == 0
    ]


# Spelling

LETTER = re.compile("[A-Za-zÀ-ÿ]+")


def brute_spelling(rows):
    counts = Counter()
    for doc, text in rows:
        for run in LETTER.findall(text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = defaultdict(set)
    for w in words:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in spelling.LETTERS if len(w) < 100}
        for e in edits & words.keys() - {w}:
            near[w].add(e)
            near[e].add(w)
    best = {w: min(others, key=lambda o: (-words[o], o)) for w, others in near.items()}
    form = {w: b for w, b in best.items() if words[b] >= 5 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def spelling_rows():
    r = random.Random(5)
    base = ["morning", "Evening", "straße", "Élan", "élanvital", "ÉLANVITAL", "aaaaaa", "aaaaaaa", "aaaaaaaa", "×÷×÷×÷×"]
    rows = [(i, " ".join(r.choice(base) for _ in range(200))) for i in range(40)]
    for i in range(40, 60):
        words = []
        for _ in range(60):
            w = r.choice(base[:3])
            k = r.randrange(len(w))
            words.append(r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("aeé") + w[k + 1 :], w[:k] + "x" + w[k:]]))
        rows.append((i, "-".join(words)))
    long = "ab" * 40
    rows += [(70, f"{long} {long}c {long[:-1]} " * 30 + f"{long}d " * 6), (71, ("y" * 3000 + " ") * 6), (72, ("y" * 2999 + " ") * 40)]
    rows += [(None, "morning " * 9), (None, None), (73, ""), (73, None), (73, "123 !"), (74, "morning " * 200_000), (75, "chained " * 5 + "chainedx " * 30 + "chainedxy " * 200), (1, rows[1][1])]
    return rows


def test_chunks_end_where_runs_do(monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK_CHARS", 10)
    text = "abc defghijklmnop qr st uv wx yz " * 9 + "z" * 50
    parts = list(spelling._chunks(text))
    assert "".join(parts) == text and [w for p in parts for w in LETTER.findall(p)] == LETTER.findall(text)


def test_spelling(spark):
    rows = spelling_rows()
    docs = spark.createDataFrame([(*row, "w", 1, "r", 2) for row in rows], "doc_id long, text string, word string, n long, root string, edit int")
    want = brute_spelling(rows)
    assert any(w[1] for w in want) and any(w[1] != w[2] for w in want if w[1])
    got = spelling.group(docs.repartition(3))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert spelling.group(docs.where("false")).collect() == []


def test_spelling_in_many_slices(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = brute_spelling([tuple(r) for r in docs.collect()])
    layout = spelling.Layout(long=9, segment=8, slice_segments=3)
    assert sorted(map(tuple, spelling.group(docs, layout=layout).collect()), key=repr) == want


def test_filters_hold_few_others(spark):
    words = [f"word{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    rows = spark.createDataFrame([(w, 9) for w in words], spelling.WORDS)
    found = [(r.word, r.edit) for r in spelling.positives(rows).collect()]
    known = set(words)
    true = [(a, b) for a, b in found if b in known]
    assert len(true) == len(set(true)) == 1000 * 27 // 2
    assert len(found) - len(true) < 200


# Pieces

ALPHABET = list("abcdefghij ETAO  \n\t.,0123▁éßж日本語のｶﾞﬁ①😀\u0000 ​　﻿ÀÉé")
ODD = ["", " ", "  ", "▁", "▁▁ ▁", " a", "a ", "\x00", "<s></s><unk><0x41>", "Hello  world\t x\n", "a" * 300, "    " * 50, "日本語" * 60, "�"]


def piece_texts():
    r = random.Random(9)
    return ODD + ["".join(r.choice(ALPHABET) for _ in range(r.randrange(1, 60))) for _ in range(300)]


def compare(codec, library, texts):
    for text in texts:
        want = library.encode(text, add_bos=True, add_eos=True)
        parts = list(codec.encode(text))
        ids, begins, ends = (np.concatenate([p[k] for p in parts]).tolist() for k in range(3))
        assert ids == want, text
        assert b"".join(codec.decode([p[0] for p in parts])).decode() == library.decode(want), text
        assert list(zip(begins[1:-1], ends[1:-1])) == [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces], text


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe())


def test_pieces_like_the_library(library, sf_dir, monkeypatch):
    texts = piece_texts()
    codec = piececodec.Codec(piececodec.read_model(piece_bpe()))
    docs = pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist()
    compare(codec, library, texts + [t for t in docs if t][:40])
    monkeypatch.setattr(piececodec, "PART_CHARS", 7)
    monkeypatch.setattr(piececodec, "MAX_CACHED", 20)
    compare(codec, library, texts + ["x" * 5000 + " y" * 3000])


@pytest.mark.parametrize("trim, dummy, fallback", [(True, True, True), (False, True, False), (True, False, True), (False, False, False)])
def test_character_maps(trim, dummy, fallback):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto.FromString(piececodec.read_model(piece_bpe()))
    maps = pb.ModelProto.FromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    model.normalizer_spec.precompiled_charsmap = maps.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces, model.normalizer_spec.add_dummy_prefix = trim, dummy
    model.trainer_spec.byte_fallback = fallback
    if not fallback:
        for piece in model.pieces:
            if piece.type == 6:
                piece.type, piece.piece = 1, "<y" + piece.piece[1:]
    data = model.SerializeToString()
    compare(piececodec.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data), piece_texts()[:150])


def test_broken_bytes_and_odd_ids(library):
    codec = piececodec.Codec(piececodec.read_model(piece_bpe()))
    r = random.Random(2)
    for _ in range(300):
        ids = [r.choice([0, 1, 2, r.randrange(3, 259), 0xE2 + 3, 0x82 + 3, 259, 1526, 28705]) for _ in range(r.randrange(8))]
        assert b"".join(codec.decode([np.array(ids, np.int64)])).decode() == library.decode(ids), ids
    with pytest.raises(ValueError):
        piececodec.Codec(b"")


def test_digests_spans_and_decoding(spark, library):
    data = piececodec.read_model(piece_bpe())
    rows = [(i, t) for i, t in enumerate(piece_texts()[:60])] + [(None, None), (7, None), (7, "again"), (7, "again"), (8, "z" * 40_000 + "é " * 300_000)]
    docs = spark.createDataFrame([(*row, "i", 1, 2) for row in rows], "doc_id long, text string, ids string, part long, n_tokens int")
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((doc_id, len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest(), len((text or "").encode())))
    got = piececodec.digest(docs.repartition(3), data)
    assert sorted(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_span_bytes").collect()), key=repr) == sorted(want, key=repr)

    parts = piececodec.encode(docs.where("doc_id = 8 AND length(text) > 100"), data).orderBy("part").collect()
    raw = rows[-1][1].encode()
    assert [r.part for r in parts] == list(range(len(parts)))
    spans = [s for r in parts for s in zip(r.begins, r.ends)]
    assert b"".join(raw[a:b] for a, b in spans) == raw
    whole = spark.createDataFrame([(1, [1, 22557, 28705, 1526, 2]), (2, []), (3, None)], "ids_of long, ids array<int>")
    assert {r.ids_of: r.decoded for r in piececodec.decode(whole, data).collect()} == {1: library.decode([22557, 28705, 1526]), 2: "", 3: None}
    empty = docs.where("false")
    assert not piececodec.digest(empty, data).collect() and not piececodec.encode(empty, data).collect()
    assert isinstance(piececodec.encode(empty, data).schema, T.StructType)
