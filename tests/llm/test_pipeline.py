"""The pipeline, stage by stage, against brute force."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from pagesift.llm import langid
from pagesift.llm.queries import word_bpe
from pagesift.llm.tasks import staged
from test_llm import brute_groups, brute_hits


def cut_repeats(pairs):
    """{id: text without bytes that an earlier 100-byte string covers}."""
    met, out = {}, {}
    for i, t in sorted(pairs):
        b = t.encode()
        for k in range(len(b) - 99):
            met.setdefault(b[k : k + 100], (i, k))
    for i, t in pairs:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            if met[b[k : k + 100]] != (i, k):
                gone[k : k + 100] = True
        out[i] = np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
    return out


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, "s", 0), (9002, "123 !!! 45", "en", "s", 10), (9003, "", "de", "s", 0)], docs.schema)
    docs = docs.unionByName(extra)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_order_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "suffix_dedup", "decontamination", "packing"]
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_documents_without_language_go(stages):
    assert set(texts(stages[0])) - set(texts(stages[1])) == {9001, 9002, 9003}


def test_documents_in_three_languages_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(docs)
    words = {x: max((r.text for r in docs.where(f"lang = '{x}'").collect()), key=len).split() for x in ("de", "en", "fr")}
    mixed = [(9100, " ".join(words["en"][:80] + words["de"][:60] + words["fr"][:60]), None, "s", 0), (9101, "12 !", None, "s", 0), (9102, None, None, "s", 0)]
    df = spark.createDataFrame(mixed, docs.schema)
    assert langid.predict(df, model).where("doc_id = 9100 and score < 0.5 and n_spans >= 3").count() == 1
    assert set(texts(langid.keep_known(df, model=model))) == {9100}
    # Nothing is labelled, so there is nothing to learn.
    assert set(texts(corpus_pipeline.language_id(spark, df, sf_dir))) == {9100}


def test_one_of_each_near_group_stays(stages):
    before, after = texts(stages[1]), texts(stages[2])
    groups = brute_groups(list(before.items()), 5, 80)
    assert after == {i: before[i] for i, _, c in groups if i == c} and len(after) < len(before)


def test_repeated_passages_are_cut(stages):
    before, after = texts(stages[2]), texts(stages[3])
    want = {i: t for i, t in cut_repeats(list(before.items())).items() if t.strip() or not before[i].strip()}
    assert after == want and after != before
    assert all(r.n_chars == len(r.text) for r in stages[3].collect() if r.text != before[r.doc_id])


def test_benchmark_passages_are_cut(spark, sf_dir, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = texts(stages[3]), texts(stages[4])
    dirty = {int(x[0]) for x in brute_hits(list(before.items()), items) if x[5]}
    assert dirty and not any(x[5] for x in brute_hits(list(after.items()), items))
    assert {i: t for i, t in after.items() if i not in dirty} == {i: t for i, t in before.items() if i not in dirty}


def test_every_id_is_packed_once(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_bpe())
    pieces = defaultdict(list)
    for r in stages[5].collect():
        pieces[r.doc_id].append(r)
    kept = texts(stages[4])
    assert set(pieces) == set(kept)
    for i, t in kept.items():
        ids, at = [*tokenizer.encode(t, add_special_tokens=False).ids, 1], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.asarray(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
