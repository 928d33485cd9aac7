"""Scoring: codes, plug-in models, both ways of joining the weights."""

import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.operators import classify, parts
from pagesift.operators.lookup import fits, lookup_join
from pagesift.operators.parts import pack, sums_by_part

WEIGHTS = [
    ("all", "ball", "__label__sport", 2.0), ("all", "ball", "__label__tech", 0.5),
    ("all", "chip", "__label__tech", 3.0), ("all", "", "__label__sport", 0.1), ("all", "", "__label__tech", -0.1),
    ("sport", "ball", "football", 1.0), ("sport", "goal", "football", 1.0), ("sport", "net", "tennis", 2.0),
    ("tech", "chip", "hardware", 1.0), ("tech", "code", "software", 1.0), ("tech", "app", "mobile", 1.0),
]
TEXTS = [(1, "ball goal"), (2, "chip chip ball"), (3, ""), (4, None), (5, "nothing known"), (6, " \t ")]


@pytest.fixture(scope="module", params=["broadcast", "salted"])
def model(request, spark):
    table = spark.createDataFrame(WEIGHTS, "model string, token string, label string, weight double")
    made = classify.topic_model(table, max_broadcast_rows=10**6 if request.param == "broadcast" else 0)
    assert made.small is (request.param == "broadcast") and made.slots == 3
    return made


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "fid long, words string")


def softmax(logits):
    top = max(logits.values())
    total = sum(math.exp(z - top) for z in logits.values())
    return {k: math.exp(z - top) / total for k, z in logits.items()}


def test_root_scores_and_codes(texts, model):
    got = {r.fid: (r.label, r.prob) for r in classify.score_labels(texts, model, tokens="words").collect()}
    one = softmax({"sport": 2.0 + 0.1, "tech": 0.5 - 0.1})
    two = softmax({"sport": 2.0 / 3 + 0.1, "tech": 6.5 / 3 - 0.1})
    assert got[1] == ("sport", pytest.approx(one["sport"]))
    assert got[2] == ("tech", pytest.approx(two["tech"]))
    assert [got[i] for i in (3, 4, 5, 6)] == [("unknow", -1.0), ("unknow", -1.0), ("unknow", -3.0), ("unknow", -1.0)]


def test_child_codes_and_missing_model(spark, model):
    rows = [(1, "goal", "sport"), (2, "zzz", "sport"), (3, "", "sport"), (4, "goal", "nomodel"), (5, "zzz", "all")]
    df = spark.createDataFrame(rows, "fid long, words string, parent string")
    got = {r.fid: (r.parent, r.label, r.prob) for r in classify.score_labels(df, model, tokens="words", key="parent").collect()}
    assert got[1][:2] == ("sport", "football")
    assert got[2] == ("sport", "sport_other", -4.0)
    assert got[3] == ("sport", "unknow", -1.0)
    assert got[4] == ("nomodel", "nomodel_other", -4.0)
    assert got[5] == ("all", "unknow", -3.0)


def test_ties_go_to_the_smaller_label(spark):
    table = spark.createDataFrame([("all", "t", "b", 1.0), ("all", "t", "a", 1.0)], "model string, token string, label string, weight double")
    df = spark.createDataFrame([(1, "t")], "fid long, words string")
    assert classify.score_labels(df, classify.topic_model(table), tokens="words").first().label == "a"


def test_parents_children_and_both_at_once(texts, model):
    parents = classify.parent_labels(texts, model)
    assert parents.columns == ["fid", "words", "cat", "prob"] and parents.count() == len(TEXTS)
    children = classify.child_labels(parents, model, ["sport", "tech"])
    kids = {r.fid: (r.words, r.cat) for r in children.collect()}
    assert kids == {1: ("ball goal", "football"), 2: ("chip chip ball", "hardware")}
    assert classify.child_labels(parents, model, ["tech"]).count() == 1

    tokens = texts.withColumn("tokens", F.split(F.coalesce("words", F.lit("")), r"\s+"))
    tokens = tokens.withColumn("tokens", F.filter("tokens", lambda w: w != ""))
    rows = classify.two_level_labels(tokens, model, model, ["tech"], ("fid",), "tokens", "title").collect()
    got = {r.fid: (r.title_pcat, r.title_ccat) for r in rows}
    assert got == {
        1: ("sport", None), 2: ("tech", "hardware"), 3: ("unknow", None), 4: ("unknow", None), 5: ("unknow", None), 6: ("unknow", None),
    }
    probs = {r.fid: (r.cat, r.prob) for r in parents.collect()}
    assert {r.fid: (r.title_pcat, r.title_pprob) for r in rows} == {k: pytest.approx(v) for k, v in probs.items()}


def test_label_only(texts, model):
    assert classify.score_label_only(texts, model, tokens="words").columns == ["fid", "label"]


def test_plugin_isolates_failures(texts):
    def load():
        return {"sport": "ball"}

    def score(model, words):
        if words.startswith("nothing"):
            raise RuntimeError("no")
        return ("sport" if model["sport"] in words else "other"), 0.5

    got = {r.fid: (r.label, r.prob) for r in classify.score_with(texts, load, score).collect()}
    failed, blank = (fixed.UNKNOWN, fixed.SCORER_FAILED), (fixed.UNKNOWN, fixed.BLANK_TEXT)
    assert got == {1: ("sport", 0.5), 2: ("sport", 0.5), 3: blank, 4: blank, 5: failed, 6: blank}


def test_plugin_without_an_answer(spark):
    rows = spark.createDataFrame([("d", 1, "x", "sport"), ("d", 2, "y", "sport"), ("e", 2, None, "tech")], "day string, fid long, words string, cat string")
    none = lambda model, words, parent=None: None if words == "x" else (f"{parent}!", 1.0)
    got = classify.score_with(rows, dict, none, ("day", "fid")).collect()
    assert [(r.day, r.fid, r.label, r.prob) for r in got] == [("d", 1, "unknow", -3.0), ("d", 2, "None!", 1.0), ("e", 2, "unknow", -1.0)]
    kids = classify.child_labels(rows, classify.Plugin(dict, none), ["sport"], ("day", "fid")).collect()
    assert [(r.day, r.fid, r.words, r.cat, r.prob) for r in kids] == [("d", 1, "x", "sport_other", -4.0), ("d", 2, "y", "sport!", 1.0)]


def test_repeated_ids_are_rows_of_their_own(spark, model):
    rows = spark.createDataFrame([(1, "ball goal"), (1, "chip"), (1, "chip")], "fid long, words string")
    assert sorted(r.label for r in classify.score_labels(rows, model, tokens="words").collect()) == ["sport", "tech"]
    assert sorted((r.words, r.cat) for r in classify.parent_labels(rows.distinct(), model).collect()) == [("ball goal", "sport"), ("chip", "tech")]


def test_salted_lookup_of_a_hot_word(spark):
    rows = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "the").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("token"))
    table = spark.createDataFrame([("the", 1), ("w1", 2), ("w7", 3)], "token string, n int")
    for how in ("inner", "left", "left_semi"):
        ways = [sorted(lookup_join(rows, table, ["token"], ["id"], small, how).collect(), key=str) for small in (True, False)]
        assert ways[0] == ways[1] and ways[0]
    assert fits(table, 3) and not fits(table, 2)


def _both_ways(spark, table, score):
    """The rows that ``score`` gives with a broadcast model and with a large one."""
    made = [classify.topic_model(table, max_broadcast_rows=rows) for rows in (10**6, 0)]
    assert [m.small for m in made] == [True, False]
    return [sorted((*r[:-1], round(r[-1], 9)) if isinstance(r[-1], float) else tuple(r) for r in score(m).collect()) for m in made]


ODD = [
    (1, ["ball", "goal"]), (1, ["chip"]), (1, ["chip"]), (2, []), (3, None), (4, [None, None]), (5, ["", "ball"]), (6, [""]),
    (7, ["ball\x00chip", None, "ball"]), (8, ["ball\x00chip"]), (None, ["net", "ball"]), (9, ["zzz"] * 300 + ["app"]),
]


def test_large_model_scores_odd_rows_alike(spark):
    table = spark.createDataFrame(WEIGHTS, "model string, token string, label string, weight double")
    rows = spark.createDataFrame(ODD, "fid long, tokens array<string>").repartition(3)
    few = lambda m: classify.score_labels(rows, m).na.fill(-99)
    a, b = _both_ways(spark, table, few)
    assert a == b and len(a) == len(ODD) - 1
    named = rows.withColumn("of", F.when(F.col("fid") % 3 == 0, "sport").when(F.col("fid") % 3 == 1, "tech"))
    a, b = _both_ways(spark, table, lambda m: classify.score_labels(named, m, key="of").na.fill(-99).na.fill("none"))
    assert a == b


def test_large_model_scores_two_levels_alike(spark):
    table = spark.createDataFrame(WEIGHTS, "model string, token string, label string, weight double")
    rows = spark.createDataFrame(ODD, "fid long, tokens array<string>")
    two = lambda m: classify.two_level_labels(rows, m, m, ["sport", "tech"], ["fid"], "tokens", "t").select(
        F.coalesce("fid", F.lit(-1)), "t_pcat", F.coalesce("t_ccat", F.lit("none")), F.round("t_pprob", 9), F.coalesce("t_cprob", F.lit(0.0))
    )
    a, b = _both_ways(spark, table, two)
    assert a == b


def test_large_model_moves_texts_and_not_tokens(spark):
    """No join or explode sees a row per token: a word a text repeats is asked for once."""
    table = spark.createDataFrame(WEIGHTS, "model string, token string, label string, weight double")
    model = classify.topic_model(table, max_broadcast_rows=0)
    rows = spark.range(40).select(F.col("id").alias("model"), F.array(F.lit("ball"), F.lit("ball")).alias("w"))
    rows = rows.select(F.col("model").alias("fid"), F.lit("all").alias("model"), pack(F.col("w")).alias("_words"))
    made = sums_by_part(rows, ["fid"], model.weights, model.slots)
    assert "Generate" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["_tokens"], r["_known"]) for r in made.collect()} == {(2, 2)}


def test_large_model_looks_up_distinct_tokens_only(spark, monkeypatch):
    """A token that texts of a batch repeat is looked up among the weights once;
    where pairs are too many for a table of them, sums are the same."""
    asked = []
    monkeypatch.setattr(parts.np, "searchsorted", lambda a, v, f=parts.np.searchsorted: asked.append(len(v)) or f(a, v))
    words = [["ball"] * 5 + ["zzz"] * 4, ["chip", "ball", None], [None], [], None, ["net", "ball\x00net"]]
    packed = [{"text": "\x00".join(w), "words": None} if w and None not in w and "ball\x00net" not in w else {"text": None, "words": w} for w in words]
    kind = pa.struct([("text", pa.string()), ("words", pa.list_(pa.string()))])
    texts = pa.table({"_part": pa.array([3] * 6, pa.int32()), "fid": pa.array(range(6)),
                      "model": ["all", "all", "all", "sport", None, "none"], "_words": pa.array(packed, kind)})
    found = pa.table({"_part": pa.array([3] * 3, pa.int32()), "model": ["all", "all", "sport"], "token": ["ball", "chip", "net"],
                      "w0": [2.0, None, 1.0], "w1": [0.5, 3.0, None]})
    made, wanted = [], []
    for most in (10**6, 0):
        monkeypatch.setattr(parts, "_MOST_CODES", most)
        made.append(sorted(map(str, parts._summing(["fid"], 2)(texts, found).to_pylist())))
        wanted.append(sorted(map(str, parts._wanted(texts).to_pylist())))
        if most:
            assert sum(asked) == 6  # all: ball, zzz; all: ball, chip; none: net, ball\0net
    assert made[0] == made[1] and wanted[0] == wanted[1] and len(wanted[0]) == 5
    assert str({"fid": 0, "model": "all", "_tokens": 9, "_known": 5, "m0": 10.0, "m1": 2.5}) in made[0]
    assert str({"fid": 1, "model": "all", "_tokens": 2, "_known": 1, "m0": 2.0, "m1": 3.5}) in made[0]
    assert str({"fid": 5, "model": "none", "_tokens": 2, "_known": 0, "m0": None, "m1": None}) in made[0]
