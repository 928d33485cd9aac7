"""The decision against its truth table."""

from itertools import product

from pyspark.sql import functions as F

from pagesift.operators.decide import category, final_label

TP, CP = ("A", "unknow", None), ("A", "B", "unknow", None)
TC, CC = ("A1", None), ("A1", "B1", None)
PROBS = (
    (0.9, 0.5), (0.5, 0.9), (0.6, 0.6), (0.9, 0.9), (0.8, 0.8), (0.5, 0.5), (None, 0.9), (0.9, None), (None, None),
)
LABEL, ONLY = ("", "A", "B", "C"), (True, False)


def expected(tp, cp, tc, cc, probs, label, only):
    """Written from the table of cases, one return per line of it."""
    tpp, cpp = probs[0] or 0.0, probs[1] or 0.0
    first = lambda *xs: next((x for x in xs if x is not None), None)
    if tp != "unknow" and cp != "unknow":
        if tc == cc:
            return tc
        if label:
            return first(tc, label) if label == tp else first(cc, label) if label == cp else label
        if only and tpp > 0.5:
            return tc
        if tpp >= cpp and tpp > 0.8:
            return first(tc, tp)
        return first(cc, cp) if tpp < cpp and cpp > 0.8 else "unknow"
    if tp != "unknow":
        if label:
            return first(tc, tp) if label == tp else label
        return first(tc, tp) if (only and tpp > 0.5) or tpp > 0.8 else "unknow"
    if cp != "unknow":
        if label:
            return first(cc, cp) if label == cp else label + "_unknow"
        return first(cc, cp) if cpp > 0.8 else "unknow"
    return "unknow"


def test_truth_table(spark):
    cases = list(product(TP, CP, TC, CC, PROBS, LABEL, ONLY))
    rows = [(i, c[0], c[1], c[2], c[3], c[4][0], c[4][1], c[5], c[6]) for i, c in enumerate(cases)]
    df = spark.createDataFrame(
        rows,
        "i int, tp string, cp string, tc string, cc string, tpp double, cpp double, label string, only boolean",
    )
    c = F.col
    got = df.select(
        "i", category(c("tp"), c("tpp"), c("tc"), c("cp"), c("cpp"), c("cc"), c("label"), c("only")).alias("cat")
    )
    assert {r.i: r.cat for r in got.collect()} == {i: expected(*case) for i, case in enumerate(cases)}


def test_final_keeps_null_and_drops_unknown(spark):
    schema = (
        "fid long, ftitle string, src_type string, furl string, title_pcat string, title_pprob double, "
        "title_ccat string, content_pcat string, content_pprob double, content_ccat string, "
        "site_label string, is_title_only boolean"
    )
    rows = [
        (1, "t", "s", "u", "A", None, None, None, None, None, "", False),  # null category
        (2, "t", "s", "u", "unknow", -1.0, None, "unknow", -1.0, None, "A", False),
        (3, "t", "s", "u", "unknow", -1.0, None, "A", 0.1, None, "health", False),
    ]
    got = {r.fid: r for r in final_label(spark.createDataFrame(rows, schema)).collect()}
    assert {k: r.cat for k, r in got.items()} == {1: None, 3: "health_unknow"}
    assert (got[1].title_pprob, got[1].content_pprob, got[1].algo_ver) == (0.0, 0.0, "algo_basic")
