"""Hand-made rows for the scalar functions and row rules."""

import pytest
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.functions import hashing, text, urls
from pagesift.operators import filters
from pagesift.operators.filters import Rules
from pagesift.operators.words import ROW, keyword_rows, keywords, row_key


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_site_prefixes(spark):
    strict = ["https://m.a.com/x", "https://m.120b.com/x", "http://a.com:80/z", "https://m.120ask.com/x/y", None]
    assert column(spark, strict, urls.site_strict) == ["https://m.a.com/", "", "", "", None]
    lax = ["https://m.120b.com/x", "http://nohost", "https:///a/b/", None]
    assert column(spark, lax, urls.site) == ["https://m.120b.com/", "", "https:///a/", None]


def test_length_in_characters(spark):
    assert column(spark, ["中文a", "", None], text.content_len) == [3, 0, None]


def test_keep_script(spark):
    assert column(spark, ["ab中文,c字", None], text.keep_script) == [" 中文 字", ""]


def test_clean_markup(spark):
    given = ["x<b>y</b>z<", "\t a\n", "<a\nhref>t", "a\rb", "\x00\x1fx ", None]
    assert column(spark, given, text.clean_markup) == ["x y z<", "a", " t", "a\rb", "x ", ""]


def test_tokenize(spark):
    given = ["The cat, the CAT 12", "中文字 x 一", "", None]
    assert column(spark, given, text.tokenize) == [
        ["the", "cat", "the", "cat", "12"],
        ["中文", "文字", "x", "一"],
        [],
        [],
    ]


def test_keywords(spark):
    tokens = spark.createDataFrame([(1, ["cat", "x", "run", "cat"]), (2, ["run"]), (3, [])], "fid long, tokens array<string>")
    lexicon = spark.createDataFrame([("cat", "nz"), ("x", "n"), ("run", "v")], "word string, nature string")
    for small in (None, True, False):
        got = {r.fid: r.tokens for r in keywords(tokens, lexicon, small=small).collect()}
        assert got == {1: ["cat", "cat"], 2: [], 3: []}
        twice = spark.createDataFrame([(1, ["cat"]), (1, ["x", "cat", "run"]), (1, ["cat"]), (1, ["cat", "cat"])], "fid long, tokens array<string>")
        assert sorted(r.tokens for r in keywords(twice, lexicon, small=small).collect()) == [["cat"], ["cat"], ["cat"], ["cat", "cat"]]
    by_length = {r.fid: r.tokens for r in keywords(tokens).collect()}
    assert by_length == {1: ["cat", "run", "cat"], 2: ["run"], 3: []}


def test_row_key_is_taken_once_per_text(spark):
    """Computed above the explode, it would hash the whole text for every token."""
    tokens = spark.createDataFrame([(1, ["cat", "x"])], "fid long, tokens array<string>")
    lexicon = spark.createDataFrame([("cat", "n")], "word string, nature string")
    made = keyword_rows(tokens, lexicon, small=True, extra=[row_key().alias(ROW)])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("xxhash64") > plan.index("Generate")
    assert [(r.pos, r.token) for r in made.collect()] == [(0, "cat")]


def test_fnv1a64_is_no_fold_over_characters(spark):
    plan = spark.createDataFrame([("a",)], "w string").select(hashing.fnv1a64(F.col("w")))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "ArrowEvalPython" in plan


def test_fnv1a64_over_many_batches(spark):
    """Repeats, long words around the length that is hashed word by word, nulls between."""
    words = [None if i % 7 == 0 else chr(97 + i % 26) * (i % 90) for i in range(3000)]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(3)
    got = {r.w: r.h for r in df.select("w", hashing.fnv1a64(F.col("w")).alias("h")).collect()}
    assert got == {w: None if w is None else _fnv(w.encode()) for w in words}


def _fnv(data: bytes) -> int:
    h = fixed.FNV_OFFSET_BASIS
    for b in data:
        h = ((h ^ b) * fixed.FNV_PRIME) % (1 << 64)
    return hashing.signed64(h)


def test_fnv1a64(spark):
    words = ["a", "foobar", "", "中文", "naïve", "\x7f\u0080ÿ", "x" * 300, None]
    got = column(spark, words, hashing.fnv1a64)
    assert got[:2] == [hashing.signed64(0xAF63DC4C8601EC8C), hashing.signed64(0x85944171F73967E8)]
    assert got == [None if w is None else _fnv(w.encode()) for w in words]


def test_md5_prefix(spark):
    assert column(spark, ["abc", None], hashing.md5_64) == [-8070080442485551184, None]


def test_masks_and_distance(spark):
    for block, mask in enumerate((0x0000FFFFFFFFFFFF, 0xFFFF0000FFFFFFFF, 0xFFFFFFFF0000FFFF, 0xFFFFFFFFFFFF0000)):
        got = column(spark, [-1], lambda c, b=block: hashing.mask_block(c, b), "long")
        assert got == [hashing.signed64(mask)]
    with pytest.raises(ValueError):
        hashing.mask_block(F.lit(1), 4)
    near = spark.createDataFrame([(5, 4), (5, 6), (7, 7), (0, -(2**63))], "a long, b long")
    got = [r[0] for r in near.select(hashing.within_bits(F.col("a"), F.col("b"), 1)).collect()]
    assert got == [True, False, True, True]


LABELS = [("mall.a.com", "tech"), ("detail.mall.a.com", "tech2"), ("b.com", "health")]


def test_site_label(spark):
    given = ["http://x.org/", "http://b.com/", "http://detail.mall.a.com/", "http://mall.a.com/", "", None]
    got = column(spark, given, lambda c: urls.site_label(c, LABELS))
    assert got == ["", "health", "", "tech", "", ""]
    assert column(spark, ["x"], lambda c: urls.site_label(c, [])) == [""]


@pytest.mark.parametrize("extra", [0, 200])
def test_contains_any(spark, extra):
    patterns = ["spam", "ad.net"] + [f"none{i}" for i in range(extra)]
    given = ["http://spam.org/", "http://ok.org/", "http://ad.net/", "", None]
    assert column(spark, given, lambda c: urls.contains_any(c, patterns)) == [True, False, True, False, False]


PHRASES = fixed.JUNK_TITLES


def test_junk_title(spark):
    rules = Rules()
    titles = [*PHRASES, "第12章 x", "x 第 3 章", "clean", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, ftitle string")
    both = df.select(
        filters.title_ok(rules).alias("a"), filters.title_ok(rules, as_built=True).alias("b")
    ).collect()
    assert [r.a for r in both] == [False] * 6 + [True, True]
    assert all(r.b for r in both)
    all_at_once = " ".join(PHRASES) + " 第1章"
    one = spark.createDataFrame([(all_at_once,)], "ftitle string")
    assert one.select(filters.title_ok(rules, as_built=True)).first()[0] is False


def test_report_rule(spark):
    rules = Rules(useless=["spam.org"])
    rows = [
        (1, None, fixed.SEARCH_HOME_TITLE, "x"),  # a null URL is kept
        (2, "http://ok.org/", None, "x"),
        (3, "http://ok.org/", fixed.SEARCH_HOME_TITLE, "x"),
        (4, "http://spam.org/", "t", "x"),
        (5, "http://ok.org/", "t", "ERROR 5"),
        (6, "http://ok.org/", "t", None),
        (7, "http://ok.org/", "t", "x"),
    ]
    df = spark.createDataFrame(rows, "fid int, furl string, ftitle string, fcontent string")
    assert [r.fid for r in df.where(filters.report_row_ok(rules)).orderBy("fid").collect()] == [1, 7]


def test_drop_unusable(spark):
    rules = Rules(useless=["spam.org"], commerce=["https://shop.com/"])
    rows = [
        (1, None, None, None),
        (2, "http://spam.org/", "t", "x"),
        (3, "https://shop.com/", "t", "x"),
        (4, "http://ok.org/", "第1章", "x"),
        (5, "http://ok.org/", "t", " ERROR 5"),
        (6, "http://ok.org/", "t", "no ERROR"),
    ]
    df = spark.createDataFrame(rows, "fid int, furl string, ftitle string, fcontent string")
    flagged = df.withColumn("is_error_body", filters.error_body(rules, trimmed=True)).drop("fcontent")
    for given in (df, flagged):
        assert [r.fid for r in filters.drop_unusable(given, rules).orderBy("fid").collect()] == [1, 6]
        assert filters.drop_unusable(given, rules, "as_built").count() == 6
    with pytest.raises(ValueError):
        filters.drop_unusable(df, rules, "other")


def test_plain_words_are_cut_not_extracted(spark):
    """Words of texts without Han are cut at what parts them, without empty ones."""
    given = [None, "", " ", "..a..É1²_\n", "a", " a b", "\x00x\U0001d400-\U0001f600y", "½ Ⅷ"]
    assert column(spark, given, text.tokenize) == [[], [], [], ["a", "é1²"], ["a"], ["a", "b"], ["x\U0001d400", "y"], ["½", "ⅷ"]]
    rows = spark.createDataFrame([("a b",)], "t string")
    plan = rows.select(text.tokenize(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "ELSE array_remove(split(" in plan
