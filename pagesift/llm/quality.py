"""Quality rules on the distributions of characters and common words.

The base rules count words, symbols, repeated lines and repeated five-word
windows. The method compares two histograms of a document, of its character
classes and of the common words of the languages, with those of each language
by Jensen-Shannon distance; a document that is far from every language fails.
The languages' histograms are counted over all documents, for every language
with ``MIN_REFERENCE`` characters. All of it is DataFrame functions.

The common words of a language are its ``COMMON_WORDS`` most frequent ones and
further ones until they are ``COMMON_SHARE`` of its words. Where words with
``MIN_SHARE`` do not reach that, any text without them is near, so the language
judges only texts that are labelled as its own or not at all. A text whose
language has too few characters for a histogram has its classes of characters
compared with those of all languages; its words are not, as none are known.

Defined results: a null or empty text has no words and fails the base rules; a
text below the minimum lengths is not compared; with no language to compare
with (an empty table, only null languages) the base rules decide; rows are
judged one by one, so repeated ids and ties need no rule.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.functions.hashing import let, signed64
from pagesift.llm.tasks import staged

SPACE = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
# Of the method: texts this short say too little about a distribution.
MIN_CHARS = 200
MIN_COMMON = 40
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.3
COMMON_WORDS = 12
COMMON_SHARE = 0.25
# A word of a language's reference has at least this share of its words.
MIN_SHARE = 0.001
# Characters of a language that make a stable histogram.
MIN_REFERENCE = 10_000

DIGITS = "0123456789"
MARKS = ".,;:!?'\"()-"


def text_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))


def window_hashes(hashes: Column) -> Column:
    """Hashes of all windows of ``WINDOW`` words, from the words' hashes."""
    n = F.size(hashes)
    window = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
    return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)).otherwise(F.array().cast("array<bigint>"))


def ordered_windows(windows: Column) -> Column:
    """The windows' hashes with their places, sorted; empty if all differ."""
    keyed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.array_sort(keyed)).otherwise(none)


def repeated_places(ordered: Column) -> Column:
    """In order, the places of windows that are equal to a neighbour in the sorted array."""
    same = lambda i, j: F.get(ordered, j)["h"] == F.get(ordered, i)["h"]
    kept = F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)),
    )
    places = F.transform(kept, lambda i: F.get(ordered, i)["i"])
    return F.when(F.size(ordered) >= 2, F.array_sort(places)).otherwise(F.array().cast("array<int>"))


def covered_words(places: Column) -> Column:
    """Words in repeated windows: each adds those up to the next, five at most."""
    step = lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))
    return F.aggregate(F.transform(places, step), F.lit(0), lambda a, x: a + x)


def without_small(text: Column) -> Column:
    """The text without its small letters, which are most of it."""
    return F.regexp_replace(text, "\\p{Ll}+", "")


def without_letters(text: Column) -> Column:
    return F.regexp_replace(text, "\\p{L}+", "")


def marked_kinds(no_letters: Column) -> Column:
    """Every character of the four kinds as the first of its kind, in one pass."""
    kinds = (SPACES, DIGITS, MARKS, SYMBOLS)
    return F.translate(no_letters, "".join(kinds), "".join(k[0] * len(k) for k in kinds))


def kind_counts(kinds: Column) -> Column:
    """Of a text from ``marked_kinds``: its spaces, digits, marks, symbols and
    others. Each kind is taken out of what the one before left."""
    left = [kinds]
    for k in (SPACES, DIGITS, MARKS, SYMBOLS):
        left.append(F.replace(left[-1], F.lit(k[0]), F.lit("")))
    return F.array(*[F.length(a) - F.length(b) for a, b in zip(left, left[1:])], F.length(left[-1]))


def class_counts(length: Column, no_small: Column, no_letters: Column, counts: Column) -> Column:
    """Characters by class, as an array of doubles, from a text's length, the
    text without small letters, that without letters and its ``kind_counts``."""
    spaces, digits, marks, symbols, others = (F.get(counts, F.lit(i)) for i in range(5))
    parts = [F.length(no_small) - F.length(no_letters), length - F.length(no_small), digits, marks, symbols, spaces, others]
    return F.array(*[p.cast("double") for p in parts])


CLASSES = 7


def _entropy_terms(p: Column, q: Column) -> Column:
    return F.when(p > 0, p * F.ln(p / ((p + q) / 2))).otherwise(F.lit(0.0))


def shares(counts: Column) -> Column:
    """Counts (a column that is computed already) as shares; null if all are 0."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.transform(F.arrays_zip(counts.alias("c"), F.array_repeat(total, F.size(counts)).alias("t")), lambda x: x["c"] / x["t"]))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence of two arrays of shares,
    with base 2: 0 to 1; null if one is null."""
    terms = F.zip_with(p, q, lambda x, y: _entropy_terms(x, y) + _entropy_terms(y, x))
    both = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(both / 2 / F.ln(F.lit(2.0)), F.lit(0.0)))


@dataclass(frozen=True)
class Reference:
    """Of a language: characters by class, common words and how often, all words."""

    classes: list[float]
    common: dict[str, float]
    n_words: float

    @property
    def words(self) -> list[float]:
        return [*self.common.values(), self.n_words - sum(self.common.values())]

    @property
    def telling(self) -> bool:
        """Is a text without the common words far from this language?"""
        return sum(self.common.values()) >= COMMON_SHARE * self.n_words


def common_words(counts: list[tuple[int, str]], total: float) -> dict[str, float]:
    """Of ``(-n, word)``, the most frequent ones that make the share."""
    out: dict[str, float] = {}
    for n, w in sorted(counts):
        if len(out) >= COMMON_WORDS and sum(out.values()) >= COMMON_SHARE * total:
            break
        out[w] = float(-n)
    return out


def references(docs: DataFrame) -> dict[str, Reference]:
    """For each language with enough characters: its characters by class and the
    counts of its common words. Both are counted over all documents; what comes
    to the driver is a row per language and at most a thousand words of each."""
    told = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").alias("lang"), F.col("text").alias("text"))
    per_doc = told.select("lang", F.length("text").alias("length"), without_small(F.col("text")).alias("small"))
    per_doc = per_doc.withColumn("rest", without_letters(F.col("small")))
    per_doc = per_doc.withColumn("kinds", kind_counts(marked_kinds(F.col("rest"))))
    per_doc = per_doc.select("lang", class_counts(F.col("length"), F.col("small"), F.col("rest"), F.col("kinds")).alias("c"))
    sums = per_doc.groupBy("lang").agg(*[F.sum(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(CLASSES)])
    enough = sum(F.col(f"c{i}") for i in range(CLASSES)) >= MIN_REFERENCE
    classes = {r["lang"]: [float(r[f"c{i}"]) for i in range(CLASSES)] for r in sums.where(enough).collect()}
    # Outer, since an inner one has the words made a second time to look for none;
    # written, since it is read twice: a row for each word of a language.
    words = told.select("lang", F.explode_outer(F.split(F.lower("text"), SPACE)).alias("w"))
    by_word = staged(words.groupBy("lang", "w").agg(F.count("*").alias("n")).where(F.col("w") != ""), "words")
    all_words = by_word.groupBy("lang").agg(F.sum("n").alias("all"))
    frequent = by_word.join(F.broadcast(all_words.where(F.col("lang").isin(*classes) if classes else F.lit(False))), "lang").where(
        F.col("n") >= MIN_SHARE * F.col("all")
    )
    common: dict[str, list[tuple[int, str]]] = {}
    totals = {}
    for r in frequent.select("lang", "w", "n", "all").collect():
        common.setdefault(r["lang"], []).append((-r["n"], r["w"]))
        totals[r["lang"]] = float(r["all"])
    return {
        lang: Reference(histogram, common_words(common.get(lang, []), totals.get(lang, 1.0)), totals.get(lang, 1.0))
        for lang, histogram in sorted(classes.items())
    }


REFERENCES = "array<struct<lang:string,classes:array<double>,slots:array<int>,words:array<double>,telling:boolean>>"


def word_hash(word: str) -> int:
    """Spark's ``xxhash64`` of a word."""
    return signed64(xxhash.xxh64_intdigest(word.encode(), 42))


def vocabulary(known: dict[str, Reference]) -> list[int]:
    """The hashes of all languages' common words, in order."""
    return sorted({word_hash(w) for r in known.values() for w in r.common})


def constant(value: list, kind: str) -> Column:
    """One constant, so that the plan has one size however long the value is."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def reference_array(known: dict[str, Reference]) -> Column:
    """The references as one constant array; words are given by their places
    in the vocabulary."""
    share = lambda counts: [x / (sum(counts) or 1.0) for x in counts]
    place = {h: i for i, h in enumerate(vocabulary(known))}
    rows = [
        {"lang": lang, "classes": share(r.classes), "slots": [place[word_hash(w)] for w in r.common], "words": share(r.words), "telling": r.telling} for lang, r in known.items()
    ]
    return constant(rows, REFERENCES)


def ordered_with(hashes: Column, vocabulary: Column) -> Column:
    """A text's common words and one more of each, in order: as many runs of
    equal values as there are common words."""
    return F.sort_array(F.concat(hashes, vocabulary))


def run_starts(ordered: Column) -> Column:
    """Where the runs of equal values start, and the end."""
    starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: ~F.get(ordered, i).eqNullSafe(F.get(ordered, i - 1)))
    return F.when(F.size(ordered) > 0, F.concat(starts, F.array(F.size(ordered)))).otherwise(F.array().cast("array<int>"))


def common_shares(starts: Column, slots: Column, n_words: Column) -> Column:
    """The shares of common words among a text's words and that of all others.
    A word's count is the length of its run without the one that was added."""
    counts = F.transform(slots, lambda s: (F.get(starts, s + 1) - F.get(starts, s) - 1) / n_words)
    return let(counts, lambda c: F.concat(c, F.array(F.lit(1.0) - F.aggregate(c, F.lit(0.0), lambda a, x: a + x))))


def judge(docs: DataFrame, known: dict[str, Reference] | None = None) -> DataFrame:
    """The base counts, the distances to the nearest language, and the verdict.
    Written, so that a filter on the result does not copy its steps."""
    return staged(verdicts(docs, references(docs) if known is None else known), "quality")


def verdicts(docs: DataFrame, known: dict[str, Reference]) -> DataFrame:
    common = sorted({w for r in known.values() for w in r.common})
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", lang.alias("_lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = text_words(F.col("text"))
    # Hashes of words in lower case that some language has as a common word.
    shared = F.filter(F.transform("_words", F.lower), lambda w: w.isin(common) if common else F.lit(False))
    rows = rows.withColumns({"_words": words, "_lines": lines_with_words(F.col("text")), "_small": without_small(F.col("text"))})
    rows = rows.withColumn("_rest", without_letters(F.col("_small")))
    rows = rows.withColumn("_kinds", kind_counts(marked_kinds(F.col("_rest"))))
    rows = rows.select(
        "doc_id",
        "_lang",
        F.size("_words").cast("long").alias("n_words"),
        (F.length("text") - F.get("_kinds", F.lit(0))).cast("long").alias("word_chars"),
        F.get("_kinds", F.lit(3)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        F.transform(shared, lambda w: F.xxhash64(w)).alias("_shared"),
        class_counts(F.length("text"), F.col("_small"), F.col("_rest"), F.col("_kinds")).alias("_classes"),
        F.length("text").alias("_chars"),
    )
    rows = rows.withColumn("_windows", window_hashes(F.col("_hashes"))).drop("_hashes")
    rows = rows.withColumn("_ordered", ordered_windows(F.col("_windows"))).drop("_windows")
    rows = rows.withColumn("_places", repeated_places(F.col("_ordered"))).drop("_ordered")
    rows = rows.withColumn("n_repeat_words", covered_words(F.col("_places")).cast("long")).drop("_places")
    rows = rows.withColumn("_shared", ordered_with(F.col("_shared"), constant(vocabulary(known), "array<bigint>")))
    rows = rows.withColumn("_starts", run_starts(F.col("_shared"))).drop("_shared")
    rows = rows.withColumn("_p", shares(F.col("_classes")))
    each = F.transform(
        reference_array(known),
        lambda r: F.struct(
            js_distance(F.col("_p"), r["classes"]).alias("c"),
            F.when(F.col("n_words") > 0, js_distance(common_shares(F.col("_starts"), r["slots"], F.col("n_words")), r["words"])).alias("w"),
            r["lang"].alias("lang"), r["telling"].alias("telling"),
        ),
    )
    rows = rows.withColumn("_each", each if known else F.array().cast("array<struct<c:double,w:double,lang:string,telling:boolean>>"))
    # A label without a reference says nothing of the words, but lifts no other test.
    unknown = F.coalesce(~F.col("_lang").isin(*known), F.lit(False)) if known else F.lit(True)
    judges = lambda x: x["telling"] | F.coalesce(F.col("_lang") == x["lang"], F.lit(True)) | unknown
    near = lambda x: (
        judges(x)
        & _near(x["c"], F.col("_chars") >= MIN_CHARS, MAX_CLASS_DISTANCE)
        & (unknown | _near(x["w"], F.col("n_words") >= MIN_COMMON, MAX_WORD_DISTANCE))
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    accepted = F.exists("_each", near) if known else F.lit(True)
    least = lambda k: F.array_min(F.transform("_each", lambda x: x[k]))
    return rows.withColumns({"base_failed": failed, "class_distance": least("c"), "word_distance": least("w"), "_accepted": accepted}).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("_accepted")).alias("kept"), "class_distance", "word_distance",
    )


def _near(distance: Column, long_enough: Column, most: float) -> Column:
    return ~long_enough | F.coalesce(distance <= most, F.lit(True))
