"""URL verdicts: rules first, then naive Bayes over segmented names.

Host names are run-together words. A unigram model of the pages' titles splits
them: Viterbi over the letters finds the split with the best product of word
probabilities, where a stretch that is no title word pays for each letter. The
words of host and path are the tokens of a multinomial naive Bayes that learns
from the pages that rules decide and judges the others.

Both models are tables. The lexicon is every word of every title; runs of
letters are found once each, however many pages have them, and their substrings
are looked up in it (a word of more than ``ANCHOR`` letters by its first ones,
then compared). Tokens are counted by the runs they come from. A table of at
most ``SMALL_TABLE`` rows, which are counted, is broadcast; a larger one is
joined by shuffle with frequent keys spread, with the same result. A page's
score is a sum of whole numbers (``FIXED`` to one), so it has no order.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule and is judged on no tokens, by the classes' shares; a token that no
ruled page has says nothing; pages of one class only make every other page that
class, and with nothing to learn from every page is allowed; ties are allowed;
rows are judged one by one. Digits are one token, ``0``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.llm.tasks import small_batches, staged
from pagesift.operators.lookup import fits, lookup_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SMOOTHING = 1.0
# Substrings are made up to this length; a run is cut in pieces of ``PIECE``
# starts, as Spark finds a place in a string by walking to it.
ANCHOR, PIECE = 24, 256
SMALL_TABLE = 200_000
UNKNOWN_LETTER = math.log(12.0)
FIXED = 1 << 32
BLOCK, ALLOW = "block", "allow"

# Fixed values: (verdict, host, path).
RULES = (
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
)


def host_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a url."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for what, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def best_words(name: str, found: Iterable[tuple[int, int, float]], total: float) -> list[str]:
    """The most probable words of a name, from the known words in it as (start,
    length, log probability); ties go to the word that starts first."""
    ends: dict[int, list[tuple[int, float]]] = {}
    for start, length, value in sorted(found):
        ends.setdefault(start + length, []).append((start, value))
    n = len(name)
    best, cut = [0.0] * (n + 1), [0] * (n + 1)
    # The best start of an unknown stretch does not depend on its end.
    open_value, open_start = -math.inf, 0
    for end in range(1, n + 1):
        value = best[end - 1] + UNKNOWN_LETTER * (end - 1)
        if value > open_value:
            open_value, open_start = value, end - 1
        top, at = open_value - UNKNOWN_LETTER * end - math.log(total), open_start
        for start, known in ends.get(end, ()):
            if best[start] + known > top:
                top, at = best[start] + known, start
        best[end], cut[end] = top, at
    out = []
    while n:
        out.append(name[cut[n] : n])
        n = cut[n]
    return out[::-1]


@dataclass
class Lexicon:
    """Log probabilities of words, for names one at a time."""

    words: dict[str, float]
    total: float

    def cost(self, word: str) -> float:
        known = self.words.get(word)
        return known if known is not None else -math.log(self.total) - UNKNOWN_LETTER * len(word)

    def split(self, name: str) -> list[str]:
        pairs = ((a, b) for a in range(len(name)) for b in range(a + 1, len(name) + 1))
        return best_words(name, [(a, b - a, self.words[name[a:b]]) for a, b in pairs if name[a:b] in self.words], self.total)


def lexicon(pages: DataFrame) -> DataFrame:
    """All words of the pages' titles, ``(word, n)``."""
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    words = pages.select(F.explode(F.split(F.lower(title), "[^\\p{L}]+")).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count("*").alias("n"))


def _runs(kind: str, text: str) -> Column:
    """The runs of letters or digits of a column, with their kind."""
    runs = F.regexp_extract_all(F.lower(text), F.lit("\\p{L}+|\\p{Nd}+"), F.lit(0))
    return F.transform(runs, lambda r: F.struct(F.lit(kind).alias("kind"), F.when(r.rlike("^\\p{Nd}"), F.lit("0")).otherwise(r).alias("part")))


def _substrings(parts: DataFrame) -> DataFrame:
    """All substrings of up to ``ANCHOR`` letters of ``(id, part)``: ``(id, at, sub)``."""
    piece = lambda s: F.struct(s.alias("start"), F.substring("part", s + 1, F.lit(PIECE + ANCHOR - 1)).alias("piece"))
    starts = F.sequence(F.lit(0), F.length("part") - 1, F.lit(PIECE))
    pieces = parts.select("id", F.inline(F.transform(starts, piece)))
    places = F.sequence(F.lit(0), F.least(F.length("piece"), F.lit(PIECE)) - 1)
    tails = pieces.select("id", "start", "piece", F.explode(places).alias("place"))
    tails = tails.select("id", (F.col("start") + F.col("place")).alias("at"), F.substring("piece", F.col("place") + 1, F.lit(ANCHOR)).alias("tail"))
    heads = F.transform(F.sequence(F.lit(1), F.length("tail")), lambda n: F.left("tail", n))
    return tails.select("id", "at", F.explode(heads).alias("sub"))


def known_words(parts: DataFrame, words: DataFrame) -> DataFrame:
    """Every place where a word of ``(word, n)`` stands in a part of ``(id, part)``,
    as ``(id, at, length, n)``. Both are read twice: stage them."""
    subs = _substrings(parts)
    short = words.where(F.length("word") <= ANCHOR).withColumnRenamed("word", "sub")
    found = lookup_join(subs, short, ["sub"], ["id", "at"], fits(short, SMALL_TABLE), "inner")
    found = found.select("id", "at", F.length("sub").alias("length"), "n")
    long = words.where(F.length("word") > ANCHOR).select(F.left("word", F.lit(ANCHOR)).alias("sub"), "word", "n")
    begun = lookup_join(subs.where(F.length("sub") == ANCHOR), long, ["sub"], ["id", "at"], fits(long, SMALL_TABLE), "inner")
    begun = begun.join(parts, "id").where(F.substring("part", F.col("at") + 1, F.length("word")) == F.col("word"))
    return found.unionByName(begun.select("id", "at", F.length("word").alias("length"), "n"))


def split_parts(parts: DataFrame, words: DataFrame) -> DataFrame:
    """``(part, words)``: each run of letters as its most probable words. What
    meets in one row are the known words of one run."""
    sums = words.agg(F.coalesce(F.sum("n") + F.count("*"), F.lit(0)).alias("t")).first()
    total = float(sums["t"] + 1)
    parts = staged(parts.select(F.unhex(F.md5(F.col("part").cast("binary"))).alias("id"), "part"), "parts")
    places = known_words(parts, words).groupBy("id").agg(F.collect_list(F.struct("at", "length", "n")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [
                best_words(part, [(x["at"], x["length"], math.log((x["n"] + 1) / total)) for x in found or ()], total)
                for part, found in zip(batch.column("part").to_pylist(), batch.column("found").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(cut, pa.list_(pa.string()))], names=["part", "words"])

    return parts.join(places, "id", "left").select("part", "found").mapInArrow(run, "part string, words array<string>")


def token_weights(tokens: DataFrame) -> DataFrame:
    """``(kind, word, weight)``: the log odds of block of every token of
    ``(kind, word, b, a)``, which are its counts in blocked and allowed pages."""
    seen = staged(tokens.where(F.col("b") + F.col("a") > 0), "tokens")
    sums = seen.agg(F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("a"), F.lit(0)), F.count("*")).first()
    blocked, allowed = (float(s + SMOOTHING * sums[2]) or 1.0 for s in sums[:2])
    odds = F.log((F.col("b") + SMOOTHING) / blocked) - F.log((F.col("a") + SMOOTHING) / allowed)
    return seen.select("kind", "word", F.round(odds * FIXED).cast("long").alias("weight"))


def part_weights(ruled: DataFrame, words: DataFrame) -> DataFrame:
    """``(kind, part, weight)``: what a run in a host or path says for block,
    for every run of ``ruled`` (which is written)."""
    told = lambda v: F.sum((F.coalesce(F.col("verdict") == v, F.lit(False))).cast("long"))
    counts = ruled.select("verdict", F.inline("runs")).groupBy("kind", "part").agg(told(BLOCK).alias("b"), told(ALLOW).alias("a"))
    counts = staged(counts, "runs")
    split = split_parts(counts.select("part").distinct(), words)
    tokens = staged(counts.join(split, "part").select("kind", "part", "b", "a", F.explode("words").alias("word")), "words_of_runs")
    weights = staged(token_weights(tokens.groupBy("kind", "word").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))), "weights")
    each = lookup_join(tokens.select("kind", "part", "word"), weights, ["kind", "word"], ["part"], fits(weights, SMALL_TABLE), "inner")
    return each.groupBy("kind", "part").agg(F.sum("weight").alias("weight"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Host, path, rule, verdict and the log odds of every page."""
    small_batches(pages.sparkSession)
    host, path = host_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumns({"rule": rule, "verdict": verdict, "runs": F.concat(_runs("h", "host"), _runs("p", "path"))})
    ruled = staged(ruled.withColumn("row", F.monotonically_increasing_id()), "ruled")
    classes = {r["verdict"]: r["n"] for r in ruled.groupBy("verdict").agg(F.count("*").alias("n")).collect()}  # three rows
    blocked, allowed = classes.get(BLOCK, 0), classes.get(ALLOW, 0)
    if not blocked or not allowed:
        score = F.lit(1.0 if blocked else -1.0)
        scored = ruled.withColumn("score", score)
    else:
        weights = staged(part_weights(ruled, staged(lexicon(pages), "title_words")), "part_weights")
        own = ruled.select("row", F.inline("runs"))
        own = lookup_join(own, weights, ["kind", "part"], ["row"], fits(weights, SMALL_TABLE), "inner")
        sums = own.groupBy("row").agg(F.sum("weight").alias("weight"))
        prior = round(math.log(blocked / allowed) * FIXED)
        scored = ruled.join(sums, "row", "left").withColumn("score", (F.coalesce("weight", F.lit(0)) + F.lit(prior)) / F.lit(float(FIXED)))
    made = F.when(F.col("score") > 0, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", made).alias("verdict"), "score")
