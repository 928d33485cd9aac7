"""Text cleaning and word tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesift import fixed

# Java's trim drops every character up to U+0020, Spark's only spaces.
_UP_TO_SPACE = "".join(chr(code) for code in range(0x21))
_HAN = f"[{fixed.HAN}]"
_RUNS = rf"[{fixed.HAN}]+|[\p{{L}}\p{{N}}&&[^{fixed.HAN}]]+"


def java_trim(text: Column) -> Column:
    return F.btrim(text, F.lit(_UP_TO_SPACE))


def content_len(text: Column) -> Column:
    """Length in characters; null stays null."""
    return F.length(text)


def keep_script(text: Column, drop: str = fixed.NON_HAN) -> Column:
    """Every run of characters that ``drop`` matches becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), drop, " ")


def clean_markup(text: Column) -> Column:
    """Trim, put line feeds to spaces, then tags to spaces. Null becomes ``''``."""
    flat = F.replace(java_trim(F.coalesce(text, F.lit(""))), F.lit("\n"), F.lit(" "))
    return F.regexp_replace(flat, fixed.TAG, " ")


def tokenize(text: Column) -> Column:
    """Lower-case words in order, with repeats; a Han run gives its bigrams."""
    lower = F.lower(F.coalesce(text, F.lit("")))

    def bigrams(run: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(run) - 1, F.lit(1))),
            lambda i: F.substring(run, i, F.lit(2)),
        )
        return F.when(run.rlike(_HAN), pairs).otherwise(F.array(run))

    # Cut between the words: extracting each makes a matcher for every word.
    plain = F.array_remove(F.split(lower, r"[^\p{L}\p{N}]+"), "")
    mixed = F.flatten(F.transform(F.regexp_extract_all(lower, F.lit(_RUNS), 0), bigrams))
    return F.when(lower.rlike(_HAN), mixed).otherwise(plain)


def join_tokens(tokens: Column, separator: str = " ") -> Column:
    """Tokens as one string: commas on the hash path, spaces for the classifier."""
    return F.concat_ws(separator, tokens)
