"""Word tables: plain tokens and keyword tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.functions.text import clean_markup, keep_script, tokenize
from pagesift.operators.lookup import fits, lookup_join


ROW = "_row"


def row_key(tokens: str = "tokens") -> Column:
    """Tells rows with the same ids and other tokens apart."""
    return F.xxhash64(tokens)


def title_content_tokens(crawl: DataFrame, ids: Sequence[str] = ("fid",)) -> DataFrame:
    """Cleaned tokens of title and content, both in one pass over the rows."""
    return crawl.select(
        *ids,
        tokenize(clean_markup(F.col("ftitle"))).alias("title_tokens"),
        tokenize(clean_markup(F.col("fcontent"))).alias("content_tokens"),
    )


def script_tokens(
    crawl: DataFrame, ids: Sequence[str] = ("fid",), drop: str = fixed.NON_HAN, column: str = "fcontent"
) -> DataFrame:
    """Tokens of the part of the content that is in the wanted script."""
    return crawl.select(*ids, tokenize(keep_script(F.col(column), drop)).alias("tokens"))


def token_rows(df: DataFrame, keep: Sequence[str | Column], tokens: str | Column = "tokens") -> DataFrame:
    """One row per token, a null token for a text without any.

    The explode is an outer one on purpose: for an inner explode Catalyst adds
    a non-empty filter in front, which computes the token array a second time.
    """
    return df.select(*keep, F.explode_outer(tokens).alias("token"))


def keyword_rows(
    tokens: DataFrame,
    lexicon: DataFrame,
    ids: Sequence[str] = ("fid",),
    nature: str = "n",
    min_len: int = 2,
    small: bool | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per kept token: ``(ids, extra, pos, token)``; dropped texts have no row.

    A word is kept if the lexicon gives it a nature starting with ``nature``
    and it has at least ``min_len`` characters. No text moves between executors.
    """
    wanted = (
        lexicon.where(F.col("nature").startswith(nature))
        .select(F.col("word").alias("token"))
        .distinct()
    )
    if small is None:
        small = fits(wanted)
    # Ahead of the explode: beside it, ``extra`` is computed anew for every token.
    given = tokens.select(*ids, *extra, "tokens")
    kept = [c for c in given.columns if c != "tokens"]
    rows = given.select(*kept, F.posexplode_outer("tokens").alias("pos", "token"))
    rows = rows.where(F.length("token") >= min_len)
    return lookup_join(rows, wanted, ["token"], [*ids, "pos"], small, "left_semi" if small else "inner")


def keywords(
    tokens: DataFrame,
    lexicon: DataFrame | None = None,
    ids: Sequence[str] = ("fid",),
    nature: str = "n",
    min_len: int = 2,
    small: bool | None = None,
) -> DataFrame:
    """Keyword tokens per text, order and repeats kept: ``(ids, tokens)``.

    Without a lexicon only the length rule applies, inside the row. Rows that
    share their ids but not their tokens are kept apart.
    """
    if lexicon is None:
        return tokens.select(*ids, F.filter("tokens", lambda t: F.length(t) >= min_len).alias("tokens"))
    row = row_key().alias(ROW)
    # A set, since rows may be equal in ids and tokens.
    kept = (
        keyword_rows(tokens, lexicon, ids, nature, min_len, small, [row])
        .groupBy(*ids, ROW)
        .agg(F.array_sort(F.collect_set(F.struct("pos", "token"))).alias("_kept"))
    )
    empty = F.array().cast("array<string>")
    return (
        tokens.select(*ids, row)
        .join(kept, [*ids, ROW], "left")
        .select(*ids, F.coalesce(F.col("_kept.token"), empty).alias("tokens"))
    )


def words_table(tokens: DataFrame, separator: str, ids: Sequence[str] = ("fid",), column: str = "tokens") -> DataFrame:
    """``(ids, words)`` with the tokens as one string."""
    return tokens.select(*ids, F.concat_ws(separator, column).alias("words"))
