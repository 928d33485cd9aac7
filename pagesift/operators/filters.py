"""Row rules over articles: URL, title and body."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.functions.text import java_trim
from pagesift.functions.urls import contains_any


@dataclass(frozen=True)
class Rules:
    """The rule lists of a site."""

    useless: Sequence[str] = ()
    commerce: Sequence[str] = ()
    title_only: Sequence[str] = ()
    label_rules: Sequence[tuple[str, str]] = ()
    junk_titles: Sequence[str] = fixed.JUNK_TITLES
    chapter: str = fixed.CHAPTER_TITLE
    search_home: str = fixed.SEARCH_HOME_TITLE
    error_body: str = fixed.ERROR_BODY

    @property
    def blocked(self) -> tuple[str, ...]:
        return (*self.useless, *self.commerce)


def url_ok(rules: Rules, url: str = "furl") -> Column:
    """No blacklisted string in the URL; a null URL has none."""
    return ~contains_any(F.col(url), rules.blocked)


def not_blacklisted(df: DataFrame, useless: Sequence[str], commerce: Sequence[str], url: str = "furl") -> DataFrame:
    return df.where(url_ok(Rules(useless=useless, commerce=commerce), url))


def error_body(rules: Rules, content: str = "fcontent", trimmed: bool = False) -> Column:
    """The body is an error message; a null body is none.

    The report takes the body as it is, the article filter trims it first.
    """
    body = java_trim(F.col(content)) if trimmed else F.col(content)
    return F.coalesce(body.startswith(rules.error_body), F.lit(False))


def title_ok(rules: Rules, title: str = "ftitle", as_built: bool = False) -> Column:
    """The title is not a junk phrase and not a novel chapter.

    ``as_built`` rejects a title only if it matches all the tests at once, as
    the original rule was coded; the default rejects if it matches any.
    """
    text = java_trim(F.col(title))
    tests = [F.contains(text, F.lit(p)) for p in rules.junk_titles] + [text.rlike(rules.chapter)]
    bad = reduce((lambda a, b: a & b) if as_built else (lambda a, b: a | b), tests)
    return ~F.coalesce(bad, F.lit(False))


def report_row_ok(rules: Rules) -> Column:
    """Rows of the duplicate report; a null URL is kept whatever else it holds."""
    title, content = F.col("ftitle"), F.col("fcontent")
    good = (
        url_ok(rules)
        & title.isNotNull()
        & ~F.coalesce(title.contains(rules.search_home), F.lit(False))
        & content.isNotNull()
        & ~error_body(rules)
    )
    return F.col("furl").isNull() | good


def drop_unusable(df: DataFrame, rules: Rules, mode: str = "intended") -> DataFrame:
    """Drop articles that can not be used.

    ``as_built`` keeps every row: the original step asks for a column that its
    input lacks, and keeps rows on which it fails. ``intended`` applies the URL,
    title and body rules, where null matches no rule. Either ``fcontent`` or
    the flag ``is_error_body`` must be there.
    """
    if mode == "as_built":
        return df
    if mode != "intended":
        raise ValueError(f"no mode {mode}")
    if "is_error_body" in df.columns:
        bad_body = F.coalesce("is_error_body", F.lit(False))
    else:
        bad_body = error_body(rules, trimmed=True)
    return df.where(url_ok(rules) & title_ok(rules) & ~bad_body)
