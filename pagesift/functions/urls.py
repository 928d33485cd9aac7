"""URL prefixes and substring rules.

Rules are matched inside the row: no join, no shuffle, and a site that holds
most of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesift import fixed

# Up to this many patterns the test is written out and compiled; longer lists
# are one array literal searched by a higher-order function.
UNROLL = 64


def site_strict(url: Column) -> Column:
    """Scheme and host if the host is lower-case letters and dots only, else ``''``."""
    return F.regexp_extract(url, fixed.STRICT_SITE, 1)


def site(url: Column) -> Column:
    """Scheme and host up to the first slash after it, else ``''``."""
    return F.regexp_extract(url, fixed.SITE, 1)


def contains_any(text: Column, patterns: Sequence[str]) -> Column:
    """True if any pattern is a substring; a null text contains nothing."""
    if not patterns:
        return F.lit(False)
    if len(patterns) <= UNROLL:
        found = reduce(lambda a, b: a | b, [text.contains(F.lit(p)) for p in patterns])
    else:
        found = F.exists(F.array(*[F.lit(p) for p in patterns]), lambda p: F.contains(text, p))
    return F.coalesce(found, F.lit(False))


def site_label(url: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the one host that is in the URL; ``''`` for none or several.

    Of several rules for a host the last counts.
    """
    if not rules:
        return F.lit("")
    table = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(l).alias("label")) for h, l in dict(rules).items()])
    labels = F.transform(F.filter(table, lambda r: F.contains(url, r["host"])), lambda r: r["label"])
    return F.coalesce(
        F.aggregate(
            labels,
            F.struct(F.lit(0).alias("n"), F.lit("").alias("label")),
            lambda acc, label: F.struct((acc["n"] + 1).alias("n"), label.alias("label")),
            lambda acc: F.when(acc["n"] == 1, acc["label"]).otherwise(F.lit("")),
        ),
        F.lit(""),
    )


def title_only(url: Column, hosts: Sequence[str]) -> Column:
    """True for sites whose bodies are not to be trusted."""
    return contains_any(url, hosts)
