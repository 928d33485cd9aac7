"""Joins that bring labels and articles together, all on the article id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.functions.text import content_len
from pagesift.functions.urls import site, site_strict
from pagesift.operators.filters import Rules, error_body, report_row_ok


def _side(labels: DataFrame, prefix: str, level: str, ids: Sequence[str]) -> DataFrame:
    return labels.select(
        *ids, F.col("cat").alias(f"{prefix}_{level}cat"), F.col("prob").alias(f"{prefix}_{level}prob")
    )


def assemble_labels(
    title_parent: DataFrame,
    title_child: DataFrame,
    content_parent: DataFrame,
    content_child: DataFrame,
    ids: Sequence[str] = ("fid",),
) -> DataFrame:
    """Title parent labels with whatever the other three have for the id.

    Repeated ids multiply. The title parent is on the keeping side.
    """
    on = list(ids)
    return (
        _side(title_parent, "title", "p", ids)
        .join(_side(title_child, "title", "c", ids), on, "left")
        .join(_side(content_parent, "content", "p", ids), on, "left")
        .join(_side(content_child, "content", "c", ids), on, "left")
    )


def assemble_articles(
    crawl: DataFrame, hashes: DataFrame, labels: DataFrame, rules: Rules = Rules(), ids: Sequence[str] = ("fid",)
) -> DataFrame:
    """Articles with their hash, if any, and their labels (inner).

    The body stays out of the join; its length and whether it is an error
    message are taken before.
    """
    on = list(ids)
    small = crawl.select(
        *ids,
        site(F.col("furl")).alias("furl"),
        "ftitle",
        content_len(F.col("fcontent")).alias("fcontent_len"),
        "src_type",
        error_body(rules, trimmed=True).alias("is_error_body"),
    )
    return small.join(hashes.select(*ids, "hash"), on, "left").join(labels, on)


def dup_report(
    groups: DataFrame,
    crawl: DataFrame,
    rules: Rules = Rules(),
    threshold: int = fixed.DUPLICATE_THRESHOLD,
    ids: Sequence[str] = ("fid",),
    small: bool = False,
) -> DataFrame:
    """Leaders of large groups with their articles, for people to check.

    The row rules look at the article only, so they run in the scan, before
    the join. Say ``small`` if the leaders were counted and can be broadcast:
    then the article bodies are not shuffled.
    """
    leaders = groups.where(F.col("samelen") >= threshold).select(*ids, "hash", "samelen")
    articles = crawl.select(
        *ids,
        site_strict(F.col("furl")).alias("furl"),
        "ftitle",
        "fkeywords",
        "fcontent",
        content_len(F.col("fcontent")).alias("fcontent_len"),
        "src_type",
    ).where(report_row_ok(rules))
    return articles.join(F.broadcast(leaders) if small else leaders, list(ids)).select(
        *ids, "hash", "samelen", "furl", "ftitle", "fkeywords", "fcontent", "fcontent_len", "src_type"
    )
