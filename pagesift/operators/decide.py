"""The decision on one category per article."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.functions.urls import site_label, title_only
from pagesift.operators.filters import Rules


def category(
    tp: Column, tpp: Column, tc: Column, cp: Column, cpp: Column, cc: Column, label: Column, by_title: Column
) -> Column:
    """Category from parent labels, parent probabilities, child labels, the
    site's label and whether the site is judged by its titles.

    A null parent counts as known, a null probability as 0.
    """
    unknown = F.lit(fixed.UNKNOWN)
    title_known, content_known = ~tp.eqNullSafe(unknown), ~cp.eqNullSafe(unknown)
    tpp, cpp = F.coalesce(tpp, F.lit(0.0)), F.coalesce(cpp, F.lit(0.0))
    has_label = label != ""
    # A site label against a null parent is "not equal".
    is_title, is_content = label.eqNullSafe(tp), label.eqNullSafe(cp)
    sure_title, sure_content = tpp > fixed.SURE_PROB, cpp > fixed.SURE_PROB
    trust_title = by_title & (tpp > fixed.TITLE_ONLY_PROB)

    both = (
        F.when(tc.eqNullSafe(cc), tc)
        .when(has_label & is_title, F.coalesce(tc, label))
        .when(has_label & is_content, F.coalesce(cc, label))
        .when(has_label, label)
        .when(trust_title, tc)
        .when((tpp >= cpp) & sure_title, F.coalesce(tc, tp))
        .when((tpp < cpp) & sure_content, F.coalesce(cc, cp))
        .otherwise(unknown)
    )
    title = (
        F.when(has_label & is_title, F.coalesce(tc, tp))
        .when(has_label, label)
        .when(trust_title | sure_title, F.coalesce(tc, tp))
        .otherwise(unknown)
    )
    content = (
        F.when(has_label & is_content, F.coalesce(cc, cp))
        .when(has_label, F.concat(label, F.lit("_" + fixed.UNKNOWN)))
        .when(sure_content, F.coalesce(cc, cp))
        .otherwise(unknown)
    )
    return (
        F.when(title_known & content_known, both)
        .when(title_known, title)
        .when(content_known, content)
        .otherwise(unknown)
    )


def with_site_rules(articles: DataFrame, rules: Rules) -> DataFrame:
    """Add ``site_label`` and ``is_title_only`` from the URL."""
    return articles.withColumns(
        {
            "site_label": site_label(F.col("furl"), rules.label_rules),
            "is_title_only": title_only(F.col("furl"), rules.title_only),
        }
    )


def final_label(articles: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The published table. Needs ``site_label`` and ``is_title_only``.

    Articles decided as unknown are left out; a null category is kept.
    """
    cat = category(
        F.col("title_pcat"), F.col("title_pprob"), F.col("title_ccat"),
        F.col("content_pcat"), F.col("content_pprob"), F.col("content_ccat"),
        F.col("site_label"), F.col("is_title_only"),
    )
    return (
        articles.withColumn("cat", cat)
        .where(~F.col("cat").eqNullSafe(F.lit(fixed.UNKNOWN)))
        .select(
            *extra,
            F.lit(fixed.ALGO_VERSION).alias("algo_ver"),
            "fid", "ftitle", "cat", "src_type", "furl",
            "title_pcat", F.coalesce("title_pprob", F.lit(0.0)).alias("title_pprob"),
            "content_pcat", F.coalesce("content_pprob", F.lit(0.0)).alias("content_pprob"),
        )
    )
