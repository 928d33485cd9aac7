"""Final run: articles with hash and labels, rule filter, one category each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pagesift import fixed
from pagesift.fixed import ASSEMBLED, PUBLISHED
from pagesift.operators.assemble import assemble_articles
from pagesift.operators.decide import final_label, with_site_rules
from pagesift.operators.filters import Rules, drop_unusable
from pagesift.sources.tables import DAY, StageStore, keep_sources

_IDS = (DAY, "fid")


def publish(articles: DataFrame, rules: Rules, mode: str = "intended", extra: Sequence[str] = (DAY,)) -> DataFrame:
    """Filter and decide; no step needs a shuffle."""
    return final_label(with_site_rules(drop_unusable(articles, rules, mode), rules), extra)


def run_articles(
    store: StageStore,
    crawl: DataFrame,
    hashes: DataFrame,
    labels: DataFrame,
    start: str,
    end: str | None = None,
    *,
    rules: Rules = Rules(),
    sources: Sequence[str] = fixed.SOURCES,
    mode: str = "intended",
) -> DataFrame:
    """Write the assembled and the published table; returns the latter."""
    assembled = assemble_articles(keep_sources(crawl, sources), hashes, labels, rules, _IDS)
    store.write(ASSEMBLED, assembled, start, end, rebalance=True)
    final = publish(store.read(ASSEMBLED, start, end), rules, mode)
    store.write(PUBLISHED, final, start, end, rebalance=True)
    return store.read(PUBLISHED, start, end)
