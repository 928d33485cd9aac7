"""Backfill of a range of days as one job per step instead of one per day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pagesift import fixed
from pagesift.operators.classify import Plugin, TopicModel
from pagesift.operators.filters import Rules
from pagesift.plans.articles import run_articles
from pagesift.fixed import HASHES, UNION
from pagesift.plans.duplicates import run_duplicates
from pagesift.plans.labels import run_labels
from pagesift.sources.tables import StageStore, read_crawl

STEPS = ("duplicates", "labels")


def run_range(
    store: StageStore,
    crawl_path: str,
    start: str,
    end: str | None,
    parent: TopicModel | Plugin,
    children: TopicModel | Plugin,
    *,
    rules: Rules = Rules(),
    sources: Sequence[str] = fixed.SOURCES,
    listed: Sequence[str] = fixed.PARENT_TOPICS,
    steps: Sequence[str] = STEPS,
    **duplicate_options,
) -> None:
    """Run ``start <= day < end`` (today if none). ``"articles"`` may be added to ``steps``."""
    end = end or date.today().strftime("%Y%m%d")
    store.recover(start, end)
    crawl = read_crawl(store.spark, crawl_path, start, end)
    if "duplicates" in steps:
        run_duplicates(store, crawl, start, end, rules=rules, sources=sources, **duplicate_options)
    if "labels" in steps:
        run_labels(store, crawl, parent, children, start, end, listed=listed, sources=sources)
    if "articles" in steps:
        hashes, labels = store.read(HASHES, start, end), store.read(UNION, start, end)
        run_articles(store, crawl, hashes, labels, start, end, rules=rules, sources=sources)
