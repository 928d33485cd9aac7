"""Label run: words of titles and bodies, parent labels, child labels, assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.fixed import (
    CONTENT_CHILD, CONTENT_PARENT, CONTENT_WORDS, EXTRACTED, TITLE_CHILD, TITLE_PARENT, TITLE_WORDS, UNION,
)
from pagesift.operators.assemble import assemble_labels
from pagesift.operators.classify import Plugin, TopicModel, child_labels, parent_labels, two_level_labels
from pagesift.operators.words import title_content_tokens
from pagesift.sources.tables import DAY, StageStore, keep_sources

_IDS = (DAY, "fid")


def label_articles(
    tokens: DataFrame,
    parent: TopicModel,
    children: TopicModel,
    listed: Sequence[str] = fixed.PARENT_TOPICS,
    ids: Sequence[str] = _IDS,
) -> DataFrame:
    """The run as one plan, from ``(ids, title_tokens, content_tokens)`` to the
    union of labels. Only the words are shuffled, once per text column."""
    title = two_level_labels(tokens, parent, children, listed, ids, "title_tokens", "title")
    content = two_level_labels(tokens, parent, children, listed, ids, "content_tokens", "content")
    return title.join(content, list(ids), "left")


def run_labels(
    store: StageStore,
    crawl: DataFrame,
    parent: TopicModel | Plugin,
    children: TopicModel | Plugin,
    start: str,
    end: str | None = None,
    *,
    listed: Sequence[str] = fixed.PARENT_TOPICS,
    sources: Sequence[str] = fixed.SOURCES,
) -> DataFrame:
    """Write every table of the run for the days of ``crawl``; returns the union."""
    store.write(EXTRACTED, keep_sources(crawl, sources), start, end)
    tokens = title_content_tokens(store.read(EXTRACTED, start, end), _IDS)
    for name, column in ((TITLE_WORDS, "title_tokens"), (CONTENT_WORDS, "content_tokens")):
        store.write(name, tokens.select(*_IDS, F.concat_ws(" ", column).alias("words")), start, end)

    for words, parents, childs in (
        (TITLE_WORDS, TITLE_PARENT, TITLE_CHILD),
        (CONTENT_WORDS, CONTENT_PARENT, CONTENT_CHILD),
    ):
        labelled = parent_labels(store.read(words, start, end), parent, _IDS)
        store.write(parents, labelled, start, end)
        below = child_labels(store.read(parents, start, end), children, listed, _IDS)
        store.write(childs, below, start, end)

    sides = [
        store.read(name, start, end, [*_IDS, "cat", "prob"])
        for name in (TITLE_PARENT, TITLE_CHILD, CONTENT_PARENT, CONTENT_CHILD)
    ]
    store.write(UNION, assemble_labels(*sides, ids=_IDS), start, end, rebalance=True)
    return store.read(UNION, start, end)
