"""Duplicate run: tokens, hashes, exact groups, near groups, report.

Days never mix: ``stat_date`` is in every key, so one job can do many days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.fixed import EXACT, EXACT_MEMBERS, HASHES, KEYWORDS, NEAR, NEAR_MEMBERS, REPORT
from pagesift.functions.hashing import xxh64
from pagesift.operators.assemble import dup_report
from pagesift.operators.exact import exact_groups, exact_members, members_csv
from pagesift.operators.filters import Rules
from pagesift.operators.lookup import fits
from pagesift.operators.near import BLOCKS, absorb_block, near_members
from pagesift.operators.simhash import simhash64
from pagesift.operators.words import keywords, script_tokens
from pagesift.sources.tables import DAY, StageStore, keep_sources

_IDS = (DAY, "fid")


def run_duplicates(
    store: StageStore,
    crawl: DataFrame,
    start: str,
    end: str | None = None,
    *,
    lexicon: DataFrame | None = None,
    rules: Rules = Rules(),
    sources=fixed.SOURCES,
    drop_script: str = fixed.NON_HAN,
    threshold: int = fixed.DUPLICATE_THRESHOLD,
    token_hash: Callable[[Column], Column] = xxh64,
) -> DataFrame:
    """Write every table of the run for the days of ``crawl``; returns the report.

    Each stage reads the table of the one before, so a lost executor costs a
    stage at most. ``crawl`` holds the days ``start`` to ``end`` (exclusive), or
    the one day ``start``.
    """
    wanted = keep_sources(crawl, sources)
    tokens = keywords(script_tokens(wanted, _IDS, drop_script), lexicon, _IDS)
    words = tokens.select(*_IDS, F.concat_ws(",", "tokens").alias("words"))
    store.write(KEYWORDS, words, start, end)

    stored = store.read(KEYWORDS, start, end)
    bags = stored.select(*_IDS, F.filter(F.split("words", ","), lambda w: w != "").alias("tokens"))
    store.write(HASHES, simhash64(bags, _IDS, token_hash=token_hash), start, end, rebalance=True)

    hashes = store.read(HASHES, start, end)
    store.write(EXACT, exact_groups(hashes, (DAY,)), start, end, rebalance=True)
    members = exact_members(hashes, store.read(EXACT, start, end), (DAY,))
    store.write(EXACT_MEMBERS, members_csv(members, (DAY,)), start, end)

    latest = EXACT
    for block in BLOCKS:
        merged = absorb_block(store.read(latest, start, end), block, by=(DAY,))
        latest = f"{NEAR}_{block}"
        store.write(latest, merged, start, end, rebalance=True)
    passes = [store.read(f"{NEAR}_{block}", start, end) for block in BLOCKS]
    texts = near_members(hashes, store.read(EXACT, start, end), passes, (DAY,))
    store.write(NEAR_MEMBERS, members_csv(texts, (DAY,)), start, end)

    # Only the leaders at or over the threshold are joined: count them first.
    leaders = store.read(latest, start, end).where(F.col("samelen") >= threshold)
    report = dup_report(leaders, crawl, rules, threshold, _IDS, small=fits(leaders))
    store.write(REPORT, report, start, end)
    return store.read(REPORT, start, end)
