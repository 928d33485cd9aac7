"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most rows of a table that is sent to every executor.
MAX_BROADCAST_ROWS = 2_000_000
HOT_KEYS = 1024
# A key with this share of the rows is spread, one more task per share.
SHARE = 1024
_SALT = "_salt"


def fits(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Counts the table. Stage it first if it is costly."""
    return table.count() <= max_rows


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    small: bool,
    how: str = "left",
) -> DataFrame:
    """Look each row up in a parameter table such as a lexicon or a model.

    A table that was found ``small`` is broadcast and ``rows`` stay where they
    are. A larger one is shuffled. Keys are counted first: one with more than a
    ``SHARE``-th of the rows (a stop word; there are fewer than ``SHARE``) is
    spread by the row's ``spread_by`` columns over a task per share, and its row
    of the table is copied to each.
    """
    on = list(on)
    if small:
        return rows.join(F.broadcast(table), on, how)
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n"))
    share = max(1, (counts.agg(F.sum("_n")).first()[0] or 0) // SHARE)
    hot = F.broadcast(counts.where(F.col("_n") > share).select(*on, F.ceil(F.col("_n") / share).cast("int").alias("_tasks")))
    tasks = F.coalesce("_tasks", F.lit(1))
    salted_rows = rows.join(hot, on, "left").withColumn(_SALT, F.pmod(F.xxhash64(*spread_by), tasks).cast("int"))
    salted_table = table.join(hot, on, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), tasks - 1)))
    return salted_rows.drop("_tasks").join(salted_table.drop("_tasks"), [*on, _SALT], how).drop(_SALT)


def attach(rows: DataFrame, groups: DataFrame, on: Sequence[str], size: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Give each row the columns of its group (one row of ``groups`` per key).

    The ``hot_keys`` largest groups by ``size`` are broadcast, a table of fixed
    length, and their rows are not shuffled. By counting, every other key holds
    at most one row in ``hot_keys + 1``, so the rest is a plain shuffle join
    without a hot task. ``rows`` and ``groups`` are read twice: stage them if
    they are costly to compute.
    """
    on = list(on)
    hot = groups.orderBy(F.desc(size), *on).limit(hot_keys)
    of_hot = rows.join(F.broadcast(hot), on)
    of_cold = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(groups, on)
    return of_hot.unionByName(of_cold)
