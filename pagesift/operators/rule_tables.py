"""URL rules from tables of any length.

A pattern is found in a text by a join, not by looking for each pattern in each
text. Every pattern has an anchor, ``GRAM`` of its characters, the ones that
fewest patterns share. Each distinct text gives its pieces of that length once;
those that are some pattern's anchor bring text and pattern together, and only
such a pair is compared. Patterns shorter than an anchor are joined whole, to
pieces of their own length.

The work grows with the characters of the distinct texts and with the pairs that
share an anchor, and nothing of either table passes the driver. Null texts and
empty ones contain nothing; null and empty patterns are no rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.operators.lookup import fits
from pagesift.session import stage

GRAM = 5


def _grams(text: Column, size: int) -> Column:
    """The distinct pieces of a length; none of a shorter text."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    pieces = F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))
    return F.when(F.length(text) >= size, pieces).otherwise(F.array().cast("array<string>"))


def anchors(patterns: DataFrame, gram: int = GRAM) -> DataFrame:
    """``(pattern, piece)``: each distinct pattern with its anchor."""
    rules = patterns.where(F.length("pattern") > 0).select("pattern").distinct()
    short = rules.where(F.length("pattern") < gram).withColumn("piece", F.col("pattern"))
    pieces = rules.where(F.length("pattern") >= gram).select("pattern", F.explode(_grams(F.col("pattern"), gram)).alias("piece"))
    shared = pieces.groupBy("piece").agg(F.count("*").alias("n"))
    rarest = pieces.join(shared, "piece").groupBy("pattern").agg(F.min_by("piece", F.struct("n", "piece")).alias("piece"))
    return short.unionByName(rarest)


def contained(texts: DataFrame, patterns: DataFrame, column: str, gram: int = GRAM) -> DataFrame:
    """``(column, pattern)``: which distinct texts contain which patterns."""
    anchored = stage(anchors(patterns, gram), "anchors")
    # At most GRAM - 1 lengths besides the anchors' own.
    lengths = [r[0] for r in anchored.select(F.length("piece").alias("n")).distinct().collect()]
    distinct = stage(texts.where(F.length(column) > 0).select(column).distinct(), "texts")
    if not lengths:
        return distinct.select(column, F.lit("").alias("pattern")).where("false")
    pieces = distinct.select(column, F.explode(F.flatten(F.array(*[_grams(F.col(column), n) for n in sorted(lengths)]))).alias("piece"))
    rules = F.broadcast(anchored) if fits(anchored) else anchored
    return pieces.join(rules, "piece").where(F.contains(F.col(column), F.col("pattern"))).select(column, "pattern").distinct()


def _looked_up(rows: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """``rows`` with the columns of ``found``, which has a row per text at most."""
    found = stage(found, "found")
    return rows.join(F.broadcast(found) if fits(found) else found, column, "left")


def not_listed(df: DataFrame, patterns: DataFrame, url: str = "furl") -> DataFrame:
    """Rows whose URL contains no pattern of the table."""
    listed = stage(contained(df, patterns, url).select(url).distinct(), "listed")
    return df.join(F.broadcast(listed) if fits(listed) else listed, url, "left_anti")


def title_only(df: DataFrame, hosts: DataFrame, url: str = "furl", name: str = "is_title_only") -> DataFrame:
    """Adds whether the URL contains a host (column ``pattern``) of the table."""
    found = contained(df, hosts, url).select(url).distinct().withColumn(name, F.lit(True))
    return _looked_up(df, found, url).withColumn(name, F.coalesce(name, F.lit(False)))


def site_label(df: DataFrame, rules: DataFrame, url: str = "furl", name: str = "site_label") -> DataFrame:
    """Adds the label of the one host of ``rules`` (``host``, ``label``, a row
    per host) that is in the URL; ``''`` for none or several."""
    hits = contained(df, rules.select(F.col("host").alias("pattern")), url)
    one = hits.groupBy(url).agg(F.count("*").alias("_n"), F.min("pattern").alias("host")).where("_n = 1").drop("_n")
    labels = rules.select("host", F.col("label").alias(name))
    return _looked_up(df, one.join(labels, "host").select(url, name), url).withColumn(name, F.coalesce(name, F.lit("")))


def with_site_rules(articles: DataFrame, label_rules: DataFrame, title_hosts: DataFrame) -> DataFrame:
    """Adds ``site_label`` and ``is_title_only`` from tables of rules, as
    ``operators.decide.with_site_rules`` does from lists."""
    return title_only(site_label(articles, label_rules), title_hosts)
