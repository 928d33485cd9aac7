"""Rule files: one pattern per line, or ``host label`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPACE_ENDS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _trim(text):
    return F.regexp_replace(text, _SPACE_ENDS, "")


def drop_blank_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines with something on them, themselves not trimmed."""
    return lines.where(_trim(F.col(column)) != "")


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """The patterns of a text file as column ``pattern``."""
    return drop_blank_lines(spark.read.text(path)).select(F.col("value").alias("pattern"))


def parse_label_rules(lines: DataFrame) -> DataFrame:
    """``(line_no, value)`` to ``(host, label)``; the last line of a host wins.

    A line counts only if it splits into exactly two non-empty parts.
    """
    parts = F.split(F.regexp_replace("value", r"[ \t]+$", ""), r"[ \t]+")
    return (
        lines.select("line_no", parts.alias("parts"))
        .where(F.size("parts") == 2)
        .select("line_no", _trim(F.col("parts")[0]).alias("host"), _trim(F.col("parts")[1]).alias("label"))
        .where((F.col("host") != "") & (F.col("label") != ""))
        .groupBy("host")
        .agg(F.max_by("label", "line_no").alias("label"))
    )


def load_label_rules(spark: SparkSession, path: str) -> DataFrame:
    """Label rules of one text file; its lines are numbered in file order."""
    whole = spark.read.text(path, wholetext=True)
    if whole.count() > 1:
        raise ValueError("several files have no order in which a last line wins")
    lines = whole.select(F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("line_no", "value"))
    return parse_label_rules(lines)


def patterns(rules: DataFrame, column: str = "pattern") -> list[str]:
    """Rules as a list for the plan: a site's configuration. A list too long
    for that stays a table, see ``operators.rule_tables``."""
    return [row[0] for row in rules.select(column).orderBy(column).collect()]


def label_pairs(rules: DataFrame) -> list[tuple[str, str]]:
    return [(row.host, row.label) for row in rules.select("host", "label").orderBy("host").collect()]
