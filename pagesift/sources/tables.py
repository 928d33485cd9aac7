"""Daily tables: Parquet folders partitioned by ``stat_date`` (``yyyyMMdd``)."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift import fixed, schemas
from pagesift.session import file_system, remove

DAY = "stat_date"
# Names that Spark does not read: rows not yet in their place, and what is to be done with them.
_NEW, _COMMIT = "_new_", "_commit_"


def read_days(
    spark: SparkSession,
    path: str,
    start: str,
    end: str | None = None,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One day, or ``start <= day < end``; the predicate prunes partitions.

    With a ``schema`` (without the day) no file is opened to infer one, and a
    table without files is an empty one.
    """
    fields = (schema or spark.read.parquet(path).schema).fields
    # Day folders look like numbers; ask for the partition column as a string.
    day_last = [*(f for f in fields if f.name != DAY), T.StructField(DAY, T.StringType())]
    table = spark.read.schema(T.StructType(day_last)).parquet(path)
    day = F.col(DAY)
    table = table.where(day == start) if end is None else table.where((day >= start) & (day < end))
    return table.select(*columns) if columns else table


def read_crawl(spark: SparkSession, path: str, start: str, end: str | None = None) -> DataFrame:
    """Crawled articles of a day or a range of days."""
    return read_days(spark, path, start, end, [*schemas.CRAWL.names, DAY], schemas.CRAWL)


def keep_sources(df: DataFrame, sources: Sequence[str] = fixed.SOURCES) -> DataFrame:
    return df.where(F.col("src_type").isin(*sources))


def drop_day(df: DataFrame) -> DataFrame:
    """All columns but the partition column."""
    return df.drop(DAY)


def debug_limit(df: DataFrame, n: int = fixed.DEBUG_ROWS, key: str = "fid") -> DataFrame:
    """A sample of ``n`` rows for trial runs: the smallest keys, so it repeats."""
    return df.orderBy(key).limit(n)


def write_days(
    df: DataFrame, path: str, day: str | None = None, rebalance: bool = False, end: str | None = None
) -> None:
    """Replace the days that ``df`` holds and leave all others alone.

    ``day`` names the one day to write, or with ``end`` the first of the days
    (``end`` exclusive): then days of the range that have no row are emptied.
    A table of several days must have a ``stat_date`` column. Rows are written by the tasks that have them, so
    text is not moved for the sake of files. ``rebalance`` is for narrow tables
    over many days: it gathers each day, and AQE splits a day that is larger
    than a file should be, so no day ends up in one task.

    All days change or none: the rows are written beside the table, then a
    commit file names the days that come and go, then folders are renamed. A
    write that stopped before the commit file has changed nothing; one that
    stopped after it is finished by ``recover_days`` or by the next write of
    any of its days.
    """
    spark = df.sparkSession
    recover_days(spark, path, day, end)
    if day is not None and DAY not in df.columns:
        df = df.withColumn(DAY, F.lit(day))
    if rebalance:
        df = df.hint("rebalance", DAY)
    name = uuid.uuid4().hex
    new = f"{path}/{_NEW}{name}"
    df.write.partitionBy(DAY).parquet(new)
    written = _day_folders(spark, new)
    stale = [f for f in _day_folders(spark, path) if day is not None and _within(f, day, end) and f not in written]
    commit = f"{path}/{_COMMIT}{name}"
    _write_whole(spark, commit, json.dumps({"new": f"{_NEW}{name}", "come": written, "go": stale}))
    _finish(spark, path, commit)


def recover_days(spark: SparkSession, path: str, day: str | None = None, end: str | None = None, clean: bool = False) -> None:
    """Finish writes that stopped after their commit file, of the given days or
    of all. Not beside a running write of the same days. ``clean`` removes what
    other stopped writes left, so no write of any day may be running."""
    for entry in _names(spark, path):
        if entry.startswith(_COMMIT) and not entry.endswith(".tmp"):
            commit = f"{path}/{entry}"
            todo = json.loads(_read(spark, commit))
            if day is None or any(_within(f, day, end) for f in todo["come"] + todo["go"]):
                _finish(spark, path, commit)
    if clean:
        for entry in _names(spark, path):
            if entry.startswith(_NEW) or (entry.startswith(_COMMIT) and entry.endswith(".tmp")):
                remove(spark, f"{path}/{entry}")


def _finish(spark: SparkSession, path: str, commit: str) -> None:
    """Put the days of a commit file in their places; may be done again."""
    todo = json.loads(_read(spark, commit))
    fs, at = file_system(spark, path)
    for folder in todo["come"]:
        new, old = at(f"{path}/{todo['new']}/{folder}"), at(f"{path}/{folder}")
        if fs.exists(new):  # else it is in its place already
            fs.delete(old, True)
            if not fs.rename(new, old):
                raise OSError(f"could not rename {new} to {old}")
    for gone in (*todo["go"], todo["new"]):
        remove(spark, f"{path}/{gone}")
    remove(spark, commit)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at(path))) if fs.exists(at(path)) else []


def _day_folders(spark: SparkSession, path: str) -> list[str]:
    return [name for name in _names(spark, path) if name.startswith(f"{DAY}=")]


def _within(folder: str, day: str, end: str | None) -> bool:
    value = folder.removeprefix(f"{DAY}=")
    return value == day if end is None else day <= value < end


def _write_whole(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, at = file_system(spark, path)
    out = fs.create(at(f"{path}.tmp"))
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(at(f"{path}.tmp"), at(path)):
        raise OSError(f"could not write {path}")


def _read(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at(path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _fingerprint(spark: SparkSession, folders: set[str], day: str, end: str | None) -> str:
    """Of the names, sizes and times of the files in these folders, but for
    those of other days."""
    out = hashlib.sha256()
    for folder in sorted(folders):
        of_day = re.search(rf"/({DAY}=[^/]*)", folder)
        if of_day and not _within(of_day[1], day, end):
            continue
        fs, at = file_system(spark, folder)
        files = fs.listStatus(at(folder)) if fs.exists(at(folder)) else []
        for line in sorted(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in files if not f.isDirectory()):
            out.update(line.encode() + b"\n")
    return out.hexdigest()


class StageStore:
    """The intermediate and final tables of the daily runs under one folder.

    With a ``run``, a name for the rules, models and options in use, a ledger
    notes each table that was written: one whose files, and those of the days it
    is made from, are still as noted is not written again. So a run that failed
    goes on after its last finished step. Inputs that are not files (rows held by
    the driver) are known by the name only.
    """

    def __init__(self, spark: SparkSession, base: str, run: str | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        self.run = run

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, name: str, df: DataFrame, start: str, end: str | None = None, rebalance: bool = False) -> None:
        """Replace the day ``start``, or the days up to ``end``; the table's
        columns are checked."""
        rows = schemas.conform(df, schemas.STAGES[name], *([DAY] if DAY in df.columns else []))
        if self.run is None:
            return write_days(rows, self.path(name), start, rebalance, end)
        key = hashlib.sha256(f"{self.run}/{name}/{start}/{end}".encode()).hexdigest()
        note = f"{self.base}/_ledger/{key}"
        made_from = _fingerprint(self.spark, {unquote(f).rsplit("/", 1)[0] for f in rows.inputFiles()}, start, end)
        fs, at = file_system(self.spark, note)
        if fs.exists(at(note)) and json.loads(_read(self.spark, note)) == [made_from, self._written(name, start, end)]:
            return
        write_days(rows, self.path(name), start, rebalance, end)
        remove(self.spark, note)
        _write_whole(self.spark, note, json.dumps([made_from, self._written(name, start, end)]))

    def _written(self, name: str, start: str, end: str | None) -> str:
        path = self.path(name)
        return _fingerprint(self.spark, {f"{path}/{f}" for f in _day_folders(self.spark, path)}, start, end)

    def read(self, name: str, start: str, end: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        return read_days(self.spark, self.path(name), start, end, columns, schemas.STAGES[name])

    def recover(self, start: str, end: str | None = None) -> None:
        """Finish writes of these days that stopped on the way, in every table."""
        for name in _names(self.spark, self.base):
            recover_days(self.spark, self.path(name), start, end)
