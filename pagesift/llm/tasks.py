"""Helpers shared by the operators: Arrow batches of bytes, gapless numbers."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Hashable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagesift.session import stage

# Rows of one Arrow batch: a batch of long texts must fit a Python worker.
BATCH_ROWS = 500
BATCH_BYTES = 4 << 20
NUMBER_BLOCK = 4_000
# Rows that a reader of Parquet holds at once: thousands of texts are large arrays.
READER_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches of later plans of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))
    drop_shuffles(spark)


def drop_shuffles(spark: SparkSession) -> None:
    """Remove a query's shuffle files when it ends, not when the driver happens
    to collect its garbage: an operator's steps hand over by written tables."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


_held: dict = {}


def held(name: Hashable, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by the worker process from task to task until
    it keeps another thing or runs a ``lean`` task of another kind."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def forget() -> None:
    _held.clear()


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator], keeps: bool = False) -> Callable[[Iterator], Iterator]:
    """A task's function that leaves a small worker behind: idle workers count
    towards an executor's memory, and the next step's run beside them."""

    @functools.wraps(run)
    def task(batches):
        if not keeps:
            forget()
        yield from run(batches)
        give_back()

    return task


def free_names(df: DataFrame, *names: str) -> list[str]:
    """These names with underscores in front, as many as it takes for none to be
    a column's (Spark's names are the same in upper and lower case)."""
    taken, front = {c.lower() for c in df.columns}, "_"
    while any((front + n).lower() in taken for n in names):
        front += "_"
    return [front + n for n in names]


def utf8(column: str = "text") -> F.Column:
    """A text as bytes, so that Python workers need not decode it; null stays."""
    return F.col(column).cast("binary")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column end to end (nulls are empty), and the
    offsets of its values (one more than there are)."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def rows_of(batch: pa.RecordBatch, max_bytes: int, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have at most ``max_bytes`` bytes together,
    or a single row."""
    sizes = np.diff(buffers(batch.column(column))[1])
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def with_texts(batch: pa.RecordBatch, columns: Sequence[str], texts: list, changed: list[bool]) -> pa.RecordBatch:
    """The batch's ``columns`` with other texts; ``n_chars``, if it is among
    them, follows the texts that changed."""
    arrays = {c: batch.column(c) for c in columns}
    arrays["text"] = pa.array(texts, batch.column("text").type)
    if "n_chars" in arrays and pa.types.is_integer(arrays["n_chars"].type):
        lengths = pa.array([len(t) if new and t is not None else None for t, new in zip(texts, changed)], pa.int64())
        arrays["n_chars"] = pc.coalesce(lengths, arrays["n_chars"].cast(pa.int64())).cast(arrays["n_chars"].type)
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(columns))


def groups_of(batches: Iterator[pa.RecordBatch], keys: Sequence[str], max_bytes: int = 16 << 20) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of rows that come sorted by the keys, with the
    places where groups start (and the end). Rows are held until they have
    ``max_bytes`` or so and end a group; a larger group is looked through again
    only when it has doubled."""
    held: list[pa.RecordBatch] = []
    size, limit = 0, max_bytes

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for k in keys:
            v = table.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < limit:
            continue
        table = pa.Table.from_batches(held)
        at = starts(table)
        limit = max(max_bytes, 2 * size)
        if len(at) > 1:
            yield table.slice(0, at[-1]), at
            table = table.slice(at[-1])
            limit = max_bytes
        held = table.to_batches()
        size = table.nbytes
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.append(starts(table), table.num_rows)


def number(rows: DataFrame, groups: Sequence[str], order: Sequence[str], name: str, total: int) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without gaps.

    No group is sorted in one task: rows fall into hash blocks of a few
    thousand, blocks are counted, and a row's number is the rows of its group's
    earlier blocks plus its place in its own. ``rows`` is read twice: stage it.
    Rows with equal ``order`` columns come in an arbitrary order.
    """
    groups, order = list(groups), list(order)
    blocks = max(1, -(-total // NUMBER_BLOCK))
    digest = F.md5(F.concat_ws("/", *[F.col(c).cast("string") for c in order]).cast("binary"))
    block = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(blocks)).alias("_block")
    placed = rows.select("*", block)
    counts = placed.groupBy(*groups, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*groups, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*groups, "_block").orderBy(*order)
    return (
        placed.join(starts, [*groups, "_block"])
        .withColumn(name, F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_block", "_start")
    )


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the lineage, and what
    is read twice is computed once."""
    drop_shuffles(df.sparkSession)
    return stage(df, name)
