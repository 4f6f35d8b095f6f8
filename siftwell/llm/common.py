"""Small helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators.graph import connected
from siftwell.operators.tables import bounded_batches, durable, removed, shared_folder, stored

__all__ = ["connected", "durable", "free_name", "gathered", "in_arrow", "released", "removed", "shared_folder", "shuffle_partitions", "slices", "stored", "table", "text_or_empty", "trimmed"]

#: Python workers handle at most about so many bytes of text at once, and get at most so many bytes in a batch (a row at least).
SLICE_BYTES, BATCH_BYTES = 4 << 20, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of the text column (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        rows = max(1, min(n, int(n * most / max(1, batch.column(text).nbytes))))
        for at in range(0, n, rows):
            yield batch.slice(at, rows)


def gathered(batches: Iterator[pa.RecordBatch], text: int = 1, most: int = 4 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of the text column (one row at least), small ones put together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices(batches, text, most):
        if held and size + batch.column(text).nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.column(text).nbytes
    if held:
        yield pa.concat_batches(held)


def released() -> None:
    """Gives memory that a task has freed back to the system, as Python workers outlive tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; what was freed in handling one is given back before the next, so that a worker's memory is that of a batch and not of its task."""
    for batch in batches:
        yield batch
        released()


#: What Python workers keep from task to task, by name: how to let go of it.
KEPT: dict[str, Callable[[], object]] = {}


def let_go(keep: str = "") -> None:
    """Drops what is kept in this process, but for `keep`."""
    for name, drop in KEPT.items():
        if name != keep:
            drop()


def in_arrow(df: DataFrame, run: Callable, schema, keep: str = "") -> DataFrame:
    """df.mapInArrow() in batches of BATCH_BYTES at most, a bound that the session keeps: Spark counts rows otherwise, and texts are long.

    A task lets go of what other operators' tasks have left in its worker (KEPT), all but `keep`.
    """
    bounded_batches(df.sparkSession, BATCH_BYTES)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(keep)
        yield from run(batches)
        released()

    return df.mapInArrow(task, schema)


def free_name(name: str, taken: list[str]) -> str:
    """The name, with underscores in front until no column has it, in whatever case."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name = "_" + name
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
