"""Intermediate tables in the folder that driver and executors share, and batches bounded in bytes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, SparkSession

#: Bytes of an Arrow batch to a Python worker, and of one side's rows in a task of crossed(), at most.
BATCH_BYTES, SIDE_BYTES = 32 << 20, 64 << 20


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, that of spark.checkpoint.dir; a temporary one only where none is named and all runs in one process."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if not named and sc.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return sc._jsc.sc().getCheckpointDir().get()


@contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Queries planned within delete their shuffle files when they have ended; what is written durably needs them no more."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def durable(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder; what its last stage does is done twice."""
    shared_folder(df.sparkSession)
    with shuffles_let_go(df.sparkSession):
        return df.select("*").checkpoint()


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """df written as Parquet into the shared folder and read again, and its path. All is done once; the order of partitions is lost."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    with shuffles_let_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def crossed(left: DataFrame, right: DataFrame, condition: Column | None, row_bytes: int) -> DataFrame:
    """All pairs of rows of two stored tables of few, large rows (of `row_bytes` at most) that meet the condition.

    Each task takes one range of either side and reads both, so nothing is shuffled or sorted, however many pairs there are.
    """
    spread = ceil(sqrt(4 * left.sparkSession.sparkContext.defaultParallelism))

    def cut(side: DataFrame) -> DataFrame:
        rows = side.count()
        return side.coalesce(max(1, min(rows, spread), ceil(rows * row_bytes / SIDE_BYTES)))

    two = cut(right).hint("shuffle_replicate_nl")
    return cut(left).crossJoin(two) if condition is None else cut(left).join(two, condition)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes what stored() has written."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Arrow batches of the session hold at most so many bytes (a row at least) from now on, or fewer where it says so already."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    n, unit = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(key).lower()).groups()
    if int(n) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > most:
        spark.conf.set(key, str(most))
