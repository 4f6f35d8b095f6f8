"""Incremental runs: new shards only, latest row per key, sessions of events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery


def run_new_shards(spark: SparkSession, source: str, schema: T.StructType, step: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, files_per_trigger: int = 1000) -> StreamingQuery:
    """Applies a step to the shards that no earlier run has seen and appends its rows; ends when they are done.

    Each micro-batch is written under its own number, so that a batch run again replaces itself.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_success(stream: DataFrame, key: str, ts: str, ok: str, lateness: str) -> DataFrame:
    """Of rows that repeat within the lateness, the first that succeeded; state is bounded by the watermark."""
    return stream.where(F.col(ok) == 1).withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])


class _LastSuccess(StatefulProcessor):
    """State of a key: the time of its last success. A timer clears it when the watermark is `idle_ms` past that."""

    def __init__(self, ts: str, ok: str, idle_ms: int) -> None:
        self.ts, self.ok, self.idle_ms = ts, ok, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField("micros", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, best_at = None, None
        for pdf in rows:
            won = pdf[(pdf[self.ok] == 1) & pdf[self.ts].notna()]
            if len(won):
                at = won[self.ts].astype("datetime64[us]").astype("int64")
                place = len(at) - 1 - int(at.to_numpy()[::-1].argmax())  # of equal times the later row
                if best_at is None or int(at.iloc[place]) >= best_at:
                    best, best_at = won.iloc[[place]], int(at.iloc[place])
        if best is None:
            return
        if self.last.exists():
            (old,) = self.last.get()
            if best_at < old:
                return
            self.handle.deleteTimer(old // 1000 + self.idle_ms)
        self.last.update((best_at,))
        self.handle.registerTimer(best_at // 1000 + self.idle_ms)
        yield best

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def last_success(stream: DataFrame, key: str, ts: str, ok: str, lateness: str, idle_ms: int) -> DataFrame:
    """Of a stream of runs the row of each key's last success, by `ts`; a later success replaces it as an update, an earlier one that comes late does not.

    Output is in update mode: a row of a key is its state from then on. Of equal times the row that comes later counts. Only the time is kept
    as state, until the watermark is `idle_ms` past it; a success after that is the first again. Needs the RocksDB state store.
    """
    rows = stream.withWatermark(ts, lateness)
    return rows.groupBy(key).transformWithStateInPandas(_LastSuccess(ts, ok, idle_ms), outputStructType=stream.schema, outputMode="Update", timeMode="EventTime")


def sessions(events: DataFrame, key: str, ts: str, gap: str, lateness: str) -> DataFrame:
    """(key, start, end, n) of sessions that a gap ends; works on streams and on tables."""
    rows = events.withWatermark(ts, lateness) if events.isStreaming else events
    w = F.session_window(ts, gap)
    return rows.groupBy(key, w).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def windowed_counts(events: DataFrame, ts: str, width: str, lateness: str, *keys: str) -> DataFrame:
    """(window start, keys, n) by event time; late rows are dropped behind the watermark."""
    rows = events.withWatermark(ts, lateness) if events.isStreaming else events
    return rows.groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")
