"""Workers of one row to many as table functions, and timelines folded row by row.

A table function gets the rows of one key at a time, in order, and keeps only its state: nothing of a key is gathered.
fold_ticks() needs not even a key's rows in one task: ticks are sorted in ranges of (id, tick), each task folds its range, and
what a range needs to know of those before it, one number and a count, is found first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from ..functions.scales import exact_round
from .tables import durable
from .timeline import EPS


class TickRanges:
    """TABLE(id, tick) to (id, range_index, start_sec, end_sec): ranges between merged ticks of an id, one after the other."""

    def __init__(self) -> None:
        self.last: float | None = None
        self.n = 0

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        if not isinstance(table.dataType, T.StructType) or len(table.dataType) != 2:
            raise ValueError("a table of id and tick is needed")
        key, tick = table.dataType.fields
        out = T.StructType().add(key.name, key.dataType).add("range_index", T.IntegerType()).add("start_sec", T.DoubleType()).add("end_sec", T.DoubleType())
        return AnalyzeResult(out, partitionBy=[PartitioningColumn(key.name)], orderBy=[OrderingColumn(tick.name)])

    def eval(self, row) -> Iterator[tuple]:
        key, tick = row
        if tick is None:
            return
        t = round(float(tick), 6)
        if self.last is None or t - self.last > EPS:
            if self.last is not None:
                yield key, self.n, self.last, t
                self.n += 1
            self.last = t


def register(spark: SparkSession) -> None:
    """Makes tick_ranges(TABLE(SELECT id, tick ...)) known to a session."""
    spark.udtf.register("tick_ranges", F.udtf(TickRanges))


def _kept(ticks: np.ndarray, last: float | None) -> np.ndarray:
    """Places of the sorted ticks that lie more than EPS behind the last one kept before them."""
    # more than EPS behind its neighbour a tick is kept whatever came before; only the others need the fold
    keep = np.diff(ticks, prepend=-np.inf if last is None else last) > EPS
    held, at = last, -2
    for i in np.flatnonzero(~keep).tolist():
        if i != at + 1 and i:
            held = ticks[i - 1]
        at = i
        if ticks[i] - held > EPS:
            keep[i], held = True, ticks[i]
    return np.flatnonzero(keep)


def fold_ticks(df: DataFrame, id_col: str, tick_col: str) -> DataFrame:
    """(id, range_index, start_sec, end_sec) of the ranges between merged ticks, from rows (id, tick), in time linear in the ticks of an id.

    Ticks are rounded to six places; one within 1e-6 of the last one kept goes. Null ids, and null and NaN ticks, are left out; an id
    with one tick has no range. Rows are sorted by range of (id, tick), so an id of very many ticks is spread over tasks.
    """
    rows = df.select(F.col(id_col).alias("id"), exact_round(F.col(tick_col).cast("double"), 6).alias("t")).where("id is not null and t is not null and not isnan(t)")
    ordered = rows.repartitionByRange("id", "t").sortWithinPartitions("id", "t").withColumn("p", F.spark_partition_id())
    ordered = durable(ordered)
    # one row a range reaches the driver: where it starts and ends
    ends = {r.p: r for r in ordered.groupBy("p").agg(F.min(F.struct("id", "t")).alias("a"), F.max(F.struct("id", "t")).alias("b")).collect()}
    order = sorted(ends)
    before = {p: q for q, p in zip(order, order[1:]) if ends[q].b.id == ends[p].a.id}  # ranges that go on with an id, and from where
    whole = {p for p in order if ends[p].a.id == ends[p].b.id}
    close = {p for p, q in before.items() if ends[p].a.t - ends[q].b.t <= EPS}  # whose first tick may go, by the last one kept before
    tail: dict[int, tuple[float | None, int]] = {}  # by range: the last tick kept of the id that it ends with, and how many are
    carry: dict[int, tuple[float, int]] = {}  # by range: the same of the id that it starts with, over all ranges before it

    def tails(of: list[int]) -> dict[int, tuple[float | None, int]]:
        known = {q: carry[q][0] for q in of if q in whole and q in close}

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, n, p = None, 0, None
            for b in batches:
                if b.num_rows:
                    if p is None:
                        p = b.column(2)[0].as_py()
                        last = known.get(p)
                    t = b.column(1).to_numpy()
                    kept = _kept(t, last)
                    if len(kept):
                        last, n = float(t[kept[-1]]), n + len(kept)
            if p is not None:
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([last if n else None], pa.float64()), pa.array([n], pa.int64())], names=["p", "last", "n"])

        own = F.create_map(*[F.lit(x) for q in of for x in (q, ends[q].b.id)])
        rows = ordered.where(F.col("p").isin(of) & (F.col("id") == own[F.col("p")]))
        return {r.p: (r.last, r.n) for r in rows.mapInArrow(fold, "p int, last double, n long").collect()}

    # one job, and another only where ticks within EPS of each other fill a whole range
    while True:
        for p in order:
            if p in before and p not in carry and (q := before[p]) in tail:
                on = q in whole and q in before
                if not on or q in carry:
                    last, n = tail[q]
                    carry[p] = (carry[q][0] if last is None else last, n + (carry[q][1] if on else 0))
        ready = [q for q in set(before.values()) if q not in tail and (not (q in whole and q in close) or q in carry)]
        if not ready:
            break
        tail |= tails(ready)
    kind = ordered.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, n = None, None, 0
        first = True
        for b in batches:
            ids, t, p = b.column(0), b.column(1).to_numpy(), b.column(2)
            codes = ids.dictionary_encode()
            place = codes.indices.to_numpy()
            cuts = np.flatnonzero(np.diff(place)) + 1
            for s, e in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(t)]])):
                if s == e:
                    continue
                key = codes.dictionary[int(place[s])].as_py()
                if first or key != own:
                    own, (last, n) = key, carry.get(p[int(s)].as_py(), (None, 0)) if first else (None, 0)
                    first = False
                kept = t[s:e][_kept(t[s:e], last)]
                if not len(kept):
                    continue
                starts = np.concatenate([[last] if last is not None else [], kept[:-1]])
                stops = kept if last is not None else kept[1:]
                if len(stops):
                    at = n - 1 if last is not None else 0
                    columns = [pa.array([key] * len(stops), ids.type), pa.array(np.arange(at, at + len(stops), dtype=np.int32)), pa.array(starts), pa.array(stops)]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "range_index", "start_sec", "end_sec"])
                last, n = float(kept[-1]), n + len(kept)

    out = T.StructType([T.StructField("id", kind), T.StructField("range_index", T.IntegerType()), T.StructField("start_sec", T.DoubleType()), T.StructField("end_sec", T.DoubleType())])
    return ordered.mapInArrow(run, out).withColumnRenamed("id", id_col)
