"""Exact top-k by inner product with block-at-a-time pruning.

Vectors are quantised to integers; a dimension is a term. Candidates are sorted once, by the Gray rank of their
signs, so that alike vectors are neighbours, and cut into cells and, within these, document-range blocks. Cells and
blocks keep the largest and the smallest weight of each term; the sums of a query's term maxima bound the scores
below. Every query first visits the cell of its highest bound, which gives it a k-th score. Then only those pairs
of query and cell travel whose bound reaches that score. In a cell, blocks are visited in the order of their bounds and
scored through their forward indexes, row by row, until no bound left reaches the k-th score.

Queries travel to cells: what is shuffled is the pairs that are left and each cell once for SLOT batches of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, in_arrow
from .simhash import gray_key

#: Candidates of a cell and of a block, queries of a batch, batches that meet a cell together, cells whose bounds meet a batch together.
CELL, BLOCK, BATCH, SLOT, CHUNK = 4096, 32, 512, 64, 1024


def quantised(vector: Column, scale: float = 1024.0) -> Column:
    """floor(scale * x) of every component; null if the vector is null, empty, or holds a null or non-finite component."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when((F.size(vector) > 0) & good, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def signs(vector: Column) -> Column:
    """The signs of up to 63 components as a long."""
    return F.aggregate(F.slice(vector, 1, 63), F.lit(0).cast("long"), lambda s, x: s * 2 + F.when(x > 0, 1).otherwise(0))


def upper_bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """[query, group]: what no score of the group exceeds, from its largest and smallest weights, rounding included."""
    q = queries.astype(np.float64)
    over, under = np.maximum(q, 0), np.minimum(q, 0)
    bound = over @ high.T + under @ low.T
    return bound + 1e-12 * (np.abs(q) @ np.maximum(np.abs(high), np.abs(low)).T) + (0 if np.abs(bound).max(initial=0) < 2.0**50 else 1)


def _scores(rows: np.ndarray, query: np.ndarray, exact_float: bool) -> np.ndarray:
    if exact_float:
        return (rows @ query).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(r, query)) for r in rows.astype(object)], object)


def search_cell(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray | None = None) -> list[tuple]:
    """(query, id, score) of each query's k best candidates of other ids, ties to smaller ids; least: scores below need not be found.

    Rows are taken in the order given, in blocks of neighbours. Ids may repeat: every row is a candidate.
    """
    width = vectors.shape[1]
    exact_float = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * width < 2.0**53
    starts = np.arange(0, len(ids), BLOCK)
    high, low = (f(vectors, starts).astype(np.float64) for f in (np.maximum.reduceat, np.minimum.reduceat))
    bounds = upper_bounds(queries, high, low)
    if exact_float:
        vectors, queries = vectors.astype(np.float64), queries.astype(np.float64)
    least = np.full(len(query_ids), -np.inf) if least is None else least
    out = []
    for q, query, bound, floor in zip(query_ids.tolist(), queries, bounds, least.tolist()):
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64 if exact_float else object)
        visit = np.argsort(-bound, kind="stable")
        at, step = 0, 4
        while at < len(visit):
            todo = visit[at : at + step]
            # equal bounds may still hold ties of smaller ids
            todo = todo[bound[todo] >= (max(floor, best[k - 1]) if len(best) >= k else floor)]
            if not len(todo):
                break
            rows = (starts[todo, None] + np.arange(BLOCK)).ravel()
            rows = rows[rows < len(ids)]
            rows = rows[ids[rows] != q]
            best_ids, best = np.concatenate([best_ids, ids[rows]]), np.concatenate([best, _scores(vectors[rows], query, exact_float)])
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
            at, step = at + step, min(64, step * 2)
        out += [(q, i, int(s)) for i, s in zip(best_ids.tolist(), best.tolist())]
    return out


def block_cells(rows: DataFrame, cell: int = CELL) -> DataFrame:
    """(cell, w, ids, codes, high, low) of the candidates (id, v): up to `cell` neighbours of one width w; numbers as 8 bytes each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, size = TaskContext.get().partitionId() << 32, [], 0

        def give() -> pa.RecordBatch:
            ids, m = (np.concatenate(x) for x in zip(*held))
            row = (place, m.shape[1], ids.tobytes(), m.tobytes(), m.max(axis=0).astype(np.float64).tobytes(), m.min(axis=0).astype(np.float64).tobytes())
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=["cell", "w", "ids", "codes", "high", "low"])

        for b in batches:
            ids, widths = b.column(0).to_numpy(), b.column(1).to_numpy()
            flat, ends = b.column(2).flatten().to_numpy(), np.cumsum(widths)
            at = 0
            while at < len(ids):
                w = widths[at]
                if held and (held[0][1].shape[1] != w or size >= cell):
                    yield give()
                    place, held, size = place + 1, [], 0
                same = int(np.argmin(np.append(widths[at:] == w, False)))
                n = min(same, cell - size)
                held.append((ids[at : at + n].astype(np.int64), flat[ends[at] - w : ends[at + n - 1]].reshape(n, w).astype(np.int64)))
                at, size = at + n, size + n
        if held:
            yield give()

    keyed = rows.select("id", F.size("v").alias("w"), "v", gray_key(signs(F.col("v"))).alias("key"))
    # ids break ties, so that a vector that very many rows share is spread over cells like others
    ranged = keyed.repartitionByRange(max(1, -(-rows.count() // cell)), "w", "key", "id").sortWithinPartitions("w", "key", "id")
    return durable(in_arrow(ranged.select("id", "w", "v"), cut, "cell long, w int, ids binary, codes binary, high binary, low binary"))


def near_cells(asked: DataFrame, cells: DataFrame, every: bool) -> DataFrame:
    """(id, v, batch, least, cell, bound) of pairs of a query (id, v, w, batch, least, own) and a cell.

    Of each query the pair of the highest bound for each CHUNK of cells or, with `every`, all that reach `least`, but for the
    cell `own`. Bounds of cells and batches of queries meet in blocks.
    """
    chunks, batches = max(1, -(-cells.count() // CHUNK)), max(1, -(-asked.count() // BATCH))
    left = asked.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = cells.select(F.col("w").alias("w2"), "cell", "high", "low", F.pmod(F.xxhash64("cell"), F.lit(chunks)).cast("int").alias("chunk2"))
    right = right.withColumn("batch2", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))

    def choose(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"id": [], "v": np.zeros(0, object), "batch": [], "least": [], "cell": [], "bound": []})
        high, low = (np.stack([np.frombuffer(x, np.float64) for x in c[n]]) for n in ("high", "low"))
        bound = upper_bounds(np.stack(q["v"].to_list()), high, low)
        cell = c["cell"].to_numpy()
        if every:
            reach = bound >= q["least"].fillna(-np.inf).to_numpy()[:, None]
            i, j = np.nonzero(reach & (q["own"].to_numpy()[:, None] != cell))
        else:
            i, j = np.arange(len(q)), bound.argmax(axis=1)
        out = q.iloc[i][["id", "v", "batch", "least"]].reset_index(drop=True)
        return out.assign(cell=cell[j], bound=bound[i, j])

    met = left.groupBy("w", "batch", "chunk").cogroup(right.groupBy("w2", "batch2", "chunk2"))
    return met.applyInPandas(choose, "id long, v array<long>, batch int, least double, cell long, bound double")


def search(pairs: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score) of the k best candidates in each cell for the queries sent there."""
    sent = pairs.select("cell", F.floor(F.col("batch") / SLOT).cast("int").alias("slot"), F.col("id").alias("q"), "v", "least")
    there = sent.select("cell", "slot").distinct()
    own = cells.join(there, "cell").select(F.col("cell").alias("cell2"), F.col("slot").alias("slot2"), "w", "ids", "codes")

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for w, ids, codes in zip(c["w"], c["ids"], c["codes"]) if len(q) else ():
            vectors = np.frombuffer(codes, np.int64).reshape(-1, w)
            out += search_cell(np.frombuffer(ids, np.int64), vectors, q["q"].to_numpy(np.int64), np.stack(q["v"].to_list()), k, q["least"].fillna(-np.inf).to_numpy())
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype({"query_id": "int64", "id": "int64", "score": "int64"})

    met = sent.groupBy("cell", "slot").cogroup(own.groupBy("cell2", "slot2"))
    return met.applyInPandas(meet, "query_id long, id long, score long")


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """query_id, rank, id_col, score: each query's k best rows of df by integer inner product, exactly.

    `queries` has the columns of df. A query's own row (every row of its id) is no candidate; ties go to
    smaller ids. Vectors that are null, empty, hold null or non-finite components, or have a null id take
    no part; vectors of another length than the query's never meet it. Repeated query rows count once, by
    their smallest vector; repeated candidate rows are candidates each. Queries without candidates and
    empty tables give no rows.
    """
    def clean(x: DataFrame) -> DataFrame:
        return x.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v")).where("id is not null and v is not null")

    cells = block_cells(clean(df))
    none = F.lit(None).cast("double")
    asked = durable(clean(queries).groupBy("id").agg(F.min("v").alias("v")).withColumn("w", F.size("v")))
    # the cell of each query's highest bound, and the k-th score there
    best = near_cells(asked.withColumns({"least": none, "own": F.lit(-1).cast("long")}), cells, every=False)
    best = durable(best.groupBy("id").agg(F.max_by(F.struct("v", "batch", "least", "cell"), "bound").alias("x")).select("id", "x.*"))
    first = durable(search(best, cells, k))
    limits = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("least"))
    known = asked.join(limits, "id", "left").join(best.select("id", F.col("cell").alias("own")), "id")
    found = first.union(search(near_cells(known, cells, every=True), cells, k))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
