"""Exact cosine joins through blocks of vectors around pivots.

Pivots are picked from a bounded sample, far from each other. Each vector belongs to its nearest pivot; sorted by pivot and
angle to it, vectors are cut into blocks, and a block knows the range of its members' angles to every pivot. By the
triangle inequality for angles, two blocks whose ranges for some pivot lie further apart than the angle in question hold
no pair: they are dropped by their summaries alone, before any vector moves. Blocks meet in tasks that each read one range of blocks
for either side (tables.crossed), so no vector is shuffled, and a meeting is a matrix product, some rows at a time.

A search for nearest neighbours goes twice: a block first meets itself and the nearest other one, and the k-th best
cosines found there bound what it has to meet then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import bounded_batches, crossed, stored

#: Vectors of a block at most, and their bytes; pivots, and the sample that they are picked from.
BLOCK, BLOCK_BYTES, PIVOTS, SAMPLE = 2048, 2 << 20, 32, 2048
#: Rows of a block in one product; neighbours that a task holds before it lets go of all but the best.
ROWS, HELD = 512, 1 << 19
#: Angles and cosines are compared with this much room, as they are rounded on the way.
ROOM = 1e-7


def _matrix(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), "<f8").reshape(len(parts), -1)


def unit_rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, u): vectors at length 1 as bytes of doubles; a zero vector has zeros. Null ids, null or empty vectors and such with null or non-finite components are left out."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and v is not null and size(v) > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1)
            flat, at = v.values, v.offsets.to_numpy()
            x = flat.to_numpy(zero_copy_only=False)
            bad = ~np.isfinite(x) | flat.is_null().to_numpy(zero_copy_only=False)
            out: list[bytes | None] = []
            for s, e in zip(at, at[1:]):
                norm = np.linalg.norm(x[s:e])
                out.append(None if bad[s:e].any() else (x[s:e] / norm if norm > 0 else x[s:e]).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["id", "u"])

    return rows.mapInArrow(run, T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("u", T.BinaryType())])).where("u is not null")


def pick_pivots(rows: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Up to `pivots` vectors of rows (u) far from each other, out of the `sample` of the smallest hashes; zero vectors are none."""
    given = rows.orderBy(F.xxhash64("u"), "u").limit(sample).select("u").collect()
    x = _matrix([bytes(r.u) for r in given]) if given else np.zeros((0, 1))
    x = x[np.any(x != 0, axis=1)]
    chosen: list[int] = [0] if len(x) else []
    nearest = x @ x[0] if len(x) else np.zeros(0)
    while len(chosen) < min(pivots, len(x)):
        at = int(nearest.argmin())
        if nearest[at] > 1 - 1e-9:
            break
        chosen.append(at)
        nearest = np.maximum(nearest, x @ x[at])
    return x[chosen]


def _angles(u: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(u @ pivots.T, -1, 1)) if len(pivots) else np.zeros((len(u), 1))


def vector_blocks(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(block, pivot, low, high, n, ids, u) of the vectors' blocks; low and high are the ranges of angles to all pivots, u the vectors' bytes.

    All vectors have one length, else an error is raised in the task that meets two. Zero vectors, which are near nothing, are left out.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    rows, _ = stored(unit_rows(df, id_col, vector_col))
    kind = rows.schema["id"].dataType
    p = pick_pivots(rows, pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                u = _matrix(b.column(1).to_pylist())
                some = np.flatnonzero(u.any(axis=1))
                a = _angles(u[some], p)
                nearest = a.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(some), b.column(1).take(some), pa.array(nearest.astype(np.int32)), pa.array(a[np.arange(len(some)), nearest])], names=["id", "u", "pivot", "angle"]
                )

    placed = rows.mapInArrow(place, T.StructType([*rows.schema.fields, T.StructField("pivot", T.IntegerType()), T.StructField("angle", T.DoubleType())]))
    # ties of angle are broken by the vector's hash, so a crowd of equal angles is no single range
    keys = ["pivot", "angle", F.xxhash64("u", "id")]
    placed, _ = stored(placed)
    ordered = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        held: list[bytes] = []
        pivot, number, part = -1, 0, 0

        def row() -> pa.RecordBatch:
            a = _angles(_matrix(held), p)
            cells = [[(part << 32) | number], [pivot], [a.min(axis=0).tolist()], [a.max(axis=0).tolist()], [len(held)], [list(ids)], [b"".join(held)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, arrow)], names=names)

        for b in batches:
            arrow = [pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32(), pa.list_(b.schema.field(0).type), pa.binary()]
            for i, u, at, part in zip(*(b.column(c).to_pylist() for c in (0, 1, 2, 4))):
                if held and (at != pivot or len(held) >= block or (len(held) + 1) * len(u) > BLOCK_BYTES):
                    yield row()
                    ids.clear()
                    held.clear()
                    number += 1
                pivot = at
                ids.append(i)
                held.append(u)
        if held:
            yield row()

    names = ["block", "pivot", "low", "high", "n", "ids", "u"]
    number = T.ArrayType(T.DoubleType())
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, [T.LongType(), T.IntegerType(), number, number, T.IntegerType(), T.ArrayType(kind), T.BinaryType()])])
    return stored(ordered.mapInArrow(cut, schema))[0]


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(x, y, apart) of all pairs of blocks x <= y: how far apart two of their vectors are at least, in radians.

    Only summaries take part.
    """
    s = blocks.select("block", "low", "high")
    left = s.select(F.col("block").alias("x"), F.col("low").alias("lx"), F.col("high").alias("hx"))
    right = s.select(F.col("block").alias("y"), F.col("low").alias("ly"), F.col("high").alias("hy"))
    return crossed(left, right, F.col("x") <= F.col("y"), 1 << 10).select("x", "y", _apart().alias("apart"))


def _apart() -> Column:
    """How far apart two vectors of the blocks of ranges (lx, hx) and (ly, hy) are at least, in radians."""
    gaps = F.zip_with(F.arrays_zip("lx", "hx"), F.arrays_zip("ly", "hy"), lambda a, b: F.greatest(a["lx"] - b["hy"], b["ly"] - a["hx"]))
    return F.greatest(F.array_max(gaps), F.lit(0.0))


def dropped_share(blocks: DataFrame, least: float) -> float:
    """Share of the pairs of different blocks that their summaries rule out for cosines of at least `least`."""
    pairs = block_pairs(blocks).where("x < y")
    n, gone = pairs.agg(F.count("*"), F.count_if(F.col("apart") > float(np.arccos(least)) + ROOM)).first()
    return gone / n if n else 0.0


def _side(blocks: DataFrame, side: str, *more: str) -> DataFrame:
    """Columns of blocks for one side of a meeting: x, xi, xu, xn, lx, hx and <name>_x of more, or y likewise."""
    own = [F.col("block").alias(side), *[F.col(c).alias(f"{side}{n}") for c, n in (("ids", "i"), ("u", "u"), ("n", "n"))]]
    return blocks.select(*own, F.col("low").alias(f"l{side}"), F.col("high").alias(f"h{side}"), *[F.col(c).alias(f"{c}_{side}") for c in more])


def _met(b: pa.RecordBatch) -> Iterator[tuple]:
    """Place in the batch, ids of both and the cosines of some rows of x, of each meeting (x, xi, xu, xn, y, yi, yu, yn) of a batch."""
    at = {n: b.column(i) for i, n in enumerate(b.schema.names)}
    for k in range(b.num_rows):
        (x, xn), (y, yn) = (tuple(at[f"{s}{c}"][k].as_py() for c in ("u", "n")) for s in ("x", "y"))
        xi, yi = (np.array(at[c][k].values.to_pylist()) for c in ("xi", "yi"))
        x, y = np.frombuffer(x, "<f8").reshape(xn, -1), np.frombuffer(y, "<f8").reshape(yn, -1).T
        for s in range(0, xn, ROWS):
            yield k, xi[s : s + ROWS], yi, x[s : s + ROWS] @ y


def pairs_within(df: DataFrame, least: float, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(a, b, cosine) of all pairs a < b of vectors of at least this cosine, which is above 0. Ids are numbers or strings; rows of one id do not pair."""
    if least <= 0:
        raise ValueError("least must be above 0")
    blocks = vector_blocks(df, id_col, vector_col, pivots, block)
    kind = blocks.schema["ids"].dataType.elementType
    near = (F.col("x") <= F.col("y")) & (_apart() <= float(np.arccos(least)) + ROOM)
    met = crossed(_side(blocks, "x"), _side(blocks, "y"), near, BLOCK_BYTES).select("x", "xi", "xu", "xn", "y", "yi", "yu", "yn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(batch.schema.get_field_index(c)) for c in ("x", "y"))
            t = batch.schema.field("xi").type.value_type
            for k, xi, yi, s in _met(batch):
                i, j = np.nonzero(s >= least)
                a, b, c = xi[i], yi[j], s[i, j]
                keep = a < b if x[k] == y[k] else a != b
                a, b, c = a[keep], b[keep], c[keep]
                up = a < b
                yield pa.RecordBatch.from_arrays([pa.array(np.where(up, a, b), t), pa.array(np.where(up, b, a), t), pa.array(c, pa.float64())], names=["a", "b", "cosine"])

    return met.mapInArrow(run, T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("cosine", T.DoubleType())]))


def nearest(df: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", least: float = -1.0, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(id, rank, neighbour, cosine): the k nearest rows of other ids for each row, of cosines (to nine places) of at least `least`; ties to the smaller id."""
    return nearest_of_blocks(vector_blocks(df, id_col, vector_col, pivots, block), k, least)


def nearest_of_blocks(blocks: DataFrame, k: int, least: float = -1.0, asked: Column | None = None) -> DataFrame:
    """The same from vector_blocks(); only for rows of the blocks that `asked`, a condition on column block, takes in."""
    kind = blocks.schema["ids"].dataType.elementType
    all_blocks = F.lit(True) if asked is None else asked
    out = T.StructType([T.StructField("id", kind), T.StructField("neighbour", kind), T.StructField("cosine", T.DoubleType()), T.StructField("home", T.LongType())])

    def best(s: np.ndarray, xi: np.ndarray, yi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the k best of each row, with all that are as good as the last of them, and their cosines."""
        n = s.shape[1]
        if np.isin(xi, yi).any():
            s = np.where(xi[:, None] == yi[None], -np.inf, s)
        last = np.partition(s, n - k, axis=1)[:, n - k] if k < n else np.full(len(s), -np.inf)
        i, j = np.nonzero(s >= np.maximum(last, least)[:, None] - 2e-9)  # cosines are rounded to nine places
        c = np.round(s[i, j], 9)
        some = np.isfinite(c) & (c >= least)
        return np.stack([i[some], j[some]]), c[some]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, low = [], 0, HELD // 2

        def best_of_all() -> list[tuple]:
            """The k best of each row among those held: others are no neighbours of it."""
            own, other, c, home = (np.concatenate(v) for v in zip(*held))
            order = np.lexsort((other, -c, own))
            starts = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1]])
            place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
            order = order[place < k]
            return [(own[order], other[order], c[order], home[order])]

        def row(own: np.ndarray, other: np.ndarray, c: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(own, t), pa.array(other, t), pa.array(c), pa.array(home)], names=["id", "neighbour", "cosine", "home"])

        for batch in batches:
            t = batch.schema.field("xi").type.value_type
            col = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023, E731
            x, y, forth, back = (col(c).to_pylist() for c in ("x", "y", "forth", "back"))
            for r, xi, yi, s in _met(batch):
                for own, other, m, home, asked in ((xi, yi, s, x[r], forth[r]), (yi, xi, s.T, y[r], back[r] and x[r] != y[r])):
                    if asked:
                        (i, j), c = best(m, own, other)
                        held.append((own[i], other[j], c, np.full(len(i), home)))
                        count += len(i)
                if count > HELD:
                    held = best_of_all()
                    count = len(held[0][0])
                    if count > low:
                        yield row(*held[0])
                        held, count = [], 0
        if held:
            yield row(*best_of_all()[0])

    own = blocks.where(all_blocks).select("block", "n", F.lit(True).alias("asked"))
    marked = blocks.join(own.select("block", "asked"), "block", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    # first a block with itself and with the nearest other one
    two = block_pairs(blocks).where("x < y")
    sides = two.select(F.col("x").alias("home"), F.col("y").alias("other"), "apart").union(two.select("y", "x", "apart"))
    near = sides.groupBy("home").agg(F.min(F.struct("apart", F.abs(F.col("home") - F.col("other")), "other"))["other"].alias("next"))
    marked, _ = stored(marked.join(near.withColumnRenamed("home", "block"), "block", "left"))
    # each such pair once, though either block may be the other's nearest: (x, y) with the flags of both
    needs = ["x", "xi", "xu", "xn", "y", "yi", "yu", "yn", "forth", "back"]
    asking = marked.where("asked").select("block", "next")
    early = asking.select(F.least("block", "next").alias("x"), F.greatest("block", "next").alias("y")).where("y is not null and x < y").distinct()
    early = early.union(asking.select("block", "block"))
    meet = early.join(_side(marked, "x", "asked"), "x").join(_side(marked, "y", "asked"), "y")
    first, _ = stored(meet.withColumn("forth", F.col("asked_x")).withColumn("back", F.col("asked_y")).select(*needs).mapInArrow(run, out))
    # the least cosine that could still count for some row of a block
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "neighbour"))
    kth = first.withColumn("rank", rank).groupBy("id", "home").agg(F.max("rank").alias("n"), F.max(F.when(F.col("rank") == k, F.col("cosine"))).alias("kth"))
    bound = kth.groupBy("home").agg(F.min(F.coalesce("kth", F.lit(-2.0))).alias("bound"), F.count("*").alias("rows"))
    full = own.withColumnRenamed("block", "home").join(bound, "home", "left").select("home", F.greatest(F.when(F.col("rows") >= F.col("n"), F.col("bound")).otherwise(-2.0), F.lit(float(least))).alias("bound"))
    full = full.select("home", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("bound") - 2e-9))).alias("within"))  # cosines are rounded to nine places
    ready, _ = stored(marked.join(full.withColumnRenamed("home", "block"), "block", "left"))
    reach = lambda side: F.coalesce(_apart() <= F.col(f"within_{side}") + ROOM, F.lit(False))
    met_early = F.coalesce((F.col("next_x") == F.col("y")) & F.col("asked_x"), F.lit(False)) | F.coalesce((F.col("next_y") == F.col("x")) & F.col("asked_y"), F.lit(False))
    left, right = (_side(ready, side, "asked", "next", "within") for side in "xy")
    rest = crossed(left, right, (F.col("x") < F.col("y")) & ~met_early & (reach("x") | reach("y")), BLOCK_BYTES)
    rest = rest.withColumn("forth", reach("x")).withColumn("back", reach("y")).select(*needs)
    found = first.unionByName(rest.mapInArrow(run, out)).drop("home")
    w: Column = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "neighbour"))
    return found.withColumn("rank", w).where(F.col("rank") <= k).select("id", "rank", "neighbour", "cosine")
