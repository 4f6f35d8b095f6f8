"""Training-side samples: buckets, batches, splits, mixtures, manifests. Orders come from hashes, so they repeat."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import durable


def portable_order(id_col: str, seed: int, factor: int = 1103515245, prime: int = 2147483647) -> Column:
    """A shuffled order that other engines can compute too."""
    return F.pmod(F.pmod(F.col(id_col), F.lit(prime)) * factor + seed, F.lit(prime))


def numbered(df: DataFrame, order: list[str], bucket: str | None = None) -> DataFrame:
    """df with `rn`, the place from 0 on by the order (in its bucket), and `n`, the number of rows (in its bucket).

    Rows are sorted by range, so a large bucket is several tasks; a range's first number comes from the sizes of
    those before it, of which there are as many as partitions and buckets.
    """
    by = [*([bucket] if bucket else []), *order]
    ranged = durable(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__p", F.spark_partition_id()))
    own = F.col(bucket) if bucket else F.lit(0)
    # the place in a range is there already, as its rows are sorted: no second shuffle of rows
    rows = ranged.withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).withColumn("__own", own)
    sizes = ranged.groupBy(own.alias("__b"), F.col("__p").alias("__q")).agg(F.count("*").alias("__k"))
    w = Window.partitionBy("__b")
    earlier = lambda v: F.coalesce(F.sum("__k").over(v.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # rows of the bucket in ranges before, less rows of other buckets before it in its range
    shift = earlier(w.orderBy("__q")) - earlier(Window.partitionBy("__q").orderBy("__b"))
    offsets = sizes.select("__b", "__q", shift.alias("__shift"), F.sum("__k").over(w).alias("n"))
    out = rows.join(offsets, (F.col("__p") == F.col("__q")) & F.col("__own").eqNullSafe(F.col("__b")))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__at") + F.col("__shift")).alias("rn"), "n")


def bucket_batches(df: DataFrame, bucket: str, id_col: str, order: Column, world: int, batch: int, drop_last: bool = True) -> DataFrame:
    """df with batch and rank: global batches of one bucket each, every rank a contiguous slice; short ends are dropped or wrapped."""
    g = world * batch
    rows = numbered(df.withColumn("__order", order), ["__order", id_col], bucket).drop("__order")
    if drop_last:
        rows = rows.where(F.col("rn") < F.floor(F.col("n") / g) * g)
    else:
        # the first rows of a bucket fill its last batch, as often as needed
        need = F.pmod(-F.col("n"), F.lit(g))
        extra = F.floor((need - 1 - F.col("rn")) / F.col("n")) + 1
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.when(F.col("rn") < need, extra).otherwise(0)).cast("int"))))
        rows = rows.withColumn("rn", F.col("rn") + F.col("copy") * F.col("n")).drop("copy")
    return rows.withColumns({"batch": F.floor(F.col("rn") / g).cast("long"), "rank": F.floor(F.pmod("rn", F.lit(g)) / batch).cast("int")}).drop("rn", "n")


def shuffled_batches(df: DataFrame, bucket: str, batch: str, seed: int) -> DataFrame:
    """(bucket, batch, step): the order in which batches of all buckets are taken, by a seeded hash; one row a batch."""
    batches = df.select(bucket, batch).distinct().withColumn("__order", F.xxhash64(F.col(bucket), F.col(batch), F.lit(seed)))
    return numbered(batches, ["__order", bucket, batch]).select(bucket, batch, F.col("rn").alias("step"))


def bucket_index(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(keys, n, first): how many items each composite bucket holds, and the ids of the first k by `id`."""
    w = Window.partitionBy(*keys).orderBy("id")
    first = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).groupBy(*keys).agg(F.array_sort(F.collect_list("id")).alias("first"))
    return df.groupBy(*keys).agg(F.count("*").alias("n")).join(first, keys)


def bucket_totals(df: DataFrame, bucket: str, g: int, wrap: bool = False) -> DataFrame:
    """(bucket, n, used, dropped, batches) if short ends are dropped; with wrap they are filled up, and nothing is dropped."""
    n = F.count("*")
    if wrap:
        return df.groupBy(bucket).agg(n.alias("n"), (F.ceil(n / g) * g).cast("long").alias("used"), F.lit(0).cast("long").alias("dropped"), F.ceil(n / g).cast("long").alias("batches"))
    return df.groupBy(bucket).agg(n.alias("n"), (F.floor(n / g) * g).cast("long").alias("used"), F.pmod(n, F.lit(g)).cast("long").alias("dropped"), F.floor(n / g).cast("long").alias("batches"))


def split_without_leaks(df: DataFrame, strata: str, group: str, id_col: str, order: Column, val_each: int, train_each: int) -> DataFrame:
    """df with `split`: val rows first, then train rows from groups that no val row comes from; other rows go.

    Only the first val_each and train_each rows of a stratum are wanted, so every task passes on no more than these.
    """
    w = Window.partitionBy(strata).orderBy(order, id_col)
    val = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= val_each).drop("__rn")
    used = val.select(group).distinct()
    rest = df.join(used, group, "left_anti").withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= train_each).drop("__rn")
    return val.withColumn("split", F.lit("val")).unionByName(rest.withColumn("split", F.lit("train")))


def mixture_weights(df: DataFrame, dataset: str, weights: dict[str, float] | None = None) -> DataFrame:
    """(dataset, n, weight): the weight of one sample, so that datasets weigh as asked (alike by default); all samples' weights sum to 1."""
    counted = df.groupBy(dataset).agg(F.count("*").alias("n"))
    asked = F.lit(1.0) if weights is None else F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col(dataset)]
    rows = counted.withColumn("__w", asked)
    total = rows.agg(F.sum("__w").alias("__t"))
    return rows.join(F.broadcast(total)).select(dataset, "n", (F.col("__w") / F.col("__t") / F.col("n")).alias("weight"))  # one row


def weighted_sample(df: DataFrame, weight: str, draws: int, seed: int) -> DataFrame:
    """Rows with `draws_of`: how often each is drawn in about `draws` draws with replacement, proportionally to its weight.

    Every row draws for itself (a Poisson count of its expected number), so no task needs all rows.
    """
    total = df.agg(F.sum(weight)).first()[0] or 1.0

    @F.pandas_udf("int")
    def count(key: pd.Series, expected: pd.Series) -> pd.Series:
        out = [np.random.default_rng(k & ((1 << 63) - 1)).poisson(e) for k, e in zip(key, expected)]
        return pd.Series(out, dtype="int32")

    key = F.xxhash64(*df.columns, F.lit(seed))
    return df.withColumn("draws_of", count(key, F.col(weight) * draws / total)).where("draws_of > 0")


def weighted_draws(df: DataFrame, weight: str, id_col: str, draws: int, seed: int, world: int = 1) -> DataFrame:
    """(draw, rank, id_col) of exactly `draws` draws with replacement, proportionally to weight; rank takes every world-th draw.

    Draw i falls on a point of the line on which rows lie end to end, in the order of their ids, as long as their
    weights; the points are those of a portable generator. Rows and points are sorted together by range, and each
    point takes the last row before it, so no task holds all rows. Weights that are null or not positive get no
    draw; a table without any gives no rows.
    """
    from .graph import durable

    rows = durable(df.select(F.col(id_col).alias("id"), F.col(weight).cast("double").alias("w")).where("w > 0").repartitionByRange("id").withColumn("p", F.spark_partition_id()))
    sums = {r["p"]: r["w"] for r in rows.groupBy("p").agg(F.sum("w").alias("w")).collect()}
    if not sums:
        return rows.select(F.lit(0).cast("long").alias("draw"), F.lit(0).alias("rank"), F.col("id").alias(id_col)).limit(0)
    starts, total = [], 0.0
    for p in sorted(sums):
        starts.append((p, total))
        total += sums[p]
    before = F.create_map(*[F.lit(x) for s in starts for x in s])
    cum = F.sum("w").over(Window.partitionBy("p").orderBy("id").rowsBetween(Window.unboundedPreceding, -1))
    lines = rows.select("p", (before[F.col("p")] + F.coalesce(cum, F.lit(0.0))).alias("at"), F.lit(-1).cast("long").alias("draw"), "id")
    i = F.col("draw")
    point = F.pmod(F.pmod(i + 1, F.lit(2147483647)) * 1103515245 + seed, F.lit(2147483647)) / F.lit(2147483647.0) * F.lit(total)
    points = df.sparkSession.range(draws).select(F.col("id").alias("draw")).withColumn("at", point)
    parts = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")) for p, s in starts])
    points = points.select(F.element_at(F.filter(parts, lambda x: x["s"] <= F.col("at")), -1)["p"].alias("p"), "at", "draw", F.lit(None).cast(rows.schema["id"].dataType).alias("id"))
    owner = F.last("id", ignorenulls=True).over(Window.partitionBy("p").orderBy("at", "draw"))
    return lines.union(points).withColumn("owner", owner).where("draw >= 0").select("draw", F.pmod("draw", F.lit(world)).cast("int").alias("rank"), F.col("owner").alias(id_col))


def metadata_shards(df: DataFrame, id_col: str, size: int) -> DataFrame:
    """df with `shard`: consecutive ids, `size` rows each."""
    return numbered(df, [id_col]).withColumn("shard", F.floor(F.col("rn") / size).cast("long")).drop("rn", "n")


def manifest_lines(df: DataFrame, path: str, label: str) -> DataFrame:
    """One text column: path and label; a path with white space is an error."""
    bad = F.col(path).rlike(r"\s")
    return df.select(F.when(bad, F.raise_error(F.concat(F.lit("white space in path: "), F.col(path)))).otherwise(F.concat_ws(" ", F.col(path), F.col(label))).alias("value"))


def packing_reject(duration: Column, width: Column, height: Column, passed: Column, min_sec: float, max_sec: float, min_px: int, max_px: int) -> Column:
    """The first reason against a clip, in the order select, duration, resolution; null if there is none."""
    px = width * height
    return F.coalesce(
        F.when(~passed.eqNullSafe(F.lit(1)), "select_pass"),
        F.when(duration.isNull(), "missing_duration"), F.when(duration < min_sec, "duration_below_min"), F.when(duration > max_sec, "duration_above_max"),
        F.when(px.isNull(), "missing_resolution"), F.when(px < min_px, "resolution_below_min"), F.when(px > max_px, "resolution_above_max"),
    )


def random_ranges(df: DataFrame, id_col: str, duration: str, length: float, count: int, step: float, seed: int) -> DataFrame:
    """(id, index, start_sec, end_sec): up to `count` windows on a step grid, drawn per id by its own seeded generator."""
    import hashlib
    import random

    kind = df.schema[id_col].dataType.simpleString()

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for i, d in zip(pdf[id_col], pdf[duration]):
                grid = int((d - length) / step + 1e-9) + 1 if d >= length else 0
                rng = random.Random(int.from_bytes(hashlib.blake2b(f"{seed}:{i}".encode(), digest_size=8).digest(), "big"))
                for k in range(count if grid else 0):
                    s = round(rng.choice(range(grid)) * step, 6)
                    out.append((i, k, s, round(s + length, 6)))
            yield pd.DataFrame(out, columns=[id_col, "index", "start_sec", "end_sec"])

    return df.select(id_col, duration).where(F.col(duration).isNotNull()).mapInPandas(draw, f"`{id_col}` {kind}, index int, start_sec double, end_sec double")
