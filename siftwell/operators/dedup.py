"""Deduplication in two phases: features of all rows, then pairs by parts of the work, then groups and rows. Parts done are not done again.

A deduplicator says what its features are, which pairs a part of the work finds, and which member of a group is best. The runner
stores features and each part's pairs as folders that appear as a whole, so a run that broke off goes on with what is missing.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.outputs import commit_folder
from ..sources.shards import exists
from . import vectors
from .graph import components, numbered_groups
from .selection import best_in_group
from .similarity import frame_ratio_match, hamming_matches, strongest


class Deduplicator(Protocol):
    """One method; `name` is also the prefix of its columns and group ids.

    save() writes features of rows below a folder, units() reads (id, ok, error and what best() orders by) from there, pairs() gives
    (a, b, weight) of the pairs that part `part` of `parts` finds, each unordered pair in one part or more, and best() the order of a group's members.
    """

    name: str

    def save(self, rows: DataFrame, path: str) -> None: ...

    def units(self, spark: SparkSession, path: str) -> DataFrame: ...

    def pairs(self, spark: SparkSession, path: str, part: int, parts: int) -> DataFrame: ...

    def best(self) -> list[Column]: ...


def _in_part(key: str, part: int, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)) == part


@dataclass(frozen=True)
class CodeDeduplicator:
    """Clips by the bit codes of their frames: `least_ratio` of a clip's codes lie within `most` bits of another clip's.

    Rows have id, ok, error, codes (array of arrays of longs) and quality. Of a frame the `k` nearest codes count, its own among them.
    """

    name: str = "codes"
    most: int = 31
    k: int = 50
    least_ratio: float = 0.8
    words: int = 4

    def save(self, rows: DataFrame, path: str) -> None:
        own = rows.select("id", "ok", "error", F.col("quality").cast("double").alias("quality"), F.coalesce("codes", F.array().cast("array<array<long>>")).alias("codes"))
        own.write.parquet(f"{path}/units")
        frames = own.where("ok = 1").select("id", F.posexplode("codes").alias("frame", "code")).where("code is not null")
        frames.select("id", F.concat_ws("#", F.col("id").cast("string"), "frame").alias("frame"), "code").write.parquet(f"{path}/frames")

    def units(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.parquet(f"{path}/units").select("id", "ok", "error", "quality", F.size("codes").alias("n"))

    def pairs(self, spark: SparkSession, path: str, part: int, parts: int) -> DataFrame:
        frames = spark.read.parquet(f"{path}/frames")
        asked = frames.where(_in_part("id", part, parts))
        near = hamming_matches(frames.select(F.col("frame").alias("id"), "code"), self.most, self.k - 1, words=self.words, asked=asked.select(F.col("frame").alias("id"), "code"))
        met = frame_ratio_match(near, frames.select("frame", F.col("id").alias("clip")), self.least_ratio, directed=True)
        pairs = met.select(F.col("clip_a").alias("a"), F.col("clip_b").alias("b"), F.col("ratio").alias("weight"), (-F.col("mean_distance")).alias("near"))
        return strongest(pairs, [F.col("weight"), F.col("near")]).select("a", "b", "weight")

    def best(self) -> list[Column]:
        return [-F.col("ok"), -F.coalesce("quality", F.lit(0.0)), -F.col("n")]


@dataclass(frozen=True)
class VectorDeduplicator:
    """Clips by one vector each: cosines of at least `least` among the `k` nearest of either, itself counted.

    Rows have id, ok, error, vector and n (frames that the vector stands for).
    """

    name: str = "vectors"
    least: float = 0.95
    k: int = 50
    pivots: int = vectors.PIVOTS
    block: int = vectors.BLOCK

    def save(self, rows: DataFrame, path: str) -> None:
        rows.select("id", "ok", "error", F.col("n").cast("long").alias("n")).write.parquet(f"{path}/units")
        vectors.vector_blocks(rows.where("ok = 1"), "id", "vector", self.pivots, self.block).write.parquet(f"{path}/blocks")

    def units(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.parquet(f"{path}/units")

    def pairs(self, spark: SparkSession, path: str, part: int, parts: int) -> DataFrame:
        blocks = spark.read.parquet(f"{path}/blocks")
        near = vectors.nearest_of_blocks(blocks, self.k - 1, self.least, asked=_in_part("block", part, parts))
        return near.select(F.least("id", "neighbour").alias("a"), F.greatest("id", "neighbour").alias("b"), "cosine").groupBy("a", "b").agg(F.max("cosine").alias("weight"))

    def best(self) -> list[Column]:
        return [-F.col("ok"), -F.coalesce("n", F.lit(0))]


def duplicate_pairs(rows: DataFrame, deduplicator: Deduplicator, path: str, parts: int = 8) -> DataFrame:
    """(a, b, weight), a < b, of one deduplicator, with features and pairs of parts kept below `path`; what is there already is not made again."""
    spark = rows.sparkSession
    own = f"{path.rstrip('/')}/{deduplicator.name}"
    if not exists(spark, f"{own}/features"):
        commit_folder(spark, f"{own}/features", lambda to: deduplicator.save(rows, to))
    for part in range(parts):
        if not exists(spark, f"{own}/pairs-{part:04d}-of-{parts:04d}"):
            found = deduplicator.pairs(spark, f"{own}/features", part, parts)
            commit_folder(spark, f"{own}/pairs-{part:04d}-of-{parts:04d}", lambda to: found.write.parquet(to))  # noqa: B023
    found = spark.read.parquet(*[f"{own}/pairs-{part:04d}-of-{parts:04d}" for part in range(parts)])
    return found.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("weight").alias("weight"))


def dedup_rows(rows: DataFrame, deduplicators: list[Deduplicator], path: str, parts: int = 8, prepare: dict | None = None) -> DataFrame:
    """(id, <name>_ok, _error, _group_id, _group_size, _is_best_clip_in_group, _best_clip_id_in_group, _json for each, deduplicators, dedup_ok, dedup_error, dedup_json).

    `prepare` gives a deduplicator's input from the rows, by name; else the rows themselves are it. Units of no group stand alone: size 1, best,
    blank ids. An id that a deduplicator does not know has its ok 0. Names are unique. Ids are unique, too.
    """
    names = [d.name for d in deduplicators]
    if not names or len(set(names)) < len(names):
        raise ValueError(f"one deduplicator or several of different names are needed, not {names}")
    spark, out = rows.sparkSession, rows.select("id")
    for d in deduplicators:
        own = (prepare or {}).get(d.name, lambda r: r)(rows)
        pairs = duplicate_pairs(own, d, path, parts)
        units = d.units(spark, f"{path.rstrip('/')}/{d.name}/features")
        labels = components(pairs)
        members = units.join(labels, F.col("id") == F.col("node")).join(numbered_groups(labels, d.name), "component")
        best = best_in_group(members, "group_id", d.best(), "id")
        grouped = members.select("id", "group_id").join(best, "group_id").select(F.col("id").alias("__id"), "group_id", "best_id", "size")
        ok = units.select(F.col("id").alias("__u"), F.col("ok").alias("__ok"), F.col("error").alias("__error"))
        out = out.join(ok, F.col("id") == F.col("__u"), "left").join(grouped, F.col("id") == F.col("__id"), "left")
        found = F.coalesce(F.col("__ok").cast("long"), F.lit(0).cast("long"))
        size = F.coalesce("size", F.lit(1)).cast("long")
        first = (F.coalesce(F.col("best_id") == F.col("id"), F.lit(True))).cast("long")
        columns = {
            f"{d.name}_ok": found, f"{d.name}_error": F.when(found == 1, "").otherwise(F.coalesce("__error", F.lit("no features"))), f"{d.name}_group_id": F.coalesce("group_id", F.lit("")),
            f"{d.name}_group_size": size, f"{d.name}_is_best_clip_in_group": first, f"{d.name}_best_clip_id_in_group": F.coalesce(F.col("best_id").cast("string"), F.lit("")),
        }
        as_json = F.to_json(F.struct(*[columns[f"{d.name}_{k}"].alias(k) for k in ("best_clip_id_in_group", "group_id", "group_size", "is_best_clip_in_group")]))
        out = out.withColumns({**columns, f"{d.name}_json": as_json}).drop("__u", "__ok", "__error", "__id", "group_id", "best_id", "size")
    errors = F.concat_ws("; ", *[F.when(F.col(f"{n}_ok") != 1, F.concat(F.lit(f"{n}: "), F.col(f"{n}_error"))) for n in names])
    together = F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{n}": '), F.col(f"{n}_json")) for n in sorted(names)]), F.lit("}"))
    out = out.withColumn("deduplicators", F.array(*map(F.lit, names))).withColumn("dedup_error", errors)
    return out.withColumn("dedup_ok", (F.col("dedup_error") == "").cast("long")).withColumn("dedup_json", together)
