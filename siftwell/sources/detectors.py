"""Detectors of cut points: what can be asked for, what may be combined, and their union."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sampling import random_ranges
from ..operators.timeline import inner_times, merge_ticks, ranges_to_ticks, uniform_ranges


@dataclass(frozen=True)
class Detector:
    """ticks(df, id_col, duration) gives (id_col, ticks, error): cut points in seconds, or why there are none.

    One that needs metadata only sets the clips by itself, so it stands alone.
    """

    ticks: Callable[[DataFrame, str, str], DataFrame]
    metadata_only: bool = False


def uniform(length: float) -> Detector:
    """Full windows of a length from the start."""

    def ticks(df: DataFrame, id_col: str, duration: str) -> DataFrame:
        return df.select(id_col, ranges_to_ticks(uniform_ranges(F.col(duration), length)).alias("ticks"), F.lit("").alias("error"))

    return Detector(ticks, metadata_only=True)


def drawn(length: float, count: int, step: float, seed: int) -> Detector:
    """Windows of a length drawn on a grid; all their ends are ticks."""

    def ticks(df: DataFrame, id_col: str, duration: str) -> DataFrame:
        found = random_ranges(df, id_col, duration, length, count, step, seed)
        ends = F.flatten(F.collect_list(F.array("start_sec", "end_sec")))
        found = found.groupBy(id_col).agg(ends.alias("ticks"))
        return df.select(id_col).join(found, id_col, "left").select(id_col, F.coalesce("ticks", F.array().cast("array<double>")).alias("ticks"), F.lit("").alias("error"))

    return Detector(ticks, metadata_only=True)


def from_column(ticks: str, ok: str | None = None, error: str | None = None) -> Detector:
    """Cut points that a provider has put into a column, with its flag and error, if it has them."""

    def found(df: DataFrame, id_col: str, duration: str) -> DataFrame:
        fine: Column = F.col(ok) == 1 if ok else F.col(ticks).isNotNull()
        why = F.coalesce(F.col(error), F.lit("")) if error else F.lit("no cut points")
        return df.select(id_col, F.when(fine, F.col(ticks)).alias("ticks"), F.when(fine, "").otherwise(why).alias("error"))

    return Detector(found)


def combined(registry: dict[str, Detector], names: list[str]) -> list[Detector]:
    """The detectors of these names. None, repeated or unknown ones are errors, and so is one that needs metadata only beside others."""
    if not names or len(set(names)) < len(names):
        raise ValueError(f"one detector or several different ones are needed, not {names}")
    if unknown := sorted(set(names) - set(registry)):
        raise ValueError(f"unknown detectors: {unknown}")
    if len(names) > 1 and (alone := [n for n in names if registry[n].metadata_only]):
        raise ValueError(f"{', '.join(alone)} cannot be combined with other detectors")
    return [registry[n] for n in names]


def detect(df: DataFrame, registry: dict[str, Detector], names: list[str], id_col: str = "video_id", duration: str = "duration_sec") -> DataFrame:
    """df with ticks_sec (both ends and all detectors' cut points inside, merged), detectors, detect_ok and detect_error.

    A detector that stands alone sets the ticks as they are, without ends. An id that a detector failed for has no ticks and
    the errors of all that failed, in the order of names. Ids are unique; each detector costs one join by id, of narrow rows.
    """
    found = combined(registry, names)
    base = df.drop("ticks_sec", "detectors", "detect_ok", "detect_error")
    for i, d in enumerate(found):
        own = d.ticks(df, id_col, duration).select(F.col(id_col).alias("__id"), F.col("ticks").alias(f"__t{i}"), F.col("error").alias(f"__e{i}"))
        base = base.join(own, F.col(id_col) == F.col("__id"), "left").drop("__id")
    why = F.concat_ws("; ", *[F.when(F.coalesce(F.col(f"__e{i}"), F.lit("not detected")) != "", F.concat(F.lit(f"{n}: "), F.coalesce(F.col(f"__e{i}"), F.lit("not detected")))) for i, n in enumerate(names)])
    inner = F.concat(*[F.coalesce(F.col(f"__t{i}"), F.array().cast("array<double>")) for i in range(len(found))])
    whole = inner if found[0].metadata_only else F.concat(F.array(F.lit(0.0)), inner_times(inner, F.col(duration)), F.array(F.col(duration).cast("double")))
    out = base.withColumn("detect_error", why).withColumn("detect_ok", (F.col("detect_error") == "").cast("long"))
    none = F.array().cast("array<double>")
    ticks = F.when(F.col("detect_ok") == 1, merge_ticks(whole)).otherwise(none)
    return out.withColumn("ticks_sec", F.coalesce(ticks, none)).withColumn("detectors", F.array(*map(F.lit, names))).drop(*[f"__{k}{i}" for i in range(len(found)) for k in "te"])
