"""Set and key joins between runs of a pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resume(inputs: DataFrame, done: DataFrame, key: str, complete=None) -> DataFrame:
    """Inputs whose key is not among the completed rows."""
    finished = done if complete is None else done.where(complete)
    return inputs.join(finished.select(key), key, "left_anti")


def merge_pass(rows: DataFrame, result: DataFrame, key: str, names: str, ok: str, error: str) -> DataFrame:
    """A later pass merged into rows: names united in order, ok of both, errors joined by `; `, other columns replaced."""
    shared = {names, ok, error, key}
    new = result.select(key, F.col(names).alias("__names"), F.col(ok).alias("__ok"), F.col(error).alias("__error"), *[c for c in result.columns if c not in shared])
    kept = rows.drop(*[c for c in result.columns if c not in shared])
    out = kept.join(new, key)
    empty = F.array().cast("array<string>")
    return out.withColumns({
        names: F.array_distinct(F.concat(F.coalesce(F.col(names), empty), F.coalesce("__names", empty))),
        ok: F.least(F.col(ok), F.col("__ok")),
        error: F.concat_ws("; ", F.nullif(F.col(error), F.lit("")), F.nullif(F.col("__error"), F.lit(""))),
    }).drop("__names", "__ok", "__error")


def exclude(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed; a null key is kept, as it equals none."""
    return rows.join(listed.select(key), key, "left_anti")


def fetch(rows: DataFrame, wanted: DataFrame, key: str, order: list) -> DataFrame:
    """The last full row, by the order, of each wanted key."""
    from .selection import latest

    return latest(rows.join(wanted.select(key), key, "left_semi"), key, order)


def ordered_fetch(rows: DataFrame, wanted: DataFrame, key: str, position: str, same: str | None = None) -> DataFrame:
    """Rows of the wanted keys in the order of their positions.

    With `same`, repeated rows of a key are one if they agree in that column, and an error otherwise; wanted keys
    without a row are an error too.
    """
    if same is not None:
        per_key = rows.join(wanted.select(key).distinct(), key, "left_semi").groupBy(key).agg(F.count_distinct(F.col(same)).alias("__n"), F.first(F.struct(*rows.columns)).alias("__row"))
        odd = per_key.where("__n > 1").select(key).limit(1).collect()
        gone = missing(wanted, rows, key).limit(1).collect()
        if odd or gone:
            raise ValueError(f"rows of {key} {odd[0][0]} differ in {same}" if odd else f"no row of {key} {gone[0][0]}")
        rows = per_key.select("__row.*")
    return wanted.join(rows, key).orderBy(position)


def missing(wanted: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).join(rows.select(key), key, "left_anti")


def union_lists(a, b):
    """Ordered union of two arrays of names."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(a, empty), F.coalesce(b, empty)))
