"""Cut points to clips: ranges, splits, trims, scene edges, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-6


def merge_ticks(ticks: Column) -> Column:
    """Sorted, rounded to six places, without those within 1e-6 of the last one kept (a fold, not a comparison of neighbours)."""
    rounded = F.array_sort(F.transform(ticks, lambda t: F.round(t.cast("double"), 6)))
    return F.aggregate(rounded, F.array().cast("array<double>"), lambda a, t: F.when((F.size(a) == 0) | (t - F.try_element_at(a, F.lit(-1)) > EPS), F.array_append(a, t)).otherwise(a))


def tick_error(ticks: Column, duration: Column) -> Column:
    """Why a tick list is bad, null if it is good: a tick not finite, negative, or behind the end."""
    return (
        F.when(F.exists(ticks, lambda t: t.isNull() | F.isnan(t) | (F.abs(t) == float("inf"))), F.lit("tick not finite"))
        .when(F.exists(ticks, lambda t: t < 0), F.lit("negative tick"))
        .when(F.exists(ticks, lambda t: t > duration + EPS), F.lit("tick beyond duration"))
    )


def ranges(ticks: Column) -> Column:
    """array<struct<start, stop>> between neighbouring merged ticks."""
    return F.zip_with(F.slice(ticks, F.lit(1), F.greatest(F.size(ticks) - 1, F.lit(0))), F.slice(ticks, F.lit(2), F.greatest(F.size(ticks) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("start"), b.alias("stop")))


def tick_ranges(df: DataFrame, id_col: str, ticks: str) -> DataFrame:
    """(id, range_index, start_sec, end_sec, num_ranges) of every range of a list of ticks."""
    cut = df.select(id_col, F.explode(F.array(ranges(merge_ticks(F.col(ticks))))).alias("r"))
    return cut.select(id_col, F.size("r").alias("num_ranges"), F.posexplode("r").alias("range_index", "x")).select(
        id_col, "range_index", F.col("x.start").alias("start_sec"), F.col("x.stop").alias("end_sec"), "num_ranges"
    )


def duration_bucket(seconds: Column) -> Column:
    return F.when(seconds < 2, "<2s").when(seconds <= 10, "2~10s").otherwise(">10s")


def clip_timings(df: DataFrame, id_col: str, ticks: str, min_len: float, max_len: float, split_len: float, trim: float) -> DataFrame:
    """(id, clip_index, split_index, start_sec, end_sec): ranges split where over max_len, trimmed, without those under min_len.

    Only pieces of a range over max_len are cut, into split_len each. Ends between different ranges shrink by
    `trim` if both clips are longer than twice that. Clips are numbered before short ones go, so numbers may gap.
    """
    if not 0 < split_len <= max_len or min_len < 0 or trim < 0:
        raise ValueError("bad lengths")
    r = tick_ranges(df, id_col, ticks).withColumn("len", F.col("end_sec") - F.col("start_sec"))
    pieces = F.when(F.col("len") > max_len + EPS, F.ceil((F.col("len") - EPS) / split_len)).otherwise(1).cast("int")
    s = r.withColumn("n", pieces).withColumn("split_index", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    start = F.col("start_sec") + F.col("split_index") * F.lit(split_len)
    stop = F.when(F.col("split_index") == F.col("n") - 1, F.col("end_sec")).otherwise(start + split_len)
    s = s.select(id_col, "range_index", "split_index", start.alias("a"), stop.alias("b"))
    w = Window.partitionBy(id_col).orderBy("range_index", "split_index")
    long_enough = lambda a, b: b - a > 2 * trim + EPS
    s = s.withColumns({"clip_index": F.row_number().over(w) - 1, "pr": F.lag("range_index").over(w), "pa": F.lag("a").over(w), "pb": F.lag("b").over(w), "nr": F.lead("range_index").over(w), "na": F.lead("a").over(w), "nb": F.lead("b").over(w)})
    mine = long_enough(F.col("a"), F.col("b"))
    front = F.coalesce((F.col("pr") != F.col("range_index")) & mine & long_enough(F.col("pa"), F.col("pb")), F.lit(False))
    back = F.coalesce((F.col("nr") != F.col("range_index")) & mine & long_enough(F.col("na"), F.col("nb")), F.lit(False))
    s = s.select(id_col, "clip_index", "split_index", F.round(F.col("a") + F.when(front, trim).otherwise(0.0), 6).alias("start_sec"), F.round(F.col("b") - F.when(back, trim).otherwise(0.0), 6).alias("end_sec"))
    return s.where((F.col("end_sec") > F.col("start_sec")) & (F.col("end_sec") - F.col("start_sec") >= F.lit(min_len) - EPS))


def uniform_ranges(duration: Column, length: float) -> Column:
    """Full windows of this length from 0; the rest is dropped."""
    n = F.floor((duration + 1e-9) / length).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((i * F.lit(length)).alias("start"), ((i + 1) * F.lit(length)).alias("stop")))).otherwise(F.array().cast("array<struct<start:double,stop:double>>"))


def ranges_to_ticks(r: Column) -> Column:
    return F.when(F.size(r) > 0, F.concat(F.transform(r, lambda x: F.round(x["start"], 6)), F.array(F.round(F.element_at(r, -1)["stop"], 6)))).otherwise(F.array().cast("array<double>"))


def inner_times(ticks: Column, end: Column) -> Column:
    return F.filter(ticks, lambda t: (t > 0) & (t < end))


def scene_edges(df: DataFrame, key: str, order: list[str], above: Column) -> DataFrame:
    """Rows at which the condition turns on (edge 1) or off (edge -1) within a key."""
    w = Window.partitionBy(key).orderBy(*order)
    on = F.coalesce(above, F.lit(False)).cast("int")
    return df.withColumn("edge", on - F.coalesce(F.lag(on).over(w), F.lit(0))).where("edge <> 0")


def suppress_short(cuts: Column, least: float, end: Column) -> Column:
    """Cuts inside (0, end) at least `least` after the last one kept, without those at the end that are too near it."""
    inner = F.filter(cuts, lambda t: (t > 0) & (t < end))
    kept = F.aggregate(inner, F.array().cast("array<double>"), lambda a, t: F.when(t - F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0.0)) >= least, F.array_append(a, t)).otherwise(a))
    return F.filter(kept, lambda t: end - t >= least)


def islands(df: DataFrame, order: list[str], key: str, partition: str) -> DataFrame:
    """df with `island`: the number of the run of equal keys within a partition, in order."""
    w = Window.partitionBy(partition).orderBy(*order)
    new = F.coalesce((~F.col(key).eqNullSafe(F.lag(key).over(w))).cast("int"), F.lit(1))
    first = F.row_number().over(w) == 1
    return df.withColumn("__new", F.when(first, 1).otherwise(new)).withColumn("island", F.sum("__new").over(w)).drop("__new")


def range_stats(df: DataFrame, id_col: str, ticks: str, duration: str) -> DataFrame:
    """Per id: ranges, long ones (over 10 s), short ones (under 2 s), mean length; ticks are clamped and both ends added."""
    d = F.col(duration)
    clamped = F.concat(F.array(F.lit(0.0)), F.transform(F.col(ticks), lambda t: F.greatest(F.lit(0.0), F.least(t, d))), F.array(d))
    lengths = F.transform(ranges(merge_ticks(clamped)), lambda r: r["stop"] - r["start"])
    return df.select(id_col, lengths.alias("l")).select(
        id_col, F.size("l").alias("n"), F.size(F.filter("l", lambda x: x > 10)).alias("long"), F.size(F.filter("l", lambda x: x < 2)).alias("short"),
        F.round(F.try_divide(F.aggregate("l", F.lit(0.0), lambda s, x: s + x), F.size("l")), 6).alias("mean_len"),
    )
