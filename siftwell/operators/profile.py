"""Profiles: histograms, distributions, overviews, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bins(v: Column, edges: list[float], closed: bool = False) -> Column:
    """Index of the bin [edge, next) that holds v ((edge, next] if closed); null for NaN, null, and values outside."""
    out = F.lit(None).cast("int")
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        inside = (v > a) & (v <= b) if closed else (v >= a) & (v < b)
        out = F.when(inside, F.lit(i)).otherwise(out)
    return F.when(~F.isnan(v.cast("double")), out)


def histogram(df: DataFrame, value: Column, edges: list[float], closed: bool = False, fill: bool = False) -> DataFrame:
    """(bin, low, high, n) of the bins in use, or of all if fill."""
    counted = df.select(bins(value, edges, closed).alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))
    names = df.sparkSession.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:]))], "bin int, low double, high double")
    return names.join(F.broadcast(counted), "bin", "left" if fill else "inner").select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))  # one row a bin


def distribution(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, count, ratio): the share of all rows to six places."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("count"))
    total = counted.agg(F.sum("count").alias("total"))  # one row
    return counted.join(F.broadcast(total)).select(*keys, "count", F.round(F.col("count") / F.col("total"), 6).alias("ratio"))


def percentile_summary(df: DataFrame, value: str, ps: list[float], *keys: str) -> DataFrame:
    """Mean and exact, linearly interpolated percentiles, to three places."""
    cols = [F.round(F.expr(f"percentile(`{value}`, {p}D)"), 3).alias(f"p{round(p * 100)}") for p in ps]
    return df.groupBy(*keys).agg(F.round(F.avg(value), 3).alias("mean"), *cols)


def value_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k commonest values, blanks as `unknown`, ties by value."""
    v = F.coalesce(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")), F.lit("unknown"))
    return df.groupBy(v.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def score_overview(df: DataFrame, columns: list[str], low: float = 0.0, high: float = 1.0, n_bins: int = 12) -> DataFrame:
    """(score, valid, missing, mean, min, max) and counts of equal bins, for each column, in one pass."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("score"), F.col(c).try_cast("double").alias("v")) for c in columns])).alias("x")).select("x.score", "x.v")
    v = F.when(~F.isnan("v"), F.col("v"))
    place = F.least(F.floor((v - low) / ((high - low) / n_bins)), F.lit(n_bins - 1))
    counts = [F.count_if(place == i).alias(f"bin_{i}") for i in range(n_bins)]
    return long.groupBy("score").agg(F.count(v).alias("valid"), F.count_if(v.isNull()).alias("missing"), F.round(F.avg(v), 6).alias("mean"), F.round(F.min(v), 6).alias("min"), F.round(F.max(v), 6).alias("max"), *counts)


def group_rollup(df: DataFrame, group: str, id_col: str, source: str) -> DataFrame:
    """(group, size, sources, first id, cross) of groups of two and more."""
    return (
        df.groupBy(group).agg(F.count("*").alias("size"), F.count_distinct(F.nullif(F.col(source), F.lit(""))).alias("sources"), F.min(id_col).alias("first_id"))
        .where("size > 1").withColumn("cross_source", (F.col("sources") > 1).cast("int"))
    )


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    """(size, groups, members)."""
    return df.groupBy(group).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("groups"), F.sum("size").alias("members"))


def resolution_profile(df: DataFrame, width: str, height: str, frames: str) -> DataFrame:
    """Counts by resolution, by frame bucket and by both, from one scan with grouping sets. level: 1 resolution, 2 frames, 0 both."""
    size = F.concat_ws("x", F.col(width), F.col(height))
    rows = df.select(size.alias("resolution"), F.col(frames).alias("frames"))
    return rows.groupingSets([[F.col("resolution")], [F.col("frames")], [F.col("resolution"), F.col("frames")]], F.col("resolution"), F.col("frames")).agg(F.count("*").alias("n"), F.grouping_id("resolution", "frames").cast("int").alias("level"))


def short_side_bucket(side: Column) -> Column:
    return F.when(side.isNull(), "unknown").when(side < 360, "<360").when(side < 480, "360-479").when(side < 720, "480-719").when(side < 1080, "720-1079").otherwise(">=1080")


def rate(flag: Column) -> Column:
    """Share of rows whose flag is 1; null counts as 0."""
    return F.round(F.count_if(flag.eqNullSafe(F.lit(1))) / F.count(F.lit(1)), 6)


def motion_summary(df: DataFrame, key: str, motion: str, cut: str, threshold: float) -> DataFrame:
    return df.groupBy(key).agg(F.round(F.avg(motion), 6).alias("motion_mean"), F.max(cut).alias("cut_max"), F.round(F.avg((F.col(cut) >= threshold).cast("int")), 6).alias("cut_ratio"))


def weighted_mean(df: DataFrame, value: str, weight: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(F.sum(F.col(value) * F.col(weight)) / F.sum(weight), 6).alias("mean"))


def run_stats(df: DataFrame, prefix: str, examples: int = 1000) -> tuple[DataFrame, DataFrame]:
    """One row of counts, and some failed rows (a bounded report)."""
    ok = F.col(f"{prefix}_ok")
    return df.agg(F.count("*").alias("output"), F.count_if(ok == 1).alias("ok"), F.count_if(~ok.eqNullSafe(F.lit(1))).alias("failed")), df.where(~ok.eqNullSafe(F.lit(1))).limit(examples)


def consecutive_rollup(df: DataFrame, order: list[str], key: str, partition: str, ok: Column, error: Column) -> DataFrame:
    """Per run of equal keys: rows, ok, failed, first error that is not blank."""
    from .timeline import islands

    rows = islands(df, order, key, partition)
    return rows.groupBy(partition, "island", key).agg(
        F.count("*").alias("n"), F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"),
        F.min_by(F.when(F.coalesce(error, F.lit("")) != "", error), F.when(F.coalesce(error, F.lit("")) != "", F.struct(*order))).alias("first_error"),
    )


def page(df: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """One page of rows in a stable order."""
    return df.orderBy(*order).offset(number * size).limit(size)


def browse_order(id_col: str, seed: int) -> Column:
    """A repeatable shuffled order of ids, another one for each seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def top_windowed(df: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def quantile_scores(df: DataFrame, key: str, value: str, q: float) -> DataFrame:
    """(key, score, median, mean, frame_count): the score is the exact, interpolated quantile over a key's frames; all to six places."""
    exact = lambda p: F.round(F.expr(f"percentile(`{value}`, {p}D)"), 6)
    return df.groupBy(key).agg(exact(q).alias("score"), exact(0.5).alias("median"), F.round(F.avg(value), 6).alias("mean"), F.count("*").alias("frame_count"))


def unique_totals(df: DataFrame, group: str, size: str) -> DataFrame:
    """One row: groups, clips and the sum of sizes; negative and NaN sizes count nothing."""
    s = F.when(F.isnan(F.col(size).cast("double")) | (F.col(size) < 0), 0).otherwise(F.col(size))
    return df.agg(F.count_distinct(group).alias("groups"), F.count("*").alias("clips"), F.coalesce(F.sum(s), F.lit(0)).alias("total"))


def match_summary(pairs: DataFrame, groups: DataFrame, method: str) -> DataFrame:
    """(method, pair_count, group_count, matched_count), and a row `all` with the sums: pairs (method, a, b), groups (method, node, component)."""
    p = pairs.groupBy(method).agg(F.count("*").alias("pair_count"))
    g = groups.groupBy(method).agg(F.count_distinct("component").alias("group_count"), F.count_distinct("node").alias("matched_count"))
    counts = ["pair_count", "group_count", "matched_count"]
    each = p.join(g, method, "full").select(method, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])
    return each.union(each.agg(F.lit("all"), *[F.sum(c) for c in counts]))


def group_members(df: DataFrame, group: str, id_col: str, source: str, best: str, k: int) -> DataFrame:
    """(group, size, sources, best_id, members): the first k members, best first, then by id. Groups of blank ids are left out."""
    w = Window.partitionBy(group).orderBy(F.desc(best), F.col(id_col))
    rows = df.where(F.coalesce(F.trim(F.col(group).cast("string")), F.lit("")) != "")
    first = rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k)
    listed = first.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("__rn", id_col))), lambda x: x[id_col]).alias("members"))
    sizes = rows.groupBy(group).agg(F.count("*").alias("size"), F.count_distinct(F.nullif(F.trim(F.col(source).cast("string")), F.lit(""))).alias("sources"), F.min(F.when(F.col(best) == 1, F.col(id_col))).alias("best_id"))
    return sizes.join(listed, group).select(group, "size", "sources", "best_id", "members")


def rate_text(fps: Column) -> Column:
    """A frame rate to two places without trailing zeros; `unknown` for a blank, null or NaN one."""
    r = F.round(fps.try_cast("double"), 2)
    text = F.regexp_replace(F.regexp_replace(F.format_string("%.2f", r), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(r.isNull() | F.isnan(r), "unknown").otherwise(text)
