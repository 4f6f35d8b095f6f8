"""Selection: rules first, then the best share of each duplicate group."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rules import Rule, check


@dataclass(frozen=True)
class GroupKeep:
    """Keep the best ceil(n * keep_ratio) rows of each group, min_keep at least, max_keep at most."""

    name: str
    group: str
    keep_ratio: float
    min_keep: int = 1
    max_keep: int | None = None
    reject_reason: str = "duplicate"

    def __post_init__(self) -> None:
        if not 0 < self.keep_ratio <= 1 or self.min_keep < 1 or self.max_keep is not None and self.max_keep < self.min_keep:
            raise ValueError(f"bad bounds for {self.name}")


def _blank(group: Column) -> Column:
    return F.coalesce(group.cast("string"), F.lit("")) == ""


def keep_count(n: Column, method: GroupKeep) -> Column:
    wanted = F.greatest(F.lit(method.min_keep).cast("long"), F.ceil(n * F.lit(method.keep_ratio)).cast("long"))
    return F.least(n, wanted, F.lit(method.max_keep).cast("long")) if method.max_keep is not None else F.least(n, wanted)


def ratio_top_n(df: DataFrame, method: GroupKeep, score: str, id_col: str, alive: Column) -> Column:
    """Whether a living row is kept: by place in its group, best score first, ties by id. A blank group is a group of one."""
    group = F.when(alive & ~_blank(F.col(method.group)), F.col(method.group).cast("string"))
    # rows that are out or have no group are spread over their ids: no window holds them all
    key = [group, F.when(group.isNull(), F.col(id_col))]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(score), F.col(id_col)))
    n = F.count(F.lit(1)).over(Window.partitionBy(*key))
    return F.when(group.isNull(), alive).otherwise(place <= keep_count(n, method))


def select(df: DataFrame, rules: list[Rule], methods: list[GroupKeep], score: str, id_col: str) -> DataFrame:
    """df with select_pass (1 or 0) and select_reject_reason.

    A row that fails rules has all their reasons; one that passes has the reason of the first method that
    drops it. Methods apply in order, each to what the one before kept, so group sizes are of survivors.
    """
    out = check(df, rules, "filter").withColumn("__alive", F.col("filter_pass") == 1).withColumn("__why", F.col("filter_reject_reason"))
    for m in methods:
        out = out.withColumn("__kept", ratio_top_n(out, m, score, id_col, F.col("__alive")))
        out = out.withColumn("__why", F.when(F.col("__alive") & ~F.col("__kept"), F.lit(m.reject_reason)).otherwise(F.col("__why")))
        out = out.withColumn("__alive", F.col("__alive") & F.col("__kept"))
    out = out.withColumn("select_pass", F.col("__alive").cast("long")).withColumn("select_reject_reason", F.col("__why"))
    return out.drop("__alive", "__why", "__kept", "filter_pass", "filter_reject_reason")


# The rules of selection, and how much of each duplicate group stays.
SELECT_RULES = [
    Rule("filter_ok", "filter_ok", equals=1, reject_reason="filter_failed"),
    Rule("optical", "optical_score", min=0.9, reject_reason="low_optical"),
    Rule("motion", "motion_score", min=0.2, reject_reason="low_motion"),
    Rule("aesthetic", "aesthetic_score", min=0.55, reject_reason="low_aesthetic"),
    Rule("text", "text_score", min=0.5, reject_reason="high_text"),
    Rule("dedup_ok", "dedup_ok", equals=1, reject_reason="dedup_failed"),
]
SELECT_GROUPS = [
    GroupKeep("pdq", "pdq_group_id", 1.0, 1, 1, "pdq_duplicate"),
    GroupKeep("cosmos", "cosmos_group_id", 0.2, 1, 20, "cosmos_duplicate"),
]


def keep_membership(df: DataFrame, methods: list[GroupKeep], score: str, id_col: str, alive: Column) -> DataFrame:
    """df with <method>_keep for each method: whether the row is among those the method keeps of its group, each method by itself."""
    out = df.withColumn("__alive", alive)
    for m in methods:
        out = out.withColumn(f"{m.name}_keep", ratio_top_n(out, m, score, id_col, F.col("__alive")))
    return out.drop("__alive")


def scope(df: DataFrame, passed: str, which: str, reason: str | None = None, wanted: str | None = None) -> DataFrame:
    """Rows of a scope: all, keep (passed is 1) or reject (any other, null too); with a reason, only rows rejected for it."""
    keep = F.col(passed).try_cast("double").eqNullSafe(F.lit(1.0))
    out = df if which == "all" else df.where(keep if which == "keep" else ~keep)
    return out if wanted is None else out.where(F.coalesce(F.col(reason), F.lit("")) == wanted)


def distinct_reasons(df: DataFrame, reason: str) -> DataFrame:
    """The reasons there are, blank ones left out."""
    return df.where(F.coalesce(F.col(reason), F.lit("")) != "").select(reason).distinct()


def reject_counts(df: DataFrame, reason: str) -> DataFrame:
    """Rows by joined reason; passing rows (blank reason) are left out."""
    return df.where(F.coalesce(F.col(reason), F.lit("")) != "").groupBy(reason).agg(F.count("*").alias("n"))


def select_score(*scores: Column) -> Column:
    """Sum from left to right."""
    out = scores[0]
    for s in scores[1:]:
        out = out + s
    return out


def latest(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The last row of each key by the order, found by a map-side maximum. Nulls in the order come first, null keys are one key."""
    best = df.groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*df.columns), F.struct(*[F.struct(c.isNotNull(), c) for c in order])).alias("__row"))
    return best.select("__row.*")


def best_in_group(df: DataFrame, group: str, order: list[Column], id_col: str) -> DataFrame:
    """(group, best id, size): the first member by the order, found by a map-side minimum."""
    return df.groupBy(group).agg(F.min_by(F.col(id_col), F.struct(*order, F.col(id_col))).alias("best_id"), F.count("*").alias("size"))


def select_summary(df: DataFrame, group: str, passed: str) -> DataFrame:
    """One row: candidates, groups, singletons, kept, rejected."""
    sizes = df.groupBy(group).agg(F.count("*").alias("n"), F.sum(F.col(passed)).alias("kept"))
    return sizes.agg(
        F.sum("n").alias("candidates"), F.count_if(F.col("n") > 1).alias("groups"), F.count_if(F.col("n") == 1).alias("singletons"),
        F.sum("kept").cast("long").alias("kept"), (F.sum("n") - F.sum("kept")).cast("long").alias("rejected"),
    )
