"""Duplicate groups: connected components of pair links, numbered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import durable


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), component the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al. 2014) until all is stars: every node hangs below one
    other, which hangs below none. Every step is a min-aggregation with map-side combine and an equi-join that adaptive
    execution can split, so a hub needs no task of its own. Each round is checkpointed; the number of rounds is about the
    logarithm of a component's size, and edges that are stars already need none. Self pairs, repeated and reversed
    pairs are fine; nodes without an edge to another node are not returned; null ends are ignored.
    """
    now = durable(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    for _ in range(max_rounds):
        ends = now.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(now.select("b", F.lit(0), F.lit(1)))
        ends = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 or (up > 0 and down > 0)").isEmpty():
            break
        both = now.union(now.select("b", "a"))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.min("a")).alias("m"))
        # large star: every larger neighbour of n hangs below n's smallest neighbour
        large = (
            both.where("b > a").join(least, F.col("a") == F.col("n"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        # small star: n and all its smaller neighbours hang below the smallest of them
        lower = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(lower, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(lower.select(F.col("n").alias("a"), F.col("m").alias("b")))
        now = durable(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def components(pairs: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, nodes: DataFrame | None = None) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link to another one.

    With `nodes` (a column node), an end of a link that is none of them is an error.
    """
    edges = pairs.select(F.col(a).alias("a"), F.col(b).alias("b"))
    if nodes is not None:
        ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).where("node is not null")
        if unknown := ends.join(nodes.select("node"), "node", "left_anti").limit(1).collect():
            raise ValueError(f"unknown node {unknown[0][0]}")
    return connected(edges, max_rounds)


def numbered_groups(labels: DataFrame, prefix: str) -> DataFrame:
    """(component, group_id): groups numbered in the order of their smallest member, without one task for all.

    Groups are sorted by range; a partition's first number comes from the sizes of those before it.
    """
    groups = labels.select("component").distinct()
    ranged = durable(groups.repartitionByRange("component").sortWithinPartitions("component").withColumn("__p", F.spark_partition_id()))
    sizes = {r["__p"]: r["n"] for r in ranged.groupBy("__p").agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for p in sorted(sizes):
        before[p], total = total, total + sizes[p]
    if not total:
        return groups.withColumn("group_id", F.lit(""))
    at = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[F.col("__p")]
    rank = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1  # ranges are sorted
    return ranged.select("component", F.format_string(f"{prefix}-%06d", (at + rank).cast("long")).alias("group_id"))
