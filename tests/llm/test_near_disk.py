"""Disk of near dedup: what is shuffled follows the rows, not the pairs of rows that share something by chance."""

import random

import numpy as np
from pyspark.sql import functions as F

from siftwell.llm import nearcopies, simhash


def long_texts(n, words, seed):
    """Unrelated texts of so many words that share one passage, and of each a near copy, of a likeness just over 0.8."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(12)]
    out = []
    for i in range(n):
        own = passage + [f"w{rng.randrange(10**7)}" for _ in range(words - 12)]
        near = list(own)
        for k in range(12 + i % 2, words - 5, 48):  # five shingles of each 48
            near[k] = f"x{i}y{k}"
        out += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(near))]
    return out


def test_unrelated_long_texts_with_a_shared_passage_are_not_compared_by_members(spark):
    for words in (900, 2500):
        cases = long_texts(40, words, words)
        sets = nearcopies.shingle_sets(spark.createDataFrame(cases, "doc_id long, text string")).cache()
        of = lambda side: lambda name: F.col(f"{side}.{name}")
        facts = nearcopies.facts_of(sets)
        pairs = facts.alias("x").join(facts.alias("y"), (F.col("x.fp") < F.col("y.fp")) & nearcopies.within_reach(of("x"), of("y"), 0.8))
        got = {frozenset(r) for r in pairs.select("x.fp", "y.fp").collect()}
        name = {i: nearcopies.vertex(nearcopies.shingles(t.encode())) for i, t in cases}
        want = {frozenset((name[2 * i], name[2 * i + 1])) for i in range(40)}
        like = [len(a & b) / len(a | b) for a, b in ((set(nearcopies.shingles(cases[2 * i][1].encode()).tolist()), set(nearcopies.shingles(cases[2 * i + 1][1].encode()).tolist())) for i in range(40))]
        assert 0.8 <= min(like) <= max(like) < 0.85
        assert got == want
        sets.unpersist()


def test_near_copies_of_sizes_on_both_sides_of_the_bound_link(spark):
    """A text and its beginning: one may be held by a bit map, the other by SimHash words, alone."""
    cases, n = [], 0
    for words in [*range(660, 900, 16), 960, 1100]:
        rng = random.Random(words)
        own = [f"w{rng.randrange(10**7)}" for _ in range(words)]
        cases += [(n, " ".join(own)), (n + 1, " ".join(own[: int(0.81 * words)])), (n + 2, " ".join(own[: int(0.7 * words)]))]
        n += 3
    df = spark.createDataFrame(cases, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in nearcopies.near_copies(df).collect()}
    assert got == {i: i - i % 3 for i, _ in cases}  # the third hangs on the second


def written(spark):
    """Shuffle bytes of all stages so far."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_runs_are_shuffled_once_for_each_block_and_not_for_each_pair(spark):
    n, asked = 20_000, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    codes = np.unique(np.random.default_rng(3).integers(-(1 << 63), 1 << 63, n, np.int64))
    fps, usual = spark.createDataFrame([(c,) for c in codes.tolist()], "fp long").repartition(4).localCheckpoint(), {k: spark.conf.get(k) for k in asked}
    for k, v in asked.items():
        spark.conf.set(k, v)
    try:
        before = written(spark)
        simhash.fingerprint_edges(fps, 12, 64).count()  # at 12 bits hardly any pair of runs is pruned: 49,000 are left
        moved = written(spark) - before
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)
    assert moved < 250 * n, moved  # bytes; a run of 512 bytes for each pair makes 25 million, before compression
