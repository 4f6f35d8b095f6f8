"""Pruned cosine joins, code joins with crowded parts, and exact rounding, against brute force."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.functions import scales
from siftwell.operators import dedup, labels, similarity, vectors

rng = np.random.default_rng(5)


def clusters(size, groups, d=24, noise=0.06):
    """Vectors in tight clusters around few directions."""
    middle = rng.normal(size=(groups, d))
    x = middle[rng.integers(0, groups, size)]
    return x + noise * np.linalg.norm(x, axis=1, keepdims=True) / math.sqrt(d) * rng.normal(size=x.shape)


def frame(spark, x, name=int):
    kind = "string" if name is str else "long"
    return spark.createDataFrame([(name(i), [float(c) for c in v]) for i, v in enumerate(x)], f"vec_id {kind}, embedding array<double>")


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("name", [int, str])
def test_pairs_within_clusters(spark, name):
    x = clusters(600, 20)
    x[7] = x[11] = x[12]
    least = 0.98
    got = {(r.a, r.b): r.cosine for r in vectors.pairs_within(frame(spark, x, name), least, pivots=24, block=16).collect()}
    s = unit(x) @ unit(x).T
    want = {tuple(sorted((name(i), name(j)))): s[i, j] for i, j in zip(*np.nonzero(np.triu(s >= least, 1)))}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_most_block_pairs_are_dropped_unseen(spark):
    blocks = vectors.vector_blocks(frame(spark, clusters(1500, 24, d=48, noise=0.02)), pivots=24, block=32)
    assert vectors.dropped_share(blocks, 0.95) > 0.9
    n = blocks.count()
    assert vectors.block_pairs(blocks).count() == n * (n + 1) // 2  # each pair of blocks is judged once
    # a vector is shipped once for each block that its own meets, not once for each block
    shipped = vectors.block_pairs(blocks).where(F.col("apart") <= math.acos(0.95)).count()
    assert shipped < 4 * n
    assert sum(r.n for r in blocks.select("n").collect()) == 1500


def test_nearest_against_all_pairs(spark):
    x = np.concatenate([clusters(300, 10), rng.normal(size=(60, 24))])
    x[3] = x[4] = x[5] = x[6]  # ties go to the smaller id
    s = np.round(unit(x) @ unit(x).T, 9)
    np.fill_diagonal(s, -2)
    for k, least in ((4, -1.0), (6, 0.9)):
        want = set()
        for i in range(len(x)):
            order = np.lexsort((np.arange(len(x)), -s[i]))[:k]
            want |= {(i, r + 1, int(j)) for r, j in enumerate(order) if s[i, j] >= least}
        got = {(r.id, r.rank, r.neighbour) for r in vectors.nearest(frame(spark, x), k, least=least, pivots=12, block=16).collect()}
        assert got == want


def test_vectors_of_no_use(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, None), (None, [1.0, 0.0]), (3, [1.0, None]), (4, [math.nan, 1.0]), (5, []), (6, [1.0, 0.0]), (7, [2.0, 0.0]), (7, [3.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted((r.a, r.b) for r in similarity.cosine_pairs(df, 0.5).collect()) == [(6, 7), (6, 7)]
    assert sorted((r.id, r.neighbour) for r in similarity.cosine_top_k(df, 1).collect()) == [(6, 7), (7, 6)]
    assert similarity.cosine_pairs(df.limit(0), 0.5).count() == similarity.cosine_top_k(df.limit(0), 3).count() == 0
    with pytest.raises(ValueError):
        similarity.cosine_pairs(df, 0.0)


def signed(v):
    return v - (1 << 64) if v >= 1 << 63 else v


def codes_of(bits, size, seed, shared=None):
    """Random codes and some near them; a third has the same bits `shared` below."""
    r = random.Random(seed)
    out = [r.getrandbits(bits) for _ in range(size)]
    out += [c ^ sum(1 << b for b in r.sample(range(bits), r.randint(0, 12))) for c in out[: size // 2]]
    if shared:
        low = (1 << shared) - 1
        out = [c & ~low | (5 & low) if i % 3 == 0 else c for i, c in enumerate(out)]
    return out


@pytest.mark.parametrize("bits, most, crowd, parts", [(64, 3, 10**6, None), (64, 3, 8, 4), (63, 9, 5, 6), (256, 12, 10, 8), (256, 31, 20, 16), (64, 10, 3, 1), (40, 4, 2, 5)])
def test_near_codes_with_crowded_parts(spark, bits, most, crowd, parts):
    words = -(-bits // 64)
    values = sorted(set(codes_of(bits, 60, bits + most, shared=16)))
    split = lambda c: [signed((c >> (64 * w)) & ((1 << 64) - 1)) for w in range(words)]
    if parts == 1:
        parts = None
    df = spark.createDataFrame([(split(c),) for c in values] + [(None,), (split(values[0]),)], "code array<long>")
    got = [(tuple(r.x), tuple(r.y), r.distance) for r in similarity.near_codes(df, most, words, bits, crowd=crowd, parts=parts).collect()]
    want = {(tuple(split(a)), tuple(split(b)), (a ^ b).bit_count()) for a in values for b in values if a != b and (a ^ b).bit_count() <= most}
    assert len(got) == len(set(got)) and set(got) == want and want  # each pair once


def test_radii_leave_no_pair_out():
    for most in range(40):
        for parts in range(1, most + 2):
            r = similarity.radii(most, parts)
            # the largest total at which every part is beyond its radius is above most
            assert sum(x + 1 for x in r) == most + 1 and min(r) >= -1
    assert similarity.part_count(64, 3, 10**3) > similarity.part_count(64, 3, 10**9)  # fewer, wider parts for more codes


def test_hamming_pairs_of_copies(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 4), (4, -1), (None, 5), (5, None), (6, -1)], "id long, code long")
    assert sorted(tuple(r) for r in similarity.hamming_pairs(df, 1).collect()) == [(1, 2, 0), (1, 3, 1), (2, 3, 1), (4, 6, 0)]


def test_exact_round_is_that_of_python(spark):
    r = random.Random(1)
    xs = [r.randint(0, 10**8) / 2 ** r.randint(0, 30) for _ in range(3000)] + [r.randint(-(10**9), 10**9) / 10 ** r.randint(0, 8) for _ in range(3000)]
    xs += [(r.randint(0, 10**6) + 0.5) / 10 ** r.choice([2, 6]) for _ in range(3000)] + [0.0, -0.5, 0.5, 1.5, 2.5, 1e300, math.inf, 5e-324]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for digits in (0, 1, 2, 6):
        assert all(v.y == round(v.x, digits) for v in df.select("x", scales.exact_round(F.col("x"), digits).alias("y")).collect())
    odd = spark.createDataFrame([(None,), (math.nan,)], "x double").select(scales.exact_round(F.col("x"), 2).alias("y")).collect()
    assert odd[0].y is None and math.isnan(odd[1].y)


def test_interpolated_quantiles(spark):
    for values in ([], [3.0], [1.0, 2.0, 4.0], [0.1, 0.7, 0.2, 0.2, 0.9, 1.5, 0.3]):
        for q in (0.0, 0.2, 0.5, 0.77, 1.0):
            got = spark.createDataFrame([(values,)], "v array<double>").select(scales.interpolated(F.col("v"), q).alias("x")).first().x
            assert got is None if not values else abs(got - np.percentile(values, 100 * q)) < 1e-12


def test_two_phases_with_parts_that_are_kept(spark, tmp_path):
    x = clusters(120, 40)
    codes = [[int(v > 0) << 1 | int(v < -0.3) for v in row[:4]] for row in x]
    rows = spark.createDataFrame(
        [(f"c{i:03d}", int(i != 5), "" if i != 5 else "unreadable", [float(c) for c in v], [c, c] if i % 30 else [], 1.0 * (i % 7), i % 4) for i, (v, c) in enumerate(zip(x, codes))],
        "id string, ok int, error string, vector array<double>, codes array<array<long>>, quality double, n int",
    )
    made = []

    class Counted(dedup.VectorDeduplicator):
        def pairs(self, spark, path, part, parts):
            made.append(part)
            if len(made) == 2:
                raise RuntimeError("executor lost")
            return super().pairs(spark, path, part, parts)

    methods = [Counted("cosmos", least=0.99, k=200, pivots=12, block=16), dedup.CodeDeduplicator("pdq", most=0, least_ratio=1.0)]
    path = str(tmp_path / "dedup")
    with pytest.raises(RuntimeError):
        dedup.dedup_rows(rows, methods, path, parts=3)
    out = {r.id: r for r in dedup.dedup_rows(rows, methods, path, parts=3).collect()}
    assert made == [0, 1, 1, 2]  # the part that was done is not done again
    s = unit(x) @ unit(x).T

    def groups(linked):
        root = list(range(120))
        for _ in range(120):
            new = [min(root[j] for j in range(120) if j == i or linked(i, j)) for i in range(120)]
            if new == root:
                break
            root = new
        return root

    fine = [i != 5 for i in range(120)]
    for name, linked, order in (
        ("cosmos", lambda i, j: fine[i] and fine[j] and s[i, j] >= 0.99, lambda i: (-(i % 4), i)),
        ("pdq", lambda i, j: fine[i] and fine[j] and i % 30 and j % 30 and codes[i] == codes[j], lambda i: (-(i % 7), i)),
    ):
        root = groups(linked)
        numbers = {r: k + 1 for k, r in enumerate(sorted(r for r in set(root) if root.count(r) > 1))}
        for i in range(120):
            r, members = out[f"c{i:03d}"], [j for j in range(120) if root[j] == root[i]]
            best = min(members, key=order)
            alone = len(members) == 1
            want = ("", 1, 1, "") if alone else (f"{name}-{numbers[root[i]]:06d}", len(members), int(best == i), f"c{best:03d}")
            assert tuple(r[f"{name}_{k}"] for k in ("group_id", "group_size", "is_best_clip_in_group", "best_clip_id_in_group")) == want
            assert r[f"{name}_ok"] == int(fine[i])
    assert out["c005"].dedup_error == "cosmos: unreadable; pdq: unreadable" and out["c005"].dedup_ok == 0 and out["c001"].dedup_ok == 1
    assert json.loads(out["c001"].dedup_json).keys() == {"cosmos", "pdq"}
    with pytest.raises(ValueError):
        dedup.dedup_rows(rows, [methods[0], methods[0]], path)


def test_near_codes_of_fixed_bits_and_wide_radii(spark):
    """F2 to F5: bits that all codes share are in no part, and a radius of a quarter of the bits goes by blocks; either way each pair comes once."""
    r = random.Random(5)
    values = [[r.getrandbits(31) for _ in range(4)] for _ in range(40)]
    values += [[w ^ 1 << r.randrange(31) for w in v] for v in values for _ in range(2)]
    df = spark.createDataFrame([(v,) for v in values], "code array<long>")
    far = lambda x, y: sum((p ^ q).bit_count() for p, q in zip(x, y))
    want = {(tuple(x), tuple(y), far(x, y)) for x in values for y in values if x != y and far(x, y) <= 31}
    assert want
    for parts in (None, 16):
        plan = similarity.near_codes(df, 31, parts=parts)
        got = [(tuple(x.x), tuple(x.y), x.distance) for x in plan.collect()]
        assert len(got) == len(set(got)) and set(got) == want
        half = [(frozenset([tuple(x.x), tuple(x.y)]), x.distance) for x in similarity.near_codes(df, 31, parts=parts, once=True).collect()]
        assert len(half) * 2 == len(want) and set(half) == {(frozenset([x, y]), d) for x, y, d in want}
    # no part of bits that are the same in all codes, so no value that all codes share
    assert len(similarity.near_codes(df, 31)._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_meetings_of_blocks_shuffle_no_vectors(spark):
    """F6 to F14: what a join of blocks ships does not grow with the pairs of blocks, and a task keeps but the best neighbours of a row."""
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 8))
    x[200:] = x[:100]  # copies, so ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = np.round(u @ u.T, 9)
    pairs = vectors.pairs_within(df, 0.5, block=16)
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert {(p.a, p.b) for p in pairs.collect()} == {(i, j) for i in range(300) for j in range(i + 1, 300) if u[i] @ u[j] >= 0.5}
    held, vectors.HELD = vectors.HELD, 500
    try:
        got = {(p.id, p.rank): p.neighbour for p in vectors.nearest(df, 4, block=16).collect()}
    finally:
        vectors.HELD = held
    want = {(i, k + 1): j for i in range(300) for k, j in enumerate(sorted((j for j in range(300) if j != i), key=lambda j: (-c[i, j], j))[:4])}
    assert got == want


def test_label_texts_are_parsed_once(spark):
    """F1, F15, F16: errors and labels of all fields come from one reading of the text."""
    df = spark.createDataFrame([('{"k": "a", "m": ["x", "x"]}',), ('{"k": "b", "m": ["x"]}',), ("[1]",), (None,)], "t string")
    schema = labels.LabelSchema(single={"k": ["a"]}, multi={"m": ["x", "y"]})
    out = df.select(schema.checked(F.col("t")).alias("c")).select("c.error", "c.labels.k", "c.labels.m")
    assert [(r.error, r.k, r.m) for r in out.collect()] == [(None, "a", ["x"]), ("bad k", "unknown", ["unknown"]), ("not an object", "unknown", ["unknown"]), ("not an object", "unknown", ["unknown"])]
    for c in (labels.CAMERA_OUTPUT.error(F.col("t")), labels.CAMERA_OUTPUT.parse(F.col("t"))):
        assert df.select(c.alias("c"))._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 1
