"""Embedding near-duplicates through the flat graph, against all pairs."""

import math

import numpy as np
import pytest

from siftwell.llm import flatgraph, queries

KIND = "vec_id long, embedding array<double>, label int, v string, u int, cell int, id int, c int"


def by_hand(rows, least=0.93):
    """(vec_id, n_links, component_id) of rows (vec_id, vector, label), every pair compared."""
    fine = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) and l is not None for _, v, l in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None for ok, (_, v, _) in zip(fine, rows)]
    n, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    groups = {}
    for i, ok in enumerate(fine):
        if ok:
            groups.setdefault((rows[i][2], len(unit[i])), []).append(i)
    for g in groups.values():
        s = np.stack([unit[i] for i in g])
        for a, b in zip(*np.nonzero(np.triu(s @ s.T >= least, 1))):
            a, b = g[a], g[b]
            n[a] += 1
            n[b] += 1
            root[top(a)] = top(b)
    ids = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            ids[top(i)] = min(v, ids.get(top(i), v))
    return [(v, k, ids.get(top(i))) for i, ((v, _, _), k) in enumerate(zip(rows, n))]


def cloud(seed, size, groups, copies, d=32, noise=0.03):
    """Vectors of which some stand in groups of near copies."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(size, d))
    for g in range(groups):
        at = rng.choice(size, copies, replace=False)
        x[at] = x[at[0]] + noise * np.linalg.norm(x[at[0]]) / math.sqrt(d) * rng.normal(size=(copies, d)) * 3
    return x


def found(spark, rows, **more):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, "x", 1, 2, 3, 4) for i, v, l in rows], KIND)
    out = flatgraph.near_embeddings(df, **more).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str)


@pytest.mark.parametrize("shard", [30, 1000])
def test_near_embeddings_against_all_pairs(spark, shard):
    rows = [(7 * i % 1000, v, i % 3) for i, v in enumerate(cloud(1, 500, 8, 9))]
    true, got = sorted(by_hand(rows), key=str), found(spark, rows, shard=shard)
    assert [r[0] for r in got] == [r[0] for r in true]
    assert all(a[1] <= b[1] for a, b in zip(got, true))  # never a link too many
    if shard == 1000:
        assert got == true
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in true) > 0


def test_a_dense_group_beyond_a_shard(spark):
    """A third of the vectors near each other: their cell cannot be dealt, its blocks are searched by all of it."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(360, 32))
    x[:140] = x[0] + 0.05 * rng.normal(size=(140, 32))
    rows = [(i, v, 0) for i, v in enumerate(x)]
    assert found(spark, rows, shard=24) == sorted(by_hand(rows), key=str)


def test_vertices_of_fewer_cells_than_others(spark):
    """Groups within one cell count their links beside vertices of several cells, at the first search."""
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(cloud(5, 600, 12, 20))], "vec_id long, embedding array<double>, label int")
    v = flatgraph.unit_vectors(df).selectExpr("id as v", "u", "1L as c", "'0' as cell")
    links = flatgraph.vertex_links(v, 0.93, shard=60).groupBy("v").agg({"n": "sum"}).toDF("v", "n")
    assert flatgraph.audit(v, links, 0.93, size=600) >= 0.99


def test_odd_vectors(spark):
    a, b = [1.0, 0.0, 0.0], [0.99, 0.1, 0.0]
    rows = [
        (5, a, 1), (3, a, 1), (3, a, 1), (4, b, 1), (None, a, 1), (6, [2.0, 0.0, 0.0], 1), (7, a, 2), (8, a, None), (9, None, 1), (10, [], 1), (11, [0.0, 0.0, 0.0], 1),
        (12, [1.0, None, 0.0], 1), (13, [math.nan, 1.0, 0.0], 1), (14, [math.inf, 1.0, 0.0], 1), (15, [1.0, 0.0], 1), (None, [0.0, 1.0, 0.0], 3), (16, [-1.0, 0.0, 0.0], 1),
        (17, [1e200, 1e199, 0.0], 1), (18, [1e-200, 0.0, 0.0], 1),
    ]
    true = by_hand([(i, None if v is None else [x / 1e200 if x and x > 1e100 and math.isfinite(x) else x * 1e200 if x and 0 < x < 1e-100 else x for x in v], l) for i, v, l in rows])
    assert found(spark, rows) == sorted(true, key=str)
    assert found(spark, []) == []


def test_pruning_keeps_what_is_not_stood_for():
    x = np.array([[1, 0], [0.995, 0.0999], [0.98, 0.199], [0, 1]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    apart = np.sqrt(np.maximum(0, 2 - 2 * x @ x.T))
    assert flatgraph.pruned(np.array([[1, 2, 3]]), apart, 3).tolist() == [[1, 3, -1]]  # 1 stands before 2, not before 3
    assert flatgraph.pruned(np.array([[-1, 3, 2]]), apart, 1).tolist() == [[3]]


def test_every_row_is_reached_and_found():
    x = cloud(3, 700, 5, 40)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links, medoid = flatgraph.shard_graph(x)
    seen, wave = {medoid}, {medoid}
    while wave:
        wave = {int(j) for i in wave for j in links[i] if j >= 0} - seen
        seen |= wave
    assert len(seen) == len(x) and links.shape[1] <= 2 * flatgraph.DEGREE + 8
    q, to = flatgraph.range_search(x, links, x, np.full((len(x), 1), medoid), 0.93)  # from the medoid alone
    true = (x @ x.T >= 0.93).sum()
    assert len(q) >= 0.9 * true and (np.einsum("pd,pd->p", x[q], x[to]) >= 0.93).all()


def test_query_and_audit(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = [tuple(r)[:3] for r in queries.op13_flatgraph(spark, sf).collect()]
    assert sorted(got) == sorted(by_hand(rows))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(cloud(4, 300, 6, 10))], "vec_id long, embedding array<double>, label int")
    v = flatgraph.unit_vectors(df).selectExpr("id as v", "u", "1L as c", "'0' as cell")
    links = flatgraph.vertex_links(v, 0.93).groupBy("v").agg({"n": "sum"}).toDF("v", "n")
    assert flatgraph.audit(v, links, 0.93) == 1 and flatgraph.audit(v, links.limit(0), 0.93) == 0
    assert flatgraph.audit(v.limit(0), links, 0.93) == 1
