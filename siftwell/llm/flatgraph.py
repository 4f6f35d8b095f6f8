"""Near-duplicate embeddings through a robust-pruned flat graph, built in shards.

Equal vectors of a label are one vertex. The vertices of a label are dealt to cells around pivots, a vertex near the
border of two cells to both, and large cells are dealt again until a cell is one shard. A task builds the graph of a
shard: each vertex is linked to near ones and a few far ones, less those that another one of them stands before (robust pruning). A
vertex's lists from all its shards are united. Every vertex then searches the graph around its cells: a beam goes from the
shard's medoid towards it, and from what is in range the search expands along links until nothing new is in range. Pairs
found are verified in double precision. Recall is audited against brute force on a bounded sample.

A cell that cannot be dealt further, as its vertices are all near each other, is cut into blocks of a shard's size, and all of
its vertices search each block. Links are counted where they are found; what leaves a task is a row for each vertex.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected, in_arrow, released, stored
from .simhash import forest

#: Vertices of a shard, about; of a task that deals vertices to pivots; queries of a task that searches a block.
SHARD, DEALT, ASKED = 1000, 4096, 8192
#: Most cells that a cell is dealt to at once; how alike two of its pivots are at most; times that cells are dealt again.
FAN, APART, LEVELS = 64, 0.7, 6
#: A vertex goes to a second cell if it is at most so many radians further from that.
BORDER = 0.35
#: Links of a vertex, candidates for them (near, far), the stretch of robust pruning.
DEGREE, NEAR, FAR, STRETCH = 24, 64, 16, 1.2
#: Vertices of the beam, and how many are expanded at a time; how far below the range expansion still goes on; neighbours of a shard that are searched too.
BEAM, STEP, SLACK, CLOSE = 32, 4, 0.05, 0.8
#: Vertices of an audit, and the least recall.
AUDIT, RECALL = 500, 0.9


def unit_vectors(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(id, label, u): the vectors at length 1 as bytes of doubles; null for vectors that are null, empty, zero or hold null or non-finite components."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))

    def unit(x: np.ndarray) -> bytes | None:
        most = np.abs(x).max(initial=0)
        if not 0 < most < np.inf:  # nan is neither
            return None
        x = x / most
        return (x / np.sqrt(x @ x)).astype("<f8").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(2)
            flat, at = v.values, v.offsets.to_numpy()
            numbers, nulls = flat.to_numpy(zero_copy_only=False), flat.is_null().to_numpy(zero_copy_only=False)
            fine = v.is_valid().to_numpy(zero_copy_only=False)
            out = [unit(numbers[s:e]) if ok and not nulls[s:e].any() else None for s, e, ok in zip(at, at[1:], fine)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["id", "label", "u"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    return in_arrow(rows, run, f"id {kinds[0]}, label {kinds[1]}, u binary")


def matrix(column) -> np.ndarray:
    """Vectors of equal length as rows, from a column of their bytes."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), "<f8").reshape(len(parts), -1)


def _thinned(pivots):
    """Pivots of which no two are more alike than APART, in their order."""
    x = np.frombuffer(b"".join(pivots), "<f8").reshape(len(pivots), -1)
    alike = x @ x.T > APART
    keep: list[int] = []
    for i in range(len(x)):
        if not alike[i, keep].any():
            keep.append(i)
    return [pivots[i] for i in keep]


def cells(vertices: DataFrame, shard: int = SHARD, border: float = BORDER) -> DataFrame:
    """(v, u, cell, main): each vertex (v, u, cell: that of all it may be compared with) in one cell or more, one of them its main one."""
    placed, over = vertices.select("v", "u", "cell", F.lit(True).alias("main")), None
    for _ in range(LEVELS):
        sizes = placed.groupBy("cell").agg(F.count("*").alias("size")).where(F.col("size") > shard)
        crowded, _ = stored(sizes.withColumn("fan", F.least(F.lit(FAN), F.greatest(F.lit(4), F.ceil(4 * F.col("size") / shard)))))
        if crowded.isEmpty():
            break
        big = placed.join(crowded, "cell")
        # one vertex of each hash class, that of the smallest hash: as many as the fan, found by partial minima
        h = F.xxhash64("u", F.lit(7))
        picked = big.groupBy("cell", F.pmod(h, F.col("fan")).alias("k")).agg(F.min(F.struct(h.alias("h"), "u")).alias("p"), F.max("size").alias("size"))
        pivots = picked.groupBy("cell").agg(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["u"]).alias("pivots"), F.max("size").alias("size"))
        thin = F.udf(_thinned, "array<binary>")  # of one row a crowded cell
        pivots, _ = stored(pivots.withColumn("pivots", thin("pivots")))
        done = placed.join(crowded.select("cell"), "cell", "left_anti")
        # cells of one pivot are dense and cannot be dealt further
        dense = placed.join(pivots.where(F.size("pivots") == 1).select("cell"), "cell", "left_semi")
        over = dense if over is None else over.unionByName(dense)
        split = pivots.where(F.size("pivots") > 1)
        salts = F.ceil(F.col("size") / DEALT).cast("int")
        left = placed.join(split.select("cell", salts.alias("salts")), "cell").withColumn("salt", F.pmod(F.xxhash64("v"), F.col("salts")).cast("int")).drop("salts")
        right = split.select(F.col("cell").alias("pcell"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("psalt"), "pivots")

        def near(x: pa.Table, y: pa.Table) -> pa.Table:
            out: dict[str, list] = {"v": [], "u": [], "cell": [], "main": []}
            if x.num_rows and y.num_rows:
                u, p = matrix(x["u"]), np.frombuffer(b"".join(y["pivots"][0].as_py()), "<f8").reshape(len(y["pivots"][0]), -1)
                angle = np.arccos(np.clip(u @ p.T, -1, 1))
                two = np.argsort(angle, axis=1, kind="stable")[:, :2]
                first, second = (np.take_along_axis(angle, two[:, k : k + 1], 1)[:, 0] for k in (0, 1))
                more = np.flatnonzero(second <= first + border)
                at, to = np.concatenate([np.arange(len(u)), more]), np.concatenate([two[:, 0], two[more, 1]])
                name = x["cell"][0].as_py()
                main = x["main"].to_numpy(zero_copy_only=False)[at] & (np.arange(len(at)) < len(u))
                out = {"v": x["v"].take(at), "u": x["u"].take(at), "cell": pa.array([f"{name}/{k}" for k in to]), "main": main}
            return pa.table(out, schema=pa.schema([("v", pa.int64()), ("u", pa.binary()), ("cell", pa.string()), ("main", pa.bool_())]))

        dealt = left.groupBy("cell", "salt").cogroup(right.groupBy("pcell", "psalt")).applyInArrow(near, "v long, u binary, cell string, main boolean")
        # a vertex may come to one cell by two ways
        dealt = dealt.groupBy("v", "cell").agg(F.first("u").alias("u"), F.max("main").alias("main")).select("v", "u", "cell", "main")
        placed, _ = stored(done.select("v", "u", "cell", "main").unionByName(dealt))
        if over is not None:
            over, _ = stored(over.select("v", "u", "cell", "main"))
    return placed if over is None else placed.unionByName(over)


def pruned(cand: np.ndarray, apart: np.ndarray, degree: int) -> np.ndarray:
    """Robust pruning: of each row's candidates (-1: none), nearest first, those that no kept one stands before, `degree` at most; -1 behind them."""
    rows = np.arange(len(cand))
    alive = cand >= 0
    own = apart[rows[:, None], cand]
    out = np.full((len(cand), degree), -1, np.int64)
    for k in range(degree):
        at = alive.argmax(axis=1)
        has = alive[rows, at]
        if not has.any():
            break
        best = cand[rows, at]
        out[has, k] = best[has]
        alive[rows, at] = False
        alive &= ~((STRETCH * apart[best[:, None], cand] <= own) & has[:, None])
    return out


def shard_graph(x: np.ndarray) -> tuple[np.ndarray, int]:
    """Neighbours of each row of x (unit vectors; -1: none), and the medoid. Every row can be reached from the medoid."""
    n = len(x)
    medoid = int((x @ x.sum(axis=0)).argmax()) if n else 0
    if n < 2:
        return np.full((n, 1), -1, np.int64), medoid
    s = (x @ x.T).astype(np.float32)
    apart = np.sqrt(np.maximum(0, 2 - 2 * s))
    np.fill_diagonal(s, -np.inf)
    near = np.argpartition(-s, min(NEAR, n - 1) - 1, axis=1)[:, : min(NEAR, n - 1)]
    cand = np.concatenate([near, np.random.default_rng(n).integers(0, n, (n, FAR))], axis=1)
    cand = np.take_along_axis(cand, np.argsort(-np.take_along_axis(s, cand, 1), axis=1, kind="stable"), 1)
    cand[cand == np.arange(n)[:, None]] = -1
    links = pruned(cand, apart, DEGREE)
    # links back, pruned again where a vertex gets too many
    i, k = np.nonzero(links >= 0)
    pairs = np.unique(np.concatenate([i * n + links[i, k], links[i, k] * n + i]))
    lists = _padded(*np.divmod(pairs, n), n)
    if lists.shape[1] > 2 * DEGREE:
        score = np.where(lists >= 0, np.take_along_axis(s, np.maximum(lists, 0), 1), -np.inf)
        lists = np.take_along_axis(lists, np.argsort(-score, axis=1, kind="stable"), 1)
        lists = pruned(lists, apart, 2 * DEGREE)
    reached = np.zeros(n + 1, bool)
    reached[medoid] = reached[n] = True
    more: list[tuple[int, int]] = []
    wave = np.array([medoid])
    while True:
        while len(wave):
            to = np.unique(lists[wave])
            wave = to[(to >= 0) & ~reached[to]]
            reached[wave] = True
        left = np.flatnonzero(~reached[:n])
        if not len(left):
            break
        there = np.flatnonzero(reached[:n])
        best = np.unravel_index(s[np.ix_(there, left)].argmax(), (len(there), len(left)))
        more.append((int(there[best[0]]), int(left[best[1]])))
        wave = left[best[1] : best[1] + 1]
        reached[wave] = True
    if more:
        i, k = np.nonzero(lists >= 0)
        a, b = np.array(more).T
        lists = _padded(*np.divmod(np.unique(np.concatenate([i * n + lists[i, k], a * n + b])), n), n)
    return lists, medoid


def _padded(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Values of each of n rows side by side, -1 behind them; row is sorted."""
    sizes = np.bincount(row, minlength=n)
    out = np.full((n, max(1, sizes.max(initial=0))), -1, np.int64)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = value
    return out


def range_search(x: np.ndarray, links: np.ndarray, queries: np.ndarray, starts: np.ndarray, least: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(query, row of x) of the rows within `least` that a search of the graph from the starts (a row for each query) finds, verified in doubles."""
    n, m, d = len(x), len(queries), links.shape[1]
    x32, q32 = np.vstack([x, np.zeros((1, x.shape[1]))]).astype(np.float32), queries.astype(np.float32)
    links = np.vstack([np.where(links < 0, n, links), np.full((1, d), n)])  # row n is none
    rows = np.arange(m)[:, None]
    seen = np.zeros((m, n + 1), bool)
    range_ = np.zeros((m, n + 1), bool)  # in range, or so near to it that the search goes on from there
    edge = np.float32(least - SLACK)

    def visit(at: np.ndarray) -> np.ndarray:
        """Likenesses of the rows at[q] to query q, -inf for none and for rows seen before."""
        new = ~seen[rows, at]
        s = np.where(new, np.einsum("qkd,qd->qk", x32[at], q32), -np.inf)
        seen[rows, at] = True
        range_[rows, at] |= s >= edge
        return s

    seen[:, n] = True
    pool = np.where(starts < 0, n, starts)
    score = visit(pool)
    opened = np.zeros(pool.shape, bool)
    while True:
        wait = np.where(opened, -np.inf, score)
        step = min(STEP, pool.shape[1])
        best = np.argpartition(-wait, step - 1, axis=1)[:, :step]
        live = np.isfinite(np.take_along_axis(wait, best, 1))
        if not live.any():
            break
        np.put_along_axis(opened, best, True, 1)
        to = links[np.where(live, np.take_along_axis(pool, best, 1), n)].reshape(m, -1)
        # a row named by two of the opened ones counts once
        to = np.sort(to, axis=1)
        to[:, 1:][to[:, 1:] == to[:, :-1]] = n
        pool, score = np.concatenate([pool, to], axis=1), np.concatenate([score, visit(to)], axis=1)
        opened = np.concatenate([opened, np.zeros(to.shape, bool)], axis=1)
        if pool.shape[1] > beam:
            top = np.argpartition(-score, beam - 1, axis=1)[:, :beam]
            pool, score, opened = (np.take_along_axis(a, top, 1) for a in (pool, score, opened))
    at_q, at = np.nonzero(range_)
    while len(at):
        new_q, new = [], []
        for k in range(0, len(at), max(1, (1 << 20) // d)):
            part = slice(k, k + max(1, (1 << 20) // d))
            keys = (at_q[part, None] * (n + 1) + links[at[part]]).ravel()
            keys = np.unique(keys[~seen.ravel()[keys]])
            q, to = np.divmod(keys, n + 1)
            seen[q, to] = True
            for z in range(0, len(q), 1 << 15):
                c = slice(z, z + (1 << 15))
                hit = np.einsum("pd,pd->p", x32[to[c]], q32[q[c]]) >= edge
                new_q.append(q[c][hit])
                new.append(to[c][hit])
        at_q, at = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (new_q, new))
        range_[at_q, at] = True
    q, to = np.nonzero(range_)
    fine = np.zeros(len(q), bool)
    for z in range(0, len(q), 1 << 15):
        c = slice(z, z + (1 << 15))
        fine[c] = np.einsum("pd,pd->p", x[to[c]], queries[q[c]]) >= least
    return q[fine], to[fine]


def _built(placed: DataFrame) -> DataFrame:
    """(v, near, close, cell, block, medoid) of the vertices (v, u, cell, block): neighbours in their shard, and those of them that are really near."""

    def build(t: pa.Table) -> pa.Table:
        v, x = t["v"].to_numpy(), matrix(t["u"])
        order = np.argsort(v)
        v, x = v[order], x[order]
        lists, medoid = shard_graph(x)
        s = np.einsum("nkd,nd->nk", x[lists].astype(np.float32), x.astype(np.float32))
        near = [v[row[row >= 0]] for row in lists]
        close = [v[row[(row >= 0) & (like >= CLOSE)]] for row, like in zip(lists, s)]
        same = lambda c: pa.array([t[c][0].as_py()] * len(v), t.schema.field(c).type)
        lists_of = lambda a: pa.array(a, pa.list_(pa.int64()))
        released()
        return pa.table({"v": v, "near": lists_of(near), "close": lists_of(close), "cell": same("cell"), "block": same("block"), "medoid": np.arange(len(v)) == medoid})

    return placed.groupBy("cell", "block").applyInArrow(build, "v long, near array<long>, close array<long>, cell string, block int, medoid boolean")


def _searched(asked: DataFrame, least: float, beam: int) -> DataFrame:
    """(v, n, root): links counted for each vertex, and the smallest vertex that those of its task lead to.

    asked holds for each task (cell, block, part) its vertices (node), with their links, and those that ask (ask).
    """

    def search(key: tuple, t: pa.Table) -> pa.Table:
        flag = lambda c: t[c].to_numpy(zero_copy_only=False)
        order = np.argsort(t["v"].to_numpy(), kind="stable")
        nodes, asks = order[flag("node")[order]], order[flag("ask")[order]]
        v_all, c_all, main_all, medoid = t["v"].to_numpy(), t["c"].to_numpy(), t["main_home"].to_numpy(), flag("medoid")
        u = matrix(t["u"])
        x, v = u[nodes], v_all[nodes]
        given = t["homes"].to_pylist()
        width = max(1, max(map(len, given)))
        homes = np.array([h + [0] * (width - len(h)) for h in given], np.int64)
        real = np.arange(width) < np.array([len(h) for h in given])[:, None]  # what is behind a vertex's homes is no cell that two have in common
        here = np.int64(t["home"][0].as_py())
        # lists of all shards, as far as their ends are here
        near = t["near"].take(nodes).combine_chunks()
        ends, sizes = near.flatten().to_numpy(), near.value_lengths().fill_null(0).to_numpy()
        row = np.repeat(np.arange(len(v)), sizes)
        at = np.searchsorted(v, ends)
        there = v[np.minimum(at, len(v) - 1)] == ends
        pairs = np.unique(row[there] * len(v) + at[there])
        links = _padded(*np.divmod(pairs, len(v)), len(v))
        first = np.flatnonzero(medoid[nodes])[:1]
        out_v, out_n, edges = [], [], []
        step = max(16, min(512, (32 << 20) // max(1, len(v) + links.shape[1] * STEP * x.shape[1] * 4)))
        for k in range(0, len(asks), step):
            part = asks[k : k + step]
            own = np.searchsorted(v, v_all[part])
            own = np.where(v[np.minimum(own, len(v) - 1)] == v_all[part], own, -1)  # a vertex of the graph starts at itself too
            starts = np.column_stack([np.full(len(part), first[0] if len(first) else 0), np.where(own == (first[0] if len(first) else 0), -1, own)])
            q, to = range_search(x, links, u[part], starts, least, beam)
            other = v_all[part][q] != v[to]
            q, to = q[other], to[other]
            counted = np.zeros(len(q), bool)
            for z in range(0, len(q), 1 << 16):
                c = slice(z, z + (1 << 16))
                a, b = homes[part[q[c]]], homes[nodes[to[c]]]
                both = ((a[:, :, None] == b[:, None, :]) & real[nodes[to[c]]][:, None, :]).any(axis=2) & real[part[q[c]]]
                # counted in the first cell that both have, or else in the main one of the vertex that asks
                lowest = np.where(both, a, np.iinfo(np.int64).max).min(axis=1)
                counted[c] = np.where(both.any(axis=1), lowest == here, main_all[part[q[c]]] == here)
            n = np.bincount(q[counted], weights=c_all[nodes[to[counted]]], minlength=len(part)).astype(np.int64)
            out_v.append(v_all[part])
            out_n.append(n)
            if len(q):
                ids, place = np.unique(np.concatenate([v_all[part][q], v[to]]), return_inverse=True)
                least_of = forest(ids, place[: len(q)], place[len(q) :])
                edges.append(np.stack([ids, least_of])[:, ids != least_of])
        ids, n = (np.concatenate(a) if a else np.zeros(0, np.int64) for a in (out_v, out_n))
        some = n > 0
        ids, n, root = ids[some], n[some], np.full(some.sum(), -1, np.int64)
        if edges:
            # the forests of the batches are one graph again
            e = np.concatenate(edges, axis=1)
            own, place = np.unique(e, return_inverse=True)
            place = place.reshape(e.shape)
            least_of = forest(own, place[0], place[1])
            moved = own != least_of
            ids, n, root = np.concatenate([ids, own[moved]]), np.concatenate([n, np.zeros(moved.sum(), np.int64)]), np.concatenate([root, least_of[moved]])
        released()
        return pa.table({"v": ids, "n": n, "root": root})

    return asked.groupBy("cell", "block", "part").applyInArrow(search, "v long, n long, root long")


def vertex_links(vertices: DataFrame, least: float, shard: int = SHARD, beam: int = BEAM, border: float = BORDER) -> DataFrame:
    """(v, n, root) rows, n to be summed up and root to be read as edges (-1: none), of different vertices (v, u, c: how many vectors it is, cell)."""
    placed, _ = stored(cells(vertices.select("v", "u", "cell"), shard, border))
    blocks = F.when(F.col("size") > 2 * shard, F.ceil(F.col("size") / shard)).otherwise(1).cast("int")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("size")).select("cell", blocks.alias("blocks"), F.ceil(F.col("size") / ASKED).cast("int").alias("parts"))
    h = F.xxhash64("v", F.lit(3))
    placed = placed.join(sizes, "cell").withColumn("parts", F.when(F.col("blocks") > 1, F.col("parts")).otherwise(1))
    placed, _ = stored(placed.withColumn("block", F.pmod(h, F.col("blocks")).cast("int")).withColumn("home", F.xxhash64("cell")))
    built, _ = stored(_built(placed.select("v", "u", "cell", "block")))
    # of each vertex the lists of all its shards and its cells
    united = built.groupBy("v").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.array_distinct(F.flatten(F.collect_list("close"))).alias("close"))
    homes = placed.groupBy("v").agg(F.array_sort(F.collect_set("home")).alias("homes"), F.max(F.when(F.col("main"), F.col("home"))).alias("main_home"))
    known, _ = stored(vertices.select("v", "u", "c").join(united, "v").join(homes, "v"))
    medoids = built.where("medoid").select("v", "cell", "block", "medoid")
    inside = placed.select("v", "cell", "block", "home", "blocks", "parts").join(medoids, ["v", "cell", "block"], "left").withColumn("medoid", F.coalesce("medoid", F.lit(False)))
    inside = inside.join(known, "v")
    # near vertices of the lists that are not of the cell
    beyond = inside.where(F.size("close") > 0).select("cell", "block", "home", "blocks", "parts", F.explode("close").alias("v")).distinct()
    beyond = beyond.join(known, "v").where(~F.array_contains("homes", F.col("home"))).withColumn("medoid", F.lit(False))
    columns = ["cell", "block", "part", "home", "v", "u", "c", "homes", "main_home", "near", "medoid", "node", "ask"]
    alone = F.col("blocks") == 1
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = inside.withColumn("part", each).withColumn("node", F.lit(True)).withColumn("ask", alone).select(columns)
    rows = rows.union(beyond.withColumn("part", each).withColumn("node", F.lit(True)).withColumn("ask", F.lit(False)).select(columns))
    crowd = inside.where(~alone).withColumn("part", F.pmod(h, F.col("parts")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    none = F.array().cast("array<long>")
    rows = rows.union(crowd.withColumn("near", none).withColumn("medoid", F.lit(False)).withColumn("node", F.lit(False)).withColumn("ask", F.lit(True)).select(columns))
    return _searched(rows, least, beam)


def audit(vertices: DataFrame, links: DataFrame, least: float, size: int = AUDIT) -> float:
    """Share of the true links of `size` vertices, those of the smallest hashes, that `links` (v, n) has; 1 if they have none. The sample is compared with all vertices."""
    sample = vertices.orderBy(F.xxhash64("u", F.lit(11)), "v").limit(size).select("v", "cell", "u").collect()
    groups: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for cell in {r.cell for r in sample}:
        own = [r for r in sample if r.cell == cell]
        groups[cell] = np.array([r.v for r in own]), np.frombuffer(b"".join(bytes(r.u) for r in own), "<f8").reshape(len(own), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = np.array(b.column(2).to_pylist(), object)
            for name, (ids, x) in groups.items():
                at = np.flatnonzero(cell == name)
                if len(at):
                    own, c = b.column(0).to_numpy()[at], b.column(3).to_numpy()[at]
                    hit = matrix(b.column(1).take(pa.array(at))) @ x.T >= least
                    hit &= own[:, None] != ids
                    n = (hit * c[:, None]).sum(axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[n > 0]), pa.array(n[n > 0].astype(np.int64))], names=["v", "true"])

    if not sample:
        return 1.0
    true = in_arrow(vertices.select("v", "u", "cell", "c"), run, "v long, true long").groupBy("v").agg(F.sum("true").alias("true"))
    both = true.join(links, "v", "left").agg(F.sum("true").alias("true"), F.sum(F.least("true", F.coalesce("n", F.lit(0)))).alias("found")).first()
    return both.found / both.true if both.true else 1.0


def near_embeddings(
    df: DataFrame, least: float = 0.93, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", shard: int = SHARD, beam: int = BEAM
) -> DataFrame:
    """(id_col, n_links, component_id, kept) of every row: other vectors of its label within a cosine of `least`, the smallest id that links lead to.

    Rows of null label, and vectors that are null, empty, zero or hold null or non-finite components, have no links; vectors of different lengths
    do not link. Equal vectors of a label link. Each row counts, repeated ids too; a null id names no component, and one without any other id is
    named null. kept: the row's id is its component's (false for a null id). Searches are repeated with wider borders and beam if an audit shows a
    recall below RECALL, and an error is raised if that does not help. Other columns do not matter. An empty table gives no rows.
    """
    rows, _ = stored(unit_vectors(df, id_col, label_col, vector_col))
    valid = rows.where("u is not null and label is not null")
    cell = F.concat(F.col("label").cast("string"), F.lit(":"), F.length("u").cast("string"))
    vertices = valid.groupBy("label", "u").agg(F.count("*").alias("c"), F.min("id").alias("least")).withColumn("cell", cell)
    vertices, _ = stored(vertices.withColumn("v", F.monotonically_increasing_id()))
    for widen in (1, 2, 4):
        found, _ = stored(vertex_links(vertices, least, shard, beam * widen, BORDER * widen))
        links = found.groupBy("v").agg(F.sum("n").alias("n"))
        recall = audit(vertices, links, least)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"recall of {recall:.3f} in an audit")
    groups = connected(found.where("root >= 0").select(F.col("v").alias("a"), F.col("root").alias("b")))
    named = vertices.join(groups, F.col("v") == F.col("node"), "left").withColumn("root", F.coalesce("component", "v"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.select("label", "u", "v", "c", "root").join(ids, "root").join(links, "v", "left")
    named = named.select("label", "u", (F.col("c") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.col("component_id"))
    out = rows.join(named, ["label", "u"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept")
    )
