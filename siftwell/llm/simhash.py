"""SimHash near-duplicates, found through a Gray-ordered hierarchical index.

A fingerprint has 64 bits; two link when at most `bits` of them differ. The distinct fingerprints are sorted by
Gray rank, in which neighbours share long bit patterns, and cut into runs, the index's nodes. A node keeps the mask
and the values of the bits that all its members share; nodes are grouped into upper nodes by place, up to a few
hundred at the top. The index is searched against itself from the top: of each pair of nodes the differences in bits
that both share are added up, level by level, each level only counting the bits that the levels above have not;
beyond `bits` the pair goes, and with it all pairs of fingerprints below. Runs are dealt to tiles, once for each block of
runs, and the pairs that are left, names of runs only, meet them there: smaller nodes prune in the same way before fingerprints are compared.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import connected, durable, in_arrow, let_go, released, shuffle_partitions, slices

#: Ids of rows that go, up to which they are broadcast.
SMALL = 1_000_000
#: Fingerprints of a run and of a node within it; most nodes of the top level.
RUN, LEAF, TOP = 512, 16, 512
#: Blocks of runs, at least, and runs of a block, about and at most: two blocks make a tile.
BLOCKS, SIDE = 8, 1024
#: Bits of a node's place that each level drops: 64 runs of a partition, the partition, 64 partitions and so on.
LEVELS = [0, 6, 32, 38, 44, 50, 56]


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """Of UTF-8 text: A-Z lower-cased, words cut at ASCII white space, a bit set if it is set in over half the shingles."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(s, seed) for s in shingles], "<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have set; zero for none."""
    half, total = len(hashes), np.zeros(64, np.int64)
    for at in range(0, half, 1 << 16):
        total += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > half, bitorder="little").view("<u8")[0])


def simhash(df: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp long: the fingerprint's bits) of every row; null and empty texts have fingerprint zero."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = [fingerprint(t, width) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, "<u8").view("<i8"))], names=[id_col, "fp"])

    source = df.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return in_arrow(source, run, f"`{id_col}` {kind}, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def gray_key(fp: Column) -> Column:
    """The same of a column of longs, as a long that sorts alike."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def shared(codes: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
    """Mask and values of the bits that all of each `fan` neighbours have in common."""
    starts = np.arange(0, len(codes), fan)
    mask = np.bitwise_and.reduceat(codes, starts) | np.bitwise_and.reduceat(~codes, starts)
    return mask, codes[starts] & mask


def links_between(x: np.ndarray, y: np.ndarray, bits: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places (i, j) of two runs in Gray order whose codes differ in at most `bits` bits."""
    (mask, value), (mask2, value2) = shared(x, leaf), shared(y, leaf)
    near = np.bitwise_count((value[:, None] ^ value2) & (mask[:, None] & mask2)) <= bits
    i, j = np.nonzero(near)
    i = np.broadcast_to((i[:, None, None] * leaf + np.arange(leaf)[:, None]), (len(i), leaf, leaf)).ravel()
    j = np.broadcast_to((j[:, None, None] * leaf + np.arange(leaf)), (len(j), leaf, leaf)).ravel()
    if len(x) % leaf or len(y) % leaf:
        there = (i < len(x)) & (j < len(y))
        i, j = i[there], j[there]
    hit = np.bitwise_count(x[i] ^ y[j]) <= bits
    return i[hit], j[hit]


def forest(codes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each code the smallest code (signed) of its component under the links (i, j)."""
    order = np.argsort(codes.view(np.int64))
    label = np.empty(len(codes), np.int64)
    label[order] = np.arange(len(codes))  # places in the signed order
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = np.minimum(new, new[order[new]])
        if (new == label).all():
            return codes[order[label]]
        label = new


def gray_runs(fps: DataFrame, run: int = RUN) -> DataFrame:
    """(place, mask, value, codes) of the runs of distinct fingerprints (column fp) in Gray order; place is partition << 32 | run, codes are 8 bytes each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, rest, n = TaskContext.get().partitionId() << 32, np.zeros(0, np.uint64), 0
        for codes in itertools.chain((b.column(0).to_numpy().view(np.uint64) for b in batches), [None]):
            last = codes is None
            rest = rest if last else np.concatenate([rest, codes])
            whole = len(rest) if last else len(rest) - len(rest) % run
            if whole:
                (mask, value), at = shared(rest[:whole], run), range(0, whole, run)
                places = base + n + np.arange(len(at))
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(mask.view(np.int64)), pa.array(value.view(np.int64)), pa.array([rest[k : min(whole, k + run)].tobytes() for k in at], pa.binary())], names=["place", "mask", "value", "codes"])
                n, rest = n + len(at), rest[whole:]

    keyed = fps.select("fp", gray_key(F.col("fp")).alias("key"))
    ranged = keyed.repartitionByRange(shuffle_partitions(fps.sparkSession), "key").sortWithinPartitions("key")
    return durable(in_arrow(ranged.select("fp"), cut, "place long, mask long, value long, codes binary"))


def node_levels(runs: DataFrame, top: int = TOP) -> list[DataFrame]:
    """(node, mask, value) of each level of the index, from the runs up to one of at most `top` nodes."""
    levels = [runs.select(F.col("place").alias("node"), "mask", "value")]
    for lower, upper in itertools.pairwise(LEVELS):
        if levels[-1].count() <= top:
            break
        parent = F.shiftright("node", upper - lower)
        both = levels[-1].groupBy(parent.alias("node")).agg(F.bit_and("mask").alias("m"), F.bit_and("value").alias("ones"), F.bit_and(F.bitwise_not("value")).alias("zeros"), F.first("value").alias("v"))
        mask = F.col("m").bitwiseAND(F.col("ones").bitwiseOR(F.col("zeros")))
        levels.append(durable(both.select("node", mask.alias("mask"), F.col("v").bitwiseAND(mask).alias("value"))))
    return levels


def near_runs(levels: list[DataFrame], bits: int) -> DataFrame:
    """Pairs (a, b) of runs, a <= b, that may hold fingerprints within `bits` bits: what a search from the top level leaves."""
    spark, top = levels[-1].sparkSession, levels[-1].toPandas()  # TOP rows at most, however many fingerprints
    node, mask, value = (top[c].to_numpy(np.int64) for c in ("node", "mask", "value"))
    seen = mask[:, None] & mask
    differ = np.bitwise_count(((value[:, None] ^ value) & seen).view(np.uint64))
    i, j = np.nonzero((differ <= bits) & (node[:, None] <= node))
    pairs = spark.createDataFrame(pd.DataFrame({"a": node[i], "b": node[j], "seen": seen[i, j], "apart": differ[i, j].astype(np.int32)}), "a long, b long, seen long, apart int")
    shifts = LEVELS[: len(levels)]
    for depth in range(len(levels) - 2, -1, -1):
        parent = F.shiftright("node", shifts[depth + 1] - shifts[depth])
        below = lambda a, m, v: levels[depth].select(parent.alias("up"), F.col("node").alias(a), F.col("mask").alias(m), F.col("value").alias(v))  # noqa: B023, E731
        left = pairs.withColumnRenamed("a", "up").join(below("a", "x", "p"), "up").drop("up")
        both = left.withColumnRenamed("b", "up").join(below("b", "y", "q"), "up").where("a <= b")
        own = F.col("x").bitwiseAND(F.col("y"))
        # bits that the levels above have counted are not counted again
        more = F.bit_count(F.col("p").bitwiseXOR(F.col("q")).bitwiseAND(own).bitwiseAND(F.bitwise_not("seen")))
        pairs = durable(both.select("a", "b", own.alias("seen"), (F.col("apart") + more).cast("int").alias("apart")).where(F.col("apart") <= bits))
    return pairs.select("a", "b")


def tiles(runs: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Pairs (i, j, a, b) by the tile of their runs' blocks, each tile's runs (i2, j2, place, codes), and the number of blocks.

    A run goes to one tile for each block and not to each of its pairs, whose number grows with the square of the runs.
    """
    blocks = max(BLOCKS, -(-runs.count() // SIDE))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    dealt = pairs.select(F.least(block("a"), block("b")).alias("i"), F.greatest(block("a"), block("b")).alias("j"), "a", "b")
    own = runs.select(block("place").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("y"), "place", "codes")
    return dealt, own.select(F.least("x", "y").alias("i2"), F.greatest("x", "y").alias("j2"), "place", "codes"), blocks


def fingerprint_edges(fps: DataFrame, bits: int = 2, run: int = RUN, top: int = TOP) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all links of at most `bits` bits.

    fps has a column fp of distinct values, no nulls. The links of a tile are reduced to a forest, so
    a dense group gives no more edges than it has members there.
    """
    runs = gray_runs(fps, run)
    dealt, own, blocks = tiles(runs, near_runs(node_levels(runs, top), bits))

    def reduced(out: list[np.ndarray]) -> np.ndarray:
        used, at = np.unique(np.concatenate(out, axis=1), return_inverse=True)
        i, j = at.reshape(2, -1)
        least = forest(used, i, j)
        return np.stack([used, least])[:, used != least]

    def search(pairs: pa.Table, held: pa.Table) -> pa.Table:
        let_go()
        codes = {place: np.frombuffer(c.as_buffer(), "<u8") for place, c in zip(held["place"].to_pylist(), held["codes"])}
        out, size = [np.zeros((2, 0), np.uint64)], 0
        for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()):
            x, y = codes[a], codes[b]
            i, j = links_between(x, y, bits)
            if a == b:
                i, j = (k[i < j] for k in (i, j))
            if len(i):
                out.append(np.stack([x[i], y[j]]))
                size += len(i)
            if size >= 1 << 20:
                out, size = [reduced(out)], 0
        a, least = reduced(out).view(np.int64)
        del out, codes
        released()
        return pa.table({"a": a, "b": least})

    # by numbers of partitions that are not put together again: tiles are small, but much is compared in each
    n = blocks * blocks
    met = dealt.repartition(n, "i", "j").groupBy("i", "j").cogroup(own.repartition(n, "i2", "j2").groupBy("i2", "j2"))
    return met.applyInArrow(search, "a long, b long").distinct()


def near_duplicates(df: DataFrame, bits: int = 2, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp, component_id) of every row; component_id is the smallest id reachable over links.

    Rows of equal fingerprints are one vertex, so copies are never paired with each other. Null and empty
    texts share fingerprint zero. Null ids are kept and never name a component unless it has no other;
    repeated rows are kept. Other columns are left out; an empty table gives no rows.
    """
    rows = durable(simhash(df, width, id_col, text_col))
    groups = connected(fingerprint_edges(rows.select("fp").distinct(), bits))
    return in_groups(rows, groups, id_col).drop("root")


def in_groups(rows: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, fp, component_id, root) of rows (id_col, fp), from components (node, component) of the linked fingerprints; root names the group."""
    vertices = rows.groupBy("fp").agg(F.min(id_col).alias("least"))
    named = vertices.join(groups, vertices.fp == groups.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # of each fingerprint the id of its component: one row a fingerprint, joined back to the rows
    ids = named.join(roots, "root").select("fp", "component_id", "root")
    return rows.join(ids, "fp").select(id_col, "fp", "component_id", "root")


def keep_one(df: DataFrame, bits: int = 2, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, with all columns, that stand for their group of near duplicates: those of the smallest id.

    Rows of null id stay only where their group has no other, and of repeated ids (and of null ids) one row
    stays, that of the smallest text hash.
    """

    @F.pandas_udf("long")
    def code(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], "<u8").view("<i8"))

    rows = durable(simhash(df, width, id_col, text_col))
    groups = connected(fingerprint_edges(rows.select("fp").distinct(), bits))
    return stand_ins(df, in_groups(rows, groups, id_col), code, id_col, text_col)


def stand_ins(df: DataFrame, groups: DataFrame, code, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df that keep_one() keeps, from groups (id_col, fp, component_id, root) and code, the fingerprints of texts.

    Rows of ids of their own are told by the id. Only rows of repeated or null ids are looked at again, by text; of
    those a partial minimum keeps one for each group. Columns of any name pass.
    """
    groups = durable(groups.select(F.col(id_col).alias("id"), "fp", "component_id", "root"))
    goes = durable(groups.where(F.col("id").isNotNull() & (F.col("id") != F.col("component_id"))).select("id").distinct())
    goes = F.broadcast(goes) if goes.count() <= SMALL else goes
    d = df.alias("d")
    one = d.join(goes.alias("g"), F.col(f"d.`{id_col}`") == F.col("g.id"), "left_anti")
    odd = durable(groups.groupBy("id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("id").isNull()).select("id"))
    if odd.isEmpty():
        return one
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("o.id"))
    one = one.join(odd.alias("o"), same, "left_anti")
    text = F.coalesce(F.col(f"d.`{text_col}`").cast("string"), F.lit(""))
    rest = d.join(odd.alias("o"), same, "left_semi").select(F.col(f"d.`{id_col}`").alias("id"), code(text.cast("binary")).alias("fp"), F.xxhash64(text).alias("h"), F.struct("d.*").alias("row"))
    known = groups.select("fp", "component_id", "root").distinct()
    # rows that stand for their group by id, the smallest text hash among them
    kept = rest.join(known, "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
    kept = kept.groupBy("root").agg(F.min_by("row", "h").alias("row")).select("row.*")
    return one.union(kept)
