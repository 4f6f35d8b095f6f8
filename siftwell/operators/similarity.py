"""Similarity joins on vectors and bit codes, with exact results.

Vectors meet in blocks around pivots, of which most pairs are dropped unseen (vectors.py). Bit codes are joined on parts: of
codes within d bits of each other some part differs in few bits, so candidates come from an equi-join and are verified. Parts
that many codes share are dealt again together with a second part. Equal codes are one code while candidates are found, so
copies never pair with each other there, and a pair is a candidate once, by the first of the parts that it could be found by.
Bits that all codes agree in are in no part. Where a radius takes in so much of a code that parts would make more work than
all pairs, blocks of codes are compared with each other, packed, by counting bits.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vectors
from .tables import bounded_batches, crossed, stored

#: Different codes of one value of a part, beyond which they are dealt again; most masks of changed bits for a part.
CROWD, MASKS = 20_000, 5_000
#: Codes of a block; comparisons in blocks that take as long as one row of a join on parts.
BLOCK, PER_ROW = 8192, 200


def cosine_pairs(df: DataFrame, least: float, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(a, b, cosine) of all pairs a < b of at least this cosine, above 0. Zero vectors match nothing."""
    return vectors.pairs_within(df, least, id_col, vector_col)


def cosine_top_k(df: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", least: float = -1.0) -> DataFrame:
    """(id, rank, neighbour, cosine): the k nearest other rows of every row (of at least a cosine), ties to the smaller id. Zero vectors take no part."""
    return vectors.nearest(df, k, id_col, vector_col, least)


def sign_code(vector: str, bits: int = 63):
    """The signs of the first `bits` components as one long (bit i set if component i is positive)."""
    parts = F.transform(F.slice(vector, 1, bits), lambda x, i: F.when(x > 0, F.expr("1L")).otherwise(F.expr("0L")))
    return F.aggregate(F.reverse(parts), F.expr("0L"), lambda s, b: F.shiftleft(s, 1).bitwiseOR(b))


def hamming_pairs(df: DataFrame, most: int, id_col: str = "id", code_col: str = "code", bits: int = 64) -> DataFrame:
    """(a, b, distance) of all pairs a < b of codes (longs of `bits` bits) that differ in at most `most` bits."""
    rows = df.select(F.col(id_col).alias("id"), F.col(code_col).alias("code")).where("id is not null and code is not null")
    near = near_codes(rows.select(F.array("code").alias("code")), most, words=1, bits=bits, once=True)
    near = near.select(F.col("x")[0].alias("ca"), F.col("y")[0].alias("cb"), "distance")
    same = rows.groupBy(F.col("code").alias("ca")).agg(F.count("*").alias("n")).where("n > 1").select("ca", F.col("ca").alias("cb"), F.lit(0).alias("distance"))
    out = near.union(same).join(rows.select(F.col("id").alias("a"), F.col("code").alias("ca")), "ca").join(rows.select(F.col("id").alias("b"), F.col("code").alias("cb")), "cb")
    out = out.where((F.col("ca") != F.col("cb")) | (F.col("a") < F.col("b")))
    return out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")


def cosine_matches(df: DataFrame, k: int, least: float, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(a, b, cosine), a < b: pairs of which one is among the k nearest of the other, itself counted, at `least` or more; the larger cosine, to six places."""
    near = cosine_top_k(df, k - 1, id_col, vector_col, least)
    pair = [F.least("id", "neighbour").alias("a"), F.greatest("id", "neighbour").alias("b")]
    return near.groupBy(*pair).agg(F.round(F.max("cosine"), 6).alias("cosine"))


def code_distance(x: Column, y: Column) -> Column:
    """Differing bits of two codes, arrays of longs."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, n: s + n)


def radii(most: int, parts: int) -> list[int]:
    """Bits in which each of some parts may differ so that of any codes within `most` bits one part at least does not differ more (-1: that part is not needed)."""
    each, more = divmod(most, parts)
    return [each if i <= more else each - 1 for i in range(parts)]


def _masks(width: int, radius: int) -> int:
    return sum(comb(width, r) for r in range(radius + 1))


def _part_costs(bits: int, most: int, codes: int) -> dict[int, float]:
    """By number of parts, the rows that a join of so many codes, spread evenly, makes for each: values near its own, and codes that have them."""
    costs = {}
    for m in range(1, bits + 1):
        width, tries = -(-bits // m), [_masks(-(-bits // m), r) for r in radii(most, m)]
        if width <= 62 and max(tries) <= MASKS:
            costs[m] = sum(n * (1 + codes / 2**width) for n in tries)
    return costs


def part_count(bits: int, most: int, codes: int) -> int:
    """Parts for which a join of so many codes, spread evenly, makes the fewest rows: values near a code's own, and codes that have them."""
    costs = _part_costs(bits, most, codes)
    if not costs:
        raise ValueError(f"{most} of {bits} bits are too many")
    return min(costs, key=costs.get)


def _code_blocks(codes: DataFrame, words: int) -> DataFrame:
    """(block, n, u): codes in blocks of up to BLOCK, u their bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, number = np.zeros((0, words), "<i8"), 0, 0

        def row(x: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) | number], pa.int64()), pa.array([len(x)], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["block", "n", "u"])

        for b in batches:
            if b.num_rows:
                part = b.column(1)[0].as_py()
                held = np.concatenate([held, b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, words)])
                while len(held) >= BLOCK:
                    yield row(held[:BLOCK])
                    held, number = held[BLOCK:], number + 1
        if len(held):
            yield row(held)

    whole = codes.where((F.size("code") == words) & F.forall("code", lambda w: w.isNotNull()))
    return stored(whole.select("code", F.spark_partition_id().alias("part")).mapInArrow(pack, "block long, n int, u binary"))[0]


def _near_in_blocks(rows: DataFrame, asked: DataFrame | None, most: int, words: int, varying: list[int], once: bool) -> DataFrame:
    """near_codes() by comparing all codes, block by block; `varying` has the bits of each word in which codes differ."""
    bounded_batches(rows.sparkSession)
    kept = np.flatnonzero(np.array(varying, "<u8").view("u1"))
    y = _code_blocks(rows, words)
    x = y if asked is None else _code_blocks(asked, words)
    mutual = asked is None

    def packed(codes: np.ndarray) -> np.ndarray:
        """The bytes that differ, as words by row."""
        out = np.zeros((len(codes), -(-len(kept) // 8) * 8), "u1")
        out[:, : len(kept)] = codes.view("u1")[:, kept]
        return np.ascontiguousarray(out.view("<u8").T)

    def listed(codes: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, words, dtype=np.int32)), pa.array(codes.ravel()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            for r in range(b.num_rows):
                own, other = (np.frombuffer(at[c][r].as_py(), "<i8").reshape(-1, words) for c in ("xu", "yu"))
                p, q = packed(own), packed(other)
                alone = mutual and at["x"][r].as_py() == at["y"][r].as_py()
                for s in range(0, len(own), 64):
                    d = np.zeros((min(64, len(own) - s), len(other)), np.uint16)
                    for one, two in zip(p, q):
                        d += np.bitwise_count(np.bitwise_xor.outer(one[s : s + 64], two))
                    i, j = np.nonzero(d <= most)
                    far = d[i, j].astype(np.int32)
                    keep = i + s < j if alone else far > 0  # codes are distinct
                    i, j, far = i[keep] + s, j[keep], far[keep]
                    for f, g in ((own[i], other[j]), (other[j], own[i]))[: 2 if mutual and not once else 1]:
                        yield pa.RecordBatch.from_arrays([listed(f), listed(g), pa.array(far)], names=["x", "y", "distance"])

    one = x.select(F.col("block").alias("x"), F.col("u").alias("xu"))
    two = y.select(F.col("block").alias("y"), F.col("u").alias("yu"))
    met = crossed(one, two, F.col("x") <= F.col("y") if mutual else None, 8 * words * BLOCK)
    return met.mapInArrow(run, "x array<long>, y array<long>, distance int")


def near_codes(codes: DataFrame, most: int, words: int = 4, bits: int | None = None, crowd: int = CROWD, parts: int | None = None, asked: DataFrame | None = None, once: bool = False) -> DataFrame:
    """(x, y, distance) of all ordered pairs of different codes (column code, arrays of `words` longs) within `most` bits; x only of the codes `asked`, if given.

    x is dealt by all values near its parts, y by the values of its own. A value that more than `crowd` codes have is
    dealt again for each second part: what is left of the distance leaves some other part with few bits, too. Codes have the
    first `bits` bits of their words; null codes match nothing. Unless `parts` is given, codes are compared in blocks where that is less work.
    With `once` (and none `asked`) an unordered pair comes once, either way round.
    """
    bits = bits or 64 * words
    once = once and asked is None
    rows, _ = stored(codes.select("code").where("code is not null").distinct())
    mine = rows if asked is None else stored(rows.join(asked.select("code").distinct(), "code", "left_semi"))[0]
    seen = rows.agg(F.count("*"), *[f(F.col("code")[i]) for i in range(words) for f in (F.bit_or, F.bit_and)]).first()
    n, whole = seen[0], (1 << 64) - 1
    varying = [((seen[1 + 2 * i] or 0) ^ (seen[2 + 2 * i] or 0)) & whole for i in range(words)]
    places = [(w, b) for w in range(words) for b in range(64) if 64 * w + b < bits and varying[w] >> b & 1]
    costs = _part_costs(len(places), most, n)
    asking = n if asked is None else mine.count()
    if not parts and (not costs or asking * n / (2 if asked is None else 1) <= PER_ROW * asking * min(costs.values())):
        return _near_in_blocks(rows, None if asked is None else mine, most, words, varying, once)
    m = parts or min(costs, key=costs.get)
    edges = [round(len(places) * i / m) for i in range(m + 1)]
    radius = radii(most, m)

    def part(code: Column, i: int) -> Column:
        """Part i as one number: runs of bits side by side."""
        value, here = F.lit(0).cast("long"), places[edges[i] : edges[i + 1]]
        for _, run in itertools.groupby(enumerate(here), lambda e: (e[1][0], e[1][1] - e[0])):
            (at, (word, low)), *more = run
            width = len(more) + 1
            bits_ = F.shiftrightunsigned(code[word], low)
            bits_ = bits_.bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else bits_
            value = value.bitwiseOR(F.shiftleft(bits_, at)) if at else bits_
        return value

    def own(code: Column, allowed: list[int]) -> Column:
        return F.array(*[F.struct(F.lit(i).alias("i"), part(code, i).alias("v")) for i in range(m) if allowed[i] >= 0])

    def around(code: Column, allowed: list[int]) -> Column:
        """The same and all values that differ in no more bits than allowed."""

        def values(i: int) -> Column:
            masks = [sum(1 << b for b in c) for r in range(allowed[i] + 1) for c in itertools.combinations(range(edges[i + 1] - edges[i]), r)]
            return F.transform(F.lit(masks).cast("array<long>"), lambda f: F.struct(F.lit(i).alias("i"), part(code, i).bitwiseXOR(f).alias("v")))

        return F.concat(*[values(i) for i in range(m) if allowed[i] >= 0])

    def apart(i: int) -> Column:
        """Bits in which part i of x and y differs."""
        return F.bit_count(part(F.col("x"), i).bitwiseXOR(part(F.col("y"), i)))

    def first(allowed: list[int]) -> Column:
        """The first part that differs in no more bits than allowed: a pair is met by that one only."""
        out = F.lit(m)
        for i in reversed(range(m)):
            if allowed[i] >= 0:
                out = F.when(apart(i) <= allowed[i], F.lit(i)).otherwise(out)
        return out

    y = rows.select(F.col("code").alias("y"), F.explode(own(F.col("code"), radius)).alias("p")).select("y", "p.i", "p.v")
    x = mine.select(F.col("code").alias("x"), F.explode(around(F.col("code"), radius)).alias("p")).select("x", "p.i", "p.v")
    distance = code_distance(F.col("x"), F.col("y"))
    verified = lambda met: met.where(F.col("x") < F.col("y") if once else F.col("x") != F.col("y")).withColumn("distance", distance).where(F.col("distance") <= most)
    crowded, _ = stored(y.groupBy("i", "v").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("i", "v"))
    if m < 2 or crowded.isEmpty():
        return verified(x.join(y, ["i", "v"])).where(F.col("i") == first(radius)).select("x", "y", "distance")
    met = verified(x.join(crowded, ["i", "v"], "left_anti").join(y, ["i", "v"])).where(F.col("i") == first(radius)).select("x", "y", "distance")
    for i in range(m):
        if radius[i] < 0:
            continue
        # the other parts, each as narrow as it has to be if part i takes none of the distance
        rest = iter(radii(most, m - 1))
        second = [-1 if j == i else next(rest) for j in range(m)]
        again = lambda side: side.where(F.col("i") == i).join(crowded, ["i", "v"], "left_semi")  # noqa: B023, E731
        xs = again(x).select("x", "i", "v", F.explode(around(F.col("x"), second)).alias("q")).select("x", "i", "v", F.col("q.i").alias("j"), F.col("q.v").alias("w"))
        ys = again(y).select("y", "i", "v", F.explode(own(F.col("y"), second)).alias("q")).select("y", "i", "v", F.col("q.i").alias("j"), F.col("q.v").alias("w"))
        both = xs.join(ys, ["i", "v", "j", "w"])
        met = met.union(verified(both).where((F.col("i") == first(radius)) & (F.col("j") == first(second))).select("x", "y", "distance"))
    return met


def hamming_matches(df: DataFrame, most: int, k: int, id_col: str = "id", code_col: str = "code", words: int = 4, asked: DataFrame | None = None, self_counts: bool = False) -> DataFrame:
    """(a, b, distance): for each row (or each one `asked`) its k nearest other rows within `most` bits of its code, ties to smaller ids.

    `code_col` is an array of longs. Of the rows that share a code only the first k + 1 ids can be anyone's neighbours,
    so no group of copies is held as a whole. With `self_counts` a row is its own first neighbour and takes one of the k places, but no row here.
    Codes are asked for twice: what has its neighbours within a third of `most` bits needs no wider search.
    """
    k = k - 1 if self_counts else k
    rows = df.select(F.col(id_col).alias("id"), F.col(code_col).alias("code")).where("id is not null and code is not null")
    mine = rows if asked is None else asked.select(F.col(id_col).alias("id"), F.col(code_col).alias("code")).where("id is not null and code is not null")
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    first = rows.withColumn("rn", place).where(F.col("rn") <= k + 1).groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    first, _ = stored(first)
    same = first.select(F.col("code").alias("x"), F.col("code").alias("y"), F.lit(0).alias("distance"))
    near = near_codes(first, most // 3, words, asked=None if asked is None else mine)
    if most // 3 < most:
        close, _ = stored(near)
        ids = same.union(close).join(first.select(F.col("code").alias("y"), F.size("ids").alias("n")), "y").groupBy("x").agg(F.sum("n").alias("n"))
        done, _ = stored(ids.where(F.col("n") > k).select("x"))
        open_ = mine.select("code").distinct().join(done.withColumnRenamed("x", "code"), "code", "left_anti")
        near = close.join(done, "x", "left_semi").union(near_codes(first, most, words, asked=open_))
    met = same.union(near).join(first.withColumnRenamed("code", "y"), "y")
    each = met.select("x", "distance", F.explode("ids").alias("b"))
    best = each.withColumn("rn", F.row_number().over(Window.partitionBy("x").orderBy("distance", "b"))).where(F.col("rn") <= k + 1)
    out = mine.select(F.col("id").alias("a"), F.col("code").alias("x")).join(best.drop("rn"), "x").where("a <> b")
    rank = F.row_number().over(Window.partitionBy("a").orderBy("distance", "b"))
    return out.withColumn("rn", rank).where(F.col("rn") <= k).select("a", "b", "distance")


def frame_ratio_match(pairs: DataFrame, frames: DataFrame, least_ratio: float, directed: bool = False) -> DataFrame:
    """Clip pairs from frame pairs: (a, b, matched, ratio, mean_distance) per direction, ratio of the first clip's frames.

    `pairs` (a, b, distance) of frames, each once unless `directed`, as hamming_matches() gives them; `frames` (frame, clip).
    Pairs within a clip count for nothing; a frame counts once for each other clip, by its nearest frame there.
    """
    both = pairs.select("a", "b", "distance")
    both = both if directed else both.union(pairs.select("b", "a", "distance"))
    fa, fb = frames.select(F.col("frame").alias("a"), F.col("clip").alias("clip_a")), frames.select(F.col("frame").alias("b"), F.col("clip").alias("clip_b"))
    near = both.join(fa, "a").join(fb, "b").where("clip_a <> clip_b")
    nearest = near.groupBy("clip_a", "clip_b", "a").agg(F.min("distance").alias("distance"))
    sizes = frames.groupBy(F.col("clip").alias("clip_a")).agg(F.count("*").alias("frames"))
    out = nearest.groupBy("clip_a", "clip_b").agg(F.count("*").alias("matched"), F.round(F.avg("distance"), 6).alias("mean_distance"))
    out = out.join(sizes, "clip_a").withColumn("ratio", F.col("matched") / F.col("frames"))
    return out.where(F.col("ratio") >= least_ratio).select("clip_a", "clip_b", "matched", "ratio", "mean_distance")


def strongest(pairs: DataFrame, order: list) -> DataFrame:
    """One row for each unordered pair: that of the largest order key."""
    key = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    return pairs.groupBy(*key).agg(F.max_by(F.struct(*[c for c in pairs.columns if c not in ("a", "b")]), F.struct(*order)).alias("x")).select("a", "b", "x.*")


def best_match(pairs: DataFrame, weight: str) -> DataFrame:
    """(id, match, weight): each id's strongest neighbour, ties to the larger id."""
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("match"), weight).union(pairs.select("b", "a", weight))
    return both.groupBy("id").agg(F.max(F.struct(F.col(weight), F.col("match"))).alias("x")).select("id", F.col("x.match").alias("match"), F.col(f"x.{weight}").alias(weight))
