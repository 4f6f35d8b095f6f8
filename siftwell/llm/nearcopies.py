"""SimHash near-dedup at a stated likeness of word shingles: fingerprints propose, an exact check decides.

A text is the set of hashes of its shingles; two texts link when the Jaccard likeness of their sets is `least` or
more, and links are judged on the sets alone. Equal sets are one vertex, with the SimHash fingerprint of its members.
Candidates come in two steps, and each is checked by the members of both sets.

First the Gray-ordered index of `simhash` finds fingerprints that differ in BITS bits, and each vertex is held against
one vertex drawn from those that share a rare shingle of it, by HEADS different orders; this costs up to HEADS
comparisons a vertex and group, and joins large groups whose members are alike to some of the others only.
Then sets of different groups meet by prefixes: two sets of a likeness of `least` share one of the first
n - ceil(least * n) + 1 members in any common order. Common shingles, as a sample has them, come last in that order, so
prefixes hold rare ones. Pairs that share a prefix member are held against each other by small facts: only pairs within the limit become rows.
For two sets of at most FULL members together these are bit maps: members toggle bits, so maps differ in at most as many bits as sets in
members, and no pair is lost. Maps of larger sets tell little. These have SIMS SimHash words of independent hashes, which must differ in at most
REACH bits: at a likeness of 0.8 they differ in about 39 of 256 with a deviation of 6, so that of such pairs one in a hundred million million
is lost, while unrelated sets differ in 128 with a deviation of 8, and one in three million of those that share a shingle by chance is compared
by members. (By one word alone one in twelve was, with the members of both moved for each pair: disk grew with the square of the long texts.)
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected, durable, in_arrow, removed, slices, stored
from .simhash import fingerprint_edges, in_groups, majority, stand_ins

WIDTH, LEAST = 5, 0.8
#: Differing bits of fingerprints that the index looks for.
BITS = 3
#: SimHash words of sets that may make more than FULL members together, and of how many bits of those such sets differ at most.
SIMS, REACH, FULL = 4, 88, 1536
#: Orders by which a shingle's vertex is drawn: a member of a large group is held against so many others of it.
HEADS = 16
#: Sampled sets, and how many of them make a shingle common.
SAMPLE, COMMON = 4096, 4
#: 64-bit words of a bit map of sets of at most 64 * WORDS members; larger ones have twice, four times as many, and so on.
WORDS = 16
#: Bits of the table of names asked for, which keeps other members out of the shuffle.
TABLE = 1 << 25


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes (uint64) of the shingles of UTF-8 text: A-Z lower-cased, words cut at ASCII white space."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = [b" ".join(words)] if len(words) <= width else map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.array([*map(xxhash.xxh64_intdigest, parts)], np.uint64))


def vertex(members: np.ndarray) -> int:
    """Name of a set (signed): zero for the empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(members.tobytes(), 1)).view(np.int64)) if len(members) else 0


def prefix(members: np.ndarray, common: np.ndarray, least: float = LEAST) -> np.ndarray:
    """The first members in the order of (common or not, hash) of which alike sets share one; common is sorted."""
    often = np.zeros(len(members), bool)
    if len(common):
        often = common[np.minimum(np.searchsorted(common, members), len(common) - 1)] == members
    lead = len(members) - int(np.ceil(least * len(members) - 1e-9)) + 1
    return np.concatenate([members[~often], members[often]])[:lead]


def bit_map(members: np.ndarray) -> np.ndarray:
    """Words (int64) of the bits that an odd number of members have as their lowest bits; a bit for each member, at least."""
    bits = 64 * WORDS
    while bits < len(members):
        bits *= 2
    hits = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(hits.astype(np.uint8), bitorder="little").view("<i8")


def folded(words: Column, to: Column) -> Column:
    """A bit map's words as a map of `to` words, if it has twice as many; as they are, if it has no more."""
    return F.when(F.size(words) > to, F.zip_with(F.slice(words, 1, to), F.slice(words, to + 1, to), lambda p, q: p.bitwiseXOR(q))).otherwise(words)


def wider(members: np.ndarray, least: float = LEAST) -> np.ndarray:
    """SimHash words (int64) beyond the first, each of other hashes of the members; zeros for sets too small to need them."""
    out = np.zeros(SIMS - 1, "<u8")
    if len(members) * (1 + 1 / least) > FULL:
        for i in range(SIMS - 1):
            h = members + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = (h ^ h >> np.uint64(shift)) * np.uint64(by)
            out[i] = majority(h ^ h >> np.uint64(31))
    return out.view("<i8")


def _texts(df: DataFrame, *columns, text_col: str = "text") -> DataFrame:
    return df.select(*columns, F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def asked_bits(names: DataFrame) -> np.ndarray:
    """Bytes of a bit table of TABLE bits in which the names (fp) are set; what reaches the driver has a fixed size."""
    at = F.pmod("fp", F.lit(TABLE))
    rows = names.groupBy(F.shiftright(at, 15).alias("part")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(32767))).alias("bits"))
    table = np.zeros(TABLE // 8, np.uint8)
    for r in rows.collect():
        table[r["part"] << 12 : (r["part"] + 1) << 12] = np.frombuffer(r["bits"], np.uint8)
    return table


def _member_rows(width: int, bits: np.ndarray | None):
    def wanted(name: int) -> bool:
        at = name % TABLE
        return bits is None or bool(bits[at >> 3] >> (at & 7) & 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text=0):
            sets = [shingles(t, width) for t in b.column(0).to_pylist()]
            own = [(v, s) for v, s in zip(map(vertex, sets), sets) if wanted(v)]
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in own], pa.int64()), pa.array([s.view(np.int64) for _, s in own], pa.list_(pa.int64()))], names=["fp", "members"])

    return run


def members_of(texts: DataFrame, width: int = WIDTH, bits: np.ndarray | None = None) -> DataFrame:
    """(fp: the set's name, members) of rows (text); with a bit table, of those names that it may hold."""
    return in_arrow(texts.select("text"), _member_rows(width, bits), "fp long, members array<long>")


def common_shingles(texts: DataFrame, width: int = WIDTH, sample: int = SAMPLE) -> np.ndarray:
    """Sorted shingles of COMMON or more sets of a sample; at most the members of the sample reach the driver."""
    share = max(1, texts.count() // sample)
    tried = members_of(texts.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0), width).select("fp", F.explode("members").alias("s")).distinct()
    often = tried.groupBy("s").agg(F.count("*").alias("k")).where(F.col("k") >= COMMON).select("s")
    return np.sort(np.array([r["s"] for r in often.collect()], np.int64).view(np.uint64))


def shingle_sets(df: DataFrame, least: float = LEAST, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp: the set's name, sim: its SimHash, n, map: its bit map, wide: more SimHash words, lead: its prefix) of every row; null and empty texts have the empty set."""
    kind = df.schema[id_col].dataType.simpleString()
    common = common_shingles(_texts(df, text_col=text_col), width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [shingles(t, width) for t in b.column(1).to_pylist()]
            cols = [pa.array(map(vertex, sets), pa.int64()), pa.array(np.array([*map(majority, sets)], "<u8").view("<i8")), pa.array(map(len, sets), pa.int32())]
            cols.append(pa.array(map(bit_map, sets), pa.list_(pa.int64())))
            cols.append(pa.array([wider(s, least) for s in sets], pa.list_(pa.int64())))
            cols.append(pa.array([prefix(s, common, least).view(np.int64) for s in sets], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[id_col, "fp", "sim", "n", "map", "wide", "lead"])

    schema = f"`{id_col}` {kind}, fp long, sim long, n int, map array<long>, wide array<long>, lead array<long>"
    return in_arrow(_texts(df, F.col(id_col), text_col=text_col), run, schema)


def facts_of(sets: DataFrame, least: float = LEAST) -> DataFrame:
    """(fp, sim, n, w1, ..., m0, ...): what two sets are first held against each other by; the words m are the bit map folded to half its bits.

    Facts that no likely partner of a set's size asks for are zero, which takes little room in shuffles.
    """
    half = WORDS // 2
    asked = F.col("n") * (1 + least) <= FULL + 1e-6
    maps = [F.when(asked, F.col("map")[i].bitwiseXOR(F.col("map")[i + half])).otherwise(0).alias(f"m{i}") for i in range(half)]
    return sets.select("fp", "sim", "n", *[F.col("wide")[i - 1].alias(f"w{i}") for i in range(1, SIMS)], *maps)


def within_reach(x: Callable[[str], Column], y: Callable[[str], Column], least: float) -> Column:
    """Whether two sets, of facts x(name) and y(name), may be alike: by sizes and, up to FULL members, bit maps, else by SimHash words. Facts are never null."""
    total = x("n") + y("n")
    sizes = F.least(x("n"), y("n")) >= F.lit(least) * F.greatest(x("n"), y("n")) - 1e-9
    apart = lambda names: functools.reduce(operator.add, [F.bit_count(x(k).bitwiseXOR(y(k))) for k in names])
    maps = apart([f"m{i}" for i in range(WORDS // 2)]) <= F.lit((1 - least) / (1 + least)) * total + 1e-6
    return sizes & F.when(total <= FULL, maps).otherwise(apart(["sim", *[f"w{i}" for i in range(1, SIMS)]]) <= REACH)


def alike(pairs: DataFrame, sets: DataFrame, texts: DataFrame, least: float = LEAST, width: int = WIDTH) -> DataFrame:
    """Those of the distinct pairs (a, b) of set names whose sets are alike to `least` or more; sets has (fp, n, map), only members of near maps are shuffled."""
    near = pairs.join(sets.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("map").alias("x")), "a").join(sets.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("map").alias("y")), "b")
    # sizes of alike sets differ by less than half, so one map has at most twice the words of the other
    x, y = folded(F.col("x"), F.size("y")), folded(F.col("y"), F.size("x"))
    differ = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, c: t + c)
    near = durable(near.where(differ <= F.lit((1 - least) / (1 + least)) * (F.col("na") + F.col("nb")) + 1e-6).select("a", "b"))
    asked = near.select(F.col("a").alias("fp")).union(near.select("b")).distinct()
    members = members_of(texts, width, asked_bits(asked)).join(asked, "fp", "left_semi").groupBy("fp").agg(F.first("members").alias("m"))
    both = near.join(members.select(F.col("fp").alias("a"), F.col("m").alias("x")), "a").join(members.select(F.col("fp").alias("b"), F.col("m").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common >= F.lit(least) * (F.size("x") + F.size("y") - common) - 1e-9).select("a", "b")


def alike_edges(sets: DataFrame, texts: DataFrame, least: float = LEAST, width: int = WIDTH) -> DataFrame:
    """Edges (a, b) of alike sets whose components are those of all such pairs; sets are rows of shingle_sets(), texts their texts."""
    spark = sets.sparkSession
    whole, whole_at = stored(sets.where("n > 0").groupBy("fp").agg(*[F.first(c).alias(c) for c in ("sim", "n", "map", "wide", "lead")]))
    some, some_at = stored(whole.drop("lead"))
    facts = facts_of(some, least)
    # shingles shared by prefixes, with a vertex drawn for each: names alone are dealt, facts are joined to what is left
    # names are dealt by shingle once, and both the drawing and the join read that; a name that a mask turns smallest is drawn
    rows = whole.select("fp", F.explode("lead").alias("s")).repartition("s")
    mask = F.xxhash64(F.pmod("s", F.lit(HEADS)))
    drawn = F.min(F.col("fp").bitwiseXOR(mask)).bitwiseXOR(F.first(mask))
    heads = rows.groupBy("s").agg(drawn.alias("head"), F.count("*").alias("k")).where("k > 1").drop("k")
    shared, shared_at = stored(rows.join(heads, "s"))
    removed(spark, whole_at)
    of = lambda side: lambda name: F.col(f"{side}.{name}")

    # sets of one fingerprint, and of fingerprints that the index links, meet in the smallest of them
    by_sim = some.groupBy("sim").agg(F.min("fp").alias("first"))
    links = fingerprint_edges(by_sim.select(F.col("sim").alias("fp")), BITS)
    same = some.join(by_sim, "sim").select(F.col("fp").alias("a"), F.col("first").alias("b"))
    near = links.join(by_sim.select(F.col("sim").alias("a"), F.col("first").alias("x")), "a").join(by_sim.select(F.col("sim").alias("b"), F.col("first").alias("y")), "b").select("x", "y")
    both = shared.select(F.col("fp").alias("a"), F.col("head").alias("b")).union(same).union(near).where("a <> b")
    both = both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    both = both.join(facts.alias("x"), F.col("a") == F.col("x.fp")).join(facts.alias("y"), F.col("b") == F.col("y.fp")).where(within_reach(of("x"), of("y"), least))
    linked = durable(alike(both.select("a", "b"), some, texts, least, width))

    groups = durable(connected(linked))
    known = shared.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("s", "fp", F.coalesce("component", "fp").alias("g"))
    apart = known.groupBy("s").agg(F.min("g").alias("x"), F.max("g").alias("y")).where("x < y").select("s")
    met, met_at = stored(known.join(apart, "s").join(facts, "fp"))
    removed(spark, shared_at)
    # both sides read one exchange, and the condition is part of the join: pairs out of reach never become rows
    x, y = of("x"), of("y")
    meets = (x("s") == y("s")) & (x("fp") < y("fp")) & (x("g") != y("g")) & within_reach(x, y, least)
    pairs = durable(met.alias("x").join(met.alias("y"), meets).select(x("fp").alias("a"), y("fp").alias("b")).distinct())
    removed(spark, met_at)
    rest = durable(alike(pairs, some, texts, least, width))
    removed(spark, some_at)
    # the groups found so far are stars, to which the rest is added
    return groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest)


def groups_of_copies(df: DataFrame, least: float = LEAST, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp, component_id, root) of every row."""
    sets, path = stored(shingle_sets(df, least, width, id_col, text_col))
    names, _ = stored(sets.select(id_col, "fp"))
    edges = alike_edges(sets, _texts(df, text_col=text_col), least, width)
    removed(df.sparkSession, path)
    return in_groups(names, connected(edges), id_col)


def near_copies(df: DataFrame, least: float = LEAST, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp, component_id) of every row, as simhash.near_duplicates() has them, by links of alike shingle sets.

    Null and empty texts share the empty set; repeated rows are kept, null ids name no component unless it has no
    other; an empty table gives no rows; other columns are left out.
    """
    return groups_of_copies(df, least, width, id_col, text_col).drop("root")


def keep_one(df: DataFrame, least: float = LEAST, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df that stand for their group of near copies, chosen as by simhash.keep_one()."""

    @F.pandas_udf("long")
    def code(texts: pd.Series) -> pd.Series:
        return pd.Series([vertex(shingles(t, width)) for t in texts], dtype="int64")

    return stand_ins(df, groups_of_copies(df, least, width, id_col, text_col), code, id_col, text_col)
