"""SpotSigs document fingerprints.

Signatures start at anchors, very common words: an anchor and the chain of the next content words (words
that are no anchors) behind it. A document's fingerprint lists its set of signatures, as sorted 32-bit hashes, so the
likeness of two documents can be had from their fingerprints alone (`members`, `jaccard`). Sets are compared by
Jaccard likeness; they are partitioned by length, sets whose lengths alone keep the likeness below the wanted one
are never compared, and a comparison stops once the rest of the lists can no longer reach it.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, in_arrow, shuffle_partitions, slices

# Common words of English, French, German and Spanish.
ANCHORS = frozenset(
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au de des du en est et la le les par pour que qui sur un une "
    "als auf das dem den der die ein eine im ist mit nicht und von zu "
    "con del el es los las no o por se su una y".split()
)
_WORD = regex.compile(r"[\p{L}\p{N}]+")
CHAIN = 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Hash of each word, lowest bit set for anchors; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word, 1) & ~1 | (word in ANCHORS)
        self[word] = h
        return h


@functools.cache
def _hashes() -> _Hashes:
    return _Hashes()


def signatures(text: str, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct signature hashes (uint32). A text without any has one, made of all its words."""
    words = _WORD.findall(text.lower())
    h = np.fromiter(map(_hashes().__getitem__, words), np.uint64, len(words))
    anchor = (h & np.uint64(1)).astype(bool)
    content = np.flatnonzero(~anchor)
    at = np.flatnonzero(anchor)
    first = np.searchsorted(content, at)
    whole = first + chain <= len(content)
    at, first = at[whole], first[whole]
    if not len(at):
        sig = np.array([xxhash.xxh64_intdigest(text if not words else " ".join(words), 2)], np.uint64)
    else:
        sig = h[at]
        for i in range(chain):
            sig = (sig ^ (sig >> np.uint64(29))) * _MIX + h[content[first + i]]
    return np.unique((sig >> np.uint64(32)).astype(np.uint32))


def digest(sig: np.ndarray) -> str:
    """Fingerprint of a signature set: its members, 4 bytes each, in base64."""
    return base64.b64encode(sig.astype("<u4").tobytes()).decode()


def members(fingerprint: str) -> np.ndarray:
    """The signature set of a fingerprint."""
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0, block: int = 256) -> float:
    """Likeness of two sorted sets; 0 if it is below `least`, found as soon as the lengths or the members left tell."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or len(small) < least * len(large) - 1e-9:
        return 0.0
    common, both = 0, len(a) + len(b)
    step = block if least else len(small)
    for at in range(0, len(small), step):
        most = common + len(small) - at
        if most < least * (both - most) - 1e-9:
            return 0.0
        part = small[at : at + step]
        place = np.searchsorted(large, part)
        common += int((large[np.minimum(place, len(large) - 1)] == part).sum())
    found = common / (both - common)
    return found if found >= least - 1e-9 else 0.0


def edited(text: str, other: str) -> str:
    """The last third of text replaced by the start of the other, of as many characters if it has them."""
    n = len(text) // 3
    return text[: len(text) - n] + other[:n]


def spot_signatures(df: DataFrame, chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, sigs array<long>, fingerprint string) of every row; a null text counts as empty, null and repeated ids are kept."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sigs = [signatures(t, chain) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.astype(np.int64) for s in sigs], pa.list_(pa.int64())), pa.array(map(digest, sigs), pa.string())], names=[id_col, "sigs", "fingerprint"])

    source = df.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return in_arrow(source, run, f"`{id_col}` {kind}, sigs array<long>, fingerprint string")


def similar_fingerprints(marked: DataFrame, least: float = 0.8) -> DataFrame:
    """Pairs (a, b, likeness) of different fingerprints of spot_signatures() that are alike to `least` or more.

    Sets are partitioned by length: a set of n members only meets sets of least * n to n / least members.
    Within reach, two sets must share one of their first n - ceil(least * n) + 1 members in hash order, so
    only those are joined, and each pair is then compared once with its members. Equal fingerprints are one
    vertex. An empty table gives no pairs.
    """
    sets = marked.groupBy("fingerprint").agg(F.min("sigs").alias("sigs"))
    sets = sets.select("fingerprint", "sigs", F.size("sigs").alias("n"))
    lead = F.col("n") - F.ceil(F.col("n") * F.lit(least) - F.lit(1e-9)) + 1
    heads = sets.select("fingerprint", "n", F.explode(F.slice("sigs", F.lit(1), lead.cast("int"))).alias("s"))
    bucket = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / least)))
    # a bucket of lengths meets itself and the next longer one
    left = heads.select("s", F.col("fingerprint").alias("a"), F.col("n").alias("na"), bucket.alias("k"))
    right = heads.select("s", F.col("fingerprint").alias("b"), F.col("n").alias("nb"), F.explode(F.array(bucket, bucket - 1)).alias("k"))
    near = (F.col("na") <= F.col("nb")) & (F.col("na") >= F.lit(least) * F.col("nb") - 1e-9) & ((F.col("na") < F.col("nb")) | (F.col("a") < F.col("b")))
    pairs = left.join(right, ["s", "k"]).where(near).select("a", "b").distinct()
    both = pairs.join(sets.select(F.col("fingerprint").alias("a"), F.col("sigs").alias("x")), "a").join(sets.select(F.col("fingerprint").alias("b"), F.col("sigs").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    likeness = common / (F.size("x") + F.size("y") - common)
    return both.select("a", "b", likeness.alias("likeness")).where(F.col("likeness") >= least)


def in_order(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (bucket, ghost, id, text), sorted in each partition such that every row with ghost 0 stands before its successor.

    The order is by id, descending, null ids last, then by a hash of the text; the first row follows the
    last. Buckets are ranges of that order, one for each shuffle partition, so rows of one id (or of none) are spread
    like others; a bucket's first row is repeated behind the bucket before it as a ghost. The ranges are found on ids
    and hashes alone and take one row a bucket on the driver; texts are shuffled once, compressed (zstd).
    """
    n = shuffle_partitions(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", F.bitwise_not(F.coalesce("id", F.lit(-(1 << 63)))).alias("key"), F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))
    ranged = rows.select("key", "h").repartitionByRange(n, "key", "h")
    firsts = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("key", "h")).alias("first")).select("first.*").collect()
    starts = np.array(sorted((r["key"], r["h"]) for r in firsts), np.int64).reshape(-1, 2)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches, text=3):
            key, h = (b.column(i).to_numpy() for i in (1, 2))
            low, high = (np.searchsorted(starts[:, 0], key, side) for side in ("left", "right"))
            own = high - 1
            for i in np.flatnonzero(low < high).tolist():  # ids that open a bucket, or several
                own[i] = low[i] + np.searchsorted(starts[low[i] : high[i], 1], h[i], "right") - 1
            opens = np.flatnonzero((starts[own] == np.stack([key, h], axis=1)).all(axis=1))
            take = np.concatenate([np.arange(len(own)), opens])
            bucket = np.concatenate([own, (own[opens] - 1) % len(starts)])
            ghost = np.repeat(np.array([0, 1], np.int32), [len(own), len(opens)])
            packed = pa.array(map(pack, b.column(3).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(ghost), *(c.take(pa.array(take)) for c in (b.column(1), b.column(2), b.column(0), packed))], names=["bucket", "ghost", "key", "h", "id", "text"])

    dealt = in_arrow(rows, deal, "bucket int, ghost int, key long, h long, id long, text binary")
    return dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "ghost", "key", "h").select("bucket", "ghost", "id", "text")


def edited_fingerprints(df: DataFrame, chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Every text's fingerprint, that of its edited text, and how alike they and the next document's are.

    (id_col, n_chars, edited unless with_text is false, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next). The edited text has its last third replaced by the start of the next document
    in the order of in_order(). Both likenesses are exact, however low, so no length or member rules them out here.
    Null texts count as empty; equal texts have equal fingerprints and a likeness of 1. Repeated rows follow each
    other; a single row follows itself; null ids come last. An empty table gives no rows; other columns are left out.
    """
    names = [id_col, "n_chars", *["edited"] * with_text, "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), *[pa.string()] * (3 + with_text), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        before = None  # bucket, ghost, id, text, signatures
        for b in slices(batches, text=3, most=SLICE_BYTES // 4):
            out: list[tuple] = []
            for bucket, ghost, id_, packed in zip(*(c.to_pylist() for c in b.columns)):
                text = unpack(packed).decode()
                sig = signatures(text, chain)
                if before and before[0] == bucket and not before[1]:
                    _, _, own, mine, its = before
                    new = edited(mine, text)
                    new_sig = signatures(new, chain) if new != mine else its
                    row = (hashlib.sha256(new.encode()).hexdigest(), digest(its), digest(new_sig), jaccard(its, new_sig), jaccard(its, sig))
                    out.append((own, len(mine), new, *row) if with_text else (own, len(mine), *row))
                before = bucket, ghost, id_, text, sig
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    text_field = "edited string, " if with_text else ""
    schema = f"`{id_col}` long, n_chars long, {text_field}edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_arrow(in_order(df, id_col, text_col), run, schema)
