"""Removal of repeated passages by suffix arrays.

A byte goes if some string of `width` bytes that covers it also starts earlier: in a document of smaller id,
or earlier in the same one. Strings are judged on the input, and never cross documents.

Equal strings must meet, so they are dealt by content: in every window of `width` bytes the least hash of a
`GRAM`-byte gram names the window's anchor. Neighbouring windows mostly share their anchor and make one
segment. Anchors seen once hold no repeat and are dropped. The segments of the others are hashed, and copies of a
segment are merged by a pre-aggregation (all but the first are repeats as a whole). Two segments count as copies if the
64-bit hashes of their anchors and of their bytes agree, 128 bits in all; bytes are not compared again. The different segments of
an anchor are fetched from their texts and meet in one chunk. There a suffix array decides: suffixes smaller than their
successors are sorted directly, the rest is induced by bucket scans, and neighbours with a common prefix of
`width` bytes are one class, of which the earliest string stays.

Anchors of very many different segments are split further, window by window: windows of one hash are merged like
segments, by a pre-aggregation that keeps the first, and need no suffix array.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import KEPT, SLICE_BYTES, free_name, in_arrow, shuffle_partitions, slices

WIDTH, GRAM = 100, 36
#: Windows of a text that are handled at once; different segments of one anchor that may meet in one chunk; bytes of a chunk.
SLAB, CROWD, CHUNK = 1 << 20, 2000, 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


class _Powers:
    """Powers of the rolling hash's base and of its inverse modulo 2**64, and a random number for each byte."""

    def __init__(self):
        n = SLAB + WIDTH
        self.up, self.down = self._row(_BASE, n), self._row(pow(_BASE, -1, 1 << 64), n)
        self.byte = np.random.default_rng(42).integers(0, 1 << 63, 256, np.uint64)

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        out = np.full(n, base & _MASK, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_powers: list[_Powers] = []
KEPT["sadedup"] = _powers.clear


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window, number of windows) of each run of windows with one anchor."""
    if not _powers:
        _powers.append(_Powers())
    p, windows = _powers[0], len(data) - WIDTH + 1
    keys, firsts, counts = [], [], []
    for at in range(0, windows, SLAB):
        part = data[at : min(len(data), at + SLAB + WIDTH - 1)]
        n, span = len(part), WIDTH - GRAM + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(p.byte[part] * p.down[:n], out=sums[1:])
        h = (sums[GRAM:] - sums[:-GRAM]) * p.up[GRAM - 1 : n]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        # least of `span` neighbours: leftmost on equal hashes, as the place fills the lower bits
        low = np.uint64((1 << 21) - 1)
        value = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        padded = np.full(-(-len(h) // span) * span, ~np.uint64(0))
        padded[: len(h)] = value
        blocks = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        m = n - WIDTH + 1
        place = (np.minimum(behind[:m], ahead[span - 1 : span - 1 + m]) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        keys.append(h[place[first]].view(np.int64))
        firsts.append(first + at)
        counts.append(np.diff(np.append(first, m)))
    if not keys:
        none = np.zeros(0, np.int64)
        return none, none, none
    return np.concatenate(keys), np.concatenate(firsts), np.concatenate(counts)


def words_at(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place as one big-endian number."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | padded[i : i + len(text)].astype(np.uint64)
    return out


def _offsets(width: int) -> list[int]:
    return [*range(0, width - 8, 8), width - 8]


def _word(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(at < len(words), words[np.minimum(at, len(words) - 1)], 0)


def sort_directly(text: np.ndarray, words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Suffixes sorted by their first `width` bytes, by words, ever fewer of them."""
    order = at[np.argsort(words[at], kind="stable")]
    new = np.ones(len(order), bool)
    new[1:] = words[order[1:]] != words[order[:-1]]
    for offset in _offsets(width)[1:]:
        single = new & np.append(new[1:], True)
        tied = np.flatnonzero(~single)
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        key = _word(words, order[tied] + offset)
        by = np.lexsort((key, group))
        order[tied] = order[tied][by]
        key = key[by]
        apart = np.ones(len(tied), bool)
        apart[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        new[tied] = apart
    return order


def suffix_array(text: np.ndarray, words: np.ndarray, width: int) -> np.ndarray:
    """All suffixes in the order of their first `width` bytes at least, in two stages."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = -1  # the end is smaller than any byte
    follow = np.where(step != 0, np.arange(n), n)
    rising = step[np.minimum.accumulate(follow[::-1])[::-1]] > 0  # smaller than its successor
    direct = sort_directly(text, words, np.flatnonzero(rising), width)
    own = text[direct]
    cut = np.searchsorted(own, np.arange(257))
    placed: list[list[np.ndarray]] = [[] for _ in range(256)]
    placed[text[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        falling = np.concatenate(placed[c]) if placed[c] else np.zeros(0, np.int64)
        # a falling suffix of this bucket puts its predecessor, if of the same byte, behind those placed
        runs, front = [falling], falling
        while len(front):
            front = front[front > 0] - 1
            front = front[text[front] == c]
            runs.append(front)
        bucket = np.concatenate([*runs, direct[cut[c] : cut[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > c]
        if len(before):
            byte = text[before]
            by = np.argsort(byte, kind="stable")
            before, byte = before[by], byte[by]
            for part in np.split(before, np.flatnonzero(byte[1:] != byte[:-1]) + 1):
                placed[text[part[0]]].append(part)
    return np.concatenate(out)


def later_windows(segments: list[bytes], documents: np.ndarray, places: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """For each segment (its document's rank and place in it) which of its windows have an equal, earlier one."""
    sizes = np.array([len(s) for s in segments])
    starts = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(segments), np.uint8)
    words = words_at(text)
    counts = sizes - width + 1
    first = np.zeros(len(text), bool)
    owner = np.repeat(np.arange(len(segments)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    first[starts[owner] + inner] = True
    order = suffix_array(text, words, width)
    order = order[first[order]]
    # common prefixes of neighbours: of `width` bytes or less, which is all that counts
    same = np.ones(max(0, len(order) - 1), bool)
    for offset in _offsets(width):
        left = np.flatnonzero(same)
        same[left] = words[order[left] + offset] == words[order[left + 1] + offset]
    begin = np.flatnonzero(np.concatenate([[True], ~same]))
    seg = np.searchsorted(starts, order, side="right") - 1
    rank = documents[seg].astype(np.int64) << 40 | (places[seg] + order - starts[seg])
    least = np.repeat(np.minimum.reduceat(rank, begin), np.diff(np.append(begin, len(order))))
    later = np.zeros(len(text), bool)
    later[order] = rank > least
    return [later[a : a + c] for a, c in zip(starts.tolist(), counts.tolist())]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_zip, _unzip = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _zipped_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle."""
    for b in slices(batches, text=2):
        at = b.schema.get_field_index("text")
        yield b.set_column(at, "text", pa.array(map(_zip.compress, b.column(at).to_pylist()), pa.binary()))


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different anchor keys of each text."""
    for b in slices(batches):
        keys = [anchors(np.frombuffer(text, np.uint8))[0] for text in b.column(1).to_pylist()]
        # a key that a text has twice is sent twice, which is all that counts
        keys = [np.repeat(u, np.minimum(n, 2)) for u, n in (np.unique(k, return_counts=True) for k in keys)]
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys)))], names=["d", "keys"])


def _wanted(text: bytes, keys) -> tuple[np.ndarray, np.ndarray]:
    """Key and place << 8 | windows of the segments whose anchors are among the keys."""
    key, first, count = anchors(np.frombuffer(text, np.uint8))
    keep = np.isin(key, np.asarray(keys, np.int64))
    return key[keep], first[keep] << 8 | count[keep]


def _lists(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of each list element, and the fields of the elements as arrays."""
    values = column.flatten()
    owner = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
    return owner, {f.name: values.field(f.name).to_numpy(zero_copy_only=False) for f in values.type}


def _mark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each wanted segment its place and a hash of its bytes."""
    for b in slices(batches, text=2, most=SLICE_BYTES // 4):
        owner, keys, places, marks = [], [], [], []
        for i, (text, wanted) in enumerate(zip(map(_unzip.decompress, b.column("text").to_pylist()), b.column("keys"))):
            key, packed = _wanted(text, wanted.values.to_numpy())
            digest = xxhash.xxh64_intdigest
            marks.append(np.array([digest(text[x >> 8 : (x >> 8) + (x & 255) + WIDTH - 1]) for x in packed.tolist()], np.uint64).view(np.int64))
            owner.append(np.full(len(key), i))
            keys.append(key)
            places.append(packed)
        arrays = [b.column("d").take(pa.array(np.concatenate(owner))), *(pa.array(np.concatenate(x)) for x in (keys, marks, places))]
        yield pa.RecordBatch.from_arrays(arrays, names=["d", "key", "h", "packed"])


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted segment; of crowded anchors every window as a segment of its own, dealt by its hash."""
    for b in slices(batches, text=2, most=1 << 18):
        owner, of = _lists(b.column("rows"))
        texts = [*map(_unzip.decompress, b.column("text").to_pylist())]
        own, keys, parts, places, out = [], [], [], [], []
        for i, key, packed, n in zip(owner.tolist(), *(of[c].tolist() for c in ("key", "packed", "n"))):
            text, place, size = texts[i], packed >> 8, (packed & 255) + WIDTH - 1
            if n <= CROWD:
                own.append(i)
                keys.append(key)
                parts.append(0)
                places.append(place)
                out.append(text[place : place + size])
                continue
            for at in range(place, place + size - WIDTH + 1):
                window = text[at : at + WIDTH]
                own.append(i)
                keys.append(key)
                parts.append(1 + xxhash.xxh64_intdigest(window) % 65521)
                places.append(at)
                out.append(window)
        for at in range(0, len(own), 20_000):
            cut = slice(at, at + 20_000)
            arrays = [pa.array(keys[cut], pa.int64()), pa.array(parts[cut], pa.int32()), b.column("d").take(pa.array(own[cut], pa.int64())), pa.array(places[cut], pa.int64()), pa.array(out[cut], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "part", "d", "place", "segment"])


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Later windows of the segments of each group (key, part), in chunks of whole groups; rows come sorted by group."""
    held: list[tuple] = []
    size = 0

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        names = sorted({r[2] for r in rows})
        rank = {x: i for i, x in enumerate(names)}
        later = later_windows([r[4] for r in rows], np.array([rank[r[2]] for r in rows]), np.array([r[3] for r in rows], np.int64))
        d, start, stop = [], [], []
        for r, flags in zip(rows, later):
            if flags.any():
                a, b = _runs(flags)
                d += [r[2]] * len(a)
                start += (a + r[3]).tolist()
                stop += (b + r[3] + WIDTH - 1).tolist()
        if d:
            return pa.RecordBatch.from_arrays([pa.array(d, kind), pa.array(start, pa.int64()), pa.array(stop, pa.int64())], names=["d", "start", "stop"])
        return None

    for batch in batches:
        kind = batch.column(2).type
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= CHUNK and row[:2] != held[-1][:2]:
                if (found := solve(held)) is not None:
                    yield found
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held and (found := solve(held)) is not None:
        yield found


def _gone(text: bytes, keys, firsts, spans) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal byte runs that go: segments of repeated anchors that are no firsts, and the later windows of firsts."""
    start, stop = [], []
    if keys is not None:
        packed = _wanted(text, keys)[1]
        copies = packed[~np.isin(packed, np.asarray([] if firsts is None else firsts, np.int64))]
        start.append(copies >> 8)
        stop.append((copies >> 8) + (copies & 255) + WIDTH - 1)
    if spans is not None and len(spans):
        start.append(np.array([s["start"] for s in spans], np.int64))
        stop.append(np.array([s["stop"] for s in spans], np.int64))
    if not sum(map(len, start)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, stop = np.concatenate(start), np.concatenate(stop)
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return start[new], reach[np.append(new[1:], len(start)) - 1]


def _left(text: bytes, start: np.ndarray, stop: np.ndarray) -> bytes:
    return b"".join(text[a:b] for a, b in zip([0, *stop.tolist()], [*start.tolist(), len(text)]))


def _cut(packed: bytes, *marks) -> tuple[bool, str]:
    """Whether a compressed text loses anything, and what is left of it in whole characters."""
    text = _unzip.decompress(packed)
    start, stop = _gone(text, *marks)
    return bool(len(start)), _left(text, start, stop).decode(errors="ignore")


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, most=SLICE_BYTES // 4):
        out = []
        for packed, *marks in zip(*(c.to_pylist() for c in b.columns[1:])):
            text = _unzip.decompress(packed)
            start, stop = _gone(text, *marks)
            kept = _left(text, start, stop) if len(start) else text
            out.append((len(text), int((stop - start).sum()), len(start), [{"start": a, "stop": z} for a, z in zip(start.tolist(), stop.tolist())], hashlib.sha256(kept).hexdigest()))
        n, removed, spans, runs, sha = zip(*out)
        arrays = [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(sha)]
        yield pa.RecordBatch.from_arrays(arrays, names=["__id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])


def document_key(df: DataFrame, id_col: str) -> Column:
    """A column that orders rows as documents: the id, if all ids are there and different, else id, then text, null ids last."""
    twice = df.groupBy(id_col).agg(F.count("*").alias("n")).where(F.col("n").__gt__(1) | F.col(id_col).isNull())
    if twice.isEmpty():
        return F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    place = F.lpad((F.col(id_col).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat(F.coalesce(place, F.lit("~")), F.md5("text"))


def later_of_crowded(windows: DataFrame) -> DataFrame:
    """(d, start, stop) of the windows (key, d, place, segment) that have an equal, earlier one.

    Equal windows of an anchor meet as partial minima, and each document then tells its firsts from its others,
    so no task holds a group.
    """
    hashed = windows.select("key", F.xxhash64("segment").alias("h"), "d", "place")
    first = hashed.groupBy("key", "h").agg(F.min(F.struct("d", "place")).alias("first")).select("first.d", "first.place", F.lit(1).alias("one"))
    told = hashed.select("d", "place", F.lit(0).alias("one")).union(first).groupBy("d", "place").agg(F.max("one").alias("one"))
    return told.where("one = 0").select("d", F.col("place").alias("start"), (F.col("place") + WIDTH).alias("stop"))


def repeats(texts: DataFrame, more: list) -> DataFrame:
    """Rows (d, text compressed, *more, keys, firsts, spans) from texts (d, text, *more): what _gone() needs to tell the bytes that go."""
    n = shuffle_partitions(texts.sparkSession)
    kind = texts.schema["d"].dataType.simpleString()
    rows = in_arrow(texts.select("d", "text"), _key_rows, f"d {kind}, keys array<long>", keep="sadedup")
    runs = rows.select("d", F.explode("keys").alias("key"))
    often = runs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    wanted = runs.join(often, "key").groupBy("d").agg(F.collect_set("key").alias("keys"))
    # the texts are shuffled once: the three joins below use the same exchange
    docs = in_arrow(texts.select("d", *more, "text"), _zipped_rows, texts.select("d", *more, "text").schema)
    docs = docs.select(F.coalesce("d", F.lit("~" if kind == "string" else 0)).alias("d"), *more, "text")
    # a hash for each segment; copies: the first stands for all, the others are repeats as a whole
    marks = in_arrow(docs.join(wanted, "d").select(*docs.columns, "keys"), _mark_rows, f"d {kind}, key long, h long, packed long", keep="sadedup")
    first = marks.groupBy("key", "h").agg(F.min(F.struct("d", "packed")).alias("first"))
    firsts = first.groupBy(F.col("first.d").alias("d")).agg(F.collect_list("first.packed").alias("firsts"))
    # the bytes of the first ones of anchors that have several different segments
    # (counted by `first`, so that this plan keeps that column and shares the exchange of the others)
    several = first.groupBy("key").agg(F.count("first").alias("n")).where("n > 1")
    rest = first.join(several, "key").groupBy(F.col("first.d").alias("d")).agg(F.collect_list(F.struct("key", "first.packed", "n")).alias("rows"))
    # crowded anchors apart from the others, from one exchange: most corpora have none, and then the second join is empty
    crowded = lambda x: x["n"] > CROWD
    part = lambda keep: in_arrow(docs.join(rest.withColumn("rows", F.filter("rows", keep)).where(F.size("rows") > 0), "d").select(*docs.columns, "rows"), _segment_rows, f"key long, part int, d {kind}, place long, segment binary")
    dealt = part(lambda x: ~crowded(x)).repartition(n, "key", "part").sortWithinPartitions("key", "part", "d", "place")
    later = in_arrow(dealt, _chunk_rows, f"d {kind}, start long, stop long").union(later_of_crowded(part(crowded)))
    spans = later.groupBy("d").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return docs.join(wanted, "d", "left").join(firsts, "d", "left").join(spans, "d", "left")


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with repeated passages taken out of its texts; rows that lose their whole text go.

    Cuts never leave half a character: what is left of one goes too. Null texts stay null; rows of equal id are
    ordered by text, null ids come last; empty tables and columns of any name pass.
    """
    others = [c for c in df.columns if c != text_col]
    rows = df.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"), F.struct(F.col(text_col).isNull().alias(free_name("__null", df.columns)), *others).alias("__row"))
    marked = repeats(rows.select(document_key(rows, "__id").alias("d"), "text", "__row"), ["__row"]).select("__row", "text", "keys", "firsts", "spans")
    columns, place = df.columns, {c: i + 1 for i, c in enumerate(others)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=SLICE_BYTES // 4):
            row, kept, texts = b.column(0), [], []
            for null, marks in zip(row.field(0).to_pylist(), zip(*(c.to_pylist() for c in b.columns[1:]))):
                gone, text = _cut(*marks)
                kept.append(not (gone and text == ""))
                texts.append(None if null else text)
            arrays = [pa.array(texts, pa.string()) if c == text_col else row.field(place[c]) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(kept))

    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == text_col else f.dataType) for f in df.schema])
    return in_arrow(marked, cut, schema, keep="sadedup")


def repeated_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, spans, kept_sha256) of every row; spans are the byte runs to remove.

    A null or empty text has no bytes and loses none; texts of under 100 bytes lose none. Rows of equal id
    are ordered by text; rows of equal id and text are one document and are judged alike. Null ids come
    last in the order and stay null. Other columns are left out; an empty table gives no rows.
    """
    id_kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    marked = repeats(rows.select(document_key(rows, "__id").alias("d"), "text", "__id"), ["__id"]).select("__id", "text", "keys", "firsts", "spans")
    schema = f"__id {id_kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>, kept_sha256 string"
    return in_arrow(marked, _kept_rows, schema, keep="sadedup").withColumnRenamed("__id", id_col)
