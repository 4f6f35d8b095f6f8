"""Packing of token streams into sequences, in document order, by dynamic programming.

The documents of a partition form one stream of ids, each document ended by one id. Windows of at most
`size` ids are cut from it. Cuts may fall at document ends (free), at sentence ends (a small penalty) and,
in stretches without either, at fixed steps (a larger one). The cost of a window is its padding: up to
`size`, or none if its length is a power of two. With P a cut's position the best cost of a stream that
ends in cut j is

    f(j) = penalty(j) + min over cuts i with P(j) - P(i) <= size of f(i) + P(i) + size - P(j),

a minimum over a sliding window of f(i) + P(i), which a monotone queue gives in constant time; windows of
a power of two are looked up by position. The stream is solved in blocks; the last windows of a block are
solved anew with the next one, so that memory is bounded and block borders cost nothing.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import _source, load
from .common import SLICE_BYTES, gathered, in_arrow, trimmed

SENTENCE, HARD, TAIL = 16.0, 256.0, 64.0
#: Ids of a block, and the longest stretch without a cut, in ids.
BLOCK, STEP = 1 << 18, 512


def best_cuts(places: list[int], penalty: list[float], size: int) -> list[int]:
    """Indices of the places (ascending, from 0; neighbours at most size apart) at which the best windows end."""
    m = len(places)
    cost, back = [0.0] * m, [0] * m
    # windows of a power of two: (end, start) of the few places that are such a distance apart
    at = np.array(places)
    ends, starts = [], []
    for w in (1 << k for k in range(8, size.bit_length()) if 1 << k <= size):
        found = np.searchsorted(at, at - w)
        hit = np.flatnonzero(at[found] == at - w)
        ends.append(hit)
        starts.append(found[hit])
    end, start = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(end, kind="stable")
    end, start, next_hit = [*end[order].tolist(), m], start[order].tolist(), 0
    queue, key = deque([0]), [0.0] * m
    for j in range(1, m):
        p = places[j]
        while places[queue[0]] < p - size:
            queue.popleft()
        i = queue[0]
        best = key[i] + size - p
        while end[next_hit] == j:
            k = start[next_hit]
            if cost[k] < best:
                best, i = cost[k], k
            next_hit += 1
        cost[j], back[j] = best + penalty[j], i
        own = key[j] = cost[j] + p
        while queue and key[queue[-1]] >= own:
            queue.pop()
        queue.append(j)
    cuts, j = [], m - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


class Packer:
    """One stream: takes documents, gives pieces (doc, first, ids, document's ids, sequence, offset)."""

    def __init__(self, size: int, ends: np.ndarray, base: int):
        self.size, self.ends, self.sequence = size, ends, base
        self.docs: list[list] = []  # id, ids in all, place of the first of those left, ids left
        self.held = 0

    def add(self, doc, ids: np.ndarray) -> None:
        self.docs.append([doc, len(ids), 0, ids])
        self.held += len(ids)

    def solve(self, last: bool) -> list[int]:
        """Lengths of the windows that are final."""
        stream = np.concatenate([d[3] for d in self.docs])
        total = len(stream)
        sentence = np.flatnonzero(np.isin(stream, self.ends)) + 1
        doc_ends = np.cumsum([len(d[3]) for d in self.docs])
        places = np.union1d(sentence, np.concatenate([[0], doc_ends]))
        gaps = np.diff(places)
        fill = [np.arange(a + STEP, b, STEP) for a, b in zip(places[:-1][gaps > STEP].tolist(), places[1:][gaps > STEP].tolist())]
        hard = np.concatenate(fill) if fill else np.zeros(0, np.int64)
        at = np.union1d(places, hard)
        # a document's end is free, a sentence's costs little, any other place much
        penalty = np.where(np.isin(at, sentence), SENTENCE, HARD)
        penalty[np.isin(at, doc_ends)] = 0.0
        at = at.tolist()
        cuts = [at[i] for i in best_cuts(at, penalty.tolist(), self.size)]
        sizes = np.diff([0, *cuts]).tolist()
        if last:
            tail = sizes.pop()
            if tail & (tail - 1) and (tail.bit_count() - 1) * TAIL < self.size - tail:
                sizes += [1 << k for k in range(tail.bit_length() - 1, -1, -1) if tail >> k & 1]
            else:
                sizes.append(tail)
            return sizes
        while sizes and sum(sizes) > total - 2 * self.size:
            sizes.pop()
        return sizes

    def flush(self, last: bool) -> Iterator[tuple]:
        if not self.held:
            return
        at = 0
        for length in self.solve(last):
            offset = 0
            while offset < length:
                doc, total, first, ids = self.docs[at]
                n = min(len(ids), length - offset)
                yield doc, first, ids[:n], total, self.sequence, offset
                offset += n
                if n == len(ids):
                    at += 1
                else:
                    self.docs[at] = [doc, total, first + n, ids[n:]]
            self.held -= length
            self.sequence += 1
        del self.docs[:at]


def pack_documents(df: DataFrame, path: str, size: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Rows of pieces: id_col, start, length, ids (unless with_ids is false), ids_crc32, doc_tokens, sequence_id, offset.

    Each partition is packed as it stands, in the order of its rows, without a shuffle; a sequence number
    holds its partition's number in the upper bits. A null text counts as empty (its piece is the end id
    alone). Null and repeated document ids are kept: every row is a document of its own. An empty table
    gives no rows. Other columns are left out. Ids are those of the vocabulary file at `path`.
    """
    kind = df.schema[id_col].dataType.simpleString()
    column = "ids array<int>, " if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        ends = np.array([bpe.final[b] for b in b".!?;"], np.uint32)
        packer = Packer(size, ends, TaskContext.get().partitionId() << 33)

        def give(last: bool) -> Iterator[pa.RecordBatch]:
            rows = list(packer.flush(last))
            if not rows:
                return
            doc, first, ids, total, sequence, offset = zip(*rows)
            numbers = [pa.array(first, pa.int64()), pa.array(map(len, ids), pa.int64())]
            if with_ids:
                numbers.append(pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())))
            numbers += [pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()), pa.array(total, pa.int64()), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            names = [id_col, "start", "length", *["ids"] * with_ids, "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(doc, batch.column(0).type), *numbers], names=names)

        batch = None
        # where ids are given out, the pipeline's other stages have filled the executor before: small slices then
        for batch in trimmed(gathered(batches, most=SLICE_BYTES // 4)) if with_ids else gathered(batches, most=SLICE_BYTES * 4):
            ids, counts = bpe.encode_column(batch.column(1).to_pylist(), arrays=True)
            end = 0
            for doc, n in zip(batch.column(0).to_pylist(), counts.tolist()):
                packer.add(doc, np.append(ids[end : end + n], np.uint32(end_id)))
                end += n
                if packer.held >= BLOCK:
                    yield from give(False)
        if batch is not None:
            yield from give(True)

    return in_arrow(_source(df, id_col, text_col), run, f"`{id_col}` {kind}, start long, length long, {column}ids_crc32 long, doc_tokens long, sequence_id long, offset long", keep="bpe")
