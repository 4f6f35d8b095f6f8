"""Fill-in-middle: texts cut into prefix, middle and suffix, rearranged for training and rebuilt exactly.

Cuts are given in code points, texts are bytes. Of each batch of texts one packed bitvector marks the bytes that start
a code point; a directory holds the popcount before each block of words. The rank of a text's end less that of its start
is its number n of code points, and a select on the ranks of the two cuts gives the bytes to cut at, for all texts of
the batch at once, whatever their lengths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_arrow, slices

#: What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Words of 64 bits in a block of the directory.
BLOCK = 8


class BitVector:
    """A packed bitvector with ranks and selects: words of 64 bits, and the popcount before each block of BLOCK words."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        words = -(-len(packed) // (8 * BLOCK)) * BLOCK
        self.words = np.zeros(words + BLOCK, "<u8")  # a block of zeros at the end: ranks of the very end need no test
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.words).reshape(-1, BLOCK).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones.sum(axis=1))])
        self.within = np.cumsum(ones, axis=1) - ones

    @property
    def total(self) -> int:
        return int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each bit."""
        word, bit = np.divmod(np.asarray(at, np.int64), 64)
        block, place = np.divmod(word, BLOCK)
        low = self.words[word] & ((np.uint64(1) << bit.astype(np.uint64)) - np.uint64(1))
        return self.before[block] + self.within[block, place] + np.bitwise_count(low)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The bit of the k-th one, from 0; k below total."""
        k = np.asarray(k, np.int64)
        block = np.searchsorted(self.before, k, side="right") - 1
        left = k - self.before[block]
        place = (self.within[block] <= left[:, None]).sum(axis=1) - 1
        left = left - self.within[block, place]
        word = self.words[block * BLOCK + place]
        at = np.zeros(len(k), np.int64)
        for half in (32, 16, 8, 4, 2, 1):  # the half of the word that holds it, then the half of that
            low = word & ((np.uint64(1) << np.uint64(half)) - np.uint64(1))
            ones = np.bitwise_count(low).astype(np.int64)
            up = left >= ones
            left = np.where(up, left - ones, left)
            word = np.where(up, word >> np.uint64(half), low)
            at += np.where(up, half, 0)
        return (block * BLOCK + place) * 64 + at


def draws(ids: list, seed: int) -> np.ndarray:
    """Four unsigned 32-bit numbers for each id: the first groups of the hex sha256 of `seed:id`; a null id counts as empty."""
    heads = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(heads), ">u4").reshape(-1, 4).astype(np.int64)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column as one array, and where each text starts and (last) ends; null texts are empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, "<i8")[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, at - at[0]


def fill_in_middle(
    df: DataFrame, plain: int = 90, spm: int = 20, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", out_col: str = "fim_text", keep_text: bool = True
) -> DataFrame:
    """df with five columns more: n (code points of the text), form, prefix_chars, middle_chars and out_col, the text rearranged.

    Four numbers drawn from `seed` and the id decide: cuts after the smaller and the larger of h1 % (n + 1) and
    h2 % (n + 1) code points; form plain from h3 % 100 = `plain` on, else spm below h4 % 100 = `spm`, else psm. A text that
    is null, empty or holds one of the three marks stays plain, with null chars; then out_col is the text, empty for null.
    Rows are independent: repeated ids draw the same numbers and null ids those of an empty id. Columns of df of the
    names added are replaced; all others stay, whatever their names (without the text itself unless `keep_text`). An
    empty table gives no rows.
    """
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    more = T.StructType([
        T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField(out_col, T.StringType()),
    ])
    added = {c.lower() for c in more.names}
    kept = [f for f in df.schema.fields if f.name.lower() not in added and (keep_text or f.name.lower() != text_col.lower())]
    width = len(kept)
    names = [f.name for f in kept]
    # columns go by their places, as names may hold anything
    plain_names = [f"c{i}" for i in range(width + len(more))]
    own = [F.col(f"`{n}`").alias(c) for n, c in zip(names, plain_names)]
    given = df.select(*own, F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(plain_names, [*kept, *more.fields])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text=width + 1):
            ids, (data, at) = b.column(width).to_pylist(), _texts(b.column(width + 1))
            starts = BitVector((data & 0xC0) != 0x80)
            first = starts.rank(at)
            n = np.diff(first)
            h = draws(ids, seed)
            cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
            # the byte of a cut: select of its rank, or the end of all bytes, which no code point starts
            ranks = first[:-1, None] + cuts
            ends = np.full(ranks.shape, len(data), np.int64)
            inner = ranks < starts.total
            ends[inner] = starts.select(ranks[inner])
            form, out, held = [], [], data.tobytes()
            for i in range(b.num_rows):
                text = held[at[i] : at[i + 1]]
                if not text or h[i, 2] % 100 >= plain or any(m in text for m in marks):
                    form.append("plain")
                    out.append(text)
                    continue
                p, m, s = held[at[i] : ends[i, 0]], held[ends[i, 0] : ends[i, 1]], held[ends[i, 1] : at[i + 1]]
                as_spm = h[i, 3] % 100 < spm
                form.append("spm" if as_spm else "psm")
                parts = [marks[1], s, marks[0], p] if as_spm else [marks[0], p, marks[1], s]
                out.append(b"".join([*parts, marks[2], m]))
            cut = np.array([f == "plain" for f in form], bool)
            chars = [pa.array(x, pa.int64(), mask=cut) for x in (cuts[:, 0], cuts[:, 1] - cuts[:, 0])]
            made = [pa.array(n, pa.int64()), pa.array(form, pa.string()), *chars, pa.array(out, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[:width], *made], names=plain_names)

    return in_arrow(given, run, schema).toDF(*names, *more.names)


def restored(out: str = "fim_text", form: str = "form") -> Column:
    """The text that a column of rearranged texts was made of, from its form; null if either is null. Needs no Python.

    Marks are found from the left: a cut text holds none of its own, and none can arise over a border, as marks start with
    a character that they hold only there and end with one that they hold only there.
    """
    o = F.col(out)
    after = lambda mark: F.substring(o, F.locate(mark, o) + len(mark), F.length(o))
    # between the first mark, at the start, and the second; between the second and the last
    first = lambda second: F.substring(o, F.lit(len(PREFIX) + 1), F.locate(second, o) - len(PREFIX) - 1)
    inner = lambda second: F.substring(o, F.locate(second, o) + len(second), F.locate(MIDDLE, o) - F.locate(second, o) - len(second))
    psm = F.concat(first(SUFFIX), after(MIDDLE), inner(SUFFIX))
    spm = F.concat(inner(PREFIX), after(MIDDLE), first(PREFIX))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.when(F.col(form).isNotNull(), o))
