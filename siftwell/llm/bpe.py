"""BPE encoding and decoding with a public word-level vocabulary file.

The file is a `tokenizers` JSON whose pre-tokenizer splits words, whose alphabet is byte-level and whose
words end in a suffix. Encoding merges a word's symbols by a priority queue of merge ranks over a doubly
linked symbol list: a popped entry that no longer describes the list is stale and skipped. Decoding
concatenates vocabulary strings with the blanks that a file without decoder puts between them.

Words repeat, so whole columns are encoded by distinct chunk: Arrow splits a slice of texts at white
space and numbers the distinct chunks; each is encoded once and remembered in a bounded cache.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEPT, gathered, in_arrow

#: Entries of a Python worker's cache of chunks and words; a full cache is kept until the next one is full.
CACHE = 60_000
#: Punctuation that is a word of its own behind a word of letters.
_MARKS = frozenset(".,;:!?")
#: Words of more symbols than this are never merged by the array form.
ARRAY_SYMBOLS = 24
#: Words that the array form merges at once.
ROWS = 4096
_INF = np.int32(2**31 - 1)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: its own where printable, else 256 and upwards."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class PairTable:
    """Vector lookup of symbol pairs: two hash tables, the second for the pairs that collide in the first."""

    def __init__(self, pairs: dict[int, tuple[int, int]]):
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        self.bits = 19
        one, rest = self._fill(keys, values, 0x9E3779B97F4A7C15)
        two, left = self._fill(keys[rest], values[rest], 0xC2B2AE3D27D4EB4F)
        self.tables = [one, two]
        self.left = {int(k): tuple(v) for k, v in zip(keys[rest][left], values[rest][left])}

    def _slots(self, keys: np.ndarray, factor: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(factor)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _fill(self, keys, values, factor):
        own = np.full(1 << self.bits, -1, np.int64)
        data = np.full((1 << self.bits, 2), _INF, np.int32)
        at = self._slots(keys, factor)
        _, first = np.unique(at, return_index=True)
        own[at[first]], data[at[first]] = keys[first], values[first]
        rest = np.ones(len(keys), bool)
        rest[first] = False
        return (own, data, factor), np.flatnonzero(rest)

    def ranks(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (the largest integer if none) and merged symbol of each pair."""
        rank, new = np.full(keys.shape, _INF, np.int32), np.zeros(keys.shape, np.int32)
        for own, data, factor in self.tables:
            at = self._slots(keys, factor)
            hit = own[at] == keys
            found = data[at[hit]]
            rank[hit], new[hit] = found[:, 0], found[:, 1]
        for key, (r, n) in self.left.items():
            rank[keys == key], new[keys == key] = r, n
        return rank, new


class WordBpe:
    """Vocabulary, merges and caches of one file in one Python process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max(*vocab.values(), *self.special.values()))
        for token, i in (*vocab.items(), *self.special.items()):
            self.tokens[i] = token
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {vocab[a] << 20 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.final = [vocab[c + self.suffix] for c in alphabet]
        self.words = regex.compile(next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.before: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}  # ids of words, and of chunks: a chunk that is a word has that word's ids

    @functools.cached_property
    def pairs(self) -> PairTable:
        return PairTable(self.merges)

    def symbols(self, word: str) -> list[int]:
        raw = word.encode()
        return [*map(self.inner.__getitem__, raw[:-1]), self.final[raw[-1]]]

    def merge(self, sym: list[int]) -> list[int]:
        """One word's symbols merged in the order of rank, then of place."""
        n, get = len(sym), self.merges.get
        after, before, queue = list(range(1, n + 1)), list(range(-1, n - 1)), []
        for i in range(n - 1):
            if found := get(sym[i] << 20 | sym[i + 1]):
                queue.append((found[0], i, found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, new = heapq.heappop(queue)
            if sym[i] < 0 or (j := after[i]) >= n or (found := get(sym[i] << 20 | sym[j])) is None or found[1] != new:
                continue  # stale: one of the two has been merged meanwhile
            sym[i], sym[j], after[i] = new, -1, after[j]
            if (k := after[j]) < n:
                before[k] = i
                if found := get(new << 20 | sym[k]):
                    heapq.heappush(queue, (found[0], i, found[1]))
            if (h := before[i]) >= 0 and (found := get(sym[h] << 20 | new)):
                heapq.heappush(queue, (found[0], h, found[1]))
        return [s for s in sym if s >= 0]

    def merge_many(self, words: list[str]) -> list[bytes]:
        """The ids of many words at once, by array steps: each step merges every word's best pair."""
        out: list[bytes] = [b""] * len(words)
        raws = [w.encode() for w in words]
        by_length: dict[int, list[int]] = {}
        for i, raw in enumerate(raws):
            by_length.setdefault(len(raw), []).append(i)
        inner, final = np.array(self.inner, np.int64), np.array(self.final, np.int64)

        def give(rows: np.ndarray, sym: np.ndarray) -> None:
            data, size = sym.astype("<u4").tobytes(), 4 * sym.shape[1]
            for k, i in enumerate(rows.tolist()):
                out[i] = data[k * size : (k + 1) * size]

        for length, members in ((n, g[at : at + ROWS]) for n, g in by_length.items() for at in range(0, len(g), ROWS)):
            if length > ARRAY_SYMBOLS:
                for i in members:
                    out[i] = array("I", self.merge(self.symbols(words[i]))).tobytes()
                continue
            byte = np.frombuffer(b"".join([raws[i] for i in members]), np.uint8).reshape(-1, length)
            rows, sym, width = np.array(members), inner[byte], length
            sym[:, -1] = final[byte[:, -1]]
            while len(rows) and width > 1:
                rank, new = self.pairs.ranks(sym[:, :-1] << 20 | sym[:, 1:])
                best = rank.argmin(axis=1)
                at = np.arange(len(rows))
                live = rank[at, best] < _INF
                give(rows[~live], sym[~live])
                rows, sym, best, new = rows[live], sym[live], best[live, None], new[at[live], best[live]]
                place = np.arange(width - 1)
                merged = np.take_along_axis(sym, place + (place > best), axis=1)
                merged[np.arange(len(rows)), best[:, 0]] = new
                sym, width = merged, width - 1
            give(rows, sym)
        return out

    def pretokens(self, piece: str) -> list[str]:
        lower = piece.lower() if "Σ" not in piece else "".join(c.lower() for c in piece)
        if lower.isalpha():
            return [lower]
        if lower[-1:] in _MARKS and lower[:-1].isalpha():
            return [lower[:-1], lower[-1]]
        return self.words.findall(lower)

    def learn(self, chunks: Iterable[str], arrays: bool) -> None:
        """Puts chunks (of no white space) and their words into the cache."""
        if len(self.known) > CACHE:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        asked = [c for c in chunks if c not in known]
        known.update((c, before[c]) for c in asked if c in before)
        missing = [c for c in asked if c not in before]
        split = [*map(self.pretokens, missing)]
        fresh = {w for ws in split for w in ws if w not in known}
        known.update((w, before[w]) for w in fresh if w in before)
        fresh = [w for w in fresh if w not in before]
        if arrays:
            known.update(zip(fresh, self.merge_many(fresh)))
        else:
            known.update((w, array("I", self.merge(self.symbols(w))).tobytes()) for w in fresh)
        known.update((c, known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])) for c, ws in zip(missing, split))

    def plain(self, text: str) -> bool:
        """Whether white space cuts the text into chunks that can be encoded by themselves."""
        return "<|" not in text and (text.isascii() or unicodedata.is_normalized("NFC", text)) and not any(c in text for c in "\x1c\x1d\x1e\x1f")

    def encode_odd(self, text: str, arrays: bool) -> np.ndarray:
        out = []
        for piece in self.cut.split(text) if self.cut else [text]:
            if piece in self.special:
                out.append(self.special[piece].to_bytes(4, "little"))
                continue
            for chunk in regex.split(r"\s+", unicodedata.normalize("NFC", piece)):
                if chunk:
                    self.learn([chunk], arrays)
                    out.append(self.known[chunk])
        return np.frombuffer(b"".join(out), "<u4")

    def encode_column(self, texts: list[str], arrays: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        plain = [self.plain(t) for t in texts]
        parts = pc.utf8_split_whitespace(pa.array([t if p else "" for t, p in zip(texts, plain)], pa.large_string()))
        coded = parts.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        self.learn(chunks, arrays)
        packed = [*map(self.known.__getitem__, chunks)]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
        starts = np.concatenate([[0], np.cumsum(sizes)])
        flat = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(packed), "<i4")))
        ids = flat.take(coded.indices).flatten().to_numpy().view("<u4")
        ends = np.concatenate([[0], np.cumsum(sizes[coded.indices.to_numpy()])]) if len(packed) else np.zeros(1, np.int64)
        cuts = ends[parts.offsets.to_numpy()]
        counts = np.diff(cuts)
        if all(plain):
            return ids, counts
        docs = [ids[a:b] if p else self.encode_odd(t, arrays) for t, p, a, b in zip(texts, plain, cuts[:-1], cuts[1:])]
        return np.concatenate(docs), np.array([len(d) for d in docs], np.int64)

    def encode(self, text: str) -> list[int]:
        return self.encode_column([text])[0].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """One per Python worker: workers are reused, so the caches outlive a task."""
    return WordBpe(path)


KEPT["bpe"] = load.cache_clear


def bpe_round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text: (id_col, ids array<int>, decoded string).

    A null text counts as empty and has no ids; null or repeated ids are kept as they are, row by row;
    other columns are left out. No shuffle.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in gathered(batches):
            ids, counts = bpe.encode_column(b.column(1).to_pylist())
            ends = np.cumsum(counts)
            text = [bpe.decode(ids[e - n : e].tolist()) for n, e in zip(counts.tolist(), ends.tolist())]
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))), pa.array(text, pa.string())], names=[id_col, "ids", "decoded"])

    return in_arrow(_source(df, id_col, text_col), run, f"`{id_col}` {kind}, ids array<int>, decoded string", keep="bpe")


def bpe_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bpe_round_trip() with its ids and text reduced to digests inside the task, so that they never travel."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in gathered(batches):
            ids, counts = bpe.encode_column(b.column(1).to_pylist())
            ends, of_ids, of_text = np.cumsum(counts), [], []
            for n, e in zip(counts.tolist(), ends.tolist()):
                own = ids[e - n : e]
                of_ids.append(hashlib.sha256(own.tobytes()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(own.tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_arrow(_source(df, id_col, text_col), run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", keep="bpe")


def _source(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
