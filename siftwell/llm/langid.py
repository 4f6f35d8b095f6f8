"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A word's probability in a
language is the sum over all ways to cut it into pieces, which a forward pass gives; a text's is the
product over its words. Piece probabilities are learned by expectation maximisation over the same
segmentations from a bounded sample of labelled texts.

Words are letter runs with a word-start mark, of any length and as they are written, but for words all in
capitals, which are lowered. Forward passes run as array
steps over all new words of one length and all languages at once; long words are rescaled on the way.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PairTable
from .common import KEPT, SLICE_BYTES, free_name, in_arrow, let_go, slices, trimmed

START = "▁"
#: Chunks that a Python worker remembers, and characters of a word up to which plain products cannot vanish.
CACHE, PLAIN = 200_000, 24
#: Words and characters of a pass over words of one length.
CELLS = 200_000
#: A text is unlike a language if its words' mean log likelihood per character lies over UNLIKE[0] + UNLIKE[1] / sqrt(words) deviations
#: below the usual, and below FLOOR, which spares the few words that a small sample has not seen.
UNLIKE, FLOOR = (2.0, 6.0), -9.0
#: Probability of a character that the vocabulary lacks, the same in every language.
UNKNOWN = 1e-8
_LETTERS = regex.compile(r"\p{L}+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class LanguageModel(NamedTuple):
    """Languages, piece probabilities [piece, language], and by language the mean and deviation of its words' log likelihood per character."""

    langs: list[str]
    prob: np.ndarray
    usual: np.ndarray


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> PieceIndex:
    """The vocabulary's pieces that can occur in a marked word (letters, with or without the mark), numbered."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ok = regex.compile(rf"{START}?\p{{L}}*")
    found = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i)))
    kept = sorted({p for p in found if p and ok.fullmatch(p)})
    return PieceIndex({p: i for i, p in enumerate(kept)})


KEPT["langid"] = pieces.cache_clear


def words_of(chunk: str) -> list[str]:
    """Marked words of a chunk; capitals alone are no other word."""
    words = [chunk] if chunk.isalpha() else _LETTERS.findall(chunk)
    return [START + (w.lower() if len(w) > 1 and w.isupper() else w) for w in words]


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _codes(words: list[str]) -> np.ndarray:
    """[word, place]: code points of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def _hashes(codes: np.ndarray) -> np.ndarray:
    """[word, place]: hash of the characters up to a place, of which a stretch's hash follows by a subtraction."""
    out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + codes[:, i]
    return out


class PieceIndex(dict):
    """Pieces by number, with a table of their hashes for whole columns of stretches."""

    def __init__(self, numbered: dict[str, int]):
        super().__init__(numbered)
        keys = {int(_hashes(_codes([p]))[0, -1].view(np.int64)): (i, 0) for p, i in numbered.items()}
        if len(keys) < len(numbered):
            raise ValueError("two pieces of one hash")
        self.table = PairTable(keys)
        self.longest = max(map(len, numbered), default=1)
        self.powers = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)


def lattice(words: list[str], index: PieceIndex) -> np.ndarray:
    """[word, end, length - 1] of words of one length: the piece's number, len(index) if there is none, one more for an unknown character."""
    none, n = len(index), len(words[0])
    longest = min(n, index.longest)
    upto = _hashes(_codes(words))
    grid = np.full((len(words), n, longest), none, np.int32)
    for k in range(1, longest + 1):
        stretch = (upto[:, k:] - upto[:, : n + 1 - k] * index.powers[k]).view(np.int64)
        number = index.table.ranks(stretch)[0]
        grid[:, k - 1 :, k - 1] = np.where(number > none, none + (k == 1), number)
    return grid


def forward(grid: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """[word, end, language]: summed probability of all segmentations of the first `end` characters; for words of up to PLAIN."""
    n = grid.shape[1]
    alpha = np.zeros((len(grid), n + 1, prob.shape[1]))
    alpha[:, 0] = 1
    for end in range(1, n + 1):
        for k in range(1, min(end, grid.shape[2]) + 1):
            alpha[:, end] += alpha[:, end - k] * prob[grid[:, end - 1, k - 1]]
    return alpha


def log_forward(grid: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """The logarithms of forward(), for words of any length."""
    n, longest = grid.shape[1:]
    if n <= PLAIN:
        return np.log(forward(grid, prob))
    out = np.zeros((len(grid), n + 1, prob.shape[1]))
    # the sums of the last `longest` ends, all divided by exp(scale)
    recent, scale = [np.ones((len(grid), prob.shape[1]))], np.zeros((len(grid), prob.shape[1]))
    for end in range(1, n + 1):
        now = sum(recent[-k] * prob[grid[:, end - 1, k - 1]] for k in range(1, len(recent) + 1))
        recent = [*recent[-longest + 1 :], now] if longest > 1 else [now]
        out[:, end] = np.log(now) + scale
        if end % 8 == 0:
            recent, scale = [r / now for r in recent], scale + np.log(now)
    return out


def _by_length(words: list[str]) -> Iterator[list[int]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for n, g in groups.items():
        most = max(1, CELLS // n)
        for at in range(0, len(g), most):
            yield g[at : at + most]


def fit_pieces(counts: dict[str, int], index: PieceIndex, rounds: int = 3, smooth: float = 0.02) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation, from its word counts."""
    size = len(index)
    prob = np.full((size + 2, 1), 1.0 / size)
    prob[size:] = [[0.0], [UNKNOWN]]
    words, weight = list(counts), np.array(list(counts.values()), float)
    grids = [(group, lattice([words[i] for i in group], index)) for group in _by_length(words)]
    for _ in range(rounds):
        expected = np.zeros(size + 2)
        for group, grid in grids:
            n, log = grid.shape[1], log_forward(grid, prob)[:, :, 0]
            held = np.zeros_like(log)  # how often a cut falls behind each character
            held[:, n] = weight[group]
            for end in range(n, 0, -1):
                for k in range(1, min(end, grid.shape[2]) + 1):
                    at = grid[:, end - 1, k - 1]
                    # of the segmentations up to `end`, the share whose last piece this is
                    through = held[:, end] * prob[at, 0] * np.exp(log[:, end - k] - log[:, end])
                    held[:, end - k] += through
                    np.add.at(expected, at, through)
        share = expected[:size] + smooth
        prob[:size, 0] = share / share.sum()
    return prob[:size, 0]


def usual_likelihood(counts: dict[str, int], index: PieceIndex, prob: np.ndarray) -> tuple[float, float]:
    """Mean and deviation, over running words, of the log likelihood per character in one language."""
    words, weight = list(counts), np.array(list(counts.values()), float)
    if not words:
        return 0.0, 0.0
    full = np.concatenate([prob, [0.0, UNKNOWN]])[:, None]
    value = np.zeros(len(words))
    for group in _by_length(words):
        grid = lattice([words[i] for i in group], index)
        value[group] = log_forward(grid, full)[:, -1, 0] / grid.shape[1]
    mean = float(np.average(value, weights=weight))
    return mean, float(np.sqrt(np.average((value - mean) ** 2, weights=weight)))


def train_language_id(df: DataFrame, path: str, text_col: str = "text", lang_col: str = "lang", max_docs: int = 200) -> LanguageModel:
    """Model of about max_docs different labelled texts a language.

    Rows of null label or null text teach nothing. The texts are those of smallest hash, so that the sample is the
    same in every run, and copies count once; its expected size is at most max_docs times the number of languages,
    however large the table. An empty table gives no languages.
    """
    index = pieces(path)
    rows = df.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel([], np.zeros((len(index) + 2, 0)), np.zeros((0, 2)))
    space = 1 << 30
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(space, int(space * max_docs / n))))])
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(space)) < share[F.col("lang")]).distinct()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        let_go("langid")
        counts: Counter = Counter()
        for text in pdf["text"]:
            counts.update(w for chunk, n in Counter(text.split()).items() for w in words_of(chunk) for _ in range(n))
        prob = fit_pieces(counts, pieces(path))
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "prob": [prob.tolist()], "usual": [list(usual_likelihood(counts, pieces(path), prob))]})

    found = {r.lang: r for r in sample.groupBy("lang").applyInPandas(fit, "lang string, prob array<double>, usual array<double>").collect()}
    langs = sorted(found)
    if not langs:
        return LanguageModel([], np.zeros((len(index) + 2, 0)), np.zeros((0, 2)))
    prob = np.array([found[k].prob for k in langs]).T
    prob = np.vstack([prob, np.zeros((1, len(langs))), np.full((1, len(langs)), UNKNOWN)])
    return LanguageModel(langs, prob, np.array([found[k].usual for k in langs]))


class Scorer:
    """Log probabilities of chunks, remembered by chunk, in one Python process."""

    def __init__(self, path: str, prob: np.ndarray):
        self.index, self.prob = pieces(path), prob
        self.rows: dict[str, int] = {}
        self.table = np.zeros((0, 2 * prob.shape[1] + 1))

    def learn(self, chunks: list[str]) -> None:
        fresh = [c for c in chunks if c not in self.rows]
        if not fresh:
            return
        if len(self.rows) + len(fresh) > CACHE:
            self.rows.clear()
            self.table, fresh = self.table[:0], chunks
        split = [words_of(c) for c in fresh]
        words = list({w for ws in split for w in ws})
        k = self.prob.shape[1]
        # by word: log likelihood in each language, the same per character, and 1, which counts words
        logs, place = np.zeros((len(words), 2 * k + 1)), {w: i for i, w in enumerate(words)}
        for group in _by_length(words):
            grid = lattice([words[i] for i in group], self.index)
            logs[group, :k] = log_forward(grid, self.prob)[:, -1]
            logs[group, k:-1] = logs[group, :k] / grid.shape[1]
            logs[group, -1] = 1
        sizes = np.array([len(ws) for ws in split])
        add = np.zeros((len(fresh), logs.shape[1]))
        if words:
            of = logs[[place[w] for ws in split for w in ws]]
            starts = np.cumsum(sizes) - sizes
            some = np.flatnonzero(sizes)
            add[some] = np.add.reduceat(of, starts[some])
        base = len(self.table)
        self.table = np.vstack([self.table, add])
        self.rows.update((c, base + i) for i, c in enumerate(fresh))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By text: log likelihood in each language, sum over words of the log likelihood per character in each, number of words."""
        parts = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
        coded = parts.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        self.learn(chunks)
        logs = self.table[[self.rows[c] for c in chunks]] if chunks else self.table[:0]
        out, ends = np.zeros((len(texts), self.table.shape[1])), parts.offsets.to_numpy()
        index = coded.indices.to_numpy()
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            if b > a:
                out[i] = np.bincount(index[a:b], minlength=0) @ logs[: index[a:b].max() + 1] if b - a > len(logs) else logs[index[a:b]].sum(axis=0)
        k = self.prob.shape[1]
        return out[:, :k], out[:, k:-1], out[:, -1]


def identify_language(df: DataFrame, model: LanguageModel, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) of every row: the likeliest language and how far it stands out.

    score is the language's share of the likelihoods per character (their geometric mean, averaged over words), so that
    it does not rise with the mere length of a text: one over the number of languages if all are equally likely.
    A null text, one without letters, or a model without languages gives `und` and score 0. Every row is
    judged by itself on its whole text, so ties, repeated rows and null ids need no care; equal
    likelihoods go to the first language in alphabetical order. Other columns are left out. No shuffle.
    """
    kind = df.schema[id_col].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(model)  # vocabulary x languages, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prob, _ = sent.value
        scorer = Scorer(path, prob)
        for b in slices(batches):
            log, each, words = scorer.score(b.column(1).to_pylist())
            known = (words > 0) & (len(names) > 0)
            best = log.argmax(axis=1) if len(names) else np.zeros(len(log), int)
            mean = np.exp(each / np.maximum(words, 1)[:, None])
            share = mean[np.arange(len(best)), best] / mean.sum(axis=1) if len(names) else np.zeros(len(log))
            pred = [names[i] if k else "und" for i, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(np.where(known, share, 0.0))], names=[id_col, "lang_pred", "score"])

    source = df.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return in_arrow(source, run, f"`{id_col}` {kind}, lang_pred string, score double", keep="langid")


def keep_language(df: DataFrame, model: LanguageModel, path: str, text_col: str = "text") -> DataFrame:
    """The rows of df, with all columns, whose text is in some learned language.

    Rejected are null texts, texts without a letter, and those whose words are unlike the words of the likeliest
    language (UNLIKE): letters without a language. A model without languages only rejects the former two. Repeated
    rows are judged alike; columns of any name pass. No shuffle.
    """
    if not model.langs:
        return df.where(F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False)))
    sent = df.sparkSession.sparkContext.broadcast(model)

    at = len(df.columns)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, prob, usual = sent.value
        scorer = Scorer(path, prob)
        for b in trimmed(slices(batches, text=at, most=SLICE_BYTES // 2)):
            log, each, words = scorer.score(b.column(at).to_pylist())
            best, n = log.argmax(axis=1), np.maximum(words, 1)
            mean, deviation = usual[best].T
            least = np.minimum(mean - deviation * (UNLIKE[0] + UNLIKE[1] / np.sqrt(n)), FLOOR)
            yield b.select(list(range(at))).filter(pa.array((words > 0) & (each[np.arange(len(best)), best] / n >= least)))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(free_name("__text", df.columns))
    return in_arrow(df.select("*", text), known, df.schema, keep="langid")
