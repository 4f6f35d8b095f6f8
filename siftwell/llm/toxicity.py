"""Toxicity grades by cumulative-link ordinal regression.

Grades 0 < 1 < .. < K share one weight vector over sparse text features; ordered thresholds cut its score:
P(grade <= k) = sigmoid(threshold_k - score). Features are all hashed words and their beginnings (inflected words share
them), log(1 + count); an L1 penalty on the weights, and no choice beforehand, leaves out those that tell nothing. The model is fitted in one task from a bounded
sample of different labelled texts.

Labels tell toxic from other texts. Grades of toxic ones come from how dense words are that tell toxicity, and these
words are found on the other half of the sample, so that no text is graded by words chosen on itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, slices

#: Hashed words, texts of the sample (its expected size).
DIMS, SAMPLE = 1 << 18, 4000
#: L1 penalty of a weight, against the mean loss of a text, times the root of the number of texts: with more texts, rarer words may tell.
PENALTY = 0.05
#: Characters of a word's beginning.
PREFIX = 4
_WORD = regex.compile(r"[^\W\d_]+")


def features(word: str) -> tuple[int, ...]:
    """Hashed word and, if it is longer, its beginning."""
    own = xxhash.xxh64_intdigest(word, 7) % DIMS
    return (own, xxhash.xxh64_intdigest("^" + word[:PREFIX], 7) % DIMS) if len(word) > PREFIX else (own,)


def buckets(text: str) -> dict[int, int]:
    """Features of a text and how often each occurs."""
    out: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for f in features(word):
            out[f] += n
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class OrdinalModel:
    """Weights over `DIMS` hashed words (zero for most) and ascending thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def at_most(self, scores: np.ndarray) -> np.ndarray:
        """[text, k]: probability of a grade of at most k, without the highest."""
        return sigmoid(self.thresholds[None, :] - scores[:, None])


class SparseRows:
    """Rows of a few numbers each: x[row[i], col[i]] = value[i]."""

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, shape: tuple[int, int]):
        self.row, self.col, self.value, self.shape = row, col, value, shape

    @classmethod
    def of(cls, rows: list[dict[int, float]], dims: int = DIMS) -> SparseRows:
        sizes = np.array([len(r) for r in rows], np.int64)
        col = np.fromiter((c for r in rows for c in r), np.int64, sizes.sum())
        value = np.fromiter((v for r in rows for v in r.values()), np.float64, sizes.sum())
        return cls(np.repeat(np.arange(len(rows)), sizes), col, value, (len(rows), dims))

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.col], minlength=self.shape[0])

    def gradient(self, by_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value * by_row[self.row], minlength=self.shape[1])


def fit_ordinal(x: SparseRows, grade: np.ndarray, steps: int = 300, rate: float = 0.2, penalty: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by proximal AdaGrad on the mean negative log likelihood and an L1 penalty; thresholds stay ordered as a start and positive gaps."""
    top = int(grade.max(initial=0))
    share = np.clip([np.mean(grade <= k) for k in range(top)], 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    n = x.shape[0]
    w = np.zeros(x.shape[1])
    t = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    seen_w, seen_t = np.full(w.shape, 1e-8), np.full(t.shape, 1e-8)
    rows = np.arange(n)
    for _ in range(steps):
        cuts = t[0] + np.concatenate([[0], np.cumsum(np.exp(t[1:]))])
        f = sigmoid(cuts[None] - x.scores(w)[:, None])
        padded = np.concatenate([np.zeros((n, 1)), f, np.ones((n, 1))], axis=1)
        p = np.maximum(padded[rows, grade + 1] - padded[rows, grade], 1e-9)
        slope = padded * (1 - padded)
        by_score = (slope[rows, grade + 1] - slope[rows, grade]) / p  # of the loss, by the score
        gw = x.gradient(by_score) / n
        by_cut = np.array([(np.where(grade == k + 1, slope[:, k + 1], 0) - np.where(grade == k, slope[:, k + 1], 0)) @ (1 / p) for k in range(top)]) / n
        gt = np.concatenate([[by_cut.sum()], [by_cut[i:].sum() * np.exp(t[i]) for i in range(1, top)]])
        seen_w, seen_t = seen_w + gw**2, seen_t + gt**2
        size = rate / np.sqrt(seen_w)
        w, t = w - size * gw, t - rate * gt / np.sqrt(seen_t)
        w = np.sign(w) * np.maximum(np.abs(w) - size * penalty, 0)
    return w, t[0] + np.concatenate([[0], np.cumsum(np.exp(t[1:]))])


def telling_words(rows: list[dict[int, int]], toxic: np.ndarray) -> np.ndarray:
    """Hashed words that are far more frequent among toxic texts: their weights in a two-grade model are positive."""
    if not toxic.any() or toxic.all():
        return np.zeros(0, np.int64)
    w, _ = fit_ordinal(SparseRows.of([dict.fromkeys(r, 1.0) for r in rows]), toxic.astype(int), steps=100, penalty=PENALTY / np.sqrt(len(rows)))
    return np.flatnonzero(w > 0.1)


def fit_grades(texts: list[str], toxic: np.ndarray) -> OrdinalModel:
    """Model of three grades from different texts and toxic flags; halves are every other text."""
    none = OrdinalModel(np.zeros(DIMS, np.float32), np.array([30.0, 31.0]))
    if not len(texts) or not toxic.any() or toxic.all():
        return none
    rows = [buckets(t) for t in texts]
    words = np.array([max(1, sum(r.values())) for r in rows])
    half, dense = np.arange(len(rows)) % 2, np.zeros(len(rows))
    for side in (0, 1):
        other = np.flatnonzero(half != side)
        telling = {*telling_words([rows[i] for i in other], toxic[other]).tolist()}
        for i in np.flatnonzero((half == side) & toxic).tolist():
            dense[i] = sum(n for c, n in rows[i].items() if c in telling) / words[i]
    grade = np.where(toxic, 1 + (dense > np.median(dense[toxic])), 0)
    w, thresholds = fit_ordinal(SparseRows.of([{c: np.log1p(n) for c, n in r.items()} for r in rows]), grade, penalty=PENALTY / np.sqrt(len(rows)))
    if grade.max() < 2:
        thresholds = np.append(thresholds, thresholds[-1] + 10)
    return OrdinalModel(w.astype(np.float32), thresholds)


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic: Column | None = None, max_docs: int = SAMPLE) -> OrdinalModel:
    """Fits the model on about max_docs labelled texts, those of smallest id hash.

    Null texts, ids and labels teach nothing; equal texts count once, toxic if any of them is. Without labelled
    texts of both kinds the model gives every text grade 0.
    """
    flag = F.col("toxic") if toxic is None else toxic
    known = labels.select(F.col(id_col).alias("id"), flag.cast("int").alias("y")).where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
    n = known.count()
    space = 1 << 30
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(space)) < F.lit(min(space, space * max_docs // max(1, n))))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows = rows.join(F.broadcast(chosen), "id")  # about max_docs ids, whatever the number of labels
    rows = rows.groupBy("text").agg(F.max("y").alias("y"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("text")
        model = fit_grades(pdf["text"].tolist(), pdf["y"].to_numpy() > 0)
        at = np.flatnonzero(model.weights)
        return pd.DataFrame({"at": [at.tolist()], "w": [model.weights[at].tolist()], "t": [model.thresholds.tolist()]})

    found = rows.groupBy(F.lit(1).alias("one")).applyInPandas(fit, "at array<int>, w array<double>, t array<double>").first()
    if found is None:
        return fit_grades([], np.zeros(0, bool))
    weights = np.zeros(DIMS, np.float32)
    weights[found["at"]] = found["w"]
    return OrdinalModel(weights, np.array(found["t"]))


def grade_toxicity(df: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, severity, p_toxic, grade, toxic) of every row, on whole texts, without a shuffle.

    severity is the expected grade, p_toxic the probability of a grade above 0, grade the likeliest one (ties
    to the lower), toxic whether p_toxic is at least a half. A null or empty text has a score of 0, which the
    thresholds grade; null and repeated ids are kept; other columns are left out.
    """
    kind = df.schema[id_col].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(model)  # of DIMS numbers, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        weight = _Weights(own.weights)
        for b in slices(batches):
            scores = np.zeros(b.num_rows)
            for i, text in enumerate(b.column(1).to_pylist()):
                counts: Counter = Counter()
                for word in _WORD.findall(text.lower()):
                    if found := weight[word]:
                        counts.update(found)
                scores[i] = sum(w * np.log1p(n) for (_, w), n in counts.items())
            below = own.at_most(scores)
            parts = np.diff(np.concatenate([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))], axis=1), axis=1)
            p = 1 - below[:, 0]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((1 - below).sum(axis=1)), pa.array(p), pa.array(parts.argmax(axis=1).astype(np.int32)), pa.array(p >= 0.5)], names=[id_col, "severity", "p_toxic", "grade", "toxic"])

    source = df.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return in_arrow(source, run, f"`{id_col}` {kind}, severity double, p_toxic double, grade int, toxic boolean")


class _Weights(dict):
    """(feature, weight) of each word's features of a weight; emptied when full."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[tuple[int, float], ...]:
        if len(self) > 200_000:
            self.clear()
        self[word] = found = tuple((f, float(self.weights[f])) for f in features(word) if self.weights[f])
        return found
