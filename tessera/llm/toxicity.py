"""Toxicity by subword bags: n-gram vectors averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its character n-grams, a segment's that of its
words, and a softmax layer over it gives the two classes; vectors and layer are learned together.
A misspelt or inflected word that was never seen shares n-grams with one that was. A text is
judged by its most toxic segment, so one insult counts alike in short and long texts; a
logistic fit on the training texts turns that into a probability.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Remembered, text_or_empty
from tessera.llm.labelled import fit_logistic, remainder, sigmoid, training_rows

#: Labelled texts of each class that are fetched for training at most.
MAX_PER_CLASS = 700
#: Rows of the n-gram table, width of a vector, n-gram lengths in bytes, words of a segment.
BUCKETS, WIDTH, GRAMS, SEGMENT = 1 << 18, 4, (3, 4, 5), 4
#: Training texts that an n-gram must occur in, and in which its vector counts half; training steps and rate.
MIN_TEXTS, HALF_TEXTS, STEPS, RATE = 3, 30, 50, 0.15
#: Share of labels 1 in every four, held-out remainder, threshold of a predicted 1.
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3


def grams(word: str) -> list[int]:
    """Table rows of the word's n-grams, with its ends marked, and of the whole word."""
    b = b"<" + word.encode("utf-8") + b">"
    found = [zlib.crc32(b[i:i + n]) % BUCKETS for n in GRAMS for i in range(len(b) - n + 1)]
    return found or [zlib.crc32(b) % BUCKETS]


def segments(n_words: int) -> np.ndarray:
    """Starts of the segments of a text; a short rest joins the last one."""
    return np.arange(0, max(1, n_words - SEGMENT // 2), SEGMENT)


@dataclass
class Model:
    """Softmax margin (class 1 less class 0) of each n-gram's vector, its constant, and the final fit."""

    margin: np.ndarray
    bias: float
    final: np.ndarray

    def words(self) -> Remembered:
        return Remembered(lambda w: float(self.margin[grams(w)].mean()))

    def evidence(self, text: str, words: Remembered) -> tuple[float, float]:
        """Margin of the most toxic segment; logarithm of the number of segments."""
        found = text.lower().split()
        if not found:
            return self.bias, 0.0
        value = np.fromiter(map(words.__getitem__, found), np.float64, len(found))
        at = segments(len(found))
        sums = np.add.reduceat(value, at)
        return float((sums / np.diff([*at, len(found)])).max()) + self.bias, float(np.log(len(at)))


def _sum_rows(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(index, values[:, k], n) for k in range(values.shape[1])], axis=1)


def _learn(texts: list[str], y: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """Margin of each table row and the constant, by full-batch Adam on the cross-entropy of segments.

    In the second half a toxic text counts with its most toxic segment alone. N-grams of
    fewer texts than MIN_TEXTS keep a zero vector, those of few texts a short one.
    """
    ids: dict[str, int] = {}
    bag, lengths, owner = [], [], []
    for k, t in enumerate(texts):
        w = [ids.setdefault(x, len(ids)) for x in t.lower().split()]
        if w:
            at = segments(len(w))
            bag.append(np.array(w, np.int32))
            lengths.append(np.diff([*at, len(w)]))
            owner.append(np.full(len(at), k))
    bag, lengths, owner = np.concatenate(bag), np.concatenate(lengths), np.concatenate(owner)
    label = y[owner]
    rows = [grams(w) for w in ids]
    of_gram = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    size = np.array([len(r) for r in rows], np.float32)[:, None]
    gram = np.concatenate(rows)
    word_texts = np.unique(bag.astype(np.int64) * len(texts) + np.repeat(owner, lengths))
    seen = np.bincount(gram, np.bincount(word_texts // len(texts), minlength=len(rows))[of_gram], BUCKETS)
    kept = seen[gram] >= MIN_TEXTS
    gram, of_gram = gram[kept], of_gram[kept]
    gram, table = np.unique(gram, return_inverse=True)
    trust = (seen[gram] / (seen[gram] + HALF_TEXTS))[:, None]
    seg_of = np.repeat(np.arange(len(lengths)), lengths)
    length = lengths[:, None].astype(np.float32)
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (len(gram), WIDTH)), rng.normal(0, 0.5, (WIDTH, 2)), np.zeros(2)]
    moment = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    target = np.stack([1 - label, label], axis=1)
    weight = np.where(label == 1, 0.5 / (label == 1).sum(), 0.5 / (label == 0).sum())
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    for step in range(1, STEPS + 1):
        vectors, layer, bias = params
        word = _sum_rows(of_gram, (vectors * trust)[table], len(rows)) / size
        seg = _sum_rows(seg_of, word[bag], len(lengths)) / length
        z = seg @ layer + bias
        if step > STEPS // 2:
            margin = z[:, 1] - z[:, 0]
            top = np.repeat(np.maximum.reduceat(margin, first), np.diff([*first, len(owner)]))
            used = (label == 0) | (margin == top)
            weight = used * np.where(label == 1, 0.5 / (used & (label == 1)).sum(), 0.5 / (label == 0).sum())
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        dz = (p - target) * weight[:, None]
        dword = _sum_rows(bag, ((dz @ layer.T) / length)[seg_of], len(rows)) / size
        grads = [_sum_rows(table, dword[of_gram], len(gram)) * trust, seg.T @ dz, dz.sum(axis=0)]
        for q, g, m in zip(params, grads, moment):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            q -= RATE * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-8)
    margin = np.zeros(BUCKETS, np.float32)
    margin[gram] = (params[0] * trust) @ (params[1][:, 1] - params[1][:, 0])
    return margin, float(params[2][1] - params[2][0])


def train(texts: list[str], y: np.ndarray, counts: np.ndarray, seed: int = 7) -> Model:
    """Vectors and layer from two thirds of the texts, the final fit from the rest; constant without both classes."""
    prior = (counts + 0.5) / (counts.sum() + 1.0)
    part = np.arange(len(y)) % 3 == 0
    if any(len(np.unique(y[p])) < 2 for p in (part, ~part)):
        return Model(np.zeros(BUCKETS, np.float32), 0.0, np.array([0.0, 0.0, np.log(prior[1] / prior[0])]))
    margin, bias = _learn([t for t, p in zip(texts, part) if not p], y[~part], seed)
    model = Model(margin, bias, np.zeros(3))
    words, rest = model.words(), y[part]
    x = np.array([(*model.evidence(t, words), 1.0) for t, p in zip(texts, part) if p])
    each = np.array([prior[0] / (rest == 0).sum(), prior[1] / (rest == 1).sum()])[rest.astype(int)] * len(rest)
    model.final = fit_logistic(x, rest, each)
    return model


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; only the text enters a score.

    An empty or null text gets the score of an empty bag. Null ids keep their row; repeated rows
    score alike; without labels of both classes every score is the share of label 1.
    """
    rows = text_or_empty(docs, id_col, text_col)
    model = train(*training_rows(rows, labels, "toxic", FOLDS, HELD_OUT, MAX_PER_CLASS, by_class=True))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words = m.words()
        for batch in batches:
            x = np.array([(*m.evidence(t.as_py(), words), 1.0) for t in batch.column(1)]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(x @ m.final))], ["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
