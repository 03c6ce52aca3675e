"""Quality by Bradley-Terry ranking: logistic loss on feature differences of preference pairs.

A labelled good text is preferred to a labelled bad one. The score of a text is a weighted sum
of its features; the weights make the preferred text of a pair score higher with probability
sigmoid(difference). The threshold is the quantile of the training scores below which as many
texts lie as are labelled bad.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_or_empty
from tessera.llm.labelled import fit_logistic, remainder, sigmoid, training_rows

#: Labelled texts that are fetched for training at most, and preference pairs drawn from them.
MAX_ROWS, PAIRS = 4_000, 40_000
FOLDS, HELD_OUT = 3, 1
_CLASSES = np.zeros((256, 8))
for _k, _chars in enumerate((string.ascii_lowercase, string.ascii_uppercase, string.digits, ".,;:'\"()-?", "!",
                             "#$%&*+<=>@^_~|\\/{}[]", "\n", " \t\r\v\f")):
    _CLASSES[[ord(c) for c in _chars], _k] = 1


def features(text: str) -> np.ndarray:
    """Shares of character classes, word and line statistics of a whole text; zeros for an empty one."""
    data = text.encode("utf-8")
    words = data.split()
    if not words:
        return np.zeros(25)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = counts @ _CLASSES / len(data)
    lines = data.split(b"\n")
    n, distinct = len(words), len(set(words))
    size = np.fromiter(map(len, words), np.int64, n)
    ends = np.frombuffer(bytes([w[-1] for w in words]), np.uint8)
    closing = _CLASSES[ends].mean(axis=0)
    upper = sum(map(bytes.isupper, words)) / n
    low = np.array([np.log1p(n), size.mean() / 10, size.std() / 10, (size > 20).mean(), distinct / n,
                    np.log(distinct / n), len(set(lines)) / len(lines), np.log1p(n / len(lines)), upper])
    return np.concatenate([share, closing, low])


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    threshold: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        return np.concatenate([z, z * z], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """0.5 at the threshold."""
        return sigmoid(self.expand(x) @ self.weight - self.threshold)


def train(texts: list[str], y: np.ndarray, counts: np.ndarray, seed: int = 7) -> Model:
    """Weights from drawn pairs; without both classes every score is 0.5."""
    x = np.array([features(t) for t in texts]).reshape(len(texts), 25)
    model = Model(x.mean(axis=0) if len(x) else np.zeros(25), x.std(axis=0) + 1e-6 if len(x) else np.ones(25),
                  np.zeros(50), 0.0)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return model
    rng = np.random.default_rng(seed)
    e = model.expand(x)
    difference = e[rng.choice(good, PAIRS)] - e[rng.choice(bad, PAIRS)]
    model.weight = fit_logistic(difference, np.ones(PAIRS), np.full(PAIRS, len(y) / PAIRS), ridge=0.3)
    # midway between the scores at either side of the quantile
    ranked, k = np.sort(e @ model.weight), len(bad)
    model.threshold = float((ranked[k - 1] + ranked[min(k, len(ranked) - 1)]) / 2)
    return model


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; only the text enters a score.

    An empty or null text has features of zero. Null ids keep their row; repeated rows score
    alike; without labels of both classes every score is 0.5.
    """
    rows = text_or_empty(docs, id_col, text_col)
    model = train(*training_rows(rows, labels, "quality", FOLDS, HELD_OUT, MAX_ROWS, by_class=False))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(batch.num_rows, 25)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], ["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
