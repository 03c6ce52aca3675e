"""Bounded labelled samples for the trained operators, and the logistic fits that they share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed


def remainder(id_col, folds: int):
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int,
                  by_class: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts, labels and the count of each label among all labelled rows that are not held out.

    At most ``most`` rows (of each class, if ``by_class``) are fetched, chosen by a hash of the id.
    Null labels, labels of absent documents and held-out rows count nowhere and take no place in
    the sample; empty texts count. If ids repeat, a document's label is the largest of its labels
    and its text the first by hash, so that reruns agree.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = (labels.where(F.col(label).isNotNull() & (remainder(F.col("doc_id"), folds) != held_out))
             .select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(label) > 0).cast("int").alias("y"))
             .groupBy("doc_id").agg(F.max("y").alias("y"))
             .join(texts.select("doc_id"), "doc_id", "left_semi"))
    known = checkpointed(known)  # two small numbers a label, read three times
    counts = dict(known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect())
    known = known.withColumn("h", F.xxhash64("doc_id"))
    if by_class:
        chosen = [known.where(F.col("y") == y).orderBy("h", "doc_id").limit(most) for y in (0, 1)]
        chosen = chosen[0].unionByName(chosen[1])
    else:
        chosen = known.orderBy("h", "doc_id").limit(most)
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")
    got = (texts.join(F.broadcast(chosen.select("doc_id", "y")), "doc_id").groupBy("doc_id", "y").agg(one)
           .select("doc_id", "y", "t.text").collect())
    got.sort(key=lambda r: r.doc_id)
    return ([r.text for r in got], np.array([r.y for r in got], np.float64),
            np.array([counts.get(0, 0), counts.get(1, 0)], np.float64))


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Newton's method for weighted logistic loss with a ridge; ``x`` holds its own constant column, if any."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(x.shape[1])
        step = np.linalg.solve(curvature, gradient)
        w -= step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return w
