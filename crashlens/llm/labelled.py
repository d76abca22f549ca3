"""Labelled training rows and a small logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows that a model is fitted on. They are drawn by a hash of
#: their id, so the sample is the same on every run and spread over the table.
SAMPLE_ROWS = 12_000


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the held-out fold; a null id
    counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int,
                  rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and label (0 or 1) of at most ``rows`` labelled documents outside
    the held-out fold.

    The ids are sampled first; they are few and bounded, so the documents are
    found by a broadcast join and no text is shuffled. Repeated ids, and
    labels that are null or neither 0 nor 1, are left out of the sample.
    """
    ids = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()) \
        .where(~held_out(F.col("doc_id"), folds, fold)) \
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_other")) \
        .where("label = _other").select(F.col("doc_id").alias("_id"), "label") \
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id")) \
        .select("text", "label")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30):
    """Weights and intercept by penalised Newton steps on scaled features;
    without both classes every weight is 0."""
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return np.zeros(x.shape[1] if x.ndim == 2 else 0), float(np.log(rate / (1 - rate)))
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w, pen = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    pen[-1] = 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(pen + 1e-9)
        move = np.linalg.solve(h, z.T @ (y - p) - pen * w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)
