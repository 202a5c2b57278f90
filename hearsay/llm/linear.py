"""Logistic models on bounded samples, and the choice of such samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    """(doc_id, text, label columns) of the labelled documents with the smallest hash of their id.

    `labels` has doc_id and label columns. At most `limit` label rows are taken,
    so the broadcast is bounded; of several labels for an id the greatest counts, column by column.
    """
    columns = [c for c in labels.columns if c != "doc_id"]
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(c).alias(c) for c in columns])
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights (the last is the constant) by damped Newton steps with an L2 penalty."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + penalty * w
        hess = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])
