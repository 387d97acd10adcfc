"""Bounded samples of labelled documents, and what classifiers fit on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.session import materialize

#: Labelled documents per class that a classifier is fitted on, at most (those of the smallest hashes).
SAMPLE_PER_CLASS = 3_000


def sample(documents: DataFrame, labels: DataFrame, label: str, allowed: Column, columns: list[str],
           per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``columns`` and ``label`` (0 or 1) of a bounded sample of labelled documents.

    ``allowed`` says which labelled doc_ids may be used. A doc_id with contradictory labels is left out.
    The chosen ids, at most twice ``per_class``, are broadcast, so the documents are only scanned.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
    known = known.groupBy("doc_id").agg(F.min(label).alias("_y"), F.max(label).alias("_h")).filter("_y = _h").drop("_h")
    lot = F.xxhash64("doc_id", F.lit(7))
    chosen = None
    for y in (0, 1):
        some = known.filter(F.col("_y") == y).orderBy(lot, "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.union(some)
    chosen = materialize(chosen, "sample-ids")
    return materialize(
        documents.select(*dict.fromkeys(["doc_id", *columns])).join(F.broadcast(chosen), "doc_id")
        .select(*columns, F.col("_y").cast("int").alias(label)),
        "sample",
    )


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, weight: np.ndarray | None = None, steps: int = 40) -> np.ndarray:
    """Weights (intercept last) of logistic regression by Newton's steps; few features."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.ones(len(x)) if weight is None else weight
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curvature = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(curvature, gradient)
        w -= move * min(1.0, 5 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
