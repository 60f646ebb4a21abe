"""Bounded samples of labelled documents, and fits of few parameters on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxweave.llm import common

_UNIT = 1 << 31


def unit_hash(column: Column, purpose: str) -> Column:
    """A number in [0, 1) that depends on the value and the purpose only."""
    return F.xxhash64(column, F.lit(purpose)).bitwiseAND(F.lit(_UNIT - 1)) / F.lit(float(_UNIT))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, text, label, weight, fold`` of labelled documents, about ``per_class`` of each class.

    Rows are chosen by a hash of their id.  ``weight`` is the number of labelled documents that a row
    stands for; ``fold`` is a number in [0, 1).  Rows with a null id or a label other than 0 or 1 are not
    used; of several labels of a document the larger counts.  The chosen labels are at most a few times
    ``per_class`` short rows and are broadcast.
    """
    marked = (
        labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    rate = F.lit(0.0)
    for value, n in counts.items():
        rate = F.when(F.col("label") == value, min(1.0, per_class / n)).otherwise(rate)
    chosen = marked.withColumn("rate", rate).where(unit_hash(F.col("doc_id"), "sample") < F.col("rate"))
    chosen = chosen.select("doc_id", "label", (1 / F.col("rate")).alias("weight"), unit_hash(F.col("doc_id"), "fold").alias("fold"))
    return common.rows(docs, doc_id, text).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label", "weight", "fold")


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weighted logistic regression with an intercept (last) on few columns, by Newton steps."""
    design = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(design.shape[1])
    weight = weight / weight.mean()
    for _ in range(steps):
        p = sigmoid(design @ beta)
        slope = design.T @ (weight * (y - p)) - ridge * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
