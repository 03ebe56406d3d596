"""What the trained classifiers share: a bounded sample of labelled rows, and Adam."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """text and label of at most ``per_class`` labelled documents of either class.

    ``docs`` has doc_id, text and held_out; held-out rows give neither text nor label. The
    hash of the id decides, so the choice is the same every time. The ids are at
    most ``2 * per_class`` rows, which is the proven size of the broadcast.
    """
    usable = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("label")).distinct()
    usable = usable.join(docs.where("not held_out").select("doc_id").distinct(), "doc_id", "left_semi")
    turn = F.xxhash64("doc_id")
    chosen = None
    for value in (0, 1):
        part = usable.where(F.col("label") == value).orderBy(turn, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    found = docs.where("not held_out").join(F.broadcast(chosen), "doc_id")
    # Of rows that repeat an id one counts, that of the least text, so the bound holds.
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")


def positive_share(docs: DataFrame, labels: DataFrame, label: str) -> float:
    """Share of label 1 among all labelled rows outside the held-out fold."""
    rows = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("label"))
    row = rows.join(docs.where("not held_out").select("doc_id").distinct(), "doc_id", "left_semi").agg(
        F.avg("label").alias("share")
    )
    return row.first().share or 0.0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    def __init__(self, parameters: dict[str, np.ndarray], rate: float, decay: float = 0.0) -> None:
        self.parameters, self.rate, self.decay, self.step = parameters, rate, decay, 0
        self.first = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.second = {k: np.zeros_like(v) for k, v in parameters.items()}

    def __call__(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in gradients.items():
            g = g + self.decay * self.parameters[k]
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            m = self.first[k] / (1 - 0.9**self.step)
            v = self.second[k] / (1 - 0.999**self.step)
            self.parameters[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(self.parameters[k].dtype)
