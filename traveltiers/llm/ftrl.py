"""A linear model over hashed features, fitted by FTRL-proximal (used by operators 6 and 9).

Every coordinate has its own learning rate; L1 keeps weights of weak coordinates at exactly
zero, so the fitted model is a short list of (coordinate, weight), at most 2**BITS of them,
and is broadcast. The learner is online and sees a bounded sample in one task; scoring is
spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traveltiers.llm.common import ship

BITS = 20
ALPHA, BETA, L1, L2, PASSES = 2.0, 1.0, 8.0, 0.1, 5
MASK = (1 << BITS) - 1


class Learner:
    """z and n of FTRL-proximal; the last coordinate is the bias, without L1."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        one = np.where(at == len(self.z) - 1, 0.0, L1)
        return np.where(np.abs(z) <= one, 0.0, -(z - np.sign(z) * one) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, value: np.ndarray, y: float) -> None:
        at, value = np.append(at, len(self.z) - 1), np.append(value, 1.0)
        w = self.weights(at)
        g = (sigmoid(float(w @ value)) - y) * value
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def fit(sample: DataFrame, features: Callable[[str | None], tuple[np.ndarray, np.ndarray]], passes: int = PASSES) -> dict[int, float]:
    """Weights by coordinate (-1: bias) from rows (id, text, y in 0..1) of a bounded sample, learned in the order of the ids' hash."""

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["order", "id"], kind="stable")
        rows = [(*features(t), y) for t, y in zip(pdf["text"], pdf["y"])]
        model = Learner()
        for _ in range(passes):
            for at, value, y in rows:
                model.learn(at, value, y)
        every = np.arange(len(model.z))
        w = model.weights(every)
        used = np.flatnonzero(w)
        return pd.DataFrame({"at": np.where(used == len(w) - 1, -1, used), "w": w[used]})

    ship(sample.sparkSession)
    one = sample.select(F.lit(0).alias("g"), F.xxhash64("id").alias("order"), F.col("id"), F.col("text"), F.col("y").cast("double").alias("y"))
    got = one.groupBy("g").applyInPandas(run, "at long, w double").collect()  # at most 2**BITS + 1 rows
    return {r["at"]: r["w"] for r in got}


class Scorer:
    """The weights as an array, and a text's probability of label 1."""

    def __init__(self, weights: dict[int, float], features: Callable):
        self.w, self.features = np.zeros(1 << BITS, np.float32), features
        self.bias = weights.get(-1, 0.0)
        for at, w in weights.items():
            if at >= 0:
                self.w[at] = w

    def score(self, text: str | None) -> float:
        at, value = self.features(text)
        return sigmoid(self.bias + float((self.w[at] * value).sum(dtype=np.float64)))
