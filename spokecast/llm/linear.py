"""Linear models on bounded samples: dual coordinate descent for the hinge loss, and calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Rows:
    """Sparse rows: the places and values of row i are at first[i] to first[i + 1]."""

    first: np.ndarray
    place: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, places: list[np.ndarray], values: list[np.ndarray]) -> Rows:
        first = np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int64)
        return cls(first, np.concatenate(places) if places else np.empty(0, np.int64), np.concatenate(values) if values else np.empty(0))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weights[self.place] * self.value)])
        return total[self.first[1:]] - total[self.first[:-1]]


def hinge(rows: Rows, labels: np.ndarray, size: int, costs: np.ndarray, epochs: int = 30, seed: int = 1) -> np.ndarray:
    """Weights, the last one a bias, that minimise half their square plus the hinge losses times ``costs``.

    ``labels`` are 1 and -1.  Each step solves the dual for one row.
    """
    weights, alpha = np.zeros(size + 1), np.zeros(len(labels))
    norm = np.add.reduceat(np.append(rows.value**2, 0.0), rows.first[:-1]) * (np.diff(rows.first) > 0) + 1.0
    order, random = np.arange(len(labels)), np.random.default_rng(seed)
    for _ in range(epochs):
        random.shuffle(order)
        most = 0.0
        for i in order.tolist():
            a, b = rows.first[i], rows.first[i + 1]
            place, value, y = rows.place[a:b], rows.value[a:b], labels[i]
            slope = y * (weights[place] @ value + weights[-1]) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), costs[i])
            step = (new - alpha[i]) * y
            if step:
                most = max(most, abs(step))
                alpha[i] = new
                weights[place] += step * value
                weights[-1] += step
        if most < 1e-4:
            break
    return weights


def logistic(margins: np.ndarray, targets: np.ndarray, importance: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve of ``margins`` closest to ``targets`` (0 to 1), by Newton's method."""
    a, b = 1.0, 0.0
    spread = max(float(np.std(margins)), 1e-9)
    x = margins / spread
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        wrong, weight = importance * (p - targets), importance * p * (1 - p) + 1e-9
        g = np.array([wrong @ x + 1e-3 * a, wrong.sum()])
        h = np.array([[weight @ (x * x) + 1e-3, weight @ x], [weight @ x, weight.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return a / spread, b


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def part_of(key: Column, parts: int) -> Column:
    """The remainder of the CRC-32 of a key as text; a null key has none."""
    return F.crc32(key.cast("string")) % parts


def sampled(rows: DataFrame, key: str, label: str, each: int) -> tuple[DataFrame, dict]:
    """About ``each`` rows of every label, chosen by a hash of the key, and the number of all rows of each label.

    No label gives more than twice ``each``, however many rows it has.
    """
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 40))
    wanted = F.lit(False)
    for value, n in counts.items():
        wanted = wanted | ((F.col(label) == F.lit(value)) & (draw < int((1 << 40) * min(1.0, each / n))))
    return rows.where(wanted), counts
