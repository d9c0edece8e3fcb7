"""Gradient-boosted trees for small tables: logistic loss, second-order gains, binned features.

Fitted on the driver from a bounded number of rows, applied in Arrow batches.
"""

from __future__ import annotations

import numpy as np


class Boosted:
    """Boosted trees of fixed depth; ``scores`` gives probabilities."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> None:
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.bias = 0.0
        self.features = np.zeros((0, 0), dtype=np.int32)
        self.limits = np.zeros((0, 0))
        self.leaves = np.zeros((0, 0))

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        x, y = np.asarray(x, float), np.asarray(y, float)
        n, width = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(mean / (1 - mean)))
        raw = np.full(n, self.bias)
        nodes = (1 << self.depth) - 1
        features, limits, leaves = [], [], []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            where = np.zeros(n, dtype=np.int64)
            feature, limit = np.zeros(nodes, dtype=np.int32), np.full(nodes, np.inf)
            for level in range(self.depth):
                first, count = (1 << level) - 1, 1 << level
                best = np.full(count, 1e-6)
                for j in range(width):
                    k = len(edges[j]) + 1
                    if k < 2:
                        continue
                    cell = (where - first) * k + binned[:, j]
                    g = np.bincount(cell, grad, count * k).reshape(count, k).cumsum(axis=1)
                    h = np.bincount(cell, hess, count * k).reshape(count, k).cumsum(axis=1)
                    gt, ht = g[:, -1:], h[:, -1:]
                    gain = (g**2 / (h + self.ridge) + (gt - g) ** 2 / (ht - h + self.ridge) - gt**2 / (ht + self.ridge))[:, :-1]
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(count), at]
                    better = top > best
                    best[better] = top[better]
                    feature[first : first + count][better] = j
                    limit[first : first + count][better] = edges[j][at[better]]
                where = 2 * where + 1 + (x[np.arange(n), feature[where]] > limit[where])
            leaf = where - nodes
            size = 1 << self.depth
            value = self.rate * np.bincount(leaf, grad, size) / (np.bincount(leaf, hess, size) + self.ridge)
            raw += value[leaf]
            features.append(feature)
            limits.append(limit)
            leaves.append(value)
        self.features, self.limits, self.leaves = np.array(features), np.array(limits), np.array(leaves)
        return self

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        n = len(x)
        raw = np.full(n, self.bias)
        rows = np.arange(n)
        nodes = (1 << self.depth) - 1
        for feature, limit, value in zip(self.features, self.limits, self.leaves):
            where = np.zeros(n, dtype=np.int64)
            for _ in range(self.depth):
                where = 2 * where + 1 + (x[rows, feature[where]] > limit[where])
            raw += value[where - nodes]
        return 1 / (1 + np.exp(-raw))
