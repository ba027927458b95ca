"""A small histogram gradient-boosting classifier with calibrated probabilities.

It is fitted on the driver from a bounded sample (every caller documents its bound) and applied in Arrow batches on
the executors; the fitted model is a few kilobytes of arrays.
"""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Binary logistic boosting over quantile-binned features; NaN goes to its own lowest bin."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 32, leaf: float = 4.0, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.leaf, self.ridge = trees, depth, rate, bins, leaf, ridge
        self.edges: list[np.ndarray] = []
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base, self.slope, self.shift = 0.0, 1.0, 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, dtype=np.int16)
        for j, edges in enumerate(self.edges):
            column = x[:, j]
            out[:, j] = np.where(np.isnan(column), 0, np.searchsorted(edges, column, side="left") + 1)
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> "BoostedTrees":
        x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
        weight = np.ones(len(y)) if weight is None else np.asarray(weight, dtype=float)
        held = np.arange(len(y)) % 5 == 4 if len(y) >= 50 else np.zeros(len(y), dtype=bool)
        self.edges = []
        for j in range(x.shape[1]):
            column = x[:, j][~np.isnan(x[:, j])]
            cuts = np.unique(np.quantile(column, np.linspace(0, 1, self.bins)[1:-1])) if len(column) else np.array([])
            self.edges.append(cuts)
        rate = np.clip(np.average(y, weights=weight), 1e-4, 1 - 1e-4)
        self.base, self.nodes = float(np.log(rate / (1 - rate))), []
        binned = self._binned(x)
        grow, labels, weights = binned[~held], y[~held], weight[~held]
        score = np.full(len(labels), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(grow, weights * (labels - p), weights * p * (1 - p))
            self.nodes.append(tree)
            score += self._leaves(grow, tree)
        self._calibrate(binned[held] if held.any() else binned, y[held] if held.any() else y)
        return self

    def _grow(self, binned: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size, width = 2 ** (self.depth + 1) - 1, self.bins + 1
        feature, cut, value = np.full(size, -1, dtype=np.int32), np.zeros(size, dtype=np.int16), np.zeros(size)
        node = np.zeros(len(gradient), dtype=np.int64)
        for level in range(self.depth + 1):
            first, count = 2**level - 1, 2**level
            local = node - first
            live = (local >= 0) & (local < count)
            g = np.bincount(local[live], gradient[live], count)
            h = np.bincount(local[live], hessian[live], count)
            value[first : first + count] = self.rate * g / (h + self.ridge)
            if level == self.depth:
                break
            best, choice, bound = np.full(count, 1e-6), np.full(count, -1), np.zeros(count, dtype=int)
            for j in range(binned.shape[1]):
                key = local[live] * width + binned[live, j]
                gl = np.bincount(key, gradient[live], count * width).reshape(count, width).cumsum(1)
                hl = np.bincount(key, hessian[live], count * width).reshape(count, width).cumsum(1)
                gr, hr = g[:, None] - gl, h[:, None] - hl
                gain = gl**2 / (hl + self.ridge) + gr**2 / (hr + self.ridge) - (g**2 / (h + self.ridge))[:, None]
                gain[(hl < self.leaf / 4) | (hr < self.leaf / 4)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(count), at]
                better = top > best
                best[better], choice[better], bound[better] = top[better], j, at[better]
            feature[first : first + count], cut[first : first + count] = choice, bound
            split = live & (choice[np.clip(local, 0, count - 1)] >= 0)
            rows = np.flatnonzero(split)
            j, b = choice[local[rows]], bound[local[rows]]
            node[rows] = 2 * node[rows] + 1 + (binned[rows, j] > b)
        return feature, cut, value

    @staticmethod
    def _leaves(binned: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        feature, cut, value = tree
        node, rows = np.zeros(len(binned), dtype=np.int64), np.arange(len(binned))
        while True:
            j = feature[node]
            inner = j >= 0
            if not inner.any():
                return value[node]
            go = binned[rows, np.maximum(j, 0)] > cut[node]
            node = np.where(inner, 2 * node + 1 + go, node)

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(np.asarray(x, dtype=float))
        return self.base + sum((self._leaves(binned, t) for t in self.nodes), np.zeros(len(binned)))

    def _calibrate(self, binned: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling on rows the trees didn't see."""
        score = self.base + sum((self._leaves(binned, t) for t in self.nodes), np.zeros(len(binned)))
        a, b = 1.0, 0.0
        target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        for _ in range(25):
            p = np.clip(1 / (1 + np.exp(-(a * score + b))), 1e-9, 1 - 1e-9)
            w = p * (1 - p)
            grad = np.array([((p - target) * score).sum() + 1e-3 * (a - 1), (p - target).sum()])
            hess = np.array([[(w * score**2).sum() + 1e-3, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-6]])
            step = np.linalg.solve(hess + 1e-9 * np.eye(2), grad)
            a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -2, 2))
        self.slope, self.shift = max(a, 0.05), b

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -40, 40)))
