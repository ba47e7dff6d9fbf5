"""Gradient-boosted trees for a two-class problem on a bounded table.

Histogram splits, logistic loss, second-order leaf values. Fitted on the
driver on a sample whose size is bounded by the caller; the fitted trees are
a few arrays that tasks evaluate on whole batches.
"""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, min_weight: float = 1.0, penalty: float = 1.0):
        self.rounds, self.depth, self.rate = rounds, depth, rate
        self.min_weight, self.penalty = min_weight, penalty
        self.start = 0.0
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        edges = [np.unique(np.quantile(x[:, f], quantiles, method="lower")) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        raw = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-raw))
            feature, cut, value, leaf = self._tree(binned, edges, y - p, p * (1 - p))
            self.trees.append((feature, cut, value))
            raw += value[leaf]
        return self

    def _tree(self, binned, edges, gradient, weight):
        """A complete tree: node i has children 2i+1 (x <= cut) and 2i+2."""
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(gradient), dtype=np.int64)
        for i in range(inner):
            rows = np.flatnonzero(node == i)
            best = (1e-6, None, None)
            total_g, total_w = gradient[rows].sum(), weight[rows].sum()
            for f, e in enumerate(edges if len(rows) else []):
                g = np.cumsum(np.bincount(binned[rows, f], gradient[rows], BINS))[:len(e)]
                w = np.cumsum(np.bincount(binned[rows, f], weight[rows], BINS))[:len(e)]
                gain = (g ** 2 / (w + self.penalty) + (total_g - g) ** 2 / (total_w - w + self.penalty)
                        - total_g ** 2 / (total_w + self.penalty))
                gain[(w < self.min_weight) | (total_w - w < self.min_weight)] = 0
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), f, int(gain.argmax()))
            if best[1] is not None:
                feature[i], cut[i] = best[1], edges[best[1]][best[2]]
                node[rows] = np.where(binned[rows, best[1]] <= best[2], 2 * i + 1, 2 * i + 2)
            else:
                node[rows] = 2 * i + 1
        leaf = node - inner
        g, w = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, weight, inner + 1)
        return feature, cut, self.rate * g / (w + self.penalty), leaf

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1."""
        total = np.full(len(x), self.start)
        at = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[at, feature[node]] > cut[node])
            total += value[node - len(feature)]
        return total
