"""Small gradient-boosted trees for binary labels (logistic loss), in numpy.

Fitted on a bounded sample in the driver, scored in batches inside tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: ``feature`` and ``threshold`` by (tree, node), ``leaf`` by (tree, leaf)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        total, rows, depth = np.full(len(x), self.base), np.arange(len(x)), self.leaf.shape[1].bit_length() - 1
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (len(leaf) - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32,
        ridge: float = 1.0) -> Trees:
    """Greedy trees on quantile bins; deterministic."""
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    code = np.column_stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(k)]) if n else np.zeros((0, k), int)
    share = min(max(float(y.mean()) if n else 0.5, 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin, features, thresholds, leaves = np.full(n, base), [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        feature, threshold = np.zeros(2 ** depth - 1, dtype=np.int64), np.full(2 ** depth - 1, np.inf)
        for at in range(2 ** depth - 1):
            own = np.flatnonzero(node == at)
            best, gain = None, 1e-6
            if len(own) > 1:
                g, h = grad[own], hess[own]
                whole = g.sum() ** 2 / (h.sum() + ridge)
                for j in range(k):
                    if not len(edges[j]):
                        continue
                    gl = np.cumsum(np.bincount(code[own, j], g, len(edges[j]) + 1))[:-1]
                    hl = np.cumsum(np.bincount(code[own, j], h, len(edges[j]) + 1))[:-1]
                    gr, hr = g.sum() - gl, h.sum() - hl
                    won = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - whole
                    if won.max() > gain:
                        best, gain = (j, int(won.argmax())), float(won.max())
            if best:
                feature[at], threshold[at] = best[0], edges[best[0]][best[1]]
            node[own] = 2 * at + 1 + (x[own, feature[at]] > threshold[at])
        slot = node - (2 ** depth - 1)
        leaf = rate * np.bincount(slot, grad, 2 ** depth) / (np.bincount(slot, hess, 2 ** depth) + ridge)
        margin += leaf[slot]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(leaves))


def calibrate(score: np.ndarray, label: np.ndarray, precision: float) -> float:
    """Least threshold at which held-out scores at or above it are right with that precision (inf: none is)."""
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(label[order]) >= precision * np.arange(1, len(order) + 1)
    last = np.append(score[order][1:] != score[order][:-1], True) if len(order) else np.zeros(0, bool)
    ok = np.flatnonzero(right & last)
    return float(score[order][ok[-1]]) if len(ok) else float("inf")
