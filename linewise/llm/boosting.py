"""Gradient-boosted trees for two classes, over histograms, with monotonic constraints.

A trained model is flat: one numpy array for each property of all nodes of all trees, so a
batch is scored by following every tree of every row at once, one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Node k of all trees: ``feature[k]`` (-1 for a leaf), ``threshold[k]`` (at most: left),
    ``left[k]``, ``right[k]`` and ``value[k]``; ``roots`` are the trees' first nodes."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    bias: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of ``x``."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            feature = self.feature[node]
            leaf = feature < 0
            go_left = x[rows, np.where(leaf, 0, feature)] <= self.threshold[node]
            node = np.where(leaf, node, np.where(go_left, self.left[node], self.right[node]))
        return 1 / (1 + np.exp(-(self.bias + self.value[node].sum(axis=1))))


def train(
    x: np.ndarray, y: np.ndarray, rising: tuple[int, ...] = (), trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: int = 5
) -> Forest:
    """Fits log-loss by Newton steps. In no tree does the score fall as a feature of ``rising``
    grows: a split on one is taken only if its right side is at least its left, and the values
    below stay on their side of the middle of the two. Without rows of both classes the forest
    has no tree and gives the smoothed share of class 1."""
    n, width = x.shape
    share = (y.sum() + 1) / (n + 2)
    bias = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    both = 0 < y.sum() < n
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
    codes = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1) if n else np.zeros((0, width), np.int64)
    total = np.full(n, bias)

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + ridge), low, high))

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, level: int, low: float, high: float) -> int:
        k = len(feature)
        g, h = grad[rows].sum(), hess[rows].sum()
        for column, item in ((feature, -1), (threshold, 0.0), (left, k), (right, k), (value, rate * leaf(g, h, low, high))):
            column.append(item)
        best = (1e-9, -1, 0, 0.0, 0.0)
        if level < depth and len(rows) >= 2 * least:
            for f in range(width):
                size = len(edges[f]) + 1
                if size < 2:
                    continue
                own = codes[rows, f]
                gl = np.cumsum(np.bincount(own, grad[rows], size))[:-1]
                hl = np.cumsum(np.bincount(own, hess[rows], size))[:-1]
                nl = np.cumsum(np.bincount(own, minlength=size))[:-1]
                a, b = np.clip(-gl / (hl + ridge), low, high), np.clip(-(g - gl) / (h - hl + ridge), low, high)
                gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                fine = (nl >= least) & (len(rows) - nl >= least)
                fine &= (b >= a) if f in rising else True
                if fine.any():
                    at = int(np.argmax(np.where(fine, gain, -np.inf)))
                    if gain[at] > best[0]:
                        best = (float(gain[at]), f, at, float(a[at]), float(b[at]))
        gain, f, at, a, b = best
        if f < 0:
            total[rows] += value[k]
            return k
        goes = codes[rows, f] <= at
        middle = (a + b) / 2
        bounds = ((low, min(high, middle)), (max(low, middle), high)) if f in rising else ((low, high), (low, high))
        feature[k], threshold[k], value[k] = f, float(edges[f][at]), 0.0
        left[k] = grow(rows[goes], grad, hess, level + 1, *bounds[0])
        right[k] = grow(rows[~goes], grad, hess, level + 1, *bounds[1])
        return k

    for _ in range(trees if both else 0):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(n), p - y, p * (1 - p), 0, -np.inf, np.inf))
    whole = lambda v, kind: np.array(v, kind)
    return Forest(whole(feature, np.int64), whole(threshold, float), whole(left, np.int64), whole(right, np.int64), whole(value, float), whole(roots, np.int64), bias, depth)
