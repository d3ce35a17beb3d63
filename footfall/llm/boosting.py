"""Gradient-boosted trees for two classes, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Forest:
    """Trees of one depth as arrays: node i has the children 2i + 1 (value at most the bound) and 2i + 2."""

    feature: np.ndarray  # trees by inner nodes
    bound: np.ndarray
    value: np.ndarray  # trees by leaves
    start: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        total = np.full(len(x), self.start)
        for feature, bound, value in zip(self.feature, self.bound, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > bound[node])
            total += value[node - inner]
        return total


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 50, depth: int = 4, rate: float = 0.3, smooth: float = 1.0) -> Forest:
    """Newton boosting of the logistic loss; each split is the best of all features and bin bounds."""
    n, features = x.shape
    bounds = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(features)]
    binned = np.stack([np.searchsorted(b, x[:, f], side="left") for f, b in enumerate(bounds)]).astype(np.int64)
    share = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    inner = 2**depth - 1
    forest = Forest(
        np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), float(np.log(share / (1 - share)))
    )
    score = np.full(n, forest.start)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, curvature = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            at = node - first
            total_g = np.bincount(at, gradient, width)
            total_h = np.bincount(at, curvature, width)
            best = np.full(width, 1e-9)
            for f, edges in enumerate(bounds):
                place = at * BINS + binned[f]
                g = np.bincount(place, gradient, width * BINS).reshape(width, BINS).cumsum(axis=1)[:, : len(edges)]
                h = np.bincount(place, curvature, width * BINS).reshape(width, BINS).cumsum(axis=1)[:, : len(edges)]
                rest_g, rest_h = total_g[:, None] - g, total_h[:, None] - h
                gain = g**2 / (h + smooth) + rest_g**2 / (rest_h + smooth) - (total_g**2 / (total_h + smooth))[:, None]
                if gain.shape[1]:
                    cut = gain.argmax(axis=1)
                    better = gain[np.arange(width), cut] > best
                    best[better] = gain[np.arange(width), cut][better]
                    forest.feature[tree, first : first + width][better] = f
                    forest.bound[tree, first : first + width][better] = edges[cut[better]]
            node = 2 * node + 1 + (x[np.arange(n), forest.feature[tree, node]] > forest.bound[tree, node])
        leaf = node - inner
        forest.value[tree] = rate * np.bincount(leaf, gradient, inner + 1) / (np.bincount(leaf, curvature, inner + 1) + smooth)
        score += forest.value[tree, leaf]
    return forest
