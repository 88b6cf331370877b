"""Histogram gradient-boosted trees in numpy: fitted on a bounded sample, applied as flat arrays."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Trees of one depth, each a complete binary tree in an array: node ``i`` has the children ``2i+1`` and ``2i+2``.

    A row goes right where its feature is above the node's threshold. Missing values (NaN)
    go left. Nodes that weren't split have an infinite threshold.
    """

    def __init__(self, prior: float, features: np.ndarray, thresholds: np.ndarray, values: np.ndarray):
        self.prior, self.features, self.thresholds, self.values = prior, features, thresholds, values

    @property
    def tells(self) -> bool:
        """Whether any node was split; else all rows score alike."""
        return bool(np.isfinite(self.thresholds).any())

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        total = np.full(len(rows), self.prior)
        every = np.arange(len(rows))
        for features, thresholds, values in zip(self.features, self.thresholds, self.values):
            node = np.zeros(len(rows), np.int64)
            for _ in range(int(np.log2(len(values)))):
                node = 2 * node + 1 + (rows[every, features[node]] > thresholds[node])
            total += values[node - len(features)]
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
    smooth: float = 5.0, least: float = 2.0,
) -> Boosted:
    """Logistic loss, second-order gains; without labels or with one kind only, the prior alone."""
    inner, leaves = 2**depth - 1, 2**depth
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    prior = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return Boosted(prior, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    width = rows.shape[1]
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    shifted = binned + np.arange(width) * bins
    total = np.full(len(labels), prior)
    found = []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, bend = labels - chance, chance * (1 - chance)
        features, thresholds = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(labels), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            place = ((node - first)[:, None] * (width * bins) + shifted).ravel()
            shape = count, width, bins
            g, h = (np.bincount(place, np.repeat(x, width), count * width * bins).reshape(shape) for x in (slope, bend))
            left_g, left_h = g.cumsum(axis=2), h.cumsum(axis=2)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + smooth) + right_g**2 / (right_h + smooth) - all_g**2 / (all_h + smooth)
            gain[(left_h < least) | (right_h < least)] = -1
            best = gain.reshape(count, -1).argmax(axis=1)
            for k, b in enumerate(best.tolist()):
                feature, cut = divmod(b, bins)
                if gain[k, feature, cut] > 1e-6 and cut < len(edges[feature]):
                    features[first + k], thresholds[first + k] = feature, edges[feature][cut]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), features[node]] > thresholds[node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, leaves), np.bincount(leaf, bend, leaves)
        values = rate * g / (h + smooth)
        total += values[leaf]
        found.append((features, thresholds, values))
    return Boosted(prior, *(np.stack(x) for x in zip(*found)))
