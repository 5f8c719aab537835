"""Small boosted trees on binned features, fitted with numpy on a bounded table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Node:
    """A split ``bin(feature) <= at`` with two children, or a leaf with a value."""

    value: float
    feature: int = -1
    at: int = -1
    low: "Node | None" = None
    high: "Node | None" = None

    def predict(self, bins: np.ndarray) -> np.ndarray:
        if self.low is None:
            return np.full(len(bins), self.value)
        return np.where(bins[:, self.feature] <= self.at, self.low.predict(bins), self.high.predict(bins))

    def paths(self, above: tuple = ()) -> list[tuple]:
        """Conjunctions (feature, at, is_low) of every node below the root."""
        if self.low is None:
            return []
        found = []
        for child, is_low in ((self.low, True), (self.high, False)):
            path = (*above, (self.feature, self.at, is_low))
            found += [path, *child.paths(path)]
        return found


def _grow(bins, gradient, hessian, rows, depth: int, ridge: float, least: float) -> Node:
    g, h = gradient[rows], hessian[rows]
    total_g, total_h = g.sum(), h.sum()
    value = -total_g / (total_h + ridge)
    best = (1e-9, None)
    if depth:
        for feature in range(bins.shape[1]):
            column = bins[rows, feature]
            size = int(column.max()) + 1 if len(column) else 0
            if size < 2:
                continue
            low_g, low_h = np.cumsum(np.bincount(column, g, size))[:-1], np.cumsum(np.bincount(column, h, size))[:-1]
            high_g, high_h = total_g - low_g, total_h - low_h
            gain = low_g**2 / (low_h + ridge) + high_g**2 / (high_h + ridge) - total_g**2 / (total_h + ridge)
            gain[(low_h < least) | (high_h < least)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], (feature, at))
    if best[1] is None:
        return Node(value)
    feature, at = best[1]
    is_low = bins[rows, feature] <= at
    args = (depth - 1, ridge, least)
    return Node(
        value, feature, at, _grow(bins, gradient, hessian, rows[is_low], *args),
        _grow(bins, gradient, hessian, rows[~is_low], *args),
    )


def boost(
    bins: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int, depth: int, rate: float = 0.3,
    ridge: float = 1.0, least: float = 1.0,
) -> tuple[float, list[Node], np.ndarray]:
    """Base log odds, trees (their values times ``rate`` add up) and the rows' log odds."""
    share = (np.dot(labels, weights) + 0.5) / (weights.sum() + 1)
    base = float(np.log(share / (1 - share)))
    score, trees, rows = np.full(len(bins), base), [], np.arange(len(bins))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(bins, weights * (p - labels), weights * p * (1 - p), rows, depth, ridge, least)
        trees.append(tree)
        score = score + rate * tree.predict(bins)
    return base, trees, score
