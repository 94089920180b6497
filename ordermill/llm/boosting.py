"""Histogram gradient-boosted trees in numpy, flat arrays throughout."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class BoostedTrees:
    """Complete binary trees of one depth: inner nodes in level order, children of node k at 2k + 1 and 2k + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; larger values go right
    leaf: np.ndarray  # trees x leaves

    def probability(self, values: np.ndarray) -> np.ndarray:
        """Chance of label 1 for rows of features; all rows go down all trees together."""
        trees, inner = self.feature.shape
        total = np.full(len(values), self.base)
        if trees and len(values):
            node = np.zeros((len(values), trees), dtype=np.int64)
            row, tree = np.arange(len(values))[:, None], np.arange(trees)[None, :]
            for _ in range((inner + 1).bit_length() - 1):
                right = values[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            total = total + self.leaf[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(
    values: np.ndarray,
    labels: np.ndarray,
    trees: int = 120,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    penalty: float = 1.0,
    least: float = 1.0,
) -> BoostedTrees:
    """Trees for labels 0 and 1 by logistic loss; splits are chosen on histograms over `bins` quantile bins of each feature.

    `penalty` shrinks leaves, `least` is the smallest sum of second derivatives in a child. Rows of one label, or none, give a
    model without trees whose probability is that of the labels, one of each added.
    """
    n, features = values.shape
    ones = float(labels.sum())
    base = float(np.log((ones + 1) / (n - ones + 1)))
    inner, leaves = 2**depth - 1, 2**depth
    if ones in (0, n):
        return BoostedTrees(base, np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for column in values.T]
    binned = np.stack([np.searchsorted(edge, column, side="left") for edge, column in zip(edges, values.T, strict=True)], axis=1)
    cell = binned + np.arange(features) * bins  # value <= edge k goes to bin k or lower
    raw = np.full(n, base)
    model = BoostedTrees(
        base, np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    )
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-raw))
        slope, curve = chance - labels, chance * (1 - chance)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            place = ((node - first)[:, None] * features * bins + cell).ravel()
            shape = (nodes, features, bins)
            g = np.bincount(place, np.repeat(slope, features), nodes * features * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(place, np.repeat(curve, features), nodes * features * bins).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + penalty) + (all_g - g) ** 2 / (all_h - h + penalty) - all_g**2 / (all_h + penalty)
            gain[(h < least) | (all_h - h < least)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for k in range(nodes):
                column, at = divmod(int(best[k]), bins)
                if gain[k, column, at] > 1e-9 and at < len(edges[column]):
                    model.feature[tree, first + k], model.threshold[tree, first + k] = column, edges[column][at]
            right = values[np.arange(n), model.feature[tree, node]] > model.threshold[tree, node]
            node = 2 * node + 1 + right
        g = np.bincount(node - inner, slope, leaves)
        h = np.bincount(node - inner, curve, leaves)
        model.leaf[tree] = -rate * g / (h + penalty)
        raw += model.leaf[tree, node - inner]
    return model
