"""Gradient-boosted trees on weighted counts of small integer features, as a Column for scoring.

What is fitted is a table of distinct feature combinations with their counts, so its size is bounded by the product of
the features' ranges, not by the number of rows behind it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Tree = tuple[int, int, "Tree | float", "Tree | float"] | float  # feature, cut (at most: left), left, right


class BoostedTrees:
    def __init__(self, x: np.ndarray, good: np.ndarray, bad: np.ndarray, rounds: int = 24, depth: int = 3, rate: float = 0.4):
        """x: combinations; good, bad: how many rows of either label each has."""
        total = good + bad
        self.base = math.log((good.sum() + 1) / (bad.sum() + 1))
        self.trees: list[Tree] = []
        score = np.full(len(x), self.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(x, good - total * p, total * p * (1 - p), depth, rate)
            self.trees.append(tree)
            score = score + self._apply(tree, x)

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, rate: float) -> Tree:
        leaf = lambda m: rate * g[m].sum() / (h[m].sum() + 1)
        gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
        every, best, found = np.ones(len(x), bool), 1e-6, None
        if depth and len(x):
            for f in range(x.shape[1]):
                for cut in np.unique(x[:, f])[:-1]:
                    left = x[:, f] <= cut
                    if (more := gain(left) + gain(~left) - gain(every)) > best:
                        best, found = more, (f, int(cut), left)
        if found is None:
            return float(leaf(every)) if len(x) else 0.0
        f, cut, left = found
        return f, cut, self._grow(x[left], g[left], h[left], depth - 1, rate), self._grow(x[~left], g[~left], h[~left], depth - 1, rate)

    def _apply(self, tree: Tree, x: np.ndarray) -> np.ndarray:
        if isinstance(tree, float):
            return np.full(len(x), tree)
        f, cut, left, right = tree
        return np.where(x[:, f] <= cut, self._apply(left, x), self._apply(right, x))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-sum((self._apply(t, x) for t in self.trees), np.full(len(x), self.base))))

    def log_odds(self, features: Sequence[Column]) -> Column:
        def of(tree: Tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            f, cut, left, right = tree
            return F.when(features[f] <= cut, of(left)).otherwise(of(right))

        out = F.lit(self.base)
        for tree in self.trees:
            out = out + of(tree)
        return out
