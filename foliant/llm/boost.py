"""Gradient-boosted regression trees for yes-or-no decisions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

TREES, DEPTH, RATE, BINS, LEAST = 40, 3, 0.2, 32, 8


@dataclass
class Tree:
    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def leaf(self, value: float) -> int:
        for a, x in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.value, value)):
            a.append(x)
        return len(self.value) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        for _ in range(DEPTH):
            f = feature[at]
            inner = f >= 0
            go = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= cut[at], left[at], right[at])
            at = np.where(inner, go, at)
        return np.array(self.value)[at]


class Booster:
    """Logistic loss; the splits are tried at quantiles of each feature."""

    def __init__(self) -> None:
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Booster:
        x, y = np.asarray(x, float), np.asarray(y, float)
        w = np.ones(len(y)) if weight is None else np.asarray(weight, float)
        rate = (w @ y + 0.1) / (w.sum() + 2)  # without rows: no
        self.base = float(np.log(rate / (1 - rate)))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) if len(c) else c for c in x.T]
        codes = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], 1) if x.size else x
        score = np.full(len(y), self.base)
        for _ in range(TREES if len(y) >= 2 * LEAST else 0):
            p = 1 / (1 + np.exp(-score))
            tree = Tree()
            self._grow(tree, codes, cuts, w * (y - p), w * p * (1 - p), np.arange(len(y)), 0)
            self.trees.append(tree)
            score = score + tree.predict(x)
        return self

    def _grow(self, tree, codes, cuts, g, h, rows, depth) -> int:
        gs, hs = g[rows].sum(), h[rows].sum()
        me = tree.leaf(RATE * gs / (hs + 1.0))
        if depth == DEPTH or len(rows) < 2 * LEAST:
            return me
        best, where = 1e-6, None
        for f, c in enumerate(cuts):
            k = codes[rows, f]
            gl = np.cumsum(np.bincount(k, g[rows], len(c) + 1))[:-1]
            hl = np.cumsum(np.bincount(k, h[rows], len(c) + 1))[:-1]
            n = np.cumsum(np.bincount(k, minlength=len(c) + 1))[:-1]
            gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
            gain = np.where((n >= LEAST) & (len(rows) - n >= LEAST), gain, 0)
            if len(gain) and gain.max() > best:
                best, where = gain.max(), (f, int(gain.argmax()))
        if where is None:
            return me
        f, b = where
        tree.feature[me], tree.cut[me] = f, float(cuts[f][b])
        low = codes[rows, f] <= b
        tree.left[me] = self._grow(tree, codes, cuts, g, h, rows[low], depth + 1)
        tree.right[me] = self._grow(tree, codes, cuts, g, h, rows[~low], depth + 1)
        return me

    def probability(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        if not len(x):
            return np.zeros(0)
        return 1 / (1 + np.exp(-sum((t.predict(x) for t in self.trees), np.full(len(x), self.base))))
