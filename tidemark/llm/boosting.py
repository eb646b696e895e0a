"""Gradient-boosted regression trees with logistic loss, in numpy, and calibration of their scores."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Trees of fixed depth, stored as full binary trees of (feature, threshold) and leaf values."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, least: int = 10, penalty: float = 1.0):
        self.rounds, self.depth, self.rate, self.least, self.penalty = rounds, depth, rate, least, penalty
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.bias, self.slope, self.shift = 0.0, 1.0, 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(p / (1 - p)))
        cuts = [np.unique(np.quantile(col, np.linspace(0, 1, 33)[1:-1])) for col in x.T]
        margin = np.full(len(y), self.bias)
        for _ in range(self.rounds):
            prob = 1 / (1 + np.exp(-margin))
            tree = self._tree(x, y - prob, prob * (1 - prob), cuts)
            self.trees.append(tree)
            margin += self._leaf(tree, x)
        return self

    def _tree(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray]):
        inner = (1 << self.depth) - 1
        feature, cut, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(1 << self.depth)
        node = np.zeros(len(g), np.int64)
        gain_of = lambda a, b: a * a / (b + self.penalty)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            best = 1e-9
            for f, points in enumerate(cuts):
                if len(rows) < 2 * self.least:
                    break
                side = np.searchsorted(points, x[rows, f], side="left")  # right of cut c iff value > points[c]
                gs = np.cumsum(np.bincount(side, weights=g[rows], minlength=len(points) + 1))
                hs = np.cumsum(np.bincount(side, weights=h[rows], minlength=len(points) + 1))
                ns = np.cumsum(np.bincount(side, minlength=len(points) + 1))
                gain = gain_of(gs[:-1], hs[:-1]) + gain_of(gs[-1] - gs[:-1], hs[-1] - hs[:-1]) - gain_of(gs[-1], hs[-1])
                gain[(ns[:-1] < self.least) | (ns[-1] - ns[:-1] < self.least)] = -1
                if len(gain) and gain.max() > best:
                    best, feature[k], cut[k] = gain.max(), f, points[int(gain.argmax())]
            node[rows] = 2 * k + 1 + (x[rows, feature[k]] > cut[k])
        at = node - inner
        gs, hs = np.bincount(at, weights=g, minlength=len(leaf)), np.bincount(at, weights=h, minlength=len(leaf))
        return feature, cut, self.rate * gs / (hs + self.penalty)

    def _leaf(self, tree, x: np.ndarray) -> np.ndarray:
        feature, cut, leaf = tree
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        return leaf[node - len(feature)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.bias + sum((self._leaf(t, x) for t in self.trees), np.zeros(len(x)))

    def calibrate(self, x: np.ndarray, y: np.ndarray, steps: int = 50) -> Boosted:
        """Platt scaling: slope and shift of the margin by Newton steps on rows that were not used to fit."""
        m = self.margin(x)
        a, b = 1.0, 0.0
        for _ in range(steps):
            p = 1 / (1 + np.exp(-(a * m + b)))
            w = p * (1 - p) + 1e-6
            g = np.array([((y - p) * m).sum() - 1e-2 * (a - 1), (y - p).sum()])
            h = np.array([[(w * m * m).sum() + 1e-2, (w * m).sum()], [(w * m).sum(), w.sum() + 1e-2]])
            step = np.linalg.solve(h, g)
            a, b = a + step[0], b + step[1]
        self.slope, self.shift = float(a), float(b)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -50, 50)))


def cautious_threshold(prob: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest probability from which on at least this share of the rows is right."""
    order = np.argsort(-prob, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.flatnonzero(np.append(prob[order][1:] < prob[order][:-1], True) & (right >= precision))
    return float(max(0.5, prob[order][last[-1]])) if len(last) else 1.0
