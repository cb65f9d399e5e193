"""Gradient-boosted trees of depth two for small labelled samples, with logistic loss."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Binary classifier; fit() on at most a documented number of rows, score() vectorised over rows."""

    def __init__(self, rounds: int = 40, rate: float = 0.3, bins: int = 24):
        self.rounds, self.rate, self.bins = rounds, rate, bins
        self.base = 0.0
        self.trees: list[tuple] = []

    def _split(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, float] | None:
        """The feature and threshold of the greatest gain."""
        best, gain = None, 1e-9
        total_g, total_h = g.sum(), h.sum() + 1.0
        for f in range(x.shape[1]):
            for cut in self.cuts[f]:
                left = x[:, f] <= cut
                n = left.sum()
                if n < 5 or len(left) - n < 5:
                    continue
                gl, hl = g[left].sum(), h[left].sum() + 1.0
                made = gl * gl / hl + (total_g - gl) ** 2 / (total_h - hl + 2.0) - total_g**2 / total_h
                if made > gain:
                    best, gain = (f, float(cut)), made
        return best

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, self.bins))) for f in range(x.shape[1])]
        p = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            prob = 1 / (1 + np.exp(-score))
            g, h = y - prob, prob * (1 - prob)
            root = self._split(x, g, h)
            if root is None:
                break
            side = x[:, root[0]] <= root[1]
            tree = [root]
            for part in (side, ~side):
                sub = self._split(x[part], g[part], h[part])
                if sub is None:
                    v = float(self.rate * g[part].sum() / (h[part].sum() + 1.0))
                    tree.append((0, np.inf, v, v))
                else:
                    low = x[part, sub[0]] <= sub[1]
                    tree.append((*sub, *(float(self.rate * g[part][m].sum() / (h[part][m].sum() + 1.0)) for m in (low, ~low))))
            self.trees.append(tuple(tree))
            score += self._tree(x, self.trees[-1])
        return self

    @staticmethod
    def _tree(x: np.ndarray, tree: tuple) -> np.ndarray:
        (f, cut), a, b = tree
        return np.where(x[:, f] <= cut, np.where(x[:, a[0]] <= a[1], a[2], a[3]), np.where(x[:, b[0]] <= b[1], b[2], b[3]))

    def score(self, row: tuple) -> float:
        """Log-odds of one row, in plain Python."""
        s = self.base
        for (f, cut), a, b in self.trees:
            t = a if row[f] <= cut else b
            s += t[2] if row[t[0]] <= t[1] else t[3]
        return s
