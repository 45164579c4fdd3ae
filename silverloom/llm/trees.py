"""Gradient-boosted regression trees for a yes/no label, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Complete trees of one depth: node i splits on feature[i] >= cut[i]; leaves hold log-odds."""

    feature: np.ndarray  # trees x (2**depth - 1)
    cut: np.ndarray
    leaf: np.ndarray  # trees x 2**depth
    start: float
    depth: int

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] >= c[at])
            out += leaf[at - (2**self.depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.3, bins: int = 32, ridge: float = 0.3) -> Boosted:
    """Newton boosting on the logistic loss with histograms: a bin for each value of a feature, or up to `bins` quantile bins."""
    n, m = x.shape

    def between(v: np.ndarray) -> np.ndarray:
        own = np.unique(v)
        return (own[1:] + own[:-1]) / 2 if len(own) <= bins else np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))

    edges = [between(x[:, j]) for j in range(m)]
    two = np.asarray([len(e) < 2 for e in edges])  # features of two bins: sums over the upper one are a matrix product
    binned = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)
    inner, leaves = 2**depth - 1, 2**depth
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    upper, many = (binned[:, two] > 0).astype(np.float64), binned[:, ~two]
    wide = many.shape[1]
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(p0 / (1 - p0)))
    score = np.full(n, start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            width, base = 2**level, 2**level - 1
            own = np.zeros((width, n))
            own[at - base, np.arange(n)] = 1
            cell = (((at - base)[:, None] * wide + np.arange(wide)) * bins + many).ravel()
            sums = []
            for v in (g, h):
                s = np.zeros((width, m, bins))
                s[:, ~two] = np.bincount(cell, np.repeat(v, wide), width * wide * bins).reshape(width, wide, bins)
                s[:, two, 1] = (own * v) @ upper
                s[:, two, 0] = (own @ v)[:, None] - s[:, two, 1]
                sums.append(s)
            gs, hs = sums
            gl, hl = gs.cumsum(axis=2), hs.cumsum(axis=2)
            ga, ha = gl[..., -1:], hl[..., -1:]
            gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
            for k in range(width):
                j, b = np.unravel_index(np.argmax(gain[k]), (m, bins))
                if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                    feature[t, base + k], cut[t, base + k] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] >= cut[t, at])
        own = at - inner
        leaf[t] = rate * np.bincount(own, g, leaves) / (np.bincount(own, h, leaves) + ridge)
        score += leaf[t, own]
    return Boosted(feature, cut, leaf, start, depth)
