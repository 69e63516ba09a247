"""Gradient-boosted trees in numpy: histogram splits, logistic loss, monotone features, flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf is its own child, so `depth` steps end at a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.start)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                below = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: np.ndarray,
    *,
    trees: int = 80,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 64,
    penalty: float = 2.0,
    least: float = 3.0,
) -> Trees:
    """Boosted trees for y in {0, 1}. `monotone` has +1, -1 or 0 for each column: the score never falls (rises) with it.

    A split on such a column must order its two leaf values; the midpoint then bounds all leaves below, so the
    whole tree keeps the order. Without rows, or with one label, the trees are a constant.
    """
    n, width = x.shape
    mean = (y.sum() + 1) / (n + 2)
    start = float(np.log(mean / (1 - mean)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node(v: float) -> int:
        k = len(value)
        for array, item in zip((feature, threshold, left, right, value), (0, np.inf, k, k, v), strict=True):
            array.append(item)
        return k

    if n and 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
        offsets = np.arange(width) * (bins + 1)
        margin = np.full(n, start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            gradient, weight = y - p, p * (1 - p)

            def leaf(g, h, low, high):
                return np.clip(g / (h + penalty), low, high)

            def grow(rows, low, high, level, gradient=gradient, weight=weight):
                g, h = gradient[rows].sum(), weight[rows].sum()
                me = node(rate * float(leaf(g, h, low, high)))
                if level == depth or len(rows) < 2:
                    margin[rows] += value[me]
                    return me
                flat = (binned[rows] + offsets).ravel()
                size = width * (bins + 1)
                gl = np.bincount(flat, np.repeat(gradient[rows], width), size).reshape(width, -1).cumsum(1)[:, :-1]
                hl = np.bincount(flat, np.repeat(weight[rows], width), size).reshape(width, -1).cumsum(1)[:, :-1]
                gr, hr = g - gl, h - hl
                vl, vr = leaf(gl, hl, low, high), leaf(gr, hr, low, high)

                def gain(s, w, v):
                    return s * v - 0.5 * (w + penalty) * v * v

                gains = gain(gl, hl, vl) + gain(gr, hr, vr) - gain(g, h, leaf(g, h, low, high))
                wrong = (hl < least) | (hr < least) | (monotone[:, None] * (vr - vl) < 0)
                for f, c in enumerate(cuts):
                    wrong[f, len(c) :] = True
                gains[wrong] = -np.inf
                f, b = np.unravel_index(int(np.argmax(gains)), gains.shape)
                if not gains[f, b] > 1e-9:
                    margin[rows] += value[me]
                    return me
                middle = float(vl[f, b] + vr[f, b]) / 2
                bounds_l, bounds_r = (low, high), (low, high)
                if monotone[f] > 0:
                    bounds_l, bounds_r = (low, middle), (middle, high)
                elif monotone[f] < 0:
                    bounds_l, bounds_r = (middle, high), (low, middle)
                below = binned[rows, f] <= b
                feature[me], threshold[me] = int(f), float(cuts[f][b])
                left[me] = grow(rows[below], *bounds_l, level + 1)
                right[me] = grow(rows[~below], *bounds_r, level + 1)
                return me

            roots.append(grow(np.arange(n), -np.inf, np.inf, 0))
    arrays = (np.array(a) for a in (feature, threshold, left, right, value))
    f, t, l, r, v = arrays
    return Trees(f.astype(np.int64), t.astype(float), l.astype(np.int64), r.astype(np.int64), v.astype(float), np.array(roots, np.int64), depth, start)
