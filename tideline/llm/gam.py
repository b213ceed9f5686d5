"""Generalised additive model with pairwise interactions, for binary labels.

Features are cut into quantile bins. Boosting goes round the features in turn, each
time fitting a tree of at most ``LEAVES`` leaves on one feature's bins and adding it,
damped, to that feature's lookup table. With the main effects fixed, pairs of features
are ranked by how much a four-leaf tree over both explains of the residual, and the
best are boosted the same way over a coarser grid. A score is then a sum of table
entries: one vectorised addition per table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 48
PAIR_BINS = 12
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 8
LEAVES = 3
RATE = 0.15
L2 = 4.0


@dataclass
class Gam:
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        if self.pairs:
            coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], side="right") for p in self.pairs for j in p}
            for (a, b), table in zip(self.pairs, self.pair_tables):
                out += table[coarse[a], coarse[b]]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + L2)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values over ordered bins from gradient and Hessian sums, by greedy splits."""
    spans, value = [(0, len(g))], np.zeros(len(g))
    cg, ch = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))
    while len(spans) < LEAVES:
        best = (1e-9, None, None)
        for k, (a, z) in enumerate(spans):
            if z - a < 2:
                continue
            cut = np.arange(a + 1, z)
            left_g, left_h = cg[cut] - cg[a], ch[cut] - ch[a]
            all_g, all_h = cg[z] - cg[a], ch[z] - ch[a]
            gain = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], k, int(cut[i]))
        if best[1] is None:
            break
        a, z = spans.pop(best[1])
        spans += [(a, best[2]), (best[2], z)]
    for a, z in spans:
        value[a:z] = (cg[z] - cg[a]) / (ch[z] - ch[a] + L2)
    return value


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best four-leaf tree (one cut along each axis) over a grid, and its gain."""
    value = np.zeros_like(g)
    if min(g.shape) < 2:
        return 0.0, value
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    a_g, a_h = cg[:-1, :-1], ch[:-1, :-1]
    b_g, b_h = cg[:-1, -1:] - a_g, ch[:-1, -1:] - a_h
    c_g, c_h = cg[-1:, :-1] - a_g, ch[-1:, :-1] - a_h
    d_g, d_h = tg - a_g - b_g - c_g, th - a_h - b_h - c_h
    gain = _gain(a_g, a_h) + _gain(b_g, b_h) + _gain(c_g, c_h) + _gain(d_g, d_h) - _gain(tg, th)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    for rows, cols, lg, lh in (
        (slice(0, i + 1), slice(0, j + 1), a_g, a_h),
        (slice(0, i + 1), slice(j + 1, None), b_g, b_h),
        (slice(i + 1, None), slice(0, j + 1), c_g, c_h),
        (slice(i + 1, None), slice(j + 1, None), d_g, d_h),
    ):
        value[rows, cols] = lg[i, j] / (lh[i, j] + L2)
    return float(gain[i, j]), value


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS, pair_rounds: int = PAIR_ROUNDS) -> Gam:
    """Fit on rows ``x`` and 0/1 labels ``y``. Without rows every probability is a half."""
    n, width = x.shape
    base = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))) if n else 0.0
    edges = [cuts(x[:, j], BINS) for j in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    if not n:
        return Gam(base, edges, tables, [], [], [])
    binned = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(width)]
    logit = np.full(n, base)
    for _ in range(rounds):
        for j in range(width):
            p = sigmoid(logit)
            size = len(tables[j])
            step = RATE * _tree(np.bincount(binned[j], y - p, size), np.bincount(binned[j], p * (1 - p), size))
            tables[j] += step
            logit += step[binned[j]]
    coarse_edges = [cuts(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(coarse_edges[j], x[:, j], side="right") for j in range(width)]

    def sums(a: int, b: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(coarse_edges[a]) + 1, len(coarse_edges[b]) + 1)
        cell = coarse[a] * shape[1] + coarse[b]
        size = shape[0] * shape[1]
        return np.bincount(cell, y - p, size).reshape(shape), np.bincount(cell, p * (1 - p), size).reshape(shape)

    p = sigmoid(logit)
    ranked = sorted(((_pair_tree(*sums(a, b, p))[0], a, b) for a in range(width) for b in range(a)), reverse=True)
    chosen = [(a, b) for gain, a, b in ranked[:pairs] if gain > 0]
    pair_tables = [np.zeros((len(coarse_edges[a]) + 1, len(coarse_edges[b]) + 1)) for a, b in chosen]
    for _ in range(pair_rounds):
        for (a, b), table in zip(chosen, pair_tables):
            step = RATE * _pair_tree(*sums(a, b, sigmoid(logit)))[1]
            table += step
            logit += step[coarse[a], coarse[b]]
    return Gam(base, edges, tables, chosen, coarse_edges, pair_tables)
