"""Boosted trees, lasso logistic regression and isotonic calibration on small dense samples.

These fit on the driver, on samples whose size the caller bounds; scoring runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Tree:
    """Arrays by node; a row goes left when its feature is at most the threshold. Leaves have
    feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            open_ = np.flatnonzero(self.feature[at] >= 0)
            if not len(open_):
                return self.value[at]
            node = at[open_]
            low = x[open_, self.feature[node]] <= self.threshold[node]
            at[open_] = np.where(low, self.left[node], self.right[node])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """Cuts between quantiles of each feature, halfway between neighbouring values."""
    cuts = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > BINS:
            values = np.unique(np.quantile(column, np.linspace(0, 1, BINS), method="nearest"))
        cuts.append((values[1:] + values[:-1]) / 2)
    return cuts


def grow(binned: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray,
         depth: int, least: float = 1.0, ridge: float = 1.0) -> Tree:
    """A regression tree on gradients and second derivatives, level by level."""
    feature, threshold, left, right, value = [], [], [], [], []
    open_ = [(np.arange(len(binned)), 0, -1, False)]
    while open_:
        rows, level, parent, is_right = open_.pop(0)
        node = len(feature)
        if parent >= 0:
            (right if is_right else left)[parent] = node
        g, h = gradient[rows].sum(), weight[rows].sum()
        for column, start in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1),
                              (value, -g / (h + ridge))):
            column.append(start)
        if level == depth or h < 2 * least:
            continue
        best = (1e-6, -1, 0)
        for j, edges in enumerate(cuts):
            if not len(edges):
                continue
            bins = binned[rows, j]
            gl = np.cumsum(np.bincount(bins, gradient[rows], len(edges) + 1))[:-1]
            hl = np.cumsum(np.bincount(bins, weight[rows], len(edges) + 1))[:-1]
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            gain[(hl < least) | (h - hl < least)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], j, k)
        if best[1] >= 0:
            _, j, k = best
            feature[node], threshold[node] = j, float(cuts[j][k])
            low = binned[rows, j] <= k
            open_ += [(rows[low], level + 1, node, False), (rows[~low], level + 1, node, True)]
    return Tree(*(np.array(c) for c in (feature, threshold, left, right, value)))


def boost(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float = 0.15,
          share: float = 0.7, seed: int = 7) -> tuple[float, list[Tree]]:
    """Logistic gradient boosting; each tree sees a random share of the rows."""
    rng = np.random.default_rng(seed)
    cuts = bin_edges(x)
    binned = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T)], 1)
    mean = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(mean / (1 - mean)))
    margin, grown = np.full(len(y), bias), []
    for _ in range(trees):
        p = sigmoid(margin)
        rows = np.flatnonzero(rng.random(len(y)) < share)
        if not len(rows):
            rows = np.arange(len(y))
        tree = grow(binned[rows], cuts, (p - y)[rows], np.maximum(p * (1 - p), 1e-6)[rows], depth)
        tree.value *= rate
        margin += tree.predict(x)
        grown.append(tree)
    return bias, grown


def margins(x: np.ndarray, bias: float, trees: list[Tree]) -> np.ndarray:
    total = np.full(len(x), bias)
    for tree in trees:
        total += tree.predict(x)
    return total


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Weights that minimise the mean logistic loss plus penalty times their absolute sum, by
    accelerated proximal gradient steps; the intercept is free."""
    n, d = x.shape
    design = np.concatenate([np.ones((n, 1)), x], 1)
    probe = np.ones(d + 1)
    for _ in range(30):
        probe = design.T @ (design @ probe)
        probe /= np.linalg.norm(probe)
    step = 4 * n / float(probe @ (design.T @ (design @ probe)))
    w = np.zeros(d + 1)
    mean = (y.sum() + 0.5) / (n + 1)
    w[0] = np.log(mean / (1 - mean))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        gradient = design.T @ (sigmoid(design @ ahead) - y) / n
        new = ahead - step * gradient
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step function closest to y, by pooling adjacent violators. Each
    pool is drawn towards the mean of all by one row, so that no probability is 0 or 1."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, v in zip(score[order].tolist(), y[order].tolist()):
        if pools and pools[-1][3] == s:
            pools[-1][0] += v
            pools[-1][1] += 1
        else:
            pools.append([v, 1.0, s, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            total, n, _, last = pools.pop()
            pools[-1][0] += total
            pools[-1][1] += n
            pools[-1][3] = last
    mean = float(y.mean()) if len(y) else 0.5
    at = [x for p in pools for x in (p[2], p[3])]
    values = [(p[0] + mean) / (p[1] + 1) for p in pools for _ in range(2)]
    return np.array(at), np.maximum.accumulate(np.array(values)) if values else np.array(values)
