"""Small models that are fitted on the driver from a bounded sample: boosted trees, isotonic
calibration, sparse logistic weights."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Tree:
    """A binary tree in arrays; `feature` is -1 at leaves. A row goes left where its value is at
    most the threshold."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.feature[node] < 0:
                out[rows] = self.value[node]
                continue
            goes = x[rows, self.feature[node]] <= self.threshold[node]
            todo += [(self.left[node], rows[goes]), (self.right[node], rows[~goes])]
        return out


def _edges(x: np.ndarray) -> list[np.ndarray]:
    points = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(column, points)) for column in x.T]


def _grow(
    x: np.ndarray, binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray,
    depth: int, smallest: float, ridge: float,
) -> Tree:
    tree = Tree([], [], [], [], [])

    def add(rows: np.ndarray, left_depth: int) -> int:
        node = len(tree.feature)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        for column, item in (
            (tree.feature, -1), (tree.threshold, 0.0), (tree.left, -1), (tree.right, -1),
            (tree.value, float(-total_g / (total_h + ridge))),
        ):
            column.append(item)
        if left_depth == 0 or total_h < 2 * smallest:
            return node
        best = (1e-6, -1, 0)
        for f, cuts in enumerate(edges):
            if not len(cuts):
                continue
            own = binned[rows, f]
            gs = np.cumsum(np.bincount(own, g[rows], len(cuts) + 1))[:-1]
            hs = np.cumsum(np.bincount(own, h[rows], len(cuts) + 1))[:-1]
            gain = gs**2 / (hs + ridge) + (total_g - gs) ** 2 / (total_h - hs + ridge)
            gain -= total_g**2 / (total_h + ridge)
            gain[(hs < smallest) | (total_h - hs < smallest)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k)
        if best[1] < 0:
            return node
        _, f, k = best
        goes = binned[rows, f] <= k
        tree.feature[node], tree.threshold[node] = f, float(edges[f][k])
        tree.left[node] = add(rows[goes], left_depth - 1)
        tree.right[node] = add(rows[~goes], left_depth - 1)
        return node

    add(np.arange(len(x)), depth)
    return tree


@dataclass
class Boosted:
    base: float
    rate: float
    trees: list[Tree]

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += self.rate * tree.predict(x)
        return total


def boost(
    x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2,
    smallest: float = 1.0, ridge: float = 1.0,
) -> Boosted:
    """Boosted trees for log loss, splits at quantiles."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), rate, [])
    edges = _edges(x)
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    margin = np.full(len(x), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, binned, edges, p - y, p * (1 - p), depth, smallest, ridge)
        model.trees.append(tree)
        margin += rate * tree.predict(x)
    return model


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing step fit of `y` over `margin` (pool adjacent violators), each
    block shrunk towards the middle by one case, between which one may interpolate."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum, count, low, high
    for m, v in zip(margin[order].tolist(), y[order].tolist(), strict=True):
        if blocks and blocks[-1][3] == m:
            blocks[-1][0] += v
            blocks[-1][1] += 1
        else:
            blocks.append([v, 1, m, m])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1][0] += last[0]
            blocks[-1][1] += last[1]
            blocks[-1][3] = last[3]
    xs = [m for b in blocks for m in (b[2], b[3])]
    ys = [(b[0] + 0.5) / (b[1] + 1) for b in blocks for _ in range(2)]
    return np.array(xs), np.maximum.accumulate(ys)


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of L1-penalised logistic regression, by accelerated proximal steps."""
    n, k = x.shape
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias, w = float(np.log(share / (1 - share))), np.zeros(k)
    size = 4 / max(1e-9, float(np.linalg.eigvalsh(x.T @ x / n + np.outer(x.mean(0), x.mean(0)))[-1]) + 1)
    ahead_w, ahead_b, t = w.copy(), bias, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ ahead_w + ahead_b)))
        next_w = ahead_w - size * (x.T @ (p - y)) / n
        next_w = np.sign(next_w) * np.maximum(np.abs(next_w) - size * penalty, 0)
        next_b = ahead_b - size * float((p - y).mean())
        next_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w = next_w + (t - 1) / next_t * (next_w - w)
        ahead_b = next_b + (t - 1) / next_t * (next_b - bias)
        w, bias, t = next_w, next_b, next_t
    return bias, w
