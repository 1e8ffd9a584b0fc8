"""Fitting small linear models on a bounded sample (numpy, on the driver)."""

from __future__ import annotations

import numpy as np


def scores(offsets: np.ndarray, index: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    """Linear scores of sparse rows: row i has the features index[offsets[i]:offsets[i+1]]."""
    sums = np.concatenate(([0.0], np.cumsum(weight[index], dtype=np.float64)))
    return sums[offsets[1:]] - sums[offsets[:-1]] + bias


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Adam:
    """Full-batch Adam steps on one vector."""

    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, x: np.ndarray, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * grad
        self.v = 0.999 * self.v + 0.001 * grad * grad
        return x - self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)


def spread(offsets: np.ndarray, index: np.ndarray, per_row: np.ndarray, size: int) -> np.ndarray:
    """Sum over rows of per_row times the row's feature indicators."""
    return np.bincount(index, weights=np.repeat(per_row, np.diff(offsets)), minlength=size)


def minimise(f, x: np.ndarray, passes: int, tolerance: float, memory: int = 8) -> np.ndarray:
    """The least point of a smooth convex ``f`` (value, gradient) by limited-memory quasi-Newton steps with halved step sizes; ends when no
    part of the gradient exceeds ``tolerance``, or after ``passes`` evaluations."""
    value, grad = f(x)
    moves, turns, n = [], [], 1
    while n < passes and np.abs(grad).max() > tolerance:
        way, kept = grad.copy(), []
        for s, y in zip(moves[::-1], turns[::-1]):
            kept.append((s @ way) / (s @ y))
            way -= kept[-1] * y
        way *= (moves[-1] @ turns[-1]) / (turns[-1] @ turns[-1]) if moves else 1 / max(np.linalg.norm(way), 1)
        for s, y, a in zip(moves, turns, kept[::-1]):
            way += s * (a - (y @ way) / (s @ y))
        step, slope = 1.0, grad @ way
        while True:
            at = x - step * way
            there, slant = f(at)
            n += 1
            if there <= value - 1e-4 * step * slope or step < 1e-6 or n >= passes:
                break
            step /= 2
        if (at - x) @ (slant - grad) > 1e-12:
            moves, turns = [*moves, at - x][-memory:], [*turns, slant - grad][-memory:]
        x, value, grad = at, there, slant
    return x


def logistic(offsets, index, scale, y, rows, l2: float = 1.0, passes: int = 200, tolerance: float = 1e-5):
    """Weights (already times the feature scale) and bias of a logistic regression on indicator features scaled by
    ``scale``, each row's sum by ``rows``. Both classes have the same total weight; ``l2`` is that of a normal prior on the weights, spread
    over the rows; fitted until the gradient vanishes."""
    n, ones = len(y), max(y.sum(), 1)
    own = np.where(y == 1, 0.5 / ones, 0.5 / max(n - ones, 1))

    def risk(at):
        w, b = at[:-1], at[-1]
        z = scores(offsets, index, w * scale, 0.0) * rows + b
        g = own * (sigmoid(z) - y)
        value = (own * np.logaddexp(0, (1 - 2 * y) * z)).sum() + l2 / (2 * n) * (w @ w)
        return value, np.append(spread(offsets, index, g * rows, len(scale)) * scale + l2 / n * w, g.sum())

    x = minimise(risk, np.zeros(len(scale) + 1), passes, tolerance)
    return x[:-1] * scale, float(x[-1])
