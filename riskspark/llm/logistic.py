"""A small penalised logistic regression for calibration on bounded samples."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights of raw features and intercept, by Newton steps on standardised features.

    With no rows or one class only, the weights are zero and the score is the (smoothed) rate.
    """
    x = np.atleast_2d(np.asarray(x, float))
    y = np.asarray(y, float)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(x.shape[1]), float(np.log(rate / (1 - rate)))
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1
    a = np.hstack([(x - mean) / spread, np.ones((len(y), 1))])
    ridge = np.full(a.shape[1], penalty)
    ridge[-1] = 1e-9
    w = np.zeros(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        step = np.linalg.solve(
            (a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge) + 1e-9 * np.eye(len(w)),
            a.T @ (y - p) - ridge * w,
        )
        w += step
        if np.abs(step).max() < 1e-9:
            break
    raw = w[:-1] / spread
    return raw, float(w[-1] - raw @ mean)


def score(x: np.ndarray, weights: np.ndarray, intercept: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights + intercept, -40, 40)))
