"""Logistic regression on a bounded matrix, by Newton steps with a ridge penalty."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Logistic:
    """Standardised inputs, weights and an intercept."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weight + self.bias

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Logistic:
    """Without rows, or with one class only, a model that gives the smoothed share of ones."""
    n, d = x.shape
    share = (float(y.sum()) + 0.5) / (n + 1)
    mean, scale = (x.mean(axis=0), x.std(axis=0)) if n else (np.zeros(d), np.ones(d))
    scale = np.where(scale > 1e-9, scale, 1.0)
    if n == 0 or y.min() == y.max():
        return Logistic(mean, scale, np.zeros(d), float(np.log(share / (1 - share))))
    z = np.hstack([(x - mean) / scale, np.ones((n, 1))])
    w = np.zeros(d + 1)
    w[-1] = np.log(share / (1 - share))
    penalty = np.full(d + 1, ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, w[:-1], float(w[-1]))
