"""Logistic regression on a bounded sample, by Newton steps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 1.0, turns: int = 25) -> Logistic:
        """With one class only (or no rows) it gives that class's smoothed share everywhere."""
        n, k = x.shape
        mean = x.mean(0) if n else np.zeros(k)
        scale = x.std(0) if n else np.ones(k)
        scale = np.where(scale > 1e-9, scale, 1.0)
        share = (y.sum() + 0.5) / (n + 1)
        w = np.concatenate([np.zeros(k), [logit(np.array(share))]])
        if n and 0 < y.sum() < n:
            z = np.hstack([(x - mean) / scale, np.ones((n, 1))])
            keep = np.concatenate([np.full(k, penalty), [1e-6]])
            for _ in range(turns):
                p = sigmoid(z @ w)
                slope = z.T @ (y - p) - keep * w
                curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(keep)
                step = np.linalg.solve(curve, slope)
                w = w + np.clip(step, -5, 5)
                if np.abs(step).max() < 1e-6:
                    break
        return cls(mean, scale, w)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))]) @ self.weights

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))
