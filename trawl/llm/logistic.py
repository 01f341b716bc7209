"""A small logistic regression for bounded samples."""
from __future__ import annotations

import numpy as np


class Logistic:
    """Standardized features, L2 penalty, Newton steps; row weights are optional."""

    def __init__(self, penalty: float = 1.0):
        self.penalty = penalty

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Logistic:
        x, y = np.asarray(x, float), np.asarray(y, float)
        weight = np.ones(len(y)) if weight is None else weight
        self.mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        self.scale = x.std(axis=0) if len(x) else np.ones(x.shape[1])
        self.scale[self.scale < 1e-9] = 1.0
        share = (weight @ y + 0.5) / (weight.sum() + 1.0)
        self.coef = np.zeros(x.shape[1] + 1)
        self.coef[-1] = np.log(share / (1 - share))
        if len(np.unique(y)) < 2:
            return self
        z = self._design(x)
        ridge = np.full(z.shape[1], self.penalty)
        ridge[-1] = 1e-6
        for _ in range(50):
            p = self._sigmoid(z @ self.coef)
            grad = z.T @ (weight * (p - y)) + ridge * self.coef
            hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(hess, grad)
            self.coef -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-8:
                break
        return self

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([z, np.ones((len(z), 1))])

    @staticmethod
    def _sigmoid(v: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(v, -30, 30)))

    def logit(self, x: np.ndarray) -> np.ndarray:
        # Summed feature by feature: the same row scores alike in every batch.
        return (self._design(np.asarray(x, float)) * self.coef).sum(axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self._sigmoid(self.logit(x))
