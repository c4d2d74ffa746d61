"""Regularised logistic regression on a bounded sample, by Newton steps or gradient descent."""

from __future__ import annotations

import numpy as np


def fit_logistic(
    x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, penalty: float = 1.0, steps: int = 30
) -> np.ndarray:
    """Intercept and coefficients; few columns only (one Newton system per step).  The intercept is free."""
    design = np.hstack([np.ones((len(x), 1)), np.asarray(x, dtype=np.float64)])
    weights = np.ones(len(x)) if weights is None else weights
    ridge = np.eye(design.shape[1]) * penalty
    ridge[0, 0] = 1e-6
    beta = np.zeros(design.shape[1])

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float(np.sum(weights * (np.logaddexp(0, z) - y * z)) + 0.5 * b @ ridge @ b)

    now = loss(beta)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -35, 35)))
        gradient = design.T @ (weights * (p - y)) + ridge @ beta
        hessian = (design * (weights * p * (1 - p))[:, None]).T @ design + ridge
        move = np.linalg.solve(hessian + 1e-9 * np.eye(len(beta)), gradient)
        scale = 1.0
        while scale > 1e-4 and loss(beta - scale * move) > now:
            scale /= 2
        after = loss(beta - scale * move)
        if now - after < 1e-8 * max(1.0, abs(now)):
            break
        beta, now = beta - scale * move, after
    return beta


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
