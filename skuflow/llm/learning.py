"""The logistic function, and logistic fits on bounded samples (op 8)."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def logistic_fit(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 60) -> np.ndarray:
    """Weights of a logistic regression of y (0/1) on the columns of x, squared
    penalty on all of them, by Newton steps with halving.  Add a column of ones
    for an intercept."""
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0.0, np.where(y > 0, -z, z)).sum() + 0.5 * penalty * (w @ w))

    now = loss(w)
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x
        curve[np.diag_indices_from(curve)] += penalty
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-6 and (after := loss(w - size * step)) > now:
            size /= 2
        if size <= 1e-6:
            break
        w = w - size * step
        if now - after < 1e-7 * max(1.0, now):
            break
        now = after
    return w
