"""Derivatives of the log-gamma function, for the prior of a handful of rows."""

from __future__ import annotations

import numpy as np


def digamma(x: np.ndarray) -> np.ndarray:
    """Recurrence up to 8, then the asymptotic series."""
    x = np.asarray(x, dtype=float)
    out, y = np.zeros_like(x), x.copy()
    while np.any(y < 8):
        low = y < 8
        out[low] -= 1 / y[low]
        y[low] += 1
    z = 1 / (y * y)
    return out + np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z / 132))))


def trigamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=float)
    out, y = np.zeros_like(x), x.copy()
    while np.any(y < 8):
        low = y < 8
        out[low] += 1 / y[low] ** 2
        y[low] += 1
    z = 1 / (y * y)
    return out + 1 / y + z / 2 + z / y * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z * (1 / 30 - z * 5 / 66))))


def trigamma_inverse(value: float) -> float:
    """x with trigamma(x) = value, by bisection on a logarithmic scale."""
    low, high = 1e-8, 1e8
    for _ in range(200):
        mid = np.sqrt(low * high)
        if trigamma(np.array([mid]))[0] > value:
            low = mid
        else:
            high = mid
    return float(np.sqrt(low * high))
