"""Follow-the-regularised-leader training of sparse linear models on bounded samples."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """FTRL-proximal with elastic net for ``classes`` scores over ``size`` hashed features."""

    def __init__(self, size: int, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.5, l2: float = 1.0):
        self.z, self.n = np.zeros((size, classes)), np.zeros((size, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, at: np.ndarray, gradient: np.ndarray, w: np.ndarray) -> None:
        """``gradient``: of the loss by the weights ``w`` of the features ``at``."""
        n = self.n[at]
        after = n + gradient**2
        self.z[at] += gradient - (np.sqrt(after) - np.sqrt(n)) / self.alpha * w
        self.n[at] = after


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)
