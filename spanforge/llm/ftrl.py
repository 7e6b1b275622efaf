"""FTRL-proximal logistic regression over hashed features, with per-coordinate rates and L1 sparsity."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Weights of 2**bits hashed features; feature 0 is the bias (always on, without L1)."""

    def __init__(self, bits: int, alpha: float = 0.1, beta: float = 1.0, l1: float = 1.0, l2: float = 1.0):
        self.z = np.zeros(1 << bits)
        self.n = np.zeros(1 << bits)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights_of(self, idx: np.ndarray) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        l1 = np.where(idx == 0, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, idx: np.ndarray, value: np.ndarray, label: float, weight: float = 1.0) -> float:
        """One example of distinct feature indices; a soft label may lie between 0 and 1. Returns the prior estimate."""
        w = self.weights_of(idx)
        p = float(sigmoid(w @ value))
        g = weight * (p - label) * value
        n = self.n[idx]
        grown = n + g * g
        self.z[idx] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[idx] = grown
        return p

    def dense(self) -> np.ndarray:
        return self.weights_of(np.arange(len(self.z))).astype(np.float32)

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        """Indices and weights that L1 left non-zero."""
        w = self.dense()
        at = np.flatnonzero(w).astype(np.int32)
        return at, w[at]


def sigmoid(x):
    x = np.clip(x, -35, 35)
    return 1.0 / (1.0 + np.exp(-x))


def expand(at: np.ndarray, weight: np.ndarray, bits: int) -> np.ndarray:
    dense = np.zeros(1 << bits, np.float32)
    dense[at] = weight
    return dense
