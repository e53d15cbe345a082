"""Follow-the-regularised-leader training of sparse linear models (one task, bounded sample)."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Per-coordinate FTRL-proximal with elastic-net penalty for ``outputs`` linear scores."""

    def __init__(self, features: int, outputs: int, rate: float, smooth: float = 1.0, l1: float = 0.0, l2: float = 0.0):
        self.z = np.zeros((features, outputs))
        self.n = np.zeros((features, outputs))
        self.rate, self.smooth, self.l1, self.l2 = rate, smooth, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Closed-form weights of the coordinates ``at``; exactly zero where |z| <= l1."""
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.smooth + np.sqrt(n)) / self.rate + self.l2)

    def learn(self, at: np.ndarray, value: np.ndarray, error: np.ndarray) -> None:
        """One example with features ``at`` (distinct) and ``error`` = prediction - truth per output."""
        w = self.weights(at)
        grad = value[:, None] * error[None, :]
        square = grad * grad
        step = (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / self.rate
        self.z[at] += grad - step * w
        self.n[at] += square


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """The temperature in [0.05, 20] with the least log loss of softmax(scores / T), by golden section on ln T."""

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean())

    if not len(truth):
        return 1.0
    low, high, part = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))
