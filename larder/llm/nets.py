"""What both recurrent networks share: Adam steps, softmax, and rows of text laid out in windows."""

from __future__ import annotations

import numpy as np


class Adam:
    def __init__(self, weights: dict, rate: float):
        self.weights, self.rate, self.step = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, grads: dict, scale: float = 1.0, most: float = 1.0) -> None:
        """One step; gradients longer than ``most`` together are shortened to it."""
        self.step += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        shrink = min(1.0, most / max(norm, 1e-12))
        for k, g in grads.items():
            g = g * shrink
            self.mean[k] = 0.9 * self.mean[k] + 0.1 * g
            self.square[k] = 0.99 * self.square[k] + 0.01 * g * g
            m = self.mean[k] / (1 - 0.9**self.step)
            s = self.square[k] / (1 - 0.99**self.step)
            self.weights[k] -= (self.rate * scale * m / (np.sqrt(s) + 1e-8)).astype(np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def add_rows(size: int, index: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` by ``index``."""
    out = np.zeros((size, values.shape[1]), np.float32)
    order = np.argsort(index, kind="stable")
    ids, starts = np.unique(index[order], return_index=True)
    out[ids] = np.add.reduceat(values[order], starts, axis=0)
    return out


def glorot(rng, *shape: int) -> np.ndarray:
    return (rng.standard_normal(shape) * np.sqrt(2.0 / (shape[0] + shape[-1]))).astype(np.float32)


class Squash:
    """tanh in place as a quotient of polynomials, right to 0.0017."""

    def __init__(self, shape: tuple[int, int]):
        self.square, self.below = np.empty(shape, np.float32), np.empty(shape, np.float32)

    def __call__(self, x: np.ndarray) -> None:
        np.clip(x, np.float32(-3.79), np.float32(3.79), out=x)
        s, d = self.square[: len(x)], self.below[: len(x)]
        np.multiply(x, x, out=s)
        np.multiply(s, np.float32(15), out=d)
        d += np.float32(420)
        d *= s
        d += np.float32(945)
        x /= d
        np.add(s, np.float32(105), out=d)
        d *= s
        d += np.float32(945)
        x *= d
