"""A one-layer convolutional network over bytes, in numpy.

Filters of several even widths see bytes one-hot, so a filter of width w is a
table of w x 256 weights. A unit (a fixed number of byte positions) is pooled
by the maximum of each filter over its positions, passed through a ReLU and a
linear head. For speed two neighbouring bytes are looked up at once in a table
of their summed weights. Texts lie behind each other in one array, each padded
with zero bytes before and up to whole units, so a block of many texts is one computation.
"""

from __future__ import annotations

import numpy as np

from tarmac.llm.common import Block

#: Zero bytes before each text, so that no filter sees two texts.
MARGIN = 8

#: Steps of training at least, however few windows there are.
LEAST_STEPS = 300

#: Positions computed at a time, so that intermediate values stay in cache.
STRIP = 1 << 14


def padded(block: Block, unit: int) -> tuple[np.ndarray, np.ndarray]:
    """The block's texts, each from a whole unit on, and the first unit of
    each row (rows + 1 entries). An empty text has one unit of zeros."""
    sizes = np.diff(block.off)
    units = np.concatenate(([0], np.cumsum(-(-(sizes + MARGIN) // unit))))
    flat = np.zeros(int(units[-1]) * unit + MARGIN, np.uint8)
    moved = np.repeat(units[:-1] * unit + MARGIN - block.off[:-1], sizes)
    flat[np.arange(len(block.buf)) + moved] = block.buf
    return flat, units


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)


class ByteCnn:
    def __init__(self, widths: tuple[int, ...], filters: int, classes: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.widths, self.filters, self.classes = widths, filters, classes
        self.tables = [rng.normal(0, 0.3 / np.sqrt(w), (w, 256, filters)).astype(np.float32)
                       for w in widths]
        self.bias = np.zeros(filters * len(widths), np.float32)
        self.head = rng.normal(0, 0.1, (filters * len(widths), classes)).astype(np.float32)
        self.head_bias = np.zeros(classes, np.float32)

    def _pairs(self) -> list[list[np.ndarray]]:
        """Per width: tables over two bytes, one for each second position."""
        return [[(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, self.filters)
                 for j in range(0, len(t), 2)] for t in self.tables]

    def pooled(self, flat: np.ndarray, unit: int) -> np.ndarray:
        """Largest value of each filter in each unit of a padded array, bias
        included, before the ReLU. ``unit`` is a power of two."""
        n = len(flat) - MARGIN
        codes = flat[:-1].astype(np.uint16) << np.uint16(8)
        codes |= flat[1:]
        pairs = self._pair_cache = getattr(self, "_pair_cache", None) or self._pairs()
        out = np.empty((n // unit, self.filters * len(self.widths)), np.float32)
        for lo in range(0, n, STRIP):
            hi = min(lo + STRIP, n)
            for i, tables in enumerate(pairs):
                values = np.take(tables[0], codes[lo:hi], axis=0, mode="clip")
                for j, table in enumerate(tables[1:], 1):
                    values += np.take(table, codes[lo + 2 * j:hi + 2 * j], axis=0, mode="clip")
                values = values.reshape(-1, unit, self.filters)
                half = unit // 2
                while half:
                    np.maximum(values[:, :half], values[:, half:2 * half], out=values[:, :half])
                    half //= 2
                out[lo // unit:hi // unit, i * self.filters:(i + 1) * self.filters] = values[:, 0]
        return out + self.bias

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.head + self.head_bias

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_pair_cache"}

    def fit(self, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray, epochs: int,
            rate: float = 0.01, decay: float = 1e-5, batch: int = 128, seed: int = 0) -> None:
        """Cross-entropy by Adam. ``windows``: (n, unit + MARGIN) bytes. A small
        sample is gone through more often, for ``LEAST_STEPS`` steps at least."""
        rng = np.random.default_rng(seed)
        epochs = max(epochs, -(-LEAST_STEPS * batch // len(windows)))
        adam = Adam([*self.tables, self.bias, self.head, self.head_bias], rate)
        positions = windows.shape[1] - MARGIN
        for epoch in range(epochs):
            adam.rate = rate * (1 - epoch / epochs) + rate * 0.05
            order = rng.permutation(len(windows))
            for lo in range(0, len(order), batch):
                rows = order[lo:lo + batch]
                x = windows[rows]
                best, at = [], []
                for table in self.tables:
                    value = table[0][x[:, :positions]]
                    for j in range(1, len(table)):
                        value = value + table[j][x[:, j:positions + j]]
                    at.append(value.argmax(axis=1))
                    best.append(np.take_along_axis(value, at[-1][:, None], axis=1)[:, 0])
                pooled = np.concatenate(best, axis=1) + self.bias
                hidden = np.maximum(pooled, 0)
                chance = softmax(hidden @ self.head + self.head_bias)
                chance[np.arange(len(rows)), labels[rows]] -= 1
                error = chance * (weights[rows] / weights[rows].sum())[:, None]
                back = (error @ self.head.T) * (pooled > 0)
                grads = []
                for i, table in enumerate(self.tables):
                    part = back[:, i * self.filters:(i + 1) * self.filters]
                    grad = np.zeros_like(table)
                    column = np.arange(self.filters)[None, :]
                    for j in range(len(table)):
                        byte = np.take_along_axis(x, at[i] + j, axis=1).astype(np.int64)
                        grad[j] = np.bincount((byte * self.filters + column).ravel(), part.ravel(),
                                              256 * self.filters).reshape(256, self.filters)
                    grads.append(grad + decay * table)
                adam.step([*grads, back.sum(0), hidden.T @ error + decay * self.head, error.sum(0)])
        self._pair_cache = None


class Logistic:
    """Logistic regression on a few dense features, by Newton steps."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, weights: np.ndarray,
                 ridge: float = 1.0):
        self.mean = features.mean(axis=0)
        self.scale = features.std(axis=0) + 1e-6
        x = np.column_stack([(features - self.mean) / self.scale, np.ones(len(features))])
        self.w = np.zeros(x.shape[1])
        penalty = np.full(x.shape[1], ridge)
        penalty[-1] = 1e-3
        for _ in range(25):
            p = sigmoid(x @ self.w)
            grad = x.T @ (weights * (p - labels)) + penalty * self.w
            hess = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
            step = np.linalg.solve(hess, grad)
            self.w -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break

    def predict(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.mean) / self.scale
        return sigmoid(x @ self.w[:-1] + self.w[-1])


def sample_windows(text: bytes, size: int, most: int, seed: int) -> np.ndarray:
    """At most ``most`` windows of ``size`` + MARGIN bytes of a text, spread over
    all of it, zero-padded at its end."""
    count = max(1, -(-len(text) // size))
    rng = np.random.default_rng(seed)
    picks = np.arange(count) if count <= most else np.sort(rng.choice(count, most, replace=False))
    out = np.zeros((len(picks), size + MARGIN), np.uint8)
    for row, k in enumerate(picks):
        part = np.frombuffer(text[k * size:(k + 1) * size + MARGIN], np.uint8)
        out[row, :len(part)] = part
    return out
