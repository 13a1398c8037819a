"""A small convolutional network over bytes, in numpy.

Filters of several widths slide over fixed-length windows of bytes; each keeps its largest response in a window
(max pooling), and a softmax layer reads those. Bytes enter as one-hot vectors, so a filter is a table: its
response is a sum of one entry for each byte below it. For inference entries of neighbouring bytes are summed
beforehand into tables of byte pairs, which halves the lookups. In training the gradient of a maximum goes to the
place it came from.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class ByteConv:
    """``filters[k]`` has shape (width, 256, number of filters); ``dense`` reads all pooled responses."""

    filters: list[np.ndarray]
    shift: np.ndarray
    dense: np.ndarray
    bias: np.ndarray
    _pairs: list = field(default_factory=list)

    def __getstate__(self):
        return self.__dict__ | {"_pairs": []}  # tables are rebuilt where they are used

    @property
    def widest(self) -> int:
        return max(len(f) for f in self.filters)

    def _tables(self) -> list:
        if not self._pairs:
            for f in self.filters:
                own = []
                for k in range(0, len(f) - 1, 2):
                    own.append((k, (f[k][:, None, :] + f[k + 1][None, :, :]).reshape(65536, -1).astype(np.float32)))
                if len(f) % 2:
                    own.append((len(f) - 1, f[-1].astype(np.float32)))
                self._pairs.append(own)
        return self._pairs

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """Largest responses, (windows, filters); ``windows`` holds bytes, shape (windows, length)."""
        n, length = windows.shape
        out = []
        pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        for f, tables in zip(self.filters, self._tables()):
            span = length - len(f) + 1
            total = None
            for k, table in tables:
                index = (pairs if len(table) == 65536 else windows)[:, k : k + span]
                part = np.take(table, index, axis=0)
                total = part if total is None else np.add(total, part, out=total)
            out.append(total.max(axis=1))
        return np.maximum(np.concatenate(out, axis=1) + self.shift, 0).astype(np.float64)

    def logits(self, windows: np.ndarray, block: int = 512) -> np.ndarray:
        parts = [self.pooled(windows[i : i + block]) for i in range(0, len(windows), block)]
        return np.concatenate(parts) @ self.dense + self.bias if parts else np.zeros((0, len(self.bias)))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    windows: np.ndarray,
    labels: np.ndarray,
    classes: int,
    widths: tuple[int, ...] = (2, 3, 4),
    filters: int = 8,
    steps: int = 400,
    batch: int = 128,
    rate: float = 0.02,
    seed: int = 7,
) -> ByteConv:
    """Adam on the cross-entropy of batches drawn with ``seed``; classes weigh alike however many rows they have."""
    rng = np.random.default_rng(seed)
    params = begun(rng, classes, widths, filters)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    rows_of = [np.flatnonzero(labels == c) for c in range(classes)]
    present = [c for c in range(classes) if len(rows_of[c])]
    for t in range(1, steps + 1):
        drawn = rng.choice(present, batch)
        x = windows[[rows_of[c][rng.integers(len(rows_of[c]))] for c in drawn]].astype(np.int64)
        _adam(params, gradients(params, x, drawn), moments, t, rate * min(1.0, 2.0 * (1 - t / (steps + 1))))
    return of(params)


def begun(rng: np.random.Generator, classes: int, widths: tuple[int, ...], filters: int) -> list[np.ndarray]:
    """The parameters that training starts from: a table for each width, shift, dense layer, bias."""
    tables = [rng.normal(0, 0.3, (w, 256, filters)) for w in widths]
    shift = np.zeros(filters * len(widths))
    return [*tables, shift, rng.normal(0, 0.3, (filters * len(widths), classes)), np.zeros(classes)]


def of(params: list[np.ndarray]) -> ByteConv:
    *tables, shift, dense, bias = params
    return ByteConv(tables, shift, dense, bias)


def gradients(params: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Those of the mean cross-entropy of windows ``x`` with classes ``y``."""
    *tables, shift, dense, bias = params
    tops, places = [], []
    for table in tables:
        w = len(table)
        span = x.shape[1] - w + 1
        response = sum(table[k][x[:, k : k + span]] for k in range(w))
        place = response.argmax(axis=1)
        places.append(place)
        tops.append(np.take_along_axis(response, place[:, None, :], 1)[:, 0, :])
    raw = np.concatenate(tops, axis=1) + shift
    active = np.maximum(raw, 0)
    delta = softmax(active @ dense + bias)
    delta[np.arange(len(y)), y] -= 1
    delta /= len(y)
    back = (delta @ dense.T) * (raw > 0)
    grads, at = [], 0
    for table, place in zip(tables, places):
        filters = table.shape[2]
        grad = np.zeros_like(table)
        g = back[:, at : at + filters]
        for k in range(len(table)):
            np.add.at(grad[k], (np.take_along_axis(x, place + k, 1), np.arange(filters)[None, :]), g)
        grads.append(grad)
        at += filters
    return grads + [back.sum(axis=0), active.T @ delta, delta.sum(axis=0)]


def _adam(params: list[np.ndarray], grads: list[np.ndarray], moments: list, t: int, step: float) -> None:
    for p, g, (m, v) in zip(params, grads, moments):
        m *= 0.9
        m += 0.1 * g
        v *= 0.99
        v += 0.01 * g * g
        p -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)


def improved(
    params: list[np.ndarray],
    windows: np.ndarray,
    labels: np.ndarray,
    least_steps: int,
    rate: float,
    seed: int,
    half: int = 64,
) -> list[np.ndarray]:
    """Parameters after one pass of Adam over all windows of two classes, ``half`` of each in a batch.

    Each class goes round in a drawn order until the larger one is through, and ``least_steps`` are done.
    """
    rng = np.random.default_rng(seed)
    params = [p.copy() for p in params]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    rows_of = [rng.permutation(np.flatnonzero(labels == c)) for c in (0, 1)]
    rows_of = [r for r in rows_of if len(r)]
    steps = max(least_steps, -(-max(map(len, rows_of)) // half))
    for t in range(1, steps + 1):
        turn = np.arange((t - 1) * half, t * half)
        taken = np.concatenate([r[turn % len(r)] for r in rows_of])
        _adam(params, gradients(params, windows[taken].astype(np.int64), labels[taken]), moments, t, rate)
    return params
