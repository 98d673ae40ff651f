"""A small byte-level convolutional network in numpy, trained with Adam."""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

#: Byte value that fills windows behind the end of a text; its embedding stays zero.
PAD = 256
#: Steps that training takes at least.
LEAST_STEPS = 200


def windows(texts: list[bytes], length: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-length windows over all bytes of some texts, and the text each belongs to.

    Neighbours share ``overlap`` bytes or more, as the last window ends with its text. Only a
    text shorter than a window is padded; an empty text has one window of padding.
    """
    step = length - overlap
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(1, -(-(sizes - overlap) // step))
    room = np.maximum(sizes, length)
    begins = np.cumsum(room) - room
    data = np.full(int(room.sum()), PAD, np.int16)
    for text, begin in zip(texts, begins.tolist(), strict=True):
        data[begin : begin + len(text)] = np.frombuffer(text, np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[owner] + np.minimum(number * step, room[owner] - length)
    return data[starts[:, None] + np.arange(length)], owner


class ByteConv:
    """Byte embedding, filters of several widths, and the maximum of each over a window."""

    def __init__(self, widths: tuple[int, ...], filters: int, dims: int, seed: int):
        rng = np.random.default_rng(seed)
        self.widths, self.filters, self.dims = widths, filters, dims
        self.size = filters * len(widths)
        self.weights = {"embedding": rng.normal(0, 1, (PAD + 1, dims)).astype(np.float32)}
        self.weights["embedding"][PAD] = 0
        for width in widths:
            scale = (width * dims) ** -0.5
            shape = (width * dims, filters)
            self.weights[f"filter{width}"] = rng.normal(0, scale, shape).astype(np.float32)
            self.weights[f"bias{width}"] = np.zeros(filters, np.float32)

    def _columns(self, embedded: np.ndarray, width: int) -> np.ndarray:
        view = sliding_window_view(embedded, width, axis=1)
        return view.transpose(0, 1, 3, 2).reshape(-1, width * self.dims)

    def pool(self, x: np.ndarray, block: int = 48) -> np.ndarray:
        """Pooled filter responses of each window; works on blocks that fit into the cache."""
        out = np.empty((len(x), self.size), np.float32)
        for at in range(0, len(x), block):
            part = x[at : at + block]
            embedded = self.weights["embedding"][part]
            for k, width in enumerate(self.widths):
                z = self._columns(embedded, width) @ self.weights[f"filter{width}"]
                top = z.reshape(len(part), -1, self.filters).max(1) + self.weights[f"bias{width}"]
                out[at : at + block, k * self.filters : (k + 1) * self.filters] = top
        return np.maximum(out, 0, out=out)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        embedded, out, trace = self.weights["embedding"][x], [], []
        for width in self.widths:
            z = self._columns(embedded, width) @ self.weights[f"filter{width}"]
            z = z.reshape(len(x), -1, self.filters)
            at = z.argmax(1)
            top = np.take_along_axis(z, at[:, None], 1)[:, 0] + self.weights[f"bias{width}"]
            out.append(np.maximum(top, 0))
            trace.append(at)
        return np.concatenate(out, 1), trace

    def backward(self, x: np.ndarray, pooled: np.ndarray, trace: list, grad: np.ndarray) -> dict:
        """Gradients of the weights; only the position of each maximum takes part."""
        grads = {"embedding": np.zeros_like(self.weights["embedding"])}
        grad = grad * (pooled > 0)
        rows = np.arange(len(x))[:, None, None]
        for k, (width, at) in enumerate(zip(self.widths, trace, strict=True)):
            g = grad[:, k * self.filters : (k + 1) * self.filters]
            seen = x[rows, at[:, :, None] + np.arange(width)]  # window, filter, place
            embedded = self.weights["embedding"][seen]
            flat = (embedded * g[:, :, None, None]).sum(0)
            grads[f"filter{width}"] = flat.reshape(self.filters, -1).T
            grads[f"bias{width}"] = g.sum(0)
            filters = self.weights[f"filter{width}"].reshape(width, self.dims, self.filters)
            back = g[:, :, None, None] * filters.transpose(2, 0, 1)[None]
            np.add.at(grads["embedding"], seen.ravel(), back.reshape(-1, self.dims))
        grads["embedding"][PAD] = 0
        return grads


class Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.step = weights, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in grads.items():
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            first = self.first[k] / (1 - 0.9**self.step)
            second = self.second[k] / (1 - 0.999**self.step)
            self.weights[k] -= (self.rate * first / (np.sqrt(second) + 1e-8)).astype(np.float32)


def rounds(epochs: int, rows: int, batch: int) -> int:
    """So many epochs, or more of a small sample, for ``LEAST_STEPS`` steps in all."""
    return max(epochs, min(100, -(-LEAST_STEPS // max(1, -(-rows // batch)))))


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


class WindowClassifier:
    """Softmax over classes for each window; a text gets the mean over its windows."""

    def __init__(self, classes: int, length=256, widths=(3, 5), filters=16, dims=8, seed=7):
        self.length, self.overlap, self.seed = length, max(widths) - 1, seed
        self.conv = ByteConv(widths, filters, dims, seed)
        self.conv.weights["out"] = np.zeros((self.conv.size, classes), np.float32)
        self.conv.weights["out_bias"] = np.zeros(classes, np.float32)

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int, batch=128, rate=0.01):
        x, owner = windows(texts, self.length, self.overlap)
        y, weights = np.asarray(labels)[owner], self.conv.weights
        adam, rng = Adam(weights, rate), np.random.default_rng(self.seed)
        for _ in range(rounds(epochs, len(x), batch)):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                pick = order[at : at + batch]
                pooled, trace = self.conv.forward(x[pick])
                p = softmax(pooled @ weights["out"] + weights["out_bias"])
                p[np.arange(len(pick)), y[pick]] -= 1
                p /= len(pick)
                grads = self.conv.backward(x[pick], pooled, trace, p @ weights["out"].T)
                grads["out"], grads["out_bias"] = pooled.T @ p, p.sum(0)
                adam.update(grads)
        return self

    def predict(self, texts: list[bytes]) -> np.ndarray:
        """Class probabilities of each text."""
        x, owner = windows(texts, self.length, self.overlap)
        weights = self.conv.weights
        p = softmax(self.conv.pool(x) @ weights["out"] + weights["out_bias"])
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        return np.add.reduceat(p, begins, 0) / np.bincount(owner)[:, None]


class DocumentScorer:
    """One probability for a text from the maxima of its filters over overlapping chunks.

    Each filter contributes the mean over the chunks of its maxima and its maximum overall; the
    share of the first chunk that is filled tells short texts from poor ones.
    """

    def __init__(self, length=256, overlap=16, widths=(3, 5), filters=16, dims=8, seed=7):
        self.length, self.overlap, self.seed = length, overlap, seed
        self.conv = ByteConv(widths, filters, dims, seed)
        self.conv.weights["out"] = np.zeros((2 * self.conv.size + 1, 1), np.float32)
        self.conv.weights["out_bias"] = np.zeros(1, np.float32)

    @staticmethod
    def _combine(
        x: np.ndarray, pooled: np.ndarray, begins: np.ndarray, counts: np.ndarray
    ) -> np.ndarray:
        mean = np.add.reduceat(pooled, begins, 0) / counts[:, None]
        filled = (x[begins] != PAD).mean(1, keepdims=True, dtype=np.float32)
        return np.concatenate([mean, np.maximum.reduceat(pooled, begins, 0), filled], 1)

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int, batch=32, rate=0.005):
        """Balanced over the two labels."""
        y = np.asarray(labels, np.float32)
        share = y.mean()
        cost = np.where(y == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
        weights, size = self.conv.weights, self.conv.size
        adam, rng = Adam(weights, rate), np.random.default_rng(self.seed)
        for _ in range(rounds(epochs, len(texts), batch)):
            order = rng.permutation(len(texts))
            for at in range(0, len(texts), batch):
                pick = order[at : at + batch]
                x, owner = windows([texts[i] for i in pick], self.length, self.overlap)
                counts = np.bincount(owner)
                begins = np.cumsum(counts) - counts
                pooled, trace = self.conv.forward(x)
                combined = self._combine(x, pooled, begins, counts)
                z = (combined @ weights["out"] + weights["out_bias"])[:, 0]
                g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) * cost[pick]) / len(pick)
                back = g[:, None] * weights["out"].T
                grad = (back[:, :size] / counts[:, None])[owner]
                top = pooled == combined[owner, size : 2 * size]
                grad = grad + top * back[owner, size : 2 * size] / np.add.reduceat(top, begins, 0)[owner]
                grads = self.conv.backward(x, pooled, trace, grad.astype(np.float32))
                grads["out"], grads["out_bias"] = combined.T @ g[:, None], g.sum(keepdims=True)
                adam.update(grads)
        return self

    def predict(self, texts: list[bytes]) -> np.ndarray:
        x, owner = windows(texts, self.length, self.overlap)
        counts = np.bincount(owner)
        combined = self._combine(x, self.conv.pool(x), np.cumsum(counts) - counts, counts)
        z = (combined @ self.conv.weights["out"] + self.conv.weights["out_bias"])[:, 0]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
