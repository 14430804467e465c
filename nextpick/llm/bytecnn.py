"""Byte-level convolutional network in numpy: train on windows, score whole texts.

Bytes are embedded, filters of several widths slide over a window, each filter's largest
response is kept (max pooling), and one hidden layer leads to a softmax. Byte 0 pads.

Scoring folds the embedding into the filters: a filter's response at a position is a sum of one
table row per pair of bytes, so a position costs two row look-ups for all filters. Windows go
through in blocks of BLOCK, whatever the length of a text, so memory is bounded.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDTHS = (2, 3, 4)
BLOCK = 1024


@dataclass
class Network:
    """Weights; `filters` holds one array (width, embedding, filters) per width."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    window: int

    def arrays(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _head(net: Network, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    features = np.maximum(pooled + net.bias, 0)
    hidden = np.maximum(features @ net.hidden + net.hidden_bias, 0)
    return features, hidden, hidden @ net.out + net.out_bias


def train(windows: np.ndarray, labels: np.ndarray, classes: int, n_filters: int = 16, dim: int = 8, n_hidden: int = 24,
          epochs: int = 5, batch: int = 64, rate: float = 0.004, seed: int = 7, least_steps: int = 400) -> Network:
    """Fit by Adam on `windows` (n, window) of bytes. Repeatable: same rows in the same order, same weights.

    A small sample is gone through more often, for `least_steps` steps in all.
    """
    epochs = max(epochs, -(-least_steps // max(1, -(-len(windows) // batch))))
    rng = np.random.default_rng(seed)
    window = windows.shape[1]
    normal = lambda *shape: rng.standard_normal(shape).astype(np.float32)
    total = n_filters * len(WIDTHS)
    net = Network(normal(256, dim) * 0.5, [normal(w, dim, n_filters) / np.sqrt(w * dim) for w in WIDTHS], np.zeros(total, np.float32),
                  normal(total, n_hidden) / np.sqrt(total), np.zeros(n_hidden, np.float32),
                  normal(n_hidden, classes) / np.sqrt(n_hidden), np.zeros(classes, np.float32), window)
    net.embedding[0] = 0
    first, second, step = [np.zeros_like(a) for a in net.arrays()], [np.zeros_like(a) for a in net.arrays()], 0
    for epoch in range(epochs):
        speed = rate * (1 - epoch / epochs)
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            step += 1
            for i, (weights, grad) in enumerate(zip(net.arrays(), _gradients(net, windows[rows], labels[rows]), strict=True)):
                first[i] += 0.1 * (grad - first[i])
                second[i] += 0.01 * (grad * grad - second[i])
                weights -= speed * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-7)
    return net


def _gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    n, size = windows.shape
    dim, each = net.embedding.shape[1], net.filters[0].shape[2]
    embedded = net.embedding[windows]
    pooled, places = [], []
    for width, weights in zip(WIDTHS, net.filters, strict=True):
        spots = size - width + 1
        patches = np.concatenate([embedded[:, k:k + spots] for k in range(width)], axis=2)
        answer = (patches.reshape(-1, width * dim) @ weights.reshape(width * dim, each)).reshape(n, spots, each)
        place = answer.argmax(axis=1)
        places.append(place)
        pooled.append(np.take_along_axis(answer, place[:, None], axis=1)[:, 0])
    pooled = np.concatenate(pooled, axis=1)
    features, hidden, logits = _head(net, pooled)
    wrong = _softmax(logits)
    wrong[np.arange(n), labels] -= 1
    wrong /= n
    d_hidden = (wrong @ net.out.T) * (hidden > 0)
    d_pooled = (d_hidden @ net.hidden.T) * (features > 0)
    d_embedding = np.zeros_like(net.embedding)
    d_filters = []
    rows = np.arange(n)[:, None]
    for j, (width, weights) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        grad = d_pooled[:, j * each:(j + 1) * each]
        d_weights = np.zeros_like(weights)
        for k in range(width):
            seen = windows[rows, places[j] + k]
            d_weights[k] = np.einsum("nfd,nf->df", net.embedding[seen], grad)
            np.add.at(d_embedding, seen, grad[:, :, None] * weights[k].T[None])
        d_filters.append(d_weights)
    d_embedding[0] = 0
    return [d_embedding, *d_filters, d_pooled.sum(axis=0), features.T @ d_hidden, d_hidden.sum(axis=0),
            hidden.T @ wrong, wrong.sum(axis=0)]


class Scorer:
    """A network with its filters folded into tables by byte pair."""

    def __init__(self, net: Network):
        self.net = net
        two, three, four = ([net.embedding @ w[k] for k in range(len(w))] for w in net.filters)
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, -1)
        zero = np.zeros_like(three[2])
        self.near = np.ascontiguousarray(np.concatenate([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])], axis=1), np.float32)
        self.far = np.ascontiguousarray(np.concatenate([pair(three[2], zero), pair(four[2], four[3])], axis=1), np.float32)
        self.each = net.filters[0].shape[2]

    def logits(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Logits of the windows that begin at `starts` and stop at `ends` at the latest, in bytes of `raw`."""
        if not len(starts):
            return np.zeros((0, self.net.out.shape[1]), np.float32)
        return np.concatenate([self._block(raw, starts[i:i + BLOCK], ends[i:i + BLOCK]) for i in range(0, len(starts), BLOCK)])

    def _block(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = self.net.window
        places = starts[None] + np.arange(size)[:, None]
        inside = places < ends[None]
        # Rows past a window's end stay padding, as in training.
        bytes_ = np.where(inside, raw[np.minimum(places, len(raw) - 1)], 0) if len(raw) else np.zeros((size, len(starts)), np.uint8)
        pairs = bytes_[:-1].astype(np.int32) * 256 + bytes_[1:]
        best = np.full((len(starts), 3 * self.each), -np.inf, np.float32)
        near, far = np.empty_like(best), np.empty((len(starts), 2 * self.each), np.float32)
        longest = int(min(size, (ends - starts).max(initial=0) + 1))
        for i in range(size - 1):
            if i > longest and i < size - 4:
                continue  # only padding from here on; the last positions stand for all of it
            np.take(self.near, pairs[i], axis=0, out=near, mode="clip")
            if i + 3 < size:
                np.take(self.far, pairs[i + 2], axis=0, out=far, mode="clip")
                near[:, self.each:] += far
                np.maximum(best, near, out=best)
            elif i + 2 < size:  # room for widths 2 and 3
                np.take(self.far, bytes_[i + 2].astype(np.int32) * 256, axis=0, out=far, mode="clip")
                near[:, self.each:2 * self.each] += far[:, :self.each]
                np.maximum(best[:, :2 * self.each], near[:, :2 * self.each], out=best[:, :2 * self.each])
            else:
                np.maximum(best[:, :self.each], near[:, :self.each], out=best[:, :self.each])
        return _head(self.net, best)[2]


def cut(starts: np.ndarray, ends: np.ndarray, window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that cover each row's bytes, `stride` apart: the row of each, its start and its end.

    A row has one window at least; an empty row has one of padding.
    """
    length = ends - starts
    count = np.maximum(1, -(-(length - window + stride) // stride))
    row = np.repeat(np.arange(len(starts)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = starts[row] + nth * stride
    return row, first, np.minimum(first + window, ends[row])


def windows_of(texts: list[bytes], window: int, stride: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Training windows of `texts`, `most` at most of each, evenly spread, and the text each is from."""
    out, origin = [], []
    for i, text in enumerate(texts):
        starts = list(range(0, max(1, len(text) - window + stride), stride))
        for start in starts[::max(1, len(starts) // most)][:most]:
            part = text[start:start + window]
            out.append(np.frombuffer(part + bytes(window - len(part)), np.uint8))
            origin.append(i)
    return np.array(out, np.uint8).reshape(-1, window), np.array(origin, np.int64)
