"""Quality of a text by a byte-level convolutional network, trained and applied in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brackish.llm.labels import labelled_sample, prior_shift
from brackish.llm.texts import small_batches, to_bytes, widened

TRAIN_DOCS = 3000  # labelled documents of each class that the network is fitted on, at most
TRAIN_CHUNKS = 6  # chunks of a training document, spread over all of it
CHUNK, STEP = 512, 384  # bytes of a chunk and from one chunk to the next
BLOCK = 8  # bytes between the places where a filter is applied; filters are two blocks wide
DEPTH, FILTERS = 8, 32  # learned numbers per byte value, and filters
EPOCHS, BATCH, RATE = 10, 128, 3e-3
MANY = 1 << 12  # chunks that are computed together
_LAGS = range(3, 25)


def chunks(data: bytes) -> np.ndarray:
    """Overlapping chunks that cover a whole text, as rows of byte values; 0 fills the last one."""
    count = 1 + max(0, -(-(len(data) - CHUNK) // STEP))
    padded = np.zeros((count - 1) * STEP + CHUNK, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (count, CHUNK), (STEP, 1)).copy()


def _echo(rows: np.ndarray) -> np.ndarray:
    """1 where the four bytes from here also stand up to 24 bytes earlier in the chunk: an input channel beside the bytes."""
    wide = rows.astype(np.uint32)
    four = wide[:, :-3] | wide[:, 1:-2] << 8 | wide[:, 2:-1] << 16 | wide[:, 3:] << 24
    found = np.zeros(rows.shape, bool)
    for lag in _LAGS:
        found[:, lag:-3] |= four[:, lag:] == four[:, :-lag]
    return found & (rows != 0)


@dataclass
class Network:
    """Byte embedding, filters over two blocks, and weights of each filter's largest and mean response."""

    embed: np.ndarray
    first: np.ndarray
    second: np.ndarray
    bias: np.ndarray
    largest: np.ndarray
    mean: np.ndarray
    base: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def blocks(self, rows: np.ndarray) -> np.ndarray:
        x = np.concatenate([self.embed[rows], _echo(rows)[:, :, None].astype(np.float32)], axis=2)
        return x.reshape(len(rows), CHUNK // BLOCK, -1)

    def responses(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x[:, :-1] @ self.first + x[:, 1:] @ self.second + self.bias, 0)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        found = []
        for at in range(0, len(rows), MANY):
            r = self.responses(self.blocks(rows[at : at + MANY]))
            found.append(r.max(axis=1) @ self.largest + r.mean(axis=1) @ self.mean + self.base)
        return np.concatenate(found)

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.offset, -30, 30)))

    def scores(self, texts: list[bytes]) -> list[float]:
        """One probability a text: the mean logit of its chunks, calibrated."""
        rows = [chunks(data) for data in texts]
        if not rows:
            return []
        logits = self.logits(np.concatenate(rows))
        starts = np.r_[0, np.cumsum([len(r) for r in rows])[:-1]]
        sizes = np.array([len(r) for r in rows])
        return self.probability(np.add.reduceat(logits, starts) / sizes).tolist()


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Network:
    """Adam on the log loss of chunks against their document's label, then a calibration on held-back documents."""
    random = np.random.default_rng(seed)
    width = BLOCK * (DEPTH + 1)
    draw = lambda *shape, scale: (random.standard_normal(shape) * scale).astype(np.float32)
    net = Network(draw(256, DEPTH, scale=0.5), draw(width, FILTERS, scale=width**-0.5), draw(width, FILTERS, scale=width**-0.5), np.zeros(FILTERS, np.float32),
                  draw(FILTERS, scale=0.1), draw(FILTERS, scale=0.1), np.zeros(1, np.float32))
    held_back = np.arange(len(texts)) % 5 == 0
    rows, target, weight = [], [], []
    share = np.bincount(labels, minlength=2) / len(labels)
    for data, label, held in zip(texts, labels, held_back, strict=True):
        if not held:
            have = chunks(data)
            have = have[np.unique(np.linspace(0, len(have) - 1, min(TRAIN_CHUNKS, len(have))).astype(int))]
            rows.append(have)
            target += [label] * len(have)
            weight += [0.5 / share[label] / len(have)] * len(have)
    rows, target, weight = np.concatenate(rows), np.array(target, np.float32), np.array(weight, np.float32)
    weight /= weight.mean()
    names = ["embed", "first", "second", "bias", "largest", "mean", "base"]
    moment = {n: np.zeros_like(getattr(net, n)) for n in names}
    square = {n: np.zeros_like(getattr(net, n)) for n in names}
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(rows))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            gradient = _gradient(net, rows[batch], target[batch], weight[batch])
            step += 1
            for n in names:
                moment[n] += 0.1 * (gradient[n] - moment[n])
                square[n] += 0.001 * (gradient[n] ** 2 - square[n])
                change = moment[n] / (1 - 0.9**step) / (np.sqrt(square[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, (getattr(net, n) - rate * change).astype(np.float32))
    back = [i for i in range(len(texts)) if held_back[i]]
    logit = np.array([net.logits(chunks(texts[i])).mean() for i in back])
    net.slope, net.offset = calibrated(logit, labels[back])
    return net


def _gradient(net: Network, rows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    x = net.blocks(rows)
    r = net.responses(x)
    top, places = r.max(axis=1), r.shape[1]
    mean = r.mean(axis=1)
    p = 1 / (1 + np.exp(-np.clip(top @ net.largest + mean @ net.mean + net.base, -30, 30)))
    d = (weight * (p - target) / len(rows)).astype(np.float32)
    dr = np.broadcast_to((d[:, None] * net.mean / places)[:, None], r.shape).copy()
    np.put_along_axis(dr, at := r.argmax(axis=1)[:, None], np.take_along_axis(dr, at, 1) + (d[:, None] * net.largest)[:, None], 1)
    dr *= r > 0
    flat = dr.reshape(-1, FILTERS)
    width = x.shape[2]
    dx = np.zeros_like(x)
    dx[:, :-1] += dr @ net.first.T
    dx[:, 1:] += dr @ net.second.T
    de = dx.reshape(len(rows) * CHUNK, -1)[:, :DEPTH]
    values = rows.ravel()
    embed = np.stack([np.bincount(values, de[:, k], 256) for k in range(DEPTH)], axis=1).astype(np.float32)
    return {
        "embed": embed, "first": x[:, :-1].reshape(-1, width).T @ flat, "second": x[:, 1:].reshape(-1, width).T @ flat, "bias": flat.sum(axis=0),
        "largest": top.T @ d, "mean": mean.T @ d, "base": np.array([d.sum()], np.float32),
    }


def calibrated(logit: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through held-back logits, slightly drawn to slope 1."""
    a, b = 1.0, 0.0
    x = np.stack([logit, np.ones_like(logit)], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        g = x.T @ (p - labels) + 0.5 * np.array([a - 1, 0])
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.5 * np.eye(2)
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    return float(max(a, 1e-3)), float(b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", train_docs: int = TRAIN_DOCS) -> Network | float:
    """A network from at most ``train_docs`` labelled documents of each class; without both classes, the share of label 1."""
    texts, marks, share = labelled_sample(docs, labels, label, train_docs)
    if len(set(marks)) < 2:
        return float(marks[0]) if len(marks) else 0.0
    net = train(texts, marks)
    net.offset += prior_shift(marks, share)
    return net


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """Add ``score``, the probability of label 1, and ``predicted`` (replacing such columns).

    Null and empty texts are read as a chunk of zero bytes.  Very long texts are read whole, chunk by chunk; rows that
    repeat a text get the same score; an empty table gives no rows.
    """
    docs = docs.drop("score", "predicted")
    names = docs.columns

    def run(batches):
        for part in small_batches(batches, "text"):
            texts = to_bytes(part.column("text"))
            found = np.array(model.scores(texts) if isinstance(model, Network) else [model] * len(texts), np.float64)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found), pa.array((found >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    return docs.mapInArrow(run, widened(docs, "score double, predicted int"))
