"""Toxicity by compression distance: which of two zstandard dictionaries shortens a window of text more."""

from __future__ import annotations

import functools
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from brackish.llm.labels import labelled_sample, prior_shift
from brackish.llm.texts import blocks, small_batches, to_bytes, widened

TRAIN_DOCS = 3000  # labelled documents of each class that the dictionaries are made from, at most
WINDOW = 32  # bytes of a window, filled up to the end of a word
ORDINARY_BYTES = 16384  # size of the ordinary dictionary
MOST_SAMPLES = 200_000  # windows, evenly drawn from all, that the ordinary dictionary is trained on
LEAST_G2 = 30.0  # log-likelihood ratio from which a word is held to be typical of toxic text
LEAST_DOCS = 5  # toxic documents with it
LEAST_RATIO = 8.0  # how much more frequent it must be there
LONGEST_STEM = 12
MOST_WORDS = 40  # words of a stem
PHASES = 3  # the compressor enters every third place of a dictionary into its table
SUSPECT = 3  # bytes saved from which a window is looked at again with its bounds moved
LEVEL = 3
_SIGNS = b".,;:!?#$%&*|()[]{}\"'"


@functools.lru_cache(maxsize=8)
def _compressor(content: bytes):
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=64, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False
    )
    made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    made.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=made, compression_params=parameters).compress


def windows(words: list[bytes]) -> list[tuple[int, int]]:
    """First and one-past-last word of consecutive windows of about WINDOW bytes."""
    found, first, size = [], 0, 0
    for i, word in enumerate(words, 1):
        size += len(word) + 1
        if size >= WINDOW:
            found.append((first, i))
            first, size = i, 0
    if first < len(words):
        found.append((first, len(words)))
    return found


@dataclass
class Model:
    """Two dictionaries, and weights that turn the bytes they save into a probability."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray

    def features(self, data: bytes) -> list[float]:
        """1, the most bytes the toxic dictionary saves on a window, and the log of what it saves on all suspects.

        What a suspect saves is the median over its own bounds and those moved by a word at either end,
        so that a chance fit at one bound does not count.
        """
        plain, other = _compressor(self.ordinary), _compressor(self.toxic)

        def saved(words: list[bytes]) -> int:
            window = b" " + b" ".join(words) + b" "
            return len(plain(window)) - len(other(window))

        most, total = 0, 0
        for block in blocks(data):
            words = block.lower().split()
            for a, b in windows(words):
                n = saved(words[a:b])
                if n >= SUSPECT:
                    n = sorted((n, saved(words[a + 1 : b]), saved(words[a : b - 1]), saved(words[max(a - 1, 0) : b]), saved(words[a : b + 1])))[2]
                    total += n if n > SUSPECT else 0
                most = max(most, n)
        return [1.0, float(most), math.log1p(total)]

    def score(self, data: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights @ np.array(self.features(data)), -30, 30))))


def _stems(data: bytes) -> set[str]:
    """The words of a text and their beginnings of three letters and more, each after a blank."""
    words = {w.strip(_SIGNS) for w in data.lower().split()} - {b""}
    found = set()
    for word in (" " + w.decode("utf-8", "replace") for w in words):
        found.update(word[:n] for n in range(4, min(len(word), LONGEST_STEM) + 1))
        found.add(word + " ")
    return found


def _distinct(texts: list[bytes]) -> list[bytes]:
    """Texts of which at least half has not been in an earlier one: copies would make their own words typical."""
    seen, kept = set(), []
    for data in texts:
        have = [line.strip().lower() for line in data.split(b"\n") if len(line) >= 20] or [data]
        if 2 * sum(len(x) for x in have if x not in seen) >= sum(map(len, have)):
            kept.append(data)
        seen.update(have)
    return kept


def _typical(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Words and stems far more frequent in toxic documents, least certain first.

    Of a word and its beginnings the most certain stands for the others, the longest if they are alike.
    """
    inside, outside = Counter(), Counter()
    for data in toxic:
        inside.update(_stems(data))
    inside = {stem: n for stem, n in inside.items() if n >= (2 if stem[-1] == " " else LEAST_DOCS)}
    for data in ordinary:
        outside.update(_stems(data) & inside.keys())
    n1, n0 = len(toxic), len(ordinary)
    found = []
    for stem, a in inside.items():
        b = outside[stem]
        if a >= LEAST_DOCS and a * n0 > LEAST_RATIO * b * n1:
            share = (a + b) / (n1 + n0)
            cells = ((a, share * n1), (b, share * n0), (n1 - a, (1 - share) * n1), (n0 - b, (1 - share) * n0))
            g2 = 2 * sum(o * math.log(o / e) for o, e in cells if o)
            if g2 >= LEAST_G2:
                found.append((round(g2, 6), len(stem), stem))
    kept, taken = [], set()
    for _, _, stem in sorted(found, reverse=True):
        beginnings = {stem[:n] for n in range(4, len(stem) + 1)}
        if stem not in taken and not beginnings & set(kept):
            kept.append(stem)
            taken |= beginnings
    # Whole words are longer matches than their beginnings alone.
    words = Counter({w: n for w, n in inside.items() if w[-1] == " "})
    grown = []
    for stem in reversed(kept):
        longer = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0])) if w.startswith(stem) and w != stem][:MOST_WORDS]
        grown += [*reversed(longer), stem]
    return [x.encode() for x in grown]


def _dictionary(texts: list[bytes]) -> bytes:
    samples = [b" " + b" ".join(words[a:b]) + b" " for data in texts if (words := data.lower().split()) for a, b in windows(words)]
    samples = samples[:: -(-len(samples) // MOST_SAMPLES) or 1]
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"".join(samples)[-ORDINARY_BYTES:] or b" "


def train(texts: list[bytes], labels: np.ndarray) -> Model:
    """Dictionaries from four fifths of the documents, weights from the rest.

    The ordinary dictionary is trained on ordinary text.  The toxic one has the same ground and the words
    typical of toxic text, in every phase the compressor may look them up, so that the two
    differ on a window only by what is toxic about it.
    """
    held_back = np.arange(len(texts)) % 5 == 0
    toxic = _distinct([t for t, y, h in zip(texts, labels, held_back, strict=True) if y and not h])
    ordinary = _distinct([t for t, y, h in zip(texts, labels, held_back, strict=True) if not y and not h])
    base, extra = _dictionary(ordinary), b""
    for phase in range(PHASES):
        for word in _typical(toxic, ordinary):
            extra += b" " * ((phase - len(extra)) % PHASES) + word
    model = Model(base, base + extra, np.zeros(3))
    x = np.array([model.features(t) for t, h in zip(texts, held_back, strict=True) if h])
    model.weights = _logistic(x, labels[held_back])
    return model


def _logistic(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - labels) + 1e-2 * weights
        weights -= np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-2 * np.eye(len(weights)), gradient)
    return weights


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_docs: int = TRAIN_DOCS) -> Model | float:
    """A model from at most ``train_docs`` labelled documents of each class; without both classes, the share of label 1."""
    texts, marks, share = labelled_sample(docs, labels, label, train_docs)
    if len(set(marks)) < 2:
        return float(marks[0]) if len(marks) else 0.0
    model = train(texts, marks)
    model.weights[0] += prior_shift(marks, share)
    return model


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """Add ``score``, the probability of label 1, and ``predicted`` (replacing such columns); null and empty texts get that of no finding."""
    docs = docs.drop("score", "predicted")
    names = docs.columns

    def run(batches):
        for part in small_batches(batches, "text"):
            found = np.array([model.score(t) if isinstance(model, Model) else model for t in to_bytes(part.column("text"))], np.float64)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found), pa.array((found >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    return docs.mapInArrow(run, widened(docs, "score double, predicted int"))
