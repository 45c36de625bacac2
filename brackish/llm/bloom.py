"""Two Bloom filters, of hashes seen once and of hashes seen twice, built by all tasks together."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PROBES = 3
SEGMENT = 1 << 13  # bytes of the filters that are sent as one row
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
_MIX = np.uint64(0x9E3779B97F4A7C15)


def filter_bits(items: int) -> int:
    """A power of two of at least 8 bits an item, within fixed bounds.

    Beyond the upper bound (32 MB) the filter only lets more false suspects
    through, which the exact pass behind it sorts out.
    """
    bits = LEAST_BITS
    while bits < 8 * items and bits < MOST_BITS:
        bits *= 2
    return bits


def positions(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    step = (hashes * _MIX) | np.uint64(1)
    return [((hashes + np.uint64(i) * step) >> np.uint64(20)) & np.uint64(bits - 1) for i in range(PROBES)]


class Pair:
    """The two filters of one task, two flags in a byte for each bit while they are built."""

    def __init__(self, bits: int):
        self.bits = bits
        self.seen = np.zeros(bits, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        values, counts = np.unique(hashes, return_counts=True)
        at = positions(values, self.bits)
        again = counts > 1
        again |= np.logical_and.reduce([self.seen[p] > 0 for p in at])
        for p in at:
            self.seen[p] |= 1
        for p in at:
            self.seen[p[again]] |= 2

    def rows(self) -> Iterator[pa.RecordBatch]:
        parts, first, second = [], [], []
        for part in range(self.bits // (8 * SEGMENT)):
            seen = self.seen[8 * SEGMENT * part : 8 * SEGMENT * (part + 1)]
            if seen.any():
                parts.append(part)
                first.append(np.packbits(seen & 1).tobytes())
                second.append(np.packbits(seen & 2).tobytes())
            if len(parts) == 512:
                yield _batch(parts, first, second)
                parts, first, second = [], [], []
        yield _batch(parts, first, second)


def _batch(parts, first, second) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(first, pa.binary()), pa.array(second, pa.binary())], ["part", "once", "twice"])


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bit is seen twice if a task saw it twice or two tasks saw it once."""
    have: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for part, one, two in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            one, two = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
            if part in have:
                a, b = have[part]
                b |= two | (a & one)
                a |= one
            else:
                have[part] = one.copy(), two.copy()
    parts = [p for p, (_, two) in have.items() if two.any()]
    yield _batch(parts, [b""] * len(parts), [have[p][1].tobytes() for p in parts])


def seen_twice(df: DataFrame, column: str, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int):
    """Broadcast filter of the hashes that ``hashes`` gives for more than one row of ``df``.

    Its size is ``bits``, whatever the input; the parts are merged by tasks, so the
    driver only receives the finished filter.
    """

    def build(batches):
        pair = Pair(bits)
        for batch in batches:
            for found in hashes(batch):
                pair.add(found)
        yield from pair.rows()

    spark = df.sparkSession
    sent = df.select(column).mapInArrow(build, "part int, once binary, twice binary")
    tasks = max(1, min(64, bits // (8 * SEGMENT)))
    merged = sent.repartition(tasks, "part").mapInArrow(_merge, "part int, once binary, twice binary").select("part", "twice")
    whole = np.zeros(bits // 8, np.uint8)
    for part, twice in merged.toLocalIterator():
        whole[part * SEGMENT : (part + 1) * SEGMENT] = np.frombuffer(twice, np.uint8)
    return spark.sparkContext.broadcast(whole.tobytes())


def suspected(hashes: np.ndarray, twice: bytes) -> np.ndarray:
    table = np.frombuffer(twice, np.uint8)
    found = np.ones(len(hashes), bool)
    for p in positions(hashes, len(table) * 8):
        found &= (table[p >> np.uint64(3)] >> (np.uint64(7) - (p & np.uint64(7))).astype(np.uint8)) & 1 > 0
    return found
