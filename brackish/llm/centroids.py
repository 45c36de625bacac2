"""Centroid clustering of integer vectors; dot products and distances come from bit planes."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brackish.session import cut_lineage

WIDTH = 64  # components of a vector: one bit plane of it is one word
MOST = 1 << 27  # integer components lie below it, so that a squared distance fits 63 bits
ROWS = 4096  # vectors that are compared together


def planes(values: np.ndarray, bits: int) -> np.ndarray:
    """Two's complement planes (n, bits) of integers (n, 64): bit c of word b is bit b of component c."""
    single = (values[:, None, :] >> np.arange(bits)[:, None] & 1).astype(np.uint8)
    return np.packbits(single, axis=2, bitorder="little").view("<u8")[..., 0]


def plane_weights(bits: int) -> np.ndarray:
    """What a bit of each plane counts; the highest plane holds the sign."""
    weights = 1 << np.arange(bits, dtype=np.int64)
    weights[-1] = -weights[-1]
    return weights


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products, row by row, of vectors given as planes: weighted counts of common bits of every pair of planes."""
    weights = plane_weights(a.shape[-1])
    common = np.bitwise_count(a[..., :, None] & b[..., None, :])
    return np.einsum("...ij,i,j->...", common, weights, weights, dtype=np.int64)


def plane_sums(p: np.ndarray) -> np.ndarray:
    """Sum of the vectors: how many have each bit of each plane, weighted."""
    bits = np.unpackbits(p.astype("<u8")[..., None].view(np.uint8), axis=2, bitorder="little")
    return plane_weights(p.shape[1]) @ bits.sum(axis=0, dtype=np.int64)


def nearest(p: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid, given as planes too; ties go to the smaller number."""
    own, theirs = dots(p, p), dots(centroids, centroids)
    apart = np.stack([own - 2 * dots(p, c[None, :]) + n for c, n in zip(centroids, theirs, strict=True)], axis=1)
    cluster = apart.argmin(axis=1)
    return cluster, apart[np.arange(len(p)), cluster]


@dataclass(frozen=True)
class Packed:
    """Vectors as planes: (key, planes) of ``rows``, each row ``bits`` words of 8 bytes."""

    rows: DataFrame
    bits: int


@dataclass(frozen=True)
class Clustering:
    """Final centroids (k, 64) with their counts and inertias, and (key, cluster, distance) of every vector."""

    rows: DataFrame
    centroids: np.ndarray
    counts: list[int]
    inertias: list[int]


def pack(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 1024.0) -> Packed:
    """floor(scale * x) of every usable vector as bit planes, written to the checkpoint folder.

    Usable are vectors of exactly 64 components, none of them null or non-finite.  Integers of 2^27 and
    more in size stop the job, as distances would not be exact.
    """
    whole = F.forall(F.col(vector), lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    usable = rows.where((F.size(vector) == WIDTH) & whole).select(
        F.col(key).cast("long").alias("key"), F.transform(vector, lambda v: F.floor(v.cast("double") * scale)).alias("vec")
    )
    low, high = usable.agg(F.min(F.array_min("vec")), F.max(F.array_max("vec"))).first()
    if low is None:
        low = high = 0
    if low <= -MOST or high >= MOST:
        raise ValueError("vector components too large for exact distances")
    bits = 1 + max(high.bit_length(), (~low).bit_length() if low < 0 else 0, 1)

    def run(batches):
        for batch in batches:
            packed = planes(np.asarray(batch.column("vec").flatten()).reshape(-1, WIDTH), bits)
            cells = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * bits), len(packed), [None, pa.py_buffer(packed.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("key"), cells.cast(pa.binary())], ["key", "planes"])

    return Packed(cut_lineage(usable.mapInArrow(run, "key long, planes binary")), bits)


def _read(batch: pa.RecordBatch, bits: int):
    """Keys and planes of a batch, in runs of at most ROWS vectors."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        yield part.column("key"), np.frombuffer(b"".join(part.column("planes").to_pylist()), "<u8").reshape(-1, bits)


def summed(packed: Packed, centroids: np.ndarray) -> dict[int, tuple[int, list[int], int]]:
    """Count, componentwise sums and inertia of each non-empty cluster: at most one row a cluster comes back."""
    bits, sent = packed.bits, planes(centroids, packed.bits)

    def run(batches):
        counts, inertias = [0] * len(sent), [0] * len(sent)
        sums = np.zeros((len(sent), WIDTH), np.int64)
        for batch in batches:
            for _, p in _read(batch, bits):
                cluster, apart = nearest(p, sent)
                for c in np.unique(cluster).tolist():
                    mine = cluster == c
                    counts[c] += int(mine.sum())
                    sums[c] += plane_sums(p[mine])
                    inertias[c] += (int((apart[mine] >> 32).sum()) << 32) + int((apart[mine] & 0xFFFFFFFF).sum())
        rows = [c for c, n in enumerate(counts) if n]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows, pa.int32()), pa.array([counts[c] for c in rows], pa.int64()), pa.array([sums[c] for c in rows], pa.list_(pa.int64())),
                pa.array([Decimal(inertias[c]) for c in rows], pa.decimal128(38, 0)),
            ],
            ["cluster", "n", "sums", "inertia"],
        )

    parts = packed.rows.mapInArrow(run, "cluster int, n long, sums array<long>, inertia decimal(38,0)")
    total = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(WIDTH)]).alias("sums"), F.sum("inertia").alias("inertia")
    )
    return {r["cluster"]: (r["n"], r["sums"], int(r["inertia"])) for r in total.collect()}


def cluster(
    rows: DataFrame, k: int = 8, rounds: int = 10, tag: str = "3", key: str = "vec_id", vector: str = "embedding", scale: float = 1024.0,
) -> Clustering:
    """Lloyd's rounds over the integer vectors of ``rows``, all exact.

    Centroids start as the ``k`` vectors of the smallest sha256 of ``tag:key``, equal ones in order of their
    planes; fewer vectors make fewer centroids.  Every round assigns all vectors and replaces each
    non-empty centroid by the floored mean of its vectors; after the last all are assigned once more.
    Vectors that are null, of another length than 64 or hold null or non-finite components take no part.
    Vectors without a key are clustered but start no centroid while others can; rows that repeat a key
    count each; equal distances go to the smaller number.  An empty table gives no centroid and no row.

    The planes are written once and each round reads them again; a task hands on one row a cluster, so k rows
    of 64 sums reach the driver whatever the input holds.
    """
    packed = pack(rows, key, vector, scale)
    drawn = packed.rows.withColumn("draw", F.sha2(F.concat(F.lit(f"{tag}:"), F.col("key").cast("string")), 256))
    first = drawn.orderBy(F.col("draw").asc_nulls_last(), "planes").limit(k).select("planes").collect()
    start = np.frombuffer(b"".join(bytes(r[0]) for r in first), "<u8").reshape(-1, packed.bits)
    centroids = np.stack([plane_sums(c[None, :]) for c in start]) if len(start) else np.zeros((0, WIDTH), np.int64)
    if not len(centroids):
        return Clustering(packed.rows.select("key", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids, [], [])
    for _ in range(rounds):
        centroids = centroids.copy()
        for c, (n, sums, _) in summed(packed, centroids).items():
            centroids[c] = [s // n for s in sums]
    last = summed(packed, centroids)
    bits, sent = packed.bits, planes(centroids, packed.bits)

    def run(batches):
        for batch in batches:
            for keys, p in _read(batch, bits):
                cluster, apart = nearest(p, sent)
                yield pa.RecordBatch.from_arrays([keys, pa.array(cluster.astype(np.int32)), pa.array(apart)], ["key", "cluster", "distance"])

    found = packed.rows.mapInArrow(run, "key long, cluster int, distance long")
    of = [last.get(c, (0, None, 0)) for c in range(len(centroids))]
    return Clustering(found, centroids, [n for n, _, _ in of], [inertia for _, _, inertia in of])
