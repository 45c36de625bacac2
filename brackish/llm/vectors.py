"""Exact top-k search by inner product with bounds from segment statistics, coarse to fine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (4, 16)  # segments of a vector at each resolution
PER_PASS = 8192  # queries, about, that are sent to every task at once
CHUNK = 2048  # candidates that are bounded together
DENSE = 0.05  # share of surviving pairs above which their scores come from one matrix product


def quantized(vectors: pa.ListArray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of all components, and the ends of the vectors among them."""
    flat = np.asarray(vectors.flatten(), np.float64)
    return np.floor(flat * scale), np.cumsum(np.asarray(pc.list_value_length(vectors)))


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments of each row, both times the root of the segment's length.

    By the Cauchy-Schwarz inequality the inner product of two rows of these is at least that of
    the vectors, so that it bounds their distance from below.
    """
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    sizes = np.diff(edges)
    means = np.add.reduceat(x, edges[:-1], axis=1) / sizes
    squares = np.add.reduceat((x - np.repeat(means, sizes, axis=1)) ** 2, edges[:-1], axis=1)
    return np.hstack([means * np.sqrt(sizes), np.sqrt(squares)])


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def least(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        for at in range(0, len(query), 1 << 20):
            self._add(query[at : at + (1 << 20)], ids[at : at + (1 << 20)], scores[at : at + (1 << 20)])

    def _add(self, query, ids, scores) -> None:
        worst = self.scores[query, -1]
        kept = (scores > worst) | (scores == worst) & (ids < self.ids[query, -1])
        query, ids, scores = query[kept], ids[kept], scores[kept]
        if not len(query):
            return
        touched = np.unique(query)
        query = np.r_[query, np.repeat(touched, self.k)]
        ids, scores = np.r_[ids, self.ids[touched].ravel()], np.r_[scores, self.scores[touched].ravel()]
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        top = place < self.k
        self.scores[query[top], place[top]] = scores[top]
        self.ids[query[top], place[top]] = ids[top]


def _exact(x: np.ndarray, q: np.ndarray) -> None:
    """Sums of products of doubles are exact integers up to 2^53."""
    if x.size and q.size and float(np.abs(x).max()) * float(np.abs(q).max()) * x.shape[1] >= 2.0**53:
        raise ValueError("vector components too large for exact integer scores")


class Queries:
    """Query vectors of one length with their statistics."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.stats = [segment_statistics(x, n) for n in LEVELS]
        self.slack = 1e-9 * np.sqrt((x**2).sum(axis=1))

    def search(self, ids: np.ndarray, x: np.ndarray, best: Best) -> None:
        for at in range(0, len(ids), CHUNK):
            self._search(ids[at : at + CHUNK], x[at : at + CHUNK], best)

    def _search(self, ids: np.ndarray, x: np.ndarray, best: Best) -> None:
        _exact(x, self.x)
        norms = np.sqrt((x**2).sum(axis=1))
        floor = best.least()
        stats = [segment_statistics(x, n) for n in LEVELS]
        bound = stats[0] @ self.stats[0].T
        bound += norms[:, None] * self.slack + 1e-6
        alive = (bound >= floor) & (ids[:, None] != self.ids)
        row, query = np.nonzero(alive)
        for n in range(1, len(LEVELS)):
            if len(row) > DENSE * alive.size:
                finer = (stats[n] @ self.stats[n].T)[row, query]
            else:
                finer = np.einsum("ij,ij->i", stats[n][row], self.stats[n][query])
            kept = finer + norms[row] * self.slack[query] + 1e-6 >= floor[query]
            row, query = row[kept], query[kept]
        if len(row) > DENSE * alive.size:
            scores = (x @ self.x.T)[row, query]
        else:
            scores = np.einsum("ij,ij->i", x[row], self.x[query])
        best.add(query, ids[row], scores)


def _by_length(ids: np.ndarray, flat: np.ndarray, ends: np.ndarray):
    """(length, ids, matrix) for each length of vectors."""
    sizes = np.diff(np.r_[0, ends])
    for n in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == n)
        yield int(n), ids[rows], flat[(ends[rows] - n)[:, None] + np.arange(n)]


def _usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows with an id and a vector of finite components only."""
    whole = F.forall(F.col(vector), lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    return rows.where(F.col(key).isNotNull() & whole).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec"))


def top_k(rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """The ``k`` rows of the highest integer inner product with each query row: query_id, rank, vec_id, score.

    Components x become floor(scale * x).  Rows of ``is_query`` are searched against all rows of
    other ids; equal scores are ranked by smaller id; with fewer rows all are listed.  Vectors
    that are null, empty or hold null or non-finite components take no part, nor do rows without an
    id; vectors of different lengths are not compared.  Rows that repeat an id are listed each; as
    queries they share one list.  Components so large that scores are not exact stop the job.

    Queries go to the tasks in passes of about PER_PASS; each task bounds its rows
    against its best so far, coarse to fine, and hands on k rows a query.
    """
    usable = _usable(rows, key, vector)
    asked = _usable(rows.where(is_query), key, vector)
    passes = max(1, -(-asked.count() // PER_PASS))
    parts = []
    for n in range(passes):
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == n).toArrow().combine_chunks()
        if part.num_rows == 0:
            continue
        flat, ends = quantized(part.column("vec").combine_chunks(), scale)
        queries = {size: Queries(ids, x) for size, ids, x in _by_length(np.asarray(part.column("id")), flat, ends)}
        parts.append(_one_pass(usable, queries, k, scale))
    if not parts:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _one_pass(usable: DataFrame, queries: dict[int, Queries], k: int, scale: float) -> DataFrame:
    sent = usable.sparkSession.sparkContext.broadcast(queries)

    def search(batches):
        asked = sent.value
        best = {n: Best(len(q.ids), k) for n, q in asked.items()}
        for batch in batches:
            if batch.num_rows:
                for n, ids, x in _by_length(np.asarray(batch.column("id")), *quantized(batch.column("vec"), scale)):
                    if n in asked:
                        asked[n].search(ids, x, best[n])
        for n, have in best.items():
            row, place = np.nonzero(have.scores > -np.inf)
            arrays = [asked[n].ids[row], have.ids[row, place], have.scores[row, place].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["query_id", "vec_id", "score"])

    return usable.mapInArrow(search, "query_id long, vec_id long, score long")
