"""Repeated word windows by a sparse de Bruijn graph with compacted paths."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brackish.llm import bloom
from brackish.llm.texts import blocks, fresh, small_batches, to_bytes, widened, word_spans
from brackish.session import cut_lineage

WINDOW = 50  # words of a span that counts as repeated
KMER = 10  # words of a k-mer, an edge of the graph
SEGMENT = 1 << 20  # words that are looked at together
_BYTES, _WORDS = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03  # odd bases of the two rolling hashes


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    inverse = pow(base, -1, 1 << 64)
    factors = np.full((2, n), 1, np.uint64)
    factors[0, 1:], factors[1, 1:] = base, inverse
    return np.multiply.accumulate(factors[0]), np.multiply.accumulate(factors[1])


def _scope(n: int) -> int:
    return 1 << max(16, (n + 1).bit_length())


def _spans_hash(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run values[start:end], equal for equal runs wherever they stand."""
    forward, back = _powers(base, _scope(len(values)))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * forward[: len(values)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    found = []
    for block in blocks(data):
        raw = np.frombuffer(block, np.uint8)
        starts, ends = word_spans(raw)
        found.append(_spans_hash(raw.astype(np.uint64) + np.uint64(1), _BYTES, starts, ends))
    return np.concatenate(found)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    low = values
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def window_runs(words: np.ndarray, window: int = WINDOW, kmer: int = KMER):
    """Runs of consecutive windows whose smallest k-mer is the same.

    Gives first window, number of windows, k-mer and run hash of each run, and the hash of
    each window.  Which k-mer a window has depends on its own words alone, so equal windows
    of different documents always meet under the same k-mer.
    """
    at = np.arange(len(words) - window + 1)
    kmers = _spans_hash(words, _WORDS, np.arange(len(words) - kmer + 1), np.arange(kmer, len(words) + 1))
    least = _sliding_min(kmers, window - kmer + 1)
    hashes = _spans_hash(words, _WORDS, at, at + window)
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    ends = np.r_[starts[1:], len(at)]
    return starts, ends - starts, least[starts], _spans_hash(words, _WORDS, starts, ends + window - 1), hashes


def _pieces(data: bytes, window: int, kmer: int):
    """window_runs() over segments that overlap by all but one word of a window: first window of the segment, runs."""
    words = word_hashes(data)
    for first in range(0, len(words) - window + 1, SEGMENT):
        yield first, window_runs(words[first : first + SEGMENT + window - 1], window, kmer)


def repeated_spans(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """(doc_id, start, n): n windows from word ``start`` that also start in a document of smaller doc_id.

    Each window belongs to the smallest of its k-mers.  These k-mers are the nodes of a sparse de Bruijn graph
    and the runs of windows between them its paths.  Bloom filters find k-mers seen in
    more than one text; only their runs are shuffled.  Where all occurrences of a k-mer continue
    alike the path does not branch: its windows stand for each other and are settled as one row.
    Where it branches, the windows of these runs are compared one by one.  Windows are
    equal if a k-mer hash and a window hash, of 64 bits each, are.
    """
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = bloom.filter_bits(letters // 80)  # a run has 20 windows on average, a word 4 letters or more

    def nodes(batch):
        for part in small_batches([batch], "text"):
            seen = [np.unique(np.concatenate(found)) for data in to_bytes(part.column("text")) if (found := [runs[2] for _, runs in _pieces(data, window, kmer)])]
            if seen:
                yield np.concatenate(seen)

    twice = bloom.seen_twice(rows, "text", nodes, bits)

    def suspects(batches):
        for part in small_batches(batches, "text"):
            owners, starts, sizes, anchors, marks, hashes = [], [], [], [], [], []
            for owner, data in zip(part.column("doc_id").to_pylist(), to_bytes(part.column("text")), strict=True):
                for first, (start, n, anchor, mark, each) in _pieces(data, window, kmer):
                    kept = bloom.suspected(anchor, twice.value)
                    if kept.any():
                        owners.append(np.full(int(kept.sum()), owner))
                        starts.append(first + start[kept])
                        sizes.append(n[kept])
                        anchors.append(anchor[kept])
                        marks.append(mark[kept])
                        hashes.append(each[np.repeat(kept, n)])
            if owners:
                ends = np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(hashes).view(np.int64)))
                flat = [np.concatenate(x) for x in (owners, starts)] + [np.concatenate(x).view(np.int64) for x in (anchors, marks)]
                yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in flat), lists], ["doc_id", "start", "anchor", "mark", "hashes"])

    # Read twice, once without the hashes: that costs less than keeping them on disk in between.
    found = rows.mapInArrow(suspects, "doc_id long, start long, anchor long, mark long, hashes array<long>")
    paths = found.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("mark").alias("one"), F.max("mark").alias("other"))
    # A new name for the key makes Spark deal both sides of the join, so that it can split a hot k-mer.
    paths = paths.where("low < high").select((-F.col("anchor")).alias("key"), "low", (F.col("one") != F.col("other")).alias("branches"))
    met = found.withColumn("key", -F.col("anchor")).join(paths, "key").where("branches or doc_id > low")
    settled = cut_lineage(
        met.select("doc_id", "start", F.size("hashes").cast("long").alias("n"), "anchor", F.when(F.col("branches"), F.col("hashes")).alias("hashes"))
    )
    whole = settled.where("hashes is null").select("doc_id", "start", "n")
    single = settled.where("hashes is not null").select("doc_id", "start", "anchor", F.posexplode("hashes").alias("at", "hash"))
    single = single.select("doc_id", (F.col("start") + F.col("at")).alias("start"), "anchor", "hash")
    firsts = single.groupBy("anchor", "hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    firsts = firsts.select((-F.col("anchor")).alias("key"), (-F.col("hash")).alias("hash"), "low")
    late = single.select("doc_id", "start", (-F.col("anchor")).alias("key"), (-F.col("hash")).alias("hash")).join(firsts, ["key", "hash"])
    return whole.unionByName(late.where("doc_id > low").select("doc_id", "start", F.lit(1).cast("long").alias("n")))


def drop_repeats(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """Remove each word covered by a ``window``-word span that also starts in a document of smaller doc_id.

    Words are runs without ASCII white space, unchanged.  Returns all columns, ``text`` as the kept
    words joined by one space, and n_words and n_removed, which replace columns of those names.
    Windows are judged on the input.  Null and empty texts and texts of fewer words lose nothing
    (null comes out empty).  Rows that repeat a doc_id are one document and lose the
    same windows; rows without a doc_id are left as they are and never count.
    """
    docs = docs.drop("n_words", "n_removed")
    owner, spans, names = fresh(docs, "__owner"), fresh(docs, "__spans"), docs.columns
    gone = repeated_spans(docs, window, kmer).distinct().groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias(spans))
    joined = docs.join(gone.withColumnRenamed("doc_id", owner), F.col("doc_id") == F.col(owner), "left").drop(owner)

    def cut(batches):
        for part in small_batches(batches, "text"):
            texts, totals, removed = [], [], []
            lists = part.column(spans)
            for row, data in enumerate(to_bytes(part.column("text"))):
                words = data.split()
                totals.append(len(words))
                if lists[row].is_valid:
                    held = lists[row].values
                    # A row that repeats the doc_id with a shorter text may have fewer words.
                    start = np.minimum(np.asarray(held.field("start")), len(words))
                    end = np.minimum(start + np.asarray(held.field("n")) + window - 1, len(words))
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, start, 1)
                    np.add.at(depth, end, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                texts.append(b" ".join(words))
                removed.append(totals[-1] - len(words))
            new = {"text": pa.array(texts, pa.binary()).cast(pa.string()), "n_words": pa.array(totals, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
            columns = {name: part.column(name) for name in names} | new
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return joined.mapInArrow(cut, widened(docs, "n_words long, n_removed long"))
