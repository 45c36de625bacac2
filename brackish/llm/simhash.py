"""SimHash near-duplicates: blocks give candidates, pivot distances discard, an exact check links."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brackish.llm.texts import blocks, small_batches, to_bytes
from brackish.operators.graph import components
from brackish.session import cut_lineage

BITS = 3  # fingerprints that differ in so many bits or fewer are linked
WIDTHS = (11, 11, 11, 11, 10, 10)  # blocks of the fingerprint; BITS differences leave three of them equal
CHUNK = 2000  # fingerprints of a bucket that are compared with as many others in one task
SALTS = 32
#: Reference fingerprints, fixed: multiples of an odd constant, which are far from each other.
PIVOTS = np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def fingerprint(data: bytes, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included; 0 without words."""
    ones, total, carried = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for block in blocks(data):
        have = carried + block.lower().split()
        carried = have[-(words - 1) :] if words > 1 else []
        if len(have) < words:
            carried = have
            continue
        sizes = np.fromiter(map(len, have), np.int64, len(have))
        starts = np.r_[0, np.cumsum(sizes + 1)[:-1]]
        joined, firsts, ends = b" ".join(have), starts.tolist(), (starts + sizes)[words - 1 :].tolist()
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(firsts, ends, strict=False)), "<u8", len(ends))
        ones, total = ones + _ones(hashes), total + len(ends)
    if not total and carried:
        ones, total = _ones(np.array([digest(b" ".join(carried), seed)], "<u8")), 1
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * ones > total)))


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
    return total


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long; null text has no words."""

    def run(batches):
        for batch in small_batches(batches, "text", 1 << 22):
            found = np.array([fingerprint(data, words) for data in to_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _bucket_keys():
    """One key for each choice of three blocks: which choice, and the bits of these blocks."""
    offsets = np.r_[0, np.cumsum(WIDTHS)].tolist()
    keys = []
    for n, chosen in enumerate(combinations(range(len(WIDTHS)), 3)):
        key = F.lit(n).cast("long")
        for b in chosen:
            bits = F.shiftrightunsigned("fp", offsets[b]).bitwiseAND(F.lit((1 << WIDTHS[b]) - 1))
            key = F.shiftleft(key, WIDTHS[b]).bitwiseOR(bits)
        keys.append(key)
    return F.array(*keys)


def _tree(fps: np.ndarray, nodes: list[int], bits: int):
    """Links that span the components of one bucket; a pair farther apart from a pivot than ``bits`` is discarded unseen."""
    away = np.bitwise_count(fps[:, None] ^ PIVOTS).astype(np.int16)
    unseen = np.ones(len(fps), bool)
    for seed in range(len(fps)):
        if not unseen[seed]:
            continue
        unseen[seed] = False
        waiting = [seed]
        while waiting:
            x = waiting.pop()
            near = np.flatnonzero(unseen)
            for p in range(len(PIVOTS)):
                if not len(near):
                    break
                near = near[np.abs(away[near, p] - away[x, p]) <= bits]
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= bits]
            unseen[near] = False
            for y in near.tolist():
                waiting.append(y)
                yield nodes[x], nodes[y]


def links(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) between the ``node`` of fingerprints ``fp`` that connect all within ``bits``, at most 3, bits.

    Fingerprints are distinct.  Two that differ in 3 bits agree in three of six blocks, so each
    goes to the 20 buckets of its block triples.  Buckets of more than CHUNK are cut into chunks
    and every pair of chunks is compared, so that no bucket has to fit a task and none is cut short.
    """
    keyed = nodes.select("fp", "node", F.explode(_bucket_keys()).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    met = keyed.join(shared, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    lists = met.groupBy("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).agg(
        F.collect_list("fp").alias("fps"), F.collect_list("node").alias("nodes")
    )

    def compare(batches):
        for batch in batches:
            pairs = []
            for fps, ids in zip(batch.column("fps").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
                pairs += _tree(np.array(fps, np.int64).view(np.uint64), ids, bits)
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

    return lists.select("fps", "nodes").mapInArrow(compare, "a long, b long").distinct()


def near_groups(docs: DataFrame, words: int = 3, bits: int = BITS) -> DataFrame:
    """doc_id, fp and component_id: the smallest doc_id reachable over links of fingerprints.

    Links are found between distinct fingerprints, of which the smallest doc_id stands for
    all its copies.  Null and empty texts share fingerprint 0 and are linked like any other.
    Rows that repeat a doc_id come out as often as they came in.  Rows without a doc_id link
    nothing and get a null component.
    """
    marked = cut_lineage(fingerprints(docs, words))
    found = marked.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    named = cut_lineage(found)
    grouped = components(links(named.select("fp", "node"), bits), "a", "b")
    labels = named.join(grouped, "node", "left").select("fp", "node", "copies", F.coalesce("component", "node").alias("component_id"))
    single = labels.where("copies = 1").select(F.col("node").alias("doc_id"), "fp", "component_id")
    # Copies of one text may be a large part of all rows: each such label is laid out in several places.
    salted = labels.where("copies > 1").select("fp", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    copied = marked.where("doc_id is not null").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["fp", "salt"])
    alone = marked.where("doc_id is null").withColumn("component_id", F.lit(None).cast("long"))
    return single.unionByName(copied.select("doc_id", "fp", "component_id")).unionByName(alone)


def keep_one(docs: DataFrame, words: int = 3, bits: int = BITS) -> DataFrame:
    """The documents of ``docs`` without near copies: of each group the smallest doc_id stays.

    Of rows that repeat a doc_id all stay, as do rows without one.
    """
    gone = near_groups(docs, words, bits).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
