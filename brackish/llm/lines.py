"""Line deduplication: two Bloom filters find suspected repeats, only those are shuffled and counted."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.llm import bloom
from brackish.llm.texts import WHITE, fresh, small_batches, to_bytes, widened

SALTS = 32  # a key's rows meet its verdict in so many places


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or sum((b & 0xC0) != 0x80 for b in key) >= least)


def _keys(data: bytes, least: int) -> list[bytes]:
    """The distinct keys of a text that may count as repeats, in order."""
    return [k for k in dict.fromkeys(map(line_key, data.split(b"\n"))) if _long_enough(k, least)]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def dedupe_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """Drop repeated lines everywhere but in the largest doc_id that holds them.

    A line's key is the line without white space (space, tab to CR) at its ends and
    with A-Z lower-cased.  Keys of at least ``least_chars`` code points found in at
    least ``least_docs`` documents lose all their lines except those of the largest
    doc_id.  Returns all columns of ``docs``, ``text`` without the dropped lines, and
    ``n_lines`` (before dropping) and ``n_dropped``, which replace columns of those names.

    Pass one builds two Bloom filters of fixed size; pass two shuffles only lines
    whose hash was seen twice, and counts them exactly as text.  Null or empty text is
    one empty line and comes out empty.  Rows that repeat a doc_id are one
    document: they count once and all lose the same keys.  Rows without a doc_id
    are never counted and lose nothing.
    """
    docs = docs.drop("n_lines", "n_dropped")
    rows = docs.where("doc_id is not null").select("doc_id", "text")
    breaks = F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    bits = bloom.filter_bits(rows.agg(breaks).first()[0] or 0)

    def hashes(batch):
        for part in small_batches([batch], "text", 1 << 22):
            yield _hashes([k for data in to_bytes(part.column("text")) for k in _keys(data, least_chars)])

    twice = bloom.seen_twice(rows, "text", hashes, bits)

    def suspects(batches):
        for part in small_batches(batches, "text", 1 << 22):
            owners, keys = [], []
            for owner, data in zip(part.column("doc_id").to_pylist(), to_bytes(part.column("text")), strict=True):
                mine = _keys(data, least_chars)
                owners += [owner] * len(mine)
                keys += mine
            kept = pa.array(bloom.suspected(_hashes(keys), twice.value))
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(keys, pa.binary())], ["owner", "key"]).filter(kept)

    held = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(suspects, "owner long, key binary").distinct()
    repeated = held.groupBy("key").agg(F.count("*").alias("n"), F.max("owner").alias("last")).where(F.col("n") >= least_docs)
    salted = repeated.select("key", "last", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    drops = (
        held.withColumn("salt", F.pmod(F.xxhash64("owner"), F.lit(SALTS)).cast("int"))
        .join(salted, ["key", "salt"]).where("owner < last")
        .groupBy("owner").agg(F.collect_list("key").alias("keys"))
    )
    owner, keys, names = fresh(docs, "__owner"), fresh(docs, "__keys"), docs.columns
    joined = docs.join(drops.select(F.col("owner").alias(owner), F.col("keys").alias(keys)), F.col("doc_id") == F.col(owner), "left").drop(owner)

    def cut(batches):
        for part in small_batches(batches, "text", 1 << 22):
            texts, lines, gone = [], [], []
            for data, drop in zip(to_bytes(part.column("text")), part.column(keys).to_pylist(), strict=True):
                mine = data.split(b"\n")
                if drop:
                    drop = set(drop)
                    left = [line for line in mine if line_key(line) not in drop]
                    texts.append(b"\n".join(left))
                else:
                    left = mine
                    texts.append(data)
                lines.append(len(mine))
                gone.append(len(mine) - len(left))
            new = {"text": pa.array(texts, pa.binary()).cast(pa.string()), "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(gone, pa.int64())}
            columns = {name: part.column(name) for name in names} | new
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return joined.mapInArrow(cut, widened(docs, "n_lines long, n_dropped long"))


def text_length() -> Column:
    """Code points of the text, for tables that keep them."""
    return F.length("text").cast("long")
