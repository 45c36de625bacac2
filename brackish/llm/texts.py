"""Helpers of the corpus operators: column names, row batches and word positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WHITE = b" \t\n\x0b\x0c\r"
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def widened(df: DataFrame, more: str) -> StructType:
    """The columns of ``df`` and those of a DDL string."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; null ids fall into fold 0 of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def to_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in runs of about ``limit`` bytes of ``column``, so that temporaries stay small.

    Arrow batches are cut by rows only; a single longer text makes a run of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        run = np.cumsum(sizes) // limit
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def blocks(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes that end before white space, so that no word is cut."""
    at = 0
    while len(data) - at > size:
        end = at + size
        while end < len(data) and data[end] not in WHITE:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last byte of each run of non-white bytes."""
    edge = np.diff(np.r_[True, _IS_WHITE[data], True].astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def byte_alphabet() -> dict[str, int]:
    """The byte of each character that byte-level tokenizers write: printable ones stand for themselves, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}
