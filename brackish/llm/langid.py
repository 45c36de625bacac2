"""Language identification by rank-order n-gram profiles and out-of-place distance."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brackish.llm.texts import blocks, small_batches, to_bytes, widened

PROFILE = 400  # n-grams in a language's or a document's profile
SAMPLE_DOCS = 4000  # documents a language's profile is learned from, about
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the 1- to 3-grams of the words of a text, a blank on each side of a word.

    Words are runs of letters, lower-cased.  A code holds up to three code points of 21 bits.
    """
    found, counts = [], []
    for block in blocks(data):
        code = np.frombuffer(block.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32).astype(np.int64)
        letter = _letters()[code]
        code = np.r_[32, np.where(letter, code, 32), 32]
        blank = code == 32
        code = code[~(blank & np.r_[False, blank[:-1]])]
        if len(code) < 3:
            continue
        two = code[:-1] | code[1:] << 21
        three = two[:-1] | code[2:] << 42
        one, values = code[code != 32], np.empty(0, np.int64)
        values = np.sort(np.concatenate([one, two, three[code[1:-1] != 32]]))
        starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        found.append(values[starts])
        counts.append(np.diff(np.r_[starts, len(values)]))
    if len(found) == 1:
        return found[0], counts[0]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    values, at = np.unique(np.concatenate(found), return_inverse=True)
    return values, np.bincount(at, np.concatenate(counts)).astype(np.int64)


def ranked(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` most frequent codes (ties: smaller code) and their ranks; equal counts share their mean rank."""
    if len(counts) > 4 * most:
        floor = np.partition(counts, -most)[-most]
        values, counts = values[counts >= floor], counts[counts >= floor]
    order = np.argsort(-counts, kind="stable")[:most]
    values, counts = values[order], counts[order]
    starts = np.flatnonzero(np.r_[True, counts[1:] != counts[:-1]])
    sizes = np.diff(np.r_[starts, len(counts)])
    return values, np.repeat(starts + (sizes - 1) / 2, sizes)


@dataclass
class Profiles:
    """Ranks of n-grams by language: a row per n-gram, a column per language, ``size`` where it is absent."""

    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray
    size: int

    def distances(self, data: bytes) -> np.ndarray | None:
        """Mean out-of-place distance to each language, 0 to 1; None for a text without letters."""
        values, places = ranked(*ngrams(data), self.size)
        if not len(values) or not self.languages:
            return None
        at = np.minimum(np.searchsorted(self.codes, values), len(self.codes) - 1)
        known = self.codes[at] == values
        ranks = np.where(known[:, None], self.ranks[at], self.size)
        moved = np.where(ranks < self.size, np.abs(ranks - places[:, None]), self.size)
        return np.minimum(moved, self.size).mean(axis=0) / self.size


def fit_profiles(docs: DataFrame, lang: str = "lang", sample_docs: int = SAMPLE_DOCS, size: int = PROFILE) -> Profiles:
    """Profiles of the languages in ``lang``; rows without text or language are not used.

    A language with more than ``sample_docs`` rows is represented by about that many,
    chosen by a hash of doc_id.  What reaches the driver is ``size`` n-grams a language.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col(lang).alias("lang"))
    totals = rows.groupBy("lang").count().orderBy("lang").collect()
    if not totals:
        return Profiles([], np.empty(0, np.int64), np.empty((0, 0)), size)
    span = 1 << 20
    part = F.pmod(F.xxhash64("doc_id"), F.lit(span))
    chosen = F.lit(False)
    for row in totals:
        chosen |= (F.col("lang") == row["lang"]) & (part < int(span * min(1.0, sample_docs / row["count"])) + 1)

    def count(batches):
        for batch in small_batches(batches, "text", 1 << 22):
            by: dict[str, list] = {}
            for name, data in zip(batch.column("lang").to_pylist(), to_bytes(batch.column("text")), strict=True):
                by.setdefault(name, []).append(ngrams(data))
            for name, grams in by.items():
                values, at = np.unique(np.concatenate([g[0] for g in grams]), return_inverse=True)
                n = np.bincount(at, np.concatenate([g[1] for g in grams])) if len(values) else np.empty(0)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), pa.array(values), pa.array(n.astype(np.int64))], ["lang", "code", "n"])

    counted = rows.where(chosen).mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    best = counted.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < size).toPandas()
    languages = sorted(best["lang"].unique())
    codes = np.unique(best["code"].to_numpy())
    ranks = np.full((len(codes), len(languages)), float(size))
    ranks[np.searchsorted(codes, best["code"]), [languages.index(x) for x in best["lang"]]] = best["place"]
    return Profiles(languages, codes, ranks, size)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Add lang_pred and score (replacing columns of those names) to each document.

    ``score`` is 1 less the mean out-of-place distance of the nearest profile.  Null
    texts and texts without a letter are ``und`` with score 0, as is everything when no
    language was learned.  Equal distances go to the language first in the alphabet.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns

    def judge(batches):
        for batch in small_batches(batches, "text", 1 << 22):
            found, scores = [], []
            for data in to_bytes(batch.column("text")):
                far = profiles.distances(data)
                found.append(UNKNOWN if far is None else profiles.languages[int(far.argmin())])
                scores.append(0.0 if far is None else float(1 - far.min()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())], [*names, "lang_pred", "score"])

    return docs.mapInArrow(judge, widened(docs, "lang_pred string, score double"))


def accepted(least_score: float) -> Column:
    """Whether a document is in a known language and not too far from its profile."""
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)
