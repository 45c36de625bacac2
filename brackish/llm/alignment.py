"""Alignment of two tokenizers over the same bytes, by skipping along diagonals of their token ends."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brackish.llm.texts import byte_alphabet, small_batches
from brackish.session import cut_lineage

BLOCK = 1 << 18  # characters of a text that are aligned together
FLUSH = 1 << 20  # pairs that a task gathers before it counts them
FREQUENT = 500_000  # pairs, the most frequent ones, whose counts (16 bytes each) are sent to every task at most
PROBE = 8  # equal ends in a row before slices are compared
CROSSED = 4096  # links of a group up to which they are listed; beyond it its distinct ids are counted first

# A space behind a character that is not white: no token of either kind reaches over it.
_CUT = re.compile(r"(?<=\S)(?= )")
# Characters that every Unicode version in use sorts into the same classes: two libraries cut words of these alike.
_SETTLED = re.compile("[\x00-\u024f\u0400-\u045f\u2010-\u2027]*")
# How byte-level tokenizers of this kind cut words (fixed value).
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_EMPTY = np.zeros(0, np.int64)


class Pair:
    """Ids and byte ends of the tokens of both tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        with open(a_path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary = {token: bytes(alphabet[c] for c in token) for token in model["model"]["vocab"]}
        ids = model["model"]["vocab"]
        self.fast = self._by_rank(model, {vocabulary[t]: i for t, i in ids.items() if t in vocabulary})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError("the second tokenizer has pieces that reach over a space")
        self.space = [self.b.piece_to_id("▁")]
        self.a_bytes = [b""] * (1 + max(ids.values()))
        for token, i in ids.items():
            self.a_bytes[i] = vocabulary[token]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = [np.array([len(x) for x in table]) for table in (self.a_bytes, self.b_bytes)]
        #: Each id with the sign behind it: within its group, at the end of it.
        self.signs = np.array([f"{i}{sign}" for table, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for sign in ends for i in range(len(table))], object)

    @staticmethod
    def _by_rank(model: dict, ranks: dict[bytes, int]):
        """The same merges in a faster library, if the ids of the vocabulary are in the order of its merges."""
        import tiktoken

        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        for token in special:
            ranks.pop(token.encode(), None)
        merged = [m if isinstance(m, str) else " ".join(m) for m in model["model"]["merges"]]
        vocabulary = model["model"]["vocab"]
        cutter = model["pre_tokenizer"]
        in_order = all(vocabulary[m.replace(" ", "")] == 256 + n for n, m in enumerate(merged)) and len(ranks) == 256 + len(merged)
        plain = model["normalizer"] is None and cutter["type"] == "ByteLevel" and cutter["use_regex"] and not cutter["add_prefix_space"]
        return tiktoken.Encoding("own", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}) if in_order and plain else None

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and end offsets of A, then of B, for a stretch of text that starts with a space; None if they do not spell it."""
        whole = text.encode()
        if self.fast and _SETTLED.fullmatch(text):
            a = self.fast.encode_to_numpy(text).astype(np.int64)
        else:
            a = self.a.encode(text, add_special_tokens=False).ids
            if b"".join([self.a_bytes[i] for i in a]) != whole:
                return None
            a = np.array(a)
        b = self.b.encode(text[1:]) if len(text) > 1 else self.space
        if b"".join([self.b_bytes[i] for i in b]) != whole:
            return None
        b = np.fromiter(b, np.int64, len(b))
        return a, np.cumsum(self.sizes[0][a]), b, np.cumsum(self.sizes[1][b])

    def group_text(self, a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group as decimal numbers."""
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        own, other = a.copy(), b + 2 * n_a
        own[to_a - 1] += n_a
        other[to_b - 1] += n_b
        spot_a = np.arange(len(a)) + np.repeat(np.r_[0, to_b[:-1]], np.diff(to_a, prepend=0))
        spot_b = np.arange(len(b)) + np.repeat(to_a, np.diff(to_b, prepend=0))
        every = np.empty(len(a) + len(b), np.int64)
        every[spot_a], every[spot_b] = own, other
        return "".join(self.signs[every].tolist())[:-1].encode()


_KEPT: dict[tuple[str, str], Pair] = {}  # a worker goes on with what earlier tasks have encoded


def tokenizers(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _KEPT:
        _KEPT[a_path, b_path] = Pair(a_path, b_path)
    return _KEPT[a_path, b_path]


def stretches(text: str, size: int = BLOCK) -> Iterator[str]:
    """Space and text in parts of about ``size`` characters that no token of either kind reaches over."""
    whole = " " + text
    at = 0
    while len(whole) - at > size:
        cut = _CUT.search(whole, at + size)
        if not cut:
            break
        yield whole[at : cut.start()]
        at = cut.start()
    yield whole[at:]


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group, how many tokens of A and of B lie before its end; both end arrays ascend to the same last value.

    While both have the same ends at the current shift of their indices every token is a group of its own.
    Once a few are, ever longer slices are compared, twice the length each time, and the last one, which differs, is
    halved down to the first difference.  There the ends are walked one by one up to the next common one, which changes the shift.
    """
    a, b = a_ends.tolist(), b_ends.tolist()
    n, i, j, run = len(a), 0, 0, 0
    inner_a: list[int] = []  # tokens that do not end a group
    inner_b: list[int] = []
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            i, j, run = i + 1, j + 1, run + 1
            if run == PROBE:
                step = PROBE
                while i + step <= n and a[i : i + step] == b[j : j + step]:
                    i, j, step = i + step, j + step, 2 * step
                while step > 1:
                    step >>= 1
                    if i + step <= n and a[i : i + step] == b[j : j + step]:
                        i, j = i + step, j + step
                run = 0
        elif x < y:
            inner_a.append(i)
            i, run = i + 1, 0
        else:
            inner_b.append(j)
            j, run = j + 1, 0
    found = []
    for size, inner in ((n, inner_a), (len(b), inner_b)):
        ends = np.ones(size, bool)
        ends[inner] = False
        found.append(np.flatnonzero(ends) + 1)
    return found[0], found[1]


def links(a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked id pairs (A id in the high, B id in the low 32 bits), ascending, and how many links each has."""
    n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
    size = n_a * n_b
    few = size <= CROSSED
    group = np.repeat(np.flatnonzero(few), size[few])
    inside = np.arange(len(group)) - np.repeat(np.cumsum(size[few]) - size[few], size[few])
    pairs = a[(to_a - n_a)[group] + inside // n_b[group]] << 32 | b[(to_b - n_b)[group] + inside % n_b[group]]
    found = [np.unique(pairs, return_counts=True)]
    for g in np.flatnonzero(~few):
        own, times = np.unique(a[to_a[g] - n_a[g] : to_a[g]], return_counts=True)
        others, times_b = np.unique(b[to_b[g] - n_b[g] : to_b[g]], return_counts=True)
        found.append(((own[:, None] << 32 | others).ravel(), (times[:, None] * times_b).ravel()))
    return added(found)


def added(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and the sums of their counts over several (keys, counts)."""
    if len(found) == 1:
        return found[0]
    keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, back, np.concatenate([c for _, c in found]))
    return keys, sums


class Aligned:
    """One text: token, group and link counts, distinct pairs with their links, and the digest of its groups."""

    def __init__(self, text: str | None, pair: Pair):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.pairs, self.times, self.sha = _EMPTY, _EMPTY, ""
        found, sha, first = [], hashlib.sha256(), True
        if not text:
            return
        counts = np.zeros(4, np.int64)
        for part in stretches(text):
            tokens = pair.tokens(part)
            if tokens is None:
                return
            a, a_ends, b, b_ends = tokens
            to_a, to_b = align(a_ends, b_ends)
            found.append(links(a, b, to_a, to_b))
            counts += (len(a), len(b), len(to_a), int(found[-1][1].sum()))
            sha.update((b"" if first else b";") + pair.group_text(a, b, to_a, to_b))
            first = False
        self.n_a, self.n_b, self.n_groups, self.n_links = counts.tolist()
        self.pairs, self.times = added(found)
        self.sha = sha.hexdigest()


def shrunk(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Distinct pairs with their links, compressed: A ids by their differences, B ids, links."""
    a = np.diff(pairs >> 32, prepend=0)
    planes = np.concatenate([a, pairs & 0xFFFFFFFF, times & 0xFFFFFFFF, times >> 32]).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def restored(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    a, b, low, high = np.ascontiguousarray(planes.T).view("<u4").reshape(4, -1).astype(np.int64)
    return np.cumsum(a) << 32 | b, low | high << 32


def _texts(batches) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Batches of about 4 MB with their texts; what is not UTF-8 counts as null."""
    for batch in small_batches(batches, "text", 1 << 22):
        out = []
        for data in batch.column("text").cast(pa.binary()).to_pylist():
            try:
                out.append(None if data is None else data.decode())
            except UnicodeDecodeError:
                out.append(None)
        yield batch, out


_DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def linked(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each document with its counts, the digest of its groups and its distinct pairs, compressed, as ``pairs``."""

    def run(batches):
        pair = tokenizers(a_path, b_path)
        for batch, texts in _texts(batches):
            found = [Aligned(text, pair) for text in texts]
            numbers = [pa.array([getattr(x, c) for x in found], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
            pairs = pa.array([shrunk(x.pairs, x.times) for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *numbers, pa.array([x.sha for x in found], pa.string()), pairs], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"{_DIGEST}, pairs binary")


def pair_counts(marked: DataFrame) -> DataFrame:
    """pair and n: in how many documents (rows) of ``linked`` an id pair is.  A task adds up its documents before it hands pairs on."""

    def run(batches):
        waiting, size = [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts.astype(np.int64))], ["pair", "n"])

        for batch in batches:
            for data in batch.column("pairs").to_pylist():
                waiting.append(restored(data)[0])
                size += len(waiting[-1])
                if size >= FLUSH:
                    yield flush()
                    waiting, size = [], 0
        if size:
            yield flush()

    return marked.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """A count that at most ``most`` pairs reach, from a histogram by powers of two."""
    bins = {r["bin"]: r["pairs"] for r in counts.groupBy(F.floor(F.log2("n") + 1e-9).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("pairs")).collect()}
    have, least = 0, 1 << (max(bins, default=0) + 1)
    for n in sorted(bins, reverse=True):
        have += bins[n]
        if have > most:
            break
        least = 1 << n
    return least


def aligned(docs: DataFrame, a_path: str, b_path: str, most: int = FREQUENT) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level tokenizer of the tokenizers library and reads a space and the text, B a sentencepiece model
    that adds the space itself; both files lie at the same path on every executor.  Texts are cut into groups
    where tokens of both end; the tokens of a group are linked each with each.  ``n_best`` are the
    links whose pair is in as many documents as the best pair of its A id, ``count_sum`` adds these numbers over all links.

    Null and empty texts and those whose tokens do not spell space and text have no tokens: zeros and ''.  Very long
    texts are aligned in parts that end before a space.  Rows that repeat a doc_id are a document each; rows without one come
    out too; an empty table gives no rows.

    Each text is encoded and aligned once; its distinct pairs are written, compressed, to the checkpoint folder, and read
    for the counts and to look them up.  The ``most`` most frequent pairs, those above a common count, are sent to the
    tasks; links of rarer ones, none of which has many documents, meet their counts in a join.
    """
    marked = cut_lineage(linked(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()))
    counts = cut_lineage(pair_counts(marked))
    of_a = F.shiftright("pair", 32).cast("int")
    best_rows = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("best")).toArrow()  # one row an id of A
    best = np.zeros(1 + max(best_rows.column("a").to_pylist(), default=0), np.int64)
    best[np.asarray(best_rows.column("a"))] = np.asarray(best_rows.column("best"))
    least = frequent_from(counts, most)
    known = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(np.asarray(known.column("pair")))
    sent = docs.sparkSession.sparkContext.broadcast((np.asarray(known.column("pair"))[order], np.asarray(known.column("n"))[order], best))

    def run(batches):
        pairs, numbers, best = sent.value
        for batch in batches:
            sums, rare = [], []
            for data in batch.column("pairs").to_pylist():
                own, times = restored(data)
                if len(pairs):
                    at = np.minimum(np.searchsorted(pairs, own), len(pairs) - 1)
                    there = pairs[at] == own
                else:
                    at, there = np.zeros(len(own), np.int64), np.zeros(len(own), bool)
                top, n = best[own >> 32], numbers[at[there]]
                sums.append((int(times[there][n == top[there]].sum()), int((times[there] * n).sum())))
                rare.append((own[~there], times[~there], top[~there]))
            ends = np.cumsum([0, *(len(p) for p, _, _ in rare)]).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(np.concatenate([r[c] for r in rare] or [_EMPTY])) for c in range(3)], ["pair", "times", "top"])
            columns = [pa.array([s[c] for s in sums], pa.int64()) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns, pa.ListArray.from_arrays(pa.array(ends), structs)], ["row", "n_best", "count_sum", "rare"])

    schema = "row long, n_best long, count_sum long, rare array<struct<pair:long,times:long,top:long>>"
    looked = cut_lineage(marked.select("row", "pairs").mapInArrow(run, schema))
    met = looked.select("row", F.inline("rare")).join(counts.where(F.col("n") < least), "pair")
    more = met.select("row", F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0).alias("n_best"), (F.col("n") * F.col("times")).alias("count_sum"))
    sums = looked.select("row", "n_best", "count_sum").unionByName(more).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return marked.drop("pairs").join(sums, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
