"""Packing of token sequences: best-fit decreasing with a segment tree over remaining capacity."""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brackish.llm.texts import blocks, byte_alphabet, small_batches, to_bytes

WINDOW = 4096
GROUP_DOCS = 20_000  # documents packed together by one task
# Characters that every Unicode version in use sorts into the same classes, without those that some take for white space.
_SETTLED = re.compile("[\x01-\x1b\x20-\x84\x86-\u024f\u0400-\u045f\u2010-\u2027]*")
# How the tokenizer cuts lower-case words (fixed value).
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_END = "</w>"


def _settled(kind: str) -> str:
    """The settled characters of a general category, for a character class."""
    every = map(chr, [*range(1, 0x250), *range(0x400, 0x460), *range(0x2010, 0x2028)])
    return "".join(re.escape(c) for c in every if unicodedata.category(c)[0] == kind)


class Coder:
    """Ids of texts by a tokenizer that lower-cases, cuts words and merges bytes up to the end of each word.

    Texts of settled characters are cut here, each word is marked at its end, and the same merges are run by a faster library,
    for which a word end is one more byte; all other texts go to the tokenizer itself, as do all where the vocabulary is of another kind.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(path).encode
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.special = [t["content"].lower() for t in model["added_tokens"]]
        self.fast = self._marked(model)
        letter, number = _settled("L"), _settled("N")
        self.cut = re.compile(f"[{letter}]++|'(?:[stmd]|re|ve|ll)|[{number}]|[^\\s{letter}{number}]++").findall

    @staticmethod
    def _marked(model: dict):
        """The merges with a zero byte for the end of a word, if the vocabulary is: bytes, bytes at an end, merges in their order."""
        import tiktoken

        steps = [(n["type"], n.get("pattern"), n.get("content")) for n in (model["normalizer"] or {}).get("normalizers", [])]
        cutters = [(c["type"], c.get("pattern"), c.get("invert")) for c in (model["pre_tokenizer"] or {}).get("pretokenizers", [])]
        expected = [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
        if steps != expected or cutters != [("Split", {"Regex": _WORDS}, True), ("ByteLevel", None, None)] or model["model"]["end_of_word_suffix"] != _END:
            return None
        vocabulary, alphabet = model["model"]["vocab"], byte_alphabet()
        merged = [m if isinstance(m, str) else " ".join(m) for m in model["model"]["merges"]]
        if any(vocabulary[m.replace(" ", "")] != 512 + n for n, m in enumerate(merged)):
            return None
        ranks = {}
        for token, i in vocabulary.items():
            if i < 512 + len(merged):
                ranks[bytes(alphabet[c] for c in token.removesuffix(_END)) + (b"\0" if token.endswith(_END) else b"")] = i
        return tiktoken.Encoding("own", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 512 + len(merged) else None

    def ids(self, data: bytes) -> np.ndarray:
        """Ids of a text or of a part that ends at white space."""
        text = data.decode("utf-8", "replace")
        plain = text.lower()
        if self.fast and _SETTLED.fullmatch(text) and _SETTLED.fullmatch(plain) and not any(t in plain for t in self.special):
            words = self.cut(plain)
            return self.fast.encode_to_numpy("\0".join(words) + "\0").astype("<u4") if words else np.zeros(0, "<u4")
        return np.array(self.encode(text, add_special_tokens=False).ids, "<u4")


_KEPT: dict[str, Coder] = {}  # a worker goes on with what earlier tasks have read


def encoder(path: str) -> Coder:
    if path not in _KEPT:
        _KEPT[path] = Coder(path)
    return _KEPT[path]


class Capacities:
    """Segment tree over remaining capacity 0..most: how many open windows have it."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, window: int, capacity: int) -> None:
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """A window of the smallest capacity of at least ``least``."""
        tree, node = self.tree, self.leaves + least
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return self.open[capacity].pop(), capacity

    def _add(self, capacity: int, n: int) -> None:
        node = self.leaves + capacity
        while node:
            self.tree[node] += n
            node >>= 1


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, longest first, each into the tightest open window."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    spaces, used = Capacities(window), 0
    for i in order:
        n = int(lengths[i])
        found = spaces.take(n) if n < window else None
        if found is None:
            at, capacity = used, window
            used += 1
        else:
            at, capacity = found
        sequence[i], offset[i] = at, window - capacity
        if capacity > n:
            spaces.put(at, capacity - n)
    return sequence, offset


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW) -> DataFrame:
    """Full windows of each document and what is left: doc_id, start, length, ids_crc32, doc_tokens.

    ``tokenizer`` is a file of the tokenizers library at the same path on every executor,
    one whose pre-tokenizer separates at white space.  Null text counts as empty: the end id alone.
    """

    def cut(batches):
        coder = encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for part in small_batches(batches, "text", 1 << 22):
            rows = []
            for owner, data in zip(part.column("doc_id").to_pylist(), to_bytes(part.column("text")), strict=True):
                coded = b"".join([coder.ids(block).tobytes() for block in blocks(data)] + [end])
                total = len(coded) // 4
                rows += [(owner, at, min(window, total - at), zlib.crc32(coded[4 * at : 4 * (at + window)]), total) for at in range(0, total, window)]
            arrays = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    Pieces are dealt by hash to groups of about ``group_docs`` documents, each of which a
    task packs by itself, on lengths alone; a group leaves a few windows part-filled, which
    is nothing against its thousands of full ones.  Null and empty texts are packed as the
    end id; rows that repeat a doc_id are packed each; equal lengths go in order of
    doc_id, start and checksum.  An empty table gives no rows.
    """
    groups = max(1, -(-docs.count() // group_docs))
    pieces = token_pieces(docs, tokenizer, end_id, window)

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        sequence, offset = best_fit(rows["length"].to_numpy(), window)
        rows["sequence_id"] = rows["_group"].astype("int64") * (1 << 32) + sequence
        rows["offset"] = offset
        return rows.drop(columns="_group")

    # The row number deals out even pieces of one document that is repeated very often.
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
