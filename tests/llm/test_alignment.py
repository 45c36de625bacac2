"""Alignment of tokenizers against common ends of whole texts, encoded as a whole."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from brackish.llm import alignment
from brackish.llm.texts import byte_alphabet
from brackish.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER


def brute(texts):
    """[(n_a, n_b, n_groups, n_links, n_best, count_sum, sha)] for each text."""
    a_model = Tokenizer.from_file(BYTE_TOKENIZER)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PIECE_TOKENIZER)
    alphabet = byte_alphabet()
    made = []
    for text in texts:
        groups = []
        if text:
            a = a_model.encode(" " + text, add_special_tokens=False)
            b = b_model.encode(text)
            of_a = [bytes(alphabet[c] for c in t) for t in a.tokens]
            of_b = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, map(b_model.id_to_piece, b), strict=True)]
            if b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
                ends_a, ends_b = (np.cumsum([len(x) for x in y]).tolist() for y in (of_a, of_b))
                i = j = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
                    groups.append((a.ids[i:x], b[j:y]))
                    i, j = x, y
        made.append(groups)
    held = Counter(p for groups in made for p in {(x, y) for a, b in groups for x in a for y in b})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for groups in made:
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
            sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


def odd_texts():
    pick = random.Random(4)
    words = ["The", "it's", "naïve", " ", "  ", "\n", "\n\n  ", "\t", "日本語", "é", "<s>", "<|endoftext|>", "12,345.6", " ", " x", "straße", "don't", "zebra", "\x00", "👩‍🚀", "ﬁ", "thedan", "aaaaaaaaaaaaaaaaaaaaaaa", "…", "\r\n", "\x1c", "\x85"]
    texts = ["".join(pick.choice(words) + pick.choice(["", " ", " "]) for _ in range(pick.choice([1, 3, 20, 200]))) for _ in range(150)]
    return texts + [None, "", " ", "  ", "\n", "a▁b", "▁", "x" * 3000, " " * 500, "a" + " " * 77 + "b", "ab " * 4000, "é" * 500, "same text", "same text"]


def as_rows(df):
    return [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize("most, block, crossed", [(500_000, 1 << 18, 4096), (40, 60, 4), (0, 1000, 1)])
def test_against_common_ends(spark, monkeypatch, most, block, crossed):
    for name, value in (("BLOCK", block), ("CROSSED", crossed), ("FLUSH", 300)):
        monkeypatch.setattr(alignment, name, value)
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n int, pair string").repartition(3)
    # Workers import the module anew: the settings hold only here.
    pair = alignment.Pair(BYTE_TOKENIZER, PIECE_TOKENIZER)
    assert pair.fast is not None
    want = brute(texts)
    for text, row in zip(texts, want, strict=True):
        x = alignment.Aligned(text, pair)
        assert all((y == z).all() for y, z in zip((x.pairs, x.times), alignment.restored(alignment.shrunk(x.pairs, x.times)), strict=True))
        assert (x.n_a, x.n_b, x.n_groups, x.n_links, x.sha) == (*row[:4], row[6])
    assert as_rows(alignment.aligned(df, BYTE_TOKENIZER, PIECE_TOKENIZER, most)) == want


def test_ids_repeated_and_absent(spark):
    schema = "doc_id long, text string"
    rows = [(1, "one two"), (1, "one two"), (1, "three"), (None, "one two")]
    got = alignment.aligned(spark.createDataFrame(rows, schema), BYTE_TOKENIZER, PIECE_TOKENIZER, 1).collect()
    want = brute([t for _, t in rows])
    assert sorted(tuple(r)[1:] for r in got) == sorted(want) and sum(r.doc_id is None for r in got) == 1
    assert alignment.aligned(spark.createDataFrame([], schema), BYTE_TOKENIZER, PIECE_TOKENIZER).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_runs_of_any_shape(seed):
    pick = np.random.default_rng(seed)
    common = np.sort(pick.choice(5000, pick.integers(1, 800), replace=False)) + 1
    a, b = (np.unique(np.r_[common, pick.integers(1, common[-1] + 1, pick.integers(0, 60))]) for _ in range(2))
    shared = np.intersect1d(a, b)
    to_a, to_b = alignment.align(a, b)
    assert (a[to_a - 1] == shared).all() and (b[to_b - 1] == shared).all()
