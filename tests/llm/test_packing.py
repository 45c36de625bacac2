"""Packing, search, and the registered queries with SQL."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from brackish.llm import packing, vectors
from brackish.llm.queries import ORACLES, QUERIES, TOKENIZER
from tests.llm import brute
from tests.llm.test_shingles import without_near_copies
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


def check_packed(rows, texts, window):
    """Every id in exactly one piece; sequences without gaps or overlaps."""
    encode = Tokenizer.from_file(TOKENIZER).encode
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc, text in texts.items():
        ids = [*encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], "<u4")
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(part.tobytes()) and len(part) == r.length
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(by_sequence)


def test_packing_of_odd_texts(spark):
    pick = random.Random(1)
    words = ["The", "it's", "café,", "Amélie", "İstanbul.", "x" * 300, "你好", "12,345.6", "<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>.", " nb sp", "don't...", "…,", "Á!", "ΣΣ.", "###"]
    texts = {i: " ".join(pick.choice(words) for _ in range(pick.choice([0, 1, 5, 40, 3000]))) for i in range(40)}
    texts |= {100: None, 101: "", 102: " \n\t ", 103: "\n".join("word" for _ in range(9000))}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, length int")
    rows = packing.pack(df, TOKENIZER, group_docs=20).collect()
    check_packed(rows, texts, 4096)
    assert packing.pack(df.limit(0), TOKENIZER).count() == 0
    twice = packing.pack(df.where("doc_id = 101").union(df.where("doc_id = 101")), TOKENIZER).collect()
    assert [r.length for r in twice] == [1, 1] and sorted(r.offset for r in twice) == [0, 1]


def test_coder_is_the_tokenizer():
    """Texts of any characters, by the fast way where it is open, against the tokenizer itself."""
    encode, coder, pick = Tokenizer.from_file(TOKENIZER).encode, packing.Coder(TOKENIZER), random.Random(9)
    assert coder.fast is not None
    some = [chr(c) for c in [*range(0x250), *range(0x3A0, 0x460), *range(0x2000, 0x2030), 0x301, 0x308, 0x327, 0x1E9E, 0x130, 0x3A3, 0x4F60, 0x1F600, 0xFB01]]
    words = ["it's", "we'll", "'sock", "x're", "THE", "Straße", "İI", "²³½", "___", "…", "<|endoftext|>", "Ⱥ", "don''t", "12ab34"]
    texts = ["".join(pick.choice(some) for _ in range(30)) for _ in range(800)]
    texts += ["".join(pick.choice(words) + pick.choice(["", " ", "\n", pick.choice(some)]) for _ in range(12)) for _ in range(800)]
    texts += [a + b for a in some for b in ("x 'S", "'T")]
    for text in ["", " ", *texts]:
        assert coder.ids(text.encode()).tolist() == encode(text, add_special_tokens=False).ids


def test_packing_leaves_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(docs, TOKENIZER).collect()
    used = check_packed(rows, {r.doc_id: r.text for r in docs.collect()}, 4096)
    assert sum(r.length for r in rows) / (4096 * used) > 0.99


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_against_a_scan_of_all_windows(seed):
    lengths = np.random.default_rng(seed).integers(1, 65, 400)
    sequence, offset = packing.best_fit(lengths, 64)
    left: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        fits = [x for x in left if x >= n]
        if fits:
            left[left.index(min(fits))] -= n
        else:
            left.append(64 - n)
    assert len(set(sequence)) == len(left)
    filled = np.bincount(sequence, lengths)
    assert sorted(64 - filled.astype(int)) == sorted(left)
    assert (offset + lengths <= 64).all()


def test_top_k_against_brute_force(spark):
    random_ = np.random.default_rng(3)
    centres = random_.normal(size=(4, 20))
    rows = [(i, [float(x) for x in (centres[i % 4] * 3 + random_.normal(size=20) * (0.01 if i % 3 else 1)).astype(np.float32)]) for i in range(900)]
    rows[7] = (7, rows[0][1])
    rows[8] = (8, rows[0][1])  # ties
    rows += [(1000, None), (1100, []), (1200, [1.0, None] + [0.0] * 18), (1300, [float("nan")] * 20), (1400, [float("inf")] * 20), (1500, [1.0, 2.0]), (1501, [2.0, -1.0]), (None, rows[3][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string").repartition(3)
    got = vectors.top_k(df, F.col("vec_id") % 100 == 0, k=10).collect()
    usable = {i: np.floor(1024 * np.array(v, np.float64)).astype(np.int64) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in usable if i % 100 == 0):
        scores = sorted((-int(usable[q] @ v), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))[:10]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert vectors.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(Exception, match="too large"):
        vectors.top_k(spark.createDataFrame([(0, [1e15]), (1, [1e15])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()


def test_passes_give_what_one_pass_gives(spark, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    one = sorted(map(tuple, vectors.top_k(df, F.col("vec_id") % 20 == 0).collect()))
    monkeypatch.setattr(vectors, "PER_PASS", 7)
    assert sorted(map(tuple, vectors.top_k(df, F.col("vec_id") % 20 == 0).collect())) == one


@pytest.mark.parametrize("level", vectors.LEVELS)
def test_bounds_hold(level):
    x = np.random.default_rng(level).normal(size=(50, 30)) * 100
    s = vectors.segment_statistics(x, level)
    assert (s @ s.T >= x @ x.T - 1e-6).all()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, name):
    got = QUERIES[name](spark, SMALL).toArrow()
    assert compare(got, connect(SMALL).sql(ORACLES[name]).to_arrow_table()) == []


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(10_000, "12 34"), (10_001, None), (10_002, "!!!")]  # no letter: rejected by language
    more = spark.createDataFrame([(*r, None, None, None) for r in rows[-3:]], docs.schema)
    state = docs.unionByName(more)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = state.columns
        state = stage(spark, state, SMALL)
        assert state.columns == before
        state = spark.createDataFrame(state.toPandas(), docs.schema)
    kept = [(d, t) for d, t in rows if any(c.isalpha() for c in t or "")]
    kept = [(d, t) for d, t, _, _ in brute.dedupe_lines(kept)]
    left, _ = without_near_copies(kept)
    kept = [(d, t) for d, t in kept if d in left]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute.contaminated(kept, items)}
    kept = {d: t for d, t in kept if d not in bad}
    got = {r.doc_id: r.text for r in state.collect()}
    assert got == kept and bad
    check_packed(corpus_pipeline.STAGES[-1][1](spark, state, SMALL).collect(), kept, 4096)
    ran = {(r.doc_id, r.start, r.ids_crc32) for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert {d for d, _, _ in ran} == kept.keys()


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
