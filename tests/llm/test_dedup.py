"""Line, near-copy and span deduplication against plain loops."""

import random

import pytest

from brackish.llm import bloom, lines, simhash, substring
from tests.llm import brute

SCHEMA = "doc_id long, text string, keys string, N_LINES int"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "kept", 7) for d, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd_docs():
    """Nulls, empties, repeated rows, ties, one very long text, copies and near copies."""
    pick = random.Random(4)
    words = [f"w{i}" for i in range(30)] + ["Émile", "straße", "ÀÉ"]
    line = lambda n: " ".join(pick.choice(words) for _ in range(n))
    shared = [line(9) + " a shared line" for _ in range(3)]
    rows = []
    for d in range(60):
        body = [line(pick.randint(1, 14)) for _ in range(pick.randint(1, 6))]
        if d % 3 == 0:
            body.insert(0, "  " + shared[d % 2].upper().replace("É", "é") + "\t")
        if d % 7 == 0:
            body += [shared[2], shared[2]]
        rows.append((d, "\n".join(body)))
    rows += [(100 + i, rows[5][1]) for i in range(6)] + [(200 + i, rows[9][1] + f" tail{i}") for i in range(5)]
    rows += [(300, None), (301, ""), (302, " \n\t\n"), (303, "one"), (303, "one"), (304, "two words"), (None, rows[5][1])]
    rows += [(305, "\n".join(line(400) for _ in range(200)) + "\n" + shared[0])]
    return rows


def test_lines_against_brute_force(spark, odd_docs):
    got = lines.dedupe_lines(table(spark, odd_docs))
    assert got.columns == ["doc_id", "text", "keys", "n_lines", "n_dropped"]
    have = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = sorted(brute.dedupe_lines(odd_docs), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert have == want and any(r[3] for r in want)


def test_lines_of_nothing(spark):
    assert lines.dedupe_lines(table(spark, [])).count() == 0


def test_full_bloom_filter_only_adds_suspects(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(bloom, "filter_bits", lambda items: 1 << 17)
    monkeypatch.setattr(bloom, "positions", lambda hashes, bits: [hashes * 0])  # every hash looks repeated
    got = lines.dedupe_lines(table(spark, odd_docs)).agg({"n_dropped": "sum"}).first()[0]
    assert got == sum(r[3] for r in brute.dedupe_lines(odd_docs))


@pytest.mark.parametrize("chunk", [2000, 2])
def test_near_copies_against_brute_force(spark, odd_docs, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    got = simhash.near_groups(table(spark, odd_docs)).collect()
    prints = {d: brute.fingerprint(t) for d, t in odd_docs if d is not None}
    groups = brute.components(prints)
    assert len(got) == len(odd_docs)
    assert {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in got if r.doc_id is not None} == {d: (prints[d], groups[d]) for d in prints}
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    kept = simhash.keep_one(table(spark, odd_docs))
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(d for d, _ in odd_docs if d is not None and groups[d] == d)


def test_close_fingerprints_of_one_bucket(spark):
    """A dense cloud around one fingerprint, in chunks, is linked as by comparing all pairs."""
    pick = random.Random(2)
    clouds = {}
    for n in range(300):
        fp = 0x0F0F123456789ABC if n % 2 else 0x7123456789ABCDEF
        for b in pick.sample(range(64), pick.randint(0, 5)):
            fp ^= 1 << b
        clouds.setdefault(fp, n)
    nodes = spark.createDataFrame([(fp - (1 << 64) if fp >> 63 else fp, n) for fp, n in clouds.items()], "fp long, node long")
    want = brute.components({n: fp for fp, n in clouds.items()})
    found = {n: n for n in clouds.values()}
    links = [(r.a, r.b) for r in simhash.links(nodes).collect()]
    for _ in links:
        for a, b in links:
            found[a] = found[b] = min(found[a], found[b])
    assert found == want


def test_near_copies_of_nothing(spark):
    assert simhash.near_groups(table(spark, [])).count() == 0


def test_fingerprint_over_blocks(monkeypatch):
    from brackish.llm import texts

    text = " ".join(f"Word{i % 50}" for i in range(3000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "blocks", lambda data: texts.blocks(data, 100))
    assert simhash.fingerprint(text.encode()) == whole == brute.fingerprint(text)


@pytest.mark.parametrize("window, kmer", [(6, 3), (50, 10)])
def test_spans_against_brute_force(spark, odd_docs, window, kmer):
    pick = random.Random(9)
    passage = [f"p{pick.randint(0, 400)}" for _ in range(90)]
    rows = [(d, t) for d, t in odd_docs if d is not None and d != 305]
    rows = list({d: (d, t) for d, t in rows}.values())
    for d in range(400, 430):
        a, b = sorted(pick.sample(range(90), 2))
        rows.append((d, " ".join([*(f"x{pick.randint(0, 9)}" for _ in range(pick.randint(0, 30))), *passage[a:b], "end", *passage[: pick.randint(0, 90)]])))
    rows += [(500, "same " * 300), (501, "same " * 120), (502, None), (503, "few words")]
    got = substring.drop_repeats(table(spark, rows), window, kmer)
    assert got.columns == ["doc_id", "text", "keys", "N_LINES", "n_words", "n_removed"]
    want = sorted(brute.repeats(rows, window))
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()) == want and any(r[2] for r in want)


def test_spans_of_repeated_and_nameless_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text), (2, text), (None, text), (3, text[: len(text) // 2])]
    got = substring.drop_repeats(table(spark, rows), 50).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("1", 0), ("2", 60), ("2", 60), ("3", 0), ("None", 0)]
    assert substring.drop_repeats(table(spark, [])).count() == 0


def test_spans_over_segments(spark, monkeypatch):
    monkeypatch.setattr(substring, "SEGMENT", 40)
    words = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(words)), (2, " ".join(["start", *words[17:280], "end"]))]
    found = {d: n for d, _, n, _ in brute.repeats(rows, 50)}
    assert {r.doc_id: r.n_removed for r in substring.drop_repeats(table(spark, rows), 50).collect()} == found
