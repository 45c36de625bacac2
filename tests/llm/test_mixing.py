"""The mix against a walk through the queues of all sources."""

import hashlib
import random
import re

import pytest

from brackish.llm import mixing

WEIGHTS = (3, 1, 2)


def brute_targets(sizes, share=1.5):
    """{source: target} by resharing until none is above twice its source."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        target |= {s: 2.0 * sizes[s] for s in above}
        open_ -= above
        left -= sum(2 * sizes[s] for s in above)
    return target


def brute(rows):
    """[(doc_id, size, source_size, target, taken)]"""
    sized = [(d, s, len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))) for d, t, s in rows]
    sizes = {}
    for _, s, n in sized:
        sizes[s] = sizes.get(s, 0) + n
    goals = brute_targets(sizes)
    out = []
    for source, size in sizes.items():
        queue = sorted((r for r in sized if r[1] == source), key=lambda r: ("" if r[0] is None else hashlib.md5(str(r[0]).encode()).hexdigest()[:15], r[0] or 0, r[2]))
        left, taken = int(goals[source] + 1e-9), [0] * len(queue)
        for _ in range(2):
            for i, (_, _, n) in enumerate(queue):
                served = min(n, left)
                taken[i] += served
                left -= served
        out += [(d, n, size, pytest.approx(goals[source]), t) for (d, _, n), t in zip(queue, taken, strict=True)]
    return out


def make(seed, docs=400):
    pick = random.Random(seed)
    sources = ["a", "B", "é", "", "zz", None, "hot", "hot", "hot", "hot", "\U0001f600"]
    rows = [(i, " \n".join("w" * pick.randint(1, 4) for _ in range(pick.choice([0, 1, 7, 40]))), pick.choice(sources)) for i in range(docs)]
    rows += [(1000, None, "a"), (1001, "", None), (1002, "\t \x0b", "hot"), (1003, "a\x1cb c d", "a"), (1004, "x " * 5000, "small"), (1005, "x", "one")]
    return rows + [rows[3], rows[3], (None, "no id here", "a")]


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, words int, before int").repartition(5)
    got = mixing.mix(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(brute(rows), key=key)
    mixed, _ = mixing.stream(df)
    at, finish = 0, 0.0
    for r in sorted(mixed.collect(), key=lambda r: r.start):
        assert r.start == at and r.finish >= finish and r.words > 0 and 0 < r.finish <= 1
        at, finish = at + r.words, r.finish
    assert at == sum(r.taken for r in got)
    sizes = [len((t or "").replace(" ", "_").replace("\x1c", "_").split()) for _, t, _ in rows]
    assert 1.5 * sum(sizes) - 12 <= at <= 1.5 * sum(sizes)
    return sorted(map(tuple, got), key=lambda r: (key(r), r[5] or 0))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_walk(spark, seed):
    rows = make(seed)
    assert check(spark, rows) == check(spark, rows[::-1])


def test_sliced(spark, monkeypatch):
    rows = make(3)
    whole = check(spark, rows)
    monkeypatch.setattr(mixing, "SLICE_ROWS", 20)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert check(spark, rows) == whole


def test_nothing(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    wordless = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], schema)).collect()
    assert sorted(r[:5] for r in map(tuple, wordless)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.mix(spark.createDataFrame([(1, "one two three", "a")], schema)).first().taken == 4
