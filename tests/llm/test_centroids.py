"""Centroid clustering against plain loops over integers."""

import hashlib

import numpy as np
import pytest

from brackish.llm import centroids


def brute(rows, k=8, rounds=10, tag="3"):
    """(rows, centroids): {position: (key, cluster, distance)} by Lloyd's rounds with Python integers."""
    kept = [(key, [int(np.floor(1024 * float(x))) for x in v]) for key, v in rows if v and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    draw = lambda r: (r[0] is None, hashlib.sha256(f"{tag}:{r[0]}".encode()).hexdigest())
    middle = [list(v) for _, v in sorted(kept, key=draw)[:k]]

    def assign():
        out = []
        for key, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in middle]
            out.append((key, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(middle)):
            mine = [v for (_, v), (_, n, _) in zip(kept, own, strict=True) if n == c]
            if mine:
                middle[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return assign(), middle


def rows_of(seed, n=300, scale=1.0):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(5, 64)) * scale
    return [(i, [float(x) for x in (centres[i % 5] + pick.normal(size=64) * scale / 3).astype(np.float32)]) for i in range(n)]


@pytest.mark.parametrize("seed, scale", [(1, 0.2), (2, 40.0)])
def test_against_loops(spark, seed, scale):
    rows = rows_of(seed, scale=scale)
    rows[9] = (9, rows[3][1])  # equal vectors
    rows += [rows[4], rows[5]]  # repeated rows
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [0.0] * 63), (905, [float("nan")] + [0.0] * 63), (906, [float("-inf")] * 64), (None, rows[7][1])]
    df = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], "vec_id long, embedding array<float>, cluster int, planes string").repartition(4)
    got = centroids.cluster(df)
    want, middle = brute(rows)
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in got.rows.collect()), key=key) == sorted(want, key=key)
    assert got.centroids.tolist() == middle and got.counts == [sum(c == n for _, c, _ in want) for n in range(8)]
    assert got.inertias == [sum(d for _, c, d in want if c == n) for n in range(8)]


def test_few_and_none(spark):
    rows = rows_of(5, n=3)
    schema = "vec_id long, embedding array<double>"
    got = centroids.cluster(spark.createDataFrame(rows, schema))
    assert [r.distance for r in got.rows.collect()] == [0, 0, 0] and len(got.centroids) == 3
    same = centroids.cluster(spark.createDataFrame([(i, [0.0] * 64) for i in range(20)], schema))
    assert {tuple(r)[1:] for r in same.rows.collect()} == {(0, 0)} and same.counts == [20, 0, 0, 0, 0, 0, 0, 0]
    none = centroids.cluster(spark.createDataFrame([], schema))
    assert none.rows.count() == 0 and none.rows.columns == ["key", "cluster", "distance"] and not len(none.centroids)
    with pytest.raises(ValueError, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], schema))


@pytest.mark.parametrize("bits", [2, 11, 28])
def test_planes_give_exact_products(bits):
    pick = np.random.default_rng(bits)
    half = 1 << bits - 1
    a, b = (pick.integers(-half, half, (50, 64)) for _ in range(2))
    a[0], b[0] = -half, -half
    p, q = centroids.planes(a, bits), centroids.planes(b, bits)
    assert (centroids.dots(p, q) == (a * b).sum(axis=1)).all() and (centroids.plane_sums(p) == a.sum(axis=0)).all()
