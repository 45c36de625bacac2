"""Union areas against unit squares counted one by one."""

import random

import pytest

from brackish.operators import boxes as B


def make(seed, n=400):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        w, s = pick.randint(-40, 40), pick.randint(-20, 20)
        # thin ones, large ones, a crowded corner
        width, height = pick.choice([(1, 30), (30, 1), (3, 3), (pick.randint(1, 60), pick.randint(1, 30)), (0, 5)])
        if pick.random() < 0.3:
            w, s, width, height = 5, 5, pick.randint(1, 4), pick.randint(1, 4)
        rows.append((pick.choice(["a", "a", "b", None]), float(w), float(s), float(w + width), float(s + height)))
    return rows + rows[:20]


def squares(rows):
    out = {}
    for k, w, s, e, n in rows:
        out.setdefault(k, set()).update((x, y) for x in range(int(w), int(e)) for y in range(int(s), int(n)))
    return {k: float(len(v)) for k, v in out.items() if v}


@pytest.mark.parametrize("most", [256, 30, 16])
def test_against_squares(spark, most):
    rows = make(most)
    odd = [("a", None, 0.0, 1.0, 1.0), ("a", float("nan"), 0.0, 1.0, 1.0), ("a", 0.0, 0.0, float("inf"), 1.0), ("c", 3.0, 3.0, 1.0, 5.0)]
    df = spark.createDataFrame(rows + odd, "k string, w double, s double, e double, n double").repartition(4)
    got = {r.k: r.area for r in B.union_area(df, ["k"], ("w", "s", "e", "n"), most=most).collect()}
    want = squares(rows)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    together = B.union_area(df, [], ("w", "s", "e", "n"), most=most).first().area
    assert abs(together - squares([("x", *r[1:]) for r in rows])["x"]) < 1e-9


def test_a_crowd_is_split(spark):
    """Ten thousand crossing slivers in one group: no task sweeps more than ``most`` of them."""
    df = spark.range(10_000).selectExpr("rand(1) * 100 x", "rand(2) * 100 y", "id % 2 = 0 tall")
    df = df.selectExpr("x w", "y s", "x + if(tall, 0.01, 9.0) e", "y + if(tall, 9.0, 0.01) n")
    small = B.union_area(df, [], ("w", "s", "e", "n"), most=100).first().area
    large = B.union_area(df, [], ("w", "s", "e", "n"), most=3000).first().area
    assert abs(small - large) < 1e-6


def test_coverage_is_a_share(spark):
    df = spark.createDataFrame([("a", -5.0, -5.0, 5.0, 5.0), ("a", 0.0, 0.0, 20.0, 5.0), ("b", 11.0, 0.0, 12.0, 1.0), ("c", -1.0, -1.0, 11.0, 11.0)], "k string, west double, south double, east double, north double")
    got = {r.k: r.fraction for r in B.coverage(df, ["k"], ("west", "south", "east", "north"), (0, 0, 10, 10)).collect()}
    assert got == {"a": 0.5, "c": 1.0}
    assert B.union_area(df.limit(0), ["k"], ("west", "south", "east", "north")).count() == 0
