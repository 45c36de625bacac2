"""Line differences against distances place by place; respaced chains against a walk along them."""

import numpy as np
import pytest

from brackish.operators import chains as C


def distance(px, py, seg):
    """From places (arrays) to a segment."""
    x1, y1, x2, y2 = seg
    d = (x2 - x1) ** 2 + (y2 - y1) ** 2
    t = np.clip(((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / d, 0, 1) if d else 0.0
    return np.hypot(px - x1 - t * (x2 - x1), py - y1 - t * (y2 - y1))


def check(rows, lines, others, radius):
    """Kept shares of each segment hold just the places that are farther than ``radius``."""
    t = np.linspace(0, 1, 2001)
    kept = {}
    for r in rows:
        kept.setdefault((r[0], r[1]), []).append((r[2], r[3]))
    for line, order, x1, y1, x2, y2 in lines:
        px, py = x1 + t * (x2 - x1), y1 + t * (y2 - y1)
        far = np.min([distance(px, py, s) for s in others], axis=0)
        inside = np.zeros(len(t), bool)
        for a, b in kept.get((line, order), []):
            inside |= (t >= a) & (t <= b)
        sure = np.abs(far - radius) > 1e-9
        assert (inside[sure] == (far > radius)[sure]).all()


@pytest.fixture(scope="module")
def drawn():
    pick = np.random.default_rng(3)
    lines = []
    for line in range(12):
        walk = np.cumsum(pick.normal(size=(15, 2)) * pick.choice([0.3, 2.0]), axis=0) + pick.uniform(-5, 5, 2)
        lines += [(f"l{line}", i, *map(float, walk[i]), *map(float, walk[i + 1])) for i in range(14)]
    others = [tuple(map(float, np.r_[p, p + pick.normal(size=2) * pick.choice([0.0, 0.5, 6.0])])) for p in pick.uniform(-8, 8, (25, 2))]
    others += [(-50.0, 1.0, 50.0, 1.0), (3.0, -50.0, 3.0, 50.0)]
    return lines, others


@pytest.mark.parametrize("radius", [0.2, 1.0])
def test_difference_against_distances(spark, drawn, radius):
    lines, others = drawn
    a = spark.createDataFrame([*lines, ("l0", 99, 1.0, 1.0, 1.0, 1.0), ("l0", 98, None, 1.0, 1.0, 1.0)], "line string, i int, x1 double, y1 double, x2 double, y2 double").repartition(3)
    b = spark.createDataFrame([*others, others[0], (float("nan"), 0.0, 0.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    got = C.away_from(a, b, "line", "i", radius).collect()
    check([(r.line, r.i, r["from"], r.to) for r in got], lines, others, radius)
    pieces = {}
    for r in sorted(got, key=lambda r: (r.line, r.i, r["from"])):
        pieces.setdefault((r.line, r.piece), []).append(r)
    for part in pieces.values():
        assert all(abs(p.x2 - q.x1) + abs(p.y2 - q.y1) < 1e-12 and p.to == 1 and q["from"] == 0 for p, q in zip(part, part[1:], strict=False))
        assert abs(sum(r.length for r in part) - part[0].piece_length) < 1e-9
    long = {(r.line, r.piece) for r in C.away_from(a, b, "line", "i", radius, least=1.5).collect()}
    assert long == {k for k, part in pieces.items() if part[0].piece_length >= 1.5}
    assert C.away_from(a.limit(0), b, "line", "i", radius).count() == 0
    assert C.away_from(a, b.limit(0), "line", "i", radius).count() == len(lines)


def test_query_against_distances(spark):
    from brackish.plans.meshes import lattice_lines

    lines, others = (df.collect() for df in lattice_lines(spark, "/root/testdata/sf0.001"))
    a, b = lattice_lines(spark, "/root/testdata/sf0.001")
    got = C.away_from(a, b, "row", "node", 0.6).collect()
    check([(r.row, r.node, r["from"], r.to) for r in got], [tuple(r) for r in lines], [tuple(r) for r in others], 0.6)
    assert got


def test_respaced(spark):
    pick = np.random.default_rng(5)
    walks = {"a": np.cumsum(pick.normal(size=(40, 2)), axis=0), None: np.cumsum(pick.normal(size=(9, 2)), axis=0) * 10, "dot": np.ones((1, 2)), "same": np.ones((4, 2))}
    rows = [(k, i, float(x), float(y), float(0.1 + pick.random()), "n") for k, w in walks.items() for i, (x, y) in enumerate(w)]
    bad = [("a", 5, None, 1.0, 1.0, "n"), ("a", 6, 1.0, 1.0, 0.0, "n"), ("a", 7, 1.0, float("nan"), 1.0, "n")]
    df = spark.createDataFrame(rows + bad, "k string, i int, x double, y double, h double, n string").repartition(3)
    got = {}
    for r in C.respaced(df, ["k"], "i", "x", "y", "h").collect():
        got.setdefault(r.k, []).append(r)
    for k, walk in walks.items():
        mine = sorted(got[k], key=lambda r: r.n)
        h = np.array([r[4] for r in rows if r[0] == k])
        s = np.r_[0, np.cumsum(np.hypot(*np.diff(walk, axis=0).T))] if len(walk) > 1 else np.zeros(1)
        assert [r.n for r in mine] == list(range(len(mine))) and abs(mine[-1].along - s[-1]) < 1e-6
        assert np.hypot(mine[0].x - walk[0][0], mine[0].y - walk[0][1]) < 1e-9 and np.hypot(mine[-1].x - walk[-1][0], mine[-1].y - walk[-1][1]) < 1e-6
        if k in ("a", None):
            fine = np.linspace(0, s[-1], 200_001)
            needed = np.r_[0, np.cumsum(np.diff(fine) * 0.5 * (np.interp(fine[1:], s, 1 / h) + np.interp(fine[:-1], s, 1 / h)))]
            steps = np.diff(np.interp([r.along for r in mine], fine, needed))
            assert len(mine) == np.ceil(needed[-1] - 1e-9) + 1 and steps.max() <= 1 + 1e-4 and np.ptp(steps) < 1e-3
    assert len(got["dot"]) == len(got["same"]) == 1
    assert C.respaced(df.limit(0), ["k"], "i", "x", "y", "h").count() == 0
