"""Faces of linework against exact arithmetic with fractions."""

import random
from fractions import Fraction as Q

import pytest

from brackish.operators import arrangement as A


def brute_faces(segments):
    """[(area, [corners], holes)] of the bounded faces, by exact crossings and walks around faces."""
    lines = {tuple(sorted([(Q(a), Q(b)), (Q(c), Q(d))])) for a, b, c, d in segments if (a, b) != (c, d)}
    cross = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    on = lambda p, q, r: cross(p, q, r) == 0 and min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])
    edges = set()
    for p, q in lines:
        cuts = {p, q}
        for r, s in lines:
            cuts |= {x for x in (r, s) if on(p, q, x)}
            a, b = cross(r, s, p), cross(r, s, q)
            if a * b < 0 and cross(p, q, r) * cross(p, q, s) < 0:
                t = a / (a - b)
                cuts.add((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        walk = sorted(cuts)
        edges |= set(zip(walk, walk[1:], strict=False))
    while True:
        rings = walks(edges)
        label = {arrow: i for i, ring in enumerate(rings) for arrow in ring}
        kept = {(u, v) for u, v in edges if label[u, v] != label[v, u]}
        if kept == edges:
            break
        edges = kept
    area = lambda ring: sum(u[0] * v[1] - u[1] * v[0] for u, v in ring) / 2
    outer = [r for r in rings if area(r) > 0]
    found = {i: [] for i in range(len(outer))}
    for hole in (r for r in rings if area(r) < 0):
        p = min(u for u, _ in hole)
        around = [i for i, r in enumerate(outer) if inside(p, r) and all(u != p for u, _ in r)]
        if around:
            found[min(around, key=lambda i: area(outer[i]))].append(hole)
    return [(area(r) + sum(map(area, found[i])), r, found[i]) for i, r in enumerate(outer)]


def walks(edges):
    from functools import cmp_to_key

    star = {}
    for u, v in edges:
        star.setdefault(u, []).append(v)
        star.setdefault(v, []).append(u)

    def turn(u):
        half = lambda v: 0 if v[1] > u[1] or (v[1] == u[1] and v[0] > u[0]) else 1

        def order(a, b):
            if half(a) != half(b):
                return half(a) - half(b)
            c = (a[0] - u[0]) * (b[1] - u[1]) - (a[1] - u[1]) * (b[0] - u[0])
            return -1 if c > 0 else 1 if c < 0 else 0

        return cmp_to_key(order)

    for u in star:
        star[u].sort(key=turn(u))
    left, rings = {(u, v) for e in edges for u, v in (e, e[::-1])}, []
    while left:
        start = arrow = min(left)
        ring = []
        while True:
            ring.append(arrow)
            left.discard(arrow)
            u, v = arrow
            arrow = (v, star[v][star[v].index(u) - 1])
            if arrow == start:
                break
        rings.append(ring)
    return rings


def inside(p, ring):
    flips = False
    for (ax, ay), (bx, by) in ring:
        if (ay > p[1]) != (by > p[1]) and p[0] < ax + (p[1] - ay) * (bx - ax) / (by - ay):
            flips = not flips
    return flips


def box(w, s, e, n):
    return [(w, s, e, s), (e, s, e, n), (e, n, w, n), (w, n, w, s)]


def linework(seed):
    pick = random.Random(seed)
    lines = [tuple(pick.randint(0, 30) for _ in range(4)) for _ in range(45)]
    lines += [(0, 0, 30, 30), (5, 5, 20, 20), (0, 15, 30, 15), (0, 15, 12, 15), (7, 7, 7, 7)]  # overlaps, a point
    lines += [(100, 0, 103, 4), (103, 4, 110, 4)] + box(101, 50, 120, 70) + [(103, 60, 118, 60)]  # a dead end; a box with a loose line in it
    lines += box(200, 0, 240, 40) + box(205, 5, 215, 15) + box(207, 7, 213, 13) + box(220, 20, 230, 30) + [(215, 10, 240, 10)]  # nested, one on a bridge
    lines += box(300, 0, 310, 10) + box(310, 10, 320, 20)  # two that touch at a corner
    return lines


@pytest.mark.parametrize("seed", [1, 2])
def test_faces_against_fractions(spark, seed):
    lines = linework(seed)
    want = brute_faces(lines)
    df = spark.createDataFrame([tuple(map(float, x)) for x in lines + lines[:5]] + [(None, 1.0, 2.0, 3.0), (float("nan"), 1.0, 2.0, 3.0)], "x1 double, y1 double, x2 double, y2 double").repartition(4)
    half = A.half_edges(A.noded(df))
    got = A.faces(half).collect()
    assert len(got) == len(want)
    assert all(abs(a - float(b)) < 1e-6 for a, b in zip(sorted(r.area for r in got), sorted(a for a, _, _ in want), strict=True))
    assert sorted(r.holes for r in got) == sorted(len(h) for _, _, h in want)
    places = [(i, x + 0.37, y + 0.21) for i, (x, y) in enumerate([(10, 10), (3, 17), (25, 8), (110, 65), (202, 2), (206, 6), (210, 10), (225, 25), (305, 5), (500, 500), (101, 2)])]
    found = {r.seed: r for r in A.seeded_domains(half, spark.createDataFrame(places, "seed int, x double, y double"), "seed", "x", "y").collect()}
    for i, x, y in places:
        p = (Q(x), Q(y))
        around = [(a, len(h)) for a, r, h in want if inside(p, r) and not any(inside(p, [(v, u) for u, v in hole]) for hole in h)]
        if around:
            area, holes = min(around)
            assert abs(found[i].area - float(area)) < 1e-6 and found[i].holes == holes
        else:
            assert i not in found


def test_outline_and_small_holes(spark):
    lines = box(0, 0, 10, 10) + box(2, 2, 3, 3) + box(5, 5, 8, 8) + [(0, 5, -5, 5)]
    df = spark.createDataFrame([tuple(map(float, x)) for x in lines], "x1 double, y1 double, x2 double, y2 double")
    half = A.half_edges(A.noded(df))
    seed = spark.createDataFrame([(1, 1.0, 1.0)], "seed int, x double, y double")
    whole = A.seeded_domains(half, seed, "seed", "x", "y").first()
    assert (whole.area, whole.perimeter, whole.holes) == (90.0, 56.0, 2)
    assert A.seeded_domains(half, seed, "seed", "x", "y", least_hole=4.0).first().area == 91.0
    ring = A.outlines(half, spark.createDataFrame([(whole.face,)], A.seeded_domains(half, seed, "seed", "x", "y").select(A.F.col("face").alias("ring")).schema)).collect()
    assert [tuple(r.node) for r in sorted(ring, key=lambda r: r.position)] == [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 5.0)] or len(ring) == 5
    assert A.faces(A.half_edges(A.noded(df.limit(0)))).count() == 0


def test_query_against_fractions(spark):
    from brackish.plans.meshes import linework as lines_of
    from brackish.plans.meshes import seeds, wet_domains

    folder = "/root/testdata/sf0.001"
    want = brute_faces([tuple(r) for r in lines_of(spark, folder).collect()])
    got = {r.seed: r for r in wet_domains(spark, folder).collect()}
    for r in seeds(spark, folder).collect():
        p = (Q(r.x), Q(r.y))
        around = []
        for a, ring, holes in want:
            if inside(p, ring) and not any(inside(p, [(v, u) for u, v in hole]) for hole in holes):
                small = [h for h in holes if sum(v[0] * u[1] - v[1] * u[0] for u, v in h) / 2 < 1]
                around.append((a + sum(sum(v[0] * u[1] - v[1] * u[0] for u, v in h) / 2 for h in small), len(holes) - len(small)))
        assert (r.seed in got) == bool(around)
        if around:
            assert abs(got[r.seed].area - float(min(around)[0])) < 1e-3 and got[r.seed].holes == min(around)[1]
    assert got
