"""Joins, graphs and grids against brute force."""

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from brackish.operators import flownet, graph, grids, joins, mesh, nearest


@pytest.mark.parametrize("k", [1, 4])
def test_k_nearest_with_a_dense_cluster(spark, k):
    rng = np.random.default_rng(2)
    s = np.vstack([rng.normal(0, 0.001, (300, 2)), rng.uniform(-50, 50, (150, 2)), np.repeat([[7.0, 7.0]], 40, axis=0)])
    p = np.vstack([rng.uniform(-60, 60, (80, 2)), rng.normal(0, 0.01, (30, 2)), [[7.0, 7.0]]])
    src = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(s)], "sid long, x double, y double")
    pts = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(p)], "pid long, x double, y double")
    rows = nearest.k_nearest(pts, src, "pid", "sid", k=k, leaf_rows=6).collect()
    got = {}
    for r in rows:
        got.setdefault(r.pid, {})[r["rank"]] = (r.sid, r.distance)
    assert len(rows) == k * len(p)
    for i, q in enumerate(p):
        d = np.hypot(*(s - q).T)
        order = np.lexsort((np.arange(len(s)), d))[:k]
        assert [got[i][n + 1][0] for n in range(k)] == list(order)
        np.testing.assert_allclose([got[i][n + 1][1] for n in range(k)], d[order])


def test_k_nearest_with_few_sources(spark):
    src = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 0.0)], "sid long, x double, y double")
    pts = spark.createDataFrame([(1, 4.0, 0.0)], "pid long, x double, y double")
    assert [(r.sid, r.distance) for r in nearest.k_nearest(pts, src, "pid", "sid", k=4).orderBy("rank").collect()] == [(2, 1.0), (1, 4.0)]


def test_idw_exact_hit_and_missing(spark):
    n = spark.createDataFrame([(1, 10, 0.0, 1), (1, 11, 2.0, 2), (2, 10, 1.0, 1), (2, 11, 2.0, 2), (2, 12, 2.0, 3)], "pid long, sid long, distance double, rank int")
    v = spark.createDataFrame([(10, 5.0), (11, 9.0), (12, None)], "sid long, v double")
    got = {r.pid: r.v for r in nearest.inverse_distance(n, v, "pid", "sid", "v").collect()}
    assert got[1] == 5.0 and abs(got[2] - (5.0 + 9.0 / 4) / 1.25) < 1e-12
    with pytest.raises(Exception, match="beyond the limit"):
        nearest.refuse_far(n, 0.5).collect()


def test_points_in_boxes(spark):
    rng = np.random.default_rng(4)
    p = rng.uniform(-20, 20, (300, 2))
    w = rng.uniform(-20, 18, (60, 2))
    side = 10 ** rng.uniform(-3, 1.3, (60, 2))
    side[0] = 0
    w[0] = p[0]
    pts = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(p)], "id long, x double, y double")
    boxes = spark.createDataFrame([(i, float(a), float(b), float(a + c), float(b + d)) for i, ((a, b), (c, d)) in enumerate(zip(w, side))], "box long, w double, s double, e double, n double")
    want = {(i, j) for i, (x, y) in enumerate(p) for j, ((a, b), (c, d)) in enumerate(zip(w, side)) if a <= x <= a + c and b <= y <= b + d}
    got = joins.points_in_boxes(pts, boxes, "x", "y", "w", "s", "e", "n").select("id", "box").collect()
    assert len(got) == len(want) and {(r.id, r.box) for r in got} == want
    semi = joins.points_in_boxes(pts, boxes, "x", "y", "w", "s", "e", "n", how="left_semi").select("id").collect()
    assert sorted(r.id for r in semi) == sorted({i for i, _ in want})


@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_overlapping_intervals(spark, scale):
    rng = np.random.default_rng(6)
    def make(n):
        s = np.round(rng.uniform(-1, 1, n) * 1000 * scale)
        return s, s + np.ceil(10 ** rng.uniform(0, 3, n) * scale)
    (a0, a1), (b0, b1) = make(120), make(90)
    b0[:3], b1[:3] = a1[:3], a1[:3] + 5  # touching is not overlapping
    a = spark.createDataFrame([(i, int(x), int(y)) for i, (x, y) in enumerate(zip(a0, a1))], "a long, s long, e long")
    b = spark.createDataFrame([(i, int(x), int(y)) for i, (x, y) in enumerate(zip(b0, b1))], "b long, s2 long, e2 long")
    got = [(r.a, r.b) for r in joins.overlapping_intervals(a, b, ("s", "e"), ("s2", "e2")).select("a", "b").collect()]
    want = {(i, j) for i in range(120) for j in range(90) if a0[i] < b1[j] and a1[i] > b0[j]}
    assert len(got) == len(set(got)) and set(got) == want


def test_priority_overlay_ignores_input_order(spark):
    t = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    rows = [(1, None, 1, "a"), (1, 5.0, 2, "b"), (1, 6.0, 3, "c"), (2, 1.0, 2, "b"), (2, 9.0, 1, "a")]
    for order in (rows, rows[::-1]):
        c = spark.createDataFrame(order, "id long, v double, p int, src string")
        got = {r.id: (r.v, r.src, r.coverage_status) for r in joins.priority_overlay(t, c, "id", "v", ["p"], ["src"]).collect()}
        assert got == {1: (5.0, "b", "ok"), 2: (9.0, "a", "ok"), 3: (None, None, "no_source_coverage")}


def _union_find(edges):
    parent = {}
    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_hub_chain_and_noise(spark):
    rng = np.random.default_rng(8)
    chain = rng.permutation(np.arange(1000, 1200))
    edges = [(0, i) for i in range(1, 150)] + list(zip(chain[:-1].tolist(), chain[1:].tolist())) + [tuple(map(int, rng.integers(2000, 2300, 2))) for _ in range(150)]
    df = spark.createDataFrame([(int(a), int(b)) for a, b in edges], "a long, b long")
    assert {r.node: r.component for r in graph.components(df, "a", "b").collect()} == _union_find([(int(a), int(b)) for a, b in edges])


def test_hop_distance(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 1), (4, 5), (8, 9)]
    n = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 8, 9)], "node long")
    e = spark.createDataFrame(edges, "a long, b long")
    d = graph.hop_distance(n, e, n.where("node = 1"), "node", "a", "b")
    assert {r.node: r.distance for r in d.collect()} == {1: 0, 2: 1, 3: 2, 4: 1, 5: 2, 8: 2147483647, 9: 2147483647}


def test_path_order_and_cycles(spark):
    arcs = [(1, 3), (2, 3), (3, 6), (4, 5), (5, 6), (6, None), (10, 11), (11, 12), (12, 10), (13, 12)]
    df = spark.createDataFrame(arcs, "arc long, down long")
    got = {r.arc: r.path_order for r in graph.path_order(df, "arc", "down").collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 1, 5: 2, 6: 3, 10: -1, 11: -1, 12: -1, 13: 1}


def test_ring_order_of_a_square(spark):
    tris = spark.createDataFrame([(0, 0, 1, 4), (1, 1, 2, 4), (2, 2, 3, 4), (3, 3, 0, 4), (4, 10, 11, 12)], "tri long, n1 long, n2 long, n3 long")
    got = [(r.ring, r.position, r.node) for r in mesh.boundary_rings(tris).orderBy("ring", "position").collect()]
    assert got == [(0, 0, 0), (0, 1, 1), (0, 2, 2), (0, 3, 3), (10, 0, 10), (10, 1, 11), (10, 2, 12)]
    assert {r.tri: r.component for r in mesh.triangle_components(tris, mesh.edges(tris)).collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4}


def _dijkstra(cells, start, dx, dy, weight):
    steps = [(0, 1, dx), (0, -1, dx), (1, 0, dy), (-1, 0, dy)] + [(a, b, float(np.hypot(dx, dy))) for a in (-1, 1) for b in (-1, 1)]
    best, heap = {}, [(v, c) for c, v in start.items()]
    heapq.heapify(heap)
    while heap:
        v, c = heapq.heappop(heap)
        if c in best:
            continue
        best[c] = v
        for dj, di, d in steps:
            n = (c[0] + dj, c[1] + di)
            if n in cells and n not in best:
                heapq.heappush(heap, (v + weight * d, n))
    return best


@pytest.mark.parametrize("block", [3, 8, 64])
def test_relaxation_over_blocks(spark, block):
    rng = np.random.default_rng(9)
    cells = {(j, i): float(rng.uniform(10, 1000)) for j in range(17) for i in range(13) if rng.random() > 0.25}
    df = spark.createDataFrame([(j, i, v) for (j, i), v in cells.items()], "j long, i long, size double")
    got = {(r.j, r.i): r.size for r in grids.limit_gradation(df, "size", 0.5, 30.0, 40.0, block=block).collect()}
    want = _dijkstra(cells, cells, 30.0, 40.0, 0.5)
    assert got.keys() == want.keys()
    np.testing.assert_allclose([got[c] for c in sorted(got)], [want[c] for c in sorted(got)])
    sources = {c: 0.0 for c in cells if c[0] == 0}
    wet = df.withColumn("wet", F.lit(True))
    dist = {(r.j, r.i): (r.distance, r.source) for r in grids.wet_distance(wet, F.col("wet"), F.col("j") == 0, 30.0, 40.0, 13, block=block).collect()}
    far = _dijkstra(cells, sources, 30.0, 40.0, 1.0)
    for c, (d, s) in dist.items():
        assert (d is None and c not in far) or abs(d - far[c]) < 1e-6
        assert (s is None) == (d is None) and (s is None or (0, s) in cells)


def test_gradation_small_case(spark):
    df = spark.createDataFrame([(j, i, 100.0 if (j, i) == (1, 1) else 1000.0) for j in range(3) for i in range(3)], "j long, i long, size double")
    out = grids.limit_gradation(df, "size", 0.10, 1000.0, 1000.0)
    assert out.agg(F.max("size")).first()[0] <= 1000.0
    assert grids.neighbour_gradation(out, "size", 1000.0, 1000.0).first().max_gradation <= 0.1 + 1e-9


def test_masked_bilinear_barrier(spark):
    grid = spark.createDataFrame([(j, i, [100.0, 500.0, 1000.0][i], i != 1) for j in range(2) for i in range(3)], "j long, i long, v double, on boolean")
    pts = spark.createDataFrame([(k, x, 0.5) for k, x in enumerate([0.5, 1.5, 1.0, 0.0, 2.0])], "id long, x double, y double")
    out = grids.bilinear(pts, grid, "id", ("x", "y"), (0.0, 0.0), (1.0, 1.0), (3, 2), ["v"], active="on").orderBy("id").collect()
    assert [r.supported for r in out] == [True, True, False, True, True]
    assert [out[i].v for i in (0, 1, 3, 4)] == [100.0, 1000.0, 100.0, 1000.0] and out[2].v is None


def test_quadtree_stops_at_targets(spark):
    one = spark.createDataFrame([(0.0, 0.0, 8.0)], "x double, y double, width double")
    leaves = grids.refine_cells(one, F.when((F.col("x") < 0) & (F.col("y") < 0), 1.0).otherwise(4.0)).collect()
    assert abs(sum(r.width**2 for r in leaves) - 64.0) < 1e-9
    assert {r.width for r in leaves if r.x < 0 and r.y < 0} == {1.0} and {r.width for r in leaves if r.x > 0} == {4.0}


FLOW = [((0, 2), (1, 1), 1, 2), ((0, 0), (1, 1), 1, 2), ((1, 1), (2, 1), 2, 3), ((2, 2), (2, 1), 1, 3), ((2, 1), (3, 0), 3, 4)]


def _flow(spark, rows):
    data = [(k, *map(float, a), *map(float, b), float(s), float(e), None, None, float(np.hypot(a[0] - b[0], a[1] - b[1]))) for k, (a, b, s, e) in enumerate(rows)]
    lines = spark.createDataFrame(data, "line long, x1 double, y1 double, x2 double, y2 double, acc1 double, acc2 double, elev1 double, elev2 double, length double")
    arcs = flownet.ordered_network(flownet.connect(flownet.oriented(lines), 100.0, 0.01))
    return arcs, {(r.x1, r.y1): (r.arcid, r.path_order, r.drainage_area_m2, r.downarc) for r in arcs.collect()}


def test_flow_order(spark):
    arcs, got = _flow(spark, FLOW)
    check = flownet.network_checks(arcs).first()
    assert (check.arcs, check.headwaters, check.terminals, check.order_errors) == (5, 3, 1, 0)
    outlet = got[(2.0, 1.0)]
    assert outlet[1] == 3 and outlet[2] == 400.0 and outlet[3] == -1
    turned = [(b, a, e, s) for a, b, s, e in reversed(FLOW)]
    assert _flow(spark, turned)[1] == got
    assert flownet.network_lines(arcs).first().line[:9].split()[0] == str(flownet.network_lines(arcs).first().arcid)


def test_points_in_rings_with_a_hole_in_the_shape(spark):
    star = [(0, 0), (10, 0), (10, 10), (5, 2), (0, 10)]
    rings = {1: star, 2: [(20, 0), (24, 0), (24, 4), (20, 4)]}
    edges = [(r, *map(float, a), *map(float, b)) for r, pts in rings.items() for a, b in zip(pts, pts[1:] + pts[:1])]
    df = spark.createDataFrame(edges, "ring long, x1 double, y1 double, x2 double, y2 double")
    pts = {1: (5, 1), 2: (5, 5), 3: (1, 5), 4: (0, 0), 5: (5, 2), 6: (22, 4), 7: (22, 4.1), 8: (10, 5), 9: (5, 0), 10: (12, 3)}
    p = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in pts.items()], "id long, x double, y double")
    got = sorted((r.id, r.ring) for r in joins.points_in_rings(p, df, "id", "x", "y", "ring").collect())
    assert got == [(1, 1), (3, 1), (4, 1), (5, 1), (6, 2), (8, 1), (9, 1)]


def test_nearest_beside_a_fill_value(spark):
    """One source at 1e30 leaves the others in cells of their own."""
    rng = np.random.default_rng(8)
    xy = rng.random((2000, 2))
    src = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)] + [(9999, 1e30, 1e30)], "s long, x double, y double")
    want = rng.random((300, 2))
    pts = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(want)], "p long, x double, y double")
    found = nearest.k_nearest(pts, src, "p", "s")
    brute = np.argmin(((want[:, None] - xy[None]) ** 2).sum(axis=2), axis=1)
    assert {r.p: r.s for r in found.collect()} == dict(enumerate(brute.tolist()))


def test_equal_points_and_far_coordinates_in_boxes(spark):
    pts = spark.createDataFrame([(9.0e6, 1.0), (9.0e6, 1.0), (9.5e6, 1.0), (1e300, 1.0)], "x double, y double")
    box = spark.createDataFrame([(9.0e6, 1.0, 9.0e6, 1.0)], "w double, s double, e double, n double")
    args = ("x", "y", "w", "s", "e", "n")
    assert joins.points_in_boxes(pts, box, *args, how="left_semi").count() == 2
    assert joins.points_in_boxes(pts, box, *args).count() == 2


def test_rings_that_meet_at_a_node(spark):
    """Two triangles that share one corner have two rings of three, not one of six."""
    two = spark.createDataFrame([(1, 1, 2, 3), (2, 1, 4, 5)], "tri long, n1 long, n2 long, n3 long")
    rings = {}
    for r in mesh.boundary_rings(two).collect():
        rings.setdefault((r.ring, r.toward), {})[r.position] = r.node
    assert rings == {(1, 2): {0: 1, 1: 2, 2: 3}, (1, 4): {0: 1, 1: 4, 2: 5}}


def test_rings_of_holes_that_touch(spark):
    """A 4 x 4 sheet with two diagonal cells cut out: an outer ring and two holes that share a corner."""
    node = lambda i, j: 5 * j + i
    cells = [(i, j) for i in range(4) for j in range(4) if (i, j) not in ((1, 1), (2, 2))]
    tris = [(2 * n + k, *corners) for n, (i, j) in enumerate(cells) for k, corners in enumerate(
        [(node(i, j), node(i + 1, j), node(i + 1, j + 1)), (node(i, j), node(i + 1, j + 1), node(i, j + 1))])]
    df = spark.createDataFrame(tris, "tri long, n1 long, n2 long, n3 long")
    rings = {}
    for r in mesh.boundary_rings(df).collect():
        rings.setdefault((r.ring, r.toward), []).append(r.node)
    assert sorted(map(len, rings.values())) in ([4, 4, 16], [8, 16]) and sum(map(len, rings.values())) == 24
    assert sorted(n for ring in rings.values() for n in ring).count(node(2, 2)) == 2
