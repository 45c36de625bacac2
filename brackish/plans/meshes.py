"""Queries over meshes, graphs, boundary chains and flow networks made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from brackish.operators import arrangement, flownet, graph, mesh
from brackish.operators import chains as chain_ops
from brackish.operators.metrics import ratio_summary
from brackish.operators.ordered import Run, running
from brackish.plans.registry import query
from brackish.sources.tables import table

# A lattice of nodes, fifty to a row, jittered; two triangles per node where the
# corners exist, some left out.
_NODES_SQL = "SELECT p_partkey AS node, p_partkey % 50 + (p_partkey * 37 % 11) / 40.0 AS x, p_partkey // 50 + (p_partkey * 53 % 13) / 40.0 AS y, p_retailprice AS depth FROM part"
_TRIS_SQL = """SELECT p_partkey * 2 + h AS tri, p_partkey AS n1, CASE h WHEN 0 THEN p_partkey + 1 ELSE p_partkey + 51 END AS n2, CASE h WHEN 0 THEN p_partkey + 51 ELSE p_partkey + 50 END AS n3
    FROM part, (VALUES (0), (1)) AS t(h) WHERE p_partkey % 50 < 49 AND p_partkey % 23 <> 5 AND p_partkey + 51 <= (SELECT max(p_partkey) FROM part)"""
_EDGES_SQL = f"""SELECT a, b, count(*) AS owners, min(tri) AS lt, max(tri) AS rt FROM (
    SELECT tri, least(n1, n2) AS a, greatest(n1, n2) AS b FROM ({_TRIS_SQL}) UNION ALL SELECT tri, least(n2, n3), greatest(n2, n3) FROM ({_TRIS_SQL}) UNION ALL SELECT tri, least(n1, n3), greatest(n1, n3) FROM ({_TRIS_SQL})) GROUP BY a, b"""
_GEOM_SQL = f"""SELECT tri, sa, l1, l2, l3, abs(sa) AS area, 4 * sqrt(3) * abs(sa) / (l1 * l1 + l2 * l2 + l3 * l3) AS q,
    degrees(acos((l2 * l2 + l3 * l3 - l1 * l1) / (2 * l2 * l3))) AS a1, degrees(acos((l3 * l3 + l1 * l1 - l2 * l2) / (2 * l3 * l1))) AS a2, degrees(acos((l1 * l1 + l2 * l2 - l3 * l3) / (2 * l1 * l2))) AS a3
    FROM (SELECT tri, ((p2.x - p1.x) * (p3.y - p1.y) - (p2.y - p1.y) * (p3.x - p1.x)) / 2 AS sa, sqrt(pow(p2.x - p3.x, 2) + pow(p2.y - p3.y, 2)) AS l1, sqrt(pow(p1.x - p3.x, 2) + pow(p1.y - p3.y, 2)) AS l2, sqrt(pow(p1.x - p2.x, 2) + pow(p1.y - p2.y, 2)) AS l3
      FROM ({_TRIS_SQL}) t JOIN ({_NODES_SQL}) p1 ON p1.node = n1 JOIN ({_NODES_SQL}) p2 ON p2.node = n2 JOIN ({_NODES_SQL}) p3 ON p3.node = n3)"""


def nodes(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        k.alias("node"), (k % 50 + (k * 37 % 11) / 40.0).alias("x"), (F.floor(k / 50) + (k * 53 % 13) / 40.0).alias("y"), F.col("p_retailprice").alias("depth")
    )


def triangles(spark, sf):
    k = F.col("p_partkey")
    part = table(spark, sf, "part").select("p_partkey")
    corner = part.select((k - 51).alias("p_partkey"))
    both = F.array(
        F.struct((k * 2).alias("tri"), k.alias("n1"), (k + 1).alias("n2"), (k + 51).alias("n3")),
        F.struct((k * 2 + 1).alias("tri"), k.alias("n1"), (k + 51).alias("n2"), (k + 50).alias("n3")),
    )
    # By merge: both sides are as long as the table, which is small only as a packed file.
    return part.where((k % 50 < 49) & (k % 23 != 5)).join(corner.hint("merge"), "p_partkey", "left_semi").select(F.inline(both))


def geometry(spark, sf):
    return mesh.triangle_geometry(mesh.corners(triangles(spark, sf), nodes(spark, sf)))


@query(
    "mesh_topology",
    f"SELECT count(*) AS edges, count(*) FILTER (owners = 1) AS boundary_edges, count(*) FILTER (owners > 2) AS nonmanifold_edges FROM ({_EDGES_SQL})",
)
def mesh_topology(spark, sf):
    """Edges, boundary edges and edges with too many owners."""
    return mesh.topology_summary(mesh.edges(triangles(spark, sf)))


@query("mesh_edges", f"SELECT a, b, owners, lt AS left_tri, rt AS right_tri FROM ({_EDGES_SQL})")
def mesh_edges(spark, sf):
    """Every undirected edge with its triangles."""
    return mesh.edges(triangles(spark, sf))


@query(
    "triangle_quality",
    f"SELECT tri, round(sa, 6) AS signed_area, round(q, 6) AS quality, round(a1, 5) AS angle1, round(a2, 5) AS angle2, round(a3, 5) AS angle3 FROM ({_GEOM_SQL})",
)
def triangle_quality(spark, sf):
    """Area, angles and equilateral quality of every triangle."""
    return geometry(spark, sf).select(
        "tri", F.round("signed_area", 6).alias("signed_area"), F.round("quality", 6).alias("quality"), *[F.round(c, 5).alias(c) for c in ("angle1", "angle2", "angle3")]
    )


@query(
    "mesh_metrics",
    f"""SELECT count(*) AS triangles, round(min(q), 6) AS quality_min, round(avg(q), 6) AS quality_mean, round(stddev_pop(q), 6) AS quality_std, round(quantile_cont(q, 0.05), 6) AS quality_p05, round(median(q), 6) AS quality_median,
      round(min(least(a1, a2, a3)), 5) AS min_angle, round(max(greatest(a1, a2, a3)), 5) AS max_angle, count(*) FILTER (least(a1, a2, a3) < 30) AS angle_below_30, count(*) FILTER (sa <= 0) AS not_positive, round(avg(q) - 3 * stddev_pop(q), 6) AS quality_l3_sigma FROM ({_GEOM_SQL})""",
)
def mesh_metrics(spark, sf):
    """Mesh-wide quality and angle statistics."""
    m = mesh.quality_metrics(geometry(spark, sf))
    six = ["quality_min", "quality_mean", "quality_std", "quality_p05", "quality_median", "quality_l3_sigma"]
    return m.select("triangles", *[F.round(c, 6).alias(c) for c in six], F.round("min_angle", 5).alias("min_angle"), F.round("max_angle", 5).alias("max_angle"), "angle_below_30", "not_positive")


@query(
    "area_changes",
    f"SELECT lt AS left_tri, rt AS right_tri, round(greatest(l.area, r.area) / least(l.area, r.area), 6) AS area_ratio FROM ({_EDGES_SQL}) JOIN ({_GEOM_SQL}) l ON l.tri = lt JOIN ({_GEOM_SQL}) r ON r.tri = rt WHERE owners = 2",
)
def area_changes(spark, sf):
    """Larger over smaller area of neighbouring triangles."""
    return mesh.area_changes(geometry(spark, sf), mesh.edges(triangles(spark, sf))).withColumn("area_ratio", F.round("area_ratio", 6))


@query("node_valence", f"SELECT node, count(*) AS valence FROM (SELECT a AS node FROM ({_EDGES_SQL}) UNION ALL SELECT b FROM ({_EDGES_SQL})) GROUP BY node ORDER BY valence DESC, node LIMIT 100")
def node_valence(spark, sf):
    """The hundred nodes with most neighbours."""
    return mesh.node_valence(mesh.edges(triangles(spark, sf))).orderBy(F.desc("valence"), "node").limit(100)


@query("element_to_node", f"SELECT node, round(avg(q), 6) AS quality FROM (SELECT q, unnest([n1, n2, n3]) AS node FROM ({_GEOM_SQL}) JOIN ({_TRIS_SQL}) USING (tri)) GROUP BY node")
def element_to_node(spark, sf):
    """Mean quality of the triangles around every node."""
    t = triangles(spark, sf).join(geometry(spark, sf).select("tri", "quality"), "tri")
    return mesh.node_average(t, "quality").withColumn("quality", F.round("quality", 6))


@query("thinnest_triangles", f"SELECT tri, round(q, 6) AS quality FROM ({_GEOM_SQL}) ORDER BY round(q, 6), tri LIMIT 50")
def thinnest_triangles(spark, sf):
    """The fifty poorest triangles."""
    g = geometry(spark, sf).select("tri", F.round("quality", 6).alias("quality"))
    return g.orderBy("quality", "tri").limit(50)


@query(
    "edge_ratio_strata",
    f"""SELECT stratum, count(*) AS n, count(r) AS n_finite, round(max(r), 6) AS maximum, count(*) FILTER (r > 1.0) AS above_1_0, count(*) FILTER (r > 1.4) AS above_1_4, grouping(stratum)::BIGINT AS total_level, count(*) - count(r) AS n_invalid
      FROM (SELECT CASE WHEN owners = 1 THEN 'boundary' WHEN a % 50 < 5 THEN 'transition' ELSE 'interior' END AS stratum, sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2)) / (0.8 + a % 7 / 10.0) AS r FROM ({_EDGES_SQL}) JOIN ({_NODES_SQL}) p ON p.node = a JOIN ({_NODES_SQL}) q ON q.node = b) GROUP BY ROLLUP (stratum)""",
)
def edge_ratio_strata(spark, sf):
    """Edge length over target size per stratum, with the total."""
    e, n = mesh.edges(triangles(spark, sf)), nodes(spark, sf)
    p = n.select(F.col("node").alias("a"), F.col("x").alias("xa"), F.col("y").alias("ya"))
    q = n.select(F.col("node").alias("b"), F.col("x").alias("xb"), F.col("y").alias("yb"))
    met = e.join(p, "a").join(q, "b")
    length = F.sqrt(F.pow(F.col("xa") - F.col("xb"), F.lit(2.0)) + F.pow(F.col("ya") - F.col("yb"), F.lit(2.0)))
    stratum = F.when(F.col("owners") == 1, "boundary").when(F.col("a") % 50 < 5, "transition").otherwise("interior")
    r = met.select(stratum.alias("stratum"), (length / (0.8 + F.col("a") % 7 / 10.0)).alias("r"))
    return ratio_summary(r, ["stratum"], F.col("r"), [1.0, 1.4]).withColumn("maximum", F.round("maximum", 6))


_NEAR_SQL = f"SELECT lt AS a, rt AS b FROM ({_EDGES_SQL}) WHERE owners = 2 UNION ALL SELECT rt, lt FROM ({_EDGES_SQL}) WHERE owners = 2"


@query(
    "mesh_components",
    f"""
    WITH RECURSIVE near AS MATERIALIZED ({_NEAR_SQL}),
    cc(tri, comp) USING KEY (tri) AS (SELECT tri, tri FROM ({_TRIS_SQL}) UNION
      SELECT n.b, min(cc.comp) FROM cc JOIN near n ON n.a = cc.tri JOIN recurring.cc r ON r.tri = n.b WHERE cc.comp < r.comp GROUP BY n.b)
    SELECT comp AS component, count(*) AS triangles FROM cc GROUP BY comp""",
)
def mesh_components(spark, sf):
    """Triangles per connected component."""
    t = triangles(spark, sf)
    return mesh.triangle_components(t, mesh.edges(t)).groupBy("component").agg(F.count(F.lit(1)).alias("triangles"))


@query(
    "components",
    "SELECT o_orderkey AS node, ((o_orderkey // 10) // 13) * 130 + o_orderkey % 10 AS component FROM orders WHERE (o_orderkey // 10) % 13 <> 12 AND o_orderkey + 10 <= (SELECT max(o_orderkey) FROM orders) UNION SELECT o_orderkey + 10, ((o_orderkey // 10) // 13) * 130 + o_orderkey % 10 FROM orders WHERE (o_orderkey // 10) % 13 <> 12 AND o_orderkey + 10 <= (SELECT max(o_orderkey) FROM orders)",
)
def components(spark, sf):
    """Connected components of chains of records."""
    return graph.components(links(spark, sf), "u", "v")


def links(spark, sf):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey")
    nxt = o.select((k - 10).alias("o_orderkey"))
    return o.where(F.floor(k / 10) % 13 != 12).join(nxt, "o_orderkey", "left_semi").select(k.alias("u"), (k + 10).alias("v"))


@query(
    "hop_distance",
    """
    WITH c AS (SELECT o_orderkey AS node, (o_orderkey // 10) // 13 * 10 + o_orderkey % 10 AS chain, (o_orderkey // 10) % 13 AS place FROM orders)
    SELECT node, CASE WHEN EXISTS (SELECT 1 FROM c d WHERE d.chain = c.chain AND d.place = 6) THEN abs(place - 6)::INTEGER ELSE 2147483647 END AS distance FROM c""",
)
def hop_distance(spark, sf):
    """Hops from the nearest seed; unreachable nodes carry the largest integer."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("node"))
    seeds = o.where(F.floor(F.col("node") / 10) % 13 == 6)
    return graph.hop_distance(o, links(spark, sf), seeds, "node", "u", "v")


@query(
    "path_order",
    """
    WITH RECURSIVE up(k, anc, d) AS (SELECT o_orderkey, o_orderkey, 0 FROM orders UNION ALL SELECT k, anc // 3, d + 1 FROM up WHERE anc > 0)
    SELECT anc AS o_orderkey, (max(d) + 1)::BIGINT AS path_order FROM up GROUP BY anc""",
)
def path_order(spark, sf):
    """Longest upstream path of every arc of a tree."""
    k = F.col("o_orderkey")
    arcs = table(spark, sf, "orders").select(k, F.when(k > 0, F.floor(k / 3)).alias("down"))
    return graph.path_order(arcs, "o_orderkey", "down")


@query(
    "boundary_rings",
    f"""
    WITH RECURSIVE o AS MATERIALIZED (SELECT p, q FROM (SELECT n1 AS p, n2 AS q FROM ({_TRIS_SQL}) UNION ALL SELECT n2, n3 FROM ({_TRIS_SQL}) UNION ALL SELECT n3, n1 FROM ({_TRIS_SQL})) JOIN ({_EDGES_SQL}) ON a = least(p, q) AND b = greatest(p, q) WHERE owners = 1),
    cc(node, ring) USING KEY (node) AS (SELECT p, p FROM o UNION SELECT o.q, min(cc.ring) FROM cc JOIN o ON o.p = cc.node JOIN recurring.cc r ON r.node = o.q WHERE cc.ring < r.ring GROUP BY o.q),
    w(ring, position, node) AS (SELECT node, 0::BIGINT, node FROM cc WHERE node = ring UNION ALL SELECT w.ring, position + 1, o.q FROM w JOIN o ON o.p = w.node WHERE o.q <> w.ring)
    SELECT ring, position, node FROM w""",
)
def boundary_rings(spark, sf):
    """Ordered boundary rings of the mesh."""
    return mesh.boundary_rings(triangles(spark, sf)).select("ring", "position", "node")


@query(
    "thin_clusters",
    f"""
    WITH RECURSIVE bad AS MATERIALIZED (SELECT tri, unnest([n1, n2, n3]) AS node FROM ({_TRIS_SQL}) JOIN ({_GEOM_SQL}) USING (tri) WHERE q < 0.8 OR least(a1, a2, a3) < 5),
    near AS MATERIALIZED (SELECT DISTINCT x.tri AS a, y.tri AS b FROM bad x JOIN bad y USING (node) WHERE x.tri <> y.tri),
    cc(tri, comp) USING KEY (tri) AS (SELECT DISTINCT tri, tri FROM bad UNION
      SELECT n.b, min(cc.comp) FROM cc JOIN near n ON n.a = cc.tri JOIN recurring.cc r ON r.tri = n.b WHERE cc.comp < r.comp GROUP BY n.b)
    SELECT comp AS component, count(*) AS members, min(tri) AS first_tri, max(tri) AS last_tri FROM cc GROUP BY comp""",
)
def thin_clusters(spark, sf):
    """Poor triangles grouped by shared nodes."""
    return mesh.thin_clusters(geometry(spark, sf), triangles(spark, sf), quality=0.8)


@query(
    "triangle_distance",
    f"""
    WITH RECURSIVE near AS MATERIALIZED ({_NEAR_SQL}), e AS ({_EDGES_SQL}),
    d(tri, d) USING KEY (tri) AS (SELECT DISTINCT tri, 0 FROM (SELECT unnest([lt, rt]) AS tri FROM e WHERE (a // 50) % 8 = 0 AND b - a = 1) UNION
      SELECT n.b, min(d.d) + 1 FROM d JOIN near n ON n.a = d.tri LEFT JOIN recurring.d r ON r.tri = n.b WHERE r.tri IS NULL OR d.d + 1 < r.d GROUP BY n.b)
    SELECT coalesce(d, 2147483647)::INTEGER AS distance, count(*) AS triangles FROM ({_TRIS_SQL}) LEFT JOIN d USING (tri) GROUP BY 1""",
)
def triangle_distance(spark, sf):
    """Hops over triangles from the edges of every eighth mesh row."""
    t = triangles(spark, sf)
    e = mesh.edges(t)
    rows = e.where((F.floor(F.col("a") / 50) % 8 == 0) & (F.col("b") - F.col("a") == 1)).select("a", "b")
    d = mesh.triangle_distance(t, e, rows)
    return d.groupBy("distance").agg(F.count(F.lit(1)).alias("triangles"))


_CHAIN_SQL = "SELECT c_nationkey::BIGINT AS chain, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS pos, c_custkey AS node, c_custkey % 40 * 3.0 AS x, c_custkey // 40 * 2.5 AS y, 2.0::DOUBLE + c_custkey % 9 AS target, CASE WHEN c_custkey % 8 < 4 THEN 'land' ELSE 'open' END AS kind FROM customer"
_PAIR_SQL = f"""SELECT *, coalesce(lead(node) OVER w, first_value(node) OVER w) AS nnode, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny, coalesce(lead(target) OVER w, first_value(target) OVER w) AS nt, coalesce(lead(kind) OVER w, first_value(kind) OVER w) AS nk
    FROM ({_CHAIN_SQL}) WINDOW w AS (PARTITION BY chain ORDER BY pos)"""


def chains(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("long").alias("chain"), F.col("c_custkey").alias("node"))
    return running(c, ["chain"], ["node"], {"pos": Run("row_index")})


def chain_nodes(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("node"), (k % 40 * 3.0).alias("x"), (F.floor(k / 40) * 2.5).alias("y"), (k % 9 + 2.0).alias("target"), F.when(k % 8 < 4, "land").otherwise("open").alias("kind")
    )


@query(
    "boundary_contract",
    f"""
    WITH e AS (SELECT *, sqrt(pow(x - nx, 2) + pow(y - ny, 2)) AS len, greatest(target, nt) / least(target, nt) AS ratio FROM ({_PAIR_SQL})),
    m AS (SELECT chain, count(*) AS edges, round(max(len / (2 / (1 / target + 1 / nt))), 6) AS max_length_ratio, round(max(abs(target - nt) / len), 6) AS max_gradient, round(coalesce(max(ratio) FILTER (kind <> nk), 1.0), 6) AS max_kind_change_ratio FROM e GROUP BY chain)
    SELECT *, array_to_string(list_filter([CASE WHEN max_length_ratio > 1.55 THEN 'boundary_edge_target_ratio_exceeded' END, CASE WHEN max_gradient > 0.15 THEN 'boundary_spacing_gradation_exceeded' END, CASE WHEN max_kind_change_ratio > 1.5 THEN 'open_land_junction_spacing_jump' END], lambda x: x IS NOT NULL), ',') AS failures FROM m""",
)
def boundary_contract(spark, sf):
    """Spacing audit of closed boundary chains."""
    c = mesh.boundary_contract(mesh.chain_edges(chains(spark, sf), "chain", "pos", "node"), chain_nodes(spark, sf))
    return c.select("chain", "edges", *[F.round(n, 6).alias(n) for n in ("max_length_ratio", "max_gradient", "max_kind_change_ratio")], "failures")


@query(
    "sponge_radius",
    f"""SELECT chain, count(*) AS edges, round(min(len), 6) AS shortest, round(median(len), 6) AS radius, round(max(len), 6) AS longest FROM (SELECT chain, sqrt(pow(x - lead(x) OVER w, 2) + pow(y - lead(y) OVER w, 2)) AS len FROM ({_CHAIN_SQL}) WINDOW w AS (PARTITION BY chain ORDER BY pos)) WHERE len IS NOT NULL GROUP BY chain""",
)
def sponge_radius(spark, sf):
    """Edge lengths along each open string; the median is the radius."""
    s = mesh.sponge(mesh.chain_edges(chains(spark, sf), "chain", "pos", "node", closed=False), chain_nodes(spark, sf))
    return s.select("chain", "edges", *[F.round(c, 6).alias(c) for c in ("shortest", "radius", "longest")])


@query(
    "constraint_integrity",
    f"""
    WITH p AS (SELECT chain, node, least(node, nnode) AS a, greatest(node, nnode) AS b FROM (SELECT p_partkey // 50 AS chain, p_partkey AS node, p_partkey + 1 AS nnode FROM part WHERE p_partkey % 50 < 49 AND p_partkey < (SELECT max(p_partkey) FROM part)))
    SELECT chain, count(*) FILTER (owners IS NULL) AS missing_edges, count(*) FILTER (owners IS DISTINCT FROM 1) AS missing_pairs FROM p LEFT JOIN ({_EDGES_SQL}) e USING (a, b) GROUP BY chain""",
)
def constraint_integrity(spark, sf):
    """Protected row edges the mesh lacks, and those that are not boundary edges."""
    k = F.col("p_partkey")
    c = table(spark, sf, "part").select(F.floor(k / 50).alias("chain"), (k % 50).alias("pos"), k.alias("node"))
    pairs = mesh.chain_edges(c, "chain", "pos", "node", closed=False)
    e = mesh.edges(triangles(spark, sf))
    gone = mesh.missing_constraints(pairs, e).withColumn("gone", F.lit(1))
    report = mesh.chain_report(c, pairs, e)
    missing = pairs.join(gone, ["a", "b"], "left").groupBy("chain").agg(F.count("gone").alias("missing_edges"))
    return missing.join(report, "chain").select("chain", "missing_edges", "missing_pairs")


@query("restricted_edges", f"SELECT a, b FROM ({_EDGES_SQL}) e WHERE EXISTS (SELECT 1 FROM (SELECT p_partkey AS f, p_partkey + p_size AS g FROM part) r WHERE r.f = e.a AND r.g = e.b)")
def restricted_edges(spark, sf):
    """Mesh edges found in a forbidden set."""
    k = F.col("p_partkey")
    forbidden = table(spark, sf, "part").select(k.alias("a"), (k + F.col("p_size")).alias("b"))
    return mesh.edges(triangles(spark, sf)).join(forbidden, ["a", "b"], "left_semi").select("a", "b")


@query("shared_chain_nodes", "SELECT l_partkey AS node FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1")
def shared_chain_nodes(spark, sf):
    """Nodes that belong to more than one chain."""
    c = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("chain"), F.col("l_partkey").alias("node"))
    return mesh.shared_chain_nodes(c)


@query(
    "ring_areas",
    f"SELECT chain, round(abs(sum(x * ny - nx * y)) / 2, 4) AS area FROM ({_PAIR_SQL}) GROUP BY chain",
)
def ring_areas(spark, sf):
    """Shoelace area of every closed chain."""
    c = chains(spark, sf).join(chain_nodes(spark, sf), "node")
    return mesh.ring_area(c, "chain", "pos", "x", "y").withColumn("area", F.round("area", 4))


@query(
    "mesh_extent",
    f"SELECT round(min(x) - 0.02 * (max(x) - min(x)), 6) AS west, round(max(x) + 0.02 * (max(x) - min(x)), 6) AS east, round(min(y) - 0.02 * (max(y) - min(y)), 6) AS south, round(max(y) + 0.02 * (max(y) - min(y)), 6) AS north FROM ({_NODES_SQL})",
)
def mesh_extent(spark, sf):
    """Padded bounding box."""
    return mesh.extent(nodes(spark, sf)).select(*[F.round(c, 6).alias(c) for c in ("west", "east", "south", "north")])


@query(
    "flow_network",
    """
    WITH RECURSIVE up(k, anc, d) AS (SELECT o_orderkey, o_orderkey, 0 FROM orders WHERE o_orderkey > 0 UNION ALL SELECT k, anc // 3, d + 1 FROM up WHERE anc // 3 > 0)
    SELECT anc AS line, (max(d) + 1)::BIGINT AS path_order, anc % 2 = 1 AS reversed, anc // 3 = 0 AS terminal, anc * 3 > (SELECT max(o_orderkey) FROM orders) AS headwater FROM up GROUP BY anc""",
)
def flow_network(spark, sf):
    """Lines turned downstream, connected at their ends and ordered from the headwaters."""
    arcs = flownet.ordered_network(flownet.connect(flownet.oriented(stream_lines(spark, sf)), 100.0, 1.0))
    return arcs.select("line", "path_order", "reversed", (F.col("downarc") == -1).alias("terminal"), (F.col("uparc") == -1).alias("headwater"))


def stream_lines(spark, sf):
    """A line from every record to its third; odd ones are drawn upstream."""
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").where("o_orderkey > 0").select(k.alias("line"), F.floor(k / 3).alias("to"))
    px, py = lambda c: (c % 1000) * 100.0, lambda c: F.floor(c / 1000) * 100.0
    odd = F.col("line") % 2 == 1
    turn = lambda f: (F.when(odd, f(F.col("to"))).otherwise(f(F.col("line"))), F.when(odd, f(F.col("line"))).otherwise(f(F.col("to"))))
    (x1, x2), (y1, y2) = turn(px), turn(py)
    a1, a2 = turn(lambda c: 1e6 - c)
    e1, e2 = turn(lambda c: c / 10.0)
    length = F.sqrt(F.pow(px(F.col("line")) - px(F.col("to")), F.lit(2.0)) + F.pow(py(F.col("line")) - py(F.col("to")), F.lit(2.0)))
    return o.select("line", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), a1.alias("acc1"), a2.alias("acc2"), e1.alias("elev1"), e2.alias("elev2"), length.alias("length"))


@query(
    "network_checks",
    """SELECT count(*) AS arcs, count(*) FILTER (o_orderkey * 3 > (SELECT max(o_orderkey) FROM orders)) AS headwaters, count(*) FILTER (o_orderkey < 3) AS terminals, 0::BIGINT AS invalid_references, 0::BIGINT AS unordered, 0::BIGINT AS order_errors FROM orders WHERE o_orderkey > 0""",
)
def network_checks(spark, sf):
    """Soundness of the network: references, order, ends."""
    return flownet.network_checks(flownet.ordered_network(flownet.connect(flownet.oriented(stream_lines(spark, sf)), 100.0, 1.0)))


def linework(spark, sf):
    """Borders of a box per supplier, and a line from each to the next one's corner."""
    s = table(spark, sf, "supplier").select("s_suppkey", (F.col("s_suppkey") * 37 % 360 - 180.0).alias("x"), (F.col("s_suppkey") * 53 % 160 - 80.0).alias("y"), (F.col("s_nationkey") * 5 + 20.0).alias("w"), (F.col("s_suppkey") % 7 * 4 + 15.0).alias("h"))
    x, y, e, n = F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h")
    far_x, far_y = (F.col("s_suppkey") + 1) * 37 % 360 - 180.0, (F.col("s_suppkey") + 1) * 53 % 160 - 80.0
    line = lambda a, b, c, d: F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2"))
    return s.select(F.inline(F.array(line(x, y, e, y), line(e, y, e, n), line(e, n, x, n), line(x, n, x, y), line(x, y, far_x, far_y))))


def seeds(spark, sf):
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("seed"), (F.col("n_nationkey") * 41 % 340 - 169.63).alias("x"), (F.col("n_nationkey") * 29 % 150 - 74.21).alias("y"))


@query("wet_domains")  # faces of crossing lines are more than SQL can walk: tested against exact arithmetic
def wet_domains(spark, sf):
    """The face of the linework around each seed point, holes cut out."""
    half = arrangement.half_edges(arrangement.noded(linework(spark, sf)))
    found = arrangement.seeded_domains(half, seeds(spark, sf), "seed", "x", "y", least_hole=1.0)
    return found.select("seed", F.round("area", 4).alias("area"), F.round("perimeter", 4).alias("perimeter"), "holes")


def lattice_lines(spark, sf):
    """Rows of a jittered lattice as lines of short segments, and a short segment per supplier among them."""
    p = F.col("p_partkey")
    x, y = (p % 50 + (p * 37 % 11) / 40.0).cast("double"), (F.floor(p / 50) + (p * 53 % 13) / 40.0).cast("double")
    nodes = table(spark, sf, "part").select(p.alias("node"), F.floor(p / 50).alias("row"), x.alias("x"), y.alias("y"))
    step = running(nodes, ["row"], ["node"], {"px": Run("lag", F.col("x")), "py": Run("lag", F.col("y"))})
    lines = step.where("px is not null").select("row", "node", F.col("px").alias("x1"), F.col("py").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    s = F.col("s_suppkey")
    sx, sy = (s * 37 % 50 + 0.3).cast("double"), (s * 29 % 40 + 0.2).cast("double")
    others = table(spark, sf, "supplier").select(sx.alias("x1"), sy.alias("y1"), (sx + s % 5 - 2).alias("x2"), (sy + s % 3 - 1).alias("y2"))
    return lines, others


@query("line_difference")  # tested against distances at many places of every segment
def line_difference(spark, sf):
    """What of the lines lies farther than 0.6 from every other segment, without slivers."""
    lines, others = lattice_lines(spark, sf)
    left = chain_ops.away_from(lines, others, "row", "node", 0.6, least=0.25)
    return left.select("row", "piece", "node", *[F.round(c, 6).alias(c) for c in ("from", "to", "x1", "y1", "x2", "y2", "piece_length")])


_RESPACED_SQL = f"""
    WITH p AS (SELECT node, node // 50 AS row, x::DOUBLE AS x, y::DOUBLE AS y, (0.2 + node % 7 * 0.15)::DOUBLE AS h FROM ({_NODES_SQL})),
    s AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(h) OVER w AS ph FROM p WINDOW w AS (PARTITION BY row ORDER BY node)),
    c AS (SELECT *, sqrt(pow(x - px, 2) + pow(y - py, 2)) AS d, sqrt(pow(x - px, 2) + pow(y - py, 2)) * (1 / ph + 1 / h) / 2 AS c FROM s),
    n AS (SELECT *, coalesce(sum(c) OVER w, 0) AS n, coalesce(sum(d) OVER w, 0) AS s FROM c WINDOW w AS (PARTITION BY row ORDER BY node ROWS UNBOUNDED PRECEDING)),
    t AS (SELECT row, max(n) AS total, ceil(max(n) - 1e-9) AS steps FROM n GROUP BY row),
    k AS (SELECT row, CAST(unnest(generate_series(0, steps::BIGINT)) AS BIGINT) AS k, total, steps FROM t),
    hit AS (SELECT k.row, k.k, k.total / k.steps * k.k AS goal, n.* EXCLUDE (row) FROM k ASOF JOIN (SELECT *, n - c AS before FROM n WHERE px IS NOT NULL) n ON k.row = n.row AND k.total / k.steps * k.k + 1e-12 * (k.k = 0)::INT >= n.before),
    f AS (SELECT *, 2 * (goal - before) / (1 / ph + sqrt(greatest(0, 1 / (ph * ph) + 2 * (goal - before) * (1 / h - 1 / ph) / d))) / d AS share FROM hit)
    SELECT row, k AS n, round(px + share * (x - px), 6) AS x, round(py + share * (y - py), 6) AS y, round(s - d + share * d, 6) AS along FROM f"""


@query("respaced_chain", _RESPACED_SQL)
def respaced_chain(spark, sf):
    """Each row of the lattice at a spacing that varies along it."""
    p = F.col("p_partkey")
    x, y = (p % 50 + (p * 37 % 11) / 40.0).cast("double"), (F.floor(p / 50) + (p * 53 % 13) / 40.0).cast("double")
    nodes = table(spark, sf, "part").select(F.floor(p / 50).alias("row"), p.alias("node"), x.alias("x"), y.alias("y"), (0.2 + p % 7 * 0.15).alias("h"))
    return chain_ops.respaced(nodes, ["row"], "node", "x", "y", "h").select("row", "n", *[F.round(c, 6).alias(c) for c in ("x", "y", "along")])
