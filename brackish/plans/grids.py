"""Queries over regular grids made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from brackish.operators import grids
from brackish.operators.ordered import Run, running
from brackish.plans.meshes import _CHAIN_SQL, chain_nodes, chains
from brackish.plans.registry import query
from brackish.sources.tables import table

# 120 cells to a row; one value per cell.
_CELL_SQL = "SELECT o_orderkey % 120 AS i, o_orderkey // 120 AS j, o_orderkey AS flat, o_totalprice / 100.0 AS size, o_custkey % 60 - 5.0 AS depth, o_orderkey % 11 <> 4 AS wet FROM orders"


def cells(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        (k % 120).alias("i"), F.floor(k / 120).alias("j"), k.alias("flat"), (F.col("o_totalprice") / 100.0).alias("size"), (F.col("o_custkey") % 60 - 5.0).alias("depth"), (k % 11 != 4).alias("wet")
    )


@query(
    "neighbour_gradation",
    f"""
    WITH c AS ({_CELL_SQL}) SELECT round(max(abs(a.size - b.size) / d), 6) AS max_gradation, count(*) AS pairs FROM c a, (VALUES (0, 1, 500.0::DOUBLE), (1, 0, 400.0), (1, 1, sqrt(410000.0)), (1, -1, sqrt(410000.0))) AS o(dj, di, d), c b WHERE b.j = a.j + dj AND b.i = a.i + di""",
)
def neighbour_gradation(spark, sf):
    """Steepest size change between neighbouring cells."""
    return grids.neighbour_gradation(cells(spark, sf), "size", 500.0, 400.0).withColumn("max_gradation", F.round("max_gradation", 6))


@query(
    "depth_gradient",
    f"""
    WITH c AS ({_CELL_SQL}), n AS (SELECT c.*, w.depth AS wv, e.depth AS ev, s.depth AS sv, n.depth AS nv FROM c LEFT JOIN c w ON w.j = c.j AND w.i = c.i - 1 LEFT JOIN c e ON e.j = c.j AND e.i = c.i + 1 LEFT JOIN c s ON s.j = c.j - 1 AND s.i = c.i LEFT JOIN c n ON n.j = c.j + 1 AND n.i = c.i)
    SELECT flat, round(sqrt(pow((coalesce(ev, depth) - coalesce(wv, depth)) / CASE WHEN ev IS NOT NULL AND wv IS NOT NULL THEN 1000.0 ELSE 500.0 END, 2) + pow((coalesce(nv, depth) - coalesce(sv, depth)) / CASE WHEN nv IS NOT NULL AND sv IS NOT NULL THEN 800.0 ELSE 400.0 END, 2)), 8) AS gradient FROM n""",
)
def depth_gradient(spark, sf):
    """Depth gradient: central inside, one-sided at edges."""
    return grids.depth_gradient(cells(spark, sf), "depth", 500.0, 400.0).select("flat", F.round("gradient", 8).alias("gradient"))


@query(
    "node_budget",
    f"""
    WITH a AS (SELECT size, 0.01 * pi() / 180 * 6371000.0 * greatest(cos(radians(j / 10.0)), 1e-6) * 0.02 * pi() / 180 * 6371000.0 AS area FROM ({_CELL_SQL}) WHERE wet)
    SELECT round(sum(area * 2 / (sqrt(3) * size * size)), 4) AS estimate, count(*) AS active_cells, ceil(sum(area * 2 / (sqrt(3) * size * size)))::BIGINT AS nodes FROM a WHERE size > 0""",
)
def node_budget(spark, sf):
    """Nodes a mesh of the given sizes would need."""
    g = cells(spark, sf).withColumn("lat", F.col("j") / 10.0)
    return grids.node_budget(g, "lat", "size", 0.01, 0.02, F.col("wet")).select(F.round("estimate", 4).alias("estimate"), "active_cells", "nodes")


@query(
    "cfl_report",
    f"SELECT round(min(0.5 * size / sqrt(9.807 * greatest(depth, 1.0))), 8) AS recommended_step, count(*) FILTER (0.5 * size / sqrt(9.807 * greatest(depth, 1.0)) < 30.0) AS cells_below_target FROM ({_CELL_SQL})",
)
def cfl_report(spark, sf):
    """Stable time step and the cells below a wanted one."""
    return grids.cfl_report(cells(spark, sf), "depth", "size", 0.5, 30.0).withColumn("recommended_step", F.round("recommended_step", 8))


@query(
    "cumulative_storage",
    f"""
    WITH c AS (SELECT flat, CASE WHEN wet THEN (flat % 97) * 10.0 END AS d, size FROM ({_CELL_SQL}))
    SELECT flat, CASE WHEN d IS NOT NULL THEN round(sum(size) OVER (PARTITION BY d IS NULL ORDER BY d DESC, flat DESC ROWS UNBOUNDED PRECEDING), 5) END AS storage FROM c""",
)
def cumulative_storage(spark, sf):
    """Area of everything at least as far from the mouth, farthest first."""
    g = cells(spark, sf).withColumn("d", F.when(F.col("wet"), (F.col("flat") % 97) * 10.0))
    return grids.cumulative_storage(g, "d", "flat", "size").select("flat", F.round("storage", 5).alias("storage"))


@query(
    "size_candidates",
    f"""
    WITH c AS (SELECT flat, 2500.0::DOUBLE AS b, CASE WHEN depth < 20 THEN 100.0 * greatest(depth, 1.0) END AS s, CASE WHEN wet THEN size END AS h FROM ({_CELL_SQL})),
    p AS (SELECT flat, least(b, s, h) AS size, CASE WHEN b <= coalesce(s, 1e99) AND b <= coalesce(h, 1e99) THEN 1 WHEN s <= coalesce(h, 1e99) THEN 2 ELSE 3 END AS source FROM c),
    t AS (SELECT *, (flat % 101) / 100.0 AS a FROM p)
    SELECT flat, source, round(exp((1 - (6 * pow(a, 5) - 15 * pow(a, 4) + 10 * pow(a, 3))) * ln(size) + (6 * pow(a, 5) - 15 * pow(a, 4) + 10 * pow(a, 3)) * ln(1500.0)), 4) AS blended FROM t""",
)
def size_candidates(spark, sf):
    """Smallest size candidate with its source, blended to an open-boundary target."""
    c = cells(spark, sf)
    slope = F.when(F.col("depth") < 20, F.greatest(F.col("depth"), F.lit(1.0)) * 100.0)
    size, source = grids.least_with_source([(1, F.lit(2500.0)), (2, slope), (3, F.when(F.col("wet"), F.col("size")))])
    picked = c.select("flat", size.alias("size"), source.alias("source"))
    share = (F.col("flat") % 101) / 100.0
    return picked.select("flat", "source", F.round(grids.blend_log(F.col("size"), F.lit(1500.0), share), 4).alias("blended"))


@query(
    "gradation_line",
    f"""SELECT a.chain, a.node, round(min(b.target + 0.05::DOUBLE * abs(a.pos - b.pos) * 3.0), 6) AS limited FROM ({_CHAIN_SQL}) a JOIN ({_CHAIN_SQL}) b ON a.chain = b.chain GROUP BY a.chain, a.node""",
)
def gradation_line(spark, sf):
    """Spacing limited along open chains, by two running minima."""
    c = chains(spark, sf).join(chain_nodes(spark, sf), "node").withColumn("at", F.col("pos") * 3.0)
    return grids.limit_gradation_line(c, ["chain"], "at", "target", 0.05).select("chain", "node", F.round("limited", 6).alias("limited"))


@query(
    "gradation_ring",
    f"""
    WITH c AS (SELECT *, max(pos) OVER (PARTITION BY chain) * 3.0 AS total FROM ({_CHAIN_SQL}))
    SELECT a.chain, a.node, round(min(b.target + 0.05::DOUBLE * least(abs(a.pos - b.pos) * 3.0, a.total - abs(a.pos - b.pos) * 3.0)), 6) AS limited FROM c a JOIN c b ON a.chain = b.chain GROUP BY a.chain, a.node""",
)
def gradation_ring(spark, sf):
    """Spacing limited around closed chains."""
    c = chains(spark, sf).join(chain_nodes(spark, sf), "node").withColumn("at", F.col("pos") * 3.0)
    total = c.groupBy("chain").agg((F.max("pos") * 3.0).alias("total"))
    ring = grids.limit_gradation_ring(c.join(total, "chain"), ["chain"], "at", "target", F.col("total"), 0.05)
    return ring.select("chain", "node", F.round("limited", 6).alias("limited"))


_NEAR_SQL = "(VALUES (0, 1, 500.0::DOUBLE), (0, -1, 500.0), (1, 0, 400.0), (-1, 0, 400.0), (1, 1, sqrt(410000.0)), (1, -1, sqrt(410000.0)), (-1, 1, sqrt(410000.0)), (-1, -1, sqrt(410000.0))) AS o(dj, di, d)"


@query(
    "gradation_grid",
    f"""
    WITH RECURSIVE c AS MATERIALIZED ({_CELL_SQL}),
    g(j, i, size) USING KEY (j, i) AS (SELECT j, i, size FROM c WHERE wet UNION
      SELECT r.j, r.i, min(g.size + 0.15::DOUBLE * o.d) FROM g, {_NEAR_SQL}, recurring.g r WHERE r.j = g.j + o.dj AND r.i = g.i + o.di AND g.size + 0.15::DOUBLE * o.d < r.size - 1e-9 GROUP BY r.j, r.i)
    SELECT j, i, round(size, 4) AS size FROM g""",
)
def gradation_grid(spark, sf):
    """Sizes of a grid lowered to a gradation limit along its cells."""
    g = cells(spark, sf).where("wet").select("j", "i", "size")
    return grids.limit_gradation(g, "size", 0.15, 500.0, 400.0).select("j", "i", F.round("size", 4).alias("size"))


@query(
    "wet_distance",
    f"""
    WITH RECURSIVE c AS MATERIALIZED ({_CELL_SQL}),
    g(j, i, distance) USING KEY (j, i) AS (SELECT j, i, CASE WHEN j = 0 THEN 0.0 ELSE 1e99 END::DOUBLE FROM c WHERE wet UNION
      SELECT r.j, r.i, min(g.distance + o.d) FROM g, {_NEAR_SQL}, recurring.g r WHERE g.distance < 1e98 AND r.j = g.j + o.dj AND r.i = g.i + o.di AND g.distance + o.d < r.distance - 1e-9 GROUP BY r.j, r.i)
    SELECT j, i, CASE WHEN distance < 1e98 THEN round(distance, 4) END AS distance FROM g""",
)
def wet_distance(spark, sf):
    """Path length over wet cells to the nearest open cell."""
    g = cells(spark, sf).select("j", "i", "wet")
    d = grids.wet_distance(g, F.col("wet"), F.col("j") == 0, 500.0, 400.0, 120)
    return d.select("j", "i", F.round("distance", 4).alias("distance"))


@query(
    "quadtree_seeds",
    """
    WITH RECURSIVE q(s_suppkey, x, y, width, depth) AS (SELECT s_suppkey, s_suppkey % 10 * 100.0::DOUBLE, s_suppkey // 10 * 100.0::DOUBLE, 100.0::DOUBLE, 0 FROM supplier UNION ALL
      SELECT s_suppkey, x + a * width / 4, y + b * width / 4, width / 2, depth + 1 FROM q, (VALUES (-1, -1), (-1, 1), (1, -1), (1, 1)) AS o(a, b) WHERE depth < 6 AND width > 1.25 * (8.0 + sqrt(x * x + y * y) / 20.0))
    SELECT s_suppkey, x, y, width, depth FROM q WHERE NOT (depth < 6 AND width > 1.25 * (8.0 + sqrt(x * x + y * y) / 20.0))""",
)
def quadtree_seeds(spark, sf):
    """Squares split until they fit their target size."""
    k = F.col("s_suppkey")
    s = table(spark, sf, "supplier").select("s_suppkey", (k % 10 * 100.0).alias("x"), (F.floor(k / 10) * 100.0).alias("y"), F.lit(100.0).alias("width"))
    return grids.refine_cells(s, 8.0 + F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")) / 20.0, deepest=6).select("s_suppkey", "x", "y", "width", "depth")


@query(
    "destagger",
    f"""
    WITH u AS (SELECT j, i, CASE WHEN wet THEN depth END AS v FROM ({_CELL_SQL}) WHERE i < 119), s AS (SELECT j, i, v FROM u UNION ALL SELECT j, i + 1, v FROM u)
    SELECT j, i, avg(v) AS v FROM s GROUP BY j, i""",
)
def destagger(spark, sf):
    """Edge values to cell centres, missing edges left out."""
    e = cells(spark, sf).where("i < 119").select("j", "i", F.when(F.col("wet"), F.col("depth")).alias("v"))
    return grids.destagger(e, "i", ["j"], "v", 119).select("j", "i", "v")


@query(
    "incident_spacing",
    f"""
    WITH c AS (SELECT *, lag(x) OVER w AS px, lead(x) OVER w AS nx FROM (SELECT j, i, i + depth / 100.0 AS x FROM ({_CELL_SQL}) WHERE wet) WINDOW w AS (PARTITION BY j ORDER BY i))
    SELECT j, i, round(coalesce((abs(x - px) + abs(nx - x)) / 2, abs(x - px), abs(nx - x)), 8) AS spacing FROM c""",
)
def incident_spacing(spark, sf):
    """Mean distance of each wet cell to its neighbours along a row."""
    from brackish.functions.cleaning import pair_mean

    c = cells(spark, sf).where("wet").select("j", "i", (F.col("i") + F.col("depth") / 100.0).alias("x"))
    r = running(c, ["j"], ["i"], {"px": Run("lag", F.col("x")), "nx": Run("lead", F.col("x"))})
    return r.select("j", "i", F.round(pair_mean(F.abs(F.col("x") - F.col("px")), F.abs(F.col("nx") - F.col("x"))), 8).alias("spacing"))
