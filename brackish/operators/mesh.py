"""Triangle meshes as tables: nodes (node, x, y[, depth]) and triangles (tri, n1, n2, n3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.operators.graph import components, hop_distance, ring_order
from brackish.operators.metrics import same_keys
from brackish.operators.ordered import Run, Slices, running
from brackish.operators.quantiles import with_quantiles
from brackish.session import cut_lineage


def corners(triangles: DataFrame, nodes: DataFrame, carry: Sequence[str] = ("x", "y")) -> DataFrame:
    """One row per triangle with the fields of its three nodes: one join, one regroup.

    Both sides are as long as the mesh, which the planner's estimate (packed file size, one row per triangle) hides:
    it would send the opened triangles through the driver, so the join is by merge.
    """
    opened = triangles.select("tri", F.posexplode(F.array("n1", "n2", "n3")).alias("pos", "node"))
    met = opened.join(nodes.select("node", *carry).hint("merge"), "node")
    pick = [F.max(F.when(F.col("pos") == p, F.col(c))).alias(f"{c}{p + 1}") for p in range(3) for c in carry]
    return met.groupBy("tri").agg(*pick)


def triangle_geometry(cornered: DataFrame) -> DataFrame:
    """Signed area, edge lengths opposite each corner, angles and equilateral quality."""
    x = [F.col(f"x{k}") for k in (1, 2, 3)]
    y = [F.col(f"y{k}") for k in (1, 2, 3)]
    twice = (x[1] - x[0]) * (y[2] - y[0]) - (y[1] - y[0]) * (x[2] - x[0])
    side = lambda p, q: F.sqrt((x[p] - x[q]) * (x[p] - x[q]) + (y[p] - y[q]) * (y[p] - y[q]))
    measured = cornered.withColumns({"signed_area": twice / 2.0, "l1": side(1, 2), "l2": side(0, 2), "l3": side(0, 1)})

    def angle(a, b, c):
        a, b, c = F.col(a), F.col(b), F.col(c)
        cosine = (b * b + c * c - a * a) / F.greatest(2.0 * b * c, F.lit(1e-30))
        return F.degrees(F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0))))

    squares = F.col("l1") * F.col("l1") + F.col("l2") * F.col("l2") + F.col("l3") * F.col("l3")
    return measured.withColumns(
        {
            "area": F.abs("signed_area"),
            "angle1": angle("l1", "l2", "l3"),
            "angle2": angle("l2", "l3", "l1"),
            "angle3": angle("l3", "l1", "l2"),
            "quality": F.abs("signed_area") * 4.0 * F.sqrt(F.lit(3.0)) / F.greatest(squares, F.lit(1e-30)),
        }
    )


def edges(triangles: DataFrame) -> DataFrame:
    """Undirected edges with the number of triangles on each and the outermost two."""
    pair = lambda p, q: F.struct(F.least(p, q).alias("a"), F.greatest(p, q).alias("b"))
    opened = triangles.select("tri", F.inline(F.array(pair("n1", "n2"), pair("n2", "n3"), pair("n1", "n3"))))
    return opened.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("owners"), F.min("tri").alias("left_tri"), F.max("tri").alias("right_tri")
    )


def boundary_edges(edge_table: DataFrame) -> DataFrame:
    return edge_table.where("owners = 1")


def neighbours(edge_table: DataFrame) -> DataFrame:
    """Pairs of triangles that share an edge of exactly two."""
    return edge_table.where("owners = 2").select("left_tri", "right_tri")


def topology_summary(edge_table: DataFrame) -> DataFrame:
    return edge_table.agg(
        F.count(F.lit(1)).alias("edges"),
        F.count_if(F.col("owners") == 1).alias("boundary_edges"),
        F.count_if(F.col("owners") > 2).alias("nonmanifold_edges"),
    )


def triangle_components(triangles: DataFrame, edge_table: DataFrame) -> DataFrame:
    """(tri, component); triangles without a neighbour are their own component."""
    linked = components(neighbours(edge_table), "left_tri", "right_tri")
    return triangles.select("tri").join(linked.withColumnRenamed("node", "tri"), "tri", "left").select(
        "tri", F.coalesce("component", "tri").alias("component")
    )


def triangle_distance(triangles: DataFrame, edge_table: DataFrame, constraint: DataFrame) -> DataFrame:
    """Hops over shared edges from the triangles on constraint edges (a, b)."""
    on = edge_table.join(constraint.select("a", "b"), ["a", "b"], "left_semi")
    seeds = on.select(F.explode(F.array_distinct(F.array("left_tri", "right_tri"))).alias("tri"))
    return hop_distance(triangles, neighbours(edge_table), seeds, "tri", "left_tri", "right_tri")


def area_changes(geometry: DataFrame, edge_table: DataFrame) -> DataFrame:
    """Larger over smaller area of each pair of neighbours."""
    areas = geometry.select("tri", "area")
    met = (
        neighbours(edge_table)
        .join(areas.select(F.col("tri").alias("left_tri"), F.col("area").alias("_l")), "left_tri")
        .join(areas.select(F.col("tri").alias("right_tri"), F.col("area").alias("_r")), "right_tri")
    )
    ratio = F.try_divide(F.greatest("_l", "_r"), F.least("_l", "_r"))
    return met.select("left_tri", "right_tri", ratio.alias("area_ratio"))


def node_valence(edge_table: DataFrame) -> DataFrame:
    """Number of distinct neighbours of each node."""
    ends = edge_table.select(F.explode(F.array("a", "b")).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("valence"))


def node_average(triangles: DataFrame, value: str) -> DataFrame:
    """Mean over the triangles around each node."""
    opened = triangles.select(value, F.explode(F.array("n1", "n2", "n3")).alias("node"))
    return opened.groupBy("node").agg(F.avg(value).alias(value))


def quality_metrics(geometry: DataFrame, **sizing) -> DataFrame:
    """Mesh-wide quality and angle statistics with threshold counts."""
    low = F.least("angle1", "angle2", "angle3")
    high = F.greatest("angle1", "angle2", "angle3")
    q = F.col("quality")
    stats = geometry.agg(
        F.count(F.lit(1)).alias("triangles"),
        F.min(q).alias("quality_min"),
        F.avg(q).alias("quality_mean"),
        F.stddev_pop(q).alias("quality_std"),
        F.min(low).alias("min_angle"),
        F.max(high).alias("max_angle"),
        F.count_if(q < 0.1).alias("quality_below_0_10"),
        F.count_if(low < 5).alias("angle_below_5"),
        F.count_if(low < 30).alias("angle_below_30"),
        F.count_if(F.col("signed_area") <= 0).alias("not_positive"),
    ).withColumn("quality_l3_sigma", F.col("quality_mean") - 3.0 * F.col("quality_std"))
    median = with_quantiles(geometry, [], q, [0.05, 0.5], **sizing)
    named = median.select(F.col("quantiles")[0].alias("quality_p05"), F.col("quantiles")[1].alias("quality_median"))
    return same_keys(stats, named, [])


def chain_edges(
    chains: DataFrame, chain: str, position: str, node: str, closed: bool = True, slices: Slices | None = None
) -> DataFrame:
    """Edges between consecutive nodes of each chain, closing the last to the first.

    The successor is a sliced lead, so a long chain is not gathered; closing needs
    one row per chain.
    """
    here = chains.select(F.col(chain).alias("chain"), F.col(position).alias("pos"), F.col(node).alias("node"))
    walked = running(here, ["chain"], ["pos"], {"next_node": Run("lead", F.col("node"))}, slices)
    if closed:
        first = here.groupBy("chain").agg(F.min_by("node", "pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
        walked = walked.join(first, "chain").where("_n > 1").withColumn("next_node", F.coalesce("next_node", "_first"))
    return walked.where("next_node is not null").select(
        "chain", "pos", "node", "next_node",
        F.least("node", "next_node").alias("a"), F.greatest("node", "next_node").alias("b"),
    )


def missing_constraints(chain_edge_table: DataFrame, mesh_edges: DataFrame) -> DataFrame:
    """Protected edges the mesh lacks."""
    return chain_edge_table.select("a", "b").distinct().join(mesh_edges.select("a", "b"), ["a", "b"], "left_anti")


def chain_report(chains: DataFrame, chain_edge_table: DataFrame, mesh_edges: DataFrame, minimum: int = 2) -> DataFrame:
    """Open-boundary chains: are nodes unique, enough, and every pair a boundary edge?"""
    outer = boundary_edges(mesh_edges).select("a", "b", F.lit(True).alias("_ok"))
    pairs = chain_edge_table.join(outer, ["a", "b"], "left").groupBy("chain").agg(
        F.count_if(F.col("_ok").isNull()).alias("missing_pairs")
    )
    counted = chains.groupBy("chain").agg(F.count("node").alias("nodes"), F.count_distinct("node").alias("unique_nodes"))
    good = (F.col("nodes") >= minimum) & (F.col("nodes") == F.col("unique_nodes")) & (F.col("missing_pairs") == 0)
    return counted.join(pairs, "chain", "left").withColumn("missing_pairs", F.coalesce("missing_pairs", F.lit(0))).withColumn("ordered", good)


def shared_chain_nodes(chains: DataFrame) -> DataFrame:
    return chains.groupBy("node").agg(F.count_distinct("chain").alias("n")).where("n > 1").select("node")


# Names of what a boundary chain can fail.
DOUBLED, TOO_LONG, TOO_STEEP, JUMP = (
    "duplicate_boundary_vertex",
    "boundary_edge_target_ratio_exceeded",
    "boundary_spacing_gradation_exceeded",
    "open_land_junction_spacing_jump",
)


def boundary_contract(
    chain_edge_table: DataFrame, nodes: DataFrame, gradation: float = 0.15, length_ratio: float = 1.55, jump: float = 1.5
) -> DataFrame:
    """Spacing audit of boundary chains against each node's target (one row per chain).

    ``nodes`` holds node, x, y, target, kind.
    """
    left = nodes.select(*[F.col(c).alias(c if c == "node" else "_" + c) for c in ("node", "x", "y", "target", "kind")])
    right = nodes.select(*[F.col(c).alias("next_node" if c == "node" else "n_" + c) for c in ("node", "x", "y", "target", "kind")])
    met = chain_edge_table.join(left, "node").join(right, "next_node")
    dx, dy = F.col("_x") - F.col("n_x"), F.col("_y") - F.col("n_y")
    ha, hb = F.col("_target"), F.col("n_target")
    met = met.withColumn("_len", F.sqrt(dx * dx + dy * dy))
    real = F.col("_len") > 1e-10
    harmonic = 2.0 / (1.0 / ha + 1.0 / hb)
    ratio = F.greatest(ha, hb) / F.greatest(F.least(ha, hb), F.lit(1e-12))
    out = met.groupBy("chain").agg(
        F.count_if(real).alias("edges"),
        F.count_if(~real).alias("doubled_vertices"),
        F.coalesce(F.max(F.when(real, F.col("_len") / F.greatest(harmonic, F.lit(1e-12)))), F.lit(0.0)).alias("max_length_ratio"),
        F.coalesce(F.max(F.when(real, F.try_divide(F.abs(ha - hb), F.col("_len")))), F.lit(0.0)).alias("max_gradient"),
        F.coalesce(F.max(F.when(real, ratio)), F.lit(1.0)).alias("max_target_ratio"),
        F.coalesce(F.max(F.when(real & (F.col("_kind") != F.col("n_kind")), ratio)), F.lit(1.0)).alias("max_kind_change_ratio"),
    )
    failures = F.array_compact(
        F.array(
            F.when(F.col("doubled_vertices") > 0, DOUBLED),
            F.when(F.col("max_length_ratio") > length_ratio + 1e-9, TOO_LONG),
            F.when(F.col("max_gradient") > gradation + 1e-9, TOO_STEEP),
            F.when(F.col("max_kind_change_ratio") > jump + 1e-9, JUMP),
        )
    )
    return out.withColumn("failures", F.array_join(F.array_sort(failures), ",")).withColumn("passed", F.col("failures") == "")


def sponge(chain_edge_table: DataFrame, nodes: DataFrame, coefficient: float = 0.0025, **sizing) -> DataFrame:
    """Edge-length spread of each node string; the median is the sponge radius."""
    left = nodes.select("node", F.col("x").alias("_x"), F.col("y").alias("_y"))
    right = nodes.select(F.col("node").alias("next_node"), F.col("x").alias("n_x"), F.col("y").alias("n_y"))
    met = chain_edge_table.join(left, "node").join(right, "next_node")
    dx, dy = F.col("_x") - F.col("n_x"), F.col("_y") - F.col("n_y")
    met = met.withColumn("_len", F.sqrt(dx * dx + dy * dy))
    spread = met.groupBy("chain").agg(
        F.count(F.lit(1)).alias("edges"), F.min("_len").alias("shortest"), F.max("_len").alias("longest")
    )
    median = with_quantiles(met, ["chain"], F.col("_len"), [0.5], **sizing)
    return spread.join(median.select("chain", F.col("quantiles")[0].alias("radius")), "chain").withColumn(
        "coefficient", F.lit(coefficient)
    )


def boundary_rings(triangles: DataFrame) -> DataFrame:
    """Ordered boundary rings, walked in the direction of the triangles.

    A node may be on several rings (holes that touch).  There a ring goes on along the fan of triangles
    that its arriving edge belongs to.
    """
    arrow = lambda p, q: F.struct(F.col(p).alias("p"), F.col(q).alias("q"))
    arrows = triangles.select(F.inline(F.array(arrow("n1", "n2"), arrow("n2", "n3"), arrow("n3", "n1"))))
    outer = boundary_edges(edges(triangles)).select("a", "b")
    on = (F.least("p", "q") == F.col("a")) & (F.greatest("p", "q") == F.col("b"))
    rim = cut_lineage(arrows.join(outer, on).select("p", "q"))
    shared = rim.groupBy(F.col("p").alias("node")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("node")
    corner = lambda n, r, s: F.struct(F.col(n).alias("node"), F.col(r).alias("r"), F.col(s).alias("s"))
    corners = triangles.select(F.inline(F.array(corner("n1", "n2", "n3"), corner("n2", "n3", "n1"), corner("n3", "n1", "n2"))))
    # The triangles at one node, each from its edge out to its edge in: following them crosses a fan.
    fans = corners.join(shared, "node").groupBy("node").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("r", "s")))).alias("_next"))
    leaving = rim.select(F.col("p").alias("node"), F.col("q").alias("after")).join(fans, "node")
    crossed = F.aggregate(F.map_keys("_next"), F.col("after"), lambda at, _: F.coalesce(F.try_element_at(F.col("_next"), at), at))
    return ring_order(rim, "p", "q", leaving.select(crossed.alias("before"), "node", "after"))


def thin_clusters(geometry: DataFrame, triangles: DataFrame, quality: float = 0.1, angle: float = 5.0) -> DataFrame:
    """Poor triangles joined into clusters by shared nodes."""
    bad = geometry.where(
        (F.col("quality") < quality) | (F.least("angle1", "angle2", "angle3") < angle)
    ).select("tri")
    on = triangles.join(bad, "tri", "left_semi").select("tri", F.explode(F.array("n1", "n2", "n3")).alias("node"))
    first = on.groupBy("node").agg(F.min("tri").alias("_first"))
    linked = components(on.join(first, "node"), "tri", "_first")
    return linked.withColumnRenamed("node", "tri").groupBy("component").agg(
        F.count(F.lit(1)).alias("members"), F.min("tri").alias("first_tri"), F.max("tri").alias("last_tri")
    )


def extent(nodes: DataFrame, pad: float = 0.02) -> DataFrame:
    """Bounding box with padding of a share of each span."""
    box = nodes.agg(F.min("x").alias("w"), F.max("x").alias("e"), F.min("y").alias("s"), F.max("y").alias("n"))
    px, py = (F.col("e") - F.col("w")) * pad, (F.col("n") - F.col("s")) * pad
    return box.select((F.col("w") - px).alias("west"), (F.col("e") + px).alias("east"),
                      (F.col("s") - py).alias("south"), (F.col("n") + py).alias("north"))


def ring_area(points: DataFrame, ring: str, position: str, x: str, y: str) -> DataFrame:
    """Shoelace area of each ring of (position, x, y)."""
    pts = points.select(F.col(ring).alias("ring"), F.col(position).alias("pos"), F.struct(x, y).alias("node"))
    pairs = chain_edges(pts, "ring", "pos", "node")
    part = F.col("node")[x] * F.col("next_node")[y] - F.col("next_node")[x] * F.col("node")[y]
    return pairs.groupBy("chain").agg((F.abs(F.sum(part)) / 2.0).alias("area")).withColumnRenamed("chain", ring)
