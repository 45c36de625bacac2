"""Spatial and interval joins as equi-joins on cells.

Spark turns a bare range condition into a nested loop over all pairs.  Here each
side is given the cells it touches on a grid fitting its own size, and the exact
test runs on rows that share one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.functions.geo import cross, in_triangle

_FINEST = 40
FEW_EDGES = 32  # a ring of no more edges carries them with its box


def _level(extent: Column) -> Column:
    """Power of two at least as long as ``extent``: it then touches two cells per axis at most."""
    return F.when(extent > 0, F.ceil(F.log2(extent))).otherwise(F.lit(-_FINEST)).cast("int")


def _cell(x: Column, level: Column) -> Column:
    return F.floor(x / F.pow(F.lit(2.0), level)).cast("long")


def points_in_boxes(
    points: DataFrame, boxes: DataFrame, x: str, y: str, west: str, south: str, east: str, north: str,
    how: str = "inner",
) -> DataFrame:
    """Every (point, box) with the point inside the closed box.

    Boxes are filed at the level of their longer side, so each has at most four
    cells; points look up one cell on each level that boxes use (a distinct list
    of a few dozen numbers).  ``how`` may be ``left_semi`` for points in any box.
    """
    level = _level(F.greatest(F.col(east) - F.col(west), F.col(north) - F.col(south)))
    # Cells no finer than what a double tells apart at the box, so that their numbers stay whole.
    reach = F.greatest(*[F.abs(F.col(c)) for c in (west, south, east, north)], F.lit(1.0))
    filed = boxes.withColumn("_level", F.greatest(level, F.lit(-_FINEST), F.ceil(F.log2(reach)).cast("int") - 50))
    levels = sorted(r[0] for r in filed.select("_level").distinct().collect() if r[0] is not None)
    span = lambda lo, hi: F.sequence(_cell(F.col(lo), F.col("_level")), _cell(F.col(hi), F.col("_level")))
    filed = filed.withColumn("_cx", F.explode(span(west, east))).withColumn("_cy", F.explode(span(south, north)))
    counted = points
    if how == "left_semi":  # equal points are looked up once and come back as often as they are
        counted = points.groupBy(*points.columns).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    seen = counted.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels]) if levels else F.array().cast("array<int>")))
    # A point beyond the numbers of a level's cells is in none of its boxes.
    seen = seen.where(F.greatest(F.abs(F.col(x)), F.abs(F.col(y))) / F.pow(F.lit(2.0), F.col("_level")) < 2.0**60)
    seen = seen.withColumns({"_cx": _cell(F.col(x), F.col("_level")), "_cy": _cell(F.col(y), F.col("_level"))})
    inside = F.col(x).between(F.col(west), F.col(east)) & F.col(y).between(F.col(south), F.col(north))
    same = (
        (seen["_level"] == filed["_level"]) & (seen["_cx"] == filed["_cx"]) & (seen["_cy"] == filed["_cy"])
    )
    if how == "left_semi":
        met = seen.join(filed, same & inside, "left_semi").select(*points.columns, "_copies").distinct()
        return met.withColumn("_copies", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).drop("_copies")
    return seen.join(filed, same & inside).select(
        *points.columns, *[c for c in boxes.columns if c not in points.columns]
    )


def locate_in_triangles(
    points: DataFrame, triangles: DataFrame, point_id: str, x: str, y: str, triangle_id: str,
    corners: Sequence[tuple[str, str]],
) -> DataFrame:
    """Lowest-numbered triangle that holds each point; points outside are dropped.

    Points at one place are looked up once, and of triangles with the same corners only the first can be found.
    """
    flat = [c for corner in corners for c in corner]
    xs, ys = [F.col(a) for a, _ in corners], [F.col(b) for _, b in corners]
    boxed = triangles.groupBy(*flat).agg(F.min(triangle_id).alias("_tri")).withColumns(
        {"_w": F.least(*xs), "_e": F.greatest(*xs), "_s": F.least(*ys), "_n": F.greatest(*ys)}
    )
    place = points.select(F.col(x).alias("_px"), F.col(y).alias("_py")).where("_px is not null and _py is not null").distinct()
    near = points_in_boxes(place, boxed, "_px", "_py", "_w", "_s", "_e", "_n")
    hit = near.where(in_triangle(F.col("_px"), F.col("_py"), [(F.col(a), F.col(b)) for a, b in corners]))
    first = hit.groupBy("_px", "_py").agg(F.min("_tri").alias("_tri"))
    found = points.join(first, (points[x] == first["_px"]) & (points[y] == first["_py"]))
    carried = [c for c in points.columns if c != point_id]
    return found.groupBy(point_id).agg(*[F.first(c).alias(c) for c in carried], F.min("_tri").alias(triangle_id))


def points_in_rings(points: DataFrame, edges: DataFrame, point_id: str, x: str, y: str, ring: str) -> DataFrame:
    """(point, ring) where a closed ring covers the point, its border included.

    ``edges`` holds ring, x1, y1, x2, y2.  A ring of few edges carries them with its box, and the test
    ends where the point meets the box.  Elsewhere, after the box test, a point meets only
    the edges of the ring that reach its own height: edges are filed by height on
    the level of their own extent, so long coastlines are not scanned per point.
    """
    box = edges.groupBy(ring).agg(
        F.min(F.least("x1", "x2")).alias("_w"), F.max(F.greatest("x1", "x2")).alias("_e"),
        F.min(F.least("y1", "y2")).alias("_s"), F.max(F.greatest("y1", "y2")).alias("_n"), F.count(F.lit(1)).alias("_edges"),
    )
    place = points.select(F.col(point_id).alias("_pid"), F.col(x).cast("double").alias("_px"), F.col(y).cast("double").alias("_py"))
    short, long = box.where(F.col("_edges") <= FEW_EDGES), box.where(F.col("_edges") > FEW_EDGES)
    carried = edges.join(short.select(ring), ring, "left_semi").groupBy(ring).agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_line")
    )
    near = points_in_boxes(place, short.join(carried, ring), "_px", "_py", "_w", "_s", "_e", "_n")
    px, py = F.col("_px"), F.col("_py")

    def crossed(x1, y1, x2, y2):
        at = x1 + F.try_divide((py - y1) * (x2 - x1), y2 - y1)
        return ((y1 > py) != (y2 > py)) & (px < at)

    def touched(x1, y1, x2, y2):
        beside = px.between(F.least(x1, x2), F.greatest(x1, x2)) & py.between(F.least(y1, y2), F.greatest(y1, y2))
        return (cross(x1, y1, x2, y2, px, py) == 0) & beside

    ends = lambda e: (e["x1"], e["y1"], e["x2"], e["y2"])
    odd = F.size(F.filter("_line", lambda e: crossed(*ends(e)))) % 2 == 1
    inside = near.where(odd | F.exists("_line", lambda e: touched(*ends(e)))).select("_pid", ring).distinct()

    near = points_in_boxes(place.distinct(), long, "_px", "_py", "_w", "_s", "_e", "_n").select("_pid", ring, "_px", "_py")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    filed = edges.join(long.select(ring), ring, "left_semi").withColumn("_level", F.greatest(_level(high - low), F.lit(-_FINEST)))
    levels = sorted(r[0] for r in filed.select("_level").distinct().collect())
    if not levels:
        return inside.withColumnRenamed("_pid", point_id)
    filed = filed.withColumn("_cell", F.explode(F.sequence(_cell(low, F.col("_level")), _cell(high, F.col("_level")))))
    asked = near.withColumn("_level", F.explode(F.array(*map(F.lit, levels))))
    asked = asked.withColumn("_cell", _cell(py, F.col("_level")))
    sides = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    met = asked.join(filed, [ring, "_level", "_cell"]).groupBy("_pid", ring).agg(
        F.count_if(crossed(*sides)).alias("_crossed"), F.bool_or(touched(*sides)).alias("_on")
    )
    far = met.where((F.pmod(F.col("_crossed"), F.lit(2)) == 1) | F.col("_on")).select("_pid", ring)
    return inside.unionByName(far).withColumnRenamed("_pid", point_id)


def interpolate_in_triangles(
    points: DataFrame, triangles: DataFrame, point_id: str, x: str, y: str, triangle_id: str,
    corners: Sequence[tuple[str, str, str]],
) -> DataFrame:
    """Linear value inside the triangle that holds each point; corners are (x, y, value) columns."""
    places = [(a, b) for a, b, _ in corners]
    hit = locate_in_triangles(points, triangles, point_id, x, y, triangle_id, places).join(triangles, triangle_id)
    (ax, ay, av), (bx, by, bv), (cx, cy, cv) = (tuple(F.col(c) for c in corner) for corner in corners)
    px, py = F.col(x), F.col(y)
    whole = cross(ax, ay, bx, by, cx, cy)
    wa = F.try_divide(cross(bx, by, cx, cy, px, py), whole)
    wb = F.try_divide(cross(cx, cy, ax, ay, px, py), whole)
    return hit.select(point_id, triangle_id, (wa * av + wb * bv + (1.0 - wa - wb) * cv).alias("value"))


def overlapping_intervals(
    left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Pairs of half-open [start, end) number intervals that overlap.

    Each interval is filed on the level of its own length and looks up the
    coarser levels the other side uses; a pair is reported once, in the cell
    that holds the later of its two starts, on the coarser of its two levels.
    """
    def filed(df, span, tag):
        s, e = F.col(span[0]), F.col(span[1])
        return df.where(s < e).withColumn(f"_{tag}level", _level((e - s).cast("double")))

    l, r = filed(left, left_span, "l"), filed(right, right_span, "r")
    used = l.select(F.col("_llevel").alias("v")).union(r.select("_rlevel")).distinct()
    levels = F.array(*[F.lit(row[0]) for row in used.collect()] or [F.lit(0)])

    def spread(df, span, tag):
        own = F.col(f"_{tag}level")
        at = df.withColumn("_at", F.explode(F.filter(levels, lambda v: v >= own)))
        first, last = (_cell(F.col(c).cast("double"), F.col("_at")) for c in span)
        return at.withColumn("_cell", F.explode(F.sequence(first, last)))

    a, b = spread(l, left_span, "l"), spread(r, right_span, "r")
    a = a.select(*left.columns, "_llevel", F.col("_at").alias("_la"), F.col("_cell").alias("_lc"))
    b = b.select(*[F.col(c).alias(c if c not in keys else "_k_" + c) for c in right.columns], "_rlevel",
                 F.col("_at").alias("_ra"), F.col("_cell").alias("_rc"))
    test = (F.col("_la") == F.col("_ra")) & (F.col("_lc") == F.col("_rc"))
    for k in keys:
        test = test & (F.col(k) == F.col("_k_" + k))
    ls, le, rs, re = (F.col(c) for c in (*left_span, *right_span))
    once = (F.col("_la") == F.greatest("_llevel", "_rlevel")) & (
        F.col("_lc") == _cell(F.greatest(ls, rs).cast("double"), F.col("_la"))
    )
    return a.join(b, test & (ls < re) & (le > rs) & once).select(
        *left.columns, *[c for c in right.columns if c not in keys]
    )


def priority_overlay(
    targets: DataFrame, candidates: DataFrame, target_id: str, value: str, priority: Sequence[str],
    carry: Sequence[str] = (),
) -> DataFrame:
    """First non-null candidate in priority order per target, with where it came from.

    Targets without one stay, marked ``no_source_coverage``.  The winner is an
    aggregate with map-side combine, so a target covered by very many sources
    never gathers them.
    """
    usable = candidates.where(F.col(value).isNotNull())
    boxed = F.struct(value, *carry)
    winner = usable.groupBy(target_id).agg(F.min_by(boxed, F.struct(*priority)).alias("_win"))
    return targets.join(winner, target_id, "left").select(
        *targets.columns,
        F.col("_win")[value].alias(value),
        *[F.col("_win")[c].alias(c) for c in carry],
        F.when(F.col("_win").isNull(), "no_source_coverage").otherwise("ok").alias("coverage_status"),
    )


def changed_rows(planned: DataFrame, current: DataFrame, keys: Sequence[str], revision: str) -> DataFrame:
    """Planned rows that disappeared or whose revision differs now."""
    now = current.select(*keys, F.col(revision).alias("_now"), F.lit(True).alias("_here"))
    return (
        planned.join(now, list(keys), "left")
        .withColumn(
            "change",
            F.when(F.col("_here").isNull(), "disappeared").when(
                ~F.col(revision).eqNullSafe(F.col("_now")), "updated"
            ),
        )
        .where("change is not null")
        .drop("_now", "_here")
    )


def crosscheck(left: DataFrame, right: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """Two keyed sets: rows missing, extra, or of a different size."""
    a = left.select(*keys, F.col(size).alias("left_size"), F.lit(True).alias("_l"))
    b = right.select(*keys, F.col(size).alias("right_size"), F.lit(True).alias("_r"))
    verdict = (
        F.when(F.col("_r").isNull(), "missing")
        .when(F.col("_l").isNull(), "extra")
        .when(~F.col("left_size").eqNullSafe(F.col("right_size")), "size_mismatch")
    )
    return a.join(b, list(keys), "full").withColumn("problem", verdict).where("problem is not null").drop("_l", "_r")


def with_fallback(primary: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary rows, and fallback rows only for keys the primary lacks."""
    return primary.unionByName(fallback.join(primary.select(*keys), list(keys), "left_anti"))
