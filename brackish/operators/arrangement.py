"""Faces of linework: crossings by cells, half-edges in order of angle, face borders by pointer doubling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.functions.geo import cross
from brackish.operators.graph import ring_order
from brackish.operators.joins import points_in_rings
from brackish.operators.ordered import Run, running
from brackish.session import cut_lineage, cut_rounds

_FINEST = 40


def _boxed(segments: DataFrame) -> DataFrame:
    """Segments with their box and the level of cells (powers of two) that is as long as they are."""
    w, e, s, n = F.least("x1", "x2"), F.greatest("x1", "x2"), F.least("y1", "y2"), F.greatest("y1", "y2")
    boxed = segments.withColumns({"w": w, "e": e, "s": s, "n": n})
    extent = F.greatest(F.col("e") - F.col("w"), F.col("n") - F.col("s"))
    # Cells no finer than what a double tells apart there.
    reach = F.greatest(*[F.abs(F.col(c)) for c in ("w", "e", "s", "n")], F.lit(1.0))
    return boxed.withColumn("level", F.greatest(F.ceil(F.log2(extent)).cast("int"), F.lit(-_FINEST), F.ceil(F.log2(reach)).cast("int") - 50))


def _cell(x: Column, level: Column) -> Column:
    return F.floor(x / F.pow(F.lit(2.0), level)).cast("long")


def close_pairs(segments: DataFrame) -> DataFrame:
    """Pairs (a, b) of segments (id, x1, y1, x2, y2) whose boxes meet, each once.

    The shorter of a pair looks up the few cells it touches on the level of the longer.  A pair may
    share several cells; it counts in the one that holds the lower corner of what both boxes share.
    """
    boxed = cut_lineage(_boxed(segments))
    levels = sorted(r[0] for r in boxed.select("level").distinct().collect())
    if not levels:
        levels = [0]

    def in_cells(df: DataFrame, level: str) -> DataFrame:
        spans = [F.sequence(_cell(F.col(lo), F.col(level)), _cell(F.col(hi), F.col(level))) for lo, hi in (("w", "e"), ("s", "n"))]
        return df.withColumn("cx", F.explode(spans[0])).withColumn("cy", F.explode(spans[1]))

    sides = ["id", "x1", "y1", "x2", "y2", "w", "e", "s", "n", "level"]
    b = in_cells(boxed, "level").select(F.struct(*sides).alias("b"), F.col("level").alias("at"), "cx", "cy")
    asked = boxed.withColumn("at", F.explode(F.array(*map(F.lit, levels)))).where("at >= level")
    a = in_cells(asked, "at").select(F.struct(*sides).alias("a"), "at", "cx", "cy")
    met = a.join(b, ["at", "cx", "cy"]).where((F.col("a.level") < F.col("b.level")) | ((F.col("a.level") == F.col("b.level")) & (F.col("a.id") < F.col("b.id"))))
    west, south = F.greatest("a.w", "b.w"), F.greatest("a.s", "b.s")
    meet = (west <= F.least("a.e", "b.e")) & (south <= F.least("a.n", "b.n"))
    return met.where(meet & (F.col("cx") == _cell(west, F.col("at"))) & (F.col("cy") == _cell(south, F.col("at")))).select("a", "b")


def _apart(segments: DataFrame) -> DataFrame:
    """Segments (x1, y1, x2, y2) that run along an axis, cut at each other's ends where they lie on one line, each piece once.

    Of pieces that cover each other every crossing would be found again and again.
    """
    upright = F.col("x1") == F.col("x2")
    axis = segments.where(upright | (F.col("y1") == F.col("y2"))).select(
        upright.alias("upright"), F.when(upright, F.col("x1")).otherwise(F.col("y1")).alias("at"),
        F.when(upright, F.least("y1", "y2")).otherwise(F.least("x1", "x2")).alias("lo"),
        F.when(upright, F.greatest("y1", "y2")).otherwise(F.greatest("x1", "x2")).alias("hi"),
    )
    ends = axis.select("upright", "at", F.inline(F.array(*[F.struct(F.col(c).alias("to"), F.lit(n).cast("long").alias("turn")) for c, n in (("lo", 1), ("hi", -1))])))
    ends = cut_lineage(ends.groupBy("upright", "at", "to").agg(F.sum("turn").alias("turn")))
    walked = running(ends, ["upright", "at"], ["to"], {"since": Run("lag", F.col("to")), "over": Run("sum", F.col("turn"))})
    pieces = walked.where("since is not null and over > turn")  # something lies over the stretch before this end
    corner = lambda c: [F.when(F.col("upright"), F.col("at")).otherwise(F.col(c)), F.when(F.col("upright"), F.col(c)).otherwise(F.col("at"))]
    cut = pieces.select(*[c.alias(n) for c, n in zip(corner("since") + corner("to"), ("x1", "y1", "x2", "y2"), strict=True)])
    return segments.where(~upright & (F.col("y1") != F.col("y2"))).unionByName(cut)


def noded(segments: DataFrame, digits: int = 9) -> DataFrame:
    """Distinct edges (u, v), u before v, into which segments (x1, y1, x2, y2) cut each other.

    ``u`` and ``v`` are structs of x and y, rounded to ``digits``.  Segments are cut where they cross, where an end
    of one lies on another, and at the ends of what they have in common.  Null or non-finite
    segments and such of no length are left out.
    """
    x = {c: (F.round(F.col(c).cast("double"), digits) + 0.0).alias(c) for c in ("x1", "y1", "x2", "y2")}
    finite = F.greatest(*[F.abs(F.col(c)) for c in x]) < float("inf")
    whole = F.col("x1").isNotNull() & F.col("y1").isNotNull() & F.col("x2").isNotNull() & F.col("y2").isNotNull() & finite
    plain = segments.select(*x.values()).where(whole & ((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))))
    turned = (F.col("x1") > F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") > F.col("y2")))
    plain = plain.select(*[F.when(turned, F.col(o)).otherwise(F.col(c)).alias(c) for c, o in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))]).distinct()
    known = cut_lineage(_apart(cut_lineage(plain)).withColumn("id", F.monotonically_increasing_id()))

    pairs = close_pairs(known)
    corner = lambda s, k: (F.col(f"{s}.x{k}"), F.col(f"{s}.y{k}"))
    ends = {s: (corner(s, 1), corner(s, 2)) for s in "ab"}
    side = {(s, k): cross(*ends[o][0], *ends[o][1], *ends[s][k]) for s, o in (("a", "b"), ("b", "a")) for k in (0, 1)}

    def point(there: Column, segment: str, px: Column, py: Column) -> Column:
        return F.when(there, F.struct(F.col(f"{segment}.id").alias("id"), px.alias("x"), py.alias("y")))

    cuts = []
    for s, o in (("a", "b"), ("b", "a")):
        for k in (0, 1):  # an end of s on o
            px, py = ends[s][k]
            inside = px.between(F.col(f"{o}.w"), F.col(f"{o}.e")) & py.between(F.col(f"{o}.s"), F.col(f"{o}.n"))
            cuts.append(point((side[s, k] == 0) & inside, o, px, py))
    proper = (F.signum(side["a", 0]) * F.signum(side["a", 1]) < 0) & (F.signum(side["b", 0]) * F.signum(side["b", 1]) < 0)
    share = side["a", 0] / (side["a", 0] - side["a", 1])
    met = [F.round(p + share * (q - p), digits) + 0.0 for p, q in zip(*ends["a"], strict=True)]
    cuts += [point(proper, s, *met) for s in "ab"]
    found = pairs.select(F.explode(F.filter(F.array(*cuts), lambda c: c.isNotNull())).alias("c")).select("c.*")
    own = known.select("id", F.inline(F.array(*[F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in (1, 2)])))
    lines = known.select("id", "x1", "y1", F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("d"), "x2", "y2")
    along = ((F.col("x") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y") - F.col("y1")) * (F.col("y2") - F.col("y1"))) / F.col("d")
    points = cut_lineage(own.unionByName(found).distinct().join(lines, "id").select("id", along.alias("along"), F.struct("x", "y").alias("v")))
    chained = running(points, ["id"], ["along", "v"], {"u": Run("lag", F.col("v"))}).where("u is not null and u <> v")
    return chained.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _next(arrows: DataFrame) -> DataFrame:
    """(arrow, next) of half-edges (u, v): next turns as far left as it can, so that what lies on the left is one face."""
    angle = F.atan2(F.col("v.y") - F.col("u.y"), F.col("v.x") - F.col("u.x"))
    placed = running(arrows.withColumn("angle", angle), ["u"], ["angle", "v"], {"before": Run("lag", F.col("v"))})
    last = arrows.withColumn("angle", angle).groupBy("u").agg(F.max_by("v", F.struct("angle", "v")).alias("last"))
    # Around a node the first half-edge follows the last; one row a node is missing.
    wrapped = placed.where("before is null").drop("before").join(last, "u").withColumnRenamed("last", "before")
    every = placed.where("before is not null").select("u", "v", "before").union(wrapped.select("u", "v", "before"))
    return every.select(F.struct(F.col("v").alias("u"), F.col("u").alias("v")).alias("arrow"), F.struct(F.col("u").alias("u"), F.col("before").alias("v")).alias("next"))


def _labelled(linked: DataFrame) -> DataFrame:
    """(arrow, next, ring): the least half-edge of the closed chain that each half-edge is on, in logarithmic rounds."""
    linked = cut_rounds(linked)
    state = cut_rounds(linked.select("arrow", F.col("next").alias("jump"), F.least("arrow", "next").alias("ring")))
    whole = []
    while True:
        far = state.select(F.col("arrow").alias("jump"), F.col("jump").alias("farther"), F.col("ring").alias("other"))
        met = cut_rounds(state.join(far, "jump"))
        # Stretches of the same length lie end to end: where all with a label agree with the next one, each has seen
        # its whole chain, which takes no part in further rounds.
        short = cut_rounds(met.where("ring <> other").select("ring").distinct())
        if short.isEmpty():
            whole.append(met.select("arrow", "ring"))
            return linked.join(reduce(DataFrame.unionByName, whole), "arrow")
        whole.append(cut_rounds(met.join(short, "ring", "left_anti").select("arrow", "ring")))
        state = cut_rounds(met.join(short, "ring", "left_semi").select("arrow", F.col("farther").alias("jump"), F.least("ring", "other").alias("ring")))


def half_edges(edges: DataFrame) -> DataFrame:
    """(arrow, next, ring) around the faces of edges (u, v), without those edges that have the same face on both sides.

    Dead ends and bridges are such edges; when they are gone, each of the rest borders two faces.
    """
    both = lambda e: e.select("u", "v").union(e.select("v", "u"))
    first = _labelled(_next(cut_lineage(both(edges))))
    turned = first.select(F.struct(F.col("arrow.v").alias("u"), F.col("arrow.u").alias("v")).alias("arrow"), F.col("ring").alias("other"))
    kept = first.join(turned, "arrow").where("ring <> other").select("arrow.u", "arrow.v")
    return cut_rounds(_labelled(_next(cut_rounds(kept))))


def ring_areas(half: DataFrame) -> DataFrame:
    """ring, area (positive around a face, negative around a group of faces from outside), perimeter."""
    ox, oy = F.col("ring.u.x"), F.col("ring.u.y")
    ux, uy, vx, vy = F.col("arrow.u.x") - ox, F.col("arrow.u.y") - oy, F.col("arrow.v.x") - ox, F.col("arrow.v.y") - oy
    return half.groupBy("ring").agg((F.sum(ux * vy - uy * vx) / 2).alias("area"), F.sum(F.hypot(vx - ux, vy - uy)).alias("perimeter"))


def _around(points: DataFrame, half: DataFrame, areas: DataFrame, apart: bool) -> DataFrame:
    """(point, face): the smallest face border that holds each point (point, x, y); with ``apart`` borders through the point do not count."""
    faces = areas.where("area > 0").select("ring", F.col("area").alias("size"))
    borders = half.join(faces.select("ring"), "ring")
    lines = borders.select("ring", F.col("arrow.u.x").alias("x1"), F.col("arrow.u.y").alias("y1"), F.col("arrow.v.x").alias("x2"), F.col("arrow.v.y").alias("y2"))
    met = points_in_rings(points, lines, "point", "x", "y", "ring")
    if apart:
        through = points.join(borders.select("ring", F.col("arrow.u.x").alias("x"), F.col("arrow.u.y").alias("y")), ["x", "y"]).select("point", "ring")
        met = met.join(through, ["point", "ring"], "left_anti")
    return met.join(faces, "ring").groupBy("point").agg(F.min_by("ring", F.struct("size", "ring")).alias("face"))


def faces(half: DataFrame, least_hole: float = 0.0) -> DataFrame:
    """face, area, perimeter, holes of each bounded face: groups of other faces that lie inside it are holes.

    Holes smaller than ``least_hole`` are not cut out.
    """
    areas = cut_lineage(ring_areas(half))
    inner = areas.where("area < 0").select(F.col("ring").alias("point"), F.col("ring.u.x").alias("x"), F.col("ring.u.y").alias("y"))
    held = _around(inner, half, areas, apart=True)
    cut = held.join(areas.withColumnRenamed("ring", "point"), "point").where(-F.col("area") >= least_hole)
    holes = cut.groupBy("face").agg(F.sum("area").alias("less"), F.sum("perimeter").alias("more"), F.count(F.lit(1)).alias("holes"))
    none = F.lit(0.0)
    return areas.where("area > 0").withColumnRenamed("ring", "face").join(holes, "face", "left").select(
        "face", (F.col("area") + F.coalesce("less", none)).alias("area"), (F.col("perimeter") + F.coalesce("more", none)).alias("perimeter"),
        F.coalesce("holes", F.lit(0).cast("long")).alias("holes"),
    )


def seeded_domains(half: DataFrame, seeds: DataFrame, seed: str, x: str, y: str, least_hole: float = 0.0) -> DataFrame:
    """``seed``, face, area, perimeter, holes of the face around each seed point; seeds in no bounded face are left out.

    A seed on a border goes to the smallest face there, one inside a hole to the face in that hole.
    """
    points = seeds.select(F.col(seed).alias("point"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("point is not null")
    found = _around(points, half, ring_areas(half), apart=False)
    return found.join(faces(half, least_hole), "face").select(F.col("point").alias(seed), "face", "area", "perimeter", "holes")


def outlines(half: DataFrame, chosen: DataFrame) -> DataFrame:
    """ring, toward, position, node: the corners in order of the rings in ``chosen`` (ring)."""
    part = half.join(chosen.select("ring").distinct(), "ring")
    turns = part.select(F.col("arrow.u").alias("before"), F.col("arrow.v").alias("node"), F.col("next.v").alias("after"))
    return ring_order(part.select("arrow.u", "arrow.v"), "u", "v", turns)
