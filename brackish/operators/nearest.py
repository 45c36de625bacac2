"""Nearest neighbours without comparing everything with everything."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import AtomicType, DoubleType, IntegerType, StructField, StructType

from brackish.operators.ordered import Run, running
from brackish.session import cut_lineage

LEAF_ROWS = 32
_DEEPEST = 12
_KNOTS = 1024
_SPLIT = 4
GROUP_POINTS = 128  # points of a group, about
GROUP_SOURCES = 20_000  # sources a group may meet; beyond that its points walk one by one
CHUNK_POINTS = 50_000  # points of a group in one task
_CELLS_AT_ONCE = 1 << 21


def nearest_on_axis(left: DataFrame, right: DataFrame, left_value: str, right_value: str, right_id: str) -> DataFrame:
    """Nearest right row for each left row along one number; ties take the smaller id.

    Equal right values are reduced to their smallest id first; then both sides
    are laid on one axis and each left row sees its two neighbours.
    """
    distinct = right.where(F.col(right_value).isNotNull()).groupBy(right_value).agg(F.min(right_id).alias("_id"))
    row_type = "struct<" + ",".join(f"`{c}`:{t}" for c, t in left.dtypes) + ">"
    boxed = F.struct(F.col(right_value).cast("double").alias("v"), F.col("_id").alias("id"))
    rows = distinct.select(
        F.col(right_value).cast("double").alias("_at"), boxed.alias("_r"), F.lit(None).cast(row_type).alias("_row"),
        F.lit(0).alias("_side"),
    )
    r_type = dict(rows.dtypes)["_r"]
    wanted = left.select(
        F.col(left_value).cast("double").alias("_at"), F.lit(None).cast(r_type).alias("_r"),
        F.struct(*left.columns).alias("_row"), F.lit(1).alias("_side"),
    )
    sided = running(
        rows.unionByName(wanted), [], ["_at", "_side"],
        {"_b": Run("last", F.col("_r")), "_a": Run("next", F.col("_r"))},
    ).where("_side = 1")
    b, a, at = F.col("_b"), F.col("_a"), F.col("_at")
    db, da = at - b["v"], a["v"] - at
    below = a.isNull() | (db < da) | ((db == da) & (b["id"] < a["id"]))
    pick = F.when(at.isNotNull() & b.isNotNull() & below, b).when(at.isNotNull(), a)
    return sided.select("_row.*", pick["id"].alias(right_id), F.abs(at - pick["v"]).alias("distance"))


def _rank(value: Column, knots: Sequence[float]) -> Column:
    """Share of the sources below a value, linear between the knots; never falls, and stays below 1."""
    line = F.array(*[F.lit(float(k)) for k in knots])
    last = len(knots) - 1

    def step(found: Column, bit: Column) -> Column:
        ahead = found + F.call_function("shiftleft", F.lit(1), bit)
        return F.when(F.get(line, ahead) <= value, ahead).otherwise(found)

    bits = F.sequence(F.lit(last.bit_length() - 1), F.lit(0), F.lit(-1))
    at = F.least(F.aggregate(bits, F.lit(0), step), F.lit(last - 1))
    low, high = F.get(line, at), F.get(line, at + 1)
    inside = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(value - low, high - low), F.lit(0.0))))
    return F.least((at + inside) / last, F.lit(1.0 - 1e-12))


def nearest_of_few(choices: Sequence[tuple[str, Column]]) -> Column:
    """Struct (distance, name) of the smallest of a short fixed list; ties take the first listed."""
    entries = F.array(
        *[F.struct(d.alias("distance"), F.lit(i).alias("rank"), F.lit(n).alias("name")) for i, (n, d) in enumerate(choices)]
    )
    return F.array_min(F.filter(entries, lambda e: e["distance"].isNotNull()))


def _walk(asking: DataFrame, place: DataFrame, who: str, k: int, depth: int, cell_at) -> DataFrame:
    """(who, its box, _cell): cells of ``place`` at ``depth`` that may hold one of the ``k`` nearest of any place in the box.

    From the counts and tight bounds of the cells a box still considers follows a radius that holds ``k``
    sources wherever in the box one stands; cells farther than it are dropped.
    """
    box = ["_pw", "_pe", "_ps", "_pn"]
    candidates = asking
    for level in range(1, depth + 1):
        cells = place.groupBy(cell_at(level).alias("_child")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_sx").alias("_w"), F.max("_sx").alias("_e"),
            F.min("_sy").alias("_s"), F.max("_sy").alias("_nn"),
        )
        parent = F.struct(
            F.floor(F.col("_child.i") / _SPLIT).cast("long").alias("i"),
            F.floor(F.col("_child.j") / _SPLIT).cast("long").alias("j"),
        )
        if level == 1:  # at most sixteen cells: all are considered
            first = [
                F.struct(
                    F.struct(F.lit(r["_child"]["i"]).cast("long").alias("i"), F.lit(r["_child"]["j"]).cast("long").alias("j")).alias("_child"),
                    *[F.lit(r[c]).alias(c) for c in ("_n", "_w", "_e", "_s", "_nn")],
                )
                for r in cells.collect()
            ]
            opened = candidates.select("*", F.inline(F.array(*first)))
        else:
            opened = candidates.join(cells.withColumn("_cell", parent), "_cell")
        zero = F.lit(0.0)
        near_x = F.greatest(F.col("_w") - F.col("_pe"), F.col("_pw") - F.col("_e"), zero)
        near_y = F.greatest(F.col("_s") - F.col("_pn"), F.col("_ps") - F.col("_nn"), zero)
        far_x = F.greatest(F.abs(F.col("_pe") - F.col("_w")), F.abs(F.col("_e") - F.col("_pw")))
        far_y = F.greatest(F.abs(F.col("_pn") - F.col("_s")), F.abs(F.col("_nn") - F.col("_ps")))
        measured = opened.withColumns(
            {"_near": near_x * near_x + near_y * near_y, "_far": far_x * far_x + far_y * far_y}
        )
        outward = W.partitionBy(who).orderBy("_far").rowsBetween(W.unboundedPreceding, 0)
        held = measured.withColumn("_held", F.sum("_n").over(outward))
        radius = F.min(F.when(F.col("_held") >= k, F.col("_far"))).over(W.partitionBy(who))
        pruned = held.withColumn("_radius", radius).where(
            # Squares that differ in their last bits may have one root, and then ids decide.
            F.col("_radius").isNull() | (F.col("_near") <= F.col("_radius") * (1.0 + 1e-12))
        )
        candidates = pruned.select(who, *box, F.col("_child").alias("_cell"), F.col("_n").alias("_in_cell"))
        if level < depth:
            candidates = candidates.drop("_in_cell")
    return candidates


def _nearest_of_group(k: int, schema: pa.Schema):
    """Cogrouped: points of a group and all sources that may be near one of them, in; the ``k`` nearest of each point, out."""

    def run(points: pa.Table, sources: pa.Table) -> pa.Table:
        if not points.num_rows or not sources.num_rows:
            return schema.empty_table()
        sources = sources.take(pc.sort_indices(sources, sort_keys=[("_sid", "ascending")], null_placement="at_start"))
        sx, sy = sources.column("_sx").to_numpy(), sources.column("_sy").to_numpy()
        px, py = points.column("_px").to_numpy(), points.column("_py").to_numpy()
        most = min(k, len(sx))
        step = max(1, _CELLS_AT_ONCE // len(sx))
        who, which, away = [], [], []
        for at in range(0, len(px), step):
            dx, dy = sx - px[at : at + step, None], sy - py[at : at + step, None]
            distance = np.sqrt(dx * dx + dy * dy)
            # Ids ascend, so a stable order gives equal distances to the smaller id.
            limit = np.partition(distance, most - 1, axis=1)[:, most - 1]
            rows, found = np.nonzero(distance <= limit[:, None])
            near = distance[rows, found]
            order = np.lexsort((found, near, rows))
            rows, found, near = rows[order], found[order], near[order]
            rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
            kept = rank < most
            who.append(rows[kept] + at), which.append(found[kept]), away.append(near[kept])
        who, which, away = np.concatenate(who), np.concatenate(which), np.concatenate(away)
        rank = np.arange(len(who)) - np.searchsorted(who, who) + 1
        columns = [points.column("_pid").take(pa.array(who)), sources.column("_sid").take(pa.array(which)), pa.array(away), pa.array(rank, pa.int32())]
        return pa.Table.from_arrays([c.cast(t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return run


def k_nearest(
    points: DataFrame, sources: DataFrame, point_id: str, source_id: str, xy: tuple[str, str] = ("x", "y"),
    k: int = 1, leaf_rows: int = LEAF_ROWS, group_points: int = GROUP_POINTS,
) -> DataFrame:
    """The exact ``k`` nearest sources of each point: (point_id, source_id, distance, rank).

    Sources are counted in cells that shrink fourfold per level until the
    fullest one holds ``leaf_rows``.  Cells divide the ranks on each axis, taken from a bounded
    sketch, so that far or unset positions do not crowd all others into one cell.  Points are put into groups
    of about ``group_points`` by the cells they lie in.  Groups then walk down the levels: from the
    counts and tight bounds of the cells a group still considers follows a radius
    that must hold ``k`` sources, and cells farther than it are dropped.  Points of a group meet
    the sources of the cells that are left, so that each point is moved a fixed number of times.  Where these are too many
    (a dense cluster, or points far apart), and where ids of points repeat or are null, each point walks by itself, and only
    surviving leaf cells are opened.  A dense cluster therefore costs one cell per
    level until a point really is near it, and the number of candidates per point
    does not grow with the number of sources.  Sources at the very same place
    count as one leaf row with up to ``k`` smallest ids.
    """
    x, y = xy
    place = sources.select(F.col(source_id).alias("_sid"), F.col(x).cast("double").alias("_sx"), F.col(y).cast("double").alias("_sy"))
    place = place.where("_sx is not null and _sy is not null")
    shares = F.array(*[F.lit(i / _KNOTS) for i in range(_KNOTS + 1)])
    xs, ys, rows = place.agg(
        F.percentile_approx("_sx", shares, 100 * _KNOTS), F.percentile_approx("_sy", shares, 100 * _KNOTS), F.count(F.lit(1))
    ).first()
    # More than k sources on one spot can never all be needed.
    spot_rank = F.row_number().over(W.partitionBy("_sx", "_sy").orderBy("_sid"))
    place = place.withColumn("_spot", spot_rank).where(F.col("_spot") <= k).drop("_spot")
    wanted = points.select(
        F.col(point_id).alias("_pid"), F.col(x).cast("double").alias("_px"), F.col(y).cast("double").alias("_py")
    ).where("_px is not null and _py is not null")
    if xs is None:
        return wanted.limit(0).select(
            F.col("_pid").alias(point_id), F.lit(None).cast(dict(sources.dtypes)[source_id]).alias(source_id),
            F.lit(0.0).alias("distance"), F.lit(0).alias("rank"),
        )
    place = cut_lineage(place.withColumns({"_ux": _rank(F.col("_sx"), xs), "_uy": _rank(F.col("_sy"), ys)}))

    def cell_at(depth: int) -> Column:
        cells = float(_SPLIT**depth)
        return F.struct(F.floor(F.col("_ux") * cells).cast("long").alias("i"), F.floor(F.col("_uy") * cells).cast("long").alias("j"))

    # The fullest cell of every depth, from one job; beyond the depth that gives each source a cell little is gained.
    deepest = min(_DEEPEST, int(math.log(max(rows, 1), _SPLIT)) + 3)
    each = F.array(*[F.struct(F.lit(d).alias("d"), cell_at(d).alias("c")) for d in range(1, deepest + 1)])
    fullest = place.select(F.inline(each)).groupBy("d", "c").count().groupBy("d").agg(F.max("count").alias("n"))
    depth = min([r["d"] for r in fullest.where(F.col("n") <= leaf_rows).collect()], default=deepest)

    def one_by_one(alone: DataFrame) -> DataFrame:
        spot = [F.col(c).alias(n) for c, n in (("_px", "_pw"), ("_px", "_pe"), ("_py", "_ps"), ("_py", "_pn"))]
        candidates = _walk(alone.select("_pid", *spot), place, "_pid", k, depth, cell_at)
        dx, dy = F.col("_sx") - F.col("_pw"), F.col("_sy") - F.col("_ps")
        pairs = candidates.join(place.withColumn("_cell", cell_at(depth)), "_cell").withColumn("distance", F.sqrt(dx * dx + dy * dy))
        rank = F.row_number().over(W.partitionBy("_pid").orderBy("distance", "_sid"))
        return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("_pid", "_sid", "distance", "rank")

    def named(found: DataFrame) -> DataFrame:
        return found.select(F.col("_pid").alias(point_id), F.col("_sid").alias(source_id), "distance", "rank")

    # Groups are cells, sixteen times as many a level; numbers, text and times can be sorted in the tasks.
    groups_at = int(math.log(max(wanted.count() / group_points, 1.0), _SPLIT**2))
    plain = all(isinstance(df.schema[c].dataType, AtomicType) for df, c in ((place, "_sid"), (wanted, "_pid")))
    if groups_at < 1 or not plain:
        return named(one_by_one(wanted))
    ranked = wanted.withColumns({"_ux": _rank(F.col("_px"), xs), "_uy": _rank(F.col("_py"), ys)})
    often = F.count(F.lit(1)).over(W.partitionBy("_pid"))
    grouped = cut_lineage(ranked.select("_pid", "_px", "_py", cell_at(groups_at).alias("_group"), often.alias("_often")))
    lone = F.col("_pid").isNotNull() & (F.col("_often") == 1) & ~F.isnan("_px") & ~F.isnan("_py")
    boxes = grouped.where(lone).groupBy("_group").agg(
        F.min("_px").alias("_pw"), F.max("_px").alias("_pe"), F.min("_py").alias("_ps"), F.max("_py").alias("_pn"), F.count(F.lit(1)).alias("_points")
    )
    leaf = min(depth, groups_at + 1)
    reached = cut_lineage(_walk(boxes.drop("_points"), place, "_group", k, leaf, cell_at).select("_group", "_cell", "_in_cell"))
    light = reached.groupBy("_group").agg(F.sum("_in_cell").alias("_sources")).where(F.col("_sources") <= GROUP_SOURCES)
    chunks = light.join(boxes, "_group").select("_group", F.ceil(F.col("_points") / CHUNK_POINTS).cast("int").alias("_chunks"))
    told = cut_lineage(grouped.join(chunks, "_group", "left"))
    mine = lone & F.col("_chunks").isNotNull()
    chunk = F.pmod(F.xxhash64("_px", "_py", "_pid"), F.col("_chunks")).cast("int")
    near = reached.join(chunks, "_group").withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    offered = near.join(place.withColumn("_cell", cell_at(leaf)), "_cell").select("_group", "_chunk", "_sid", "_sx", "_sy")
    asked = told.where(mine).select("_group", chunk.alias("_chunk"), "_pid", "_px", "_py")
    kinds = StructType([
        StructField("_pid", asked.schema["_pid"].dataType), StructField("_sid", offered.schema["_sid"].dataType),
        StructField("distance", DoubleType()), StructField("rank", IntegerType()),
    ])
    by = lambda df: df.withColumns({"_i": F.col("_group.i"), "_j": F.col("_group.j")}).drop("_group").groupBy("_i", "_j", "_chunk")
    met = by(asked).cogroup(by(offered)).applyInArrow(_nearest_of_group(k, to_arrow_schema(kinds)), kinds)
    return named(met.unionByName(one_by_one(told.where(~mine).select("_pid", "_px", "_py"))))


def inverse_distance(
    neighbours: DataFrame, values: DataFrame, point_id: str, source_id: str, value: str,
    time: Sequence[str] = (), power: float = 2.0, exact: float = 1e-9,
) -> DataFrame:
    """Weighted value per point (and time) from ranked neighbours.

    Null source values drop out of the weights; a source at the point itself
    answers alone.
    """
    here = F.col("distance") < exact
    paired = neighbours.join(values, source_id)
    w = F.when(F.col(value).isNotNull(), 1.0 / F.pow(F.greatest(F.col("distance"), F.lit(exact)), F.lit(power)))
    out = paired.groupBy(point_id, *time).agg(
        F.max(F.when(here & (F.col("rank") == 1), F.lit(1))).alias("_hit"),
        F.max(F.when(here & (F.col("rank") == 1), F.col(value))).alias("_at"),
        F.sum(w * F.col(value)).alias("_num"),
        F.sum(w).alias("_den"),
    )
    return out.select(
        point_id, *time,
        F.when(F.col("_hit") == 1, F.col("_at")).otherwise(F.try_divide("_num", "_den")).alias(value),
    )


def nearest_known(
    points: DataFrame, sources: DataFrame, point_id: str, source_id: str, value: str, xy: tuple[str, str] = ("x", "y"), limit: float | None = None
) -> DataFrame:
    """Value of the nearest source that has one (not null, not NaN): (point_id, source_id, distance, value).

    With a ``limit`` a point that is farther than it from all known sources stops the job.
    """
    known = sources.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    found = k_nearest(points, known, point_id, source_id, xy)
    found = found if limit is None else refuse_far(found, limit)
    return found.select(point_id, source_id, "distance").join(known.select(source_id, value), source_id).select(point_id, source_id, "distance", value)


def refuse_far(neighbours: DataFrame, limit: float) -> DataFrame:
    """Stop the job where a point's nearest source is beyond the limit."""
    far = (F.col("rank") == 1) & (F.col("distance") > limit)
    message = F.concat(F.lit("nearest source beyond the limit: "), F.col("distance").cast("string"))
    return neighbours.withColumn("distance", F.when(far, F.raise_error(message).cast("double")).otherwise(F.col("distance")))


def spacing(sources: DataFrame, source_id: str, xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Distance of each source to its nearest other place."""
    spots = sources.groupBy(*xy).agg(F.min(source_id).alias(source_id))
    pairs = k_nearest(spots, spots.withColumnRenamed(source_id, "_other"), source_id, "_other", xy, k=2)
    return pairs.where(F.col(source_id) != F.col("_other")).groupBy(source_id).agg(F.min("distance").alias("spacing"))


def minimal_arc(df: DataFrame, keys: Sequence[str], lon: str) -> DataFrame:
    """Shortest eastward (start, stop) that holds all longitudes of a group.

    Longitudes are made distinct first, then each sees the next one east; the
    complement of the widest gap is the arc.
    """
    turned = df.where(F.col(lon).isNotNull()).select(*keys, F.pmod(F.col(lon), F.lit(360.0)).alias(lon)).distinct()
    east = running(turned, keys, [lon], {"_next": Run("lead", F.col(lon))})
    first = turned.groupBy(*keys).agg(F.min(lon).alias("_first"))
    met = east.join(first, list(keys))
    gap = F.coalesce("_next", F.col("_first") + 360.0) - F.col(lon)
    ends = F.struct(F.col(lon).alias("stop"), F.coalesce("_next", "_first").alias("start"))
    widest = met.groupBy(*keys).agg(F.min_by(ends, F.struct(-gap, F.col(lon))).alias("w"))
    stop = F.when(F.col("w.stop") < F.col("w.start"), F.col("w.stop") + 360.0).otherwise(F.col("w.stop"))
    return widest.select(*keys, F.col("w.start").alias("start"), stop.alias("stop"))


def far_from(points: DataFrame, primary: DataFrame, point_id: str, primary_id: str, tolerance: float, xy=("x", "y")) -> DataFrame:
    """Fallback points that no primary point lies within ``tolerance`` of."""
    near = k_nearest(points, primary, point_id, primary_id, xy).where(F.col("distance") <= tolerance)
    return points.join(near.select(point_id), point_id, "left_anti")
