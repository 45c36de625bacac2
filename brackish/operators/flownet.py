"""Stream networks: orientation, connection and ordering of line arcs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.functions.hydrology import channel_class
from brackish.operators.graph import path_order
from brackish.operators.ordered import Run, plan_slices, running
from brackish.session import cut_lineage

ABSOLUTE_CELLS, RELATIVE_CELLS, ELEVATION_TOLERANCE = 1e-6, 1e-12, 1e-6  # fixed values


def orientation(acc_a: Column, acc_b: Column, elev_a: Column, elev_b: Column) -> tuple[Column, Column]:
    """(reversed, method): water runs to more accumulation, or down where that ties."""
    measured = acc_a.isNotNull() & acc_b.isNotNull()
    levelled = elev_a.isNotNull() & elev_b.isNotNull() & (F.abs(elev_a - elev_b) > ELEVATION_TOLERANCE)
    levelled = F.coalesce(levelled, F.lit(False))
    tolerance = F.greatest(
        F.lit(ABSOLUTE_CELLS), F.greatest(F.lit(1.0), F.abs(acc_a), F.abs(acc_b)) * RELATIVE_CELLS
    )
    differs = measured & (F.abs(acc_b - acc_a) > tolerance)
    method = (
        F.when(differs, "accumulation_primary")
        .when(measured & levelled, "accumulation_tie_elevation_fallback")
        .when(measured, "accumulation_tie_raw_fallback")
        .when(levelled, "invalid_accumulation_elevation_fallback")
        .otherwise("invalid_accumulation_raw_fallback")
    )
    turned = F.when(differs, acc_a > acc_b).when(levelled, elev_a < elev_b).otherwise(F.lit(False))
    return turned, method


def oriented(lines: DataFrame) -> DataFrame:
    """Lines (line, x1, y1, x2, y2, length, acc1, acc2, elev1, elev2) turned downstream."""
    turned, method = orientation(F.col("acc1"), F.col("acc2"), F.col("elev1"), F.col("elev2"))
    marked = lines.withColumns({"reversed": turned, "method": method})
    swap = lambda p, q: F.when(F.col("reversed"), F.col(q)).otherwise(F.col(p))
    pairs = [("x1", "x2"), ("y1", "y2"), ("acc1", "acc2"), ("elev1", "elev2")]
    others = [c for c in marked.columns if c not in {n for pair in pairs for n in pair}]
    return marked.select(*others, *[swap(p, q).alias(p) for p, q in pairs], *[swap(q, p).alias(q) for p, q in pairs])


def connect(lines: DataFrame, cell_area_m2: float, tolerance_m: float) -> DataFrame:
    """Arcs numbered by geometry (not input order), joined at nodes, with routing and class.

    An arc whose end meets several others is left unrouted (-1).
    """
    key = lambda x, y: F.struct(F.rint(F.col(x) / tolerance_m).alias("kx"), F.rint(F.col(y) / tolerance_m).alias("ky"))
    keyed = lines.withColumns(
        {"_from": key("x1", "y1"), "_to": key("x2", "y2"), "_len6": F.round("length", 6), "_kx": F.rint(F.col("x1") / tolerance_m)}
    )
    cut = plan_slices(keyed, "_kx")
    arcs = running(keyed, [], ["_kx", "_from", "_to", "_len6", "x1", "y1", "x2", "y2"], {"arcid": Run("row_index")}, cut)
    # Everything below joins the numbered arcs to themselves: number them once.
    arcs = cut_lineage(arcs)
    ends = arcs.select(F.inline(F.array(
        F.struct(F.col("_from").alias("key"), (F.col("arcid") * 2).alias("at")),
        F.struct(F.col("_to").alias("key"), (F.col("arcid") * 2 + 1).alias("at")),
    ))).groupBy("key").agg(F.min("at").alias("at"))
    nodes = running(ends, [], ["at"], {"node": Run("row_index")}).select("key", "node")
    arcs = arcs.join(nodes.select(F.col("key").alias("_from"), F.col("node").alias("from_node")), "_from")
    arcs = arcs.join(nodes.select(F.col("key").alias("_to"), F.col("node").alias("to_node")), "_to")
    cells = F.greatest(F.lit(0), F.rint(F.coalesce("acc2", F.lit(0.0)))).cast("long")
    drop = F.greatest(F.lit(0.0), F.coalesce(F.col("elev1") - F.col("elev2"), F.lit(0.0)))
    length = F.greatest("length", F.lit(0.001))
    arcs = arcs.withColumns({"cells": cells, "slope": F.greatest(drop / length, F.lit(0.00001))})

    starts = arcs.groupBy(F.col("from_node").alias("to_node")).agg(F.count(F.lit(1)).alias("_n"), F.min("arcid").alias("_next"))
    above = arcs.groupBy(F.col("to_node").alias("from_node")).agg(
        F.max_by("arcid", F.struct("cells", -F.col("arcid"))).alias("_up"), F.sum("cells").alias("_sum")
    )
    routed = arcs.join(starts, "to_node", "left").join(above, "from_node", "left")
    routed = routed.withColumns(
        {
            "downarc": F.when(F.col("_n") == 1, F.col("_next")).otherwise(F.lit(-1)).cast("long"),
            "uparc": F.coalesce("_up", F.lit(-1)).cast("long"),
            "local": F.greatest(F.lit(0), F.col("cells") - F.coalesce("_sum", F.lit(0))),
        }
    )
    area = (F.col("cells") + F.col("local") / 2.0) * cell_area_m2
    routed = routed.withColumns({"meanmsq": area, "drainage_area_m2": F.col("cells") * F.lit(float(cell_area_m2))})
    return routed.withColumn("channel", channel_class(F.col("slope"), F.col("meanmsq"))).drop(
        "_from", "_to", "_len6", "_kx", "_n", "_next", "_up", "_sum"
    )


def ordered_network(arcs: DataFrame) -> DataFrame:
    """Adds the longest-upstream-path order."""
    arcs = cut_lineage(arcs)
    order = path_order(arcs.select("arcid", F.when(F.col("downarc") > 0, F.col("downarc")).alias("down")), "arcid", "down")
    return arcs.join(order, "arcid")


def network_checks(arcs: DataFrame) -> DataFrame:
    """Counts of what a sound network must not have, and of its ends."""
    below = arcs.select(F.col("arcid").alias("downarc"), F.col("path_order").alias("_below"))
    met = arcs.join(below, "downarc", "left")
    points = F.col("downarc") != -1
    return met.agg(
        F.count(F.lit(1)).alias("arcs"),
        F.count_if(F.col("uparc") == -1).alias("headwaters"),
        F.count_if(~points).alias("terminals"),
        F.count_if(points & F.col("_below").isNull()).alias("invalid_references"),
        F.count_if(F.col("path_order") < 1).alias("unordered"),
        F.count_if(points & (F.col("_below") <= F.col("path_order"))).alias("order_errors"),
    )


def network_lines(arcs: DataFrame) -> DataFrame:
    """Fixed-width text rows."""
    row = F.format_string(
        "%5d %3d %11.5f %17.5f %3d %7d",
        F.col("arcid"), F.col("path_order"), F.col("slope"), F.col("length"), F.col("channel.chanclass"), F.col("downarc"),
    )
    return arcs.select("arcid", row.alias("line"))
