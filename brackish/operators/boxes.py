"""Area covered by overlapping boxes, for any number of boxes in a group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.session import cut_rounds

MOST = 256  # boxes that are swept together
LEAST = 16  # distinct boxes that may meet in one point, seen from near: no more splitting below
SPLIT = 4  # parts of a cell along each axis
DEEPEST = 24  # rounds of splitting; cells are then as small as a double can tell apart
SALTS = 32
_BOX, _CELL = ("_w", "_s", "_e", "_n"), ("_cw", "_cs", "_ce", "_cn")


def swept(w: np.ndarray, s: np.ndarray, e: np.ndarray, n: np.ndarray) -> float:
    """Area of the union of a few boxes: strips between all their ends, and what is covered of each."""
    xs, ys = np.unique(np.r_[w, e]), np.unique(np.r_[s, n])
    change = np.zeros((len(xs) + 1, len(ys) + 1), np.int32)
    a, b = np.searchsorted(xs, [w, e])
    c, d = np.searchsorted(ys, [s, n])
    for x, y, sign in ((a, c, 1), (b, c, -1), (a, d, -1), (b, d, 1)):
        np.add.at(change, (x, y), sign)
    covered = change.cumsum(axis=0).cumsum(axis=1)[: len(xs) - 1, : len(ys) - 1] > 0
    return float(np.diff(xs) @ (covered @ np.diff(ys)))


def _swept(cells: DataFrame) -> DataFrame:
    """(_group, area) of cells with few boxes."""

    def run(batches):
        for batch in batches:
            members = batch.column("boxes")
            flat, ends = members.flatten(), np.cumsum(np.asarray(members.value_lengths()))
            sides = [np.asarray(flat.field(c)) for c in _BOX]
            areas = [swept(*(side[a:b] for side in sides)) for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_group"), pa.array(areas, pa.float64())], ["_group", "area"])

    boxed = cells.groupBy("_group", "_cell").agg(F.collect_list(F.struct(*_BOX)).alias("boxes")).select("_group", "boxes")
    return boxed.mapInArrow(run, boxed.select("_group").schema.add("area", "double"))


def _split(parts: DataFrame) -> DataFrame:
    """The boxes of each cell, cut along its parts."""
    width, height = (F.col("_ce") - F.col("_cw")) / SPLIT, (F.col("_cn") - F.col("_cs")) / SPLIT
    places = F.sequence(F.lit(0), F.lit(SPLIT - 1))
    # The last part ends where the cell does, and each starts where the one before ends.
    edge = lambda low, high, step, k: F.when(k >= SPLIT, F.col(high)).otherwise(F.col(low) + step * k)
    across = parts.withColumn("_i", F.explode(places)).withColumns({"_x0": edge("_cw", "_ce", width, F.col("_i")), "_x1": edge("_cw", "_ce", width, F.col("_i") + 1)})
    across = across.where((F.col("_w") < F.col("_x1")) & (F.col("_e") > F.col("_x0")))
    both = across.withColumn("_j", F.explode(places)).withColumns({"_y0": edge("_cs", "_cn", height, F.col("_j")), "_y1": edge("_cs", "_cn", height, F.col("_j") + 1)})
    both = both.where((F.col("_s") < F.col("_y1")) & (F.col("_n") > F.col("_y0")))
    return both.select(
        "_group", F.concat("_cell", F.array((F.col("_i") * SPLIT + F.col("_j")).cast("byte"))).alias("_cell"),
        F.col("_x0").alias("_cw"), F.col("_y0").alias("_cs"), F.col("_x1").alias("_ce"), F.col("_y1").alias("_cn"),
        F.greatest("_w", "_x0").alias("_w"), F.greatest("_s", "_y0").alias("_s"), F.least("_e", "_x1").alias("_e"), F.least("_n", "_y1").alias("_n"),
    ).distinct()


def union_area(boxes: DataFrame, keys: Sequence[str], box: Sequence[str | Column], most: int | None = None) -> DataFrame:
    """``keys`` and ``area``: what the boxes (west, south, east, north) of each group cover, overlaps counted once.

    A group starts as one cell.  A cell that one box covers wholly is done, one with up to ``most`` boxes is
    swept by a task, and any other is split in 16, with its boxes cut to the parts: so no task gathers a crowded
    place, and boxes larger than a cell are not carried further down.  Boxes with a null or non-finite
    side, or without extent, cover nothing; a group of such boxes only is not listed.
    """
    most = max(LEAST, most or MOST)
    sides = [(c if isinstance(c, Column) else F.col(c)).cast("double").alias(name) for c, name in zip(box, _BOX, strict=True)]
    w, s, e, n = (F.col(c) for c in _BOX)
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    proper = boxes.select(group.alias("_group"), *sides).where((w < e) & (s < n) & (F.greatest(F.abs(w), F.abs(s), F.abs(e), F.abs(n)) < float("inf"))).distinct()
    bounds = proper.groupBy("_group").agg(F.min("_w").alias("_cw"), F.min("_s").alias("_cs"), F.max("_e").alias("_ce"), F.max("_n").alias("_cn"))
    salted = proper.withColumn("_salt", F.pmod(F.xxhash64(*_BOX), F.lit(SALTS)))
    laid = bounds.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    parts = salted.join(laid, ["_group", "_salt"]).drop("_salt").withColumn("_cell", F.array().cast("array<byte>"))
    whole = (w <= F.col("_cw")) & (e >= F.col("_ce")) & (s <= F.col("_cs")) & (n >= F.col("_cn"))
    found = None
    for depth in range(DEEPEST + 1):
        parts = cut_rounds(parts)
        facts = parts.groupBy("_group", "_cell").agg(
            F.count(F.lit(1)).alias("_boxes"), F.bool_or(whole).alias("_full"), F.first((F.col("_ce") - F.col("_cw")) * (F.col("_cn") - F.col("_cs"))).alias("area")
        )
        facts = cut_rounds(facts)
        large = ~F.col("_full") & (F.col("_boxes") > most) & F.lit(depth < DEEPEST)
        laid = facts.where(~F.col("_full")).select("_group", "_cell", large.alias("_large"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
        told = parts.withColumn("_salt", F.pmod(F.xxhash64(*_BOX), F.lit(SALTS))).join(laid, ["_group", "_cell", "_salt"]).drop("_salt")
        areas = facts.where("_full").select("_group", "area").unionByName(_swept(told.where(~F.col("_large"))))
        found = areas if found is None else found.unionByName(areas)
        if facts.where(large).isEmpty():
            break
        parts = _split(told.where("_large"))
    return found.groupBy("_group").agg(F.sum("area").alias("area")).select(*[F.col(f"_group.{k}").alias(k) for k in keys], "area")


def coverage(boxes: DataFrame, keys: Sequence[str], box: Sequence[str], request: Sequence[float]) -> DataFrame:
    """``keys`` and ``fraction``: the share of a request box (west, south, east, north) that the boxes of a group cover."""
    west, south, east, north = map(float, request)
    w, s, e, n = (F.col(c).cast("double") for c in box)
    cut = [F.greatest(w, F.lit(west)), F.greatest(s, F.lit(south)), F.least(e, F.lit(east)), F.least(n, F.lit(north))]
    whole = (east - west) * (north - south)
    return union_area(boxes, keys, cut).withColumn("fraction", F.col("area") / F.lit(whole)).drop("area")
