"""Layer weights and averages over a water column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brackish.operators.series import interpolate_at


def layer_top_weights(df: DataFrame, column: Sequence[str], sigma: str) -> DataFrame:
    """Thickness from each layer top to the next (the last to 1), summing to 1."""
    down = W.partitionBy(*column).orderBy(sigma)
    thick = df.withColumn("_t", F.lead(sigma, 1).over(down))
    thick = thick.withColumn("_t", F.coalesce("_t", F.lit(1.0)) - F.col(sigma))
    return thick.withColumn("weight", F.try_divide("_t", F.sum("_t").over(W.partitionBy(*column)))).drop("_t")


def trapezoid_weights(df: DataFrame, column: Sequence[str], sigma: str) -> DataFrame:
    """Half the distance between the neighbours of each point, summing to 1."""
    down = W.partitionBy(*column).orderBy(sigma)
    s = F.col(sigma)
    sided = df.withColumns({"_a": F.lag(sigma).over(down), "_b": F.lead(sigma).over(down)})
    sided = sided.withColumn("_t", (F.coalesce("_b", s) - F.coalesce("_a", s)) / 2.0)
    return sided.withColumn("weight", F.try_divide("_t", F.sum("_t").over(W.partitionBy(*column)))).drop("_a", "_b", "_t")


def interface_thickness(df: DataFrame, column: Sequence[str], level: str, interface: str) -> DataFrame:
    """Absolute distance between an interface and the one before it; not normalised."""
    down = W.partitionBy(*column).orderBy(level)
    return df.withColumn("weight", F.abs(F.col(interface) - F.lag(interface).over(down)))


def weighted_mean(df: DataFrame, column: Sequence[str], value: Column, weight: Column, wet: Column | None = None) -> DataFrame:
    """Mean over layers, renormalised over those with a value and a positive weight.

    Two sums per water column, so columns of any height combine map-side.
    """
    counts = value.isNotNull() & weight.isNotNull() & (weight > 0)
    mean = F.try_divide(F.sum(F.when(counts, value * weight)), F.nullif(F.sum(F.when(counts, weight)), F.lit(0.0)))
    if wet is not None:
        mean = F.when(F.bool_and(wet), mean)
    return df.groupBy(*column).agg(mean.alias("mean"), F.count_if(counts).alias("layers"))


def pick_layer(df: DataFrame, column: Sequence[str], sigma: str, view: str, by_size: bool = True) -> DataFrame:
    """The surface, near-surface, bottom or ``index:N`` layer of each water column."""
    order = F.abs(F.col(sigma)) if by_size else F.col(sigma)
    if view.startswith("index:"):
        place = F.row_number().over(W.partitionBy(*column).orderBy(F.col("layer")))
        return df.withColumn("_r", place).where(F.col("_r") == int(view.split(":", 1)[1]) + 1).drop("_r")
    if view == "bottom":
        place = F.row_number().over(W.partitionBy(*column).orderBy(order.desc(), F.col("layer")))
        return df.withColumn("_r", place).where("_r = 1").drop("_r")
    if view == "surface":
        place = F.row_number().over(W.partitionBy(*column).orderBy(order, F.col("layer")))
        return df.withColumn("_r", place).where("_r = 1").drop("_r")
    if view == "near_surface":
        place = F.row_number().over(W.partitionBy(*column).orderBy(order, F.col("layer")))
        two = df.withColumn("_r", place).where("_r <= 2")
        back = F.row_number().over(W.partitionBy(*column).orderBy(F.col("_r").desc()))
        return two.withColumn("_q", back).where("_q = 1").drop("_r", "_q")
    raise ValueError("unknown layer view " + view)


def layer_views(df: DataFrame, column: Sequence[str], sigma: str, layer: str) -> DataFrame:
    """Surface, near-surface and bottom layer of every column, from one sort of it."""
    place = F.row_number().over(W.partitionBy(*column).orderBy(F.abs(F.col(sigma)), layer))
    at = lambda n: F.max(F.when(F.col("_r") == n, F.col(layer)))
    return df.withColumn("_r", place).groupBy(*column).agg(
        at(1).alias("surface"), F.coalesce(at(2), at(1)).alias("near_surface"), F.max_by(layer, "_r").alias("bottom")
    )


def depth_to_sigma(values: DataFrame, targets: DataFrame, column: Sequence[str], depth: str, value: str, out: str = "value") -> DataFrame:
    """Values on fixed depths carried to other depths of the same column, ends held."""
    return interpolate_at(targets, values, column, depth, value, out, hold_ends=True)


def sigma_report(layers: DataFrame, levels: DataFrame, column: Sequence[str], tolerance: float = 1e-3) -> DataFrame:
    """Per column: is the sigma axis usable, which way does it run, and what is wrong?

    ``levels`` holds (level, siglev), ``layers`` (layer, siglay); layer n lies
    between levels n and n+1.
    """
    down = W.partitionBy(*column).orderBy("level")
    step = levels.withColumns({"_prev": F.lag("siglev").over(down), "_d": F.col("siglev") - F.lag("siglev").over(down)})
    lev = step.groupBy(*column).agg(
        F.count(F.lit(1)).alias("n_levels"),
        F.bool_or(F.col("siglev").isNull()).alias("_gap"),
        F.bool_or(~F.col("siglev").between(-1 - tolerance, tolerance)).alias("_out"),
        F.bool_and(F.coalesce(F.col("_d") > 0, F.col("_prev").isNull())).alias("_up"),
        F.bool_and(F.coalesce(F.col("_d") < 0, F.col("_prev").isNull())).alias("_down"),
        F.max("siglev").alias("_top"),
        F.min("siglev").alias("_bottom"),
    )
    between = step.where("_prev is not null").select(
        *column, (F.col("level") - 1).alias("layer"),
        F.least("_prev", "siglev").alias("_lo"), F.greatest("_prev", "siglev").alias("_hi"),
    )
    lay = (
        layers.join(between, [*column, "layer"], "left")
        .groupBy(*column)
        .agg(
            F.count(F.lit(1)).alias("n_layers"),
            F.bool_and(F.coalesce((F.col("siglay") > F.col("_lo")) & (F.col("siglay") < F.col("_hi")), F.lit(False))).alias("_nested"),
        )
    )
    problem = (
        F.when(F.col("n_levels") != F.col("n_layers") + 1, "count")
        .when(F.col("_gap"), "missing")
        .when(F.col("_out"), "range")
        .when(~F.col("_up") & ~F.col("_down"), "monotonic")
        .when((F.abs("_top") > tolerance) | (F.abs(F.col("_bottom") + 1) > tolerance), "endpoints")
        .when(~F.col("_nested"), "nesting")
    )
    way = F.when(F.col("_up"), "bottom_to_surface").when(F.col("_down"), "surface_to_bottom")
    return lev.join(lay, list(column)).select(*column, "n_layers", way.alias("orientation"), problem.alias("problem"))
