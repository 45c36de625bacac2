"""Exact quantiles that never gather a group.

Spark's exact ``percentile`` keeps every distinct value of a group in one task's
memory.  Beyond a size it is replaced here by: a bounded sketch brackets each
wanted rank, one counting pass finds how many values lie below the bracket, and
only values inside the bracket (a few per 100,000) are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brackish.operators import ordered
from brackish.session import cut_lineage

ACCURACY = 100_000


def with_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    probabilities: Sequence[float],
    out: str = "quantiles",
    nearest_rank: bool = False,
    rows_per_task: int | None = None,
    accuracy: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """One row per group with an array of quantiles; nulls are left out.

    Linear interpolation between ranks, or the nearest rank (``ceil(p * n)``).
    ``rows`` is an upper bound on the input when the caller knows one; without it
    the rows are counted, which for a stored table reads only its footers.
    """
    rows_per_task, accuracy = rows_per_task or ordered.ROWS_PER_TASK, accuracy or ACCURACY
    narrow = df.select(*keys, value.cast("double").alias("_v"))
    if (df.count() if rows is None else rows) <= rows_per_task:
        if nearest_rank:
            each = [F.expr(f"percentile_disc({p!r}) within group (order by _v)") for p in probabilities]
            return narrow.groupBy(*keys).agg(F.array(*each).alias(out))
        return narrow.groupBy(*keys).agg(F.percentile("_v", F.array(*map(F.lit, probabilities))).alias(out))
    return _bracketed(narrow, list(keys), list(probabilities), out, nearest_rank, accuracy)


def _bracketed(df, keys, probabilities, out, nearest_rank, accuracy) -> DataFrame:
    margin = 4.0 / accuracy
    wanted = [b for p in probabilities for b in (max(p - margin, 0.0), min(p + margin, 1.0))]
    n = F.col("_n")
    grouped = df.withColumn("_g", F.struct(*keys) if keys else F.struct(F.lit(0).alias("all")))
    values = grouped.where(F.col("_v").isNotNull()).select("_g", "_v")
    sketch = cut_lineage(values.groupBy("_g").agg(
        F.count("_v").alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", F.array(*map(F.lit, wanted)), accuracy).alias("_b"),
    ))
    small = n <= accuracy

    def rank(p):
        if nearest_rank:
            first = F.greatest(F.lit(0), F.ceil(F.lit(p) * n) - 1).cast("long")
            return first, first, F.lit(0.0)
        at = F.lit(p) * (n - 1)
        low = F.floor(at).cast("long")
        return low, F.ceil(at).cast("long"), at - low

    def bracket(i, p):
        # The ends of the range need no margin beyond the smallest and largest value.
        low = F.col("_min") if p - margin <= 0 else F.col("_b")[2 * i]
        high = F.col("_max") if p + margin >= 1 else F.col("_b")[2 * i + 1]
        return F.struct(F.lit(i).alias("i"), low.alias("low"), high.alias("high"))

    # A group no larger than the sketch is ranked whole, once for all ranks (i = -1).
    whole = F.array(F.struct(F.lit(-1).alias("i"), F.col("_min").alias("low"), F.col("_max").alias("high")))
    split = F.array(*[bracket(i, p) for i, p in enumerate(probabilities)])
    brackets = sketch.select("_g", "_n", F.when(small, whole).otherwise(split).alias("_k"))
    # Of groups larger than the sketch there is one per ``accuracy`` rows at most: their brackets are sent to the
    # values, so that no group of any size is moved or sorted whole.  The values of the other groups meet by shuffle.
    large = F.broadcast(brackets.where(~small))
    placed = values.join(large, "_g")
    lows = [F.count_if(F.col("_v") < F.get("_k", F.lit(i))["low"]) for i in range(len(probabilities))]
    below = placed.groupBy("_g").agg(F.array(*lows).alias("_below"))
    rest = values.join(F.broadcast(brackets.where(~small).select("_g")), "_g", "left_anti").join(brackets.where(small), "_g")
    inside = (
        placed.unionByName(rest).select("_g", "_v", "_n", F.explode("_k").alias("k"))
        .where(F.col("_v").between(F.col("k.low"), F.col("k.high")))
        .groupBy("_g", "_v", "_n", F.col("k.i").alias("i"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    upto = W.partitionBy("_g", "i").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = inside.withColumn("upto", F.sum("c").over(upto)).join(below, "_g", "left")
    under = F.when(F.col("i") >= 0, F.get("_below", F.col("i"))).otherwise(F.lit(0))
    ranked = ranked.withColumn("end", F.coalesce(under, F.lit(0)) + F.col("upto"))
    found = []
    for i, p in enumerate(probabilities):
        first, last, share = rank(p)
        mine = F.col("i").isin(i, -1)
        low = F.min(F.when(mine & (F.col("end") > first), F.col("_v")))
        high = F.min(F.when(mine & (F.col("end") > last), F.col("_v")))
        found += [low.alias(f"lo{i}"), high.alias(f"hi{i}"), F.max(share.cast("double")).alias(f"sh{i}")]
    picked = ranked.groupBy("_g").agg(*found)
    line = lambda i: F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"sh{i}")
    result = picked.select("_g", F.array(*map(line, range(len(probabilities)))).alias(out))
    if keys:
        everyone = grouped.select("_g").distinct()
        return everyone.join(result, "_g", "left").select(*[F.col("_g")[k].alias(k) for k in keys], out)
    # Without a key there is one row, as from an aggregate, also where no value is known.
    one = df.sparkSession.range(1).select(F.struct(F.lit(0).alias("all")).alias("_g"))
    return one.join(result, "_g", "left").select(out)
