"""Repeatable samples and reports of the largest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def stratified_sample(df: DataFrame, strata: Sequence[str], identity: str, size: int) -> DataFrame:
    """Round-robin over strata in key order, inside each by the hash of the identity.

    Independent of input order.  No stratum can contribute more than ``size``
    rows, so each is cut to that inside the map tasks before the shuffle.
    """
    tag = F.sha2(F.col(identity).cast("string"), 256)
    inside = F.row_number().over(W.partitionBy(*strata).orderBy(tag, F.col(identity)))
    ranked = df.withColumn("turn", inside).where(F.col("turn") <= size)
    return ranked.orderBy("turn", *strata).limit(size)


def conservative_bytes(sample: DataFrame, size: str, total_rows: int) -> DataFrame:
    """Bytes of the whole from sampled sizes: the larger of the nearest-rank p95 and the maximum, times all rows.

    The sample is bounded by its own size, so one exact percentile is safe.
    """
    return sample.agg(
        F.count(size).alias("files_probed"),
        F.expr(f"percentile_disc(0.95) within group (order by `{size}`)").cast("long").alias("sample_p95"),
        F.max(size).alias("sample_max"),
    ).withColumn("conservative_bytes", F.greatest("sample_p95", "sample_max") * F.lit(total_rows))


def largest(df: DataFrame, value: Column, tie: Sequence[str], k: int) -> DataFrame:
    """Top ``k`` by value, ties by ascending ``tie``."""
    return df.orderBy(value.desc_nulls_last(), *tie).limit(k)


def evenly_spaced(df: DataFrame, keys: Sequence[str], index: str, count: str, k: int) -> DataFrame:
    """Rows at ``k`` evenly spaced positions (0-based ``index`` of ``count``), ends included."""
    i, n = F.col(index), F.col(count)
    most = F.least(F.lit(k), n)
    spots = F.transform(
        F.sequence(F.lit(0), most - 1),
        lambda j: F.when(most > 1, F.rint(j * (n - 1) / (most - 1))).otherwise(F.lit(0.0)).cast("long"),
    )
    return df.where(F.array_contains(spots, i.cast("long")))


def preferred_tier(df: DataFrame, tier: str, order: Sequence[str], most: int) -> DataFrame:
    """Rows of the first tier in ``order`` that has between 1 and ``most`` rows."""
    rank = F.array_position(F.array(*[F.lit(t) for t in order]), F.col(tier))
    counted = df.groupBy(tier).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") <= most) & (rank > 0))
    first = counted.agg(F.min_by(tier, rank).alias(tier))
    return df.join(first, tier, "left_semi")
