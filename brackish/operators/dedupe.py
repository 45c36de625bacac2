"""Choosing one record per identity, and saying what was not chosen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brackish.operators.ordered import Run, plan_slices, running


# Why a candidate was not chosen.
SAME_RANK, LOWER_RANK = "same_rank_identical_remote_metadata", "lower_archive_or_layout_preference"


def best_per_key(df: DataFrame, keys: Sequence[str], preference: Sequence[Column]) -> DataFrame:
    """The first row of each key in preference order (which must be total).

    A row number kept at 1 is limited inside every map task before the shuffle,
    so a key with a third of all rows sends one row per task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*preference))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: Sequence[str], preference: Sequence[Column], k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*preference))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def rank_conflicts(
    df: DataFrame, keys: Sequence[str], rank: Column, identity: Sequence[Column], name: str
) -> DataFrame:
    """One verdict per key over its best-ranked candidates (highest ``rank``).

    Several identical candidates are fine and the smallest name wins; candidates
    that differ, or whose identity is unknown, are a conflict.  Two aggregations:
    first per rank, then over ranks, so no group is gathered.
    """
    tag = F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("?")) for c in identity]), 256)
    known = None
    for c in identity:
        known = c.isNotNull() if known is None else known & c.isNotNull()
    per_rank = (
        df.select(*keys, rank.alias("_rank"), F.col(name).alias("_name"), tag.alias("_tag"), known.alias("_known"))
        .groupBy(*keys, "_rank")
        .agg(
            F.count(F.lit(1)).alias("winners"),
            F.min("_name").alias("preferred"),
            F.min("_tag").alias("_t1"),
            F.max("_tag").alias("_t2"),
            F.bool_and("_known").alias("_known"),
        )
    )
    verdict = (
        F.when(F.col("_best.winners") == 1, "single")
        .when(F.col("_best._known") & (F.col("_best._t1") == F.col("_best._t2")), "identical")
        .otherwise("conflict")
    )
    boxed = F.struct("winners", "preferred", "_t1", "_t2", "_known")
    return (
        per_rank.groupBy(*keys)
        .agg(F.max_by(boxed, "_rank").alias("_best"), F.sum("winners").alias("candidates"))
        .select(
            *keys,
            "candidates",
            F.col("_best.winners").alias("winners"),
            F.col("_best.preferred").alias("preferred"),
            verdict.alias("verdict"),
        )
    )


def refuse_conflicts(verdicts: DataFrame) -> DataFrame:
    """Stop the job at a conflict instead of picking."""
    stop = F.raise_error(F.concat(F.lit("same-rank conflict at "), F.col("preferred")))
    return verdicts.withColumn("verdict", F.when(F.col("verdict") == "conflict", stop.cast("string")).otherwise(F.col("verdict")))


def rejected_candidates(df: DataFrame, verdicts: DataFrame, keys: Sequence[str], rank: Column, name: str) -> DataFrame:
    """Candidates that lost, with the reason and the name that won."""
    best = df.groupBy(*keys).agg(F.max(rank).alias("_top"))
    judged = df.join(best, list(keys)).join(verdicts.select(*keys, "preferred"), list(keys))
    same = rank == F.col("_top")
    reason = F.when(same, SAME_RANK).otherwise(LOWER_RANK)
    return judged.where(F.col(name) != F.col("preferred")).withColumn("reason", reason).drop("_top")


def covering_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[str]) -> DataFrame:
    """Intervals that add something to those before them (oldest first).

    Ordered by start, an interval [start, end) is needless exactly when an
    earlier one already reaches its end, so the greedy walk is a running maximum.
    """
    slices = plan_slices(df, start)
    reach = running(df, keys, [start, *order], {"_reach": Run("max", F.col(end))}, slices)
    before = running(reach, keys, [start, *order], {"_before": Run("lag", F.col("_reach"))}, slices)
    adds = F.col("_before").isNull() | (F.col(end) > F.col("_before"))
    return before.withColumn("adds", adds).drop("_reach", "_before")


def earliest_source(df: DataFrame, keys: Sequence[str], time: str, source_order: Sequence[Column]) -> DataFrame:
    """Series records: at a doubled time the earliest source owns it."""
    return best_per_key(df, [*keys, time], source_order)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def singletons(df: DataFrame, keys: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Rows alone in their group; an aggregate keeps the one row, nothing is gathered."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in carry])
        .where("_n = 1")
        .drop("_n")
    )
