"""Data-quality frames: completeness, coverage, monotony, gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.functions.timeaxis import micros
from brackish.operators.ordered import Run, running
from brackish.operators.series import cadence


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, known values and their fraction.  One scan."""
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("known")) for c in columns])
    return counted.select(F.inline(rows), F.col("_n").alias("n_rows")).withColumn(
        "fraction", F.try_divide(F.col("known").cast("double"), F.col("n_rows").cast("double"))
    )


def frame_coverage(df: DataFrame, frame: Sequence[str], value: Column, wet: Column | None = None) -> DataFrame:
    """Known fraction of the wet values of each frame."""
    counts = F.lit(True) if wet is None else F.coalesce(wet, F.lit(False))
    return df.groupBy(*frame).agg(
        F.count_if(counts).alias("n_wet"),
        F.count_if(counts & value.isNotNull()).alias("n_known"),
        F.min(F.when(counts, value)).alias("low"),
        F.max(F.when(counts, value)).alias("high"),
    ).withColumn("coverage", F.try_divide(F.col("n_known").cast("double"), F.col("n_wet").cast("double")))


def coverage_gate(coverage: DataFrame, keys: Sequence[str] = (), threshold: float = 0.95) -> DataFrame:
    """Does every frame reach the threshold?"""
    return coverage.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"),
        F.count_if(F.col("n_known") == 0).alias("empty_frames"),
        F.min("coverage").alias("worst"),
        F.bool_and(F.coalesce(F.col("coverage") >= threshold, F.lit(False))).alias("passed"),
    )


def time_health(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Known fraction, strict order as delivered (``seq``), and time span of each series."""
    stepped = running(df, keys, ["seq"], {"_prev": Run("lag", F.col(time))})
    return stepped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.count(value).cast("double"), F.count(F.lit(1)).cast("double")).alias("known_fraction"),
        F.bool_and(F.coalesce(F.col(time) > F.col("_prev"), F.lit(True))).alias("increasing"),
        F.min(time).alias("first"),
        F.max(time).alias("last"),
    )


def window_covered(df: DataFrame, keys: Sequence[str], time: str, start: Column, end: Column) -> DataFrame:
    """Does each series begin by ``start`` and reach ``end`` within one median step?"""
    span = df.groupBy(*keys).agg(F.min(time).alias("first"), F.max(time).alias("last"))
    joined = span.join(cadence(df, keys, time), list(keys))
    reach = micros(F.col("last")) + F.coalesce("cadence_us", F.lit(0))
    return joined.withColumn("covered", (F.col("first") <= start) & (reach >= micros(end)))


def plausible_range(df: DataFrame, name: str, value: str, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Observed range per variable, with a warning outside the limits of its name prefix."""
    ranged = df.groupBy(name).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    warning = None
    for prefix, (low, high) in limits.items():
        test = F.startswith(F.col(name), F.lit(prefix)) & ((F.col("low") < low) | (F.col("high") > high))
        text = F.concat(F.col(name), F.lit(" outside the plausible range"))
        warning = F.when(test, text) if warning is None else warning.when(test, text)
    return ranged.withColumn("warning", warning)


def missing_references(children: DataFrame, parents: DataFrame, reference: str, key: str) -> DataFrame:
    """Child rows that point to a parent that is not there."""
    return children.join(parents.select(F.col(key).alias(reference)), reference, "left_anti")


def unstable_attributes(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Keys whose attributes differ between records (geometry drift)."""
    changed = [F.min(c).eqNullSafe(F.max(c)).alias("_" + c) for c in attributes]
    drift = None
    for c in attributes:
        test = ~F.col("_" + c)
        drift = test if drift is None else drift | test
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *changed).where(drift).select(key, "n")


def require_empty(problems: DataFrame, message: str) -> None:
    """Fail closed: raise when a check frame has a row."""
    if not problems.isEmpty():
        raise ValueError(message)


def severity_score(df: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, Column, float]]) -> DataFrame:
    """Start at 100, subtract each broken rule's weight, and list what broke."""
    broken = F.filter(
        F.array(*[F.when(test, F.struct(F.lit(w).alias("w"), F.lit(n).alias("name"))) for n, test, w in rules]),
        lambda r: r.isNotNull(),
    )
    lost = F.aggregate(broken, F.lit(0.0), lambda a, r: a + r["w"])
    return df.select(
        *keys,
        F.greatest(F.lit(0.0), 100.0 - lost).alias("score"),
        F.array_join(F.transform(broken, lambda r: r["name"]), ",").alias("failures"),
        (F.size(broken) == 0).alias("accepted"),
    )


def latest_per_key(events: DataFrame, keys: Sequence[str], time: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Merged status document: the last non-null value of every field wins."""
    position = F.struct(*time)
    return events.groupBy(*keys).agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), position)).alias(f) for f in fields]
    )


def progress_track(events: DataFrame, keys: Sequence[str], order: Sequence[str], percent: str) -> DataFrame:
    """Progress that never falls and never passes 100."""
    capped = F.least(F.col(percent).cast("double"), F.lit(100.0))
    return running(events, keys, order, {"progress": Run("max", capped)})
