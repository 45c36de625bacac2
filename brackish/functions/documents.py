"""JSON fields and word-list flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_present(json: Column, paths: Sequence[str]) -> Column:
    """First of several JSON paths that holds a value."""
    return F.coalesce(*[F.get_json_object(json, p) for p in paths])


def leaves(df: DataFrame, keys: Sequence[str], json: str) -> DataFrame:
    """(keys, path, value) of every scalar in documents of any depth; parts of a path are joined by dots.

    Objects and arrays are opened one level a round, until none is left, so the rounds are the
    deepest nesting.  Text that is not JSON, and empty objects and arrays, have no leaves.
    """
    open_ = df.select(*keys, F.lit("").alias("path"), F.try_parse_json(json).alias("_v")).where("_v is not null")
    found = None
    while True:
        kinds = open_.withColumn("_kind", F.schema_of_variant("_v"))
        nested = F.col("_kind").startswith("OBJECT") | F.col("_kind").startswith("ARRAY")
        flat = kinds.where(~nested).select(*keys, "path", F.try_variant_get("_v", "$", "string").alias("value"))
        found = flat if found is None else found.unionByName(flat)
        deeper = kinds.where(nested)
        if deeper.isEmpty():
            return found
        parts = deeper.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()).select("pos", "key", F.col("value").alias("_part")))
        name = F.coalesce("key", F.col("pos").cast("string"))
        path = F.when(F.col("path") == "", name).otherwise(F.concat_ws(".", "path", name))
        open_ = parts.select(*keys, path.alias("path"), F.col("_part").alias("_v"))


# Scale of each size unit.
SIZE_SCALE = {"bytes": 1.0, "mb": 1024.0**2, "gb": 1024.0**3}


def stated_bytes(json: Column, keys: Mapping[str, Sequence[str]]) -> Column:
    """Sum of the sizes a document states, in bytes; null when it states none.

    ``keys`` maps a unit (bytes, mb, gb) to the JSON paths that use it.
    """
    found = [
        F.when(number >= 0, number * SIZE_SCALE[unit])
        for unit, paths in keys.items()
        for number in [F.get_json_object(json, p).try_cast("double") for p in paths]
    ]
    total = F.aggregate(F.filter(F.array(*found), lambda x: x.isNotNull()), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.coalesce(*found).isNotNull(), total)


def canonical_hash(fields: Column) -> Column:
    """SHA-256 of a string map as JSON with sorted keys: the same for any order of insertion."""
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(fields)))), 256)


def clean_dates(values: Column) -> Column:
    """Sorted distinct non-blank texts of an array."""
    trimmed = F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: F.trim(v))
    kept = F.filter(trimmed, lambda v: (v != "") & ~F.lower(v).isin("nan", "none", "null"))
    return F.array_sort(F.array_distinct(kept))


def has_any_flag(flags: Column, bad: Sequence[str], separator: str = ",") -> Column:
    """Does a separated list hold one of the bad codes?  Missing lists hold none."""
    return F.coalesce(F.arrays_overlap(F.split(flags, separator), F.array(*[F.lit(b) for b in bad])), F.lit(False))


def words(text: Column) -> Column:
    return F.filter(F.split(F.upper(F.trim(text)), r"\s+"), lambda w: w != "")


def has_all(have: Column, wanted: Sequence[str]) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), have)) == 0


def has_any(have: Column, wanted: Sequence[str]) -> Column:
    return F.arrays_overlap(have, F.array(*[F.lit(w) for w in wanted]))


def choose_by_rules(rules: Sequence[tuple[Column, str]]) -> Column:
    """Reason of the first rule that holds, null when none does."""
    choice = None
    for test, reason in rules:
        choice = F.when(test, reason) if choice is None else choice.when(test, reason)
    return choice


def plan_state(expected_bytes: Column, free_bytes: Column, seconds: Column, long_run: float = 600.0) -> Column:
    """Storage and duration gate of a transfer."""
    return (
        F.when(~(free_bytes > expected_bytes * 4), "blocked")
        .when(seconds.isNull() | (seconds < 0), "blocked")
        .when(seconds >= long_run, "long_run_monitor_required")
        .otherwise("ready")
    )


def duration_seconds(size: Column, rate: Column, pieces: Column, latency: Column) -> tuple[Column, Column, Column]:
    """(low, central, conservative) transfer time."""
    central = size / rate + pieces * F.least(F.lit(5.0), F.greatest(F.lit(0.0), latency))
    return central * 0.75, central, central * 1.5 + pieces * 5.0
