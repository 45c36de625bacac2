"""Parquet tables and schema helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brackish.functions.cleaning import finite


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN and infinities of floating columns to null, once at the scan."""
    floating = [c for c, t in df.dtypes if t in ("double", "float") and (columns is None or c in columns)]
    return df.withColumns({c: finite(F.col(c)) for c in floating}) if floating else df


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
    return df


def with_aliases(df: DataFrame, roles: Mapping[str, Sequence[str]], required: Sequence[str] = ()) -> DataFrame:
    """Rename the first present alias of each role to the role; ignores case."""
    have = {c.lower(): c for c in df.columns}
    found = {role: next((have[a.lower()] for a in names if a.lower() in have), None) for role, names in roles.items()}
    absent = [r for r in required if found.get(r) is None]
    if absent:
        raise ValueError(f"no column for {absent}; available: {df.columns}")
    return df.withColumnsRenamed({c: role for role, c in found.items() if c and c != role})


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """Records of different catalogues under one schema; absent fields are null."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


def inventory(df: DataFrame) -> DataFrame:
    """Column names, types and nullability as a table."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def coordinate_roles(df: DataFrame, candidates: Mapping[str, Sequence[str]], overrides: Mapping[str, str] | None = None):
    """Role -> column: an override, then column metadata, then a known name."""
    overrides = overrides or {}
    roles = {}
    for role, names in candidates.items():
        if role in overrides:
            roles[role] = overrides[role]
            continue
        tagged = [f.name for f in df.schema.fields if f.metadata.get("standard_name") == role or f.metadata.get("axis") == role]
        named = [c for n in names for c in df.columns if c.lower() == n.lower()]
        if tagged or named:
            roles[role] = (tagged or named)[0]
    return roles


def page(df: DataFrame, order: str, offset: int, size: int) -> DataFrame:
    """One page of a listing in id order."""
    return df.orderBy(order).offset(offset).limit(size)


def file_facts(df: DataFrame, time: str) -> DataFrame:
    """Per source file: records and time span, from the file each row came from."""
    return df.withColumn("file", F.col("_metadata.file_name")).groupBy("file").agg(
        F.count(F.lit(1)).alias("records"), F.min(time).alias("first"), F.max(time).alias("last")
    )
