"""Geometry documents to rows."""

from __future__ import annotations

import struct
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def geojson_rings(spark: SparkSession, path: str) -> DataFrame:
    """(feature, part, ring, points) of polygon features and collections."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    docs = spark.read.option("multiLine", True).schema(schema).json(path)
    rows = docs.select(F.posexplode("features").alias("feature", "f")).select("feature", "f.properties", "f.geometry.*")
    single = F.from_json("coordinates", "array<array<array<double>>>")
    many = F.from_json("coordinates", "array<array<array<array<double>>>>")
    parts = F.when(F.col("type") == "Polygon", F.array(single)).when(F.col("type") == "MultiPolygon", many)
    opened = rows.select("feature", "properties", F.posexplode(parts).alias("part", "rings"))
    return opened.select("feature", "properties", "part", F.posexplode("rings").alias("ring", "r")).select(
        "feature", "properties", "part", "ring",
        F.transform("r", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("points"),
    )


def way_lines(spark: SparkSession, path: str) -> DataFrame:
    """(way, points) of ways with at least two vertices, from map-query documents."""
    schema = "elements array<struct<type:string,id:long,geometry:array<struct<lon:double,lat:double>>>>"
    docs = spark.read.option("multiLine", True).schema(schema).json(path)
    ways = docs.select(F.explode("elements").alias("e")).where("e.type = 'way' and size(e.geometry) >= 2")
    return ways.select(
        F.col("e.id").alias("way"), F.transform("e.geometry", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y"))).alias("points")
    )


def line_parts(wkb: Column) -> Column:
    """Line strings of a WKB value as array<array<point>>; null when it is not one.

    Two and three dimensions, either byte order, single and multi lines.
    """
    return _decode(wkb)


_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


@F.pandas_udf(T.ArrayType(T.ArrayType(_POINT)))
def _decode(column: pd.Series) -> pd.Series:
    def part(data: bytes, at: int):
        order = "<" if data[at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", data, at + 1)
        at += 5
        if code & 0x20000000:
            at += 4
        dims = 2 + int(bool(code & 0x80000000) or 1000 <= code & 0xFFFF < 2000 or code & 0xFFFF >= 3000)
        dims += int(bool(code & 0x40000000) or 2000 <= code & 0xFFFF < 4000)
        kind = (code & 0xFFFF) % 1000
        (count,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if kind == 2:
            flat = struct.unpack_from(order + "d" * (count * dims), data, at)
            points = [{"x": flat[k], "y": flat[k + 1]} for k in range(0, len(flat), dims)]
            return [points] if len(points) >= 2 else [], at + 8 * count * dims
        if kind == 5:
            found = []
            for _ in range(count):
                one, at = part(data, at)
                found += one
            return found, at
        raise ValueError("not a line")

    def safe(value):
        try:
            return None if value is None else part(bytes(value), 0)[0]
        except (ValueError, struct.error, IndexError):
            return None

    return column.map(safe)


def raw_lines(df: DataFrame, wkb: str) -> tuple[DataFrame, DataFrame]:
    """(line parts, counts of skipped values by reason)."""
    decoded = df.withColumn("_parts", line_parts(F.col(wkb)))
    reason = (
        F.when(F.col(wkb).isNull(), "missing").when(F.col("_parts").isNull(), "unreadable").when(F.size("_parts") == 0, "too_short")
    )
    good = decoded.select(*df.columns, F.posexplode("_parts").alias("part", "points")).drop(wkb)
    return good, decoded.withColumn("reason", reason).where("reason is not null").groupBy("reason").count()


def segments(df: DataFrame, keys: list[str], points: str) -> DataFrame:
    """Consecutive vertex pairs of each line."""
    pairs = F.arrays_zip(
        F.slice(points, F.lit(1), F.size(points) - 1).alias("p"), F.slice(points, F.lit(2), F.size(points) - 1).alias("q")
    )
    return df.select(*keys, F.posexplode(pairs).alias("seg", "z")).select(
        *keys, "seg", F.col("z")["p"]["x"].alias("x1"), F.col("z")["p"]["y"].alias("y1"), F.col("z")["q"]["x"].alias("x2"), F.col("z")["q"]["y"].alias("y2")
    )


def clip_segments(df: DataFrame, bbox: tuple[float, float, float, float]) -> DataFrame:
    """Segments (x1, y1, x2, y2) cut to a box; those outside are dropped."""
    west, south, east, north = (float(v) for v in bbox)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t0, t1, out = F.lit(0.0), F.lit(1.0), F.lit(False)
    for p, q in [(-dx, F.col("x1") - west), (dx, east - F.col("x1")), (-dy, F.col("y1") - south), (dy, north - F.col("y1"))]:
        r = F.try_divide(q, p)
        out = out | ((p == 0) & (q < 0))
        t0 = F.greatest(t0, F.when(p < 0, r))
        t1 = F.least(t1, F.when(p > 0, r))
    cut = df.withColumns({"_t0": t0, "_t1": t1, "_out": out}).where(~F.col("_out") & (F.col("_t0") < F.col("_t1")))
    return cut.withColumns(
        {
            "x1": F.col("x1") + F.col("_t0") * dx, "y1": F.col("y1") + F.col("_t0") * dy,
            "x2": F.col("x1") + F.col("_t1") * dx, "y2": F.col("y1") + F.col("_t1") * dy,
        }
    ).drop("_t0", "_t1", "_out")
