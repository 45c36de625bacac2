"""Outputs.  Spark's committer makes each write atomic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.functions.timeaxis import millis_of_day, mjd_day, to_mjd


def with_model_times(df: DataFrame, time: str) -> DataFrame:
    """The redundant time columns forcing files carry: text, day number, whole day and milliseconds."""
    t = F.col(time)
    return df.withColumns(
        {
            "Times": F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS"),
            "time_mjd": to_mjd(t),
            "Itime": mjd_day(t),
            "Itime2": millis_of_day(t),
        }
    )


def write_forcing(df: DataFrame, path: str, time: str, partition: str = "day") -> None:
    """Forcing rows by day; the shuffle that keeps files few and prunable splits a day too large for a task."""
    dated = with_model_times(df, time).withColumn(partition, F.to_date(time))
    dated.hint("rebalance", F.col(partition)).write.mode("overwrite").partitionBy(partition).parquet(path)


def write_packages(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("package").parquet(path)


def write_many(df: DataFrame, folder: str, formats: Sequence[str]) -> list[str]:
    """The same rows in several encodings."""
    written = []
    for kind in formats:
        target = f"{folder}/{kind}"
        writer = df.write.mode("overwrite")
        {"csv": lambda: writer.option("header", True).csv(target), "json": lambda: writer.json(target),
         "parquet": lambda: writer.parquet(target), "orc": lambda: writer.orc(target)}[kind]()
        written.append(target)
    return written


def write_lines(df: DataFrame, path: str, order: Sequence[str], line: str) -> None:
    """Text in order: the global sort is by range, so parts follow each other."""
    df.orderBy(*order).select(line).write.mode("overwrite").text(path)


def mesh_2dm_lines(nodes: DataFrame, triangles: DataFrame, chains: DataFrame, name: str) -> DataFrame:
    """(section, at, line) of tagged mesh text; strings end with a negative node and their id."""
    spark = nodes.sparkSession
    head = spark.createDataFrame([(0, 0, "MESH2D"), (0, 1, f'MESHNAME "{name}"')], "section int, at long, line string")
    cells = triangles.select(
        F.lit(1).alias("section"), F.col("tri").alias("at"),
        F.concat_ws(" ", F.lit("E3T"), "tri", "n1", "n2", "n3", F.lit(1)).alias("line"),
    )
    points = nodes.select(
        F.lit(2).alias("section"), F.col("node").alias("at"),
        F.format_string("ND %d %.12f %.12f %.4f", F.col("node"), F.col("x"), F.col("y"), F.col("depth")).alias("line"),
    )
    last = chains.groupBy("chain").agg(F.max("pos").alias("_last"))
    ended = chains.join(last, "chain")
    text = F.when(F.col("pos") == F.col("_last"), F.concat(F.lit("NS -"), F.col("node"), F.lit(" "), F.col("chain"))).otherwise(
        F.concat(F.lit("NS "), F.col("node"))
    )
    strings = ended.select(F.lit(3).alias("section"), (F.col("chain") * 1_000_000_000 + F.col("pos")).alias("at"), text.alias("line"))
    return head.unionByName(cells).unionByName(points).unionByName(strings)


def river_namelist(rivers: DataFrame, file_name: str, layers: int = 20) -> DataFrame:
    """One block of settings per (river, node), spread evenly over the layers."""
    shares = f"{layers}*{1.0 / layers:.11f}"
    block = F.concat_ws(
        "\n", F.lit(" &NML_RIVER"), F.concat(F.lit("  RIVER_NAME          = '"), F.col("river"), F.lit("',")),
        F.lit(f"  RIVER_FILE          = '{file_name}',"), F.concat(F.lit("  RIVER_GRID_LOCATION = "), F.col("node"), F.lit(",")),
        F.lit(f"  RIVER_VERTICAL_DISTRIBUTION = {shares}"), F.lit("  /"),
    )
    return rivers.select("river", "node", block.alias("line"))


def spread_over_nodes(df: DataFrame, total: Column, weights: Sequence[float]) -> DataFrame:
    """A river's flow over its inflow nodes; the weights are a short fixed list."""
    if abs(sum(weights) - 1.0) > 1e-6:
        raise ValueError("node weights must sum to 1")
    shares = F.array(*[F.struct(F.lit(i + 1).alias("node"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)])
    return df.select(*df.columns, F.inline(shares)).withColumn("node_flow", total * F.col("weight"))
