"""Structured Streaming counterparts of the time operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brackish.session import ensure_checkpoint_dir


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table of the folder as a file stream, with its own schema."""
    path = f"{folder}/{name}.parquet"
    stored = spark.read.parquet(path)
    stream = spark.readStream.schema(stored.schema)
    if any(f.rstrip("/").endswith(f"/{name}.parquet") for f in stored.inputFiles()[:1]):  # one file, not a folder of parts
        return stream.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return stream.parquet(path)


def as_event_time(stream: DataFrame, column: str) -> DataFrame:
    return stream.withColumn(column, F.col(column).cast("timestamp"))


def first_seen(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """One row per key within the lateness allowance; older keys leave the state."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def tumbling(stream: DataFrame, keys: Sequence[str], time: str, value: str, width: str, delay: str) -> DataFrame:
    """Count, sum and range per key and window, once the window is final."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, width), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n", "total", "low", "high")
    )


def sessions(stream: DataFrame, keys: Sequence[str], time: str, gap: str, delay: str) -> DataFrame:
    """Runs of records less than ``gap`` apart."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.session_window(time, gap), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("session_window.start").alias("first"), F.col("session_window.end").alias("until"), *keys, "n")
    )


def time_owner(stream: DataFrame, time: str, step: str, owner: Sequence[str], delay: str) -> DataFrame:
    """Per step of time the record of the earliest owner, once nothing earlier can come."""
    carried = F.struct(*owner)
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, step))
        .agg(F.min(carried).alias("_first"), F.count(F.lit(1)).alias("offered"))
        .select(F.col("window.start").alias("step_start"), "_first.*", "offered")
    )


def _folders(spark: SparkSession, target: str | None) -> tuple[str, str]:
    base = target or f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    return f"{base}/data", f"{base}/progress"


def drain(stream: DataFrame, target: str | None = None) -> DataFrame:
    """Run an append stream over what is there now and read the result back.

    Rows go executor to file; nothing passes the driver.  The progress folder
    makes a rerun continue where it stopped.
    """
    spark = stream.sparkSession
    data, progress = _folders(spark, target)
    query = (
        stream.writeStream.format("parquet").option("path", data).option("checkpointLocation", progress)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(data)


def drain_latest(stream: DataFrame, keys: Sequence[str], time: Sequence[str], fields: Sequence[str], target: str | None = None) -> DataFrame:
    """Status table: per key the last non-null value of every field over all batches.

    A batch writes one row for each key that it holds, with the last value of every field and its time, under its
    batch number, so a repeated batch overwrites its own output and the state is never
    rewritten.  Reading takes the latest of these per field; a late record is placed by its time.
    """
    spark = stream.sparkSession
    data, progress = _folders(spark, target)

    def latest(df: DataFrame, stamped) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.max(stamped(f)).alias(f) for f in fields])

    def write(batch: DataFrame, number: int) -> None:
        stamp = lambda f: F.when(F.col(f).isNotNull(), F.struct(*[F.col(t).alias(f"_t{i}") for i, t in enumerate(time)], F.col(f).alias("_v")))
        latest(batch, stamp).write.mode("overwrite").parquet(f"{data}/version={number}")

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    try:
        versions = spark.read.parquet(data)
    except AnalysisException:  # no batch has come
        types = dict(stream.dtypes)
        return spark.createDataFrame([], ", ".join(f"`{c}` {types[c]}" for c in (*keys, *fields)))
    return latest(versions, F.col).select(*keys, *[F.col(f)["_v"].alias(f) for f in fields])


def command_queue(
    spark: SparkSession, inbox: str, done: str, results: str, progress: str, schema: str,
    handle: Callable[[DataFrame], DataFrame], forever: bool = False,
):
    """JSON command files: each handled once, its result written, the file archived.

    The checkpoint remembers which files were taken; results carry the batch
    number, so a repeated batch replaces its own.
    """
    stream = (
        spark.readStream.schema(schema).option("multiLine", True).option("maxFilesPerTrigger", 100)
        .option("cleanSource", "archive").option("sourceArchiveDir", done).json(inbox)
        .withColumn("command_file", F.col("_metadata.file_name"))
    )

    def run(batch: DataFrame, number: int) -> None:
        handle(batch).write.mode("overwrite").json(f"{results}/batch={number}")

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", progress)
    return (writer.trigger(processingTime="250 milliseconds") if forever else writer.trigger(availableNow=True)).start()
