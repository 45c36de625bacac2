"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("brackish")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def in_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: epoch arithmetic on zone-less times assumes UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; make one only for a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="brackish-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise to the reliable checkpoint folder, which outlives an executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def cut_rounds(df: DataFrame) -> DataFrame:
    """``cut_lineage`` for loops that join their own result round after round.

    A checkpoint keeps the planner's estimate of its size, which is a product over the joins before it: over
    rounds it would be squared again and again, up to numbers that take the planner minutes.  Here it is forgotten.
    """
    done, spark = cut_lineage(df), df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(done._jdf.toJavaRDD(), done._jdf.schema()), spark)
