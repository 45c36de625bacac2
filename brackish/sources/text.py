"""Readers for delimited and tagged text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brackish.functions.cleaning import above_sentinel, try_number
from brackish.functions.names import profile_path_parts
from brackish.functions.units import cubic_feet_to_metres
from brackish.sources.tables import require_columns


def profile_index(spark: SparkSession, path: str, product: str) -> DataFrame:
    """Profile index: all text, ``#`` comments, bad rows dropped, path parts derived."""
    return profile_rows(spark.read.option("header", True).option("comment", "#").csv(path), product)


def profile_rows(raw: DataFrame, product: str) -> DataFrame:
    """Typed rows of an index whose columns are all text."""
    require_columns(raw, ["file", "date", "latitude", "longitude", "date_update"], product)
    for extra in ("parameters", "parameter_data_mode"):
        if extra not in raw.columns:
            raw = raw.withColumn(extra, F.lit(""))
    digits = lambda c: F.regexp_replace(F.col(c), r"\D", "")
    parts = profile_path_parts(F.col("file"))
    typed = raw.withColumns(
        {
            "latitude": try_number(F.col("latitude")), "longitude": try_number(F.col("longitude")),
            "date_compact": digits("date"), "date_update": digits("date_update"),
            "dac": parts["dac"], "wmo": parts["wmo"], "file_mode": parts["mode"], "product": F.lit(product),
            "parameters": F.coalesce("parameters", F.lit("")),
        }
    )
    return typed.where(
        (F.length("date_compact") == 14) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("dac").isNotNull()
    )


def rdb(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated table with ``#`` comments; the row of field formats is dropped."""
    raw = spark.read.option("header", True).option("sep", "\t").option("comment", "#").csv(path)
    return raw.where(~F.coalesce(F.col(raw.columns[0]).rlike(r"^\d+[sdn]$"), F.lit(False)))


def observed_discharge(spark: SparkSession, path: str, code: str = "00060") -> DataFrame:
    """(site_no, date, cfs, m3s) from the first daily-mean column of the parameter code."""
    return discharge_rows(rdb(spark, path), code)


def discharge_rows(raw: DataFrame, code: str = "00060") -> DataFrame:
    """The same from a table whose columns are all text."""
    value = next((c for c in raw.columns if c.endswith(f"_{code}_00003")), None)
    if value is None:
        return raw.sparkSession.createDataFrame([], "site_no string, date date, obs_q_cfs double, obs_q_m3s double")
    q = try_number(F.col(value))
    return raw.select(
        "site_no", F.col("datetime").try_cast("date").alias("date"), q.alias("obs_q_cfs"),
        cubic_feet_to_metres(q).alias("obs_q_m3s"),
    )


def sediment_table(spark: SparkSession, path: str, columns: list[str], numeric: list[str], name: str, sentinel: float = -98.0):
    """CSV with column pruning and sentinel cleaning."""
    raw = spark.read.option("header", True).csv(path).select(*columns)
    cleaned = raw.withColumns({c: above_sentinel(F.col(c), sentinel) for c in numeric if c in columns})
    return cleaned.withColumn("source_table", F.lit(name))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text), numbered inside each file."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line", "text")).where(F.trim("text") != "")


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text), read in parts; ``line`` orders the lines of a file but does not count them."""
    at = F.struct(F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), at.alias("line"), F.col("value").alias("text")).where(F.trim("text") != "")


def _tokens(df: DataFrame) -> DataFrame:
    return df.withColumn("t", F.split(F.trim("text"), r"\s+"))


def mesh_2dm(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, elements, nodestrings) of tagged mesh text; large files are read in parts."""
    return mesh_rows(split_lines(spark, path))


def mesh_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, elements, nodestrings) of the lines (file, line, text) of tagged mesh text.

    Quadrilaterals appear as two triangles' worth of corners in ``n4``.  A node
    string may run over several lines and ends at a negative node, optionally
    followed by its id.
    """
    tagged = _tokens(rows).withColumn("tag", F.upper(F.col("t")[0]))
    number = lambda i, kind: F.try_element_at("t", F.lit(i + 1)).try_cast(kind)
    nodes = tagged.where("tag = 'ND'").select(
        "file", number(1, "long").alias("node"), number(2, "double").alias("x"), number(3, "double").alias("y"), number(4, "double").alias("depth")
    )
    elements = tagged.where("tag in ('E3T', 'E4Q')").select(
        "file", number(1, "long").alias("tri"), number(2, "long").alias("n1"), number(3, "long").alias("n2"),
        number(4, "long").alias("n3"), F.when(F.col("tag") == "E4Q", number(5, "long")).alias("n4"),
    )
    values = tagged.where("tag = 'NS'").select("file", "line", F.posexplode(F.slice("t", 2, F.size("t"))).alias("at", "v"))
    order = W.partitionBy("file").orderBy("line", "at")
    walked = values.withColumn("v", F.col("v").cast("long"))
    ends = F.sum(F.when(F.col("v") < 0, 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, -1))
    walked = walked.withColumns(
        {"string": F.coalesce(ends, F.lit(0)), "_prev": F.lag("v").over(order), "_pl": F.lag("line").over(order)}
    )
    # The number right after an end, on the same line, names the string just ended.
    is_id = (F.col("_prev") < 0) & (F.col("_pl") == F.col("line"))
    named = walked.where(is_id).select("file", (F.col("string") - 1).alias("string"), F.col("v").alias("given"))
    body = walked.where(~F.coalesce(is_id, F.lit(False))).join(named, ["file", "string"], "left")
    position = F.row_number().over(W.partitionBy("file", "string").orderBy("line", "at")) - 1
    strings = body.select(
        "file", F.coalesce("given", F.col("string") + 1).alias("chain"), position.alias("pos"), F.abs("v").alias("node")
    )
    return nodes, elements, strings


def grid_dat(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, triangles) of a grid file: two counts, the cells, then the nodes."""
    rows = lines(spark, path)
    count = F.substring_index("text", "=", -1)
    head = rows.where(F.contains("text", F.lit("="))).groupBy("file").agg(
        F.max_by(F.trim(count).try_cast("long"), F.col("line")).alias("_cells"), F.max("line").alias("_head")
    )
    body = _tokens(rows.where(~F.contains("text", F.lit("=")))).join(head, "file")
    is_cell = F.col("line") - F.col("_head") <= F.col("_cells")
    cells = body.where(is_cell).select(
        "file", *[F.col("t")[i].try_cast("long").alias(c) for i, c in enumerate(["tri", "n1", "n2", "n3"])]
    )
    nodes = body.where(~is_cell).select(
        "file", F.col("t")[0].try_cast("long").alias("node"), F.col("t")[1].try_cast("double").alias("x"),
        F.col("t")[2].try_cast("double").alias("y"), F.try_element_at("t", F.lit(4)).try_cast("double").alias("depth"),
    )
    return nodes, cells


def node_list(spark: SparkSession, path: str) -> DataFrame:
    """(pos, node, kind) of an open-boundary node list."""
    rows = _tokens(lines(spark, path)).where(~F.contains("text", F.lit("=")))
    return rows.select(
        "file", F.col("t")[0].try_cast("long").alias("pos"), F.col("t")[1].try_cast("long").alias("node"),
        F.try_element_at("t", F.lit(3)).try_cast("int").alias("kind"),
    )


def namelist(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, key, value) of the settings of files."""
    return settings(lines(spark, path))


def settings(rows: DataFrame) -> DataFrame:
    """(file, line, key, value) of lines ``KEY = value``; text after ``!`` is a comment."""
    bare = F.trim(F.split("text", "!")[0])
    rows = rows.withColumn("s", bare).where(F.contains("s", F.lit("=")))
    value = F.trim(F.regexp_replace(F.trim(F.substring_index("s", "=", -1)), r",$", ""))
    return rows.select(
        "file", "line", F.upper(F.trim(F.substring_index("s", "=", 1))).alias("key"),
        F.regexp_replace(value, r"^['\"]|['\"]$", "").alias("value"),
    )


def series_csv(spark: SparkSession, path: str, aliases: dict[str, list[str]]) -> DataFrame:
    """Long series CSV with alias columns (time, value, and a station or node key)."""
    from brackish.functions.timeaxis import parse_any
    from brackish.sources.tables import with_aliases

    raw = with_aliases(spark.read.option("header", True).csv(path), aliases, required=["time", "value"])
    typed = raw.withColumns({"time": parse_any(F.col("time")), "value": try_number(F.col("value"))})
    for c in ("lon", "lat"):
        if c in typed.columns:
            typed = typed.withColumn(c, try_number(F.col(c)))
    return typed


def listing_xml(spark: SparkSession, path: str) -> DataFrame:
    """Objects of saved bucket listings; empty objects are left out."""
    schema = "Key string, LastModified string, ETag string, Size long"
    rows = spark.read.format("xml").option("rowTag", "Contents").option("ignoreNamespace", True).schema(schema).load(path)
    return rows.where("Size > 0").select(
        F.col("Key").alias("key"), F.col("Size").alias("size"), F.trim(F.col("ETag"), F.lit('" ')).alias("etag"),
        F.col("LastModified").alias("last_modified"),
    )


def url_list(spark: SparkSession, path: str, suffix: str = r"\.(tif|tiff|nc)$") -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("url")).where(F.col("url").rlike("(?i)" + suffix)).distinct()
