"""Text formats: lines composed from a table and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from brackish.functions import documents, geo
from brackish.plans.registry import query
from brackish.sinks import writers
from brackish.sources import text
from brackish.sources.tables import table


def _words(*parts):
    return F.concat_ws("  ", *[F.lit(p) if isinstance(p, str) else p for p in parts])


@query(
    "read_mesh_nodes",
    """SELECT 'm' || s_nationkey AS file, s_suppkey AS node, CAST(s_acctbal AS DOUBLE) AS x, CAST(-s_suppkey AS DOUBLE) AS y, CASE WHEN s_suppkey % 5 <> 0 THEN 2.5::DOUBLE END AS depth FROM supplier""",
)
def read_mesh_nodes(spark, sf):
    """Node lines of tagged mesh text; a depth may be absent."""
    k = F.col("s_suppkey")
    line = _words(" nd", k, F.col("s_acctbal").cast("double"), -k, F.when(k % 5 != 0, "2.5"))
    rows = table(spark, sf, "supplier").select(F.concat(F.lit("m"), "s_nationkey").alias("file"), k.alias("line"), line.alias("text"))
    return text.mesh_rows(rows)[0]


@query(
    "read_mesh_cells",
    """SELECT p_brand AS file, p_partkey AS tri, p_partkey + 1 AS n1, p_partkey * 2 AS n2, CAST(p_size AS BIGINT) AS n3, CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 7 END AS n4 FROM part WHERE p_partkey % 11 <> 0""",
)
def read_mesh_cells(spark, sf):
    """Triangles and quadrilaterals among other lines."""
    k = F.col("p_partkey")
    tag = F.when(k % 11 == 0, "ND").when(k % 3 == 0, "E4Q").otherwise("E3T")
    line = _words(tag, k, k + 1, k * 2, F.col("p_size"), F.when(k % 3 == 0, k + 7))
    return text.mesh_rows(table(spark, sf, "part").select(F.col("p_brand").alias("file"), k.alias("line"), line.alias("text")))[1]


@query(
    "read_node_strings",
    """SELECT 'f' || o_custkey % 20 AS file, o_custkey AS chain, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS pos, o_orderkey + 1 AS node FROM orders""",
)
def read_node_strings(spark, sf):
    """Node strings of several lines that end at a negative node and their name."""
    orders, k = table(spark, sf, "orders"), F.col("o_orderkey") + 1
    last = orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last"))
    node = F.when(F.col("o_orderkey") == F.col("last"), F.concat(F.lit("-"), k, F.lit(" "), "o_custkey")).otherwise(k.cast("string"))
    rows = orders.join(last, "o_custkey").select(
        F.concat(F.lit("f"), F.col("o_custkey") % 20).alias("file"), (F.col("o_custkey") * 1_000_000_000 + F.col("o_orderkey")).alias("line"), _words("NS", node).alias("text")
    )
    strings = text.mesh_rows(rows)[2]
    return strings.select("file", "chain", F.col("pos").cast("int").alias("pos"), "node")


@query(
    "read_settings",
    """SELECT 's' || c_nationkey AS file, c_custkey AS line, 'KEY_' || c_custkey AS key, c_mktsegment AS value FROM customer WHERE c_custkey % 7 <> 0""",
)
def read_settings(spark, sf):
    """Settings lines with quotes, commas and comments."""
    k = F.col("c_custkey")
    line = F.concat(F.lit(" key_"), k, F.lit(" = '"), "c_mktsegment", F.lit("', ! a note = none"))
    rows = table(spark, sf, "customer").select(F.concat(F.lit("s"), "c_nationkey").alias("file"), k.alias("line"), F.when(k % 7 == 0, "! only = a note").otherwise(line).alias("text"))
    return text.settings(rows)


@query(
    "read_profile_rows",
    """
    SELECT o_orderkey AS profile, strftime(o_orderdate, '%Y%m%d') || '120000' AS date_compact, CAST(o_orderkey % 90 AS DOUBLE) AS latitude, CAST(o_custkey AS DOUBLE) AS longitude, 'aoml' AS dac, CAST(o_custkey AS VARCHAR) AS wmo,
      CASE WHEN o_orderkey % 2 = 0 THEN 'R' ELSE 'D' END AS file_mode
    FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0""",
)
def read_profile_rows(spark, sf):
    """Profile index rows; those without a position or a whole date are left out."""
    k = F.col("o_orderkey")
    name = F.concat(F.lit("AOML/"), "o_custkey", F.lit("/profiles/"), F.when(k % 2 == 0, "R").otherwise("D"), k, F.lit("_001.nc"))
    raw = table(spark, sf, "orders").select(
        k, name.alias("file"), F.when(k % 5 == 0, "2020").otherwise(F.date_format("o_orderdate", "yyyyMMdd'120000'")).alias("date"),
        F.when(k % 7 == 0, "none").otherwise((k % 90).cast("string")).alias("latitude"), F.col("o_custkey").cast("string").alias("longitude"), F.lit("20240101000000").alias("date_update"),
    )
    return text.profile_rows(raw, "argo").select(k.alias("profile"), "date_compact", "latitude", "longitude", "dac", "wmo", "file_mode")


@query(
    "read_discharge",
    """SELECT CAST(l_suppkey AS VARCHAR) AS site_no, CAST(l_shipdate AS DATE) AS date, CASE WHEN l_linenumber <> 3 THEN CAST(l_quantity AS DOUBLE) END AS obs_q_cfs, round(CASE WHEN l_linenumber <> 3 THEN l_quantity * 0.028316846592 END, 9)::DOUBLE AS obs_q_m3s FROM lineitem""",
)
def read_discharge(spark, sf):
    """Daily means of a gauge table; marks instead of numbers are null."""
    value = F.when(F.col("l_linenumber") == 3, "Ice").otherwise(F.col("l_quantity").cast("string"))
    raw = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("site_no"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("datetime"), value.alias("1_00060_00003")
    )
    return text.discharge_rows(raw).withColumn("obs_q_m3s", F.round("obs_q_m3s", 9))


@query(
    "write_mesh_lines",
    """
    SELECT CAST(0 AS INTEGER) AS section, CAST(k AS BIGINT) AS "at", line FROM (VALUES (0, 'MESH2D'), (1, 'MESHNAME "m"')) AS v(k, line)
    UNION ALL SELECT 1, p_partkey, concat_ws(' ', 'E3T', p_partkey, p_partkey + 1, p_partkey + 2, p_size, 1) FROM part
    UNION ALL SELECT 2, s_suppkey, printf('ND %d %.12f %.12f %.4f', s_suppkey, s_suppkey / 8.0, s_suppkey / 4.0, 1.5) FROM supplier
    UNION ALL SELECT 3, l_orderkey * 1000000000 + l_linenumber, CASE WHEN l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey) THEN concat('NS -', l_partkey, ' ', l_orderkey) ELSE concat('NS ', l_partkey) END FROM lineitem""",
)
def write_mesh_lines(spark, sf):
    """A mesh as tagged text: cells, nodes, node strings."""
    k = F.col("s_suppkey")
    nodes = table(spark, sf, "supplier").select(k.alias("node"), (k / 8.0).alias("x"), (k / 4.0).alias("y"), F.lit(1.5).alias("depth"))
    p = F.col("p_partkey")
    cells = table(spark, sf, "part").select(p.alias("tri"), (p + 1).alias("n1"), (p + 2).alias("n2"), F.col("p_size").alias("n3"))
    chains = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("chain"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("node"))
    return writers.mesh_2dm_lines(nodes, cells, chains, "m")


_SIDE = "sign(({q}x - {p}x) * ({r}y - {p}y) - ({q}y - {p}y) * ({r}x - {p}x))"
_SIDES = {n: _SIDE.format(p=n[0], q=n[1], r=n[2]) for n in ("abc", "abd", "cda", "cdb")}
_ON = " OR ".join(
    f"({_SIDES[p + q + r]} = 0 AND {r}x BETWEEN least({p}x, {q}x) AND greatest({p}x, {q}x) AND {r}y BETWEEN least({p}y, {q}y) AND greatest({p}y, {q}y))"
    for p, q, r in (("a", "b", "c"), ("a", "b", "d"), ("c", "d", "a"), ("c", "d", "b"))
)


@query(
    "crossing_segments",
    f"""
    WITH s AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 10 AS DOUBLE) AS ax, CAST(l_suppkey % 10 AS DOUBLE) AS ay, CAST(l_partkey % 7 AS DOUBLE) AS bx, CAST(l_quantity AS DOUBLE) AS b_y, CAST(l_suppkey % 6 AS DOUBLE) AS cx, CAST(l_linenumber AS DOUBLE) AS cy, CAST(l_partkey % 13 AS DOUBLE) AS dx, CAST(l_suppkey % 12 AS DOUBLE) AS dy FROM lineitem)
    SELECT l_orderkey, l_linenumber, ({_SIDES["abc"]} <> {_SIDES["abd"]} AND {_SIDES["cda"]} <> {_SIDES["cdb"]}) OR {_ON} AS crosses FROM s""".replace("by", "b_y"),
)
def crossing_segments(spark, sf):
    """Do the two segments of a row share a point?"""
    of = lambda c, n: (F.col(c) % n).cast("double")
    a, b = (of("l_partkey", 10), of("l_suppkey", 10)), (of("l_partkey", 7), F.col("l_quantity").cast("double"))
    c, d = (of("l_suppkey", 6), F.col("l_linenumber").cast("double")), (of("l_partkey", 13), of("l_suppkey", 12))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", geo.segments_cross(a, b, c, d).alias("crosses"))


@query(
    "document_leaves",
    """
    SELECT o_orderkey, unnest(['id', 'who.name', 'who.tags.0', 'who.tags.1', 'list.0.v', 'list.1.v']) AS path,
      unnest([CAST(o_orderkey AS VARCHAR), 'c' || o_custkey, 'a', CAST(o_custkey % 5 AS VARCHAR), CAST(o_orderkey % 7 AS VARCHAR), 'true']) AS value
    FROM orders WHERE o_orderkey % 9 <> 0""",
)
def document_leaves(spark, sf):
    """Every scalar of nested documents with its path; text that is no document has none."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    whole = F.format_string('{"id": %d, "who": {"name": "c%d", "tags": ["a", %d], "none": {}}, "list": [{"v": %d}, {"v": true}]}', k, c, c % 5, k % 7)
    docs = table(spark, sf, "orders").select("o_orderkey", F.when(k % 9 == 0, "{broken").otherwise(whole).alias("doc"))
    return documents.leaves(docs, ["o_orderkey"], "doc")
