"""Queries over axes, chunks, listings and subdivided lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from brackish.functions import documents as D
from brackish.functions import geo as G
from brackish.functions import timeaxis as T
from brackish.functions import vertical as Z
from brackish.operators import dedupe, joins, nearest, series, vertical
from brackish.operators.ordered import Run, plan_slices, running
from brackish.plans.cleaning import LONLAT_SQL, lonlat
from brackish.plans.registry import OFF_TIE, query
from brackish.plans.spatial import _STATIONS_SQL, _TARGETS_SQL, stations, targets, triangles
from brackish.sources.tables import file_facts, page, table


@query(
    "regular_axis",
    """
    WITH p AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS t, arg_max(value, ts) AS v FROM events GROUP BY ALL),
    g AS (SELECT event_type, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-29 23:00:00', INTERVAL 1 HOUR)) AS t FROM (SELECT DISTINCT event_type FROM events)),
    j AS (SELECT g.event_type, g.t, epoch_us(g.t) AS x, p.v, l.v AS pv, epoch_us(l.t) AS px, n.v AS nv, epoch_us(n.t) AS nx FROM g LEFT JOIN p USING (event_type, t)
      ASOF LEFT JOIN p l ON g.event_type = l.event_type AND g.t >= l.t ASOF LEFT JOIN (SELECT * FROM p WHERE t < TIMESTAMP '2024-01-30') n ON g.event_type = n.event_type AND g.t <= n.t)
    SELECT event_type, t, round(CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * ((x - px)::DOUBLE / (nx - px)) END + 3.1e-7, 6) AS value FROM j""",
)
def regular_axis(spark, sf):
    """An hourly axis: the last record of the hour wins, gaps filled in time."""
    e = table(spark, sf, "events").select("event_type", F.col("ts").alias("t"), "value")
    bounds = e.select("event_type").distinct().select("event_type", F.lit("2024-01-01").cast("timestamp_ntz").alias("a"), F.lit("2024-01-30").cast("timestamp_ntz").alias("b"))
    grid = series.time_grid(bounds, ["event_type"], "a", "b", 3600, "t")
    out = series.regular_axis(e, ["event_type"], "t", "value", 3600, grid, plan_slices(e, "t"))
    return out.select("event_type", "t", F.round(F.col("filled") + OFF_TIE, 6).alias("value"))


@query(
    "axis_regularity",
    """
    SELECT i, count(*) AS n, min(s) AS shortest, max(s) AS longest, coalesce(max(s) - min(s) <= 0.5, false) AS regular
    FROM (SELECT i, j - lag(j) OVER (PARTITION BY i ORDER BY j) AS s FROM (SELECT DISTINCT o_orderkey % 120 AS i, (o_orderkey // 120)::DOUBLE AS j FROM orders WHERE o_orderkey % 240 > 50 OR o_orderkey % 7 <> 3)) GROUP BY i""",
)
def axis_regularity(spark, sf):
    """Is every axis evenly stepped?"""
    k = F.col("o_orderkey")
    cells = table(spark, sf, "orders").where((k % 240 > 50) | (k % 7 != 3)).select((k % 120).alias("i"), F.floor(k / 120).cast("double").alias("j"))
    return series.axis_regularity(cells, ["i"], "j", 0.5)


@query("duplicate_times", "SELECT event_type, date_trunc('minute', ts) AS t, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def duplicate_times(spark, sf):
    """Series times delivered more than once."""
    e = table(spark, sf, "events").select("event_type", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("t"))
    return dedupe.duplicate_keys(e, ["event_type", "t"])


@query(
    "combine_sources",
    """SELECT i, j, sum(o_totalprice)::DECIMAL(38,2)::DOUBLE AS total, count(*) AS n FROM (SELECT o_orderkey % 50 AS i, o_custkey % 20 AS j, o_totalprice, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01') GROUP BY ALL""",
)
def combine_sources(spark, sf):
    """Sums and counts per cell over many files in a time window, merged from partial ones."""
    o = table(spark, sf, "orders")
    inside = o.where((F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")))
    return inside.groupBy((F.col("o_orderkey") % 50).alias("i"), (F.col("o_custkey") % 20).alias("j")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"), F.count(F.lit(1)).alias("n")
    )


@query("listing_page", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 100 OFFSET 100")
def listing_page(spark, sf):
    """The second page of a listing in id order."""
    return page(table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey", 100, 100)


@query("strided_window", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 120 BETWEEN 10 AND 90 AND (o_orderkey % 120 - 10) % 4 = 0 AND (o_orderkey // 120) % 4 = 0")
def strided_window(spark, sf):
    """A grid window read with a stride on both axes (the stride is the operator)."""
    k = F.col("o_orderkey")
    i, j = k % 120, F.floor(k / 120)
    return table(spark, sf, "orders").where(i.between(10, 90) & (F.pmod(i - 10, F.lit(4)) == 0) & (F.pmod(j, F.lit(4)) == 0)).select("o_orderkey", "o_totalprice")


@query(
    "time_chunks",
    """
    WITH c AS (SELECT (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // (168 * 3600000000) AS week, length(props) AS size, ts FROM events),
    r AS (SELECT week, ts, sum(size) OVER (PARTITION BY week ORDER BY ts ROWS UNBOUNDED PRECEDING) - size AS before FROM c)
    SELECT week, (before // 4000)::BIGINT AS chunk, min(ts) AS first, max(ts) AS last, count(*) AS n FROM r GROUP BY week, before // 4000""",
)
def time_chunks(spark, sf):
    """Weekly windows cut into chunks of bounded bytes."""
    weeks = F.floor((T.micros(F.col("ts")) - 1704067200000000) / F.lit(168 * 3600 * 1_000_000))
    e = table(spark, sf, "events").select("ts", weeks.alias("week"), F.length("props").cast("long").alias("size"))
    summed = running(e, ["week"], ["ts"], {"upto": Run("sum", F.col("size"))}, plan_slices(table(spark, sf, "events"), "ts"))
    chunk = F.floor((F.col("upto") - F.col("size")) / 4000)
    return summed.groupBy("week", chunk.alias("chunk")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))


@query("file_facts", "SELECT 'events.parquet' AS file, count(*) AS records, min(ts) AS first, max(ts) AS last FROM events")
def facts_of_files(spark, sf):
    """Records and time span of every file read."""
    return file_facts(table(spark, sf, "events"), "ts")


@query(
    "role_uniqueness",
    """SELECT o_custkey, role, count(*) AS files, CASE WHEN count(*) = 1 THEN 'ok' ELSE 'ambiguous' END AS verdict FROM (SELECT o_custkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'grid' WHEN o_orderpriority LIKE '2%' THEN 'elevation' WHEN o_orderstatus = 'P' THEN 'mask' END AS role FROM orders) WHERE role IS NOT NULL GROUP BY o_custkey, role""",
)
def role_uniqueness(spark, sf):
    """Each file role of a source must be filled by exactly one file."""
    priority = F.substring("o_orderpriority", 1, 1)
    role = F.when(priority == "1", "grid").when(priority == "2", "elevation").when(F.col("o_orderstatus") == "P", "mask")
    named = table(spark, sf, "orders").select("o_custkey", role.alias("role")).where("role is not null")
    n = named.groupBy("o_custkey", "role").agg(F.count(F.lit(1)).alias("files"))
    return n.withColumn("verdict", F.when(F.col("files") == 1, "ok").otherwise("ambiguous"))


@query(
    "run_summary",
    """
    SELECT o_orderkey, c_mktsegment, n_name, r_name, count(l_orderkey) AS lines, round(sum(l_quantity), 4) AS quantity FROM orders
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def run_summary(spark, sf):
    """One row per run from several documents: equi-joins after each is reduced to its key."""
    per = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    joined = table(spark, sf, "orders").join(c, "o_custkey").join(n, "n_nationkey").join(table(spark, sf, "region"), "r_regionkey").join(per, "o_orderkey", "left")
    return joined.select("o_orderkey", "c_mktsegment", "n_name", "r_name", F.coalesce("lines", F.lit(0)).alias("lines"), F.round("quantity", 4).alias("quantity"))


@query(
    "far_from_primary",
    f"""SELECT t.id FROM ({_TARGETS_SQL}) t WHERE NOT EXISTS (SELECT 1 FROM ({_STATIONS_SQL}) s WHERE sqrt((s.x - t.x) * (s.x - t.x) + (s.y - t.y) * (s.y - t.y)) <= 40.0)""",
)
def far_from_primary(spark, sf):
    """Fallback points that the primary source does not already cover."""
    return nearest.far_from(targets(spark, sf), stations(spark, sf).withColumnRenamed("id", "station"), "id", "station", 40.0).select("id")


@query(
    "densified_segments",
    """
    WITH s AS (SELECT o_orderkey, (o_custkey % 500) + 1.0 AS len, CASE WHEN o_orderstatus = 'O' THEN 120.0 ELSE 45.0 END AS sp FROM orders), n AS (SELECT *, greatest(1, ceil(len / sp))::BIGINT AS pieces FROM s)
    SELECT o_orderkey, k::BIGINT AS piece, round(len * k::DOUBLE / pieces, 6) AS at FROM n, unnest(generate_series(0, pieces - 1)) AS t(k)""",
)
def densified_segments(spark, sf):
    """Segments cut to the spacing of their class."""
    length = F.col("o_custkey") % 500 + 1.0
    spacing = F.when(F.col("o_orderstatus") == "O", 120.0).otherwise(45.0)
    cut = table(spark, sf, "orders").select("o_orderkey", length.alias("len"), F.posexplode(G.subdivisions(length, spacing)).alias("piece", "f"))
    return cut.select("o_orderkey", F.col("piece").cast("long").alias("piece"), F.round(F.col("len") * F.col("f"), 6).alias("at"))


@query(
    "metric_segments",
    """
    WITH s AS (SELECT p_partkey, p_retailprice AS len, 20.0 + p_size AS h0, 20.0 + p_size + (p_partkey % 5) * 15.0 AS h1 FROM part),
    n AS (SELECT *, greatest(1, ceil(CASE WHEN h1 = h0 THEN len / h0 ELSE len * ln(h1 / h0) / (h1 - h0) END - 1e-9))::BIGINT AS pieces FROM s)
    SELECT p_partkey, k::BIGINT AS piece, round(CASE WHEN h1 = h0 THEN k::DOUBLE / pieces ELSE (pow(h1 / h0, k::DOUBLE / pieces) - 1) / (h1 / h0 - 1) END, 6) AS fraction FROM n, unnest(generate_series(0, pieces - 1)) AS t(k)""",
)
def metric_segments(spark, sf):
    """Segments cut evenly relative to a target that changes along them."""
    h0 = F.col("p_size") + 20.0
    h1 = h0 + (F.col("p_partkey") % 5) * 15.0
    cut = table(spark, sf, "part").select("p_partkey", F.posexplode(G.metric_subdivisions(F.col("p_retailprice"), h0, h1)).alias("piece", "f"))
    return cut.select("p_partkey", F.col("piece").cast("long").alias("piece"), F.round("f", 6).alias("fraction"))


@query(
    "depth_to_sigma",
    """
    WITH z AS (SELECT l_suppkey AS c, l_linenumber * 10.0 AS depth, avg(l_quantity) AS v FROM lineitem GROUP BY ALL),
    g AS (SELECT s_suppkey AS c, k, k * 80.0 / 8 AS depth FROM supplier, range(0, 9) AS t(k)), h AS (SELECT c, k::INTEGER AS level, depth + 2.5 AS depth FROM g),
    j AS (SELECT h.c, h.level, h.depth, p.depth AS pd, p.v AS pv, n.depth AS nd, n.v AS nv FROM h ASOF LEFT JOIN z p ON h.c = p.c AND h.depth >= p.depth ASOF LEFT JOIN z n ON h.c = n.c AND h.depth <= n.depth)
    SELECT c, level, round(CASE WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv WHEN nd = pd THEN pv ELSE pv + (nv - pv) * ((depth - pd) / (nd - pd)) END + 3.1e-7, 6) AS v FROM j""",
)
def depth_to_sigma(spark, sf):
    """Profiles on fixed depths carried to each column's own levels, ends held."""
    z = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("c"), (F.col("l_linenumber") * 10.0).alias("depth")).agg(F.avg("l_quantity").alias("v"))
    levels = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c"), F.explode(F.sequence(F.lit(0), F.lit(8))).alias("level"))
    wanted = levels.withColumn("depth", F.col("level") * 10.0 + 2.5)
    out = vertical.depth_to_sigma(z, wanted, ["c"], "depth", "v", "v")
    return out.select("c", "level", F.round(F.col("v") + OFF_TIE, 6).alias("v"))


@query(
    "tin_interpolate",
    f"""
    WITH t AS (SELECT p_partkey AS tri, (p_partkey * 13 % 340) - 170.0::DOUBLE AS ax, (p_partkey * 17 % 150) - 75.0::DOUBLE AS ay, p_size / 5.0 AS s FROM part),
    u AS (SELECT tri, ax, ay, ax + s AS bx, ay + 0.5 AS b_y, ax + 0.5 AS cx, ay + s AS cy FROM t),
    d AS (SELECT o_orderkey, lon, lat, u.*, (bx - ax) * (lat - ay) - (b_y - ay) * (lon - ax) AS d1, (cx - bx) * (lat - b_y) - (cy - b_y) * (lon - bx) AS d2, (ax - cx) * (lat - cy) - (ay - cy) * (lon - cx) AS d3 FROM ({LONLAT_SQL}), u),
    h AS (SELECT o_orderkey, min(tri) AS tri FROM d WHERE NOT ((d1 < 0 OR d2 < 0 OR d3 < 0) AND (d1 > 0 OR d2 > 0 OR d3 > 0)) GROUP BY o_orderkey)
    SELECT o_orderkey, tri, round((d2 * ax + d3 * bx + d1 * cx) / (d1 + d2 + d3) * 2 + 3.1e-7, 6) AS value FROM h JOIN d USING (o_orderkey, tri) WHERE d1 + d2 + d3 <> 0""",
)
def tin_interpolate(spark, sf):
    """Linear values inside mesh triangles (here of twice the longitude, so the answer is known)."""
    t = triangles(spark, sf).withColumns({v: F.col(x) * 2.0 for v, x in (("va", "ax"), ("vb", "bx"), ("vc", "cx"))})
    pts = lonlat(spark, sf).select("o_orderkey", "lon", "lat")
    out = joins.interpolate_in_triangles(pts, t, "o_orderkey", "lon", "lat", "tri", [("ax", "ay", "va"), ("bx", "by", "vb"), ("cx", "cy", "vc")])
    return out.where("value is not null").select("o_orderkey", "tri", F.round(F.col("value") + OFF_TIE, 6).alias("value"))


@query(
    "canonical_hash",
    """SELECT c_custkey, sha256('{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}') AS hash FROM customer""",
)
def canonical_hash(spark, sf):
    """One hash per document, whatever the order of its fields."""
    straight = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))
    turned = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name"))
    c = table(spark, sf, "customer").withColumn("m", F.when(F.col("c_custkey") % 2 == 0, straight).otherwise(turned))
    return c.select("c_custkey", D.canonical_hash(F.col("m")).alias("hash"))


@query("coriolis_modes", "SELECT p_partkey, 0.0::DOUBLE AS zero, 38.5::DOUBLE AS fixed, p_size / 2.0 AS own FROM part")
def coriolis_modes(spark, sf):
    """The per-node latitude setting under each mode."""
    y = F.col("p_size") / 2.0
    return table(spark, sf, "part").select(
        "p_partkey", Z.coriolis_value("zero", y).alias("zero"), Z.coriolis_value("latitude", y, 38.5).alias("fixed"), Z.coriolis_value("node-y", y).alias("own")
    )


@query(
    "longitude_slice",
    f"""SELECT o_orderkey, round(u, 6) AS unwrapped FROM (SELECT o_orderkey, (lon - 360 * floor(lon / 360)) + 360 * ceil((165 - (lon - 360 * floor(lon / 360))) / 360) AS u FROM ({LONLAT_SQL})) WHERE u BETWEEN 165 - 1e-9 AND 205 + 1e-9""",
)
def longitude_slice(spark, sf):
    """Coordinates inside an unwrapped, padded interval over the dateline."""
    start, stop = G.unwrap_interval(170.0, -160.0, 5.0)
    u = G.unwrap_from(F.col("lon"), start)
    return lonlat(spark, sf).select("o_orderkey", u.alias("u")).where(F.col("u").between(start - 1e-9, stop + 1e-9)).select("o_orderkey", F.round("u", 6).alias("unwrapped"))


@query(
    "resolution_choice",
    """
    WITH a AS (SELECT DISTINCT p_brand, substr(p_type, 1, 1) AS tier FROM part)
    SELECT p_brand, arg_min(tier, CASE tier WHEN 'S' THEN 1 WHEN 'M' THEN 2 WHEN 'L' THEN 3 WHEN 'E' THEN 4 WHEN 'P' THEN 5 ELSE 6 END) AS tier FROM a GROUP BY p_brand""",
)
def resolution_choice(spark, sf):
    """The preferred tier among those available, per source."""
    order = F.array(*map(F.lit, "SMLEP"))
    tier = F.substring("p_type", 1, 1)
    rank = F.array_position(order, tier)
    a = table(spark, sf, "part").select("p_brand", tier.alias("tier"), F.when(rank == 0, 6).otherwise(rank).alias("rank"))
    return a.groupBy("p_brand").agg(F.min_by("tier", "rank").alias("tier"))
