"""Queries over filters, choices between records, samples and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from brackish.functions import documents as D
from brackish.functions import geo as G
from brackish.functions import names as N
from brackish.functions import timeaxis as T
from brackish.operators import boxes as box_ops
from brackish.operators import dedupe, joins, sampling
from brackish.operators.ordered import Run, running
from brackish.plans.cleaning import LONLAT_SQL, lonlat
from brackish.plans.registry import query
from brackish.sources.tables import table, union_sources


@query(
    "profile_select",
    f"""
    SELECT o_orderkey, lon, lat FROM ({LONLAT_SQL})
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31' AND (lon >= 150 OR lon <= -100) AND lat BETWEEN -60 AND 60
      AND o_orderstatus IN ('F', 'O') AND o_orderpriority NOT LIKE '5%'""",
)
def profile_select(spark, sf):
    """Closed time range, dateline box, lists, and all/any of a word list."""
    have = D.words(F.when(F.startswith("o_orderpriority", F.lit("5")), "PRES DOXY").otherwise("PRES DOXY CHLA"))
    df = lonlat(spark, sf)
    return df.where(
        F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1999-12-31").cast("timestamp_ntz"))
        & G.in_bbox(F.col("lon"), F.col("lat"), (150.0, -60.0, -100.0, 60.0))
        & F.col("o_orderstatus").isin("F", "O")
        & D.has_all(have, ["DOXY", "CHLA"]) & D.has_any(have, ["PRES"])
    ).select("o_orderkey", "lon", "lat")


@query(
    "bbox_dateline",
    """
    SELECT vec_id, round(lon, 5) AS lon, round(lat, 5) AS lat, lon >= 120 OR lon <= -120 AS wraps FROM (
      SELECT vec_id, embedding[1]::DOUBLE * 600 AS lon0, embedding[2]::DOUBLE * 300 AS lat, (embedding[1]::DOUBLE * 600 + 180) - 360 * floor((embedding[1]::DOUBLE * 600 + 180) / 360) - 180 AS lon FROM embeddings)
    WHERE (lon >= 120 OR lon <= -20) AND lat BETWEEN -60 AND 60""",
)
def bbox_dateline(spark, sf):
    """A box that crosses the dateline, over points in any longitude convention."""
    e = table(spark, sf, "embeddings").select("vec_id", (F.col("embedding")[0].cast("double") * 600).alias("lon0"), (F.col("embedding")[1].cast("double") * 300).alias("lat"))
    inside = e.where(G.in_bbox(F.col("lon0"), F.col("lat"), (120.0, -60.0, -20.0, 60.0)))
    lon = G.wrap_lon(F.col("lon0"))
    return inside.select("vec_id", F.round(lon, 5).alias("lon"), F.round("lat", 5).alias("lat"), G.in_lon_range(lon, 120.0, -120.0).alias("wraps"))


_RING = [(-60.0, -20.0), (40.0, -30.0), (80.0, 25.0), (10.0, 10.0), (-40.0, 50.0)]


def _ring_sql(x, y):
    parts = []
    for (ax, ay), (bx, by) in zip(_RING, [*_RING[1:], _RING[0]]):
        parts.append(f"(CASE WHEN ({ay} > {y}) <> ({by} > {y}) AND {x} < {ax} + ({y} - {ay}) * ({bx - ax}::DOUBLE / {by - ay}) THEN 1 ELSE 0 END)")
    return " + ".join(parts)


@query(
    "polygon_covers",
    f"""SELECT o_orderkey FROM ({LONLAT_SQL}) WHERE lon BETWEEN -60 AND 80 AND lat BETWEEN -30 AND 50 AND (({_ring_sql('lon', 'lat')}) % 2 = 1 OR (lon = -60.0 AND lat = -20.0) OR (lon = 40.0 AND lat = -30.0) OR (lon=80.0 AND lat=25.0) OR (lon=10.0 AND lat=10.0) OR (lon=-40.0 AND lat=50.0))""",
)
def polygon_covers(spark, sf):
    """Points a polygon covers, its border included; the box test comes first."""
    lon, lat = F.col("lon"), F.col("lat")
    near = lonlat(spark, sf).where(lon.between(-60, 80) & lat.between(-30, 50))
    return near.where(G.in_ring(lon, lat, _RING)).select("o_orderkey")


TILES_SQL = """SELECT p_partkey AS tile, p_size, p_brand, p_type, p_retailprice, ((p_partkey * 7) % 360) - 180.0::DOUBLE AS west, ((p_partkey * 11) % 170) - 85.0::DOUBLE AS south,
    ((p_partkey * 7) % 360) - 180.0::DOUBLE + 0.25 + p_size / 10.0::DOUBLE AS east, ((p_partkey * 11) % 170) - 85.0::DOUBLE + 0.25 + p_size / 10.0::DOUBLE AS north FROM part"""


def tiles(spark, sf):
    """Parts read as map tiles of different sizes."""
    k, side = F.col("p_partkey"), 0.25 + F.col("p_size") / 10.0
    west, south = (k * 7) % 360 - 180.0, (k * 11) % 170 - 85.0
    return table(spark, sf, "part").select(
        k.alias("tile"), "p_size", "p_brand", "p_type", "p_retailprice", west.alias("west"), south.alias("south"), (west + side).alias("east"), (south + side).alias("north")
    )


@query(
    "tiles_in_request",
    f"""
    SELECT tile, round(greatest(0.0, least(east, 20.0) - greatest(west, -30.0)) * greatest(0.0, least(north, 40.0) - greatest(south, -10.0)), 6) AS overlap
    FROM ({TILES_SQL}) WHERE west < 20 AND east > -30 AND south < 40 AND north > -10""",
)
def tiles_in_request(spark, sf):
    """Tiles that meet a request box and the area they share with it."""
    box = [F.col(c) for c in ("west", "south", "east", "north")]
    request = (-30.0, -10.0, 20.0, 40.0)
    return tiles(spark, sf).where(G.box_meets_request(box, request)).select("tile", F.round(G.overlap_area(box, request), 6).alias("overlap"))


def _union_sql(boxes: str, k: str) -> str:
    """Area covered per group: strips between neighbouring box ends, and in each the stretches that no box further south has reached."""
    return f"""
    WITH b AS (SELECT DISTINCT {k} AS k, w, s, e, n FROM ({boxes}) WHERE w < e AND s < n),
    ends AS (SELECT k, w AS x FROM b UNION SELECT k, e FROM b),
    strips AS (SELECT k, x AS x0, lead(x) OVER (PARTITION BY k ORDER BY x) AS x1 FROM ends),
    laid AS (SELECT t.k, x0, x1, s, n, max(n) OVER (PARTITION BY t.k, x0 ORDER BY s, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
        FROM strips t JOIN b ON t.k IS NOT DISTINCT FROM b.k AND b.w <= x0 AND b.e >= x1),
    areas AS (SELECT k, sum((x1 - x0) * greatest(0.0, n - greatest(s, coalesce(reached, s)))) AS area FROM laid GROUP BY k)"""


_CLIPPED_SQL = f"""SELECT p_type, greatest(west, -30.0::DOUBLE) AS w, greatest(south, -10.0::DOUBLE) AS s, least(east, 20.0::DOUBLE) AS e, least(north, 40.0::DOUBLE) AS n FROM ({TILES_SQL})"""


@query("coverage_fraction", _union_sql(_CLIPPED_SQL, "p_type") + " SELECT k AS p_type, round(area / 2500.0, 6) AS fraction FROM areas")
def coverage_fraction(spark, sf):
    """Share of a request its tiles cover, overlaps counted once."""
    met = box_ops.coverage(tiles(spark, sf), ["p_type"], ("west", "south", "east", "north"), (-30.0, -10.0, 20.0, 40.0))
    return met.select("p_type", F.round("fraction", 6).alias("fraction"))


@query("union_area", _union_sql(f"SELECT 0 AS one, west AS w, south AS s, east AS e, north AS n FROM ({TILES_SQL})", "one") + " SELECT round(area, 4) AS area FROM areas")
def union_area(spark, sf):
    """What all tiles cover together."""
    return box_ops.union_area(tiles(spark, sf), [], ("west", "south", "east", "north")).select(F.round("area", 4).alias("area"))


@query(
    "dateline_request",
    f"""
    SELECT tile, part FROM ({TILES_SQL}), (VALUES (0, 160.0, -20.0, 180.0, 30.0), (1, -180.0, -20.0, -150.0, 30.0)) AS b(part, w, s, e, n)
    WHERE west <= e AND east >= w AND south <= n AND north >= s""",
)
def dateline_request(spark, sf):
    """A request over the dateline as two boxes, touching tiles included."""
    parts = G.split_at_dateline((160.0, -20.0, -150.0, 30.0))
    box = [F.col(c) for c in ("west", "south", "east", "north")]
    hit = F.array_compact(F.array(*[F.when(G.boxes_meet(box, [F.lit(v) for v in p]), F.lit(i)) for i, p in enumerate(parts)]))
    return tiles(spark, sf).select("tile", F.explode(hit).alias("part"))


@query(
    "source_order",
    f"""
    SELECT tile, rank FROM (SELECT tile, row_number() OVER (PARTITION BY p_type ORDER BY CASE p_brand WHEN 'Brand#1' THEN 1 WHEN 'Brand#2' THEN 2 ELSE 9 END, p_size * 30.87, tile)::INTEGER AS rank FROM ({TILES_SQL}) WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3'))
    WHERE rank <= 5""",
)
def source_order(spark, sf):
    """The five best sources per kind by priority, resolution and name."""
    t = tiles(spark, sf).where(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"))
    priority = F.when(F.col("p_brand") == "Brand#1", 1).when(F.col("p_brand") == "Brand#2", 2).otherwise(9)
    return dedupe.top_per_key(t, ["p_type"], [priority, F.col("p_size") * 30.87, F.col("tile")], 5).select("tile", "rank")


@query(
    "preferred_tier",
    f"""
    WITH c AS (SELECT * FROM ({TILES_SQL}) WHERE west <= 20 AND east >= -30 AND south <= 40 AND north >= -10),
    n AS (SELECT p_type, count(*) AS n FROM c GROUP BY p_type HAVING count(*) <= 1000000)
    SELECT tile, p_type FROM c WHERE p_type = (SELECT p_type FROM n WHERE p_type IN ('SMALL', 'ECONOMY', 'STANDARD') ORDER BY CASE p_type WHEN 'STANDARD' THEN 1 WHEN 'SMALL' THEN 2 ELSE 3 END LIMIT 1)""",
)
def preferred_tier(spark, sf):
    """Tiles of the first resolution tier with a usable number of them."""
    box = [F.col(c) for c in ("west", "south", "east", "north")]
    met = tiles(spark, sf).where(G.boxes_meet(box, [F.lit(v) for v in (-30.0, -10.0, 20.0, 40.0)]))
    return sampling.preferred_tier(met, "p_type", ["STANDARD", "SMALL", "ECONOMY"], 1_000_000).select("tile", "p_type")


@query(
    "rule_select",
    r"""
    SELECT p_partkey, CASE WHEN regexp_matches(lower(p_name), 'bolt$') THEN 'matched pattern' WHEN p_name = 'red widget' AND p_size < 20 THEN 'small metadata' WHEN p_type = 'ECONOMY' THEN 'economy item' END AS reason
    FROM part""",
)
def rule_select(spark, sf):
    """Selection reason from ordered rules, a pattern first."""
    rules = [
        (F.col("p_name").rlike("(?i)BOLT$"), "matched pattern"),
        ((F.col("p_name") == "red widget") & (F.col("p_size") < 20), "small metadata"),
        (F.col("p_type") == "ECONOMY", "economy item"),
    ]
    return table(spark, sf, "part").select("p_partkey", D.choose_by_rules(rules).alias("reason"))


@query(
    "nearest_time",
    """
    SELECT user_id, arg_min(ts, (abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')), ts)) AS nearest, count(*) FILTER (ts = TIMESTAMP '2024-01-15 12:00:00') AS exact FROM events GROUP BY user_id""",
)
def nearest_time(spark, sf):
    """Exact hits of a requested time and, for the message, the nearest one."""
    want = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    away = F.struct(F.abs(T.micros(F.col("ts")) - T.micros(want)), F.col("ts"))
    return table(spark, sf, "events").groupBy("user_id").agg(F.min_by("ts", away).alias("nearest"), F.count_if(F.col("ts") == want).alias("exact"))


@query(
    "dedupe_preference",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey % 4 ORDER BY CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END, l_shipdate DESC, l_extendedprice, l_partkey, l_suppkey, l_linenumber) AS r FROM lineitem) WHERE r = 1""",
)
def dedupe_preference(spark, sf):
    """One record per identity by source preference, then newest."""
    li = table(spark, sf, "lineitem").withColumn("tile", F.col("l_partkey") % 4)
    pref = F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "R", 1).otherwise(2)
    best = dedupe.best_per_key(li, ["l_orderkey", "tile"], [pref, F.col("l_shipdate").desc(), "l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber"])
    return best.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice")


@query(
    "conflict_detect",
    """
    WITH b AS (SELECT *, CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS rk, 'k' || l_partkey || '-' || l_suppkey || '-' || l_extendedprice::VARCHAR AS nm FROM lineitem),
    t AS (SELECT *, max(rk) OVER (PARTITION BY l_orderkey) AS top, count(*) OVER (PARTITION BY l_orderkey) AS n FROM b)
    SELECT l_orderkey, min(n) AS candidates, count(*) AS winners, CASE WHEN count(*) = 1 THEN 'single' WHEN count(DISTINCT l_linestatus) = 1 THEN 'identical' ELSE 'conflict' END AS verdict
    FROM t WHERE rk = top GROUP BY l_orderkey""",
)
def conflict_detect(spark, sf):
    """Best-ranked candidates that agree, stand alone or contradict each other."""
    li = table(spark, sf, "lineitem").withColumn("nm", F.concat_ws("-", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"))
    v = dedupe.rank_conflicts(li, ["l_orderkey"], F.when(F.col("l_returnflag") == "N", 1).otherwise(0), [F.col("l_linestatus")], "nm")
    return v.select("l_orderkey", "candidates", "winners", "verdict")


@query(
    "rejected_candidates",
    """
    WITH b AS (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 1 ELSE 0 END AS rk FROM orders),
    t AS (SELECT *, max(rk) OVER (PARTITION BY o_custkey) AS top FROM b),
    w AS (SELECT o_custkey, min(o_orderkey) AS preferred FROM t WHERE rk = top GROUP BY o_custkey)
    SELECT t.o_orderkey, w.preferred, CASE WHEN rk = top THEN 'same_rank_identical_remote_metadata' ELSE 'lower_archive_or_layout_preference' END AS reason
    FROM t JOIN w USING (o_custkey) WHERE t.o_orderkey <> w.preferred""",
)
def rejected_candidates(spark, sf):
    """Every record that was not chosen, why, and what was chosen."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    rank = F.when(F.col("o_orderstatus") == "O", 2).when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    v = dedupe.rank_conflicts(o, ["o_custkey"], rank, [F.lit("same")], "o_orderkey")
    return dedupe.rejected_candidates(o, v, ["o_custkey"], rank, "o_orderkey").select("o_orderkey", "preferred", "reason")


@query(
    "covering_intervals",
    """
    SELECT o_orderkey, coalesce(e > max(e) OVER (PARTITION BY o_orderpriority ORDER BY s, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS adds
    FROM (SELECT o_orderkey, o_orderpriority, epoch_us(o_orderdate) // 1000000 AS s, epoch_us(o_orderdate) // 1000000 + (o_custkey % 30 + 1) * 86400 AS e FROM orders)""",
)
def covering_intervals(spark, sf):
    """Intervals that add coverage to those before them (greedy cover, oldest first)."""
    s = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", s.alias("s"), (s + (F.col("o_custkey") % 30 + 1) * 86400).alias("e"))
    return dedupe.covering_intervals(o, ["o_orderpriority"], "s", "e", ["o_orderkey"]).select("o_orderkey", "adds")


@query(
    "singleton_groups",
    """SELECT min(event_id) AS event_id FROM events GROUP BY user_id, event_type, date_trunc('day', ts) HAVING count(*) = 1""",
)
def singleton_groups(spark, sf):
    """Records alone in their group."""
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return dedupe.singletons(e, ["user_id", "event_type", "day"], ["event_id"]).select("event_id")


@query(
    "stratified_sample",
    """
    SELECT doc_id, lang, source, turn FROM (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY sha256(doc_id::VARCHAR), doc_id)::INTEGER AS turn FROM documents)
    ORDER BY turn, lang, source LIMIT 200""",
)
def stratified_sample(spark, sf):
    """A repeatable round-robin sample over strata."""
    return sampling.stratified_sample(table(spark, sf, "documents").select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", 200)


@query(
    "sampled_bytes",
    """
    WITH s AS (SELECT n_chars FROM (SELECT doc_id, n_chars, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY sha256(doc_id::VARCHAR), doc_id) AS turn FROM documents) ORDER BY turn, lang, source LIMIT 64)
    SELECT count(n_chars) AS files_probed, quantile_disc(n_chars, 0.95) AS sample_p95, max(n_chars) AS sample_max, greatest(quantile_disc(n_chars, 0.95), max(n_chars)) * (SELECT count(*) FROM documents) AS conservative_bytes FROM s""",
)
def sampled_bytes(spark, sf):
    """Total size estimated from a stratified sample, on the safe side."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return sampling.conservative_bytes(sampling.stratified_sample(docs, ["lang", "source"], "doc_id", 64), "n_chars", docs.count())


@query("topk_hotspots", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def topk_hotspots(spark, sf):
    """The fifty largest values, ties by index."""
    return sampling.largest(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), F.col("o_totalprice"), ["o_orderkey"], 50)


@query(
    "best_trial",
    """
    SELECT o_custkey, arg_min(o_orderkey, (CASE WHEN o_orderstatus = 'F' AND o_totalprice < 100000 THEN 0 WHEN o_orderstatus = 'F' THEN 1 WHEN o_totalprice <= 0.95 * 300000 THEN 2 ELSE 3 END, o_totalprice, o_orderkey)) AS chosen
    FROM orders GROUP BY o_custkey""",
)
def best_trial(spark, sf):
    """Tiered choice: full pass, partial pass, enough improvement, then the rest."""
    done = F.col("o_orderstatus") == "F"
    tier = F.when(done & (F.col("o_totalprice") < 100000), 0).when(done, 1).when(F.col("o_totalprice") <= 0.95 * 300000, 2).otherwise(3)
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", F.struct(tier, "o_totalprice", "o_orderkey")).alias("chosen"))


@query(
    "evenly_spaced",
    """
    SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
    WHERE i IN (round_even(0 * (n - 1) / 4.0, 0), round_even(1 * (n - 1) / 4.0, 0), round_even(2 * (n - 1) / 4.0, 0), round_even(3 * (n - 1) / 4.0, 0), n - 1)""",
)
def evenly_spaced(spark, sf):
    """Five evenly spaced positions of each ordered chain."""
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    ranked = running(o, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], {"i": Run("row_index")}).withColumn("i", F.col("i") - 1)
    sized = ranked.join(o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")), "o_orderpriority")
    return sampling.evenly_spaced(sized, ["o_orderpriority"], "i", "n", 5).select("o_orderkey")


@query(
    "plan_vs_manifest",
    """
    SELECT coalesce(a.k, b.k) AS o_orderkey, a.s AS left_size, b.s AS right_size, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'extra' ELSE 'size_mismatch' END AS problem
    FROM (SELECT o_orderkey AS k, o_totalprice AS s FROM orders WHERE o_orderkey % 10 <> 3) a
    FULL JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 17 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS s FROM orders WHERE o_orderkey % 10 <> 5) b ON a.k = b.k
    WHERE a.k IS NULL OR b.k IS NULL OR a.s IS DISTINCT FROM b.s""",
)
def plan_vs_manifest(spark, sf):
    """Planned and delivered sets: missing, extra, different."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    changed = F.when(F.col("o_orderkey") % 17 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return joins.crosscheck(o.where("o_orderkey % 10 <> 3"), o.where("o_orderkey % 10 <> 5").withColumn("o_totalprice", changed), ["o_orderkey"], "o_totalprice")


@query(
    "recheck_revisions",
    """
    SELECT a.o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'disappeared' ELSE 'updated' END AS change FROM orders a
    LEFT JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS d FROM orders WHERE o_orderkey % 29 <> 1) b ON a.o_orderkey = b.o_orderkey
    WHERE b.o_orderkey IS NULL OR a.o_orderdate IS DISTINCT FROM b.d""",
)
def recheck_revisions(spark, sf):
    """Planned rows whose revision is not the current one."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    newer = F.when(F.col("o_orderkey") % 13 == 0, F.col("o_orderdate") + F.expr("interval 1 day")).otherwise(F.col("o_orderdate"))
    return joins.changed_rows(o, o.where("o_orderkey % 29 <> 1").withColumn("o_orderdate", newer), ["o_orderkey"], "o_orderdate").select("o_orderkey", "change")


@query(
    "fallback_union",
    """
    SELECT c_custkey AS k, 'primary' AS origin FROM customer WHERE c_custkey % 3 <> 0
    UNION ALL SELECT DISTINCT o_custkey, 'fallback' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)""",
)
def fallback_union(spark, sf):
    """Primary records, and the fallback only for what they lack."""
    first = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.lit("primary").alias("origin"))
    second = table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct().withColumn("origin", F.lit("fallback"))
    return joins.with_fallback(first, second, ["k"])


@query(
    "union_catalogues",
    """
    SELECT 'customer' AS source_name, c_custkey AS id, c_acctbal AS size, NULL::INTEGER AS resolution FROM customer UNION ALL
    SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier UNION ALL SELECT 'part', p_partkey, NULL, p_size FROM part""",
)
def union_catalogues(spark, sf):
    """Catalogues of different shape under one schema."""
    c = table(spark, sf, "customer").select(F.lit("customer").alias("source_name"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("size"))
    s = table(spark, sf, "supplier").select(F.lit("supplier").alias("source_name"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("size"))
    p = table(spark, sf, "part").select(F.lit("part").alias("source_name"), F.col("p_partkey").alias("id"), F.col("p_size").alias("resolution"))
    return union_sources([c, s, p])


@query(
    "set_algebra",
    """
    SELECT 'both' AS part, k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL
    SELECT 'customer_only', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL
    SELECT 'either', k FROM (SELECT c_nationkey + 1000 AS k FROM customer UNION SELECT s_nationkey + 1000 FROM supplier) UNION ALL
    SELECT 'semi', n_nationkey FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 500)""",
)
def set_algebra(spark, sf):
    """Intersection, difference, distinct union and semi join of key sets."""
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    ck, sk = c.select(F.col("c_nationkey").cast("long").alias("k")), s.select(F.col("s_nationkey").cast("long").alias("k"))
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    poor = s.where("s_acctbal < 500").select(F.col("s_nationkey").alias("n_nationkey"))
    parts = {
        "both": ck.intersect(sk),
        "customer_only": c.select(F.col("c_custkey").alias("k")).subtract(orders),
        "either": ck.union(sk).distinct().select((F.col("k") + 1000).alias("k")),
        "semi": table(spark, sf, "nation").join(poor, "n_nationkey", "left_semi").select(F.col("n_nationkey").cast("long").alias("k")),
    }
    return union_sources([df.withColumn("part", F.lit(n)).select("part", "k") for n, df in parts.items()])


@query(
    "interval_intersection",
    """
    SELECT o_orderkey, greatest(a0, b0) AS start, least(a1, b1) AS stop FROM (SELECT o_orderkey, o_custkey AS a0, o_custkey + 200 AS a1, o_orderkey % 1000 AS b0, o_orderkey % 1000 + 300 AS b1 FROM orders) WHERE greatest(a0, b0) < least(a1, b1)""",
)
def interval_intersection(spark, sf):
    """Index ranges intersected; empty ones drop out."""
    c, k = F.col("o_custkey"), F.col("o_orderkey") % 1000
    both = table(spark, sf, "orders").select("o_orderkey", F.greatest(c, k).alias("start"), F.least(c + 200, k + 300).alias("stop"))
    return both.where("start < stop")


@query(
    "ordered_request",
    """SELECT ord, event_type, count(event_id) AS n FROM (VALUES (1, 'view'), (2, 'click'), (3, 'absent')) AS r(ord, event_type) LEFT JOIN events USING (event_type) GROUP BY ord, event_type""",
)
def ordered_request(spark, sf):
    """Requested names in requested order, with what was found for each."""
    wanted = ["view", "click", "absent"]
    place = F.array_position(F.array(*map(F.lit, wanted)), F.col("event_type"))
    found = table(spark, sf, "events").where(F.col("event_type").isin(wanted)).groupBy(place.cast("int").alias("ord")).agg(F.count("event_id").alias("n"))
    request = spark.range(1).select(F.posexplode(F.array(*map(F.lit, wanted))).alias("ord", "event_type"))
    request = request.withColumn("ord", F.col("ord") + 1)
    return request.join(found, "ord", "left").select("ord", "event_type", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "identity_join",
    """
    SELECT l.event_id, sha256(l.event_type || '|' || l.user_id) AS identity, o.n AS same_identity FROM events l JOIN (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL) o USING (event_type, user_id)""",
)
def identity_join(spark, sf):
    """Records joined to what was planned under the same identity hash."""
    e = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    keyed = e.withColumn("identity", N.identity_hash(F.col("event_type"), F.col("user_id")))
    counts = e.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("same_identity"))
    planned = counts.select(N.identity_hash(F.col("event_type"), F.col("user_id")).alias("identity"), "same_identity")
    return keyed.join(planned, "identity").select("event_id", "identity", "same_identity")
