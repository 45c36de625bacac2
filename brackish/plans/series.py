"""Queries over time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from brackish.functions import geo as G
from brackish.functions import timeaxis as T
from brackish.functions.vectors import DEGREES_PER_HOUR
from brackish.operators import filters, joins, series, spectra
from brackish.operators import nearest as spatial_ops
from brackish.operators.ordered import Run, plan_slices, running
from brackish.plans.cleaning import LONLAT_SQL, lonlat
from brackish.plans.registry import OFF_TIE, query
from brackish.sources.tables import table


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


GAPPY_SQL = "SELECT event_id, user_id, ts, event_type, CASE WHEN (event_id // 3) % 4 <> 1 AND event_id % 7 <> 2 THEN value END AS v FROM events"


def gappy(spark, sf):
    """Events with values missing by a fixed rule, in runs."""
    k = F.col("event_id")
    keep = (F.floor(k / 3) % 4 != 1) & (k % 7 != 2)
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", F.when(keep, F.col("value")).alias("v"))


@query(
    "expected_gaps",
    """
    SELECT event_type, t FROM (SELECT event_type, unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-12 23:55:00', INTERVAL 5 MINUTE)) AS t FROM (SELECT DISTINCT event_type FROM events))
    WHERE (event_type, t) NOT IN (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) FROM events)""",
)
def expected_gaps(spark, sf):
    """Expected five-minute times that nothing covers, per kind."""
    e = table(spark, sf, "events")
    bounds = e.select("event_type").distinct().select("event_type", stamp("2024-01-03").alias("a"), stamp("2024-01-13").alias("b"))
    grid = series.time_grid(bounds, ["event_type"], "a", "b", 300, "t")
    have = e.select("event_type", T.floor_to_step(F.col("ts"), 300).alias("t"))
    return series.missing_times(grid, have, ["event_type", "t"])


@query(
    "snap_time",
    """
    SELECT event_id, CASE WHEN abs(us - n) <= 60000000 THEN make_timestamp(n) ELSE ts END AS snapped, CASE WHEN abs(us - n) <= 60000000 THEN (us - n) / 1e6 ELSE 0.0 END AS offset_seconds,
      CASE WHEN abs(us - h) <= 60000000 THEN make_timestamp(h) ELSE ts END AS half_hour
    FROM (SELECT event_id, ts, epoch_us(ts) AS us, CAST(round_even(epoch_us(ts) / 360e6, 0) * 360e6 AS BIGINT) AS n, CAST(round_even((epoch_us(ts) - 1800e6) / 3600e6, 0) * 3600e6 + 1800e6 AS BIGINT) AS h FROM events)""",
)
def snap_time(spark, sf):
    """Times moved to a six-minute cadence, and to half past the hour, within a minute."""
    e = series.snapped(table(spark, sf, "events").select("event_id", "ts"), "ts", 360, 60)
    return e.select("event_id", "snapped", "offset_seconds", T.snap(F.col("ts"), 3600, 60, 1800).alias("half_hour"))


@query(
    "gaps_islands",
    f"""
    WITH f AS (SELECT *, v IS NULL AS gone, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, v IS NULL ORDER BY ts, event_id) AS g FROM ({GAPPY_SQL}))
    SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS length FROM f WHERE gone GROUP BY user_id, g""",
)
def gaps_islands(spark, sf):
    """Every run of missing values per series, with its ends and length."""
    return series.run_lengths(gappy(spark, sf), ["user_id"], ["ts", "event_id"], F.col("v").isNull()).select("user_id", "first", "last", "length")


@query(
    "longest_run",
    f"""
    WITH f AS (SELECT *, v IS NULL AS gone, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - row_number() OVER (PARTITION BY event_type, v IS NULL ORDER BY ts, event_id) AS g FROM ({GAPPY_SQL}))
    SELECT event_type, max(n) AS longest FROM (SELECT event_type, g, count(*) FILTER (gone) AS n FROM f GROUP BY event_type, gone, g) GROUP BY event_type""",
)
def longest_run(spark, sf):
    """Longest run of missing values per kind."""
    return series.longest_run(gappy(spark, sf), ["event_type"], ["ts", "event_id"], F.col("v").isNull())


_FILL_SQL = f"""
    WITH n AS (SELECT *, row_number() OVER w AS i FROM ({GAPPY_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS pi,
      last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS pv,
      first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni,
      first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv FROM n)
    SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN RULE THEN CASE WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (i - pi)::DOUBLE / (ni - pi) END END, 6) AS filled FROM s"""


@query("gap_fill_first_n", _FILL_SQL.replace("RULE", "i - pi <= 2"))
def gap_fill_first_n(spark, sf):
    """The first two rows of every gap filled on the line, trailing ones held."""
    return series.fill_gaps(gappy(spark, sf), ["user_id"], ["ts", "event_id"], "v", 2, "first_n").select("event_id", F.round("filled", 6).alias("filled"))


@query("gap_fill_whole", _FILL_SQL.replace("RULE", "ni - pi - 1 <= 2"))
def gap_fill_whole(spark, sf):
    """Only gaps of at most two rows filled."""
    return series.fill_gaps(gappy(spark, sf), ["user_id"], ["ts", "event_id"], "v", 2, "whole_gap").select("event_id", F.round("filled", 6).alias("filled"))


@query(
    "fill_line",
    """
    WITH b AS (SELECT event_id, user_id, epoch_us(ts) AS x, CASE WHEN (event_id // 3) % 4 <> 1 AND event_id % 7 <> 2 THEN value END AS v FROM events),
    s AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER p AS px, last_value(v IGNORE NULLS) OVER p AS pv, first_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER f AS nx, first_value(v IGNORE NULLS) OVER f AS nv
      FROM b WINDOW p AS (PARTITION BY user_id ORDER BY x ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY user_id ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * ((x - px)::DOUBLE / (nx - px)) END, 6) AS filled FROM s""",
)
def fill_line(spark, sf):
    """Missing values linear in time, ends held."""
    return series.fill_line(gappy(spark, sf), ["user_id"], "ts", "v").select("event_id", F.round("filled", 6).alias("filled"))


@query(
    "resample_linear",
    """
    WITH d AS (SELECT event_type, epoch_us(date_trunc('day', ts) + INTERVAL 12 HOUR) AS x, avg(value) AS v FROM events GROUP BY ALL),
    g AS (SELECT event_type, unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-29 23:00:00', INTERVAL 1 HOUR)) AS t FROM (SELECT DISTINCT event_type FROM events)),
    j AS (SELECT g.event_type, g.t, epoch_us(g.t) AS x, p.x AS px, p.v AS pv, n.x AS nx, n.v AS nv FROM g ASOF LEFT JOIN d p ON g.event_type = p.event_type AND epoch_us(g.t) >= p.x ASOF LEFT JOIN d n ON g.event_type = n.event_type AND epoch_us(g.t) <= n.x)
    SELECT event_type, t, round(CASE WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv WHEN nx = px THEN pv ELSE pv + (nv - pv) * ((x - px)::DOUBLE / (nx - px)) END + 3.1e-7, 6) AS value FROM j""",
)
def resample_linear(spark, sf):
    """Daily means at noon to hourly values, ends held."""
    e = table(spark, sf, "events")
    daily = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("value").alias("v"))
    bounds = e.select("event_type").distinct().select("event_type", stamp("2024-01-02").alias("a"), stamp("2024-01-30").alias("b"))
    grid = series.time_grid(bounds, ["event_type"], "a", "b", 3600, "t")
    cut = plan_slices(e.withColumnRenamed("ts", "t"), "t")
    return series.daily_to_hourly(daily, ["event_type"], "day", "v", grid, "value", cut).select("event_type", "t", F.round(F.col("value") + OFF_TIE, 6).alias("value"))


@query(
    "interpolate_guarded",
    """
    WITH s AS (SELECT user_id, epoch_us(ts) AS x, value AS v FROM events),
    g AS (SELECT user_id, unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-28 18:00:00', INTERVAL 6 HOUR)) AS t FROM (SELECT DISTINCT user_id FROM events)),
    j AS (SELECT g.user_id, g.t, epoch_us(g.t) AS x, p.x AS px, p.v AS pv, n.x AS nx, n.v AS nv FROM g ASOF LEFT JOIN s p ON g.user_id = p.user_id AND epoch_us(g.t) >= p.x ASOF LEFT JOIN s n ON g.user_id = n.user_id AND epoch_us(g.t) <= n.x)
    SELECT user_id, t, round(CASE WHEN nx = px THEN pv WHEN nx - px <= 36000000000 THEN pv + (nv - pv) * ((x - px)::DOUBLE / (nx - px)) END, 6) AS value FROM j""",
)
def interpolate_guarded(spark, sf):
    """Linear values at target times; brackets wider than ten hours and outside times are null."""
    e = table(spark, sf, "events")
    bounds = e.select("user_id").distinct().select("user_id", stamp("2024-01-02").alias("a"), stamp("2024-01-29").alias("b"))
    grid = series.time_grid(bounds, ["user_id"], "a", "b", 21600, "ts")
    out = series.interpolate_at(grid, e.select("user_id", "ts", "value"), ["user_id"], "ts", "value", "value", max_gap=36_000_000_000)
    return out.select("user_id", F.col("ts").alias("t"), F.round("value", 6).alias("value"))


@query(
    "asof_join",
    """
    SELECT l.event_id, r.event_id AS latest_id, r.value AS latest_value FROM (SELECT * FROM events WHERE event_type = 'error') l
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') r ON l.user_id = r.user_id AND l.ts >= r.ts""",
)
def asof_join(spark, sf):
    """Each error with the latest view of the same user before it."""
    e = table(spark, sf, "events")
    left = e.where("event_type = 'error'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("latest_id"), F.col("value").alias("latest_value"))
    return series.asof_join(left, right, ["user_id"], "ts", ["latest_id", "latest_value"], ["latest_id"]).select("event_id", "latest_id", "latest_value")


@query(
    "gap_guard",
    """
    WITH s AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
    m AS (SELECT user_id, floor(median(epoch_us(ts) - epoch_us(prev))) AS c FROM s GROUP BY user_id)
    SELECT user_id, prev AS gap_start, ts AS gap_end, (epoch_us(ts) - epoch_us(prev)) / 1e6 AS gap_seconds, c / 1e6 AS cadence_seconds FROM s JOIN m USING (user_id) WHERE epoch_us(ts) - epoch_us(prev) > 3 * c""",
)
def gap_guard(spark, sf):
    """Steps longer than three times the median step of their series."""
    return series.wide_gaps(table(spark, sf, "events"), ["user_id"], "ts")


@query(
    "block_mean",
    """
    WITH n AS (SELECT event_type, ts, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events),
    b AS (SELECT event_type, i // 24 AS block, avg(value) AS mean, count(*) AS rows FROM n GROUP BY ALL)
    SELECT b.event_type, b.block, round(mean, 6) AS mean, rows, ts AS stamp FROM b JOIN n ON n.event_type = b.event_type AND n.i = b.block * 24 + rows // 2""",
)
def block_mean(spark, sf):
    """Means of every 24 records, stamped in the middle; the rest block is kept."""
    b = series.block_means(table(spark, sf, "events"), ["event_type"], ["ts", "event_id"], "value", 24)
    return b.select("event_type", "block", F.round("mean", 6).alias("mean"), "rows", "stamp")


@query(
    "running_distance",
    f"""
    WITH p AS (SELECT o_custkey, o_orderkey, lon, lat, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat FROM ({LONLAT_SQL}) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
    d AS (SELECT *, CASE WHEN plon IS NULL THEN 0.0 ELSE 2 * 6371.0088 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians((lon - plon + 540.0) - 360.0 * floor((lon - plon + 540.0) / 360.0) - 180.0) / 2), 2))) END AS step FROM p)
    SELECT o_orderkey, round(sum(step) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING), 5) AS km FROM d""",
)
def running_distance(spark, sf):
    """Great-circle distance along each ordered chain of points."""
    pts = lonlat(spark, sf).select("o_custkey", "o_orderkey", "lon", "lat")
    cut = plan_slices(pts, "o_orderkey")
    here = running(pts, ["o_custkey"], ["o_orderkey"], {"plon": Run("lag", F.col("lon")), "plat": Run("lag", F.col("lat"))}, cut)
    step = F.coalesce(G.haversine_km(F.col("plon"), F.col("plat"), F.col("lon"), F.col("lat")), F.lit(0.0))
    return running(here.withColumn("step", step), ["o_custkey"], ["o_orderkey"], {"km": Run("sum", F.col("step"))}, cut).select("o_orderkey", F.round("km", 5).alias("km"))


@query(
    "running_flux",
    """
    WITH s AS (SELECT event_id, user_id, ts, value, epoch_us(ts) - coalesce(epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)), epoch_us(ts)) AS dt FROM events)
    SELECT event_id, round(sum(value * (dt / 1e6)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING), 3) AS cumulative FROM s""",
)
def running_flux(spark, sf):
    """Running integral of a rate over time."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return series.running_integral(e, ["user_id"], "ts", F.col("value")).select("event_id", F.round("cumulative", 3).alias("cumulative"))


@query(
    "median_flux",
    """
    WITH m AS (SELECT date_trunc('day', ts) AS day, median(value) AS p, median(-value / 10.0) AS e FROM events GROUP BY ALL),
    s AS (SELECT day, (p + e) * coalesce(epoch_us(day) - epoch_us(lag(day) OVER (ORDER BY day)), 0) / 1e6 AS part FROM m)
    SELECT day, round(sum(part) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING), 3) AS cumulative FROM s""",
)
def median_flux(spark, sf):
    """Domain median per time of gain and loss, then the running sum of their net over time."""
    from brackish.operators.quantiles import with_quantiles

    e = table(spark, sf, "events").withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    gain = with_quantiles(e, ["day"], F.col("value"), [0.5], "p")
    loss = with_quantiles(e, ["day"], -F.col("value") / 10.0, [0.5], "e")
    net = gain.join(loss, "day").select("day", (F.col("p")[0] + F.col("e")[0]).alias("net"))
    return series.running_integral(net, [], "day", F.col("net")).select("day", F.round("cumulative", 3).alias("cumulative"))


@query(
    "every_nth",
    """
    WITH k AS (SELECT event_id, ts, (row_number() OVER (ORDER BY ts, event_id) - 1) AS i FROM events), f AS (SELECT event_id, ts, i // 6 AS frame FROM k WHERE i % 6 = 0),
    p AS (SELECT DISTINCT round_even(j * ((SELECT count(*) FROM f) - 1) / 399.0::DOUBLE, 0) AS frame FROM range(400) r(j))
    SELECT event_id, ts, f.frame::BIGINT AS frame FROM f WHERE (SELECT count(*) FROM f) <= 400 OR f.frame IN (SELECT frame FROM p)""",
)
def every_nth(spark, sf):
    """Every sixth record, then evenly down to four hundred frames."""
    return series.every_nth(table(spark, sf, "events").select("event_id", "ts"), ["ts", "event_id"], 6, 400)


@query(
    "consecutive_chunks",
    """
    WITH d AS (SELECT DISTINCT o_orderkey AS y FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 50 <> 9), r AS (SELECT y, y - row_number() OVER (ORDER BY y) AS g FROM d),
    c AS (SELECT y, g, (y - min(y) OVER (PARTITION BY g)) // 4 AS p FROM r)
    SELECT min(y) AS first, max(y) AS last, count(*) AS n FROM c GROUP BY g, p""",
)
def consecutive_chunks(spark, sf):
    """Missing numbers cut into consecutive runs of at most four."""
    have = table(spark, sf, "orders").where("o_orderkey % 7 <> 0 and o_orderkey % 50 <> 9")
    return series.consecutive_chunks(have, "o_orderkey", 4)


@query(
    "load_series",
    """
    WITH u AS (SELECT event_id, event_type, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS source_file, epoch_us(ts) AS us FROM events),
    s AS (SELECT *, CAST(round_even(us / 3600e6, 0) * 3600e6 AS BIGINT) AS n FROM u), t AS (SELECT *, CASE WHEN abs(us - n) <= 900000000 THEN make_timestamp(n) ELSE make_timestamp(us) END AS ts FROM s),
    w AS (SELECT * FROM t WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25')
    SELECT event_type, ts, min(source_file) AS source_file FROM w GROUP BY event_type, ts""",
)
def load_series(spark, sf):
    """Files of one series: snapped, earliest file kept at a doubled time, cropped half-open."""
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    files = [e.where("event_id % 3 = 0"), e.where("event_id % 3 <> 0")]
    one = series.load_series(files, ["event_type"], "ts", 3600, 900, stamp("2024-01-05"), stamp("2024-01-25"))
    return one.select("event_type", "ts", "source_file")


@query(
    "time_audit",
    """
    WITH r AS (SELECT event_type, make_timestamp(CAST(round_even(epoch_us(ts) / 3600e6, 0) * 3600e6 AS BIGINT)) AS t, (epoch_us(ts) - round_even(epoch_us(ts) / 3600e6, 0) * 3600e6) / 1e6 AS off FROM events),
    p AS (SELECT event_type, t, count(*) AS n, max(abs(off)) AS off FROM r WHERE abs(off) <= 600 GROUP BY ALL),
    g AS (SELECT event_type, unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-27 23:00:00', INTERVAL 1 HOUR)) AS t FROM (SELECT DISTINCT event_type FROM events))
    SELECT coalesce(g.event_type, p.event_type) AS event_type, count(g.t) AS expected, count(p.t) AS delivered, count(*) FILTER (p.t IS NULL) AS missing, count(*) FILTER (p.n > 1) AS doubled, count(*) FILTER (g.t IS NULL) AS unexpected, max(p.off) AS largest_offset
    FROM g FULL JOIN p ON g.event_type = p.event_type AND g.t = p.t GROUP BY ALL""",
)
def time_audit(spark, sf):
    """Expected, delivered, missing and doubled hours, and the largest adjustment."""
    e = table(spark, sf, "events")
    hours = T.from_micros(T.snapped_micros(F.col("ts"), 3600))
    r = e.select("event_type", hours.alias("t"), ((T.micros(F.col("ts")) - T.snapped_micros(F.col("ts"), 3600)) / 1e6).alias("off")).where(F.abs("off") <= 600)
    bounds = e.select("event_type").distinct().select("event_type", stamp("2024-01-03").alias("a"), stamp("2024-01-28").alias("b"))
    return series.time_audit(r, series.time_grid(bounds, ["event_type"], "a", "b", 3600, "t"), ["event_type"], "t", "off")


@query(
    "interval_overlap",
    """
    SELECT a.o_orderkey, b.o_orderkey AS other FROM (SELECT o_orderkey, o_custkey, epoch_us(o_orderdate) // 1000000 AS s, epoch_us(o_orderdate) // 1000000 + (o_orderkey % 200 + 1) * 86400 AS e FROM orders) a
    JOIN (SELECT o_orderkey, o_custkey, epoch_us(o_orderdate) // 1000000 AS s, epoch_us(o_orderdate) // 1000000 + (o_orderkey % 30 + 1) * 86400 AS e FROM orders WHERE o_orderstatus = 'F') b
    ON a.o_custkey = b.o_custkey AND a.s < b.e AND a.e > b.s""",
)
def interval_overlap(spark, sf):
    """Pairs of half-open intervals that overlap, per customer."""
    s = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", s.alias("s"))
    a = o.select("o_orderkey", "o_custkey", "s", (F.col("s") + (F.col("o_orderkey") % 200 + 1) * 86400).alias("e"))
    b = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("other"), "o_custkey", F.col("s").alias("s2"), (F.col("s") + (F.col("o_orderkey") % 30 + 1) * 86400).alias("e2"))
    return joins.overlapping_intervals(a, b, ("s", "e"), ("s2", "e2"), ["o_custkey"]).select("o_orderkey", "other")


@query(
    "interval_windows",
    """
    SELECT w, count(*) AS n, sum(o_totalprice)::DECIMAL(38,2)::DOUBLE AS total FROM (SELECT o_totalprice, epoch_us(o_orderdate) // 1000000 AS s, epoch_us(o_orderdate) // 1000000 + (o_orderkey % 60 + 1) * 86400 AS e FROM orders) o
    JOIN (SELECT DISTINCT date_trunc('month', o_orderdate) AS w FROM orders) m ON o.s < epoch_us(w + INTERVAL 1 MONTH) // 1000000 AND o.e > epoch_us(w) // 1000000 GROUP BY w""",
)
def interval_windows(spark, sf):
    """Records whose interval meets each calendar month."""
    o = table(spark, sf, "orders")
    s = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    spans = o.select("o_totalprice", s.alias("s"), (s + (F.col("o_orderkey") % 60 + 1) * 86400).alias("e"))
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    months = o.select(month.alias("w")).distinct()
    seconds = lambda c: F.unix_seconds(c.cast("timestamp"))
    months = months.select("w", seconds(F.col("w")).alias("s2"), seconds(F.col("w") + F.expr("interval 1 month")).alias("e2"))
    met = joins.overlapping_intervals(spans, months, ("s", "e"), ("s2", "e2"))
    return met.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query(
    "minimal_lon_interval",
    """
    WITH d AS (SELECT DISTINCT c_nationkey AS k, round((c_custkey * 37 % 3000) / 10.0, 6)::DOUBLE + 200 - 360 * floor((round((c_custkey * 37 % 3000) / 10.0, 6)::DOUBLE + 200) / 360) AS x FROM customer),
    g AS (SELECT k, x, coalesce(lead(x) OVER (PARTITION BY k ORDER BY x), min(x) OVER (PARTITION BY k) + 360) AS nx, coalesce(lead(x) OVER (PARTITION BY k ORDER BY x), min(x) OVER (PARTITION BY k)) AS follow FROM d),
    b AS (SELECT k, arg_min(x, (-(nx - x), x)) AS stop, arg_min(follow, (-(nx - x), x)) AS start FROM g GROUP BY k)
    SELECT k, round(start, 6) AS start, round(CASE WHEN stop < start THEN stop + 360 ELSE stop END, 6) AS stop FROM b""",
)
def minimal_lon_interval(spark, sf):
    """Shortest arc that holds all longitudes of a group: the complement of the widest gap."""
    lon = G.lon_360(F.round((F.col("c_custkey") * 37 % 3000) / 10.0, 6) + 200.0)
    arc = spatial_ops.minimal_arc(table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), lon.alias("x")), ["k"], "x")
    return arc.select("k", F.round("start", 6).alias("start"), F.round("stop", 6).alias("stop"))


def hourly(spark, sf, slices):
    """Mean value per kind and hour on a complete hourly axis."""
    e = table(spark, sf, "events")
    means = e.groupBy("event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("t")).agg(F.avg("value").alias("v"))
    bounds = e.select("event_type").distinct().select("event_type", stamp("2024-01-01").alias("a"), stamp("2024-01-30").alias("b"))
    grid = series.time_grid(bounds, ["event_type"], "a", "b", 3600, "t")
    return series.fill_line(grid.join(means, ["event_type", "t"], "left"), ["event_type"], "t", "v", "filled", slices).select("event_type", "t", F.col("filled").alias("v"))


_HOURLY_SQL = """
    m AS (SELECT event_type, date_trunc('hour', ts) AS t, avg(value) AS v FROM events GROUP BY ALL),
    g AS (SELECT event_type, unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 HOUR)) AS t FROM (SELECT DISTINCT event_type FROM events)),
    r AS (SELECT g.event_type, epoch(g.t) AS t, m.v, row_number() OVER (PARTITION BY g.event_type ORDER BY g.t) - 1 AS i FROM g LEFT JOIN m ON g.event_type = m.event_type AND g.t = m.t),
    k AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN i END) OVER (PARTITION BY event_type ORDER BY i) AS pi, min(CASE WHEN v IS NOT NULL THEN i END) OVER (PARTITION BY event_type ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni FROM r),
    f AS (SELECT k.event_type, k.i, CASE WHEN k.pi IS NULL THEN b.v WHEN k.ni IS NULL OR k.pi = k.ni THEN a.v ELSE a.v + (b.v - a.v) * (k.i - k.pi) / (k.ni - k.pi) END AS v
        FROM k LEFT JOIN r a ON a.event_type = k.event_type AND a.i = k.pi LEFT JOIN r b ON b.event_type = k.event_type AND b.i = k.ni)"""


@query(
    "psd_peaks",
    f"""
    WITH {_HOURLY_SQL},
    line AS (SELECT event_type, regr_slope(v, i) AS s, avg(i) AS mi, avg(v) AS mv FROM f WHERE v IS NOT NULL GROUP BY event_type),
    d AS (SELECT f.event_type, f.i, f.v - (mv + s * (f.i - mi)) AS x FROM f JOIN line USING (event_type)),
    seg AS (SELECT event_type, unnest([i // 128, i // 128 - 1]) AS seg, i, x FROM d),
    whole AS (SELECT event_type, seg, i - 128 * seg AS n, x - avg(x) OVER (PARTITION BY event_type, seg) AS x, count(*) OVER (PARTITION BY event_type, seg) AS c FROM seg WHERE seg >= 0),
    w AS (SELECT event_type, seg, n, x * (0.5 - 0.5 * cos(2 * pi() * n / 256)) AS x FROM whole WHERE c = 256),
    dft AS (SELECT event_type, seg, bin, sum(x * cos(2 * pi() * bin * n / 256)) AS a, sum(x * sin(2 * pi() * bin * n / 256)) AS b FROM w, (SELECT unnest(generate_series(0, 128)) AS bin) GROUP BY ALL),
    spectrum AS (SELECT event_type, bin, avg((a * a + b * b) * CASE WHEN bin IN (0, 128) THEN 1 ELSE 2 END) / 96 AS power FROM dft GROUP BY ALL),
    band AS (SELECT *, bin / 256 AS f, CASE WHEN f > 1 / 34.0 AND f <= 1 / 4.0 THEN 'tidal' WHEN f > 1 / 2160.0 AND f <= 1 / 34.0 THEN 'subtidal' WHEN f > 0 AND f <= 1 / 2160.0 THEN 'very_low' END AS band FROM spectrum)
    SELECT event_type, band, round(1 / arg_max(f, power), 6) AS period_hours, round(max(power), 6) AS power FROM band WHERE band IS NOT NULL GROUP BY ALL""",
)
def psd_peaks(spark, sf):
    """Strongest period per band of each hourly series (averaged periodogram)."""
    axis = table(spark, sf, "events").withColumnRenamed("ts", "t")  # an hourly axis holds fewer rows than its events
    slices = plan_slices(axis, "t")
    spectrum = spectra.power_spectrum(hourly(spark, sf, slices), ["event_type"], ["t"], "v", 1.0, 256, slices)
    peaks = spectra.band_peaks(spectrum, ["event_type"])
    return peaks.select("event_type", "band", F.round("period_hours", 6).alias("period_hours"), F.round("power", 6).alias("power"))


_BANDS = filters.tide_bands(1.0, very_low_days=10.0)


def _floats(values) -> str:
    return "[" + ", ".join(f"{float(v)!r}::DOUBLE" for v in values) + "]"


def _one_pass_sql(name: str, source: str, f: filters.Filter) -> str:
    """The samples ``xs`` of each series one after the other: y is C s + D x, the next state A s + B x."""
    x = "xs[j + 1]"
    state = ", ".join(f"list_dot_product({_floats(row)}, s) + {float(b)!r} * {x}" for row, b in zip(f.a, f.b))
    return f"""{name} AS (
        SELECT event_type, 0 AS j, xs, [{", ".join(f"{float(v)!r} * xs[1]" for v in f.settled)}] AS s, NULL::DOUBLE AS y FROM {source}
        UNION ALL SELECT event_type, j + 1, xs, [{state}], list_dot_product({_floats(f.c)}, s) + {float(f.d)!r} * {x} FROM {name} WHERE j < len(xs))"""


def _band_sql(name: str, f: filters.Filter) -> str:
    p = f.pad
    return f"""{name}_x AS (
        SELECT event_type, list_concat(list_transform(generate_series({p}, 1, -1), lambda k: 2 * v[1] - v[k + 1]), v,
            list_transform(generate_series(1, {p}), lambda k: 2 * v[-1] - v[len(v) - k])) AS xs FROM lists),
    {_one_pass_sql(name + "_f", name + "_x", f)},
    {name}_y AS (SELECT event_type, list(y ORDER BY j DESC) AS xs FROM {name}_f WHERE j > 0 GROUP BY event_type),
    {_one_pass_sql(name + "_g", name + "_y", f)},
    {name} AS (SELECT event_type, len(xs) - j - {p} AS i, y FROM {name}_g WHERE j > 0 AND len(xs) - j - {p} >= 0 AND j > {p})"""


_BANDED_SQL = f"""
    WITH RECURSIVE {_HOURLY_SQL.lstrip()},
    lists AS (SELECT event_type, list(v ORDER BY i) AS v FROM f GROUP BY event_type),
    {", ".join(_band_sql(name, f) for name, f in _BANDS.items())},
    banded AS (
        SELECT event_type, TIMESTAMP '2024-01-01' + to_hours(CAST(i AS BIGINT)) AS t, a.y AS tidal, b.y AS subtidal, c.y AS very_low
        FROM tidal a JOIN subtidal b USING (event_type, i) JOIN very_low c USING (event_type, i))"""


def _banded(spark, sf):
    axis = table(spark, sf, "events").withColumnRenamed("ts", "t")
    slices = plan_slices(axis, "t")
    return filters.filter_bands(hourly(spark, sf, slices), ["event_type"], "t", "v", _BANDS, slices)


@query(
    "band_filters",
    _BANDED_SQL + " SELECT event_type, t, round(tidal, 6) AS tidal, round(subtidal, 6) AS subtidal, round(very_low, 6) AS very_low FROM banded",
)
def band_filters(spark, sf):
    """Tidal, subtidal and very low part of each hourly series, by filters without phase."""
    return _banded(spark, sf).select("event_type", "t", *[F.round(b, 6).alias(b) for b in _BANDS])


@query(
    "band_deviations",
    _BANDED_SQL + """ SELECT event_type, count(*) AS rows, round(stddev_pop(tidal), 6) AS tidal, round(stddev_pop(subtidal), 6) AS subtidal, round(stddev_pop(very_low), 6) AS very_low
    FROM banded GROUP BY event_type""",
)
def band_deviations(spark, sf):
    """Deviation of each band of each series."""
    spread = [F.round(F.stddev_pop(b), 6).alias(b) for b in _BANDS]
    return _banded(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), *spread)


_FITTED = ("M2", "S2", "K1", "O1")
_BASIS_SQL = ", ".join(["1.0::DOUBLE"] + [f"{wave}(radians(h * {DEGREES_PER_HOUR[n]!r}))" for n in _FITTED for wave in ("cos", "sin")])
_NORMAL_SQL = ", ".join("[" + ", ".join([f"sum(b[{p}] * b[{q}])" for q in range(1, 10)] + [f"sum(b[{p}] * value)"]) + "]" for p in range(1, 10))


@query(
    "harmonic_fit",
    f"""
    WITH RECURSIVE basis AS (SELECT event_type, value, [{_BASIS_SQL}] AS b FROM (SELECT *, (epoch_us(ts) - 1704067200000000) / 3.6e9 AS h FROM events) WHERE value IS NOT NULL AND h IS NOT NULL),
    start AS (SELECT event_type, count(*) AS rows, [{_NORMAL_SQL}] AS m FROM basis GROUP BY event_type),
    reduced AS (
        SELECT event_type, rows, 1 AS k, m FROM start
        UNION ALL
        SELECT event_type, rows, k + 1, list_transform(generate_series(1, 9), lambda i: CASE WHEN i = k THEN list_transform(m[k], lambda x: x / m[k][k])
            ELSE list_transform(generate_series(1, 10), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k]) END) FROM reduced WHERE k <= 9),
    c AS (SELECT event_type, rows, m[1][10] AS mean, unnest({list(_FITTED)!r}) AS constituent, unnest([m[2][10], m[4][10], m[6][10], m[8][10]]) AS a, unnest([m[3][10], m[5][10], m[7][10], m[9][10]]) AS b FROM reduced WHERE k = 10)
    SELECT event_type, rows, round(mean, 6) AS mean, constituent, round(sqrt(a * a + b * b), 6) AS amplitude, round((degrees(atan2(b, a)) + 360.0) % 360.0, 4) AS phase FROM c""",
)
def harmonic_fit(spark, sf):
    """Tidal constants fitted to every record, by sums and one small solve per series."""
    hours = (T.micros(F.col("ts")) - 1704067200000000) / 3.6e9
    e = table(spark, sf, "events").select("event_type", hours.alias("h"), "value")
    fitted = spectra.harmonic_fit(e, ["event_type"], "h", "value", {n: DEGREES_PER_HOUR[n] for n in _FITTED})
    return fitted.select("event_type", "rows", F.round("mean", 6).alias("mean"), "constituent", F.round("amplitude", 6).alias("amplitude"), F.round("phase", 4).alias("phase"))


@query(
    "energetic_window",
    """
    WITH d AS (SELECT event_type, date_trunc('day', ts) AS day, avg(value * value) AS e FROM events GROUP BY ALL),
    m AS (SELECT event_type, day, row_number() OVER w AS i, count(*) OVER (PARTITION BY event_type) AS n, avg(e) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day))
    SELECT event_type, round(max(m), 4) AS energy, arg_min(day, (-round(m, 6), i)) AS centre FROM m WHERE i > 2 AND i <= n - 2 GROUP BY event_type""",
)
def energetic_window(spark, sf):
    """Middle of the most energetic five days of each series."""
    e = table(spark, sf, "events")
    daily = e.groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.avg(F.col("value") * F.col("value")).alias("e"))
    return spectra.energetic_centre(daily, ["event_type"], "day", "e", 5).select("event_type", F.round("energy", 4).alias("energy"), "centre")


def _repair_sql(rounds: int) -> str:
    """The passes written out: along each axis a null takes the line between its known neighbours, or the only one."""
    steps, last = [], "s0"
    for n in range(rounds):
        for keys, at, code in (("node, layer", "month", 1), ("node, month", "layer", 2), ("month, layer", "node", 3)):
            new = f"s{n}_{code}"
            steps.append(f"""{new} AS (
        SELECT node, layer, month, CASE WHEN v IS NULL AND (p IS NOT NULL OR q IS NOT NULL) THEN {code} ELSE repair_code END AS repair_code,
            CASE WHEN v IS NOT NULL THEN v WHEN p IS NULL THEN q[2] WHEN q IS NULL THEN p[2] ELSE p[2] + (q[2] - p[2]) * ({at} - p[1]) / (q[1] - p[1]) END AS v
        FROM (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN [{at}::DOUBLE, v] END IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY {at}) AS p,
            first_value(CASE WHEN v IS NOT NULL THEN [{at}::DOUBLE, v] END IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY {at} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM {last}))""")
            last = new
    return ",\n    ".join(steps) + f"\n    SELECT node, layer, month, round(v, 6) AS v, repair_code FROM {last}"


@query(
    "repair_axes",
    f"""
    WITH s0 AS (
        SELECT node, layer, month, 0 AS repair_code, CASE WHEN NOT ((node * 7 + layer * 3 + month) % 5 < 2 OR (layer = 3 AND node % 4 = 1) OR node = 7) THEN v END AS v
        FROM (SELECT l_suppkey % 20 AS node, l_linenumber AS layer, CAST(month(l_shipdate) AS INTEGER) AS month, avg(l_quantity) AS v FROM lineitem GROUP BY ALL)),
    {_repair_sql(3)}""",
)
def repair_axes(spark, sf):
    """Missing values filled along time, then down the column, then along the chain, with a code."""
    li = table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 20).alias("node"), F.col("l_linenumber").alias("layer"), F.month("l_shipdate").alias("month"), "l_quantity", "l_partkey"
    )
    cell = li.groupBy("node", "layer", "month").agg(F.avg("l_quantity").alias("v"))
    gone = (F.col("node") * 7 + F.col("layer") * 3 + F.col("month")) % 5 < 2
    gone = gone | ((F.col("layer") == 3) & (F.col("node") % 4 == 1)) | (F.col("node") == 7)
    gappy_ = cell.withColumn("v", F.when(~gone, F.col("v")))
    passes = [(["node", "layer"], "month", 1), (["node", "month"], "layer", 2), (["month", "layer"], "node", 3)]
    return series.repair_axes(gappy_, "v", passes).select("node", "layer", "month", F.round("v", 6).alias("v"), "repair_code")
