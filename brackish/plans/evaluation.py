"""Queries over scores, summaries and data quality."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brackish.functions import documents as D
from brackish.functions import timeaxis as T
from brackish.functions.vectors import speed_agrees
from brackish.operators import dedupe, joins, metrics, quality, sampling, series, vertical
from brackish.operators.quantiles import with_quantiles
from brackish.plans.cleaning import GRAIN_SQL, GRAIN_VALID_SQL, LONLAT_SQL, grain, lonlat
from brackish.plans.registry import query
from brackish.sources.tables import table


def pairs(spark, sf):
    """Line prices (model) beside order prices (observed), a left equi-join."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_shipdate")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice", "o_orderpriority", "o_orderdate")
    obs = F.when(F.col("l_orderkey") % 11 != 0, F.col("o_totalprice"))
    return li.join(o, "l_orderkey", "left").withColumn("obs", obs)


SCORES = ["r", "alpha", "beta", "kge", "nse", "rmse", "mae", "bias", "pbias", "sim_mean", "obs_mean"]


@query(
    "skill_metrics",
    """
    WITH p AS (SELECT o_orderpriority, l_extendedprice AS s, o_totalprice AS o, o_orderdate AS t
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 11 <> 0),
    a AS (SELECT o_orderpriority, count(*) AS n_pairs, min(t) AS date_start, max(t) AS date_end, covar_pop(s, o) / (stddev_pop(s) * stddev_pop(o)) AS r,
      stddev_pop(s) / stddev_pop(o) AS alpha, avg(s) / avg(o) AS beta, 1 - sum((s - o) * (s - o)) / (var_pop(o) * count(*)) AS nse, sqrt(avg((s - o) * (s - o))) AS rmse,
      avg(abs(s - o)) AS mae, avg(s - o) AS bias, 100.0 * sum(s - o) / sum(o) AS pbias, avg(s) AS sim_mean, avg(o) AS obs_mean FROM p GROUP BY o_orderpriority)
    SELECT o_orderpriority, n_pairs, date_start, date_end, round(r, 4) AS r, round(alpha, 4) AS alpha, round(beta, 4) AS beta,
      round(1 - sqrt((r - 1) * (r - 1) + (alpha - 1) * (alpha - 1) + (beta - 1) * (beta - 1)), 4) AS kge, round(nse, 4) AS nse, round(rmse, 4) AS rmse, round(mae, 4) AS mae,
      round(bias, 4) AS bias, round(pbias, 4) AS pbias, round(sim_mean, 4) AS sim_mean, round(obs_mean, 4) AS obs_mean FROM a""",
)
def skill_metrics(spark, sf):
    """Model-versus-observation skill per group: join, one pass of sums, guarded scores."""
    m = metrics.skill_scores(pairs(spark, sf), ["o_orderpriority"], "l_extendedprice", "obs", "o_orderdate")
    return m.select("o_orderpriority", "n_pairs", "date_start", "date_end", *[F.round(c, 4).alias(c) for c in SCORES])


@query(
    "skill_metrics_lagged",
    """
    WITH d AS (SELECT event_type, ts::DATE AS day, sum(value) AS sim, sum(value) FILTER (event_id % 3 = 0) AS obs FROM events GROUP BY ALL),
    m AS (SELECT a.event_type, a.sim, a.obs, b.obs AS prev FROM d a LEFT JOIN d b ON a.event_type = b.event_type AND b.day = a.day - 1),
    l AS (SELECT event_type, 'same_date' AS comparison, sim, obs AS o FROM m UNION ALL SELECT event_type, 'previous_date', sim, prev FROM m)
    SELECT event_type, comparison, count(*) FILTER (sim IS NOT NULL AND o IS NOT NULL) AS n, round(corr(sim, o), 6) AS corr, round(avg(sim - o), 4) AS bias,
      round(sqrt(avg((sim - o) * (sim - o))), 4) AS rmse, round(avg(sim) FILTER (o IS NOT NULL) / avg(o), 6) AS ratio_mean
    FROM l GROUP BY event_type, comparison""",
)
def skill_metrics_lagged(spark, sf):
    """Same-day and previous-day comparison with a minimum of pairs."""
    e = table(spark, sf, "events")
    daily = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.sum("value").alias("sim"), F.sum(F.when(F.col("event_id") % 3 == 0, F.col("value"))).alias("obs")
    )
    shifted = daily.select("event_type", F.date_add("day", 1).alias("day"), F.col("obs").alias("prev"))
    both = daily.join(shifted, ["event_type", "day"], "left")
    m = metrics.skill_by_comparison(both, ["event_type"], "sim", {"same_date": "obs", "previous_date": "prev"})
    return m.select("event_type", "comparison", "n", F.round("corr", 6).alias("corr"), F.round("bias", 4).alias("bias"), F.round("rmse", 4).alias("rmse"), F.round("ratio_mean", 6).alias("ratio_mean"))


_SUMMARY_SQL = """count(x) AS n, round(avg(x), 4) AS mean, round(stddev_pop(x), 4) AS std, min(x) AS min, max(x) AS max, round(sqrt(avg(x * x)), 4) AS rmse,
      round(quantile_cont(x, 0.5), 4) AS median, round(quantile_cont(x, 0.05), 4) AS p05, round(quantile_cont(x, 0.25), 4) AS p25,
      round(quantile_cont(x, 0.75), 4) AS p75, round(quantile_cont(x, 0.95), 4) AS p95"""
_SUMMARY = ["mean", "std", "rmse", "median", "p05", "p25", "p75", "p95"]


def _rounded(df, keys):
    return df.select(*keys, "n", "min", "max", *[F.round(c, 4).alias(c) for c in _SUMMARY])


@query(
    "anomaly_stats",
    f"""
    SELECT l_returnflag, {_SUMMARY_SQL} FROM (SELECT l_returnflag, CASE WHEN l_partkey % 13 <> 0 THEN l_extendedprice - 30000.0 END AS x FROM lineitem) GROUP BY l_returnflag""",
)
def anomaly_stats(spark, sf):
    """Moments and exact linear quantiles of an anomaly per class; missing values left out."""
    x = F.when(F.col("l_partkey") % 13 != 0, F.col("l_extendedprice") - 30000.0)
    return _rounded(metrics.distribution_summary(table(spark, sf, "lineitem"), ["l_returnflag"], x), ["l_returnflag"])


# Overlapping named regions (west, south, east, north).
REGIONS = {"whole": (-180.0, -90.0, 180.0, 90.0), "west": (-180.0, -60.0, 0.0, 60.0), "tropics": (-120.0, -23.5, 140.0, 23.5), "north": (-60.0, 20.0, 90.0, 80.0)}
_REGION_SQL = ", ".join(f"('{n}', {w}::DOUBLE, {s}::DOUBLE, {e}::DOUBLE, {nn}::DOUBLE)" for n, (w, s, e, nn) in REGIONS.items())


@query(
    "region_stats",
    f"""
    SELECT region, {_SUMMARY_SQL} FROM (SELECT region, o_totalprice AS x FROM ({LONLAT_SQL}), (VALUES {_REGION_SQL}) AS r(region, w, s, e, n)
      WHERE lon BETWEEN w AND e AND lat BETWEEN s AND n) GROUP BY region""",
)
def region_stats(spark, sf):
    """The summary per named region; regions may overlap, so a row may count in several."""
    lon, lat = F.col("lon"), F.col("lat")
    inside = F.array_compact(
        F.array(*[F.when(lon.between(w, e) & lat.between(s, n), F.lit(name)) for name, (w, s, e, n) in REGIONS.items()])
    )
    df = lonlat(spark, sf).select("o_totalprice", F.explode(inside).alias("region"))
    return _rounded(metrics.distribution_summary(df, ["region"], F.col("o_totalprice")), ["region"])


@query(
    "group_mean_first_count",
    """
    SELECT g AS user_key, round(avg(value), 6) AS mean_value, arg_min(event_type, (ts, event_id)) FILTER (event_type IS NOT NULL) AS first_event_type, count(k) AS observation_count
    FROM (SELECT CASE WHEN user_id % 10 <> 0 THEN user_id END AS g, value, CASE WHEN event_id % 6 <> 0 THEN event_type END AS event_type, ts, event_id,
      CASE WHEN event_id % 4 <> 0 THEN props END AS k FROM events) GROUP BY g""",
)
def group_mean_first_count(spark, sf):
    """Means, first known attribute in time order, counts; rows without a key form a group."""
    e = table(spark, sf, "events").select(
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_key"), "value", "ts", "event_id",
        F.when(F.col("event_id") % 6 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 4 != 0, F.col("props")).alias("k"),
    )
    g = metrics.group_profile(e, ["user_key"], ["value"], ["event_type"], ["ts", "event_id"], "k")
    return g.withColumn("mean_value", F.round("mean_value", 6))


@query(
    "valid_fraction_summary",
    f"""
    SELECT l_returnflag, count(*) AS observations, count(DISTINCT l_suppkey) AS locations, count(*) FILTER (ok) AS valid_rows,
      round(avg(gravel), 5) AS gravel_mean_pct, round(avg(silt), 5) AS silt_mean_pct, round(avg(mud), 5) AS mud_mean_pct,
      round(avg(100.0 * gravel / (gravel + sand + silt + clay)) FILTER (ok), 5) AS gravel_norm_pct,
      round(avg(100.0 * clay / (gravel + sand + silt + clay)) FILTER (ok), 5) AS clay_norm_pct, round(median(l_extendedprice), 5) AS median_size
    FROM (SELECT *, {GRAIN_VALID_SQL} AS ok FROM ({GRAIN_SQL})) GROUP BY l_returnflag""",
)
def valid_fraction_summary(spark, sf):
    """Grain fractions per region: all rows, valid rows, median size."""
    s = metrics.fraction_summary(grain(spark, sf), ["l_returnflag"], "l_suppkey", "gravel", "sand", "mud", "clay", "l_extendedprice")
    names = ["gravel_mean_pct", "silt_mean_pct", "mud_mean_pct", "gravel_norm_pct", "clay_norm_pct", "median_size"]
    return s.select("l_returnflag", "observations", "locations", "valid_rows", *[F.round(n, 5).alias(n) for n in names])


@query(
    "stratum_rollup",
    """
    SELECT l_shipmode AS stratum, count(*) AS n, count(r) AS n_finite, round(max(r), 6) AS maximum, count(*) FILTER (r > 1.0) AS above_1_0, count(*) FILTER (r > 1.55) AS above_1_55,
      count(*) - count(r) AS n_invalid, grouping(l_shipmode)::BIGINT AS total_level
    FROM (SELECT l_linestatus AS l_shipmode, CASE WHEN l_tax > 0 THEN l_discount / l_tax END AS r FROM lineitem) GROUP BY ROLLUP (l_shipmode)""",
)
def stratum_rollup(spark, sf):
    """Ratio summary per stratum with the total; undefined ratios are counted, not used."""
    li = table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("stratum"), F.try_divide("l_discount", "l_tax").alias("r"))
    return metrics.ratio_summary(li, ["stratum"], F.col("r"), [1.0, 1.55]).withColumn("maximum", F.round("maximum", 6))


@query(
    "display_limits",
    """
    SELECT p_type, CASE WHEN lo = hi THEN lo - greatest(abs(lo) * 0.01, 1e-12) ELSE lo END AS vmin, CASE WHEN lo = hi THEN hi + greatest(abs(lo) * 0.01, 1e-12) ELSE hi END AS vmax
    FROM (SELECT p_type, round(quantile_cont(x, 0.02), 6) AS lo, round(quantile_cont(x, 0.98), 6) AS hi FROM (SELECT p_type, CASE WHEN p_type = 'SMALL' THEN 7.0 ELSE p_retailprice END AS x FROM part) GROUP BY p_type)""",
)
def display_limits(spark, sf):
    """2nd and 98th percentiles, widened where they coincide."""
    x = F.when(F.col("p_type") == "SMALL", 7.0).otherwise(F.col("p_retailprice"))
    d = metrics.display_limits(table(spark, sf, "part"), ["p_type"], x)
    return d.select("p_type", F.round("vmin", 6).alias("vmin"), F.round("vmax", 6).alias("vmax"))


@query(
    "display_range",
    """
    SELECT p_brand, CASE WHEN lo = hi THEN mn ELSE lo END AS vmin, CASE WHEN lo = hi THEN CASE WHEN mn = mx THEN mn + 1 ELSE mx END ELSE hi END AS vmax
    FROM (SELECT p_brand, round(quantile_cont(p_size, 0.02), 6) AS lo, round(quantile_cont(p_size, 0.98), 6) AS hi, min(p_size)::DOUBLE AS mn, max(p_size)::DOUBLE AS mx FROM part GROUP BY p_brand)""",
)
def display_range(spark, sf):
    """Quantile limits that fall back to the full range."""
    d = metrics.display_limits_or_range(table(spark, sf, "part"), ["p_brand"], F.col("p_size"))
    return d.select("p_brand", F.round("vmin", 6).alias("vmin"), F.round("vmax", 6).alias("vmax"))


@query(
    "nearest_rank_p95",
    "SELECT l_linenumber, quantile_disc(l_extendedprice, 0.95) AS p95, max(l_extendedprice) AS largest FROM lineitem GROUP BY l_linenumber",
)
def nearest_rank_p95(spark, sf):
    """Nearest-rank percentile beside the maximum."""
    li = table(spark, sf, "lineitem")
    q = with_quantiles(li, ["l_linenumber"], F.col("l_extendedprice"), [0.95, 1.0], nearest_rank=True)
    return q.select("l_linenumber", F.col("quantiles")[0].alias("p95"), F.col("quantiles")[1].alias("largest"))


@query(
    "weighted_layer_mean",
    """
    SELECT l_orderkey, round(sum(x * w) FILTER (x IS NOT NULL AND w > 0) / sum(w) FILTER (x IS NOT NULL AND w > 0), 7) AS mean, count(*) FILTER (x IS NOT NULL AND w > 0) AS layers
    FROM (SELECT l_orderkey, CASE WHEN l_partkey % 9 <> 0 THEN l_extendedprice END AS x, l_discount AS w FROM lineitem) GROUP BY l_orderkey""",
)
def weighted_layer_mean(spark, sf):
    """Mean over the layers of each column, renormalised over known layers of positive weight."""
    x = F.when(F.col("l_partkey") % 9 != 0, F.col("l_extendedprice"))
    m = vertical.weighted_mean(table(spark, sf, "lineitem"), ["l_orderkey"], x, F.col("l_discount"))
    return m.select("l_orderkey", F.round("mean", 7).alias("mean"), "layers")


_SIGMA_SQL = """SELECT l_orderkey, l_linenumber AS layer, (l_linenumber - min(l_linenumber) OVER (PARTITION BY l_orderkey)) / 8.0::DOUBLE AS sigma
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)"""


def sigma_columns(spark, sf):
    """The distinct line numbers of each order as a sigma axis from 0 at the top."""
    d = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("layer")).distinct()
    top = F.min("layer").over(W.partitionBy("l_orderkey"))  # a handful of layers each
    return d.select("l_orderkey", "layer", ((F.col("layer") - top) / 8.0).alias("sigma"))


@query(
    "layer_weights",
    f"""
    SELECT l_orderkey, layer, round(top / sum(top) OVER (PARTITION BY l_orderkey), 9) AS top_weight,
      CASE WHEN sum(trap) OVER (PARTITION BY l_orderkey) <> 0 THEN round(trap / sum(trap) OVER (PARTITION BY l_orderkey), 9) END AS trapezoid_weight, thickness
    FROM (SELECT l_orderkey, layer, coalesce(lead(sigma) OVER w, 1.0) - sigma AS top, (coalesce(lead(sigma) OVER w, sigma) - coalesce(lag(sigma) OVER w, sigma)) / 2 AS trap,
        abs(sigma - lag(sigma) OVER w) AS thickness FROM ({_SIGMA_SQL}) WINDOW w AS (PARTITION BY l_orderkey ORDER BY sigma))""",
)
def layer_weights(spark, sf):
    """Layer-top, trapezoid and interface weights of every water column."""
    s = sigma_columns(spark, sf)
    top = vertical.layer_top_weights(s, ["l_orderkey"], "sigma").withColumnRenamed("weight", "top_weight")
    trap = vertical.trapezoid_weights(top, ["l_orderkey"], "sigma").withColumnRenamed("weight", "trapezoid_weight")
    thick = vertical.interface_thickness(trap, ["l_orderkey"], "sigma", "sigma")
    return thick.select(
        "l_orderkey", "layer", F.round("top_weight", 9).alias("top_weight"), F.round("trapezoid_weight", 9).alias("trapezoid_weight"), F.col("weight").alias("thickness")
    )


@query(
    "layer_views",
    f"""
    SELECT l_orderkey, min(layer) FILTER (r = 1) AS surface, min(layer) FILTER (r = least(2, n)) AS near_surface, min(layer) FILTER (r = n) AS bottom
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY sigma) AS r, count(*) OVER (PARTITION BY l_orderkey) AS n FROM ({_SIGMA_SQL})) GROUP BY l_orderkey""",
)
def layer_views(spark, sf):
    """Surface, near-surface and bottom layer of every water column."""
    s = sigma_columns(spark, sf)
    return vertical.layer_views(s, ["l_orderkey"], "sigma", "layer")


@query(
    "sigma_health",
    f"""
    WITH v AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY layer) AS level, -layer / 8.0::DOUBLE AS s FROM ({_SIGMA_SQL})),
    g AS (SELECT l_orderkey, max(s) AS hi, min(s) AS lo, count(*) AS n FROM v GROUP BY l_orderkey)
    SELECT l_orderkey, n - 1 AS n_layers, 'surface_to_bottom' AS orientation, CASE WHEN abs(hi) > 0.001 OR abs(lo + 1) > 0.001 THEN 'endpoints' END AS problem
    FROM g WHERE n > 1""",
)
def sigma_health(spark, sf):
    """Is the sigma axis of each column monotonic, nested and complete?"""
    s = sigma_columns(spark, sf).withColumn("siglev", -F.col("layer") / 8.0)
    down = W.partitionBy("l_orderkey").orderBy("layer")
    levels = s.withColumns({"level": F.row_number().over(down).cast("long"), "_next": F.lead("siglev").over(down)})
    layers = levels.where("_next is not null").select("l_orderkey", F.col("level").alias("layer"), ((F.col("siglev") + F.col("_next")) / 2).alias("siglay"))
    return vertical.sigma_report(layers, levels.select("l_orderkey", "level", "siglev"), ["l_orderkey"])


@query(
    "completeness_report",
    """
    SELECT column_name, known, n_rows, known::DOUBLE / n_rows AS fraction FROM (
      SELECT unnest(['event_id', 'value', 'odd']) AS column_name, unnest([count(event_id), count(value), count(CASE WHEN event_id % 3 <> 0 THEN props END)]) AS known, count(*) AS n_rows FROM events)""",
)
def completeness_report(spark, sf):
    """Known fraction per column, from one scan."""
    e = table(spark, sf, "events").withColumn("odd", F.when(F.col("event_id") % 3 != 0, F.col("props")))
    return quality.completeness(e, ["event_id", "value", "odd"])


@query(
    "coverage_gate",
    """
    SELECT event_type, count(*) AS frames, count(*) FILTER (k = 0) AS empty_frames, min(k::DOUBLE / n) AS worst, bool_and(k::DOUBLE / n >= 0.95) AS passed
    FROM (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS n, count(*) FILTER (event_id % 40 <> 7) AS k FROM events WHERE value > 5 GROUP BY ALL) GROUP BY event_type""",
)
def coverage_gate(spark, sf):
    """Known share of wet values per frame, and whether every frame passes."""
    e = table(spark, sf, "events").withColumn("v", F.when(F.col("event_id") % 40 != 7, F.col("value")))
    frames = quality.frame_coverage(e, ["event_type", F.date_trunc("hour", "ts").alias("h")], F.col("v"), F.col("value") > 5)
    return quality.coverage_gate(frames.where("n_wet > 0"), ["event_type"])


@query(
    "qc_char_histogram",
    """SELECT c AS flag, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c NOT IN (' ', chr(9), chr(10), chr(11), chr(12), chr(13), '') GROUP BY c""",
)
def qc_char_histogram(spark, sf):
    """Histogram of the characters of whole texts, blanks left out."""
    chars = table(spark, sf, "documents").select(F.explode(F.split("text", "")).alias("flag"))
    return chars.where(~F.col("flag").rlike(r"^\s*$")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "zip_modes_count",
    """
    SELECT parameter, mode, count(*) AS n FROM (
      SELECT unnest(['PRES', 'TEMP', event_type]) AS parameter, unnest([CASE WHEN event_id % 2 = 0 THEN 'R' ELSE 'D' END, 'A', CASE WHEN user_id % 2 = 0 THEN 'D' ELSE '' END]) AS mode FROM events)
    WHERE mode <> '' GROUP BY ALL""",
)
def zip_modes_count(spark, sf):
    """Parameters paired with their modes by position, then counted."""
    ps = F.array(F.lit("PRES"), F.lit("TEMP"), F.col("event_type"))
    ms = F.array(F.when(F.col("event_id") % 2 == 0, "R").otherwise("D"), F.lit("A"), F.when(F.col("user_id") % 2 == 0, "D").otherwise(""))
    z = table(spark, sf, "events").select(F.inline(F.arrays_zip(ps.alias("parameter"), ms.alias("mode"))))
    return z.where("mode <> ''").groupBy("parameter", "mode").agg(F.count(F.lit(1)).alias("n"))


@query(
    "merge_count_maps",
    """SELECT json_extract_string(props, '$.k') AS key, count(*) AS total FROM events GROUP BY ALL""",
)
def merge_count_maps(spark, sf):
    """Per-file count maps merged by key."""
    per_user = table(spark, sf, "events").groupBy("user_id", F.get_json_object("props", "$.k").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("key").agg(F.sum("n").alias("total"))


@query(
    "source_counts",
    """SELECT coalesce(nullif(source, 'src_1'), 'none') AS source, lang, count(*) AS n, min(n_chars) AS smallest, max(n_chars) AS largest FROM documents GROUP BY ALL""",
)
def source_counts(spark, sf):
    """Records and size range per source and kind."""
    source = F.coalesce(F.nullif("source", F.lit("src_1")), F.lit("none")).alias("source")
    return table(spark, sf, "documents").groupBy(source, "lang").agg(F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("smallest"), F.max("n_chars").alias("largest"))


@query(
    "case_inventory",
    """
    SELECT lang, sum(n_chars)::BIGINT AS bytes, count(*) AS records, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM documents GROUP BY lang""",
)
def case_inventory(spark, sf):
    """Bytes, records and the set of sources per case; the set is reduced to its members first."""
    d = table(spark, sf, "documents")
    per_source = d.groupBy("lang", "source").agg(F.sum("n_chars").alias("b"), F.count(F.lit(1)).alias("r"))
    return per_source.groupBy("lang").agg(
        F.sum("b").alias("bytes"), F.sum("r").alias("records"), F.array_join(F.array_sort(F.collect_list("source")), ",").alias("sources")
    )


@query(
    "size_totals",
    """SELECT source, sum(CASE WHEN n_chars % 5 <> 0 THEN n_chars END)::BIGINT AS known_bytes, count(*) FILTER (n_chars % 5 = 0) AS unknown, sum(CASE WHEN doc_id % 2 = 0 THEN n_chars ELSE 0 END)::BIGINT AS selected_bytes FROM documents GROUP BY source""",
)
def size_totals(spark, sf):
    """Known, unknown and selected sizes per source."""
    size = F.when(F.col("n_chars") % 5 != 0, F.col("n_chars"))
    return table(spark, sf, "documents").groupBy("source").agg(
        F.sum(size).alias("known_bytes"), F.count_if(size.isNull()).alias("unknown"),
        F.sum(F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")).otherwise(0)).alias("selected_bytes"),
    )


@query(
    "speed_consistency",
    """SELECT o_orderstatus, count(*) AS n, count(*) FILTER (o_orderkey % 50 = 0) AS inconsistent FROM orders GROUP BY o_orderstatus""",
)
def speed_consistency(spark, sf):
    """Stored speeds against their components."""
    u, v = F.col("o_totalprice") / 1000.0, F.col("o_custkey") + 1.0
    speed = F.sqrt(u * u + v * v) + F.when(F.col("o_orderkey") % 50 == 0, 1.0).otherwise(0.0)
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~speed_agrees(speed, u, v)).alias("inconsistent")
    )


@query(
    "plausible_ranges",
    """SELECT event_type, min(value) AS low, max(value) AS high, CASE WHEN event_type LIKE 'c%' AND max(value) > 50 THEN event_type || ' outside the plausible range' END AS warning FROM events GROUP BY event_type""",
)
def plausible_ranges(spark, sf):
    """Observed range per variable with a warning by name prefix."""
    return quality.plausible_range(table(spark, sf, "events"), "event_type", "value", {"c": (-1.0, 50.0), "zz": (0.0, 1.0)})


@query(
    "time_health",
    """
    SELECT user_id, count(*) AS n, count(v)::DOUBLE / count(*) AS known_fraction, bool_and(coalesce(ts > prev, true)) AS increasing, min(ts) AS first, max(ts) AS last
    FROM (SELECT user_id, ts, CASE WHEN event_id % 8 <> 0 THEN value END AS v, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events) GROUP BY user_id""",
)
def time_health(spark, sf):
    """Known share, strict time order and span of each series."""
    e = table(spark, sf, "events").select("user_id", "ts", F.col("event_id").alias("seq"), F.when(F.col("event_id") % 8 != 0, F.col("value")).alias("v"))
    return quality.time_health(e, ["user_id"], "ts", "v")


@query(
    "window_covered",
    """
    SELECT user_id, min(ts) AS first, max(ts) AS last, min(ts) <= TIMESTAMP '2024-01-02' AND epoch_us(max(ts)) + coalesce(floor(median(step)), 0) >= epoch_us(TIMESTAMP '2024-01-29') AS covered
    FROM (SELECT user_id, ts, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS step FROM events) GROUP BY user_id""",
)
def window_covered(spark, sf):
    """Does each series reach over the wanted window, within one median step?"""
    start, end = (F.lit(v).cast("timestamp_ntz") for v in ("2024-01-02", "2024-01-29"))
    return quality.window_covered(table(spark, sf, "events"), ["user_id"], "ts", start, end).select("user_id", "first", "last", "covered")


@query(
    "missing_references",
    """SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size % 10 <> 0)""",
)
def missing_references(spark, sf):
    """Rows that point to something that is not there."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate")
    return quality.missing_references(li, table(spark, sf, "part").where("p_size % 10 <> 0"), "l_partkey", "p_partkey")


@query(
    "geometry_drift",
    """SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING min(l_returnflag) <> max(l_returnflag) OR min(l_linestatus) <> max(l_linestatus)""",
)
def geometry_drift(spark, sf):
    """Keys whose attributes change between records."""
    return quality.unstable_attributes(table(spark, sf, "lineitem"), "l_orderkey", ["l_returnflag", "l_linestatus"])


@query(
    "severity_score",
    """
    SELECT p_partkey, greatest(0.0::DOUBLE, 100.0 - CASE WHEN p_size > 40 THEN 30.0 ELSE 0.0 END - CASE WHEN p_retailprice > 1500 THEN 50.0 ELSE 0.0 END)::DOUBLE AS score,
      array_to_string(list_filter([CASE WHEN p_size > 40 THEN 'too_large' END, CASE WHEN p_retailprice > 1500 THEN 'too_dear' END], lambda x: x IS NOT NULL), ',') AS failures,
      NOT (p_size > 40 OR p_retailprice > 1500) AS accepted
    FROM part""",
)
def severity_score(spark, sf):
    """Score and failure list from a set of gates."""
    rules = [("too_large", F.col("p_size") > 40, 30.0), ("too_dear", F.col("p_retailprice") > 1500, 50.0)]
    return quality.severity_score(table(spark, sf, "part"), ["p_partkey"], rules)


@query(
    "latest_status",
    """
    SELECT user_id, arg_max(event_type, (ts, event_id)) FILTER (event_id % 3 <> 0) AS stage, arg_max(value, (ts, event_id)) FILTER (event_id % 5 <> 0) AS amount FROM events GROUP BY user_id""",
)
def latest_status(spark, sf):
    """Status documents merged: the last known value of each field."""
    e = table(spark, sf, "events").select(
        "user_id", "ts", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("stage"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("amount")
    )
    return quality.latest_per_key(e, ["user_id"], ["ts", "event_id"], ["stage", "amount"])


@query(
    "progress_track",
    """SELECT event_id, max(least(value, 100.0)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS progress FROM events""",
)
def progress_track(spark, sf):
    """Progress that never falls and stops at 100."""
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return quality.progress_track(e, ["user_id"], ["ts", "event_id"], "value").select("event_id", "progress")


@query(
    "trend_by_series",
    """SELECT user_id, round(regr_slope(value, h), 8) AS slope_per_hour, round(stddev_pop(value), 6) AS std FROM (SELECT user_id, value, (epoch_us(ts) - 1704067200000000) / 3.6e9 AS h FROM events) GROUP BY user_id""",
)
def trend_by_series(spark, sf):
    """Trend and spread of each series."""
    h = (T.micros(F.col("ts")) - 1704067200000000) / 3.6e9
    return table(spark, sf, "events").withColumn("h", h).groupBy("user_id").agg(
        F.round(F.regr_slope("value", "h"), 8).alias("slope_per_hour"), F.round(F.stddev_pop("value"), 6).alias("std")
    )


@query(
    "metric_diff",
    """
    SELECT key, before, after, round(after - before, 6) AS change FROM (
      SELECT l_returnflag AS key, round(avg(l_quantity) FILTER (l_linestatus = 'F'), 6) AS before, round(avg(l_quantity) FILTER (l_linestatus = 'O'), 6) AS after FROM lineitem GROUP BY l_returnflag)""",
)
def metric_diff(spark, sf):
    """Metric documents before and after, compared by key."""
    li = table(spark, sf, "lineitem")
    side = lambda s, n: li.where(F.col("l_linestatus") == s).groupBy(F.col("l_returnflag").alias("key")).agg(F.round(F.avg("l_quantity"), 6).alias(n))
    both = side("F", "before").join(side("O", "after"), "key", "full")
    return both.withColumn("change", F.round(F.col("after") - F.col("before"), 6))


@query(
    "comparable_runs",
    """
    SELECT o_orderpriority, count(DISTINCT o_orderstatus) = 1 AS comparable, count(*) AS candidates, count(DISTINCT o_custkey) AS distinct_runs FROM orders GROUP BY o_orderpriority""",
)
def comparable_runs(spark, sf):
    """Candidates compare only when all share one input identity."""
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        (F.min("o_orderstatus") == F.max("o_orderstatus")).alias("comparable"), F.count(F.lit(1)).alias("candidates"), F.count_distinct("o_custkey").alias("distinct_runs")
    )
