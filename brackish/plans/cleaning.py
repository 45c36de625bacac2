"""Queries over projections, conversions and scalar readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from brackish.functions import cleaning as C
from brackish.functions import documents as D
from brackish.functions import geo as G
from brackish.functions import hydrology as H
from brackish.functions import names as N
from brackish.functions import timeaxis as T
from brackish.functions import units as U
from brackish.functions import vectors as V
from brackish.functions import vertical as Z
from brackish.plans.registry import query
from brackish.sinks.writers import spread_over_nodes, with_model_times
from brackish.sources.tables import table


@query(
    "sentinel_clean",
    """
    SELECT c_custkey, CASE WHEN c_acctbal > 500.0 THEN c_acctbal END AS acctbal
    FROM customer""",
)
def sentinel_clean(spark, sf):
    """Values at or below a sentinel become null."""
    return table(spark, sf, "customer").select("c_custkey", C.above_sentinel(F.col("c_acctbal"), 500.0).alias("acctbal"))


GRAIN_SQL = """
    SELECT *, CASE WHEN mud >= clay THEN mud - clay END AS silt FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag, l_extendedprice,
             l_quantity AS gravel, l_discount * 400.0 AS mud, l_tax * 500.0 AS clay,
             100.0 - l_quantity - l_discount * 400.0 + (l_linenumber - 4) * 2.5 AS sand
      FROM lineitem)"""


def grain(spark, sf):
    """Lineitem read as grain-size samples."""
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_extendedprice",
        F.col("l_quantity").alias("gravel"), (F.col("l_discount") * 400.0).alias("mud"), (F.col("l_tax") * 500.0).alias("clay"),
        (100.0 - F.col("l_quantity") - F.col("l_discount") * 400.0 + (F.col("l_linenumber") - 4) * 2.5).alias("sand"),
    )


GRAIN_VALID_SQL = (
    "coalesce(gravel + sand + mud BETWEEN 95.0 AND 105.0 AND silt IS NOT NULL AND gravel >= 0 AND sand >= 0 AND clay >= 0 AND silt >= 0, false)"
)


@query(
    "grain_fractions",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, round(silt, 6) AS silt, ok AS valid,
           CASE WHEN ok THEN round(100.0 * gravel / (gravel + sand + silt + clay), 6) END AS gravel_norm,
           CASE WHEN ok THEN round(100.0 * silt / (gravel + sand + silt + clay), 6) END AS silt_norm
    FROM (SELECT *, {GRAIN_VALID_SQL} AS ok FROM ({GRAIN_SQL}))""",
)
def grain_fractions(spark, sf):
    """Silt, validity and normalised classes per sample."""
    df = grain(spark, sf)
    g, s, m, c = (F.col(x) for x in ("gravel", "sand", "mud", "clay"))
    valid = C.fractions_valid(g, s, m, c)
    silt = C.silt(m, c)
    classes = [g, s, silt, c]
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", F.round(silt, 6).alias("silt"), valid.alias("valid"),
        F.round(C.normalised_fraction(g, classes, valid), 6).alias("gravel_norm"),
        F.round(C.normalised_fraction(silt, classes, valid), 6).alias("silt_norm"),
    )


@query(
    "elevation_depth",
    """
    SELECT c_custkey, CASE WHEN e < 0 THEN -e WHEN e IS NOT NULL THEN 0.0 END AS depth, coalesce(e < 0, false) AS wet
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE c_acctbal - 4000.0 END AS e FROM customer)""",
)
def elevation_depth(spark, sf):
    """Positive-down depth, zero on land, null where unknown."""
    e = F.when(F.col("c_custkey") % 7 != 3, F.col("c_acctbal") - 4000.0)
    return table(spark, sf, "customer").select("c_custkey", C.elevation_to_depth(e).alias("depth"), C.is_wet(e).alias("wet"))


@query(
    "unit_convert",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
      round(CASE WHEN l_linestatus = 'O' THEN l_quantity * 6.0 - 273.15 ELSE l_quantity END, 6) AS temperature_c,
      round(1e9 * CASE l_linenumber WHEN 1 THEN l_tax WHEN 2 THEN l_tax / 1000.0 WHEN 3 THEN l_tax / 1000.0 / 3600.0
           WHEN 4 THEN l_tax / 1000.0 / 86400.0 END, 5) AS rain,
      CASE WHEN (CASE WHEN l_linestatus = 'O' THEN l_quantity * 6.0 - 273.15 ELSE l_quantity END) < -100
             OR (CASE WHEN l_linestatus = 'O' THEN l_quantity * 6.0 - 273.15 ELSE l_quantity END) > 70 THEN 'out_of_range' END AS problem
    FROM lineitem""",
)
def unit_convert(spark, sf):
    """Role-wise unit conversion with a range gate; unknown units give null."""
    li = table(spark, sf, "lineitem")
    kelvin = F.col("l_linestatus") == "O"
    temperature = U.convert(
        "air_temperature", F.when(kelvin, F.col("l_quantity") * 6.0).otherwise(F.col("l_quantity")),
        F.when(kelvin, "K").otherwise("degree_Celsius"),
    )
    units = F.element_at(F.array(*map(F.lit, ["m/s", "kg m-2 s-1", "mm / hr", "mm day-1", "in/hr", "ft/s", "?"])), F.col("l_linenumber"))
    rain = U.convert("precipitation", F.col("l_tax"), units)
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", F.round(temperature, 6).alias("temperature_c"),
        F.round(rain * 1e9, 5).alias("rain"), U.range_problem("air_temperature", temperature).alias("problem"),
    )


@query(
    "pressure_departure",
    "SELECT p_partkey, ((p_size - 25.0 + 1000.0) * 100.0)::DOUBLE AS pascal, round(p_size * 0.028316846592::DOUBLE, 9) AS m3s FROM part",
)
def pressure_departure(spark, sf):
    """Pressure departures to absolute pascal, cubic feet to cubic metres."""
    return table(spark, sf, "part").select(
        "p_partkey", F.round(U.departure_to_pascal(F.col("p_size") - 25.0), 6).alias("pascal"),
        F.round(U.cubic_feet_to_metres(F.col("p_size")), 9).alias("m3s"),
    )


@query(
    "rotate_vector",
    """
    SELECT o_orderkey, round(u * cos(a) - v * sin(a), 6) AS east, round(u * sin(a) + v * cos(a), 6) AS north,
      round(sqrt(u * u + v * v), 6) AS speed,
      round(270.0 - degrees(atan2(v, u)) - 360.0 * floor((270.0 - degrees(atan2(v, u))) / 360.0), 6) AS from_degrees
    FROM (SELECT o_orderkey, o_totalprice / 100000.0 AS u, o_custkey / 1000.0 + 0.5 AS v, radians(o_orderkey % 360) AS a FROM orders)""",
)
def rotate_vector(spark, sf):
    """Grid components to east/north, speed and the direction the flow comes from."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 100000.0).alias("u"), (F.col("o_custkey") / 1000.0 + 0.5).alias("v"),
        F.radians(F.col("o_orderkey") % 360).alias("a"),
    )
    east, north, speed = V.rotate_to_earth(F.col("u"), F.col("v"), F.col("a"))
    return o.select(
        "o_orderkey", F.round(east, 6).alias("east"), F.round(north, 6).alias("north"), F.round(speed, 6).alias("speed"),
        F.round(V.direction_from(F.col("u"), F.col("v")), 6).alias("from_degrees"),
    )


@query(
    "terrain_levels",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
      round(z1 + zeta * (1.0 + z1 / h), 6) AS z_transform1, round(zeta + (zeta + h) * ((20.0 * s + h * c) / (20.0 + h)), 6) AS z_transform2
    FROM (SELECT *, (s - c) * 20.0 + c * h AS z1 FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, -(l_linenumber - 0.5) / 7.0 AS s,
        -((l_linenumber - 0.5) / 7.0) * ((l_linenumber - 0.5) / 7.0) AS c, l_quantity + 10.0 AS h, l_tax AS zeta FROM lineitem))""",
)
def terrain_levels(spark, sf):
    """Depth of terrain-following levels under both transforms."""
    x = (F.col("l_linenumber") - 0.5) / 7.0
    h, zeta = F.col("l_quantity") + 10.0, F.col("l_tax")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
        F.round(Z.terrain_depth(-x, -(x * x), h, zeta, 20.0, 1), 6).alias("z_transform1"),
        F.round(Z.terrain_depth(-x, -(x * x), h, zeta, 20.0, 2), 6).alias("z_transform2"),
    )


@query(
    "complex_polar",
    """
    SELECT o_orderkey, round(sqrt(re * re + im * im), 6) AS amplitude,
      round(degrees(atan2(-im, re)) - 360.0 * floor(degrees(atan2(-im, re)) / 360.0), 6) AS phase,
      CASE WHEN o_orderkey % 5 > 0 THEN round(re / (o_orderkey % 5), 9) END AS velocity,
      CASE WHEN im > 0 THEN round(log10(im), 6) END AS log_im
    FROM (SELECT o_orderkey, o_totalprice / 1000.0 - 250.0 AS re, (o_custkey % 401) - 200.5 AS im FROM orders)""",
)
def complex_polar(spark, sf):
    """Amplitude and phase lag, transport over depth, logarithm of the positive."""
    re, im = F.col("o_totalprice") / 1000.0 - 250.0, F.col("o_custkey") % 401 - 200.5
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round(V.amplitude(re, im), 6).alias("amplitude"), F.round(V.phase_lag(re, im), 6).alias("phase"),
        F.round(V.transport_to_velocity(re, F.col("o_orderkey") % 5), 9).alias("velocity"),
        F.round(C.log10_positive(im), 6).alias("log_im"),
    )


LONLAT_SQL = """SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus, o_totalprice,
    ((o_orderkey * 7919) % 36000) / 100.0 - 180.0 AS lon, ((o_orderkey * 104729) % 17000) / 100.0 - 85.0 AS lat FROM orders"""


def lonlat(spark, sf):
    """Orders placed on the globe by a fixed rule."""
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").withColumns(
        {"lon": ((k * 7919) % 36000) / 100.0 - 180.0, "lat": ((k * 104729) % 17000) / 100.0 - 85.0}
    )


@query(
    "longitude_forms",
    f"""
    SELECT o_orderkey, round(lon + 540.0 - 360.0 * floor((lon + 720.0) / 360.0) , 6) AS wrapped,
      round(lon - 360.0 * floor(lon / 360.0), 6) AS turned,
      round((lon - 360.0 * floor(lon / 360.0)) + 360.0 * ceil((170.0 - (lon - 360.0 * floor(lon / 360.0))) / 360.0), 6) AS unwrapped,
      CAST((CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END) + least(60, greatest(1, floor((lon + 180.0) / 6.0) + 1)) AS INTEGER) AS epsg
    FROM (SELECT * FROM ({LONLAT_SQL}) WHERE lat BETWEEN -80 AND 84)""",
)
def longitude_forms(spark, sf):
    """Wrapped, 0-360 and unwrapped longitude, and the projection zone."""
    lon, lat = F.col("lon"), F.col("lat")
    return lonlat(spark, sf).where(lat.between(-80, 84)).select(
        "o_orderkey", F.round(G.wrap_lon(lon + 360.0 + 180.0), 6).alias("wrapped"), F.round(G.lon_360(lon), 6).alias("turned"),
        F.round(G.unwrap_from(lon, 170.0), 6).alias("unwrapped"), G.utm_epsg(lon, lat).alias("epsg"),
    )


@query(
    "rating_curve",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, round(0.01 * pow(q, 1.8), 6) AS load_t,
      CASE WHEN q > 0 THEN round(0.01 * pow(q, 1.8) * 1e6 / (q * 86400.0 * 1000.0), 9) ELSE 0.0 END AS floc, round(2.5 * pow(q, 0.4), 6) AS power_law
    FROM (SELECT *, greatest(l_quantity - 5.0, 0.0) AS q FROM lineitem)""",
)
def rating_curve(spark, sf):
    """Sediment load, floc concentration and a power law of discharge."""
    q = F.greatest(F.col("l_quantity") - 5.0, F.lit(0.0))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", F.round(H.sediment_load(q), 6).alias("load_t"),
        F.round(H.floc_concentration(q), 9).alias("floc"), F.round(H.power_law(q, 2.5, 0.4), 6).alias("power_law"),
    )


_FACTOR = H.size_extrapolation()
_MASS = H.particle_mass_kg(0.5, 0.02, 0.02, 1380.0)


@query(
    "particle_numbers",
    """
    WITH grid AS (
        SELECT target, low * pow(high / low, i / 20000.0) AS x FROM (VALUES (0, 50.0::DOUBLE, 2000.0::DOUBLE), (1, 0.1, 100.0)) AS ranges(target, low, high), (SELECT unnest(generate_series(0, 20000)) AS i)),
    density AS (SELECT target, x, 0.0016 * exp((1.42 - 3.02) * ln(x) + 3.02 * ln(15.0) - 3.02 * ln(1 + 15.0 / x) + 3.02) AS d FROM grid),
    strips AS (SELECT target, (d + lag(d) OVER w) / 2 * (x - lag(x) OVER w) AS area FROM density WINDOW w AS (PARTITION BY target ORDER BY x)),
    share AS (SELECT sum(area) FILTER (WHERE target = 1) / sum(area) FILTER (WHERE target = 0) AS factor FROM strips)
    SELECT p_partkey, round(0.0016 * exp((1.42 - 3.02) * ln(p_size) + 3.02 * ln(15.0) - 3.02 * ln(1 + 15.0 / p_size) + 3.02) * 1e6, 6) AS density_millionths,
      round(p_retailprice * 0.25 / 0.028316846592, 6) AS number_m3,
      round(p_retailprice * 0.25 / 0.028316846592 * factor * (pi() / 6 * 0.5 * 0.02 * 0.02 * 1e-9 * 1380.0) * 1e6, 6) AS target_mg
    FROM part, share""",
)
def particle_numbers(spark, sf):
    """Particle size density, number and mass concentration."""
    number = H.fibre_number_m3(F.col("p_retailprice"), F.lit(0.25))
    return table(spark, sf, "part").select(
        "p_partkey", F.round(H.size_density(F.col("p_size")) * 1e6, 6).alias("density_millionths"),
        F.round(number, 6).alias("number_m3"), F.round(number * _FACTOR * _MASS * 1e6, 6).alias("target_mg"),
    )


@query(
    "channel_class",
    """
    SELECT p_partkey, CAST(base + bin AS INTEGER) AS chanclass, width, depth, round((CASE base WHEN 1 THEN 0.06::DOUBLE + 0.03 * bin WHEN 7 THEN 0.10 + 0.05 * bin ELSE 0.20 + 0.10 * bin END), 6) AS effwidth,
      greatest(1, CAST(ceil(p_size * 1e6 / 202.0) AS BIGINT)) AS cells
    FROM (SELECT p_partkey, p_size,
        CASE WHEN slope <= 0.002 THEN 1 WHEN slope <= 0.1 THEN 7 ELSE 13 END AS base, CASE WHEN slope <= 0.002 THEN 0.03 WHEN slope <= 0.1 THEN 0.05 ELSE 0.1 END::DOUBLE AS depth,
        CASE WHEN area <= 1e6 THEN 0 WHEN area <= 1e7 THEN 1 WHEN area <= 2e7 THEN 2 WHEN area <= 3e7 THEN 3 WHEN area <= 4e7 THEN 4 ELSE 5 END AS bin,
        CASE WHEN area <= 1e6 THEN 0.5 WHEN area <= 1e7 THEN 1.0 WHEN area <= 2e7 THEN 2.0 WHEN area <= 3e7 THEN 3.0 WHEN area <= 4e7 THEN 4.0 ELSE 4.5 END::DOUBLE AS width
      FROM (SELECT p_partkey, p_size, p_size * p_size / 10000.0 AS slope, p_retailprice * 24000.0 AS area FROM part))""",
)
def channel_class(spark, sf):
    """Channel class from slope and area bins; cells for a source area."""
    size = F.col("p_size")
    c = H.channel_class(size * size / 10000.0, F.col("p_retailprice") * 24000.0)
    return table(spark, sf, "part").select(
        "p_partkey", c["chanclass"].alias("chanclass"), c["width"].alias("width"), c["depth"].alias("depth"),
        F.round(c["effwidth"], 6).alias("effwidth"), H.area_to_cells(size, F.lit(202.0)).alias("cells"),
    )


@query(
    "distribute_weights",
    """
    SELECT o_orderkey, node, round(o_totalprice * weight, 6) AS node_flow, round(o_totalprice * weight * 0.6, 6) AS fine_load
    FROM orders, (VALUES (1, 0.5::DOUBLE), (2, 0.3::DOUBLE), (3, 0.2::DOUBLE)) AS w(node, weight)""",
)
def distribute_weights(spark, sf):
    """A flow over its inflow nodes by fixed weights, with a constant tracer share."""
    flow = spread_over_nodes(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), F.col("o_totalprice"), [0.5, 0.3, 0.2])
    return flow.select("o_orderkey", "node", F.round("node_flow", 6).alias("node_flow"), F.round(F.col("o_totalprice") * F.col("weight") * 0.6, 6).alias("fine_load"))


@query(
    "model_times",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS times_text, round(epoch_us(ts) / 86400e6 + 40587, 7) AS time_mjd,
      CAST(floor(epoch_us(ts) / 86400e6) + 40587 AS INTEGER) AS itime, CAST((epoch_us(ts) // 1000) % 86400000 AS INTEGER) AS itime2
    FROM events""",
)
def model_times(spark, sf):
    """The redundant time columns of forcing files."""
    e = with_model_times(table(spark, sf, "events").select("event_id", "ts"), "ts")
    return e.select("event_id", F.col("Times").alias("times_text"), F.round("time_mjd", 7).alias("time_mjd"), F.col("Itime").alias("itime"), F.col("Itime2").alias("itime2"))


@query(
    "decode_times",
    """
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN make_timestamp((epoch_us(ts) // 1000) * 1000) ELSE date_trunc('day', ts) END AS decoded
    FROM events""",
)
def decode_times(spark, sf):
    """One time from whichever encoding each record carries."""
    t, kind = F.col("ts"), F.col("event_id") % 3
    text = F.when(kind == 0, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    day, ms = F.when(kind == 1, T.mjd_day(t)), F.when(kind == 1, T.millis_of_day(t))
    mjd = F.when(kind == 2, F.floor(T.to_mjd(t)).cast("double"))
    return table(spark, sf, "events").select("event_id", T.decode_time(text, day, ms, mjd).alias("decoded"))


_TIDE = {"M2": (0.9, 120.0), "S2": (0.3, 150.0), "K1": (0.2, 40.0), "O1": (0.15, 300.0)}


@query(
    "harmonic_synthesis",
    """
    SELECT event_id, round(sum(a * cos(radians(w * h - g))), 6) AS eta
    FROM (SELECT event_id, (epoch_us(ts) / 86400e6 + 40587 - 15019.0) * 24.0 AS h FROM events),
         (VALUES (0.9::DOUBLE, 120.0::DOUBLE, 28.9841042::DOUBLE), (0.3, 150.0, 30.0), (0.2, 40.0, 15.0410686), (0.15, 300.0, 13.9430356)) AS c(a, g, w)
    GROUP BY event_id""",
)
def harmonic_synthesis(spark, sf):
    """Tidal height from constituents, all in one expression."""
    return table(spark, sf, "events").select("event_id", F.round(V.harmonic_sum(T.to_mjd(F.col("ts")), _TIDE), 6).alias("eta"))


@query(
    "key_parse",
    r"""
    SELECT page_id, name, naming, product, guidance, lead, run_time, run_time + to_hours(CAST(CASE WHEN guidance = 'nowcast' THEN lead - 6 ELSE lead END AS BIGINT)) AS valid_time
    FROM (
      SELECT page_id, name, CASE WHEN page_id % 2 = 0 THEN 'current' ELSE 'legacy' END AS naming,
        CASE WHEN page_id % 3 = 0 THEN 'fields' ELSE 'regulargrid' END AS product,
        CASE WHEN page_id % 5 < 2 THEN 'nowcast' ELSE 'forecast' END AS guidance, CAST(1 + page_id % 6 AS INTEGER) AS lead,
        TIMESTAMP '2024-01-01' + to_days(CAST(page_id % 27 AS INTEGER)) + to_hours(6 * (page_id % 4)) AS run_time
      FROM (SELECT page_id, CASE WHEN page_id % 2 = 0
              THEN 'bay.t' || lpad((6 * (page_id % 4))::VARCHAR, 2, '0') || 'z.202401' || lpad((1 + page_id % 27)::VARCHAR, 2, '0') || '.' || CASE WHEN page_id % 3 = 0 THEN 'fields' ELSE 'regulargrid' END || '.' || CASE WHEN page_id % 5 < 2 THEN 'n' ELSE 'f' END || lpad((1 + page_id % 6)::VARCHAR, 3, '0') || '.nc'
              ELSE 'nos.bay.' || CASE WHEN page_id % 3 = 0 THEN 'fields' ELSE 'regulargrid' END || '.' || CASE WHEN page_id % 5 < 2 THEN 'n' ELSE 'f' END || lpad((1 + page_id % 6)::VARCHAR, 3, '0') || '.202401' || lpad((1 + page_id % 27)::VARCHAR, 2, '0') || '.t' || lpad((6 * (page_id % 4))::VARCHAR, 2, '0') || 'z.nc' END AS name
            FROM pages))""",
)
def key_parse(spark, sf):
    """Archive keys in two namings read into product, run and valid time."""
    p = F.col("page_id")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    product = F.when(p % 3 == 0, "fields").otherwise("regulargrid")
    tail = F.concat(F.when(p % 5 < 2, "n").otherwise("f"), F.lpad((1 + p % 6).cast("string"), 3, "0"))
    day, hour = F.concat(F.lit("202401"), two(1 + p % 27)), two((p % 4) * 6)
    new = F.concat(F.lit("bay.t"), hour, F.lit("z."), day, F.lit("."), product, F.lit("."), tail, F.lit(".nc"))
    old = F.concat(F.lit("nos.bay."), product, F.lit("."), tail, F.lit("."), day, F.lit(".t"), hour, F.lit("z.nc"))
    keyed = table(spark, sf, "pages").select("page_id", F.concat(F.lit("a/b/"), F.when(p % 2 == 0, new).otherwise(old)).alias("key"))
    return N.forecast_keys(keyed, "key", "bay").select("page_id", "name", "naming", "product", "guidance", "lead", "run_time", "valid_time")


@query(
    "url_parts",
    r"""
    SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
      split_part(url, '/', -1) AS base_name, sha256(url) AS identity
    FROM pages""",
)
def url_parts(spark, sf):
    """Scheme, host, last path part and identity of every page address."""
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", F.regexp_extract(url, r"^(https?)://", 1).alias("scheme"), F.regexp_extract(url, r"^https?://([^/?#]+)", 1).alias("host"),
        N.base_name(url).alias("base_name"), N.identity_hash(url).alias("identity"),
    )


@query(
    "tile_names",
    r"""
    SELECT p_partkey, 'tiled_' || res || 'as' AS collection, round(lon, 8) AS west, round(lat - 0.25, 8) AS south, arc AS resolution_arcsec, CAST(2010 + p_size % 12 AS INTEGER) AS year
    FROM (SELECT p_partkey, p_size, CASE p_size % 4 WHEN 0 THEN '19' WHEN 1 THEN '13' WHEN 2 THEN '1' ELSE '3' END AS res,
        CASE p_size % 4 WHEN 0 THEN 1.0::DOUBLE / 9 WHEN 1 THEN 1.0::DOUBLE / 3 WHEN 2 THEN 1.0 ELSE 3.0 END AS arc,
        -(60 + p_partkey % 60 + 0.25::DOUBLE * (p_size % 4)) AS lon, 20 + p_partkey % 30 + 0.25::DOUBLE * (p_size % 3 + 1) AS lat FROM part)""",
)
def tile_names(spark, sf):
    """Elevation tile names read into tier, bounds and year."""
    k, s = F.col("p_partkey"), F.col("p_size")
    quarter = lambda c: F.element_at(F.array(*map(F.lit, ["00", "25", "50", "75"])), c)
    res = F.element_at(F.array(*map(F.lit, ["19", "13", "1", "3"])), s % 4 + 1)
    name = F.concat(
        F.lit("u/ncei"), res, F.lit("_n"), (20 + k % 30).cast("string"), F.lit("x"), quarter((s % 3 + 2)), F.lit("_w"),
        F.lpad((60 + k % 60).cast("string"), 3, "0"), F.lit("x"), quarter(s % 4 + 1), F.lit("_"), (2010 + s % 12).cast("string"), F.lit("v2.tif"),
    )
    t = N.elevation_tiles(table(spark, sf, "part").select("p_partkey", name.alias("file")), "file")
    return t.select("p_partkey", "collection", "west", "south", "resolution_arcsec", "year")


@query(
    "text_readings",
    r"""
    SELECT doc_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS folded,
      regexp_extract(text, '([-+0-9.]+)', 1) AS first_number_text,
      substring(regexp_replace(text, '(https?://[^\s"''?#]+)[?#][^\s"'']*', '\1', 'g'), 1, 1000) AS public_text
    FROM documents""",
)
def text_readings(spark, sf):
    """Whole documents folded to single spaces; first number; addresses without their queries."""
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", N.folded(t).alias("folded"), F.regexp_extract(t, r"([-+0-9.]+)", 1).alias("first_number_text"), N.public_message(t).alias("public_text")
    )


@query(
    "name_normalise",
    r"""SELECT p_partkey, lower(trim(regexp_replace(replace('  ' || p_name || '-Zone   ' || p_brand, '-Zone', '- Zone'), '\s+', ' ', 'g'))) AS site FROM part""",
)
def name_normalise(spark, sf):
    """Site names in one spelling."""
    raw = F.concat(F.lit("  "), "p_name", F.lit("-Zone   "), "p_brand")
    return table(spark, sf, "part").select("p_partkey", N.site_name(raw).alias("site"))


@query(
    "json_first_present",
    """
    SELECT event_id, coalesce(json_extract_string(props, '$.size'), json_extract_string(props, '$.k')) AS first_value,
      json_extract_string(props, '$.k')::DOUBLE * 1048576.0 AS stated_bytes
    FROM events""",
)
def json_first_present(spark, sf):
    """First of several JSON fields; the sizes a document states, in bytes."""
    props = F.col("props")
    return table(spark, sf, "events").select(
        "event_id", D.first_present(props, ["$.size", "$.k"]).alias("first_value"),
        D.stated_bytes(props, {"bytes": ["$.bytes"], "mb": ["$.k", "$.size_mb"], "gb": ["$.gb"]}).alias("stated_bytes"),
    )


@query(
    "content_ranges",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN o_custkey END AS first_byte, CASE WHEN o_orderkey % 4 <> 3 THEN o_custkey + 99 END AS last_byte
    FROM orders""",
)
def content_ranges(spark, sf):
    """Byte ranges read from a header; inconsistent ones are null."""
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    total = F.when(k % 4 == 3, c + 99).otherwise(c + 1000)
    header = F.concat(F.lit("bytes "), c.cast("string"), F.lit("-"), (c + 99).cast("string"), F.lit("/"), total.cast("string"))
    r = table(spark, sf, "orders").select("o_orderkey", N.content_range(header).alias("r"))
    return r.select("o_orderkey", F.col("r.first").alias("first_byte"), F.col("r.last").alias("last_byte"))


@query(
    "profile_paths",
    """
    SELECT c_custkey, lower(c_mktsegment) AS dac, (5900000 + c_custkey)::VARCHAR AS wmo, CASE WHEN c_custkey % 2 = 0 THEN 'R' ELSE 'D' END AS mode
    FROM customer WHERE c_custkey % 5 <> 4""",
)
def profile_paths(spark, sf):
    """Profile paths split into centre, platform and mode; malformed paths drop out."""
    k = F.col("c_custkey")
    name = F.concat(F.when(k % 3 == 0, "B").otherwise(""), F.when(k % 5 == 4, "X").when(k % 2 == 0, "R").otherwise("D"), k.cast("string"), F.lit("_001.nc"))
    path = F.concat("c_mktsegment", F.lit("/"), (k + 5900000).cast("string"), F.lit("/profiles/"), name)
    p = table(spark, sf, "customer").select("c_custkey", N.profile_path_parts(path).alias("p")).where("p is not null")
    return p.select("c_custkey", "p.dac", "p.wmo", "p.mode")


@query(
    "month_pieces",
    """
    SELECT o_orderkey, greatest(m, d) AS first_day, least(last_day(m), d + 70)::DATE AS last_day
    FROM (SELECT o_orderkey, d, unnest(generate_series(date_trunc('month', d)::DATE, d + 70, INTERVAL 1 MONTH))::DATE AS m
          FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders))""",
)
def month_pieces(spark, sf):
    """A 70-day request cut into calendar months."""
    d = F.to_date("o_orderdate")
    p = table(spark, sf, "orders").select("o_orderkey", F.explode(T.month_pieces(d, F.date_add(d, 70))).alias("p"))
    return p.select("o_orderkey", "p.first_day", "p.last_day")


@query(
    "discovery_prefixes",
    """
    SELECT c_custkey, 'm/' || strftime(d, '%Y/%m/%d') || '/' AS prefix
    FROM (SELECT c_custkey, unnest(generate_series(DATE '2024-01-30' + (c_custkey % 20)::INTEGER - 1, DATE '2024-01-30' + (c_custkey % 20)::INTEGER + 3, INTERVAL 1 DAY)) AS d FROM customer)
    UNION ALL
    SELECT c_custkey, 'm/' || strftime(d, '%Y%m') || '/' AS prefix
    FROM (SELECT c_custkey, unnest(generate_series(date_trunc('month', DATE '2024-01-30' + (c_custkey % 20)::INTEGER - 1), DATE '2024-01-30' + (c_custkey % 20)::INTEGER + 3, INTERVAL 1 MONTH)) AS d FROM customer)""",
)
def discovery_prefixes(spark, sf):
    """Folders to list for a window padded by a day."""
    start = F.date_add(F.lit("2024-01-30").cast("date"), (F.col("c_custkey") % 20).cast("int"))
    return table(spark, sf, "customer").select("c_custkey", F.explode(T.padded_prefixes(start, F.date_add(start, 2), "m/")).alias("prefix"))


@query(
    "plan_gate",
    """
    SELECT o_orderkey, round(central, 9) AS central_s, round(central * 1.5 + n * 5.0, 9) AS conservative_s,
      CASE WHEN NOT (free > 4 * size) THEN 'blocked' WHEN central * 1.5 + n * 5.0 >= 600 THEN 'long_run_monitor_required' ELSE 'ready' END AS state
    FROM (SELECT o_orderkey, o_totalprice AS size, o_custkey * 1000.0 AS free, o_orderkey % 9 AS n, o_totalprice / 2000.0 + (o_orderkey % 9) * least(5.0::DOUBLE, o_custkey % 8) AS central FROM orders)""",
)
def plan_gate(spark, sf):
    """Transfer time and the storage and duration gate."""
    size, free, n = F.col("o_totalprice"), F.col("o_custkey") * 1000.0, F.col("o_orderkey") % 9
    _, central, careful = D.duration_seconds(size, F.lit(2000.0), n, (F.col("o_custkey") % 8).cast("double"))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round(central, 9).alias("central_s"), F.round(careful, 9).alias("conservative_s"), D.plan_state(size, free, careful).alias("state")
    )


@query(
    "clean_dates",
    """
    SELECT user_id, min(strftime(ts, '%Y-%m-%d')) FILTER (event_id % 4 <> 1) AS first_date,
      max(strftime(ts, '%Y-%m-%d')) FILTER (event_id % 4 <> 1) AS last_date
    FROM events GROUP BY user_id""",
)
def clean_dates(spark, sf):
    """First and last usable date text per user: blanks and null words are not dates."""
    words = F.element_at(F.array(F.lit(" "), F.lit("NaN"), F.lit("none")), (F.col("event_id") % 3 + 1).cast("int"))
    raw = F.when(F.col("event_id") % 4 == 1, words).otherwise(F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd"), F.lit(" ")))
    usable = F.get(D.clean_dates(F.array(raw)), F.lit(0))
    return table(spark, sf, "events").select("user_id", usable.alias("d")).groupBy("user_id").agg(
        F.min("d").alias("first_date"), F.max("d").alias("last_date")
    )
