"""Reading structured facts out of names, keys and messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group(text: Column, pattern: str, index: int) -> Column:
    """A regex group, null where the pattern or the group does not match."""
    return F.nullif(F.regexp_extract(text, pattern, index), F.lit(""))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def profile_path_parts(path: Column) -> Column:
    """Struct (dac, wmo, name, mode) of ``dac/wmo/profiles/name``; null when malformed."""
    parts = F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/")
    name = F.element_at(parts, -1)
    shifted = F.upper(F.substring(name, 1, 1)).isin("B", "S")
    mode = F.upper(F.when(shifted, F.substring(name, 2, 1)).otherwise(F.substring(name, 1, 1)))
    fits = (F.size(parts) >= 4) & (F.lower(F.try_element_at(parts, F.lit(-2))) == "profiles") & mode.isin("R", "D")
    return F.when(
        fits,
        F.struct(
            F.lower(parts[0]).alias("dac"), parts[1].alias("wmo"), name.alias("name"), mode.alias("mode")
        ),
    )


# Object key formats.
CURRENT_KEY = r"(?i)^{model}\.t(\d{{2}})z\.(\d{{8}})\.(fields|stations|regulargrid)\.(?:([nf])(\d{{3}})|(nowcast|forecast))\.nc$"
LEGACY_KEY = r"(?i)^(?:nos\.)?{model}\.(fields|stations|regulargrid)\.(?:([nf])(\d{{3}})|(nowcast|forecast))\.(\d{{8}})\.t(\d{{2}})z\.nc$"


def regex_groups(text: Column, pattern: str, order: Sequence[int]) -> Column:
    """Groups of one match as an array, in the given order; null where the text does not match."""
    marks = "\u0001".join(f"${i}" for i in order)
    return F.when(text.rlike(pattern), F.split(F.regexp_replace(text, pattern, marks), "\u0001"))


def matched_rows(df: DataFrame, text: Column, patterns: Mapping[str, tuple[str, Sequence[int]]]) -> DataFrame:
    """Rows that match one of the named patterns, with ``_m`` (form, groups).

    The match is exploded rather than filtered: filters written on what is read
    from it then stay above, and the pattern is run once per row.
    """
    found = [
        F.when(text.rlike(p), F.struct(F.lit(form).alias("form"), regex_groups(text, p, order).alias("g")))
        for form, (p, order) in patterns.items()
    ]
    return df.withColumn("_m", F.explode(F.array_compact(F.array(*found))))


def forecast_keys(df: DataFrame, key: str, model: str, cycles: tuple[int, ...] = (0, 6, 12, 18)) -> DataFrame:
    """What each archive key says: product, guidance, run, lead, valid time and span.

    Hourly objects carry ``n``/``f`` and a lead; station objects cover a cycle.
    Keys that fit neither naming are dropped.
    """
    forms = {
        "current": (CURRENT_KEY.format(model=model), (1, 2, 3, 4, 5, 6)),
        "legacy": (LEGACY_KEY.format(model=model), (6, 5, 1, 2, 3, 4)),
    }
    named = df.withColumn("name", base_name(F.col(key)))
    part = lambda i: F.nullif(F.col("_m.g")[i], F.lit(""))
    read = matched_rows(named, F.col("name"), forms).withColumns(
        {
            "naming": F.col("_m.form"),
            "run_time": F.try_to_timestamp(F.concat(part(1), part(0)), F.lit("yyyyMMddHH")).cast("timestamp_ntz"),
            "product": F.lower(part(2)),
            "_code": F.lower(part(3)),
            "lead": part(4).cast("int"),
            "_whole": F.lower(part(5)),
        }
    )
    code, lead, whole, run = F.col("_code"), F.col("lead"), F.col("_whole"), F.col("run_time")
    archive = F.contains(F.col(key), F.lit("/access/"))
    lead_ok = F.when(code == "n", lead.between(1, 6) | ((lead == 0) & archive)).otherwise(lead >= 1)
    hourly = (F.col("product") != "stations") & lead_ok
    fits = F.hour(run).isin(*cycles) & F.when(code.isNotNull(), hourly).otherwise((F.col("product") == "stations") & whole.isNotNull())
    ahead = F.when(code == "n", lead - 6).otherwise(lead)
    hour, tail = F.expr("interval 1 hour"), F.expr("interval 6 minutes")
    timed = read.where(fits).withColumn("valid_time", run + F.make_dt_interval(F.lit(0), ahead))
    start = F.when(whole == "nowcast", run - 6 * hour).when(whole == "forecast", run).otherwise(F.col("valid_time"))
    end = (
        F.when(whole == "nowcast", run + tail)
        .when(whole == "forecast", run + F.expr("interval 2 days") + tail)
        .otherwise(F.col("valid_time") + hour)
    )
    guidance = F.coalesce(whole, F.when(code == "n", "nowcast").otherwise("forecast"))
    return timed.withColumns(
        {"guidance": guidance, "aggregate": whole.isNotNull(), "expected_start": start, "expected_end": end}
    ).drop("_m", "_code", "_whole")


# Elevation tile name format, tile size and tiers (arc seconds).
TILE_NAME = r"(?i)^ncei(\d+)_([ns])(\d+)x(\d+)_([ew])(\d+)x(\d+)_(\d{4})v(\d+)\.(nc|tif|tiff)$"
TILE_DEGREES = 0.25
TILE_TIERS = {"19": 1.0 / 9.0, "13": 1.0 / 3.0, "1": 1.0, "3": 3.0}


def coordinate_token(hemisphere: Column, whole: Column, part: Column) -> Column:
    size = F.concat(whole, F.lit("."), part).try_cast("double")
    return F.when(F.lower(hemisphere).isin("s", "w"), -size).otherwise(size)


def elevation_tiles(df: DataFrame, name: str) -> DataFrame:
    """Tier, bounds, year and version of tile names; other names are dropped."""
    matched = matched_rows(df, base_name(F.col(name)), {"tile": (TILE_NAME, range(1, 11))})
    m = lambda i: F.col("_m.g")[i - 1]
    tier = F.element_at(F.create_map(*[F.lit(v) for pair in TILE_TIERS.items() for v in pair]), m(1))
    read = matched.where(m(1).isin(*TILE_TIERS)).withColumns(
        {
            "collection": F.concat(F.lit("tiled_"), m(1), F.lit("as")),
            "resolution_arcsec": tier,
            "_lat": coordinate_token(m(2), m(3), m(4)),
            "west": F.round(coordinate_token(m(5), m(6), m(7)), 8),
            "year": m(8).cast("int"),
            "version": m(9).cast("int"),
            "_south": F.lower(m(2)) == "s",
        }
    )
    south = F.when(F.col("_south"), F.col("_lat")).otherwise(F.col("_lat") - TILE_DEGREES)
    return read.withColumns(
        {"south": F.round(south, 8), "north": F.round(south + TILE_DEGREES, 8), "east": F.round(F.col("west") + TILE_DEGREES, 8)}
    ).drop("_m", "_lat", "_south")


def covered_years(file_name: Column, pattern: str) -> Column:
    """Array of years a file name covers, from one year or a first and a last."""
    first = group(file_name, pattern, 1).try_cast("int")
    last = F.coalesce(group(file_name, pattern, 2).try_cast("int"), first)
    return F.when(first <= last, F.sequence(first, last))


def content_range(text: Column) -> Column:
    """Struct (first, last, total) of ``bytes a-b/n``; null when inconsistent."""
    pattern = r"(?i)^\s*bytes\s+(\d+)-(\d+)/(\d+)\s*$"
    first, last, total = (group(text, pattern, i).try_cast("long") for i in (1, 2, 3))
    return F.when(
        (first <= last) & (total > last), F.struct(first.alias("first"), last.alias("last"), total.alias("total"))
    )


def first_number(text: Column) -> Column:
    return group(text, r"([-+0-9.]+)", 1).try_cast("double")


def actual_range(text: Column, name: str) -> Column:
    """Struct (low, high) of ``name: ... actual_range: a, b``."""
    number = r"([-+0-9.Ee]+)"
    pattern = rf"(?is){name}:.*?actual_range:\s*{number}\s*,\s*{number}"
    low, high = (group(text, pattern, i).try_cast("double") for i in (1, 2))
    return F.when(low.isNotNull() & high.isNotNull(), F.struct(low.alias("low"), high.alias("high")))


def folded(text: Column) -> Column:
    """Lower case with single spaces."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def site_name(text: Column) -> Column:
    return folded(F.replace(text, F.lit("-Zone"), F.lit("- Zone")))


def public_message(text: Column, length: int = 1000) -> Column:
    """Drop URL queries and local paths, then shorten."""
    no_query = F.regexp_replace(text, r"(https?://[^\s\"'?#]+)[?#][^\s\"']*", "$1")
    no_drive = F.regexp_replace(no_query, r"(?i)[A-Z]:\\[^\s,;]+", "[local-path]")
    no_home = F.regexp_replace(no_drive, r"(?<!:)/(?:home|Users|scratch)/[^\s,;]+", "[local-path]")
    return F.substring(no_home, 1, length)


def identity_hash(*parts: Column) -> Column:
    """SHA-256 over parts; missing parts keep their place."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def bare_etag(etag: Column) -> Column:
    return F.nullif(F.trim(etag, F.lit('" ')), F.lit(""))


def cache_path(source: Column, key: Column) -> Column:
    """Collision-free relative path: source/year/month/hash-name."""
    name = base_name(key)
    day = group(name, r"(\d{8})", 1)
    return F.when(
        day.isNotNull(),
        F.concat_ws(
            "/", source, F.substring(day, 1, 4), F.substring(day, 5, 2),
            F.concat(F.substring(F.sha2(key, 256), 1, 16), F.lit("-"), name),
        ),
    )
