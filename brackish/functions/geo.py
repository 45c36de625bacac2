"""Longitude, latitude and planar geometry as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius and kilometres per degree.
EARTH_RADIUS_KM = 6371.0088
EARTH_RADIUS_M = 6371000.0
KM_PER_DEGREE_LON = 111.320
KM_PER_DEGREE_LAT = 110.574


def wrap_lon(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def lon_360(lon: Column) -> Column:
    return F.pmod(lon, F.lit(360.0))


def unwrap_from(lon: Column, start: Column | float) -> Column:
    """Longitude moved by whole turns to the first value at or after ``start``."""
    start = F.lit(start) if not isinstance(start, Column) else start
    turned = lon_360(lon)
    return turned + 360.0 * F.ceil((start - turned) / 360.0)


def unwrap_interval(west: float, east: float, padding: float = 0.0) -> tuple[float, float]:
    """West-east as an increasing pair in degrees, a whole turn where it closes."""
    if padding < 0:
        raise ValueError("padding must not be negative")
    whole = (0.0, 360.0)
    if abs(east - west) >= 359.999999:
        return whole
    start, stop = west % 360.0, east % 360.0
    stop += 360.0 if stop < start else 0.0
    start, stop = start - padding, stop + padding
    return whole if stop - start >= 359.999999 else (start, stop)


def in_lon_range(lon: Column, west: float, east: float) -> Column:
    """Closed range; west beyond east means the range crosses the dateline."""
    lon = wrap_lon(lon)
    if west <= east:
        return lon.between(west, east)
    return (lon >= west) | (lon <= east)


def in_bbox(lon: Column, lat: Column, bbox: Sequence[float]) -> Column:
    west, south, east, north = bbox
    return in_lon_range(lon, west, east) & lat.between(south, north)


def split_at_dateline(bbox: Sequence[float]) -> list[tuple[float, float, float, float]]:
    west, south, east, north = bbox
    if west <= east:
        return [(west, south, east, north)]
    return [(west, south, 180.0, north), (-180.0, south, east, north)]


def boxes_meet(a: Sequence[Column], b: Sequence[Column], touching: bool = True) -> Column:
    """Do two (west, south, east, north) boxes overlap?"""
    (aw, as_, ae, an), (bw, bs, be, bn) = a, b
    if touching:
        return (aw <= be) & (ae >= bw) & (as_ <= bn) & (an >= bs)
    return (aw < be) & (ae > bw) & (as_ < bn) & (an > bs)


def box_meets_request(box: Sequence[Column], bbox: Sequence[float]) -> Column:
    """Open overlap with a request box; boxes kept in 0-360 degrees are honoured."""
    west, south, east, north = bbox
    w, s, e, n = box
    turned = (w > 180.0) | (e > 180.0)
    rw = F.when(turned, F.lit(west + 360.0 if west < 0 else west)).otherwise(F.lit(west))
    re = F.when(turned, F.lit(east + 360.0 if east <= 0 else east)).otherwise(F.lit(east))
    return (w < re) & (e > rw) & (s < north) & (n > south)


def overlap_area(box: Sequence[Column], bbox: Sequence[float]) -> Column:
    w, s, e, n = box
    west, south, east, north = (F.lit(float(v)) for v in bbox)
    width = F.least(e, east) - F.greatest(w, west)
    height = F.least(n, north) - F.greatest(s, south)
    return F.when((width > 0) & (height > 0), width * height).otherwise(F.lit(0.0))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2.0
    half_lon = F.radians(wrap_lon(lon2 - lon1)) / 2.0
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    return F.asin(F.sqrt(chord)) * (2.0 * EARTH_RADIUS_KM)


def local_x_km(lon: Column, center_lon: Column, center_lat: Column) -> Column:
    return wrap_lon(lon - center_lon) * KM_PER_DEGREE_LON * F.cos(F.radians(center_lat))


def local_y_km(lat: Column, center_lat: Column) -> Column:
    return (lat - center_lat) * KM_PER_DEGREE_LAT


def utm_epsg(lon: Column, lat: Column) -> Column:
    """WGS84 UTM zone code; null outside 80 S to 84 N."""
    zone = F.least(F.lit(60), F.greatest(F.lit(1), F.floor((lon + 180.0) / 6.0) + 1))
    return F.when(
        lon.between(-180, 180) & lat.between(-80, 84), (F.when(lat >= 0, 32600).otherwise(32700) + zone).cast("int")
    )


def cross(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """Twice the signed area of a, b, p."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def in_triangle(px: Column, py: Column, corners: Sequence[tuple[Column, Column]]) -> Column:
    """Inside or on the edge, for either orientation."""
    (ax, ay), (bx, by), (cx, cy) = corners
    d1, d2, d3 = cross(ax, ay, bx, by, px, py), cross(bx, by, cx, cy, px, py), cross(cx, cy, ax, ay, px, py)
    return ~(((d1 < 0) | (d2 < 0) | (d3 < 0)) & ((d1 > 0) | (d2 > 0) | (d3 > 0)))


def in_ring(px: Column, py: Column, ring: Sequence[tuple[float, float]], boundary: bool = True) -> Column:
    """Even-odd test against a fixed ring; ``boundary`` counts points on it as inside."""
    flips, touches = [], []
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
        if ay != by:
            straddles = (F.lit(ay) > py) != (F.lit(by) > py)
            at = F.lit(ax) + (py - ay) * ((bx - ax) / (by - ay))
            flips.append(F.when(straddles & (px < at), 1).otherwise(0))
        on_line = cross(*(F.lit(float(v)) for v in (ax, ay, bx, by)), px, py) == 0
        within = px.between(min(ax, bx), max(ax, bx)) & py.between(min(ay, by), max(ay, by))
        touches.append(on_line & within)
    inside = F.pmod(reduce(lambda a, b: a + b, flips), F.lit(2)) == 1
    return inside | reduce(lambda a, b: a | b, touches) if boundary else inside


def subdivisions(length: Column, spacing: Column) -> Column:
    """Fractions (0 up to, not including, 1) that cut a length into equal pieces no longer than the spacing."""
    pieces = F.greatest(F.lit(1), F.ceil(length / spacing)).cast("int")
    return F.transform(F.sequence(F.lit(0), pieces - 1), lambda k: k / pieces)


def metric_subdivisions(length: Column, start: Column, end: Column) -> Column:
    """Fractions that cut a length into pieces of equal size relative to a target going linearly from start to end."""
    growth = F.when(F.abs(end - start) > 1e-12, (end - start) / start)
    total = F.when(growth.isNull(), length / start).otherwise(length * F.log1p(growth) / (end - start))
    pieces = F.greatest(F.lit(1), F.ceil(total)).cast("int")
    even = lambda k: k / pieces
    return F.transform(
        F.sequence(F.lit(0), pieces - 1),
        lambda k: F.when(growth.isNull(), even(k)).otherwise(F.expm1(even(k) * F.log1p(growth)) / growth),
    )


def segments_cross(a: Sequence[Column], b: Sequence[Column], c: Sequence[Column], d: Sequence[Column]) -> Column:
    """Do closed segments ab and cd share a point?"""

    def side(p, q, r):
        return F.signum(cross(*p, *q, *r))

    def on(p, q, r):
        return (
            (side(p, q, r) == 0)
            & r[0].between(F.least(p[0], q[0]), F.greatest(p[0], q[0]))
            & r[1].between(F.least(p[1], q[1]), F.greatest(p[1], q[1]))
        )

    proper = (side(a, b, c) != side(a, b, d)) & (side(c, d, a) != side(c, d, b))
    return proper | on(a, b, c) | on(a, b, d) | on(c, d, a) | on(c, d, b)


def cell_area_m2(pixel_width: Column, row_skew: Column, column_skew: Column, pixel_height: Column) -> Column:
    """Cell area from an affine transform; a flat cell is refused."""
    area = F.abs(pixel_width * pixel_height - row_skew * column_skew)
    return F.when(area > 0, area).otherwise(F.raise_error(F.lit("cell area must be positive")).cast("double"))


def degree_cell_area_m2(lat: Column, lon_width: float, lat_width: float) -> Column:
    per_degree = 3.141592653589793 / 180.0 * EARTH_RADIUS_M
    return (
        F.lit(lon_width * per_degree) * F.greatest(F.cos(F.radians(lat)), F.lit(1e-6)) * F.lit(lat_width * per_degree)
    )
