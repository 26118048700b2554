"""Planar and geographic geometry as column expressions.

A point is a struct (lon, lat), a line or ring an array of points, a polygon an array of
rings. Metric coordinates are those of the Lambert azimuthal equal-area projection that
covers Europe.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<lon:double,lat:double>"
LINE = f"array<{POINT}>"
POLYGON = f"array<{LINE}>"

# The GRS80 ellipsoid and the parameters of EPSG:3035.
A, E2 = 6378137.0, 0.006694380022900788
LAT0, LON0, EAST0, NORTH0 = 52.0, 10.0, 4321000.0, 3210000.0

_E = math.sqrt(E2)


def _q(sin):
    """The authalic function of a sine of latitude, for floats and columns."""
    log = math.log if isinstance(sin, float) else F.ln
    return (1 - E2) * (sin / (1 - E2 * sin * sin) - log((1 - _E * sin) / (1 + _E * sin)) / (2 * _E))


_QP = _q(1.0)
_B0 = math.asin(_q(math.sin(math.radians(LAT0))) / _QP)
_RQ = A * math.sqrt(_QP / 2)
_D = A * math.cos(math.radians(LAT0)) / math.sqrt(1 - E2 * math.sin(math.radians(LAT0)) ** 2) / (_RQ * math.cos(_B0))


def rint(value: Column, digits: int) -> Column:
    """Rounds half to even, as numpy does."""
    return F.rint(value * 10**digits) / 10**digits


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def metric(lon: Column, lat: Column) -> tuple[Column, Column]:
    """East and north in metres."""
    beta = F.asin(_q(F.sin(F.radians(lat))) / _QP)
    turn = F.radians(lon - LON0)
    b = _RQ * F.sqrt(F.lit(2.0) / (1 + math.sin(_B0) * F.sin(beta) + math.cos(_B0) * F.cos(beta) * F.cos(turn)))
    return (
        EAST0 + b * _D * F.cos(beta) * F.sin(turn),
        NORTH0 + b / _D * (math.cos(_B0) * F.sin(beta) - math.sin(_B0) * F.cos(beta) * F.cos(turn)),
    )


def geographic(east: Column, north: Column) -> tuple[Column, Column]:
    """Longitude and latitude of metric coordinates."""
    x, y = (east - EAST0) / _D, (north - NORTH0) * _D
    rho = F.sqrt(x * x + y * y)
    c = 2 * F.asin(rho / (2 * _RQ))
    safe = F.greatest(rho, F.lit(1e-12))
    beta = F.asin(F.cos(c) * math.sin(_B0) + y * F.sin(c) * math.cos(_B0) / safe)
    lon = LON0 + F.degrees(F.atan2(x * F.sin(c), safe * math.cos(_B0) * F.cos(c) - y * math.sin(_B0) * F.sin(c)))
    e4, e6 = E2**2, E2**3
    lat = beta + (E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)
    return lon, F.degrees(lat)


def _metric_point(p: Column) -> Column:
    x, y = metric(p["lon"], p["lat"])
    return F.struct(x.alias("x"), y.alias("y"))


def _edges(line: Column, f) -> Column:
    """f of the ends of each segment of a line."""
    n = F.size(line)
    return F.zip_with(F.slice(line, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(line, F.lit(2), F.greatest(n - 1, F.lit(0))), f)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def length_m(line: Column) -> Column:
    """Length in metres between the projected points."""
    return _total(_edges(F.transform(line, _metric_point), lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"])))


def area_m2(ring: Column) -> Column:
    """Area in square metres inside a ring, closed or not."""
    closed = F.when(is_closed(ring), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))
    return F.abs(_total(_edges(F.transform(closed, _metric_point), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]))) / 2


def is_closed(line: Column) -> Column:
    return F.element_at(line, 1) == F.element_at(line, -1)


def closed_ring(line: Column) -> Column:
    """A ring that ends where it begins."""
    return F.when((F.size(line) > 0) & ~F.coalesce(is_closed(line), F.lit(False)), F.concat(line, F.slice(line, 1, 1))).otherwise(line)


def in_ring(p: Column, ring: Column) -> Column:
    """Whether a point lies inside a ring, by the parity of crossings; points on an upper or right edge do not."""
    crosses = lambda a, b: ((a["lat"] > p["lat"]) != (b["lat"] > p["lat"])) & (p["lon"] < (b["lon"] - a["lon"]) * (p["lat"] - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"])
    safe = lambda a, b: F.when(a["lat"] == b["lat"], F.lit(False)).otherwise(crosses(a, b))
    return F.size(F.filter(_edges(ring, safe), lambda x: x)) % 2 == 1


def bounds(line: Column) -> Column:
    """The box around a line: west, south, east, north."""
    lon, lat = F.transform(line, lambda p: p["lon"]), F.transform(line, lambda p: p["lat"])
    return F.struct(F.array_min(lon).alias("west"), F.array_min(lat).alias("south"), F.array_max(lon).alias("east"), F.array_max(lat).alias("north"))


def nearer_end(line: Column, p: Column) -> Column:
    """Whether p is nearer to a line's start than to its end."""
    far = lambda q: F.hypot(q["lon"] - p["lon"], q["lat"] - p["lat"])
    return far(F.element_at(line, 1)) < far(F.element_at(line, -1))


def extended(line: Column, p: Column) -> Column:
    """A line with a stub from its nearer end to a point; ties go to the end, nulls and points already there change nothing."""
    stub = F.when(nearer_end(line, p), F.concat(F.array(p), line)).otherwise(F.concat(line, F.array(p)))
    return F.when(p.isNull() | (F.element_at(line, 1) == p) | (F.element_at(line, -1) == p), line).otherwise(stub)


def rounded(line: Column, digits: int) -> Column:
    return F.transform(line, lambda p: F.struct(rint(p["lon"], digits).alias("lon"), rint(p["lat"], digits).alias("lat")))


def _pair(p: Column) -> Column:
    return F.concat(p["lon"].cast("string"), F.lit(" "), p["lat"].cast("string"))


def _path(line: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(line, _pair), ", "), F.lit(")"))


def wkt_point(p: Column) -> Column:
    return F.concat(F.lit("POINT ("), _pair(p), F.lit(")"))


def wkt_line(line: Column) -> Column:
    return F.concat(F.lit("LINESTRING "), _path(line))


def wkt_polygon(rings: Column) -> Column:
    """A polygon for one ring, a multi-polygon of outlines for several."""
    one = F.concat(F.lit("POLYGON ("), _path(rings[0]), F.lit(")"))
    many = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(rings, lambda r: F.concat(F.lit("("), _path(r), F.lit(")"))), ", "), F.lit(")"))
    return F.when(F.size(rings) == 1, one).otherwise(many)


def geojson_coordinates(line: Column) -> Column:
    """The points of a line as JSON arrays."""
    return F.concat(F.lit("["), F.array_join(F.transform(line, lambda p: F.concat(F.lit("["), p["lon"].cast("string"), F.lit(","), p["lat"].cast("string"), F.lit("]"))), ","), F.lit("]"))


def ring_offset(n: Column, index: Column, radius: float = 15.0) -> tuple[Column, Column]:
    """East and north offsets of the index-th of n places around a circle, factors rounded to four decimals."""
    angle = math.pi / 4 + 2 * math.pi * index / n
    return radius * rint(F.sin(angle), 4), radius * rint(F.cos(angle), 4)
