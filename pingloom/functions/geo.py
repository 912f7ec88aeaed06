"""Geometry as Column expressions, so that it stays inside generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
DEGREE_M = 111_320.0
#: The latitude at which the plane of contours is true to scale.
PLANE_LATITUDE = 55.8


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def cell(degrees: Column, size_m: float) -> Column:
    return F.floor(degrees / F.lit(size_m / DEGREE_M)).cast("long")


def plane_cell(lat: Column, lon: Column, metres: float, latitude: float = PLANE_LATITUDE) -> tuple[Column, Column]:
    """x and y of a point's square cell in the plane of contours."""
    return F.floor(lon * F.lit(DEGREE_M) * F.lit(math.cos(math.radians(latitude))) / F.lit(metres)).cast("long"), F.floor(lat * F.lit(DEGREE_M) / F.lit(metres)).cast("long")


def mercator_x(lon: Column, zoom: Column) -> Column:
    return (lon + 180.0) / 360.0 * 256.0 * F.pow(F.lit(2.0), zoom)


def mercator_y(lat: Column, zoom: Column) -> Column:
    s = F.sin(F.radians(lat))
    return (F.lit(0.5) - F.log((1 + s) / (1 - s)) / F.lit(4 * math.pi)) * 256.0 * F.pow(F.lit(2.0), zoom)


def kmh(meters: Column, seconds: Column) -> Column:
    return F.try_divide(meters * 3.6, seconds)


def speed_colour(kmh_value: Column, top: float = 40.0) -> Column:
    """Red at rest to green at `top`, as struct<r, g>."""
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), kmh_value / top))
    return F.struct(F.round((1 - share) * 255).cast("int").alias("r"), F.round(share * 255).cast("int").alias("g"))
