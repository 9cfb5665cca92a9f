"""Points and distances as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088  # mean radius
KM_PER_DEGREE = 111.195  # along a meridian on that sphere


def point(lng: Column | str, lat: Column | str) -> Column:
    """``struct<lng, lat>``, NULL when a coordinate is missing."""
    x = F.col(lng) if isinstance(lng, str) else lng
    y = F.col(lat) if isinstance(lat, str) else lat
    return F.when(
        x.isNotNull() & y.isNotNull(), F.struct(x.cast("double").alias("lng"), y.cast("double").alias("lat"))
    )


def haversine_km(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Great-circle distance."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp = F.sin((p2 - p1) / 2)
    dl = F.sin(F.radians(lng2 - lng1) / 2)
    h = dp * dp + F.cos(p1) * F.cos(p2) * dl * dl
    return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)


def distance_km(a: Column, b: Column) -> Column:
    """Great-circle distance between two points."""
    return haversine_km(a["lng"], a["lat"], b["lng"], b["lat"])


def planar(a: Column, b: Column) -> Column:
    """Straight-line distance in degrees between two points."""
    dx, dy = a["lng"] - b["lng"], a["lat"] - b["lat"]
    return F.sqrt(dx * dx + dy * dy)
