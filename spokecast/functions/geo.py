"""Distances and areas on latitude/longitude columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius, sanity box and area boxes
# (name, lat from, lat to, lon from, lon to); the first match wins.
EARTH_RADIUS_KM = 6371
CITY_BOX = (40.5, 41.0, -74.3, -73.7)
AREA_BOXES = (
    ("Manhattan - Financial", 40.700, 40.720, -74.020, -73.980),
    ("Manhattan - Midtown", 40.740, 40.780, -74.010, -73.970),
    ("Manhattan - Upper West", 40.780, 40.800, -74.000, -73.950),
    ("Manhattan - Upper East", 40.780, 40.800, -73.980, -73.940),
    ("Manhattan - Downtown", 40.700, 40.730, -73.970, -73.930),
    ("Brooklyn", 40.580, 40.740, -74.050, -73.833),
    ("Queens", 40.690, 40.800, -73.962, -73.700),
    ("Bronx", 40.790, 40.880, -73.930, -73.830),
    ("Jersey City", 40.680, 40.760, -74.080, -74.020),
)


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    return lat.between(box[0], box[1]) & lon.between(box[2], box[3])


def in_city(lat: Column, lon: Column) -> Column:
    """Coordinate sanity box; false or null outside."""
    return in_box(lat, lon, CITY_BOX)


def area_of(lat: Column, lon: Column) -> Column:
    """Name of the first box holding the point, else ``Other``."""
    (name, *box), *rest = AREA_BOXES
    first = F.when(in_box(lat, lon, tuple(box)), name)
    return reduce(lambda c, b: c.when(in_box(lat, lon, b[1:]), b[0]), rest, first).otherwise("Other")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres (K1)."""
    dlat = F.sin((F.radians(lat1) - F.radians(lat2)) / 2)
    dlon = F.sin((F.radians(lon1) - F.radians(lon2)) / 2)
    a = dlat * dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * dlon * dlon
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(a))
