"""Planar distances. The two differ in unit and in how longitude is scaled."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylytics.constants import KM_PER_DEGREE, MILES_PER_LAT_DEGREE, MILES_PER_LNG_DEGREE
from staylytics.functions.parse import as_column, to_double


def planar_miles(
    lat: Column | str,
    lng: Column | str,
    clat: Column | str,
    clng: Column | str,
    lat_miles: float = MILES_PER_LAT_DEGREE,
    lng_miles: float = MILES_PER_LNG_DEGREE,
) -> Column:
    """Miles with one fixed factor per axis."""
    dy = (to_double(lat) - as_column(clat)) * F.lit(lat_miles)
    dx = (to_double(lng) - as_column(clng)) * F.lit(lng_miles)
    return F.sqrt(dy * dy + dx * dx)


def planar_km(
    lat: Column | str, lng: Column | str, clat: Column | str, clng: Column | str, per_degree: float = KM_PER_DEGREE
) -> Column:
    """Kilometres with longitude shrunk by the cosine of the latitude."""
    y = to_double(lat)
    dy = y - as_column(clat)
    dx = (to_double(lng) - as_column(clng)) * F.cos(F.radians(y))
    return F.lit(per_degree) * F.sqrt(dy * dy + dx * dx)
