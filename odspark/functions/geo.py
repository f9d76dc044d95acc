"""Great-circle distance and grid cells for bucketed spatial joins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle metres between two points given in degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = p2 - p1
    dlmb = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Same formula as SQL text (for the DuckDB oracle)."""
    a = (f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * "
         f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)")
    return f"({2 * EARTH_RADIUS_M} * asin(sqrt(least(1.0, {a}))))"


def bearing_deg(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Initial bearing 0..360 degrees from point 1 to point 2."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dl = F.radians(lon2) - F.radians(lon1)
    y = F.sin(dl) * F.cos(p2)
    x = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(y, x)) + F.lit(360.0), F.lit(360.0))
