"""Unit changes, rounding, drive-time zone, chunk file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Drive-time zone upper bounds in minutes (zone i for minutes < bound i, else 7)
ZONE_BOUNDS = [10, 20, 30, 40, 50, 60]
ROUND_DIGITS = 5


def metres_to_km(c: Column) -> Column:  # F1
    return c / F.lit(1000.0)


def seconds_to_minutes(c: Column) -> Column:  # F2
    return c / F.lit(60.0)


def round5(c: Column) -> Column:  # like "%.5f", halves by the exact binary value (F.round goes by the shortest decimal form)
    scale = F.lit(10.0 ** ROUND_DIGITS)
    part = F.abs(c) * scale - F.floor(F.abs(c) * scale)
    exact = F.regexp_replace(F.format_number(c, ROUND_DIGITS), ",", "").cast("double")
    return F.when((F.abs(part - 0.5) < 1e-3) & (F.abs(c) >= 1 / scale), exact).otherwise(F.round(c, ROUND_DIGITS))


def round_binary(c: Column, decimals: int) -> Column:  # a half of the scaled double goes up, as SQL engines round doubles
    scale = F.lit(10.0 ** decimals)
    return F.round(c * scale) / scale


def drive_zone(minutes: Column) -> Column:  # null and NaN minutes fall to the last zone
    expr = None
    for i, bound in enumerate(ZONE_BOUNDS, start=1):
        cond = minutes < F.lit(bound)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(ZONE_BOUNDS) + 1))


def leg_relevanz(kh_key: Column, plz: Column) -> Column:  # F5
    return F.concat(kh_key, plz)


def chunk_file_name(prefix: str, chunk: Column) -> Column:  # F6 zero-padded file index
    return F.format_string(prefix + "%010d.csv", chunk)
