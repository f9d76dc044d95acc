"""Site and postal-code points."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odspark.operators.common import sized_side

# key lists longer than this become a semi join instead of an IN list
ISIN_MAX_KEYS = 1000


def to_double(name: str) -> Column:
    """Text coordinate → double; unparsable text gives null (ANSI-safe)."""
    return F.expr(f"try_cast({name} AS DOUBLE)").alias(name)


def filter_keys(df: DataFrame, key_col: str, keys: Iterable[str] | DataFrame | None) -> DataFrame:
    """Optional key filter; an empty list means no filter."""
    if keys is None:
        return df
    if isinstance(keys, DataFrame):
        return df.join(keys.select(F.col(keys.columns[0]).alias(key_col)).distinct(), key_col, "left_semi")
    keys = list(keys)
    if not keys:
        return df
    if len(keys) <= ISIN_MAX_KEYS:
        return df.filter(F.col(key_col).isin(keys))
    spark = df.sparkSession
    key_df = spark.createDataFrame([(k,) for k in keys], f"{key_col} string")
    return df.join(key_df, key_col, "left_semi")


def site_points(sites: DataFrame, keys: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Open site rows with coordinates whose relevanz is the key's maximum.

    The maximum (A1) is taken over all open rows of the key, also those without
    coordinates; a tie keeps every top row (J2). The per-key maxima are a partial
    aggregate (a hot key costs one row per task before the shuffle), written once,
    size-checked and broadcast into the scan of the site rows.
    """
    typed = sites.select("kh_key", to_double("longitude"), to_double("latitude"), "relevanz", "gueltig_bis")
    open_rows = typed.filter(F.col("gueltig_bis").isNull())
    maxima = open_rows.groupBy("kh_key").agg(F.max("relevanz").alias("relevanz"))
    side, small = sized_side(maxima)
    out = open_rows.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull()) \
        .join(F.broadcast(side) if small else side, ["kh_key", "relevanz"], "left_semi")
    return filter_keys(out, "kh_key", keys).distinct()


def postal_points(postal: DataFrame) -> DataFrame:
    """Distinct postal codes with both coordinates (plz keeps leading zeros)."""
    typed = postal.select("plz", to_double("longitude_plz"), to_double("latitude_plz"))
    return typed.filter(F.col("longitude_plz").isNotNull() & F.col("latitude_plz").isNotNull()).distinct()


def as_points(df: DataFrame, key: str, lon: str, lat: str) -> DataFrame:
    """P10: any table → (key, longitude, latitude)."""
    return df.select(F.col(key).alias("key"), F.col(lon).cast("double").alias("longitude"),
                     F.col(lat).cast("double").alias("latitude"))
