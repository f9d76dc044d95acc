"""Publish per-site snapshots: A2, J5, P3, P6, P12, F4, S12, V5."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odspark.functions.units import drive_zone
from odspark.operators.common import sized_side
from odspark.operators.points import filter_keys

# a published table: read with it, since a snapshot without rows leaves no file to take it from
SNAPSHOT_SCHEMA = "plz string, fahrstrecke double, fahrzeit double, fahrzone int, kh_key string"


def latest_dates(stored: DataFrame, keys: Iterable[str] | None = None) -> DataFrame:
    """A2: max(gueltig_ab) per kh_key over open rows, ordered by kh_key.

    Partial aggregation map-side: a hot key costs one row per task before the shuffle.
    """
    open_rows = filter_keys(stored.filter(F.col("gueltig_bis").isNull()), "kh_key", keys)
    return open_rows.groupBy("kh_key").agg(F.max("gueltig_ab").alias("max_gueltig_ab"))


def known_keys(latest: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(keys present in the target's key list, keys reported and skipped)."""
    k = known.select("kh_key").distinct()
    return latest.join(k, "kh_key", "left_semi"), latest.join(k, "kh_key", "left_anti")


def snapshot(stored: DataFrame, known: DataFrame | None = None, keys: Iterable[str] | None = None,
             mode: str = "latest_date") -> DataFrame:
    """V5: one job for all keys → (kh_key, plz, fahrstrecke, fahrzeit, fahrzone).

    ``mode='latest_date'`` keeps open rows dated at the key's latest date (reference);
    ``'all_open'`` keeps every open row. The per-key dates are a small aggregate:
    materialized, size-checked and broadcast into the scan of the stored rows, so
    the big side is never shuffled.
    """
    open_rows = filter_keys(stored.filter(F.col("gueltig_bis").isNull()), "kh_key", keys)
    if mode == "all_open":
        rows = open_rows if known is None else open_rows.join(known.select("kh_key").distinct(), "kh_key", "left_semi")
    else:
        latest = latest_dates(stored, keys)
        if known is not None:
            latest, _ = known_keys(latest, known)
        side, small = sized_side(latest)
        side = side.withColumnRenamed("max_gueltig_ab", "gueltig_ab")
        rows = open_rows.join(F.broadcast(side) if small else side, ["kh_key", "gueltig_ab"], "inner")
    return rows.select(
        "kh_key", "plz",
        F.col("fahrstrecke_km").alias("fahrstrecke"),
        F.col("fahrzeit_min").alias("fahrzeit"),
        drive_zone(F.col("fahrzeit_min")).alias("fahrzone"),
    )


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace only the kh_key partitions present in ``df`` (dynamic overwrite)."""
    # range partitioning on (kh_key, plz) splits a hot key over several writers
    (df.repartitionByRange("kh_key", "plz").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("kh_key").parquet(path))


def zone_counts(snap: DataFrame) -> DataFrame:
    """Distinct postal codes per (site, drive-time zone)."""
    return snap.groupBy("kh_key", "fahrzone").agg(F.countDistinct("plz").alias("n_plz"))
