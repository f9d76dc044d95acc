"""Checks and validity-dated versions: A4-A7, P5, P8, P11, J4, J6, J7, V1-V4, S14."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odspark.functions.units import leg_relevanz
from odspark.operators.common import join_sized, one_row_join
from odspark.operators.points import filter_keys
from odspark.session import cut_lineage

VALUE_COLUMNS = ["fahrstrecke_km", "fahrzeit_min"]
LEG_COLUMNS = ["kh_key", "plz", "fahrstrecke_km", "fahrzeit_min", "latitude_kh", "longitude_kh",
               "latitude_plz", "longitude_plz", "relevanz"]


def run_date(yyyymmdd: str) -> Column:
    """Run date text yyyyMMdd → DATE (required)."""
    if not yyyymmdd or len(yyyymmdd) != 8 or not yyyymmdd.isdigit():
        raise ValueError(f"run date must be yyyymmdd, got {yyyymmdd!r}")
    return F.to_date(F.lit(yyyymmdd), "yyyyMMdd")


def results_as_legs(results: DataFrame) -> DataFrame:
    """Result rows (key1, key2, distance, duration) under the stored column names."""
    return results.select(F.col("key1").alias("kh_key"), F.col("key2").alias("plz"),
                          F.col("distance").alias("fahrstrecke_km"), F.col("duration").alias("fahrzeit_min"))


# ---- checks -------------------------------------------------------------------------------

def result_keys(results: DataFrame) -> DataFrame:
    """A4: distinct key1 over all result rows."""
    return results.select("key1").distinct()


def coverage_offenders(results: DataFrame, postal_points: DataFrame) -> DataFrame:
    """A5: keys whose row count differs from the number of postal codes (duplicates count)."""
    per_key = results.groupBy("key1").agg(F.count(F.lit(1)).alias("n_rows"))
    n = postal_points.agg(F.count(F.lit(1)).alias("n_expected"))
    return one_row_join(per_key, n).filter(F.col("n_rows") != F.col("n_expected"))


def check_coverage(results: DataFrame, postal_points: DataFrame, sample: int = 10) -> None:
    """A5 as the reference applies it: raise when any key's row count differs from the postal codes.

    Only the number of offenders and a few example keys reach the driver.
    """
    off = coverage_offenders(results, postal_points)
    n = off.count()
    if n:
        examples = [r.key1 for r in off.select("key1").limit(sample).collect()]
        raise ValueError(f"{n} keys without full postal coverage, e.g. {examples}")


def pair_counts(results: DataFrame) -> DataFrame:
    """Rows per (key1, key2), most frequent first."""
    return results.groupBy("key1", "key2").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key1", "key2")


def rows_per_key(results: DataFrame) -> DataFrame:
    """Rows of each key gathered over all files (count + distinct postal codes)."""
    return results.groupBy("key1").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.countDistinct("key2").alias("n_plz"))


# ---- which keys to process ----------------------------------------------------------------

def processed_today(stored: DataFrame, today: Column) -> DataFrame:
    """Keys that already have open rows dated today (same-day rerun)."""
    return stored.filter(F.col("gueltig_bis").isNull() & (F.col("gueltig_ab") == today)).select("kh_key").distinct()


def drop_processed(results: DataFrame, stored: DataFrame, today: Column) -> DataFrame:
    """P5: result rows of keys not yet processed today."""
    done = processed_today(stored, today).withColumnRenamed("kh_key", "key1")
    return results.join(done, "key1", "left_anti")


def invalid_key_rows(stored: DataFrame, results: DataFrame, today: Column,
                     keys: Iterable[str] | None = None) -> DataFrame:
    """J6 / J7 with P11: open older versions (gueltig_bis null, gueltig_ab <> today) to close.

    Without a key list: keys absent from the results (null keys never qualify,
    as with SQL NOT IN). With a key list: all such rows of the listed keys.
    """
    cand = stored.filter(F.col("gueltig_bis").isNull() & (F.col("gueltig_ab") != today))
    keys = list(keys or [])
    if keys:
        return filter_keys(cand, "kh_key", keys).select("kh_key", "gueltig_ab").distinct()
    present = results.select(F.col("key1").alias("kh_key")).distinct()
    return (cand.filter(F.col("kh_key").isNotNull()).join(present, "kh_key", "left_anti")
            .select("kh_key", "gueltig_ab").distinct())


def close_versions(stored: DataFrame, to_close: DataFrame, today: Column, strict_reference: bool = False) -> DataFrame:
    """V3: gueltig_bis = today where (kh_key, gueltig_ab) match.

    Only open rows are touched unless ``strict_reference`` (the reference's
    update also re-dates closed rows of the same date).
    """
    marks = to_close.select("kh_key", "gueltig_ab").distinct().withColumn("_close", F.lit(True))
    j = join_sized(stored, marks, ["kh_key", "gueltig_ab"], "left")
    hit = F.col("_close").isNotNull()
    if not strict_reference:
        hit = hit & F.col("gueltig_bis").isNull()
    return j.withColumn("gueltig_bis", F.when(hit, today).otherwise(F.col("gueltig_bis"))).drop("_close") \
        .select(*stored.columns)


def invalid_key_report(to_close: DataFrame, today: Column) -> DataFrame:
    """V4: distinct keys without distances plus the run timestamp."""
    return to_close.select("kh_key").distinct().withColumn("gueltig_ab", today.cast("timestamp"))


# ---- lookups and output record ------------------------------------------------------------

def legs_record(results: DataFrame, sites: DataFrame, postal: DataFrame) -> DataFrame:
    """J4 + F5 + P8: the fixed 9-column stored leg.

    Site coordinates by kh_key (several site rows: the least (longitude, latitude)),
    postal coordinates by plz. Rows whose key is unknown are dropped here and
    reported by ``lost_lookup_rows``.
    """
    site_xy = sites.groupBy("kh_key").agg(F.min(F.struct("longitude", "latitude")).alias("_s")) \
        .select("kh_key", F.col("_s.longitude").alias("longitude_kh"), F.col("_s.latitude").alias("latitude_kh"))
    plz_xy = postal.groupBy("plz").agg(F.min(F.struct("longitude_plz", "latitude_plz")).alias("_p")) \
        .select("plz", F.col("_p.longitude_plz").alias("longitude_plz"), F.col("_p.latitude_plz").alias("latitude_plz"))
    legs = results_as_legs(results)
    j = join_sized(join_sized(legs, site_xy, "kh_key"), plz_xy, "plz")
    return j.select(
        F.col("kh_key").cast("string"), F.col("plz").cast("string"),
        F.col("fahrstrecke_km").cast("double"), F.col("fahrzeit_min").cast("double"),
        F.col("latitude_kh").cast("double"), F.col("longitude_kh").cast("double"),
        F.col("latitude_plz").cast("double"), F.col("longitude_plz").cast("double"),
        leg_relevanz(F.col("kh_key"), F.col("plz")).alias("relevanz"))


def lost_lookup_rows(results: DataFrame, sites: DataFrame, postal: DataFrame) -> DataFrame:
    """J4 check: result rows whose site or postal code has no coordinates (an error in the reference)."""
    legs = results_as_legs(results)
    held = lambda df, key: df.select(key).where(F.col(key).isNotNull()).distinct().withColumn(f"_{key}", F.lit(True))
    # both lookups in one pass over the results
    met = join_sized(join_sized(legs, held(sites, "kh_key"), "kh_key", "left"), held(postal, "plz"), "plz", "left")
    missing = F.array_compact(F.array(*[F.when(F.col(f"_{key}").isNull(), F.lit(key)) for key in ("kh_key", "plz")]))
    return met.select(*legs.columns, F.explode(missing).alias("missing"))


# ---- SCD2 -----------------------------------------------------------------------------------

def unique_legs(new: DataFrame, value_cols: list[str] = VALUE_COLUMNS) -> DataFrame:
    """One new row per (kh_key, plz): the least values, compared from the last value column (duration) to the first; nulls come last."""
    order = [x for c in reversed(value_cols) for x in (F.col(c).isNull(), F.col(c))]
    fields = [f"_{i}" for i in range(len(order))]
    best = F.min(F.struct(*[c.alias(f) for c, f in zip(order, fields, strict=True)])).alias("_best")
    out = new.groupBy("kh_key", "plz").agg(best)
    return out.select("kh_key", "plz", *[F.col(f"_best._{2 * (len(value_cols) - 1 - i) + 1}").alias(c) for i, c in enumerate(value_cols)])


def _newest_first(value_cols: list[str]) -> list[Column]:
    """Order of a pair's open rows: latest date first, rows without a date last; equal dates by their values."""
    return [F.col("gueltig_ab").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in reversed(value_cols)]]


def scd2_diff(stored: DataFrame, new: DataFrame, today: Column,
              value_cols: list[str] = VALUE_COLUMNS, whole_key: bool = False) -> DataFrame:
    """V1: actions for the keys present in ``new``.

    Open stored rows vs new rows on (kh_key, plz); several new rows of a pair count as one
    (``unique_legs``), and of several open rows the newest is compared, the others are closed.
    Output rows carry ``action``: ``close`` (stored row, gueltig_bis = today) or ``insert``
    (new row, gueltig_ab = today, open). Equal pairs produce nothing.

    ``whole_key``: when any pair of a key changes, all of its open rows are closed and all of its new
    rows inserted, so that the rows dated at the key's latest date are the key's whole coverage (V5).

    The run's new rows and the ranked open rows are written once (both are read
    twice below); closes and inserts of compared pairs come from one pass over
    the full outer join (an action array, exploded).
    """
    new_m = cut_lineage(unique_legs(new.select("kh_key", "plz", *value_cols), value_cols))
    new_keys = new_m.select("kh_key").distinct()
    open_rows = stored.filter(F.col("gueltig_bis").isNull()).join(new_keys, "kh_key", "left_semi")
    w = Window.partitionBy("kh_key", "plz").orderBy(*_newest_first(value_cols))
    ranked = cut_lineage(open_rows.select("kh_key", "plz", "gueltig_ab", *value_cols)
                         .withColumn("_rank", F.row_number().over(w)))
    latest = ranked.filter(F.col("_rank") == 1).drop("_rank")
    older = ranked.filter(F.col("_rank") > 1).drop("_rank")

    o = latest.select("kh_key", "plz", "gueltig_ab", *[F.col(c).alias("_old_" + c) for c in value_cols]).withColumn("_is_old", F.lit(True))
    n = new_m.select("kh_key", "plz", *[F.col(c).alias("_new_" + c) for c in value_cols]).withColumn("_is_new", F.lit(True))
    full = o.join(n, ["kh_key", "plz"], "full_outer")
    same = None
    for c in value_cols:
        e = F.col("_old_" + c).eqNullSafe(F.col("_new_" + c))
        same = e if same is None else same & e
    has_old, has_new = F.col("_is_old").isNotNull(), F.col("_is_new").isNotNull()
    differs = ~(has_old & has_new & same)
    if whole_key:
        changed = (full.filter(differs).select("kh_key").union(older.select("kh_key"))).distinct().withColumn("_changed", F.lit(True))
        full = join_sized(full, changed, "kh_key", "left")
        differs = F.col("_changed").isNotNull()
    close = F.when(has_old & differs, F.struct(
        F.lit("close").alias("action"), F.col("gueltig_ab").alias("gueltig_ab"), today.alias("gueltig_bis"),
        *[F.col("_old_" + c).alias(c) for c in value_cols]))
    insert = F.when(has_new & differs, F.struct(
        F.lit("insert").alias("action"), today.alias("gueltig_ab"), F.lit(None).cast("date").alias("gueltig_bis"),
        *[F.col("_new_" + c).alias(c) for c in value_cols]))
    acts = full.select("kh_key", "plz", F.explode(F.array_compact(F.array(close, insert))).alias("_a"))
    acts = acts.select("kh_key", "plz", "_a.action", "_a.gueltig_ab", "_a.gueltig_bis",
                       *[F.col("_a." + c).alias(c) for c in value_cols])
    older_closes = older.select("kh_key", "plz", F.lit("close").alias("action"), "gueltig_ab",
                                today.alias("gueltig_bis"), *value_cols)
    return acts.unionByName(older_closes)


def scd2_apply(stored: DataFrame, actions: DataFrame, value_cols: list[str] = VALUE_COLUMNS) -> DataFrame:
    """Old rows with closes applied ∪ inserted rows (then written per kh_key partition).

    A close names a stored row by all of its values. Equal stored rows are numbered, and as many of them are
    closed as there are closes, so that every close ends one row.
    """
    identity = ["kh_key", "plz", "gueltig_ab", *value_cols]
    closes = actions.filter(F.col("action") == "close").groupBy(*identity).agg(
        F.count(F.lit(1)).alias("_n"), F.max("gueltig_bis").alias("_close_date")).select(*[F.col(c).alias("_c_" + c) for c in identity], "_n", "_close_date")
    open_ = stored.filter(F.col("gueltig_bis").isNull()).withColumn(
        "_k", F.row_number().over(Window.partitionBy(*identity).orderBy(F.lit(1))))
    match = None
    for c in identity:
        e = F.col(c).eqNullSafe(F.col("_c_" + c))
        match = e if match is None else match & e
    upd = open_.join(closes, match, "left").withColumn("gueltig_bis", F.when(F.col("_k") <= F.col("_n"), F.col("_close_date")))
    ins = actions.filter(F.col("action") == "insert").drop("action")
    return (stored.filter(F.col("gueltig_bis").isNotNull()).unionByName(upd.select(*stored.columns))
            .unionByName(ins.select(*stored.columns)))


def require_lookups(results: DataFrame, sites: DataFrame, postal: DataFrame, sample: int = 10) -> None:
    """J4 as the reference applies it: raise when a result's site or postal code has no coordinates (count + a few examples)."""
    lost = lost_lookup_rows(results, sites, postal)
    n = lost.count()
    if n:
        examples = [(r.kh_key, r.plz, r.missing) for r in lost.limit(sample).collect()]
        raise ValueError(f"{n} results without coordinates, e.g. {examples}")


def store_run(stored: DataFrame, results: DataFrame, postal_points: DataFrame, today: Column, sites: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One run over the versioned table: P5 → A5 and J4 (raise) → J6 → V4 → V3 → V1 (whole keys) → V2.

    Returns the table after the run and the report of keys without distances. Keys that already have rows of today are left alone.
    Coverage is counted on rows: a repeated result of a pair is an error too. J4 needs the ``sites`` that the results were asked for.
    """
    fresh = cut_lineage(drop_processed(results, stored, today))
    check_coverage(fresh, postal_points)
    if sites is not None:
        require_lookups(fresh, sites, postal_points)
    gone = cut_lineage(invalid_key_rows(stored, results, today))
    closed = close_versions(stored, gone, today)
    after = scd2_apply(closed, scd2_diff(closed, results_as_legs(fresh), today, whole_key=True))
    return after, invalid_key_report(gone, today)


def several_open(stored: DataFrame) -> DataFrame:
    """Pairs with more than one open version (none after a run)."""
    return (stored.filter(F.col("gueltig_bis").isNull()).groupBy("kh_key", "plz").agg(F.count(F.lit(1)).alias("n_open"))
            .filter(F.col("n_open") > 1))
