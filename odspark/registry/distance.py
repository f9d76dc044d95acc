"""Registered distance queries and their DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.operators import answers, pairs, points, publish, versions
from odspark.operators.common import tasks_for
from odspark.sources.fixtures import fixture, with_clause

# Run dates of the registered scenario (parameters of the jobs, yyyymmdd).
RUN_DATE = "20020101"      # run date after every stored version date
CHUNK_ROWS = 5_000         # rows of a request file in the registered jobs (several files at every scale)
KEY_LIST = ["260000003|01", "260000007|01", "260000020|01"]


def _fx(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return fixture(spark, sf, name)


def _site_pts(spark, sf):
    return points.site_points(_fx(spark, sf, "sites"))


def _postal_pts(spark, sf):
    return points.postal_points(_fx(spark, sf, "postal"))


def _requests(spark, sf):
    return pairs.request_pairs(_site_pts(spark, sf), _postal_pts(spark, sf))


def _answers(spark, sf):
    sites, postal, legs = _site_pts(spark, sf), _postal_pts(spark, sf), _fx(spark, sf, "legs")
    return answers.attach_legs(pairs.request_pairs(sites, postal), legs, tasks_for(spark, sites.count() * postal.count() + legs.count()))


def _results(spark, sf):
    return answers.answered(_answers(spark, sf))


def _new_legs(spark, sf):
    today = versions.run_date(RUN_DATE)
    res = versions.drop_processed(_results(spark, sf), _fx(spark, sf, "versions"), today)
    return versions.results_as_legs(res)


def q_site_points(spark, sf):
    """Site points ordered by key as the last step."""
    return _site_pts(spark, sf).orderBy("kh_key")


def q_site_points_keys(spark, sf):
    return points.site_points(_fx(spark, sf, "sites"), KEY_LIST)


def q_postal_points(spark, sf):
    """Postal points ordered by code as the last step."""
    return _postal_pts(spark, sf).orderBy("plz")


def q_request_pairs(spark, sf):
    return _requests(spark, sf)


def q_pair_total(spark, sf):
    return pairs.expected_pair_total(_site_pts(spark, sf), _postal_pts(spark, sf))


def q_request_chunks(spark, sf):
    return pairs.chunk_requests(_requests(spark, sf), CHUNK_ROWS).select("key1", "key2", "row_index", "chunk")


def q_answers(spark, sf):
    return _answers(spark, sf)


def q_remaining(spark, sf):
    return answers.remaining_requests(_requests(spark, sf), _results(spark, sf))


def q_resume_counts(spark, sf):
    return answers.resume_counts(_requests(spark, sf), _results(spark, sf))


def q_result_keys(spark, sf):
    return versions.result_keys(_results(spark, sf))


def q_coverage(spark, sf):
    return versions.coverage_offenders(_results(spark, sf), _postal_pts(spark, sf))


def q_pair_counts(spark, sf):
    return versions.pair_counts(_results(spark, sf))


def q_rows_per_key(spark, sf):
    return versions.rows_per_key(_results(spark, sf))


def q_drop_processed(spark, sf):
    """P5: a second run on the day after a first one stored the keys of KEY_LIST: those that it changed are left out."""
    today, stored, results = versions.run_date(RUN_DATE), _fx(spark, sf, "versions"), _results(spark, sf)
    first = versions.results_as_legs(results.filter(F.col("key1").isin(KEY_LIST)))
    return versions.drop_processed(results, versions.scd2_apply(stored, versions.scd2_diff(stored, first, today)), today)


def q_invalid_keys(spark, sf):
    return versions.invalid_key_rows(_fx(spark, sf, "versions"), _results(spark, sf), versions.run_date(RUN_DATE))


def q_invalid_keys_list(spark, sf):
    return versions.invalid_key_rows(_fx(spark, sf, "versions"), _results(spark, sf),
                                     versions.run_date(RUN_DATE), KEY_LIST)


def q_close_versions(spark, sf):
    today = versions.run_date(RUN_DATE)
    stored = _fx(spark, sf, "versions")
    return versions.close_versions(stored, versions.invalid_key_rows(stored, _results(spark, sf), today), today)


def q_invalid_report(spark, sf):
    today = versions.run_date(RUN_DATE)
    rows = versions.invalid_key_rows(_fx(spark, sf, "versions"), _results(spark, sf), today)
    return versions.invalid_key_report(rows, today)


def q_legs_record(spark, sf):
    return versions.legs_record(_results(spark, sf), _site_pts(spark, sf), _postal_pts(spark, sf))


def q_lost_lookups(spark, sf):
    """J4 check: legs of the whole leg table whose site or postal code is unknown to the lookups."""
    legs = _fx(spark, sf, "legs")
    tasks = tasks_for(spark, 2 * legs.count())
    legs = answers.best_legs(legs, tasks)
    results = answers.attach_legs(legs.select("key1", "key2"), legs, tasks)
    return versions.lost_lookup_rows(results, _site_pts(spark, sf), _postal_pts(spark, sf))


def q_scd2_diff(spark, sf):
    return versions.scd2_diff(_fx(spark, sf, "versions"), _new_legs(spark, sf), versions.run_date(RUN_DATE))


def q_scd2_apply(spark, sf):
    stored = _fx(spark, sf, "versions")
    acts = versions.scd2_diff(stored, _new_legs(spark, sf), versions.run_date(RUN_DATE))
    return versions.scd2_apply(stored, acts)


def q_latest_dates(spark, sf):
    """A2 + O3: latest open date per key, ordered by key."""
    return publish.latest_dates(_fx(spark, sf, "versions")).orderBy("kh_key")


def q_known_keys(spark, sf):
    latest = publish.latest_dates(_fx(spark, sf, "versions"))
    ok, _ = publish.known_keys(latest, _site_pts(spark, sf))
    return ok


def q_unknown_keys(spark, sf):
    latest = publish.latest_dates(_fx(spark, sf, "versions"))
    _, bad = publish.known_keys(latest, _site_pts(spark, sf))
    return bad


def q_snapshot(spark, sf):
    return publish.snapshot(_fx(spark, sf, "versions"), known=_fx(spark, sf, "sites"))


def q_snapshot_all_open(spark, sf):
    return publish.snapshot(_fx(spark, sf, "versions"), known=_fx(spark, sf, "sites"), mode="all_open")


def _written_snapshot(spark, sf):
    from odspark.sources import files
    path = files.scratch_dir(spark, "snapshot")
    publish.write_snapshot(publish.snapshot(_fx(spark, sf, "versions"), known=_fx(spark, sf, "sites")), path)
    return path


def q_snapshot_table(spark, sf):
    """S12 → S1: snapshot written partitioned by kh_key (dynamic overwrite), read back whole."""
    from odspark.sources import files
    return files.read_table(spark, _written_snapshot(spark, sf), schema=publish.SNAPSHOT_SCHEMA).select(
        "kh_key", "plz", "fahrstrecke", "fahrzeit", "fahrzone")


def q_snapshot_partition(spark, sf):
    """S12 → S2: one kh_key partition read back (partition pruning); the key is the first published one."""
    from odspark.sources import files
    path = _written_snapshot(spark, sf)
    first = files.read_table(spark, path, schema=publish.SNAPSHOT_SCHEMA).agg(F.min("kh_key")).first()[0]
    return files.read_partition(spark, path, "kh_key", first, publish.SNAPSHOT_SCHEMA).select(
        "kh_key", "plz", "fahrstrecke", "fahrzeit", "fahrzone")


def q_replace_versions(spark, sf):
    """V2 → S13 → S1: the versioned table replaced as a whole and read back."""
    from odspark.sources import files
    stored = _fx(spark, sf, "versions")
    applied = versions.scd2_apply(stored, versions.scd2_diff(stored, _new_legs(spark, sf), versions.run_date(RUN_DATE)))
    path = files.scratch_dir(spark, "versions")
    files.replace_table(applied, path)
    return files.read_table(spark, path)


def q_merge_store(spark, sf):
    """S14 + V2: the run's actions merged into a partitioned store (only the partitions that they name are read and written), read back whole."""
    from odspark.operators import version_store
    from odspark.sources import files
    stored = _fx(spark, sf, "versions")
    path = files.scratch_dir(spark, "version-store")
    version_store.create_store(stored, path)
    version_store.merge_store(spark, path, versions.scd2_diff(stored, _new_legs(spark, sf), versions.run_date(RUN_DATE)), stored.schema)
    return version_store.read_store(spark, path, stored.schema)


def q_zone_counts(spark, sf):
    """Flagship: postal codes per drive-time zone of each site, from answered legs."""
    rec = versions.legs_record(_results(spark, sf), _site_pts(spark, sf), _postal_pts(spark, sf))
    snap = rec.select("kh_key", "plz", F.col("fahrstrecke_km").alias("fahrstrecke"),
                      F.col("fahrzeit_min").alias("fahrzeit"),
                      publish.drive_zone(F.col("fahrzeit_min")).alias("fahrzone"))
    return publish.zone_counts(snap)


def _full_results(spark, sf):
    """Results for every request pair (a leg table that covers all pairs): distance from the coordinates, duration at 75 km/h."""
    one = _site_pts(spark, sf).groupBy("kh_key").agg(F.min(F.struct("longitude", "latitude")).alias("p")).select("kh_key", "p.longitude", "p.latitude")
    req = pairs.request_pairs(one, _postal_pts(spark, sf))
    km = F.round(F.abs(F.col("longitude1") - F.col("longitude2")) * 72 + F.abs(F.col("latitude1") - F.col("latitude2")) * 111, 3)
    return req.select("key1", "key2", km.alias("distance")).withColumn("duration", F.round(F.col("distance") * 0.8, 3))


def _store_run(spark, sf):
    return versions.store_run(_fx(spark, sf, "versions"), _full_results(spark, sf), _postal_pts(spark, sf), versions.run_date(RUN_DATE), _site_pts(spark, sf))


def q_store_chain(spark, sf):
    """P5 → A5 → J6 → V4 → V3 → V1 (whole keys) → V2: the versioned table after one run over every pair."""
    return _store_run(spark, sf)[0]


def q_store_snapshot(spark, sf):
    """The same run, published (V5): rows dated at each key's latest date are the key's whole coverage."""
    return publish.snapshot(_store_run(spark, sf)[0], known=_fx(spark, sf, "sites"))


def q_store_pairs(spark, sf):
    """Open versions per pair after the run, over all pairs: every count is 1."""
    after = _store_run(spark, sf)[0]
    return after.filter(F.col("gueltig_bis").isNull()).groupBy("kh_key", "plz").agg(F.count(F.lit(1)).alias("n_open"))


# ------------------------------------------------------------------------------------------
# DuckDB oracle
# ------------------------------------------------------------------------------------------

_CTE = {
    "site_typed": "SELECT kh_key, TRY_CAST(longitude AS DOUBLE) AS longitude, TRY_CAST(latitude AS DOUBLE) AS latitude,"
                  " relevanz, gueltig_bis FROM sites",
    "site_max": "SELECT kh_key, max(relevanz) AS max_relevanz FROM site_typed WHERE gueltig_bis IS NULL GROUP BY kh_key",
    "site_pts": "SELECT DISTINCT m.* FROM site_typed m JOIN site_max x ON m.kh_key = x.kh_key AND m.relevanz = x.max_relevanz"
                " WHERE m.longitude IS NOT NULL AND m.latitude IS NOT NULL AND m.gueltig_bis IS NULL",
    "postal_pts": "SELECT DISTINCT plz, TRY_CAST(longitude_plz AS DOUBLE) AS longitude_plz,"
                  " TRY_CAST(latitude_plz AS DOUBLE) AS latitude_plz FROM postal"
                  " WHERE TRY_CAST(longitude_plz AS DOUBLE) IS NOT NULL AND TRY_CAST(latitude_plz AS DOUBLE) IS NOT NULL",
    "req": "SELECT s.kh_key AS key1, s.longitude AS longitude1, s.latitude AS latitude1, p.plz AS key2,"
           " p.longitude_plz AS longitude2, p.latitude_plz AS latitude2 FROM site_pts s, postal_pts p",
    "best": "SELECT key1, key2, distance_m, duration_s FROM (SELECT *, row_number() OVER (PARTITION BY key1, key2"
            " ORDER BY duration_s, distance_m) AS rn FROM legs) t WHERE rn = 1",
    "ans": "SELECT r.*, round(b.distance_m / 1000.0, 5) AS distance, round(b.duration_s / 60.0, 5) AS duration"
           " FROM req r LEFT JOIN best b ON r.key1 = b.key1 AND r.key2 = b.key2",
    "res": "SELECT key1, key2, distance, duration FROM ans WHERE duration IS NOT NULL",
    "done_today": f"SELECT DISTINCT kh_key FROM versions WHERE gueltig_bis IS NULL AND gueltig_ab = DATE '{RUN_DATE[:4]}-{RUN_DATE[4:6]}-{RUN_DATE[6:]}'",
    "res_new": "SELECT * FROM res WHERE key1 NOT IN (SELECT kh_key FROM done_today WHERE kh_key IS NOT NULL)",
    # one new row per pair: least duration, then least distance
    "new_legs": "SELECT key1 AS kh_key, key2 AS plz, distance AS fahrstrecke_km, duration AS fahrzeit_min FROM (SELECT *,"
                " row_number() OVER (PARTITION BY key1, key2 ORDER BY duration, distance) AS rn FROM res_new) t WHERE rn = 1",
    "open_new": "SELECT * FROM versions WHERE gueltig_bis IS NULL AND kh_key IN (SELECT kh_key FROM new_legs)",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY kh_key, plz ORDER BY gueltig_ab DESC NULLS LAST, fahrzeit_min, fahrstrecke_km) AS rk FROM open_new",
    "diff_full": "SELECT COALESCE(o.kh_key, n.kh_key) AS kh_key, COALESCE(o.plz, n.plz) AS plz, o.gueltig_ab,"
                 " o.fahrstrecke_km AS old_km, o.fahrzeit_min AS old_min, n.fahrstrecke_km AS new_km,"
                 " n.fahrzeit_min AS new_min, o.kh_key IS NOT NULL AS has_old, n.kh_key IS NOT NULL AS has_new,"
                 " (o.fahrstrecke_km IS NOT DISTINCT FROM n.fahrstrecke_km AND o.fahrzeit_min IS NOT DISTINCT FROM n.fahrzeit_min) AS same"
                 " FROM (SELECT * FROM ranked WHERE rk = 1) o FULL OUTER JOIN new_legs n ON o.kh_key = n.kh_key AND o.plz = n.plz",
    "actions": "SELECT kh_key, plz, 'close' AS action, gueltig_ab, {today} AS gueltig_bis, old_km AS fahrstrecke_km,"
               " old_min AS fahrzeit_min FROM diff_full WHERE has_old AND (NOT has_new OR NOT same)"
               " UNION ALL SELECT kh_key, plz, 'insert', {today}, CAST(NULL AS DATE), new_km, new_min FROM diff_full"
               " WHERE has_new AND (NOT has_old OR NOT same)"
               " UNION ALL SELECT kh_key, plz, 'close', gueltig_ab, {today}, fahrstrecke_km, fahrzeit_min FROM ranked WHERE rk > 1",
    "invalid": "SELECT DISTINCT kh_key, gueltig_ab FROM versions WHERE gueltig_bis IS NULL AND gueltig_ab <> {today}"
               " AND kh_key IS NOT NULL AND kh_key NOT IN (SELECT key1 FROM res WHERE key1 IS NOT NULL)",
    "latest": "SELECT kh_key, max(gueltig_ab) AS max_gueltig_ab FROM versions WHERE gueltig_bis IS NULL GROUP BY kh_key",
}

_ORDER = ["site_typed", "site_max", "site_pts", "postal_pts", "req", "best", "ans", "res", "done_today", "res_new",
          "new_legs", "open_new", "ranked", "diff_full", "actions", "invalid", "latest"]
_DEPS = {
    "site_max": ["site_typed"], "site_pts": ["site_typed", "site_max"], "req": ["site_pts", "postal_pts"],
    "ans": ["req", "best"], "res": ["ans"], "res_new": ["res", "done_today"], "new_legs": ["res_new"],
    "open_new": ["new_legs"], "ranked": ["open_new"], "diff_full": ["ranked", "new_legs"],
    "actions": ["diff_full", "ranked"], "invalid": ["res"],
}
_TODAY = f"DATE '{RUN_DATE[:4]}-{RUN_DATE[4:6]}-{RUN_DATE[6:]}'"


def _closure(names):
    out = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in out:
            continue
        out.add(n)
        stack.extend(_DEPS.get(n, []))
    return out


def oracle(ctes: list[str], body: str, fixtures: tuple = ("sites", "postal", "legs", "versions")) -> str:
    need = _closure(ctes)
    parts = [f"{n} AS ({_CTE[n].format(today=_TODAY)})" for n in _ORDER if n in need]
    w = with_clause(*fixtures)
    return w.rstrip("\n") + (",\n" + ",\n".join(parts) if parts else "") + "\n" + body


def _keys_sql():
    return ", ".join(f"'{k}'" for k in KEY_LIST)


QUERIES = {
    "zone_counts": q_zone_counts,
    "p1_site_points": q_site_points,
    "p4_site_points_keys": q_site_points_keys,
    "p2_postal_points": q_postal_points,
    "j1_request_pairs": q_request_pairs,
    "a8_pair_total": q_pair_total,
    "f6_request_chunks": q_request_chunks,
    "j8_answers": q_answers,
    "j3_remaining": q_remaining,
    "a10_resume_counts": q_resume_counts,
    "a4_result_keys": q_result_keys,
    "a5_coverage": q_coverage,
    "a6_pair_counts": q_pair_counts,
    "a7_rows_per_key": q_rows_per_key,
    "p5_drop_processed": q_drop_processed,
    "j6_invalid_keys": q_invalid_keys,
    "j7_invalid_keys_list": q_invalid_keys_list,
    "v3_close_versions": q_close_versions,
    "v4_invalid_report": q_invalid_report,
    "j4_legs_record": q_legs_record,
    "j4_lost_lookups": q_lost_lookups,
    "v1_scd2_diff": q_scd2_diff,
    "v2_scd2_apply": q_scd2_apply,
    "a2_latest_dates": q_latest_dates,
    "j5_known_keys": q_known_keys,
    "j5_unknown_keys": q_unknown_keys,
    "v5_snapshot": q_snapshot,
    "v5_snapshot_all_open": q_snapshot_all_open,
    "s12_snapshot_table": q_snapshot_table,
    "s2_snapshot_partition": q_snapshot_partition,
    "s13_replace_versions": q_replace_versions,
    "s14_merge_store": q_merge_store,
    "v6_store_chain": q_store_chain,
    "v6_store_snapshot": q_store_snapshot,
    "v6_store_pairs": q_store_pairs,
}

_ZONE_SQL = ("CASE WHEN {c} < 10 THEN 1 WHEN {c} < 20 THEN 2 WHEN {c} < 30 THEN 3 WHEN {c} < 40 THEN 4"
             " WHEN {c} < 50 THEN 5 WHEN {c} < 60 THEN 6 ELSE 7 END")

_LEGS_RECORD = (
    "SELECT r.key1 AS kh_key, r.key2 AS plz, r.distance AS fahrstrecke_km, r.duration AS fahrzeit_min,"
    " s.latitude_kh, s.longitude_kh, p.latitude_plz, p.longitude_plz, r.key1 || r.key2 AS relevanz FROM res r"
    " JOIN (SELECT kh_key, arg_min(latitude, (longitude, latitude)) AS latitude_kh, min(longitude) AS longitude_kh"
    " FROM site_pts GROUP BY kh_key) s ON s.kh_key = r.key1"
    " JOIN (SELECT plz, arg_min(latitude_plz, (longitude_plz, latitude_plz)) AS latitude_plz,"
    " min(longitude_plz) AS longitude_plz FROM postal_pts GROUP BY plz) p ON p.plz = r.key2"
)

ORACLE = {
    "zone_counts": oracle(["res", "site_pts", "postal_pts"],
                          f"SELECT kh_key, {_ZONE_SQL.format(c='fahrzeit_min')} AS fahrzone, count(DISTINCT plz) AS n_plz"
                          f" FROM ({_LEGS_RECORD}) t GROUP BY 1, 2"),
    "p1_site_points": oracle(["site_pts"], "SELECT * FROM site_pts"),
    "p4_site_points_keys": oracle(["site_pts"], f"SELECT * FROM site_pts WHERE kh_key IN ({_keys_sql()})"),
    "p2_postal_points": oracle(["postal_pts"], "SELECT * FROM postal_pts"),
    "j1_request_pairs": oracle(["req"], "SELECT * FROM req"),
    "a8_pair_total": oracle(["site_pts", "postal_pts"],
                            "SELECT a.n_sites, b.n_postal, a.n_sites * b.n_postal AS n_pairs FROM"
                            " (SELECT count(*) AS n_sites FROM site_pts) a, (SELECT count(*) AS n_postal FROM postal_pts) b"),
    "f6_request_chunks": oracle(["req"], "SELECT key1, key2, row_number() OVER (ORDER BY key1, key2) - 1 AS row_index,"
                                         f" CAST(floor((row_number() OVER (ORDER BY key1, key2) - 1) / {CHUNK_ROWS}) AS BIGINT) AS chunk FROM req"),
    "j8_answers": oracle(["ans"], "SELECT * FROM ans"),
    "j3_remaining": oracle(["req", "res"], "SELECT * FROM req r WHERE NOT EXISTS (SELECT 1 FROM res x WHERE"
                                           " x.key1 IS NOT DISTINCT FROM r.key1 AND x.key2 IS NOT DISTINCT FROM r.key2)"),
    "a10_resume_counts": oracle(["req", "res"],
                                "SELECT count(*) AS total, count(x.key1) AS processed, count(*) - count(x.key1) AS remaining"
                                " FROM req r LEFT JOIN (SELECT DISTINCT key1, key2 FROM res) x"
                                " ON x.key1 IS NOT DISTINCT FROM r.key1 AND x.key2 IS NOT DISTINCT FROM r.key2"),
    "a4_result_keys": oracle(["res"], "SELECT DISTINCT key1 FROM res"),
    "a5_coverage": oracle(["res", "postal_pts"],
                          "SELECT key1, n_rows, n_expected FROM (SELECT key1, count(*) AS n_rows FROM res GROUP BY key1) a,"
                          " (SELECT count(*) AS n_expected FROM postal_pts) b WHERE n_rows <> n_expected"),
    "a6_pair_counts": oracle(["res"], "SELECT key1, key2, count(*) AS n FROM res GROUP BY 1, 2"),
    "a7_rows_per_key": oracle(["res"], "SELECT key1, count(*) AS n_rows, count(DISTINCT key2) AS n_plz FROM res GROUP BY 1"),
    "p5_drop_processed": oracle(["res", "actions"], "SELECT * FROM res WHERE key1 NOT IN (SELECT kh_key FROM actions WHERE action = 'insert'"
                                                    f" AND kh_key IN ({_keys_sql()}))"),
    "j6_invalid_keys": oracle(["invalid"], "SELECT * FROM invalid"),
    "j7_invalid_keys_list": oracle([], f"SELECT DISTINCT kh_key, gueltig_ab FROM versions WHERE gueltig_bis IS NULL"
                                       f" AND gueltig_ab <> {_TODAY} AND kh_key IN ({_keys_sql()})"),
    "v3_close_versions": oracle(["invalid"],
                                f"SELECT v.kh_key, v.plz, v.fahrstrecke_km, v.fahrzeit_min, v.gueltig_ab,"
                                f" CASE WHEN i.kh_key IS NOT NULL AND v.gueltig_bis IS NULL THEN {_TODAY} ELSE v.gueltig_bis END"
                                f" AS gueltig_bis FROM versions v LEFT JOIN invalid i ON v.kh_key = i.kh_key"
                                f" AND v.gueltig_ab = i.gueltig_ab"),
    "v4_invalid_report": oracle(["invalid"], f"SELECT DISTINCT kh_key, CAST({_TODAY} AS TIMESTAMP) AS gueltig_ab FROM invalid"),
    "j4_legs_record": oracle(["res", "site_pts", "postal_pts"], _LEGS_RECORD),
    "j4_lost_lookups": oracle(["best", "site_pts", "postal_pts"],
                              ", l AS (SELECT key1 AS kh_key, key2 AS plz, round(distance_m / 1000.0, 5) AS fahrstrecke_km,"
                              " round(duration_s / 60.0, 5) AS fahrzeit_min FROM best)"
                              " SELECT *, 'kh_key' AS missing FROM l WHERE kh_key NOT IN (SELECT kh_key FROM site_pts)"
                              " UNION ALL SELECT *, 'plz' FROM l WHERE plz NOT IN (SELECT plz FROM postal_pts)"),
    "v1_scd2_diff": oracle(["actions"], "SELECT * FROM actions"),
    # every close ends one open row with its values
    "v2_scd2_apply": oracle(["actions"],
                            "SELECT kh_key, plz, fahrstrecke_km, fahrzeit_min, gueltig_ab, gueltig_bis FROM versions WHERE gueltig_bis IS NOT NULL"
                            " UNION ALL SELECT o.kh_key, o.plz, o.fahrstrecke_km, o.fahrzeit_min, o.gueltig_ab, CASE WHEN o.k <= c.n THEN c.d END FROM"
                            " (SELECT *, row_number() OVER (PARTITION BY kh_key, plz, gueltig_ab, fahrstrecke_km, fahrzeit_min) AS k FROM versions"
                            " WHERE gueltig_bis IS NULL) o LEFT JOIN (SELECT kh_key, plz, gueltig_ab, fahrstrecke_km, fahrzeit_min, count(*) AS n,"
                            " max(gueltig_bis) AS d FROM actions WHERE action = 'close' GROUP BY 1, 2, 3, 4, 5) c ON o.kh_key IS NOT DISTINCT FROM c.kh_key"
                            " AND o.plz IS NOT DISTINCT FROM c.plz AND o.gueltig_ab IS NOT DISTINCT FROM c.gueltig_ab"
                            " AND o.fahrstrecke_km IS NOT DISTINCT FROM c.fahrstrecke_km AND o.fahrzeit_min IS NOT DISTINCT FROM c.fahrzeit_min"
                            " UNION ALL SELECT kh_key, plz, fahrstrecke_km, fahrzeit_min, gueltig_ab, gueltig_bis FROM actions"
                            " WHERE action = 'insert'"),
    "a2_latest_dates": oracle(["latest"], "SELECT * FROM latest"),
    "j5_known_keys": oracle(["latest", "site_pts"], "SELECT * FROM latest WHERE kh_key IN (SELECT kh_key FROM site_pts)"),
    "j5_unknown_keys": oracle(["latest", "site_pts"], "SELECT * FROM latest l WHERE NOT EXISTS (SELECT 1 FROM site_pts s WHERE s.kh_key = l.kh_key)"),
    "v5_snapshot": oracle(["latest"],
                          f"SELECT v.kh_key, v.plz, v.fahrstrecke_km AS fahrstrecke, v.fahrzeit_min AS fahrzeit,"
                          f" {_ZONE_SQL.format(c='v.fahrzeit_min')} AS fahrzone FROM versions v JOIN latest l"
                          f" ON v.kh_key = l.kh_key AND v.gueltig_ab = l.max_gueltig_ab"
                          f" WHERE v.gueltig_bis IS NULL AND v.kh_key IN (SELECT kh_key FROM sites)"),
    "v5_snapshot_all_open": oracle([], f"SELECT v.kh_key, v.plz, v.fahrstrecke_km AS fahrstrecke, v.fahrzeit_min AS fahrzeit,"
                                       f" {_ZONE_SQL.format(c='v.fahrzeit_min')} AS fahrzone FROM versions v"
                                       f" WHERE v.gueltig_bis IS NULL AND v.kh_key IN (SELECT kh_key FROM sites)"),
    "s12_snapshot_table": None,
    "s2_snapshot_partition": None,
}

ORACLE["s12_snapshot_table"] = ORACLE["v5_snapshot"]
ORACLE["s2_snapshot_partition"] = ("SELECT * FROM (" + ORACLE["v5_snapshot"].replace("\n", " ") + ") s"
                                   " WHERE kh_key = (SELECT min(kh_key) FROM (" + ORACLE["v5_snapshot"].replace("\n", " ")
                                   + ") t)")
ORACLE["s13_replace_versions"] = ORACLE["v2_scd2_apply"]
ORACLE["s14_merge_store"] = ORACLE["v2_scd2_apply"]

# The store run by its rules: keys of the run that change at all are closed and written anew; keys without results are closed;
# keys processed today are left alone.
_STORE = (
    ", one AS (SELECT kh_key, arg_min(latitude, (longitude, latitude)) AS latitude, min(longitude) AS longitude FROM site_pts GROUP BY kh_key),"
    " full_res AS (SELECT kh_key, plz, km AS fahrstrecke_km, round(km * 0.8, 3) AS fahrzeit_min FROM (SELECT kh_key, plz,"
    " round(abs(longitude - longitude_plz) * 72 + abs(latitude - latitude_plz) * 111, 3) AS km FROM one, postal_pts) t),"
    " fresh AS (SELECT * FROM full_res WHERE kh_key NOT IN (SELECT kh_key FROM done_today)),"
    " gone AS (SELECT DISTINCT kh_key, gueltig_ab FROM versions WHERE gueltig_bis IS NULL AND gueltig_ab <> {today}"
    " AND kh_key NOT IN (SELECT kh_key FROM full_res)),"
    " open_key AS (SELECT v.* FROM versions v WHERE gueltig_bis IS NULL AND kh_key IN (SELECT kh_key FROM fresh)),"
    " same_key AS (SELECT kh_key FROM (SELECT kh_key, plz, fahrstrecke_km, fahrzeit_min, 1 AS side FROM open_key UNION ALL"
    " SELECT kh_key, plz, fahrstrecke_km, fahrzeit_min, 2 FROM fresh) u GROUP BY kh_key, plz HAVING count(*) <> 2 OR min(side) = max(side)"
    " OR min(fahrstrecke_km) <> max(fahrstrecke_km) OR min(fahrzeit_min) <> max(fahrzeit_min)),"
    " after_run AS (SELECT v.kh_key, v.plz, v.fahrstrecke_km, v.fahrzeit_min, v.gueltig_ab, CASE WHEN v.gueltig_bis IS NULL AND"
    " (v.kh_key IN (SELECT kh_key FROM same_key) OR EXISTS (SELECT 1 FROM gone g WHERE g.kh_key = v.kh_key AND g.gueltig_ab = v.gueltig_ab))"
    " THEN {today} ELSE v.gueltig_bis END AS gueltig_bis FROM versions v"
    " UNION ALL SELECT kh_key, plz, fahrstrecke_km, fahrzeit_min, {today}, CAST(NULL AS DATE) FROM fresh WHERE kh_key IN (SELECT kh_key FROM same_key)) "
).replace("{today}", _TODAY)
_STORE_CTES = ["site_pts", "postal_pts", "done_today"]
ORACLE["v6_store_chain"] = oracle(_STORE_CTES, _STORE + "SELECT * FROM after_run")
ORACLE["v6_store_snapshot"] = oracle(
    _STORE_CTES, _STORE + f"SELECT a.kh_key, a.plz, a.fahrstrecke_km AS fahrstrecke, a.fahrzeit_min AS fahrzeit, {_ZONE_SQL.format(c='a.fahrzeit_min')} AS fahrzone"
    " FROM after_run a JOIN (SELECT kh_key, max(gueltig_ab) AS d FROM after_run WHERE gueltig_bis IS NULL GROUP BY 1) l ON a.kh_key = l.kh_key"
    " AND a.gueltig_ab = l.d WHERE a.gueltig_bis IS NULL AND a.kh_key IN (SELECT kh_key FROM sites)")
ORACLE["v6_store_pairs"] = oracle(_STORE_CTES, _STORE + "SELECT kh_key, plz, count(*) AS n_open FROM after_run WHERE gueltig_bis IS NULL GROUP BY 1, 2")
