"""Invariants of the distance jobs."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from odspark.operators import answers, pairs, points, publish, versions
from odspark.registry import distance as D
from odspark.sources import files


def test_pairs_count_both_paths(spark):
    s = points.site_points(D._fx(spark, SF01, "sites"))
    p = points.postal_points(D._fx(spark, SF01, "postal"))
    n1, n2 = s.count(), p.count()
    assert pairs.request_pairs(s, p).count() == n1 * n2
    # beyond the broadcast bound: bucketed equi-join, still every pair exactly once
    left = s.select(F.col("kh_key").alias("key1"))
    right = p.select(F.col("plz").alias("key2"))
    bucketed = pairs.all_pairs(left, right, rows_per_task=100)
    assert bucketed.count() == n1 * n2
    assert bucketed.distinct().count() == left.distinct().count() * right.distinct().count()


def test_row_index_dense_and_ordered(spark):
    req = D._requests(spark, SF01)
    idx = pairs.with_row_index(req, ["key1", "key2"]).select("key1", "key2", "row_index")
    w = Window.orderBy("key1", "key2")
    ref = req.select("key1", "key2", (F.row_number().over(w) - 1).alias("row_index"))
    assert idx.exceptAll(ref).count() == 0 and ref.exceptAll(idx).count() == 0


def test_resume_split(spark):
    req = D._requests(spark, SF01)
    res = D._results(spark, SF01)
    remaining = answers.remaining_requests(req, res)
    done = req.join(res.select("key1", "key2").distinct(), ["key1", "key2"], "left_semi")
    assert remaining.count() + done.count() == req.count()
    c = answers.resume_counts(req, res).first()
    assert c.total == req.count() and c.remaining == remaining.count()


def test_null_keys_match_on_resume(spark):
    req = spark.createDataFrame([("a", None), ("b", "x")], "key1 string, key2 string")
    res = spark.createDataFrame([("a", None, 1.0, 1.0)], "key1 string, key2 string, distance double, duration double")
    assert [r.key1 for r in answers.remaining_requests(req, res).collect()] == ["b"]


def test_scd2_one_open_version_per_pair(spark):
    stored = D._fx(spark, SF01, "versions")
    new = D._new_legs(spark, SF01)
    today = versions.run_date(D.RUN_DATE)
    applied = versions.scd2_apply(stored, versions.scd2_diff(stored, new, today))
    # every pair of a key in the run has at most one open version, and exactly one if the run delivers it
    keys = new.select("kh_key").distinct()
    assert versions.several_open(applied.join(keys, "kh_key", "left_semi")).count() == 0
    open_rows = applied.filter(F.col("gueltig_bis").isNull())
    assert new.select("kh_key", "plz").distinct().join(open_rows, ["kh_key", "plz"], "left_anti").count() == 0
    # a second run with the same rows changes nothing
    again = versions.scd2_diff(applied, new, today)
    assert again.filter("action = 'insert'").count() == 0


def test_snapshot_dynamic_overwrite(spark):
    snap = publish.snapshot(D._fx(spark, SF01, "versions"))
    path = files.scratch_dir(spark, "snapshot")
    publish.write_snapshot(snap, path)
    keys = [r.kh_key for r in snap.select("kh_key").distinct().limit(2).collect()]
    one = snap.filter(F.col("kh_key") == keys[0]).limit(3)
    publish.write_snapshot(one, path)
    back = spark.read.parquet(path)
    assert back.filter(F.col("kh_key") == keys[0]).count() == 3
    assert back.filter(F.col("kh_key") == keys[1]).count() == snap.filter(F.col("kh_key") == keys[1]).count()


def test_request_files_roundtrip(spark):
    req = D._requests(spark, SF01)
    chunked = pairs.chunk_requests(req, 20_000)
    folder = files.scratch_dir(spark, "req")
    files.write_requests(chunked, folder)
    back = files.read_requests(spark, folder)
    names = sorted(r.file_name for r in back.select("file_name").distinct().collect())
    assert names[0] == "coordination_items_0000000000.csv" and len(names) == -(-req.count() // 20_000)
    assert back.count() == req.count()


V = "kh_key string, plz string, fahrstrecke_km double, fahrzeit_min double, gueltig_ab date, gueltig_bis date"


def _run(spark, stored, new, whole_key=False):
    """Rows after a run of 2024: (key, code, km, year from, year to); 0 for no date."""
    import datetime
    d = lambda y: datetime.date(y, 1, 1) if y else None
    frame = spark.createDataFrame([(k, p, km, m, d(a), d(b)) for k, p, km, m, a, b in stored], V)
    legs = spark.createDataFrame(new, "kh_key string, plz string, fahrstrecke_km double, fahrzeit_min double")
    after = versions.scd2_apply(frame, versions.scd2_diff(frame, legs, versions.run_date("20240101"), whole_key=whole_key))
    return sorted((r.kh_key, r.plz, r.fahrstrecke_km, r.gueltig_ab.year if r.gueltig_ab else 0, r.gueltig_bis.year if r.gueltig_bis else 0) for r in after.collect())


def test_scd2_ties_and_missing_dates(spark):
    two = [("k", "1", 5.0, 5.0, 2020, None), ("k", "1", 7.0, 7.0, 2020, None)]
    # equal to the row that is compared (least duration of the date): that one stays open, the other ends
    assert _run(spark, two, [("k", "1", 5.0, 5.0)]) == [("k", "1", 5.0, 2020, 0), ("k", "1", 7.0, 2020, 2024)]
    # different: both end, one new version; two stored rows stay two
    assert _run(spark, two, [("k", "1", 6.0, 6.0)]) == [("k", "1", 5.0, 2020, 2024), ("k", "1", 6.0, 2024, 0), ("k", "1", 7.0, 2020, 2024)]
    # wholly equal stored rows: one stays
    assert _run(spark, [two[0], two[0]], [("k", "1", 5.0, 5.0)]) == [("k", "1", 5.0, 2020, 0), ("k", "1", 5.0, 2020, 2024)]
    # no date: still an old row
    assert _run(spark, [("k", "1", 5.0, 5.0, None, None)], [("k", "1", 6.0, 6.0)]) == [("k", "1", 5.0, 0, 2024), ("k", "1", 6.0, 2024, 0)]
    # several new rows of a pair count as one: the shortest
    assert _run(spark, [("k", "2", 1.0, 1.0, 2020, None)], [("k", "1", 9.0, 9.0), ("k", "1", 3.0, 3.0), ("k", "1", 3.0, 3.0), ("k", "2", 1.0, 1.0)]) == [
        ("k", "1", 3.0, 2024, 0), ("k", "2", 1.0, 2020, 0)]


def test_whole_key_diff(spark):
    stored = [("k", "1", 1.0, 1.0, 2020, None), ("k", "2", 2.0, 2.0, 2020, None), ("m", "1", 1.0, 1.0, 2020, None)]
    new = [("k", "1", 1.0, 1.0), ("k", "2", 2.5, 2.5), ("m", "1", 1.0, 1.0)]
    assert _run(spark, stored, new, whole_key=True) == [("k", "1", 1.0, 2020, 2024), ("k", "1", 1.0, 2024, 0), ("k", "2", 2.0, 2020, 2024), ("k", "2", 2.5, 2024, 0),
                                                        ("m", "1", 1.0, 2020, 0)]


def test_store_run_refuses_partial_coverage(spark):
    import pytest
    stored = D._fx(spark, SF01, "versions")
    with pytest.raises(ValueError, match="without full postal coverage"):
        versions.store_run(stored, D._results(spark, SF01), D._postal_pts(spark, SF01), versions.run_date(D.RUN_DATE))


def test_zone_counts_never_exceed_the_postal_codes(spark):
    n = points.postal_points(D._fx(spark, SF01, "postal")).select("plz").distinct().count()
    assert D.q_zone_counts(spark, SF01).groupBy("kh_key").agg(F.sum("n_plz").alias("n")).agg(F.max("n")).first()[0] <= n


def test_request_pairs_are_built_in_many_tasks(spark):
    left = spark.range(400).withColumnRenamed("id", "a").coalesce(1)
    right = spark.range(500).withColumnRenamed("id", "b").coalesce(1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        product = pairs.all_pairs(left, right, rows_per_task=10_000)
        assert product.rdd.getNumPartitions() == 20 and product.distinct().count() == 200_000
        assert product.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 40_000
        cut = pairs.all_pairs(left, right, rows_per_task=100)      # the right side in pieces too
        assert cut.distinct().count() == 200_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_reset_removes_earlier_request_files(spark):
    req = D._requests(spark, SF01)
    folder = files.scratch_dir(spark, "requests")
    files.write_requests(pairs.chunk_requests(req, 20_000), folder, if_exists="delete")
    files.write_requests(pairs.chunk_requests(req.limit(100), 20_000), folder, if_exists="delete")
    assert files.read_requests(spark, folder).count() == 100


def test_no_result_file_is_an_error(spark):
    import pytest
    folder = files.scratch_dir(spark, "requests")
    files.write_requests(pairs.chunk_requests(D._requests(spark, SF01).limit(10), 5), folder)
    with pytest.raises(FileNotFoundError):
        files.read_results(spark, folder)


def test_archive_name(spark):
    one = spark.createDataFrame([("coordination_items_0000000003.csv",)], "file_name string")
    assert one.select(files.archive_file_name(stamp="20240101")).first()[0] == "coordination_items_0000000003_20240101_done.csv"


def test_checkpoint_folder_is_required_off_local():
    import types

    import pytest
    from odspark import session
    conf = types.SimpleNamespace(get=lambda *a: None)
    sc = types.SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn", setCheckpointDir=lambda x: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(types.SimpleNamespace(sparkContext=sc, conf=conf))


def test_written_snapshot_without_rows_is_read_as_no_rows(spark, monkeypatch):
    # no published key: the open version belongs to no site
    tables = {"versions": spark.createDataFrame([("k", "1", 1.0, 1.0, None, None)], "kh_key string, plz string, fahrstrecke_km double, fahrzeit_min double, gueltig_ab date, gueltig_bis date"),
              "sites": spark.createDataFrame([("other",)], "kh_key string")}
    monkeypatch.setattr(D, "_fx", lambda spark, sf, name: tables[name])
    columns = ["kh_key", "plz", "fahrstrecke", "fahrzeit", "fahrzone"]
    for q in (D.q_snapshot_table, D.q_snapshot_partition):
        got = q(spark, "none")
        assert got.columns == columns and got.count() == 0


def test_written_snapshot_keeps_the_text_of_its_keys(spark, monkeypatch):
    import datetime
    day = datetime.date(2020, 1, 1)
    tables = {"versions": spark.createDataFrame([("0123", "1", 1.0, 1.0, day, None)], "kh_key string, plz string, fahrstrecke_km double, fahrzeit_min double, gueltig_ab date, gueltig_bis date"),
              "sites": spark.createDataFrame([("0123",)], "kh_key string")}
    monkeypatch.setattr(D, "_fx", lambda spark, sf, name: tables[name])
    for q in (D.q_snapshot_table, D.q_snapshot_partition):
        assert [tuple(r) for r in q(spark, "none").collect()] == [("0123", "1", 1.0, 1.0, 1)]
