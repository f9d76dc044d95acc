"""Request folder stream: every file once, several micro-batches, one log row per file."""

from pyspark.sql import functions as F

from conftest import SF001
from odspark.operators import pairs
from odspark.registry import distance as D
from odspark.sources import files
from odspark.streaming import requests as R


def test_stream_processes_each_file_once(spark):
    req = D._requests(spark, SF001)
    folder = files.scratch_dir(spark, "req")
    files.write_requests(pairs.chunk_requests(req, 1000), folder)
    n_files = -(-req.count() // 1000)
    out_dir, log_dir, ckpt = (files.scratch_dir(spark, x) for x in ("res", "log", "ckpt"))
    stream = R.request_stream(spark, folder, max_files=2)
    R.answer_batches(stream, D._fx(spark, SF001, "legs"), out_dir, log_dir, ckpt, folder).awaitTermination()
    log = spark.read.parquet(log_dir)
    assert log.select("file_name").distinct().count() == n_files == log.count()
    assert log.select("batch_id").distinct().count() >= n_files // 2
    assert log.agg(F.sum("rows")).first()[0] == req.count()
    # a second run over the same folder and checkpoint finds nothing new
    R.answer_batches(R.request_stream(spark, folder, max_files=2),
                     D._fx(spark, SF001, "legs"), out_dir, log_dir, ckpt, folder).awaitTermination()
    assert spark.read.parquet(log_dir).count() == n_files
    results = files.read_results(spark, out_dir)
    assert results.count() == D._results(spark, SF001).count()
    assert R.run_summary(spark, log_dir).agg(F.sum("files")).first()[0] == n_files


def test_stream_archives_consumed_files(spark):
    import glob
    import os

    req = D._requests(spark, SF001)
    folder = files.scratch_dir(spark, "req")
    files.write_requests(pairs.chunk_requests(req, 150), folder)
    archive, out_dir, log_dir, ckpt = (files.scratch_dir(spark, x) for x in ("arch", "res", "log", "ckpt"))
    def local(x):
        return x[len("file:"):] if x.startswith("file:") else x
    before = sorted(glob.glob(f"{local(folder)}/*/*.csv"))
    R.answer_batches(R.request_stream(spark, folder, max_files=1), D._fx(spark, SF001, "legs"), out_dir, log_dir, ckpt, folder, archive, "20020101").awaitTermination()
    moved = sorted(os.listdir(local(archive)))
    assert len(before) >= 3 and moved == [f"coordination_items_{k:010d}_20020101_done.csv" for k in range(len(before))]
    assert not glob.glob(f"{local(folder)}/*/*.csv")


def test_a_file_in_several_parts_is_closed_once(spark):
    req = pairs.chunk_requests(D._requests(spark, SF001).limit(12), 6)
    folder, archive, out_dir, log_dir, ckpt = (files.scratch_dir(spark, x) for x in ("req", "arch", "res", "log", "ckpt"))
    files.write_requests(req.filter("row_index % 2 = 0"), folder, if_exists="delete")
    files.write_requests(req.filter("row_index % 2 = 1"), folder, if_exists="append")
    legs = req.select("key1", "key2").distinct().withColumn("distance_m", F.lit(1000.0)).withColumn("duration_s", F.lit(60.0))
    # a run that dies after its first batch is taken up again by the next
    R.answer_batches(R.request_stream(spark, folder, max_files=1), legs, out_dir, log_dir, ckpt, folder, archive).awaitTermination()
    log = spark.read.parquet(log_dir).collect()
    assert sorted((r.file_name, r.parts, r.rows, r.answered, r.status) for r in log) == [
        (f"coordination_items_{k:010d}.csv", 2, 6, 6, "done") for k in range(2)]
    assert files.read_results(spark, out_dir).count() == 12
    assert [tuple(r) for r in R.run_summary(spark, log_dir).collect()] == [("done", 2)]


def test_a_file_with_a_part_to_come_stays_open(spark):
    out_dir, log_dir = (files.scratch_dir(spark, x) for x in ("res", "log"))
    rows = D._requests(spark, SF001).limit(4).withColumn("file_name", F.lit("coordination_items_0000000000.csv"))
    spark.createDataFrame([("coordination_items_0000000000.csv", p) for p in ("a", "b")], R.MANIFEST).write.parquet(log_dir + "-manifest")
    from odspark.operators.answers import best_legs
    best = best_legs(D._fx(spark, SF001, "legs"))
    assert R.write_batch(rows.withColumn("part", F.lit("a")), 0, best, out_dir, log_dir) == []
    closed = R.write_batch(rows.withColumn("part", F.lit("b")), 1, best, out_dir, log_dir)
    assert [(r.parts, r.rows) for r in closed] == [(2, 8)]


def test_repeated_batch_leaves_one_result(spark):
    req = D._requests(spark, SF001).limit(50).withColumn("file_name", F.lit("coordination_items_0000000000.csv")).withColumn("part", F.lit("one"))
    out_dir, log_dir = (files.scratch_dir(spark, x) for x in ("res", "log"))
    req.select("file_name", "part").distinct().write.parquet(log_dir + "-manifest")
    legs = D._fx(spark, SF001, "legs")
    from odspark.operators.answers import best_legs
    for _ in range(2):
        R.write_batch(req, 7, best_legs(legs), out_dir, log_dir)
    assert spark.read.parquet(log_dir).count() == 1
    from odspark.operators.answers import answered, attach_legs
    assert files.read_results(spark, out_dir).count() == answered(attach_legs(req, legs)).count()


def test_a_batch_closes_files_of_several_log_folders(spark):
    names = [f"coordination_items_{k:010d}.csv" for k in range(12)]
    rows = spark.createDataFrame([(f"k{i}" if i % 4 else None, float(i), 1.0, "p", 1.0, 1.0, n, "one") for i, n in enumerate(names)],
                                 "key1 string, longitude1 double, latitude1 double, key2 string, longitude2 double, latitude2 double, file_name string, part string")
    best = spark.createDataFrame([(f"k{i}", "p", 1000.0, 60.0) for i in range(0, 40, 2)], "key1 string, key2 string, distance_m double, duration_s double")
    out_dir, log_dir = (files.scratch_dir(spark, x) for x in ("res", "log"))
    spark.createDataFrame([(n, "one") for n in names] + [("coordination_items_0000000099.csv", "one")], R.MANIFEST).write.parquet(log_dir + "-manifest")
    closed = R.write_batch(rows, 0, best, out_dir, log_dir)
    assert sorted((r.file_name, r.rows, r.answered, r.status) for r in closed) == [
        (n, 1, int(i % 4 == 2), "done" if i % 4 == 2 else "error") for i, n in enumerate(names)]
    assert sorted(r.key1 for r in files.read_results(spark, out_dir).collect()) == ["k10", "k2", "k6"]
    assert sorted(tuple(r) for r in R.run_summary(spark, log_dir).collect()) == [("done", 3), ("error", 9), ("open", 1)]


def test_a_batch_takes_tasks_and_legs_by_its_own_size(spark):
    path = files.scratch_dir(spark, "legs")
    spark.createDataFrame([(f"k{i}", "p", 1.0, 1.0) for i in range(9)], "key1 string, key2 string, distance_m double, duration_s double").write.parquet(path)
    rows = spark.createDataFrame([("k3", "p", "f", "one"), ("k4", "q", "f", "two")], "key1 string, key2 string, file_name string, part string")
    parts = [{"rows": 1, "least": "k3", "greatest": "k3"}, {"rows": 1, "least": "k4", "greatest": "k4"}]
    got = R._answers(rows, spark.read.parquet(path), parts)
    assert got.rdd.getNumPartitions() == 2
    assert "GreaterThanOrEqual(key1,k3), LessThanOrEqual(key1,k4)" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.key1, r.duration) for r in got.where("duration IS NOT NULL").collect()) == [("k3", round(1 / 60, 5))]


def _rows_of(spark, *files_and_parts):
    rows = [(f"k{i}", float(i), 1.0, "p", 1.0, 1.0, *fp) for i, fp in enumerate(files_and_parts)]
    return spark.createDataFrame(rows, "key1 string, longitude1 double, latitude1 double, key2 string, longitude2 double, latitude2 double, file_name string, part string")


def _legs(spark, n=40):
    return spark.createDataFrame([(f"k{i}", "p", 1000.0, 60.0) for i in range(0, n, 2)], "key1 string, key2 string, distance_m double, duration_s double")


def test_streams_side_by_side_read_every_file_once(spark, tmp_path):
    names = [f"coordination_items_{k:010d}.csv" for k in range(12)] + ["other.csv", "v.csv", "x7b.csv"]
    folder = tmp_path / "req"
    folder.mkdir()
    for i, n in enumerate(names):
        (folder / n).write_text(f"key1;longitude1;latitude1;key2;longitude2;latitude2\nk{i};1.0;1.0;p;1.0;1.0\n")
    out_dir, log_dir, ckpt, archive = (files.scratch_dir(spark, x) for x in ("res", "log", "ckpt", "arch"))
    for _ in range(2):  # the second run finds nothing new
        streams = R.request_streams(spark, f"file:{folder}", max_files=1)
        assert len(streams) == R.STREAMS
        R.answer_batches(streams, _legs(spark), out_dir, log_dir, ckpt, f"file:{folder}", archive).awaitTermination()
    log = spark.read.parquet(log_dir).collect()
    assert sorted((r.file_name, r.parts, r.rows, r.status) for r in log) == sorted((n, 1, 1, "error" if i % 2 else "done") for i, n in enumerate(names))
    assert len({r.batch_id for r in log}) == len(names) and not list(folder.glob("*.csv"))
    assert spark.read.option("header", True).option("sep", ";").csv(out_dir).count() == 8


def test_a_batch_takes_few_jobs(spark, monkeypatch):
    names = [f"coordination_items_{k:010d}.csv" for k in range(2)]
    out_dir, log_dir = (files.scratch_dir(spark, x) for x in ("res", "log"))
    spark.createDataFrame([(n, p) for n in names for p in ("a", "b")], R.MANIFEST).write.parquet(log_dir + "-manifest")
    monkeypatch.setattr(R, "LEGS_PER_FILE", 5)
    best, known = R.LegFiles(_legs(spark)), R.OpenFiles(spark, log_dir, False)
    near, n = best.near(spark, [("k0", "k10"), ("k38", "k38")])
    assert len(best.files) == 4 and n <= 15 and {r.key1 for r in near.collect()} == {"k0", "k10", "k38"}
    batch = _rows_of(spark, *[(n, "a") for n in names])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.sparkContext.setJobGroup("few", "few")
        assert R.write_batch(batch, 0, best, out_dir, log_dir, known) == []
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few")) <= 3
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.adaptive.enabled")
    # a run that takes this one up knows its parts; a part that comes after the file was closed is added to it
    known = R.OpenFiles(spark, log_dir, True)
    closed = R.write_batch(_rows_of(spark, *[(n, "b") for n in names]), 1, best, out_dir, log_dir, known)
    assert [(r.file_name, r.parts, r.rows, r.answered, r.status) for r in closed] == [(names[0], 2, 2, 2, "done"), (names[1], 2, 2, 0, "error")] and known.parts == {}
    monkeypatch.setattr(R, "COUNTED_PARTS", 0)
    closed = R.write_batch(_rows_of(spark, (names[0], "c")), 2, best, out_dir, log_dir, known)
    assert [(r.file_name, r.parts, r.rows, r.answered, r.archive_name) for r in closed] == [(names[0], 3, 3, 3, "coordination_items_0000000000_done.csv")]
    assert sorted((r.file_name, r.parts) for r in spark.read.parquet(log_dir).collect()) == [(names[0], 3), (names[1], 2)]
