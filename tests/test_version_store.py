"""Copy-on-write merges of the versioned table."""

import glob
import os

from pyspark.sql import functions as F

from odspark.operators import version_store as VS
from odspark.operators import versions
from odspark.sources import files

STORED = "kh_key string, plz string, fahrstrecke_km double, fahrzeit_min double, gueltig_ab date, gueltig_bis date"


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def _actions(spark, stored, keys, km):
    new = spark.createDataFrame([(k, p, km, 1.0) for k in keys for p in ("1", "2")], "kh_key string, plz string, fahrstrecke_km double, fahrzeit_min double")
    return versions.scd2_diff(stored, new, versions.run_date("20240101"))


def _store(spark):
    stored = spark.createDataFrame([(k, p, 1.0, 1.0, None, None) for k in ("a", "b", "c/d", None) for p in ("1", "2")], STORED) \
        .withColumn("gueltig_ab", F.lit("2020-01-01").cast("date"))
    path = files.scratch_dir(spark, "store")
    VS.create_store(stored, path)
    return stored, path


def test_a_merge_touches_only_the_named_partitions(spark):
    stored, path = _store(spark)
    assert _rows(VS.read_store(spark, path, stored.schema)) == _rows(stored)
    acts = _actions(spark, stored, ["a", "new"], 2.0)
    before = sorted(glob.glob(f"{_local(path)}/data/gen=0/*/*.parquet"))
    assert VS.merge_store(spark, path, acts, stored.schema) == 1
    assert sorted(glob.glob(f"{_local(path)}/data/gen=0/*/*.parquet")) == before
    assert sorted(os.path.basename(p) for p in glob.glob(f"{_local(path)}/data/gen=1/part=*")) == ["part=a", "part=new"]
    assert _rows(VS.read_store(spark, path, stored.schema)) == _rows(versions.scd2_apply(stored, acts))
    # without actions nothing is written
    assert VS.merge_store(spark, path, acts.limit(0), stored.schema) is None


def test_reads_of_a_merge_are_pruned(spark):
    stored, path = _store(spark)
    some = spark.createDataFrame([("a",)], "part string")
    plan = VS.read_store(spark, path, stored.schema, some)._jdf.queryExecution().toString()
    filters = [x for x in plan.splitlines() if "PartitionFilters" in x]
    assert filters and all("part#" in x and "gen#" in x for x in filters)
    assert VS.read_store(spark, path, stored.schema, some).select("kh_key").distinct().collect()[0][0] == "a"


def test_a_lost_merge_leaves_the_old_rows(spark):
    stored, path = _store(spark)
    # data of a merge that never reached its commit, and a commit that was not finished
    stored.where("kh_key = 'a'").withColumn("fahrzeit_min", F.lit(9.0)).withColumn("part", F.col("kh_key")).write.partitionBy("part").parquet(f"{path}/data/gen=1")
    spark.createDataFrame([("a", 1)], "part string, gen int").write.parquet(f"{path}/commits/gen=1")
    os.remove(f"{_local(path)}/commits/gen=1/_SUCCESS")
    assert _rows(VS.read_store(spark, path, stored.schema)) == _rows(stored)
    assert VS.merge_store(spark, path, _actions(spark, stored, ["b"], 3.0), stored.schema) == 2


def test_a_merge_of_many_keys_writes_few_folders(spark, monkeypatch):
    """Files follow the rows: many keys share folders, and a later merge reads and writes its own keys alone."""
    monkeypatch.setattr(VS, "MAX_FOLDERS", 4)
    stored, path = _store(spark)
    many = _actions(spark, stored, ["a", "c/d", *(f"k{i}" for i in range(30))], 2.0)
    assert VS.merge_store(spark, path, many, stored.schema) == 1
    assert len(glob.glob(f"{_local(path)}/data/gen=1/part=*")) <= 4
    after = versions.scd2_apply(stored, many)
    assert _rows(VS.read_store(spark, path, stored.schema)) == _rows(after)
    few = _actions(spark, VS.read_store(spark, path, stored.schema), ["k3", "b"], 5.0)
    after = versions.scd2_apply(after, few)
    assert VS.merge_store(spark, path, few, stored.schema) == 2
    assert sorted(os.path.basename(p) for p in glob.glob(f"{_local(path)}/data/gen=2/part=*")) == ["part=b", "part=k3"]
    assert _rows(VS.read_store(spark, path, stored.schema)) == _rows(after)
