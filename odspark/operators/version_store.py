"""The versioned table as partitions that are merged copy-on-write.

Layout of a store: ``data/gen=N/part=P/…`` holds the rows of a key as the N-th merge left them, ``commits/gen=N`` the keys that this merge wrote with their folders P.
A folder holds one key, or in a merge of more than MAX_FOLDERS keys a group of them, so that files follow the rows and not the keys. A merge reads
only the folders of the keys that its actions name, writes these keys as a new generation and then its commit; a reader takes the
latest committed generation of each key. So keys without actions keep their files, and a merge that is lost before its commit leaves the
old rows in sight (its data is never read, the next merge takes a new number).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odspark.operators.common import sized_side
from odspark.operators.versions import scd2_apply
from odspark.session import cut_lineage

#: folder name of the rows without a key (a key never has this text)
NO_KEY = "__none__"
#: folders that a partition filter names one by one
MAX_LISTED = 10_000
#: folders that one merge writes at most; with more keys a folder holds several
MAX_FOLDERS = 1_000


def _folders(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """(generation, written to its end) of the folders gen=N below a path, from the file system's listing."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(base)]
    return sorted((int(n[4:]), fs.exists(hadoop.Path(f"{path}/{n}/_SUCCESS"))) for n in names if n.startswith("gen="))


def _committed(spark: SparkSession, path: str) -> DataFrame:
    """(part, gen, folder): the latest committed generation of each key and its folder there."""
    done = [f"{path}/commits/gen={g}" for g, whole in _folders(spark, f"{path}/commits") if whole]
    if not done:
        return spark.createDataFrame([], "part string, gen int, folder string")
    # commits of stores from before folders held groups name the key only
    latest = spark.read.schema("part string, gen int, folder string").parquet(*done).groupBy("part").agg(F.max(F.struct("gen", "folder")).alias("l"))
    return latest.select("part", "l.gen", F.coalesce("l.folder", "part").alias("folder"))


def _key() -> Column:
    return F.coalesce("kh_key", F.lit(NO_KEY))


def _write(spark: SparkSession, path: str, rows: DataFrame, parts: DataFrame) -> int:
    gen = max([g for g, _ in _folders(spark, f"{path}/data") + _folders(spark, f"{path}/commits")], default=-1) + 1
    grouped = parts.count() > MAX_FOLDERS
    folder = lambda key: F.concat(F.lit("group-"), F.pmod(F.xxhash64(key), F.lit(MAX_FOLDERS)).cast("string")) if grouped else key
    # range partitioning on (folder, plz) splits a hot key over several writers
    (rows.withColumn("part", folder(_key())).repartitionByRange("part", "plz")
     .write.partitionBy("part").parquet(f"{path}/data/gen={gen}"))
    parts.select("part", F.lit(gen).alias("gen"), folder(F.col("part")).alias("folder")).write.parquet(f"{path}/commits/gen={gen}")
    return gen


def create_store(stored: DataFrame, path: str) -> None:
    """A new store with the rows of ``stored``."""
    stored = cut_lineage(stored)
    _write(stored.sparkSession, path, stored, stored.select(_key().alias("part")).distinct())


def read_store(spark: SparkSession, path: str, schema: T.StructType, parts: DataFrame | None = None) -> DataFrame:
    """The committed rows, of some keys (``parts``) only if given: the other folders are not read (up to MAX_LISTED folders by a partition filter)."""
    latest = _committed(spark, path)
    if parts is not None:
        latest = latest.join(parts, "part", "left_semi")
    latest, small = sized_side(latest)
    if not _folders(spark, f"{path}/data"):
        return spark.createDataFrame([], schema)
    held = spark.read.schema(T.StructType([*schema.fields, T.StructField("gen", T.IntegerType()), T.StructField("part", T.StringType())])).parquet(f"{path}/data")
    if parts is not None:
        folders = latest.select("gen", "folder").distinct()
        if folders.count() <= MAX_LISTED:
            wanted = folders.collect()
            held = held.where(F.col("part").isin(sorted({r["folder"] for r in wanted})) & F.col("gen").isin(sorted({r["gen"] for r in wanted})))
    latest = latest.select("gen", F.col("part").alias("_key"))
    held = held.withColumn("_key", _key())
    return held.join(F.broadcast(latest) if small else latest, ["gen", "_key"]).select(*schema.fieldNames())


def merge_store(spark: SparkSession, path: str, actions: DataFrame, schema: T.StructType) -> int | None:
    """V2 on the store: closes and inserts of ``actions`` applied to the partitions that they name. Gives back the new generation (None without actions)."""
    actions = cut_lineage(actions)
    parts = cut_lineage(actions.select(_key().alias("part")).distinct())
    if parts.isEmpty():
        return None
    old = read_store(spark, path, schema, parts)
    return _write(spark, path, cut_lineage(scd2_apply(old, actions)), parts)
