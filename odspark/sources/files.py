"""Request / result CSV files and table reads.

Files are ``;``-separated with a header. Request files carry the rows of one
chunk; Spark writes each chunk into its own partition folder named after the
reference file name (``file_name=coordination_items_0000000000.csv/``), so
the file name is data (partition column) instead of a driver-side loop.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odspark.session import ensure_checkpoint_dir

REQUEST_SCHEMA = T.StructType([
    T.StructField("key1", T.StringType()), T.StructField("longitude1", T.DoubleType()),
    T.StructField("latitude1", T.DoubleType()), T.StructField("key2", T.StringType()),
    T.StructField("longitude2", T.DoubleType()), T.StructField("latitude2", T.DoubleType()),
])
# file column order is key1;key2;distance;duration (bound by name on read)
RESULT_SCHEMA = T.StructType([
    T.StructField("key1", T.StringType()), T.StructField("key2", T.StringType()),
    T.StructField("distance", T.DoubleType()), T.StructField("duration", T.DoubleType()),
])
REQUEST_PREFIX = "coordination_items_"
RESULT_PREFIX = "results_items_"
CSV = {"sep": ";", "header": "true"}


def scratch_dir(spark: SparkSession, name: str = "files") -> str:
    """A fresh folder inside the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


# ---- reads --------------------------------------------------------------------------------------

def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """Full table read. With its schema a table without files is read as no rows, and partition values keep their type."""
    reader = spark.read.format(fmt)
    return (reader if schema is None else reader.schema(schema)).load(path)


def read_partition(spark: SparkSession, path: str, key: str, value, schema: T.StructType | str | None = None) -> DataFrame:
    """One partition of a ``partitionBy(key)`` table (partition pruning)."""
    return read_table(spark, path, schema=schema).where(F.col(key) == F.lit(value))


def read_sql(spark: SparkSession, sql: str) -> DataFrame:
    """S3: read by SQL text over registered views."""
    return spark.sql(sql)


def read_requests(spark: SparkSession, folder: str) -> DataFrame:
    """S4 + S10: typed request rows of every request file under ``folder`` with their file name."""
    schema = T.StructType(REQUEST_SCHEMA.fields + [T.StructField("file_name", T.StringType())])
    df = spark.read.options(**CSV).schema(schema).csv(folder)
    return df.filter(F.lower(F.col("file_name")).startswith(REQUEST_PREFIX.lower()))


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """S5 + S10: typed result rows of every result file (one or many) under ``folder``; no result file is an error."""
    schema = T.StructType(RESULT_SCHEMA.fields + [T.StructField("file_name", T.StringType())])
    df = spark.read.options(**CSV).schema(schema).csv(folder).filter(F.col("file_name").startswith(RESULT_PREFIX)).drop("part")
    if not any(f"file_name={RESULT_PREFIX}" in f for f in df.inputFiles()):
        raise FileNotFoundError(f"no result file in {folder}")
    return df


# ---- writes -------------------------------------------------------------------------------------

def request_file_name(chunk_col: str = "chunk"):
    """Zero-padded request file name of a chunk."""
    return F.format_string(REQUEST_PREFIX + "%010d.csv", F.col(chunk_col))


def result_file_name(request_name_col: str = "file_name"):
    """Result file name from the request file name (index kept)."""
    return F.regexp_replace(F.col(request_name_col), "^" + REQUEST_PREFIX, RESULT_PREFIX)


def archive_file_name(input_name_col: str = "file_name", stamp=""):
    """Name of a finished request file in the archive: the input name with a stamp (text or column) before its ending."""
    stamp = F.lit(stamp) if isinstance(stamp, str) else stamp
    return F.concat(F.regexp_replace(F.col(input_name_col), r"\.csv$", ""), F.when(stamp != "", F.concat(F.lit("_"), stamp)).otherwise(""), F.lit("_done.csv"))


def move_file(spark: SparkSession, folder: str, name: str, archive_dir: str, archive_name: str) -> None:
    """Move a request file (a file, or a folder of parts) into the archive; nothing to do when it is there already."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda *x: jvm.org.apache.hadoop.fs.Path("/".join(x))
    fs = path(folder).getFileSystem(conf)
    fs.mkdirs(path(archive_dir))
    for source in (f"file_name={name}", name):
        if fs.exists(path(folder, source)) and not fs.rename(path(folder, source), path(archive_dir, archive_name)):
            raise OSError(f"{folder}/{source} cannot be moved to {archive_dir}/{archive_name}")


def write_requests(chunked: DataFrame, folder: str, if_exists: str = "overwrite") -> None:
    """One folder per chunk file; ``if_exists`` = overwrite (reset) | error | append."""
    mode = {"delete": "overwrite", "overwrite": "overwrite", "error": "error", "append": "append"}.get(if_exists,
                                                                                                    "overwrite")
    out = chunked.withColumn("file_name", request_file_name()).select(*REQUEST_SCHEMA.fieldNames(), "file_name")
    # each chunk is at most rows_per_file rows: one writer task per file
    # static: a reset removes the files of earlier chunks too
    (out.repartition("file_name").write.mode(mode).option("partitionOverwriteMode", "static").options(**CSV)
     .partitionBy("file_name").csv(folder))


def write_results(results: DataFrame, folder: str) -> None:
    """Result rows per result file, whole files replaced (rows of earlier runs are kept by the caller, U3)."""
    out = results.select("key1", "key2", "distance", "duration", "file_name")
    (out.repartition("file_name").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .options(**CSV).partitionBy("file_name").csv(folder))


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def write_rows(spark: SparkSession, rows: list[dict], schema: str, folder: str) -> None:
    """Replaces a folder by one Parquet file of a few rows that the driver holds: a Spark job costs far more than these rows."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    types = {"string": pa.string(), "long": pa.int64()}
    sink = pa.BufferOutputStream()
    pq.write_table(pa.Table.from_pylist(rows, pa.schema([(n, types[t]) for n, t in (c.split() for c in schema.split(", "))])), sink)
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(folder)
    # made beside the folder under a hidden name, so that a reader finds the old file, none or the new one
    made = path(target.getParent(), "_" + uuid.uuid4().hex)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path(made, f"part-{uuid.uuid4().hex}.parquet"))
    try:
        out.write(bytearray(sink.getvalue()))
    finally:
        out.close()
    fs.delete(target, True)
    if not fs.rename(made, target):
        raise OSError(f"{made} cannot be renamed to {folder}")


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a whole table."""
    df.write.mode("overwrite").parquet(path)
