"""Origin-destination pairs and request chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odspark.operators.common import one_row_join
from odspark.session import cut_lineage

# The product is built in tasks of about this many output rows.
ROWS_PER_TASK = 1_000_000
# request rows per file (reference value)
REQUEST_ROWS_PER_FILE = 500_000


def all_pairs(left: DataFrame, right: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every (left row, right row) combination: the feature asks for the whole product, n1 · n2 rows.

    The work is split by the counted size of the product, about ``rows_per_task`` output rows a task (at least one
    task per core): the right side is cut into ``kr`` pieces of at most that many rows, the left side into ``kl``, and every pair
    of pieces is one key of an equi-join whose partitions hold a few keys each.
    """
    n_left, n_right = left.count(), right.count()
    tasks = max(left.sparkSession.sparkContext.defaultParallelism, -(-n_left * n_right // rows_per_task))
    kr = max(1, -(-n_right // rows_per_task))
    kl = max(1, min(n_left, -(-4 * tasks // kr)))   # more keys than tasks, so that the keys spread evenly
    at = lambda df, k: F.pmod(F.xxhash64(*df.columns), F.lit(k))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)).cast("array<bigint>"))
    l = left.withColumn("_l", at(left, kl)).withColumn("_r", every(kr))
    r = right.withColumn("_r", at(right, kr)).withColumn("_l", every(kl))
    n = max(1, min(kl * kr, tasks))
    return l.repartition(n, "_l", "_r").join(r.repartition(n, "_l", "_r"), ["_l", "_r"]).drop("_l", "_r")


def request_pairs(sites: DataFrame, postal: DataFrame) -> DataFrame:
    """Request rows (key1, longitude1, latitude1, key2, longitude2, latitude2)."""
    s = sites.select(F.col("kh_key").alias("key1"), F.col("longitude").alias("longitude1"),
                     F.col("latitude").alias("latitude1"))
    p = postal.select(F.col("plz").alias("key2"), F.col("longitude_plz").alias("longitude2"),
                      F.col("latitude_plz").alias("latitude2"))
    return all_pairs(s, p).select("key1", "longitude1", "latitude1", "key2", "longitude2", "latitude2")


def expected_pair_total(sites: DataFrame, postal: DataFrame) -> DataFrame:
    """n1 · n2 as a one-row DataFrame (two global counts, no pairs built)."""
    a = sites.agg(F.count(F.lit(1)).alias("n_sites"))
    b = postal.agg(F.count(F.lit(1)).alias("n_postal"))
    return one_row_join(a, b).withColumn("n_pairs", F.col("n_sites") * F.col("n_postal"))


def with_row_index(df: DataFrame, order_cols: list[str], index_col: str = "row_index") -> DataFrame:
    """Dense 0-based index in ``order_cols`` order without a single-partition window.

    Range-sort, checkpoint (stable partitions), then index = rows in earlier
    partitions + position inside the partition. Only one row per partition
    (a few thousand at most) is combined in a window.
    """
    sorted_df = cut_lineage(df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols))
    mid = F.monotonically_increasing_id()
    tagged = sorted_df.withColumn("_pid", F.shiftright(mid, 33)).withColumn(
        "_pos", mid.bitwiseAND(F.lit((1 << 33) - 1)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_offset", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                              F.lit(0)))
    return (tagged.join(F.broadcast(offsets.select("_pid", "_offset")), "_pid")
            .withColumn(index_col, F.col("_offset") + F.col("_pos"))
            .drop("_pid", "_pos", "_offset"))


def chunk_requests(requests: DataFrame, rows_per_file: int = REQUEST_ROWS_PER_FILE) -> DataFrame:
    """chunk number (0-based) of each request row in (key1, key2) order. Rows that have their row_index already are not sorted again."""
    idx = requests if "row_index" in requests.columns else with_row_index(requests, ["key1", "key2"])
    return idx.withColumn("chunk", F.floor(F.col("row_index") / F.lit(rows_per_file)).cast("long"))


def chunk_summary(chunked: DataFrame) -> DataFrame:
    """A8 per chunk: rows, written-so-far running total and file name.

    The dense row index of ``chunk_requests`` already counts the rows of all earlier partitions, so the rows written after a chunk are its highest
    index + 1: partial maxima, no window over the chunks.
    """
    per = chunked.groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"), (F.max("row_index") + 1).alias("written"))
    return per.withColumn("file_name", F.format_string("coordination_items_%010d.csv", F.col("chunk")))
