"""Join helpers with checked broadcast sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.session import cut_lineage

# Broadcast a side only when its checked row count is at most this.
BROADCAST_MAX_ROWS = 2_000_000


# rows of a task in joins and groupings of whole result tables
TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int = TASK_ROWS) -> int:
    """Tasks for a counted number of rows, at least one per core: the rows of a task, and with them its memory, stay the same however many rows there are."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_task))


def sized_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, bool]:
    """Materialize a (small, derived) side once in the checkpoint folder and check its size.

    Returns the materialized frame and whether it may be broadcast. Beyond the
    bound the caller falls back to a shuffle join (AQE splits skewed keys).
    """
    mat = cut_lineage(df)
    return mat, mat.count() <= max_rows


def join_sized(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    side, ok = sized_side(small, max_rows)
    return big.join(F.broadcast(side) if ok else side, on, how)


def one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side by side of two one-row aggregates (equi-join on a constant key)."""
    k = "_one"
    return a.withColumn(k, F.lit(1)).join(b.withColumn(k, F.lit(1)), k).drop(k)
