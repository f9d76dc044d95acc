"""Resume and answers: J3, J8, F1-F3, U1, U3, A10."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odspark.functions.units import metres_to_km, round5, seconds_to_minutes

RESULT_COLUMNS = ["key1", "key2", "distance", "duration"]


def remaining_requests(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Requests without a result; null keys match null keys (null-safe)."""
    r = results.select(F.col("key1").alias("_k1"), F.col("key2").alias("_k2")).distinct()
    cond = requests["key1"].eqNullSafe(r["_k1"]) & requests["key2"].eqNullSafe(r["_k2"])
    return requests.join(r, cond, "left_anti")


def best_legs(legs: DataFrame, tasks: int | None = None) -> DataFrame:
    """First answer per (key1, key2): least duration, then least distance.

    Partial aggregation happens map-side, so a hot pair never sits whole in one task. ``tasks`` (optional, ``tasks_for`` the rows): the
    tasks that the rows are dealt over, first by pair and values, then the pairs; without it Spark deals them by their bytes, which tell little of their number.
    """
    if tasks is not None:
        dealt = legs.select("key1", "key2", "duration_s", "distance_m", F.pmod(F.xxhash64("duration_s", "distance_m"), F.lit(tasks)).alias("_at"))
        least = dealt.repartition(tasks, "key1", "key2", "_at").groupBy("key1", "key2", "_at").agg(F.min(F.struct("duration_s", "distance_m")).alias("_b"))
        legs = least.select("key1", "key2", "_b.duration_s", "_b.distance_m").repartition(tasks, "key1", "key2")
    best = legs.groupBy("key1", "key2").agg(
        F.min(F.struct("duration_s", "distance_m")).alias("_b"))
    return best.select("key1", "key2", F.col("_b.distance_m").alias("distance_m"),
                       F.col("_b.duration_s").alias("duration_s"))


def attach_legs(requests: DataFrame, legs: DataFrame, tasks: int | None = None) -> DataFrame:
    """J8 + F1-F3: requests get km and minutes (5 decimals); unanswered keep nulls. ``tasks``: as for ``best_legs``, for the rows of both sides."""
    return attach_best(requests, best_legs(legs, tasks), tasks)


def attach_best(requests: DataFrame, best: DataFrame, tasks: int | None = None) -> DataFrame:
    """``attach_legs`` with one leg per pair (``best_legs``)."""
    if tasks is not None:
        requests = requests.repartition(tasks, "key1", "key2")
    joined = requests.join(best, ["key1", "key2"], "left")
    return joined.select(
        *requests.columns,
        round5(metres_to_km(F.col("distance_m"))).alias("distance"),
        round5(seconds_to_minutes(F.col("duration_s"))).alias("duration"),
    )


def answered(requests_with_legs: DataFrame) -> DataFrame:
    """Result rows (key1, key2, distance, duration) of answered requests."""
    return requests_with_legs.filter(F.col("duration").isNotNull()).select(*RESULT_COLUMNS)


def unique_results(results: DataFrame) -> DataFrame:
    """One result row per (key1, key2): least duration, then least distance (sites with several points request a pair more than once)."""
    best = results.groupBy("key1", "key2").agg(F.min(F.struct("duration", "distance")).alias("_b"))
    return best.select("key1", "key2", F.col("_b.distance").alias("distance"), F.col("_b.duration").alias("duration"))


def unanswered(requests_with_legs: DataFrame) -> DataFrame:
    """Quality report of requests the leg table cannot answer (an error in the reference)."""
    return requests_with_legs.filter(F.col("duration").isNull()).select("key1", "key2")


def require_answers(requests_with_legs: DataFrame, sample: int = 10) -> None:
    """J8 as the reference applies it: raise when a request has no answer (count + a few examples)."""
    missing = unanswered(requests_with_legs)
    n = missing.count()
    if n:
        examples = [(r.key1, r.key2) for r in missing.limit(sample).collect()]
        raise ValueError(f"{n} requests without an answer, e.g. {examples}")


def merge_results(earlier: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier results ∪ new results, by column name."""
    return earlier.select(*RESULT_COLUMNS).unionByName(new.select(*RESULT_COLUMNS))


def resume_counts(requests: DataFrame, results: DataFrame) -> DataFrame:
    """A10: processed / remaining request rows on resume, as one row."""
    r = results.select(F.col("key1").alias("_k1"), F.col("key2").alias("_k2")).distinct() \
        .withColumn("_hit", F.lit(1))
    cond = requests["key1"].eqNullSafe(r["_k1"]) & requests["key2"].eqNullSafe(r["_k2"])
    marked = requests.join(r, cond, "left")
    return marked.agg(F.count(F.lit(1)).alias("total"), F.count("_hit").alias("processed")) \
        .withColumn("remaining", F.col("total") - F.col("processed"))
