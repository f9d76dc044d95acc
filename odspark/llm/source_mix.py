"""Mixing sources to target weights (op 12): words per source, repetition rates, hash-seeded copies.

The words of every text are counted once and summed per source (partial sums before the shuffle, so a hot source is only numbers).
Sources get weights by their place in code-point order (1, 2, 3, repeating; the source null comes last) and share the words of the whole
corpus: a target stops at MAX_RATE times its source's words, and what it leaves is shared again by weight. That is water filling; each
round is one aggregate over the source table, and there are as many rounds as the set of stopped sources grows.

A source's rate is target / words. Each of its documents is taken floor(rate) times, plus one copy where a draw in [0, 1) from the
md5 of its id lies below the rest of the rate. All draws of a source are turned by one of TURNS equal steps around the unit circle (a
document's probability stays the same): the step whose sum of words lies nearest to the target is used, so small sources and sources with a
few very long documents come near their target too. Reruns agree, because nothing but ids, texts and sums decides.

Native: DataFrame functions only.

Defined cases: a null or empty text has size 0 and adds nothing; the source null is a source of its own (null in the result), an empty string too; a
source without words has target 0 and its documents are taken 0 times; documents without id draw from the md5 of their text; rows with
the same id (or, without id, the same text) draw alike and each is a document; an empty table gives no rows. Extra columns are ignored by
`mix` and passed through by `emit`, which names its helper columns so that they do not clash (HELD).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odspark.llm.common import keyed_join, space_words, stored, table, text_or_empty

WEIGHTS = (1, 2, 3)
MAX_RATE = 3
TURNS = 32
#: Prefix of helper columns; inputs do not use it.
HELD = "__mix_"


def _exact(n) -> Column:
    return F.lit(str(n)).cast("decimal(38,0)")


def draw(id_col: str, text_col: str) -> Column:
    """A number in [0, 1) of 48 bits from the md5 of the id (of the text where there is no id)."""
    seed = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.concat(F.lit("text:"), text_or_empty(f"`{text_col}`")))
    return F.conv(F.substring(F.md5(seed), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def key_of(source_col: str) -> Column:
    """Join key of a source: never null, of fixed length."""
    c = F.col(f"`{source_col}`").cast("string")
    return F.when(c.isNull(), F.lit("null")).otherwise(F.md5(c))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """`docs` with its size, draw and source key in helper columns."""
    return docs.select("*", F.size(space_words(text_or_empty(f"`{text_col}`"))).cast("long").alias(HELD + "size"),
                       draw(id_col, text_col).alias(HELD + "draw"), key_of(source_col).alias(HELD + "key"))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """`df` with `place`, its number from 0 in the given order: places inside range partitions plus the rows of earlier partitions."""
    ranged = stored(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    inside = ranged.withColumn("inside", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    before = ranged.groupBy("part").agg(F.count("*").alias("n"))      # one row per partition
    before = before.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    return inside.join(F.broadcast(before), "part").withColumn("place", F.col("before") + F.col("inside") - 1).drop("part", "inside", "n", "before")


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: key, source, documents, source_size, target, rate. sizes: key, source, size."""
    per = sizes.groupBy("key").agg(F.first("source").alias("source"), F.count("*").alias("documents"), F.sum("size").alias("source_size"))
    weight = F.expr(f"get(array({', '.join(f'{w}L' for w in WEIGHTS)}), CAST(place % {len(WEIGHTS)} AS INT))")
    sources = stored(numbered(per, F.col("source").isNull(), F.col("source")).withColumn("weight", weight).drop("place"), "sources")
    limit = F.col("source_size").cast("decimal(38,0)") * MAX_RATE
    total = sources.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight"), F.count("*").alias("n")).first()
    words, weights, stopped = total["words"] or 0, total["weight"] or 0, 0
    rest, shared, above = words, weights, F.lit(False)
    while rest and shared:
        # a share above its limit stops there; the others share what it leaves
        above = limit * _exact(shared) < F.col("weight").cast("decimal(38,0)") * _exact(rest)
        now = sources.where(above).agg(F.count("*").alias("n"), F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
        if now["n"] == stopped:
            break
        stopped, rest, shared = now["n"], words - MAX_RATE * (now["words"] or 0), weights - (now["weight"] or 0)
    share = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(shared or 1))
    target = F.when(above, (F.col("source_size") * MAX_RATE).cast("double")).otherwise(share)
    rate = F.when(F.col("source_size") == 0, 0.0).otherwise(F.col("target") / F.col("source_size"))
    return sources.withColumn("target", target).withColumn("rate", rate)


def _extra(turn: Column) -> Column:
    """Whether a draw, turned, lies below the rest of the rate."""
    turned = F.col("draw") + turn
    return F.when(turned >= 1.0, turned - 1.0).otherwise(turned) < F.col("rate") - F.floor("rate")


def rates(sizes: DataFrame) -> DataFrame:
    """`targets` with `turn`, the step whose taken words lie nearest to the target (the smallest one on a tie). sizes: a stored table of key, source, size, draw."""
    goal = stored(targets(sizes), "targets")
    met = keyed_join(sizes.select("key", "size", "draw"), goal.select("key", "rate", "documents"), "key", "documents")
    sums = met.groupBy("key").agg(*[F.sum(F.when(_extra(F.lit(k / TURNS)), F.col("size")).otherwise(0)).alias(f"s{k}") for k in range(TURNS)])
    off = lambda k: F.abs(F.floor("rate") * F.col("source_size") + F.col(f"s{k}") - F.col("target"))
    best = F.array_min(F.array(*[F.struct(off(k).alias("off"), F.lit(k).alias("k")) for k in range(TURNS)]))["k"] / F.lit(float(TURNS))
    return stored(goal.join(sums, "key").withColumn("turn", best).drop(*[f"s{k}" for k in range(TURNS)]), "rates")


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    held = sized(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source")), "doc_id", "text", "source")
    return stored(held.select("doc_id", "source", *[F.col(HELD + c).alias(c) for c in ("size", "draw", "key")]), "sizes")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = _sizes(docs, id_col, text_col, source_col)
    found = keyed_join(sizes, rates(sizes).drop("source"), "key", "documents")
    copies = (F.floor("rate") + _extra(F.col("turn")).cast("long")).cast("long")
    return found.withColumn("copies", copies).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken, with the columns of `docs`."""
    plan = rates(_sizes(docs, id_col, text_col, source_col)).select(*[F.col(c).alias(HELD + c) for c in ("key", "rate", "turn", "documents")])
    found = keyed_join(sized(docs, id_col, text_col, source_col), plan, HELD + "key", HELD + "documents")
    named = {c: F.col(HELD + c) for c in ("rate", "turn", "draw")}
    turned = named["draw"] + named["turn"]
    extra = F.when(turned >= 1.0, turned - 1.0).otherwise(turned) < named["rate"] - F.floor(named["rate"])
    copies = F.floor(named["rate"]).cast("int") + extra.cast("int")
    return found.withColumn(HELD + "copy", F.explode(F.array_repeat(F.lit(1), copies))).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: size, target and taken words of every document."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "copies", "taken")


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) AS DOUBLE) / CAST({1 << 48} AS DOUBLE) AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS s, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
o AS (SELECT *, sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY s / w, w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS r,
             sum(w) OVER (ORDER BY s / w, w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM s),
f AS (SELECT *, 3 * s * ws < w * r AS stopped FROM o),
l AS (SELECT r, ws FROM f WHERE NOT stopped ORDER BY s / w, w, source LIMIT 1),
t AS (SELECT f.source, s, CASE WHEN stopped THEN CAST(3 * s AS DOUBLE) ELSE CAST(w AS DOUBLE) * CAST(l.r AS DOUBLE) / CAST(l.ws AS DOUBLE) END AS target
      FROM f LEFT JOIN l ON true),
q AS (SELECT *, CASE WHEN s = 0 THEN CAST(0 AS DOUBLE) ELSE target / s END AS rate FROM t),
e AS (SELECT d.doc_id, d.size, d.u, q.*, k, CAST(k AS DOUBLE) / {TURNS} AS turn,
             (CASE WHEN u + CAST(k AS DOUBLE) / {TURNS} >= 1 THEN u + CAST(k AS DOUBLE) / {TURNS} - 1 ELSE u + CAST(k AS DOUBLE) / {TURNS} END) < rate - floor(rate) AS extra
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source, range({TURNS}) g(k)),
b AS (SELECT source, k, abs(floor(any_value(rate)) * any_value(s) + sum(CASE WHEN extra THEN size ELSE 0 END) - any_value(target)) AS off FROM e GROUP BY source, k),
c AS (SELECT source, k FROM b QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, k) = 1)
SELECT e.doc_id, e.size, e.s AS source_size, e.target, CAST(floor(rate) + CAST(extra AS INT) AS BIGINT) AS copies,
       CAST((floor(rate) + CAST(extra AS INT)) * e.size AS BIGINT) AS taken
FROM e JOIN c ON e.source IS NOT DISTINCT FROM c.source AND e.k = c.k
"""
