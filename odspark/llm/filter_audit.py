"""Filter interaction audit (op 13): what each filter removes in every order, from sorted posting lists.

One pass over the texts gives each document's failures of the filters that see one text, and a digest of the text; a join of digests
that occur more than once gives the failures of the filter against copies. Failing rows then become sorted posting lists: one list of row
ids per part, id range and filter, and lists of the rows with a good and a toxic label. Inside one id range the lists are merged: the union of a
set of filters grows by one list at a time, and the ids that a list adds are found by galloping through the longer of the two, so
each of the 2^5 unions is made once and with it every difference. Sizes are summed over the ranges of a part; the 120 orders are then only lookups of
sizes of unions: a filter removes |union with it| - |union of the filters before it|.

A range holds at most 2^RANGE_BITS rows of one input partition, so a hot part is spread over tasks and lists stay bounded. Digests are 128-bit; copies of
one text never meet in one task (their smallest id is a partial minimum, and heavy digests are broadcast, see keyed_join).

Defined cases: a null text counts as empty (it fails A; with no words B, C and D hold nothing to fail); the part of a null source is the empty string,
together with sources that are empty strings; documents without id never fail E, cause no failure of others and have no label; rows with one id are each a
document (an equal id is not a smaller one); a document has a label if any label row of its id has it; null labels are none; an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.llm.common import keyed_join, small_batches, stored, table

FILTERS = "ABCDE"
GOOD, TOXIC = "good", "toxic"
RANGE_BITS = 16
MIN_WORDS = 200
SIGNS = re.compile(rb"[#$%&*|]")
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CONTINUATION = bytes(range(0x80, 0xC0))


def failures(text: bytes) -> int:
    """The filters A to D that a UTF-8 text fails, as bits 0 to 3."""
    words = text.split()
    a = len(words) < MIN_WORDS
    b = 100 * len(set(words)) < 50 * len(words)
    c = 100 * (len(text) - len(text.translate(None, UPPER))) > 2 * len(text.translate(None, CONTINUATION))
    return a | b << 1 | c << 2 | (SIGNS.search(text) is not None) << 3


def rows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One stored row per document: row (a number of its own), doc_id, part, fails (bits of A to D), digest."""
    small_batches(docs.sparkSession)
    held = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("string").alias("text"))
    kind = held.schema["doc_id"].dataType.simpleString()

    def run(batches) -> Iterator:
        import hashlib

        import pyarrow as pa

        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            digests = [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(failures, texts), pa.int32()), pa.array(digests, pa.binary())],
                                             names=["doc_id", "part", "fails", "digest"])

    found = held.mapInArrow(run, f"doc_id {kind}, part string, fails int, digest binary")
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "rows")


def copies(rows: DataFrame) -> DataFrame:
    """The rows (row, part) whose text a smaller id has too."""
    known = rows.where("doc_id IS NOT NULL").select("row", "part", "doc_id", "digest")
    first = stored(known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
                   .where("first < last").drop("last"), "first")
    return keyed_join(known, first, "digest", "n").where("doc_id > first").select("row", "part")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, part, good, toxic) of the rows with a label."""
    has = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    wanted = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(has("quality").alias(GOOD), has("toxic").alias(TOXIC)).where(f"{GOOD} OR {TOXIC}")
    known = rows.where("doc_id IS NOT NULL").select("row", "part", "doc_id")
    wanted = stored(wanted.join(known.groupBy("doc_id").agg(F.count("*").alias("n")), "doc_id"), "wanted")
    return keyed_join(known, wanted, "doc_id", "n").select("row", "part", GOOD, TOXIC)


def postings(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Sorted posting lists: (part, range, list, ids), ids ascending; lists A to E, good and toxic."""
    names = F.filter(F.array(*[F.when(F.col("fails").bitwiseAND(1 << k) > 0, F.lit(f)) for k, f in enumerate(FILTERS[:4])]), lambda x: x.isNotNull())
    own = rows.where("fails > 0").select("row", "part", F.explode(names).alias("list"))
    marks = labelled(rows, labels).select("row", "part", F.explode(F.array_compact(F.array(F.when(F.col(GOOD), F.lit(GOOD)), F.when(F.col(TOXIC), F.lit(TOXIC))))).alias("list"))
    every = own.union(copies(rows).select("row", "part", F.lit("E").alias("list"))).union(marks)
    return every.groupBy("part", F.shiftright("row", RANGE_BITS).alias("range"), "list").agg(F.sort_array(F.collect_list("row")).alias("ids"))


def gallop(needles, hay):
    """(place in the hay of each needle that is not there, whether it is there); both ascending without repeats. The shorter list jumps through the longer one."""
    import numpy as np

    if not len(hay):
        return np.zeros(len(needles), np.int64), np.zeros(len(needles), bool)
    if len(needles) <= len(hay):
        place = np.searchsorted(hay, needles)
        return place, hay[np.minimum(place, len(hay) - 1)] == needles
    upto = np.searchsorted(needles, hay)                      # first needle that is not below each id of the hay
    hit = upto < len(needles)
    hit[hit] = needles[upto[hit]] == hay[hit]
    there = np.zeros(len(needles), bool)
    there[upto[hit]] = True
    return np.cumsum(np.bincount(upto, minlength=len(needles) + 1))[:-1], there


def union_sizes(lists: list, marks: list) -> dict[int, tuple[int, ...]]:
    """Sizes of the unions of every set of lists (bits of their places), and of each union's intersections with the marks. Ids ascend in all of them."""
    import numpy as np

    out = {0: (0,) * (1 + len(marks))}

    def grow(mask: int, union, sizes: tuple[int, ...], start: int) -> None:
        for k in range(start, len(lists)):
            place, there = gallop(lists[k], union)
            new = lists[k][~there]
            more = (len(new), *[int(gallop(new, m)[1].sum()) for m in marks])
            total = tuple(a + b for a, b in zip(sizes, more))
            out[mask | 1 << k] = total
            if k + 1 < len(lists):
                grow(mask | 1 << k, np.insert(union, place[~there], new), total, k + 1)

    grow(0, np.empty(0, np.int64), out[0], 0)
    return out


def union_table(lists: DataFrame) -> DataFrame:
    """(part, filters, n, good, toxic): rows of a part that fail any filter of a set (bits), those with a good and those with a toxic label."""
    def merge(pdf):
        import numpy as np
        import pandas as pd

        held = {name: np.asarray(ids, np.int64) for name, ids in zip(pdf["list"], pdf["ids"])}
        none = np.empty(0, np.int64)
        sizes = union_sizes([held.get(f, none) for f in FILTERS], [held.get(GOOD, none), held.get(TOXIC, none)])
        return pd.DataFrame([(pdf["part"].iloc[0], mask, *n) for mask, n in sizes.items()], columns=["part", "filters", "n", GOOD, TOXIC])

    found = lists.groupBy("part", "range").applyInPandas(merge, "part string, filters int, n long, good long, toxic long")
    return found.groupBy("part", "filters").agg(*[F.sum(c).alias(c) for c in ("n", GOOD, TOXIC)])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    rows = rows_of(docs, id_col, text_col, part_col)
    sizes = union_table(stored(postings(rows, labels), "postings"))
    held = sizes.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("filters", F.struct("n", GOOD, TOXIC)))).alias("held"))   # 32 entries
    parts = rows.groupBy("part").agg(F.count("*").alias("documents")).join(held, "part", "left")
    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(FILTERS)])
    out = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    out = out.withColumn("bit", F.expr(f"shiftleft(1, instr('{FILTERS}', substr(filter_order, step, 1)) - 1)"))
    out = out.withColumn("before", F.expr(f"aggregate(sequence(0, step - 1), 0, (m, k) -> IF(k = 0, m, m | shiftleft(1, instr('{FILTERS}', substr(filter_order, k, 1)) - 1)))"))
    every = (1 << len(FILTERS)) - 1

    def size(filters: str, field: str = "n"):
        return f"coalesce(held[{filters}].{field}, 0L)"

    n = len(FILTERS)
    # in how many orders exactly the filters of a set come before another filter
    ways = {s: math.factorial(s.bit_count()) * math.factorial(n - 1 - s.bit_count()) for s in range(every)}
    shapley = " + ".join(f"IF(bit & {s} = 0, {w}L * ({size(f'bit | {s}')} - {size(str(s))}), 0L)" for s, w in ways.items())
    return out.select(
        "part", "filter_order", "step",
        F.expr(f"documents - {size('before | bit')}").alias("kept"),
        F.expr(f"{size('before | bit')} - {size('before')}").alias("removed"),
        F.expr(f"{size('bit')} - ({size('before | bit')} - {size('before')})").alias("redundant"),
        F.expr(f"{size(str(every))} - {size(f'{every} ^ bit')}").alias("unique_fails"),
        F.expr(f"{size('before | bit', GOOD)} - {size('before', GOOD)}").alias("good_lost"),
        F.expr(f"{size('before | bit', TOXIC)} - {size('before', TOXIC)}").alias("toxic_lost"),
        F.expr(shapley).alias("shapley"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the audit of filters A to E over the whole documents, per source."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t),
firsts AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
l AS (SELECT doc_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INT)), 0) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, ['A', 'B', 'C', 'D', 'E'] AS names,
             [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
              regexp_matches(text, '[#$%&*|]'), coalesce(w.doc_id > first, false)] AS bad
      FROM w JOIN firsts USING (text) LEFT JOIN l ON l.doc_id = w.doc_id),
g AS (SELECT part, good, toxic, list_transform(list_filter(list_zip(names, bad), lambda x: x[2]), lambda x: x[1]) AS fails, count(*) AS n FROM f GROUP BY ALL),
o AS (SELECT '' AS filter_order UNION ALL SELECT filter_order || c FROM o, unnest(['A', 'B', 'C', 'D', 'E']) u(c) WHERE NOT contains(filter_order, c)),
p AS (SELECT filter_order, CAST(s AS INT) AS step, substr(filter_order, s, 1) AS c, substr(filter_order, 1, s - 1) AS before FROM o, range(1, 6) r(s) WHERE length(filter_order) = 5),
x AS (SELECT part, filter_order, step, c, n, good, toxic, list_contains(fails, c) AS hit, len(fails) AS k,
             len(list_filter(fails, lambda y: contains(before, y))) > 0 AS gone FROM g, p),
a AS (SELECT part, filter_order, step, c,
             coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed,
             coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant, coalesce(sum(n) FILTER (hit AND k = 1), 0) AS unique_fails,
             coalesce(sum(n) FILTER (hit AND NOT gone AND good = 1), 0) AS good_lost, coalesce(sum(n) FILTER (hit AND NOT gone AND toxic = 1), 0) AS toxic_lost
      FROM x GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM a
"""
