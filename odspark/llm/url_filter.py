"""URL filters (op 10): a temporal list join. Dated list entries become validity intervals; every capture is judged by the entries active at its fetch time.

An entry adds a pattern to a list or removes it from a time on. Patterns are hosts (`example.com` covers its subdomains) or hosts with a path prefix
(`example.com/en` covers `/en` and what lies below). A capture is looked up under every suffix of its host, alone and with every
prefix of its path, by an equality join on the pattern and a condition on the interval. Among the active matches the longest pattern decides; at equal
patterns `allow` wins over `block`. Built from DataFrame and SQL functions only.

A hot host does not gather in one task: intervals are broadcast when their counted size allows; beyond that captures are salted and intervals replicated per
salt (AQE may split further).

Defined cases: a null or empty url, or one without `scheme://host`, matches nothing and is not blocked; entries with a null field are ignored; of
several entries for one list, pattern and time a removal wins; an addition of a pattern that is on the list, or a removal of one that is not, changes
nothing; a null fetch time matches nothing. Repeated captures stay rows of their own. Extra columns of captures pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odspark.llm.common import stored, table

BROADCAST_ROWS = 200_000   # intervals (each a pattern and two dates, below 1 KB for real hosts)
BROADCAST_BYTES = 64 << 20
SALTS = 16

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host of a url without user, port and trailing dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))), r"\.$", "")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to): times at which a pattern is on a list, ends exclusive, null while it lasts. entries: list,
    pattern, action (`add` or `remove`), at."""
    rows = entries.select("list", F.lower("pattern").alias("pattern"), "action", "at").where(
        "list IS NOT NULL AND pattern IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')")
    last = rows.groupBy("list", "pattern", "at").agg(F.max("action").alias("action"))   # a removal wins
    w = Window.partitionBy("list", "pattern").orderBy("at")
    turns = last.withColumn("before", F.lag("action").over(w)).where("before IS NULL AND action = 'add' OR action != before")
    spans = turns.select("list", "pattern", "action", F.col("at").alias("valid_from"), F.lead("at").over(w).alias("valid_to"))
    return spans.where("action = 'add'").drop("action")


def patterns_of(host: Column, url: Column) -> Column:
    """Array of all patterns that cover a url: every suffix of its host, alone and with every prefix of its path."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "")
    prefixes = F.when(F.size(steps) == 0, F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")))))
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lower(p)))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(both))


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """`captures` with host, n_active (list entries active at the fetch time that cover the url), pattern and list of the deciding one, blocked."""
    spark, held = captures.sparkSession, "__url_filter_"
    spans = stored(intervals(entries), "list-intervals").select(*[F.col(c).alias(held + c) for c in ("list", "pattern", "valid_from", "valid_to")])
    size = spans.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(held + "pattern") + F.octet_length(held + "list") + 16), F.lit(0))).first()
    url, host = F.col(f"`{url_col}`").cast("string"), F.col(held + "host")
    rows = captures.withColumn(held + "row", F.struct(F.col(f"`{url_col}`").alias("u"), F.col(f"`{time_col}`").alias("t"))).withColumn(held + "host", host_of(url))
    # equal urls fetched at one time are judged once
    once = rows.select(held + "row", held + "host").distinct()
    keys = once.select(held + "row", F.explode(patterns_of(host, F.col(f"{held}row.u").cast("string"))).alias(held + "pattern"))
    active = (F.col(f"{held}row.t") >= F.col(held + "valid_from")) & (F.col(held + "valid_to").isNull() | (F.col(f"{held}row.t") < F.col(held + "valid_to")))
    if size[0] <= BROADCAST_ROWS and size[1] <= BROADCAST_BYTES:
        met = keys.join(F.broadcast(spans), held + "pattern").where(active)
    else:
        salted = spans.withColumn(held + "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = keys.withColumn(held + "salt", F.pmod(F.xxhash64(held + "row"), F.lit(SALTS)).cast("int")).join(salted, [held + "pattern", held + "salt"]).where(active)
    best = F.max(F.struct(F.char_length(held + "pattern").alias("n"), F.col(held + "pattern").alias("p"), (F.col(held + "list") == "allow").alias("a"), F.col(held + "list").alias("l")))
    decided = met.groupBy(held + "row").agg(F.count("*").alias(held + "n"), best.alias(held + "best")).withColumnRenamed(held + "row", held + "key")
    joined = rows.join(decided, F.col(held + "row").eqNullSafe(F.col(held + "key")), "left")
    added = {"host": host, "n_active": F.coalesce(F.col(held + "n"), F.lit(0)).cast("long"), "pattern": F.col(f"{held}best.p"), "list": F.col(f"{held}best.l"),
             "blocked": F.coalesce(F.col(f"{held}best.l") == "block", F.lit(False))}
    return joined.select(*[F.col(f"`{c}`") for c in captures.columns if c not in added], *[c.alias(k) for k, c in added.items()])


# ---- the registered query: captures and list entries derived from `pages` ----

#: Words in a site's name for which the derived block list names it for good.
LISTED_WORDS = ["casino", "bets", "pills"]


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day: pages have none, so it follows from page_id (one of 366 days from 2024-01-01)."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(366)).cast("int")).alias("fetched"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries for the sites (last three labels) of the pages: additions to and removals from `block`, additions to `allow`."""
    labels = F.split(host_of(F.col("url").cast("string")), r"\.")
    site = F.array_join(F.when(F.size(labels) > 3, F.slice(labels, F.size(labels) - 2, 3)).otherwise(labels), ".")
    sites = pages.select(site.alias("site")).where("site != ''").distinct().withColumn("n", F.char_length("site"))
    listed = " OR ".join(f"contains(site, '{w}')" for w in LISTED_WORDS)
    first = "date_add(DATE'2024-01-01', n * 13 % 120"
    dated = [(f"{listed} OR n % 2 = 0", "'block'", "site", "'add'", f"{first})"),
             (f"{listed} OR n % 2 = 0", "'block'", "site", "'remove'", f"{first} + 60 + n)"),
             (listed, "'block'", "site", "'add'", "DATE'2024-10-27'"),
             ("n % 3 = 0", "'allow'", "site || '/en'", "'add'", "date_add(DATE'2024-01-01', n * 29 % 200)")]
    each = ", ".join(f"IF({when}, named_struct('list', {name}, 'pattern', {pattern}, 'action', {action}, 'at', {at}), NULL)" for when, name, pattern, action, at in dated)
    return sites.selectExpr(f"inline(array_compact(array({each})))")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every page judged by the list entries active on its fetch day."""
    pages = table(spark, sf_dir, "pages")
    return judge(captures(pages), derived_entries(pages)).select("page_id", "url", "fetched", "host", "n_active", "pattern", "list", "blocked")


_LISTED = " OR ".join(f"contains(site, '{w}')" for w in LISTED_WORDS)
ORACLE = rf"""
WITH c AS (SELECT page_id, url, CAST('2024-01-01' AS DATE) + CAST(page_id * 7919 % 366 AS INTEGER) AS fetched,
    regexp_replace(lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)), '\.$', '') AS host,
    lower(regexp_extract(coalesce(url, ''), '{PATH}', 1)) AS path FROM pages),
s AS (SELECT DISTINCT array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') AS site FROM c WHERE host != ''),
e AS (SELECT *, length(site) AS n FROM s),
v AS (SELECT 'block' AS list, site AS pattern, DATE '2024-01-01' + CAST(n * 13 % 120 AS INTEGER) AS lo, DATE '2024-01-01' + CAST(n * 13 % 120 + 60 + n AS INTEGER) AS hi FROM e WHERE {_LISTED} OR n % 2 = 0
  UNION ALL SELECT 'block', site, DATE '2024-10-27', NULL FROM e WHERE {_LISTED}
  UNION ALL SELECT 'allow', site || '/en', DATE '2024-01-01' + CAST(n * 29 % 200 AS INTEGER), NULL FROM e WHERE n % 3 = 0),
m AS (SELECT page_id, v.list, v.pattern FROM c JOIN v ON fetched >= lo AND (hi IS NULL OR fetched < hi) AND (
      ('.' || host LIKE '%.' || v.pattern) OR (contains(v.pattern, '/') AND '.' || host LIKE '%.' || split_part(v.pattern, '/', 1) AND (path || '/') LIKE '/' || split_part(v.pattern, '/', 2) || '/%'))),
best AS (SELECT page_id, count(*) AS n, max({{'n': length(pattern), 'p': pattern, 'a': list = 'allow', 'l': list}}) AS b FROM m GROUP BY 1)
SELECT c.page_id, url, fetched, host, CAST(coalesce(n, 0) AS BIGINT) AS n_active, b.p AS pattern, b.l AS list, coalesce(b.l = 'block', FALSE) AS blocked
FROM c LEFT JOIN best USING (page_id)
"""
