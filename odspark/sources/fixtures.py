"""Fixture views derived from the driver tables (see FIXTURES.md).

The same statements feed Spark (``register_fixtures``) and the DuckDB oracle
(``with_clause``), so both engines see identical inputs. Tagged tables (ways,
node_tags) are a tag map in Spark and one column per tag in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Fixed fixture definitions (FIXTURES.md): SQL valid in Spark 4.1 and DuckDB.
SQL = {
    "sites": """
SELECT CAST(260000000 + CAST(floor(s_suppkey / 2.0) AS BIGINT) AS STRING) || '|01' AS kh_key,
 CASE WHEN s_suppkey % 11 = 4 THEN NULL WHEN s_suppkey % 13 = 5 THEN 'n/a' ELSE CAST(6e0 + (s_suppkey * 7919 % 9000) / 1e3 AS STRING) END AS longitude,
 CASE WHEN s_suppkey % 11 = 4 THEN NULL ELSE CAST(47.5e0 + (s_suppkey * 104729 % 7000) / 1e3 AS STRING) END AS latitude,
 CAST(1 + s_nationkey % 2 AS STRING) AS relevanz,
 CASE WHEN s_suppkey % 7 = 3 THEN DATE '2022-01-01' END AS gueltig_bis FROM supplier""",
    "postal": """
SELECT lpad(CAST(1000 + c_custkey % 1200 AS STRING), 5, '0') AS plz,
 CASE WHEN c_custkey % 1200 % 17 = 0 THEN NULL ELSE CAST(6e0 + (c_custkey % 1200 * 7907 % 9000) / 1e3 AS STRING) END AS longitude_plz,
 CASE WHEN c_custkey % 1200 % 17 = 0 THEN NULL ELSE CAST(47.5e0 + (c_custkey % 1200 * 7901 % 7000) / 1e3 AS STRING) END AS latitude_plz FROM customer""",
    "legs": """
SELECT CAST(260000000 + CAST(floor(l_suppkey / 2.0) AS BIGINT) AS STRING) || '|01' AS key1,
 lpad(CAST(1000 + l_partkey % 1200 AS STRING), 5, '0') AS key2,
 min(l_extendedprice) * 3e0 AS distance_m, min(l_quantity) * 75e0 AS duration_s FROM lineitem GROUP BY 1, 2""",
    "versions": """
SELECT CAST(260000000 + o_custkey % 50 AS STRING) || '|01' AS kh_key,
 lpad(CAST(1000 + o_orderkey % 60 AS STRING), 5, '0') AS plz,
 min(o_totalprice) / 1e4 AS fahrstrecke_km, min(o_orderkey % 97) * 0.75e0 AS fahrzeit_min,
 CAST(date_trunc('year', o_orderdate) AS DATE) AS gueltig_ab,
 CASE WHEN min(o_orderstatus) = 'F' THEN CAST(date_trunc('year', max(o_orderdate)) AS DATE) END AS gueltig_bis
 FROM orders GROUP BY 1, 2, 5""",
    "way_nodes": """
SELECT way_id, row_number() OVER (PARTITION BY way_id ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS seq, node_id
 FROM (SELECT l_orderkey % p.n AS way_id, l_partkey AS node_id, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem CROSS JOIN (SELECT max(p_partkey) + 1 AS n FROM part) p) t""",
    "nodes": """
SELECT p_partkey AS node_id, 6e0 + (p_partkey * 7919 % 9000) / 1e3 AS lon, 47.5e0 + (p_partkey * 104729 % 7000) / 1e3 AS lat FROM part""",
    "turns": """
SELECT event_id AS turn_id, event_id * 37 % 361 - 180 AS angle, 2 + event_id % 3 AS number_of_roads, event_id % 5 = 0 AS has_traffic_light, event_id * 37 % 361 IN (0, 360) AS is_u_turn, event_id % 11 = 0 AS is_left_hand_driving, CASE WHEN event_id % 13 = 0 THEN 'ferry' ELSE 'driving' END AS source_mode, CASE WHEN event_id % 17 = 0 THEN 'ferry' ELSE 'driving' END AS target_mode, event_id % 4 = 0 AS source_restricted, event_id % 6 = 1 AS target_restricted FROM events""",
    "relations": """
SELECT c_custkey AS rel_id, 'route' AS type, CASE WHEN c_custkey % 2 = 0 THEN 'road' ELSE 'bus' END AS route,
 CASE c_custkey % 4 WHEN 1 THEN 'north' WHEN 2 THEN 'South' WHEN 3 THEN 'up' END AS direction,
 CASE WHEN c_custkey % 2 = 0 THEN 'US 101 Coast' ELSE 'Ring B' END AS name,
 CASE c_custkey % 3 WHEN 0 THEN 'A 1' WHEN 1 THEN 'B 7' ELSE '101' END AS ref
 FROM customer
UNION ALL
SELECT c.n + s_suppkey AS rel_id, 'route' AS type, CAST(NULL AS STRING) AS route,
 CASE s_suppkey % 3 WHEN 0 THEN 'north' WHEN 2 THEN 'east' END AS direction,
 CAST(NULL AS STRING) AS name, CAST(NULL AS STRING) AS ref
 FROM supplier CROSS JOIN (SELECT max(c_custkey) + 1 AS n FROM customer) c""",
    "relation_members": """
SELECT w.rel_id, 'way' AS member_type, w.member_id,
 CASE (rel_id + member_id) % 5 WHEN 0 THEN '' WHEN 1 THEN 'forward' WHEN 2 THEN 'backward' WHEN 3 THEN 'north' ELSE 'south' END AS role
 FROM (SELECT DISTINCT o_custkey AS rel_id, o_orderkey % p.n AS member_id
  FROM orders CROSS JOIN (SELECT max(p_partkey) + 1 AS n FROM part) p) w
UNION ALL
SELECT r.rel_id, 'relation' AS member_type, r.member_id, CASE WHEN member_id % 2 = 0 THEN '' ELSE 'west' END AS role
 FROM (SELECT DISTINCT c.n + o_orderkey % s.n AS rel_id, o_custkey AS member_id
  FROM orders CROSS JOIN (SELECT max(c_custkey) + 1 AS n FROM customer) c CROSS JOIN (SELECT max(s_suppkey) + 1 AS n FROM supplier) s) r""",
    "raster": """
SELECT CAST(floor(id / 4) AS INT) AS row, CAST(id % 4 AS INT) AS col,
 CASE WHEN id <> 9 THEN CAST(size % 50 AS DOUBLE) END AS datum
 FROM (SELECT p_partkey % 20 AS id, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY 1) g""",
    "areas": """
SELECT c_custkey AS area_id, CASE c_custkey % 3 WHEN 0 THEN 'industrial' WHEN 1 THEN 'residential' ELSE 'forest' END AS type,
 100e0 + c_custkey % 900 AS area, n.lon + (c_custkey % 7 - 3) * 0.0004e0 AS lon, n.lat AS lat
 FROM customer CROSS JOIN (SELECT max(p_partkey) + 1 AS n FROM part) p JOIN nodes n ON n.node_id = c_custkey % p.n""",
}

# raster grid extent (FIXTURES.md): 5 rows x 4 columns
RASTER_BOUNDS = {"lon_min": 6.0, "lon_max": 15.0, "lat_min": 47.5, "lat_max": 54.5, "nrows": 5, "ncols": 4}

# Fixed tag value lists of the tagged fixture tables (FIXTURES.md); None = tag absent.
WAY_TAGS = [
    ("highway", 4001, ["motorway", "motorway_link", "trunk", "primary", "secondary", "tertiary", "residential",
                       "living_street", "service", "track", "footway", "steps", "construction", None]),
    ("route", 3001, [None, None, None, None, "ferry", None, "shuttle_train"]),
    ("bridge", 3011, [None, None, None, None, "movable"]),
    ("duration", 3019, [None, None, "00:10", "01:02:03", "PT5M"]),
    ("access", 3023, [None, None, None, "yes", "no", "private", "destination", "permissive"]),
    ("motor_vehicle:forward", 3037, [None, None, None, None, "no", "delivery"]),
    ("bicycle", 3041, [None, None, None, "yes", "no", "dismount"]),
    ("foot", 3049, [None, None, "yes", "no"]),
    ("oneway", 3061, [None, None, "yes", "no", "-1", "reversible", "alternating"]),
    ("oneway:bicycle", 3067, [None, None, None, "no", "yes"]),
    ("cycleway", 3079, [None, None, None, "lane", "opposite"]),
    ("junction", 3083, [None, None, None, "roundabout", "circular"]),
    ("maxspeed", 3089, [None, "50", "30 mph", "FR:urban", "de:motorway", "none", "walk"]),
    ("maxspeed:forward", 3109, [None, None, None, "70"]),
    ("maxheight", 3119, [None, None, "1.8", "2,1 m", "6'10\"", "default"]),
    ("maxwidth", 3121, [None, None, None, "1.9", "narrow", "2.5"]),
    ("maxweight", 3137, [None, None, "1.5", "3500 kg", "4000 lbs"]),
    ("maxlength", 3163, [None, None, None, "4.5", "12"]),
    ("surface", 3167, [None, "asphalt", "gravel", "cobblestone", "mud"]),
    ("tracktype", 3169, [None, None, "grade1", "grade5"]),
    ("smoothness", 3181, [None, None, "bad", "impassable"]),
    ("service", 3187, [None, None, "alley", "driveway", "emergency_access"]),
    ("width", 3191, [None, None, "2.5 m", "7"]),
    ("lanes", 3203, [None, "1", "2", "many"]),
    ("side_road", 3209, [None, None, "yes", "rotary"]),
    ("hov:lanes", 3217, [None, None, None, "designated|designated", "designated|yes"]),
    ("turn:lanes", 3221, [None, None, "left|through|right"]),
    ("toll", 3229, [None, None, None, "yes"]),
    ("tunnel", 3251, [None, None, "yes", "no"]),
    ("name", 3253, [None, "Main Street", "Ring Road"]),
    ("ref", 3257, [None, "A 1;B 7", "US 101"]),
    ("destination", 3259, [None, None, "North;South"]),
    ("destination:ref", 3271, [None, None, "A 59"]),
    ("area", 3299, [None, None, None, None, None, None, "yes"]),
]

NODE_TAGS = [
    ("barrier", 4003, [None, None, "gate", "bollard", "wall", "height_restrictor", "kerb"]),
    ("bollard", 4007, [None, "rising"]),
    ("kerb", 4013, [None, "lowered"]),
    ("maxheight", 4019, [None, "1.9", "3"]),
    ("access", 4021, [None, None, None, "no", "private"]),
    ("highway", 4027, [None, "traffic_signals", "crossing"]),
]


def _lit(value: str | None, dialect: str) -> str:
    if value is None:
        return "NULL"
    esc = "\\'" if dialect == "spark" else "''"
    return "'" + value.replace("'", esc) + "'"


def _pick(mult: int, values: list, dialect: str) -> str:
    whens = " ".join(
        f"WHEN {i} THEN {_lit(v, dialect)}" for i, v in enumerate(values) if v is not None
    )
    return f"CASE (p_partkey * {mult} % 10007) % {len(values)} {whens} END"


def tagged_sql(spec: list, id_name: str, where: str, dialect: str) -> str:
    """Tag table: a map column in Spark, one column per tag in DuckDB."""
    if dialect == "spark":
        pairs = ", ".join(f"'{k}', {_pick(a, vals, dialect)}" for k, a, vals in spec)
        body = f"map_filter(map({pairs}), (k, v) -> v IS NOT NULL) AS tags"
    else:
        body = ", ".join(f'{_pick(a, vals, dialect)} AS "{k}"' for k, a, vals in spec)
    return f"SELECT p_partkey AS {id_name}, {body} FROM part{where}"


# rows of a tagged table that a task makes and a file holds: few, since the rules over the tags cost far more than their bytes tell
TAGGED_ROWS = 2_500


def spread_parts(spark: SparkSession) -> str:
    """The part keys dealt over tasks by their counted number (up to a few tasks a core, then 20 times the rows a task): a small file is read by one task alone."""
    rows = spark.table("part").count()
    tasks = max(1, -(-rows // (20 * TAGGED_ROWS)), min(-(-rows // TAGGED_ROWS), 4 * spark.sparkContext.defaultParallelism))
    return f"(SELECT /*+ REPARTITION({tasks}, p_partkey) */ p_partkey FROM part) part"


def ways_sql(dialect: str) -> str:
    return tagged_sql(WAY_TAGS, "way_id", "", dialect)


def node_tags_sql(dialect: str) -> str:
    # every part is a node and carries node tags
    return tagged_sql(NODE_TAGS, "node_id", "", dialect)


def _duck(sql: str) -> str:
    # DuckDB spells the string type VARCHAR
    return sql.replace("AS STRING", "AS VARCHAR")


DEPENDS = {"areas": ["nodes"]}
ORDER = ["sites", "postal", "legs", "versions", "way_nodes", "nodes", "turns", "relations",
         "relation_members", "raster", "areas", "ways", "node_tags"]


def with_clause(*names: str) -> str:
    """``WITH`` clause that defines the named fixtures for the DuckDB oracle."""
    wanted = set()
    for n in names:
        wanted.add(n)
        wanted.update(DEPENDS.get(n, []))
    parts = []
    for n in ORDER:
        if n not in wanted:
            continue
        if n == "ways":
            body = ways_sql("duckdb")
        elif n == "node_tags":
            body = node_tags_sql("duckdb")
        else:
            body = _duck(SQL[n])
        parts.append(f"{n} AS ({body.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    for t in RAW_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def register_fixtures(spark: SparkSession, sf_dir: str) -> None:
    """Register raw tables and every fixture view in the session."""
    register_tables(spark, sf_dir)
    parts = spread_parts(spark)
    for n in ORDER:
        if n == "ways":
            body = ways_sql("spark").replace(" FROM part", f" FROM {parts}")
        elif n == "node_tags":
            body = node_tags_sql("spark").replace(" FROM part", f" FROM {parts}")
        else:
            body = SQL[n]
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {n} AS {body}")


_STORED: dict = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture as a stored table: derived from the driver tables and written once per
    session as parquet into the shared checkpoint folder on first use, then read back (an
    input table with column pruning and pushed filters, not a plan recomputed at every reference)."""
    from odspark.sources.files import scratch_dir
    key = "odspark.fixtures.dir"
    if spark.conf.get(key, None) != sf_dir or not spark.catalog.tableExists(name):
        register_fixtures(spark, sf_dir)
        spark.conf.set(key, sf_dir)
    skey = (id(spark.sparkContext._jsc), spark.sparkContext.applicationId, sf_dir, name)
    df = _STORED.get(skey)
    if df is None:
        path = scratch_dir(spark, f"fixture-{name}")
        spark.table(name).write.mode("overwrite").parquet(path)
        df = _STORED[skey] = spark.read.parquet(path)
    return df
