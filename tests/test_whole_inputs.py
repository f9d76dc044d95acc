"""Fixtures take whole tables: every row of the given tables counts, so the network grows with them."""

import duckdb
from pyspark.sql import functions as F

from conftest import SF01

import __spark_entry__ as E
from odspark.functions.units import round5, round_binary
from odspark.registry import network as N
from test_oracle import rows


def raw(spark, name):
    return spark.read.parquet(f"{SF01}/{name}.parquet")


def test_network_takes_whole_part_and_lineitem(spark):
    nodes, wn, ways = (N._fx(spark, SF01, n) for n in ("nodes", "way_nodes", "ways"))
    assert nodes.count() == raw(spark, "part").count()
    assert wn.count() == raw(spark, "lineitem").count()
    assert wn.join(nodes, "node_id", "left_anti").isEmpty() and wn.join(ways, "way_id", "left_anti").isEmpty()
    assert ways.join(wn, "way_id", "left_anti").isEmpty()
    by_way = wn.groupBy("way_id").agg(F.count("*").alias("n"), F.max("seq").alias("last"), F.countDistinct("seq").alias("d"))
    assert by_way.filter("n <> last or n <> d").isEmpty()
    areas = N._fx(spark, SF01, "areas")
    assert areas.count() == raw(spark, "customer").count()
    assert areas.select("lon", "lat").distinct().count() > 500


def test_halves_round_as_in_sql(spark):
    xs = [197796.763 / (80 / 9), 304918.303 / (80 / 9), None, 0.0]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i").select(round_binary(F.col("x"), 6)).collect()]
    assert got == [None if x is None else duckdb.execute("SELECT round(CAST(? AS DOUBLE), 6)", [x]).fetchone()[0] for x in xs]


def test_kilometres_round_by_exact_binary_value(spark):
    xs = [0.123455, 0.123445, 57.123455, 115.922335, 1234567.123455, -57.123455, 2.5, 0.0, 5e-06, 1e-07] + [k / 1e6 for k in range(100015, 130000, 10)]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i").select(round5(F.col("x"))).collect()]
    assert got == [float("%.5f" % x) for x in xs]
    assert spark.range(1).select(round5(F.lit(None).cast("double"))).first()[0] is None


def test_car_edges_of_the_whole_network_match_oracle(spark):
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    df = E.queries()["e2_car_edges"](spark, SF01)
    res = con.execute(E.oracle_sql()["e2_car_edges"])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in res.description], res.fetchall())


def test_relations_and_raster_come_from_given_tables(spark):
    rels, members, raster = (N._fx(spark, SF01, n) for n in ("relations", "relation_members", "raster"))
    orders = raw(spark, "orders")
    assert rels.count() == rels.select("rel_id").distinct().count() == raw(spark, "customer").count() + raw(spark, "supplier").count()
    for kind in ("way", "relation"):
        of = members.filter(F.col("member_type") == kind)
        assert of.count() == of.distinct().count() > 0.9 * orders.count()
        assert of.join(rels, "rel_id", "left_anti").isEmpty()
    subs = members.filter("member_type = 'relation'").select(F.col("member_id").alias("rel_id"))
    assert subs.join(rels, "rel_id", "left_anti").isEmpty()
    # one row for every customer with a directed parent, in both parities
    got = E.queries()["l2_parent_directions"](spark, SF01).collect()
    assert len(got) > 0.9 * orders.select("o_custkey").distinct().count() and {r.super_dir for r in got} == {None, "north", "east", "west"}
    want = {k: float(v % 50) for k, v in raw(spark, "part").groupBy(F.col("p_partkey") % 20).agg(F.sum("p_size")).collect()}
    assert {r.row * 4 + r.col: r.datum for r in raster.collect()} == want | {9: None}
