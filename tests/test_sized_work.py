"""Work that follows the counted rows: tasks, passes over the input and the side that is searched from."""

import math

from pyspark.sql import functions as F

from odspark.operators import answers, common, pairs, versions
from odspark.plans import network as N
from odspark.plans import paths as P
from odspark.sources import fixtures


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_route_table_searches_from_the_smaller_side(spark, monkeypatch):
    e = spark.createDataFrame([(k, k + 1, 6.0 + k / 100, 48.0, 6.0 + (k + 1) / 100, 48.0, float(k % 5 + 1), 10.0 + k) for k in range(30)],
                              "source long, target long, source_lon double, source_lat double, target_lon double, target_lat double, duration_s double, distance_m double")
    many = spark.createDataFrame([(f"a{k}", k) for k in range(20)] + [("none", None)], "key string, node_id long")
    few = spark.createDataFrame([("z", 25), ("y", 3), ("y2", 3)], "key string, node_id long")
    started, search = [], P.shortest_paths
    monkeypatch.setattr(P, "shortest_paths", lambda edges, origins, *a: started.append(origins.count()) or search(edges, origins, *a))
    found = _rows(P.route_table(e, many, few))
    assert started == [2]
    want = [(f"a{k}", t, float(sum(10 + x for x in range(k, n))), float(sum(x % 5 + 1 for x in range(k, n))))
            for k in range(20) for t, n in (("z", 25), ("y", 3), ("y2", 3)) if k <= n]
    assert found == sorted(want)
    assert _rows(P.route_table(e, few, many)) == sorted(("z" if n == 25 else t, f"a{k}", float(sum(10 + x for x in range(n, k))), float(sum(x % 5 + 1 for x in range(n, k))))
                                                        for k in range(20) for t, n in (("z", 25), ("y", 3), ("y2", 3)) if n <= k)
    assert started == [2, 2]


def test_edges_of_a_table_come_from_one_pass(spark):
    segs = spark.createDataFrame([(1, 1, 10, 11, 6.0, 48.0, 6.1, 48.0, 100.0), (1, 2, 11, 12, 6.1, 48.0, 6.2, 48.0, 300.0), (2, 1, 10, 12, 6.0, 48.0, 6.2, 48.0, 50.0),
                                  (3, 1, 10, 12, 6.0, 48.0, 6.2, 48.0, 50.0)],
                                 "way_id long, seq long, from_node long, to_node long, from_lon double, from_lat double, to_lon double, to_lat double, distance_m double")
    ways = spark.createDataFrame([(1, True, "driving", "driving", 36.0, 0.0, None, None, 40.0, None, ["a"], ["b"]), (2, True, "driving", "inaccessible", 36.0, 36.0, None, None, 0.0, None, [], []),
                                  (3, True, "inaccessible", None, 36.0, 36.0, None, None, 0.0, None, [], [])],
                                 "way_id long, alive boolean, forward_mode string, backward_mode string, forward_speed double, backward_speed double, forward_rate double, backward_rate double, "
                                 "duration double, weight double, forward_classes array<string>, backward_classes array<string>")
    e = N.directed_edges(segs, ways)
    assert "Union" not in _plan(e) and "Union" not in _plan(N.node_degree(e))
    assert _rows(e.select("way_id", "seq", "forward", "source", "target", "duration_s", F.concat_ws(",", "classes"))) == [
        (1, 1, False, 11, 10, 10.0, "b"), (1, 1, True, 10, 11, 10.0, "a"), (1, 2, False, 12, 11, 30.0, "b"), (1, 2, True, 11, 12, 30.0, "a"), (2, 1, True, 10, 12, 5.0, "")]
    assert _rows(N.node_degree(e)) == [(10, 2), (11, 1), (12, 2)]
    assert _rows(N.open_ways(ways).select("way_id")) == [(1,), (2,)]


def test_tagged_tables_are_made_by_several_tasks(spark):
    s = spark.newSession()
    s.range(6_000).withColumnRenamed("id", "p_partkey").createOrReplaceTempView("part")
    made = s.sql(fixtures.ways_sql("spark").replace(" FROM part", f" FROM {fixtures.spread_parts(s)}"))
    assert made.rdd.getNumPartitions() == 3 and made.count() == 6_000


def test_places_of_areas_meet_way_nodes_once(spark):
    areas = spark.createDataFrame([(k, "industrial", 100.0 + k, 8.0, 50.0) for k in range(40)] + [(0, "industrial", 100.0, 8.0, 50.0), (90, "industrial", 400.0, 8.0, 50.0003),
                                   (90, "industrial", 400.0, 8.0, 50.0006), (91, "industrial", None, 8.0, 50.0), (92, "forest", 900.0, 8.0, 50.0)],
                                  "area_id long, type string, area double, lon double, lat double")
    places = N.area_places(areas.where("type = 'industrial'"))
    assert places.count() == 3
    ways = spark.createDataFrame([(1, {"highway": "primary"}), (2, {"highway": "primary"})], "way_id long, tags map<string,string>")
    nodes = spark.createDataFrame([(1, 8.0, 50.0), (2, 8.0, 50.0003), (3, 9.0, 50.0)], "node_id long, lon double, lat double")
    way_nodes = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 1, 3)], "way_id long, seq long, node_id long")
    found = _rows(N.industrial_speed(ways, way_nodes, nodes, areas))
    val = sum(math.sqrt(100 + k) for k in range(40)) + 20
    assert found == [(1, round(val, 6), round(20 / math.log10(val), 6)), (2, None, 20.0)]


def test_an_index_is_not_made_twice(spark, monkeypatch):
    rows = spark.createDataFrame([(f"k{k}", "p", k) for k in range(9)], "key1 string, key2 string, row_index long")
    monkeypatch.setattr(pairs, "with_row_index", None)
    assert [r.chunk for r in pairs.chunk_requests(rows, 4).orderBy("row_index").collect()] == [0, 0, 0, 0, 1, 1, 1, 1, 2]


def test_answers_are_dealt_over_counted_tasks(spark):
    assert common.tasks_for(spark, 10 ** 9) == 2_000 and common.tasks_for(spark, 1) == spark.sparkContext.defaultParallelism
    legs = spark.createDataFrame([("a", "1", 5.0, 9.0), ("a", "1", 4.0, 9.0), ("a", "1", 1.0, 9.5), ("b", "1", None, 2.0), (None, "2", 1.0, 1.0)], "key1 string, key2 string, distance_m double, duration_s double")
    best = answers.best_legs(legs, 23)
    assert best.rdd.getNumPartitions() == 23
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, best.collect())) == sorted(map(key, answers.best_legs(legs).collect()))
    requests = spark.createDataFrame([("a", "1"), ("a", "1"), ("c", "1"), (None, "2")], "key1 string, key2 string")
    assert sorted(map(key, answers.attach_legs(requests, legs, 23).collect())) == sorted(map(key, answers.attach_legs(requests, legs).collect()))


def test_lost_lookups_take_one_pass(spark):
    results = spark.createDataFrame([("a", "1", 1.0, 1.0), ("x", "1", 1.0, 1.0), ("x", "9", 1.0, 1.0), (None, None, 1.0, 1.0)], "key1 string, key2 string, distance double, duration double")
    sites, postal = spark.createDataFrame([("a",), ("a",), (None,)], "kh_key string"), spark.createDataFrame([("1",)], "plz string")
    lost = versions.lost_lookup_rows(results, sites, postal)
    assert "Union" not in _plan(lost)
    assert sorted((str(r.kh_key), str(r.plz), r.missing) for r in lost.collect()) == [
        ("None", "None", "kh_key"), ("None", "None", "plz"), ("x", "1", "kh_key"), ("x", "9", "kh_key"), ("x", "9", "plz")]


def test_way_rules_for_edges_give_only_the_columns_of_edges(spark):
    from odspark.plans import network, ways
    from odspark.plans.profiles import CAR

    tagged = spark.createDataFrame([(1, {"highway": "primary", "name": "x"}), (2, {"highway": "footway"}), (3, {"highway": "residential", "oneway": "yes", "maxspeed": "30"}),
                                    (3, {"highway": "residential", "oneway": "yes", "maxspeed": "30"})], "way_id long, tags map<string,string>")
    few = ways.car_ways(tagged, CAR, network.EDGE_COLUMNS)
    assert few.columns == network.EDGE_COLUMNS
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(few) == rows(ways.car_ways(tagged, CAR).select(*network.EDGE_COLUMNS))


def test_node_rules_of_barriers_and_lights_run_once(spark):
    from odspark.plans import network

    edges = spark.createDataFrame([(1, 2), (2, 1), (1, 3), (3, 4), (4, 4)], "source long, target long")
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    nodes = spark.createDataFrame([(2, True, False), (4, False, True), (4, False, True), (1, False, None), (9, None, None)], "node_id long, barrier boolean, traffic_lights boolean")
    got = network.without_barriers(edges, nodes.mapInArrow(counted, nodes.schema)).select("source", "target", "target_traffic_light").collect()
    assert sorted(map(tuple, got)) == [(1, 3, False), (3, 4, True), (3, 4, True), (4, 4, True), (4, 4, True)]
    assert runs.value == 5


def test_paths_to_all_nodes_are_read_not_stored(spark, monkeypatch, tmp_path):
    line = [(a, b, 6.0 + a / 100, 50.0, 1.0, 2.0) for k in range(199) for a, b in ((k, k + 1), (k + 1, k))]
    e = spark.createDataFrame(line, "source long, target long, source_lon double, source_lat double, duration_s double, distance_m double")
    starts = (0, 60, 61, 130, 199)
    want = sorted((s, n, float(abs(s - n)), 2.0 * abs(s - n)) for s in starts for n in range(200))
    for name, block_edges, rows in (("one", 1_000, 0), ("many", 100, len(want) // 2)):
        monkeypatch.setattr(P, "scratch_dir", lambda s, kind, name=name: str(tmp_path / name))
        found = P.shortest_paths(e, spark.createDataFrame([(s,) for s in starts], "node long"), block_edges=block_edges)
        assert _rows(found) == want
        stored = spark.read.parquet(str(tmp_path / name)).where("NOT leaves").count() if (tmp_path / name).exists() else 0
        assert stored <= rows


def test_a_table_that_a_task_holds_is_searched_without_stored_path_rows(spark, monkeypatch):
    # more edges than a block; a hub with many edges into it, and an edge of unknown length
    line = [(k, k + 1, 1.0, 2.0) for k in range(300)] + [(k, 500, 400.0 - k, 1.0) for k in range(300)] + [(500, 501, 1.0, None), (7, None, 1.0, 1.0), (600, 0, None, 1.0)]
    e = spark.createDataFrame(line, "source long, target long, duration_s double, distance_m double")
    monkeypatch.setattr(P, "BLOCK_EDGES", 100)
    made = []
    monkeypatch.setattr(P, "scratch_dir", lambda s, kind: made.append(kind))
    starts = spark.createDataFrame([(0,), (290,), (700,)], "node long")
    want = {(0, n): (float(n), 2.0 * n) for n in range(301)} | {(290, n): (float(n - 290), 2.0 * (n - 290)) for n in range(290, 301)}
    want |= {(0, 500): (400.0, 1.0), (0, 501): (401.0, None), (290, 500): (110.0, 1.0), (290, 501): (111.0, None), (700, 700): (0.0, 0.0)}
    rows = lambda df: {(r.origin, r.node): (r.duration_s, r.distance_m) for r in df.collect()}
    assert rows(P.shortest_paths(e, starts)) == want
    some = {500, 300, 700}
    assert rows(P.shortest_paths(e, starts, spark.createDataFrame([(n,) for n in some], "node long"))) == {k: v for k, v in want.items() if k[1] in some}
    assert rows(P.shortest_paths(e, starts, None, 100.0)) == {k: v for k, v in want.items() if v[0] <= 100}
    assert made == []
