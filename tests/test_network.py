"""Network jobs against brute force on small inputs."""

import heapq
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF001, ways_df
from odspark.functions.geo import EARTH_RADIUS_M
from odspark.plans import network as N
from odspark.plans import paths as P
from odspark.plans import relations as L
from odspark.registry import network as NW


def dijkstra(edges, src):
    adj = {}
    for u, v, d, m in edges:
        adj.setdefault(u, []).append((v, d, m))
    best = {src: (0.0, 0.0)}
    heap = [(0.0, 0.0, src)]
    while heap:
        d, m, u = heapq.heappop(heap)
        if (d, m) > best.get(u, (math.inf, math.inf)):
            continue
        for v, dd, mm in adj.get(u, []):
            cand = (d + dd, m + mm)
            if cand < best.get(v, (math.inf, math.inf)):
                best[v] = cand
                heapq.heappush(heap, (cand[0], cand[1], v))
    return best


def test_shortest_paths_match_dijkstra(spark):
    e, nn = NW.car_network(spark, SF001)
    rows = [(r.source, r.target, r.duration_s, r.distance_m) for r in e.collect()]
    origins = sorted({r[0] for r in rows})[:5]
    o = spark.createDataFrame([(x,) for x in origins], "node long")
    got = {(r.origin, r.node): (r.duration_s, r.distance_m) for r in P.shortest_paths(e, o).collect()}
    want = {}
    for s in origins:
        for node, v in dijkstra(rows, s).items():
            want[(s, node)] = v
    assert set(got) == set(want)
    for k, v in want.items():
        assert abs(got[k][0] - v[0]) < 1e-6


def test_duration_bound_is_a_prefix(spark):
    e, _ = NW.car_network(spark, SF001)
    o = e.select(F.col("source").alias("node")).distinct().limit(3)
    full = {(r.origin, r.node): r.duration_s for r in P.shortest_paths(e, o).collect()}
    cut = {(r.origin, r.node): r.duration_s for r in P.shortest_paths(e, o, max_duration_s=60).collect()}
    assert all(abs(full[k] - v) < 1e-9 for k, v in cut.items())
    assert {k for k, v in full.items() if v <= 60} == set(cut)


def hav(lon1, lat1, lon2, lat2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(1.0, a)))


def test_snap_is_exact(spark):
    nodes = spark.createDataFrame([(1, 6.0, 50.0), (2, 6.3, 50.2), (3, 9.0, 53.0), (4, 12.5, 48.1)],
                                  "node_id long, lon double, lat double")
    pts = spark.createDataFrame([("a", 6.1, 50.05), ("b", 11.0, 49.0), ("c", 14.9, 54.4)],
                                "key string, longitude double, latitude double")
    got = {r.key: r.node_id for r in N.snap_points(pts, nodes).collect()}
    assert got == {r.key: r.node_id for r in N.snap_points(pts, nodes, leaf_nodes=1).collect()}
    nl = [(r.node_id, r.lon, r.lat) for r in nodes.collect()]
    for r in pts.collect():
        want = min(nl, key=lambda n: (hav(r.longitude, r.latitude, n[1], n[2]), n[0]))[0]
        assert got[r.key] == want


def test_relations_refs(spark):
    rels = spark.createDataFrame([(1, "route", "road", "north", "US 101 Coast", "US 101"),
                                  (2, "route", "road", None, "Ring B", "B 7"),
                                  (10, "route", None, "east", None, None)],
                                 "rel_id long, type string, route string, direction string, name string, ref string")
    members = spark.createDataFrame([(1, "way", 7, "forward"), (2, "way", 7, "south"), (10, "relation", 2, "")],
                                    "rel_id long, member_type string, member_id long, role string")
    ways = spark.createDataFrame([(7, "US 101;B 7"), (8, None)], "way_id long, ref string")   # the car result names the way's ref
    wr = {r.rel_id: r for r in L.way_route_relations(rels, members).collect()}
    assert wr[1].route_direction == "north" and wr[1].route_forward is True
    # own role direction (south) conflicts with the parent's east → no direction
    assert wr[2].route_direction is None
    refs = L.way_refs(L.match_refs(ways, L.way_route_relations(rels, members))).collect()
    assert refs[0].forward_ref == "US 101 $north; B 7" and refs[0].backward_ref == "US 101; B 7"


def test_ascii_grid_source(spark):
    import os

    from odspark.sources import files
    folder = files.scratch_dir(spark, "grid")
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/raster.asc", "w") as fh:
        fh.write("0 1 2 3\n10 11 x 13\n\n20 21 22 23\n")
    cells = {(r.row, r.col): r.datum for r in N.read_ascii_grid(spark, f"{folder}/raster.asc").collect()}
    assert cells[(0, 3)] == 3 and cells[(1, 2)] is None and cells[(2, 1)] == 21 and len(cells) == 12


def test_grid_rows_over_several_splits(spark):
    import os

    from odspark.sources import files
    folder = files.scratch_dir(spark, "grid")
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/raster.asc", "w") as fh:
        for k in range(900):
            fh.write("\n" * (k % 3 == 0) + f" {k}\t{k + 1}  {k + 2} \n")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        cells = N.read_ascii_grid(spark, f"{folder}/raster.asc")
        rows = cells.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert len(rows) == 2700 and all(r.datum == r.row + r.col for r in rows)


def test_only_repeated_ids_are_compared(spark):
    a = spark.createDataFrame([(k, "a") for k in range(70000)] + [(5, "0"), (None, "n")], "way_id long, tag string")
    b = spark.createDataFrame([(k, "b") for k in range(69990, 80000)] + [(-3, "neg"), (-3, "minus")], "way_id long, tag string")
    c = spark.createDataFrame([(75000, "c"), (90000, "c")], "way_id long, tag string")
    bits = N.repeated_ids(a, b, c)
    assert bits.selectExpr("sum(bitmap_count(bits))").first()[0] == 10 + 1 + 1 + 1
    got = {r.way_id: r.tag for r in N.merge_extracts(a, b, c).collect()}
    assert len(got) == 80003 and got[69995] == "a" and got[75000] == "b" and got[90000] == "c" and got[5] == "0" and got[-3] == "minus" and got[None] == "n"
    plain = {r.way_id: r.tag for r in _with_bitmaps(0, lambda: N.merge_extracts(a, b, c)).collect()}
    assert plain == got


def _with_bitmaps(n, make):
    held, N.MAX_BITMAPS = N.MAX_BITMAPS, n
    try:
        return make()
    finally:
        N.MAX_BITMAPS = held


def test_turn_angles(spark):
    # from the south: right, left, straight on, back
    pts = {0: (6.0, 49.9), 1: (6.0, 50.0), 2: (6.1, 50.0), 3: (5.9, 50.0), 4: (6.0, 50.1)}
    rows = [(10 * a + b, 1, True, a, b, *pts[a], *pts[b], "driving") for a, b in ((0, 1), (1, 2), (1, 3), (1, 4), (1, 0))]
    e = spark.createDataFrame(rows, "way_id long, seq long, forward boolean, source long, target long, source_lon double, source_lat double, target_lon double, target_lat double, mode string")
    pairs = spark.createDataFrame([(f"{o}", 1, 1, True, o, 1, True) for o in (12, 13, 14, 10, 1)], "turn_id string, in_way long, in_seq long, in_forward boolean, out_way long, out_seq long, out_forward boolean")
    got = {r.turn_id: r for r in N.turn_rows(e, pairs, spark.createDataFrame([(1,)], "node_id long")).collect()}
    assert set(got) == {"12", "13", "14", "10"}                     # an edge does not meet itself
    assert abs(got["12"].angle - 90) < 0.1 and abs(got["13"].angle + 90) < 0.1 and abs(got["14"].angle) < 1e-6 and abs(got["10"].angle) == 180
    assert got["10"].is_u_turn and not got["14"].is_u_turn and got["12"].number_of_roads == 5 and got["12"].has_traffic_light


def test_snapping_is_exact_on_random_points(spark):
    import random
    r = random.Random(4)
    place = lambda: (r.uniform(-180, 180), r.choice([r.uniform(-90, 90), r.uniform(-89.99, 89.99), r.uniform(50, 51)]))
    nodes = [(k, *place()) for k in range(300)] + [(1000 + k, 8 + r.random() / 100, 50 + r.random() / 100) for k in range(300)]
    pts = [(f"p{k}", *place()) for k in range(200)] + [("q", 8.005, 50.005), ("pole", 0.0, 90.0), ("edge", 180.0, 0.0), ("null", None, 1.0)]
    found = N.snap_points(spark.createDataFrame(pts, "key string, longitude double, latitude double"), spark.createDataFrame(nodes, "node_id long, lon double, lat double"), leaf_nodes=20)
    got = {x.key: (x.node_id, x.snap_m) for x in found.collect()}
    assert len(got) == len(pts) - 1
    for key, lon, lat in pts[:-1]:
        best = min((hav(lon, lat, n[1], n[2]), n[0]) for n in nodes)
        assert abs(got[key][1] - best[0]) < 2e-3 and (got[key][0] == best[1] or abs(hav(lon, lat, *[n[1:] for n in nodes if n[0] == got[key][0]][0]) - best[0]) < 1e-6)


def test_merge_extracts_keeps_one_row_per_way(spark):
    a = ways_df(spark, [{"highway": "primary"}, {"highway": "service"}])
    b = ways_df(spark, [{"highway": "primary"}, {"highway": "service"}, {"name": "x"}])
    assert N.merge_extracts(a, b).count() == 3


def _path_rows(df):
    return {(r.origin, r.node): (r.duration_s, r.distance_m) for r in df.collect()}


def grid_edges(spark, side=14):
    """Roads of a grid of nodes, both ways, with odd durations."""
    rows = []
    for k in range(side * side):
        x, y = k % side, k // side
        for dx, dy in ((1, 0), (0, 1), (-1, 0), (0, -1)):
            if 0 <= x + dx < side and 0 <= y + dy < side and (k * 7 + dx + 2 * dy) % 11:
                to = k + dx + side * dy
                rows.append((k, to, 6 + x / 100, 50 + y / 100, float((k * 37 + to * 11) % 50 + 1), float(k % 9 + 1)))
    return spark.createDataFrame(rows, "source long, target long, source_lon double, source_lat double, duration_s double, distance_m double"), rows


def test_shortest_paths_over_many_blocks(spark):
    e, rows = grid_edges(spark)
    o = spark.createDataFrame([(0,), (95,), (195,)], "node long")
    assert P.edge_blocks(e, 200)[2] > 1
    found = _path_rows(P.shortest_paths(e, o, block_edges=200))
    graph = [(r[0], r[1], r[4], r[5]) for r in rows]
    assert found == {(s, n): v for s in (0, 95, 195) for n, v in dijkstra(graph, s).items()}


def test_shortest_paths_to_targets_only(spark, monkeypatch):
    e, rows = grid_edges(spark)
    monkeypatch.setattr(P, "SMALL_BAND", 8)
    graph = [(r[0], r[1], r[4], r[5]) for r in rows]
    o = spark.createDataFrame([(0,), (95,), (195,)], "node long")
    full = {(s, n): v for s in (0, 95, 195) for n, v in dijkstra(graph, s).items()}
    near = [n for (x, n), _ in sorted(full.items(), key=lambda kv: kv[1]) if x == 95][:20]
    targets = spark.createDataFrame([(n,) for n in near + [-5]], "node long")
    for t, blocks in ((targets, P.BLOCK_EDGES), (targets.where("node >= 0"), P.BLOCK_EDGES), (targets.where("node >= 0"), 200)):
        found = _path_rows(P.shortest_paths(e, o, t, block_edges=blocks))
        assert found == {k: v for k, v in full.items() if k[1] in near}


def test_shortest_paths_with_hubs_ties_and_lone_origins(spark):
    rows = [(0, k, 1.0, 5.0) for k in range(1, 300)] + [(k, 300, 1.0, float(k % 7)) for k in range(1, 300)] + [(300, 0, 0.0, 0.0), (0, 1, 1.0, 4.0), (300, 400, 2.0, 2.0)]
    e = spark.createDataFrame(rows, "source long, target long, duration_s double, distance_m double")
    o = spark.createDataFrame([(0,), (0,), (None,), (400,), (999,)], "node long")
    for blocks in (P.BLOCK_EDGES, 200):
        found = _path_rows(P.shortest_paths(e, o, block_edges=blocks))
        assert found[0, 300] == (2.0, 5.0) and found[0, 1] == (1.0, 4.0) and found[0, 400] == (4.0, 7.0) and found[0, 0] == (0.0, 0.0)
        assert found[400, 400] == (0.0, 0.0) and found[999, 999] == (0.0, 0.0) and len(found) == 304


def test_ref_matching_rules(spark):
    rels = spark.createDataFrame([(1, "route", "road", "north", "A 1 Coast", "B 7"),
                                  (2, "route", "road", "south", "X Y", None),
                                  (3, "route", "bus", "west", None, None),
                                  (4, "route", "road", "east", "Q 9", None)],
                                 "rel_id long, type string, route string, direction string, name string, ref string")
    members = spark.createDataFrame([(1, "way", 0, ""), (2, "way", 1, ""), (3, "way", 1, ""), (4, "way", 2, "backward")],
                                    "rel_id long, member_type string, member_id long, role string")
    ways = spark.createDataFrame([(0, "A 1; B 7"), (1, "X; Y"), (2, "Q 9; Z"), (3, None)], "way_id long, ref string")
    refs = {r.way_id: r for r in L.way_refs(L.match_refs(ways, L.way_route_relations(rels, members))).collect()}
    # name score 3 (A + number 1) is not beaten by the equal ref score of "B 7"
    assert refs[0].forward_ref == "A 1 $north; B 7"
    # tie between X and Y → the earlier token; a relation without name and ref matches nothing
    assert refs[1].forward_ref == "X $south; Y"
    # role backward: only the backward direction is set
    assert refs[2].forward_ref == "Q 9; Z" and refs[2].backward_ref == "Q 9 $east; Z"


def test_cell_join_salting_keeps_pairs(spark):
    left = spark.createDataFrame([(i % 3, 0, i) for i in range(30)], "_cx long, _cy long, a long")
    right = spark.createDataFrame([(i % 2, 0, i) for i in range(50)], "_cx long, _cy long, b long")
    plain = left.join(right, ["_cx", "_cy"])
    salted = N._cell_join(left, right, hot_rows=4)
    assert salted.count() == plain.count()
    assert salted.select("a", "b").exceptAll(plain.select("a", "b")).count() == 0


def test_paths_refuse_negative_durations(spark):
    e = spark.createDataFrame([(1, 2, -1.0, 1.0)], "source long, target long, duration_s double, distance_m double")
    o = spark.createDataFrame([(1,)], "node long")
    with pytest.raises(ValueError, match="negative"):
        P.shortest_paths(e, o)


def test_snapping_far_points_and_across_180_degrees(spark):
    from odspark.plans import network as N
    pts = "key string, longitude double, latitude double"
    nodes = "node_id long, lon double, lat double"
    far = N.snap_points(spark.createDataFrame([("near", 6.001, 50.0), ("far", 12.0, 50.0)], pts),
                        spark.createDataFrame([(1, 6.0, 50.0), (2, 6.0, 50.1)], nodes), leaf_nodes=1)
    # the great circle bends north: the northern node is nearer to the far point
    assert {r.key: r.node_id for r in far.collect()} == {"near": 1, "far": 2}
    date_line = N.snap_points(spark.createDataFrame([("p", 179.95, 0.0), ("q", -179.999, 60.0)], pts),
                              spark.createDataFrame([(1, 179.0, 0.0), (2, -179.99, 0.0), (3, 179.99, 60.0), (4, -170.0, 60.0)], nodes))
    got = {r.key: (r.node_id, r.snap_m) for r in date_line.collect()}
    assert got["p"][0] == 2 and got["p"][1] < 7000 and got["q"][0] == 3
    none = N.snap_points(spark.createDataFrame([("p", 1.0, 1.0)], pts), spark.createDataFrame([], nodes))
    assert [(r.key, r.node_id) for r in none.collect()] == [("p", None)]


def test_industrial_areas_far_north_and_across_180_degrees(spark):
    from odspark.plans import network as N
    ways = ways_df(spark, [{"highway": "residential"}, {"highway": "residential"}])
    way_nodes = spark.createDataFrame([(0, 1, 1), (1, 1, 2)], "way_id long, seq long, node_id long")
    nodes = spark.createDataFrame([(1, 15.0, 78.2), (2, 179.9999, 10.0)], "node_id long, lon double, lat double")
    areas = spark.createDataFrame([(1, "industrial", 10000.0, 15.0043, 78.2), (2, "industrial", 10000.0, -179.9999, 10.0)],
                                  "area_id long, type string, area double, lon double, lat double")
    got = {r.way_id: r.val for r in N.industrial_speed(ways, way_nodes, nodes, areas).collect()}
    assert got == {0: 100.0, 1: 100.0}


def test_slope_of_a_fifth_and_extract_ties(spark):
    from odspark.plans import network as N
    rows = spark.createDataFrame([(1, 1, 1, 2, 100.0, 10.0, 10.0, 0.0, 20.0)], "way_id long, seq long, source long, target long, distance_m double, weight double, duration_s double, _sd double, _td double")
    out = N._scaled(rows, (F.col("_td") - F.col("_sd")) / F.col("distance_m")).first()
    assert (out.weight, out.duration_s) == (10.0, 10.0)
    a, b = (spark.createDataFrame(x, "way_id long, tag string") for x in ([(1, "b"), (1, "a"), (2, "x")], [(1, "0"), (3, "y")]))
    assert sorted((r.way_id, r.tag) for r in N.merge_extracts(a, b).collect()) == [(1, "a"), (2, "x"), (3, "y")]

def test_route_answers_feed_requests(spark):
    df = NW.q_request_answers_from_routes(spark, SF001)
    e, nn = NW.car_network(spark, SF001)
    legs = P.route_table(e, N.snap_points(NW.site_points(spark, SF001), nn),
                         N.snap_points(NW.postal_points(spark, SF001), nn))
    best = {}
    for r in legs.collect():
        k = (r.key1, r.key2)
        best[k] = min(best.get(k, (math.inf, math.inf)), (r.duration_s, r.distance_m))
    answered = [r for r in df.collect() if r.duration is not None]
    assert answered and len(answered) <= df.count()
    for r in answered:
        d, m = best[(r.key1, r.key2)]
        assert abs(r.duration - round(d / 60, 5)) < 1e-9 and abs(r.distance - round(m / 1000, 5)) < 1e-9
