"""Registered road-network queries (ways, nodes, turns, segments, relations, routes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odspark.functions import tags as T
from odspark.functions.units import round_binary
from odspark.operators import points
from odspark.operators.common import join_sized
from odspark.plans import bicycle as B
from odspark.plans import network as N
from odspark.plans import nodes_turns as K
from odspark.plans import paths as P
from odspark.plans import relations as L
from odspark.plans import ways as W
from odspark.plans.profiles import BICYCLE, BICYCLE_CYCLABILITY, CAR, CAR_DISTANCE, FOOT, TESTBOT, TURNBOT
from odspark.registry import network_sql as S
from odspark.session import cut_lineage
from odspark.sources.files import scratch_dir
from odspark.sources.fixtures import RASTER_BOUNDS, fixture


def _fx(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return fixture(spark, sf, name)


def _r6(c):
    return F.round(c, 6)


# ---- tag helpers --------------------------------------------------------------------------------

def q_tag_parse(spark, sf):
    """G1-G16 and the duration parser as one profile of parsed columns per way."""
    tag = T.tag
    f, b = T.forward_backward_by_set(["motor_vehicle"])
    kmh = T.parse_speed(tag("maxspeed"))
    return _fx(spark, sf, "ways").select(
        "way_id",
        T.first_tag(CAR["access_tags_hierarchy"]).alias("access_first"),
        _r6(kmh).alias("maxspeed_kmh"),
        _r6(T.parse_height(tag("maxheight"))).alias("maxheight_m"),
        _r6(T.parse_meters(tag("maxwidth"))).alias("maxwidth_m"),
        _r6(T.parse_kilograms(tag("maxweight"))).alias("maxweight_kg"),
        _r6(T.parse_meters(tag("maxlength"))).alias("maxlength_m"),
        f.alias("mv_forward"), b.alias("mv_backward"),
        T.directional_tag("destination", True).alias("dest_forward"),
        F.array_join(T.list_tokens(tag("ref")), "|").alias("ref_tokens"),
        F.size(T.tokenize_common(tag("name"))).cast("bigint").alias("name_tokens"),
        T.is_number(tag("lanes")).alias("lanes_is_number"),
        T.all_lanes_designated(tag("hov:lanes")).alias("hov_all_designated"),
        T.by_prefixed_sequence(["bicycle"], "oneway").alias("oneway_bicycle"),
        T.by_postfixed_sequence(["motor_vehicle"], "forward").alias("mv_postfixed"),
        _r6(T.duration_seconds(tag("duration"))).alias("duration_s"),
        _r6(T.limit_speed(F.lit(50.0), F.coalesce(kmh, F.lit(0.0)),
                          F.coalesce(T.parse_speed(tag("maxspeed:forward")), F.lit(0.0)))).alias("speed_limited"),
        T.constant_by_key_value(CAR["speeds"]).cast("double").alias("highway_speed"),
    )


def q_tag_usage(spark, sf):
    """Ways per tag key, most used first."""
    w = _fx(spark, sf, "ways")
    return (w.select(F.explode(F.map_keys("tags")).alias("tag_key")).groupBy("tag_key")
            .agg(F.count(F.lit(1)).alias("n_ways")).orderBy(F.desc("n_ways"), "tag_key"))


# ---- ways ------------------------------------------------------------------------------------------

def car_result(spark, sf):
    return W.car_ways(_fx(spark, sf, "ways"), CAR)


def testbot_result(spark, sf):
    return B.testbot_ways(_fx(spark, sf, "ways"), TESTBOT)


def q_car_ways(spark, sf):
    return W.flat_result(car_result(spark, sf))


def q_car_routable(spark, sf):
    return W.routable(car_result(spark, sf)).select("way_id", "forward_mode", "backward_mode")


def q_foot_ways(spark, sf):
    return W.flat_result(W.foot_ways(_fx(spark, sf, "ways"), FOOT))


def q_bicycle_ways(spark, sf):
    return W.flat_result(B.bicycle_ways(_fx(spark, sf, "ways"), BICYCLE))


def q_bicycle_cyclability(spark, sf):
    """Bicycle ways weighted by cyclability (rates and weight from the safety penalties)."""
    return W.flat_result(B.bicycle_ways(_fx(spark, sf, "ways"), BICYCLE_CYCLABILITY))


def q_testbot_ways(spark, sf):
    r = testbot_result(spark, sf)
    return r.select("way_id", "forward_mode", "backward_mode", _r6(F.col("forward_speed")).alias("forward_speed"),
                    _r6(F.col("backward_speed")).alias("backward_speed"), _r6(F.col("duration")).alias("duration"),
                    "name", F.array_join("forward_classes", ",").alias("classes"), "roundabout")


# ---- nodes and turns ---------------------------------------------------------------------------------

def q_car_nodes(spark, sf):
    return K.car_nodes(_fx(spark, sf, "node_tags"), CAR)


def q_bicycle_nodes(spark, sf):
    return K.bicycle_nodes(_fx(spark, sf, "node_tags"), BICYCLE)


def q_foot_nodes(spark, sf):
    return K.foot_nodes(_fx(spark, sf, "node_tags"), FOOT)


def _turns(fn, profile):
    def q(spark, sf):
        t = fn(_fx(spark, sf, "turns"), profile)
        return t.select("turn_id", _r6(F.col("duration")).alias("duration"), _r6(F.col("weight")).alias("weight"))
    q.__name__ = f"q_{fn.__name__}"
    return q


# ---- network ---------------------------------------------------------------------------------------

def segs(spark, sf):
    return N.segments(_fx(spark, sf, "way_nodes"), _fx(spark, sf, "nodes"))


def edges_of(spark, sf, ways: DataFrame) -> DataFrame:
    """Directed edges of the ways. Ways and segments are each written once; nodes are looked up for the open ways alone, the others give no edge."""
    ways = cut_lineage(N.open_ways(ways).select(*N.EDGE_COLUMNS))
    nodes_of = join_sized(_fx(spark, sf, "way_nodes"), ways.select("way_id"), "way_id", "left_semi")
    return N.directed_edges(cut_lineage(N.segments(nodes_of, _fx(spark, sf, "nodes"))), ways)


def car_edges(spark, sf):
    # the rules for names, lanes and the like give no column of an edge
    return edges_of(spark, sf, W.car_ways(_fx(spark, sf, "ways"), CAR, N.EDGE_COLUMNS))


def testbot_edges(spark, sf):
    tb = testbot_result(spark, sf).withColumn("forward_rate", F.lit(None).cast("double")) \
        .withColumn("backward_rate", F.lit(None).cast("double")).withColumn("weight", F.lit(None).cast("double"))
    return edges_of(spark, sf, tb)


def q_segments(spark, sf):
    return segs(spark, sf).select("way_id", "seq", "from_node", "to_node", "distance_m")


def _edge_cols(e):
    return e.select("way_id", "seq", "forward", "source", "target", "mode", "distance_m", "duration_s", "weight",
                    F.array_join(F.col("classes"), ",").alias("classes"))


def q_car_edges(spark, sf):
    return _edge_cols(car_edges(spark, sf))


def q_testbot_edges(spark, sf):
    return _edge_cols(testbot_edges(spark, sf))


def q_edges_no_barriers(spark, sf):
    e = N.without_barriers(car_edges(spark, sf), K.car_nodes(_fx(spark, sf, "node_tags"), CAR))
    return e.select("way_id", "seq", "forward", "source", "target", "duration_s", "target_traffic_light")


def q_exclude_toll(spark, sf):
    """Car edges without the excludable classes toll and motorway."""
    e = B.exclude_classes(car_edges(spark, sf), ["toll", "motorway"])
    return e.select("way_id", "seq", "forward", "source", "target")


def q_node_degree(spark, sf):
    return N.node_degree(car_edges(spark, sf))


def given_turns(edges: DataFrame) -> DataFrame:
    """Turn rows to price: from every directed edge on to the next segment of its way, and back along itself."""
    e = edges.select(F.col("way_id").alias("in_way"), F.col("seq").alias("in_seq"), F.col("forward").alias("in_forward"))
    onward = e.select("*", F.col("in_way").alias("out_way"), F.when(F.col("in_forward"), F.col("in_seq") + 1).otherwise(F.col("in_seq") - 1).alias("out_seq"), F.col("in_forward").alias("out_forward"))
    back = e.select("*", F.col("in_way").alias("out_way"), F.col("in_seq").alias("out_seq"), (~F.col("in_forward")).alias("out_forward"))
    return onward.union(back).withColumn("turn_id", F.concat_ws(":", "in_way", "in_seq", F.col("in_forward").cast("int"), "out_seq", F.col("out_forward").cast("int")))


def turns_of(spark, sf):
    # read once by each side of the turns
    e = cut_lineage(car_edges(spark, sf).drop("distance_m", "duration_s", "weight", "classes"))
    lights = K.car_nodes(_fx(spark, sf, "node_tags"), CAR).where("traffic_lights")
    return N.turn_rows(e, given_turns(e), lights)


def q_turn_angles(spark, sf):
    """Angle, roads, light and U-turn of the given turns."""
    return turns_of(spark, sf).select("turn_id", "node_id", F.round("angle", 6).alias("angle"), "number_of_roads", "has_traffic_light", "is_u_turn", "source_mode", "target_mode")


def q_turn_costs(spark, sf):
    """E4 → R1: the given turns priced by the car's turn rule."""
    t = K.car_turns(turns_of(spark, sf), CAR)
    return t.select("turn_id", F.round("duration", 5).alias("duration"), F.round("weight", 5).alias("weight"))


def car_distance_result(spark, sf):
    return W.car_ways(_fx(spark, sf, "ways"), CAR_DISTANCE)


def q_car_distance(spark, sf):
    """W27 + W28: the car weighted by distance, with the turn classes of its ways."""
    r = car_distance_result(spark, sf)
    return W.flat_result(r).join(r.select("way_id", "highway_turn_classification", "access_turn_classification"), "way_id")


def q_class_turns(spark, sf):
    """W28 → E4 → R1: given turns with the classes of both ways; steps down the classes cost weight. Turns also lead from each way's last segment to the ways that start there."""
    ways = W.car_ways(_fx(spark, sf, "ways"), CAR_DISTANCE, [*N.EDGE_COLUMNS, "highway_turn_classification", "access_turn_classification"])
    e = cut_lineage(edges_of(spark, sf, ways).drop("distance_m", "duration_s", "weight", "classes"))
    first = e.where("forward AND seq = 1").select(F.col("way_id").alias("out_way"), F.col("seq").alias("out_seq"), F.col("forward").alias("out_forward"), F.col("source").alias("at"))
    last = e.where("forward").groupBy("way_id").agg(F.max_by("target", "seq").alias("at"), F.max("seq").alias("in_seq"))
    over = last.select(F.col("way_id").alias("in_way"), "in_seq", F.lit(True).alias("in_forward"), "at").join(first, "at").drop("at")
    over = over.withColumn("turn_id", F.concat_ws(":", "in_way", "out_way"))
    t = K.class_turns(N.with_turn_classes(N.turn_rows(e, over), ways), CAR_DISTANCE, ("source_highway_class", "target_highway_class"))
    return t.select("turn_id", "source_highway_class", "target_highway_class", F.round("duration", 5).alias("duration"), F.round("weight", 5).alias("weight"))


# columns of the registered grid text
GRID_COLS = 25


def q_ascii_grid(spark, sf):
    """Q3: a grid of part sizes written as text in several files and read back with its row numbers."""
    parts = spark.read.parquet(f"{sf}/part.parquet")
    cells = parts.select(F.floor(F.col("p_partkey") / GRID_COLS).alias("r"), (F.col("p_partkey") % GRID_COLS).alias("c"),
                         F.when(F.col("p_size") % 7 == 0, F.lit("x")).otherwise(F.col("p_size").cast("string")).alias("t"))
    lines = cells.groupBy("r").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c", "t"))), lambda x: x["t"]), " ").alias("value"))
    path = scratch_dir(spark, "grid")
    lines.repartitionByRange(6, "r").sortWithinPartitions("r").select("value").write.text(path)
    return N.read_ascii_grid(spark, path)


def rasterbot_edges(spark, sf):
    """Rasterbot ways: every way cycling at 15 km/h both ways."""
    w = _fx(spark, sf, "ways").select("way_id", F.lit(True).alias("alive"), F.lit("cycling").alias("forward_mode"),
                                      F.lit("cycling").alias("backward_mode"), F.lit(15.0).alias("forward_speed"),
                                      F.lit(15.0).alias("backward_speed"),
                                      F.lit(None).cast("double").alias("forward_rate"),
                                      F.lit(None).cast("double").alias("backward_rate"),
                                      F.lit(0.0).alias("duration"), F.lit(None).cast("double").alias("weight"),
                                      F.array().cast("array<string>").alias("forward_classes"),
                                      F.array().cast("array<string>").alias("backward_classes"))
    return N.directed_edges(segs(spark, sf), w)


def q_raster_nearest(spark, sf):
    return N.raster_slope_nearest(rasterbot_edges(spark, sf), _fx(spark, sf, "raster"), RASTER_BOUNDS)


def q_raster_interpolated(spark, sf):
    return N.raster_slope_interpolated(rasterbot_edges(spark, sf), _fx(spark, sf, "raster"), RASTER_BOUNDS)


def q_industrial_speed(spark, sf):
    return N.industrial_speed(_fx(spark, sf, "ways"), _fx(spark, sf, "way_nodes"), _fx(spark, sf, "nodes"),
                              _fx(spark, sf, "areas"))


def car_network(spark, sf):
    """Car edges without barrier nodes (materialized once) and the nodes they touch."""
    e = N.without_barriers(car_edges(spark, sf), K.car_nodes(_fx(spark, sf, "node_tags"), CAR))
    e = cut_lineage(e)
    ids = e.select(F.explode(F.array("source", "target")).alias("node_id")).distinct()
    return e, _fx(spark, sf, "nodes").join(ids, "node_id", "left_semi")


def network_nodes(spark, sf):
    """Nodes that carry at least one car edge."""
    e = car_edges(spark, sf)
    ids = e.select(F.explode(F.array("source", "target")).alias("node_id")).distinct()
    return _fx(spark, sf, "nodes").join(ids, "node_id", "left_semi")


def site_points(spark, sf):
    s = points.site_points(_fx(spark, sf, "sites"))
    return points.as_points(s, "kh_key", "longitude", "latitude").distinct()


def postal_points(spark, sf):
    p = points.postal_points(_fx(spark, sf, "postal"))
    return points.as_points(p, "plz", "longitude_plz", "latitude_plz")


def q_snap_sites(spark, sf):
    return N.snap_points(site_points(spark, sf), network_nodes(spark, sf))


def q_snap_postal(spark, sf):
    return N.snap_points(postal_points(spark, sf), network_nodes(spark, sf))


def q_routes(spark, sf):
    """Least-duration paths from every snapped site node over the car edges."""
    e, nn = car_network(spark, sf)
    origins = N.snap_points(site_points(spark, sf), nn).select(F.col("node_id").alias("node"))
    sp = P.shortest_paths(e, origins)
    return sp.select("origin", "node", round_binary(F.col("duration_s"), 3).alias("duration_s"),
                     round_binary(F.col("distance_m"), 3).alias("distance_m"))


def q_route_answers(spark, sf):
    """Request legs (key1, key2, distance_m, duration_s) from snapped points and E6."""
    e, nn = car_network(spark, sf)
    return P.route_table(e, N.snap_points(site_points(spark, sf), nn), N.snap_points(postal_points(spark, sf), nn))


def q_request_answers_from_routes(spark, sf):
    """E7 → J8: the J1 request rows answered from the car network (legs in millimetres and milliseconds) instead of the leg table."""
    from odspark.operators import answers, pairs
    requests = pairs.request_pairs(points.site_points(_fx(spark, sf, "sites")),
                                   points.postal_points(_fx(spark, sf, "postal")))
    return answers.attach_legs(requests, q_route_answers(spark, sf))


# ---- relations -------------------------------------------------------------------------------------------

def way_rels(spark, sf):
    return L.way_route_relations(_fx(spark, sf, "relations"), _fx(spark, sf, "relation_members"))


def q_way_relations(spark, sf):
    return way_rels(spark, sf)


def q_parent_directions(spark, sf):
    return L.parent_directions(_fx(spark, sf, "relations"), _fx(spark, sf, "relation_members"))


def q_match_refs(spark, sf):
    return L.match_refs(car_result(spark, sf), way_rels(spark, sf))


def q_way_refs(spark, sf):
    return L.way_refs(L.match_refs(car_result(spark, sf), way_rels(spark, sf)))


def q_merge_extracts(spark, sf):
    """Two regional extracts (west / east of 10.5°E by first node, overlapping) merged by way id."""
    wn = _fx(spark, sf, "way_nodes").join(_fx(spark, sf, "nodes"), "node_id")
    lon = wn.groupBy("way_id").agg(F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"))
    ways = _fx(spark, sf, "ways").join(lon, "way_id")
    west = ways.filter(F.col("min_lon") < 10.5).select("way_id", "tags")
    east = ways.filter(F.col("max_lon") >= 10.0).select("way_id", "tags")
    m = N.merge_extracts(west, east)
    return m.select("way_id", F.size("tags").alias("n_tags"))


QUERIES = {
    "g_tag_parse": q_tag_parse,
    "x3_tag_usage": q_tag_usage,
    "w29_car_ways": q_car_ways,
    "w29_car_routable": q_car_routable,
    "w29_foot_ways": q_foot_ways,
    "b_bicycle_ways": q_bicycle_ways,
    "b7_bicycle_cyclability": q_bicycle_cyclability,
    "b8_testbot_ways": q_testbot_ways,
    "k1_car_nodes": q_car_nodes,
    "k2_bicycle_nodes": q_bicycle_nodes,
    "k3_foot_nodes": q_foot_nodes,
    "r1_car_turns": _turns(K.car_turns, CAR),
    "r2_bicycle_turns": _turns(K.bicycle_turns, BICYCLE),
    "r3_foot_turns": _turns(K.foot_turns, FOOT),
    "r4_testbot_turns": _turns(K.testbot_turns, TESTBOT),
    "r5_turnbot_turns": _turns(K.profile_turns, TURNBOT),
    "e1_segments": q_segments,
    "e2_testbot_edges": q_testbot_edges,
    "e2_car_edges": q_car_edges,
    "e3_edges_no_barriers": q_edges_no_barriers,
    "e4_node_degree": q_node_degree,
    "e4_turn_angles": q_turn_angles,
    "e4_r1_turn_costs": q_turn_costs,
    "w27_car_distance": q_car_distance,
    "w28_class_turns": q_class_turns,
    "q3_ascii_grid": q_ascii_grid,
    "b9_exclude_classes": q_exclude_toll,
    "q1_raster_nearest": q_raster_nearest,
    "q2_raster_interpolated": q_raster_interpolated,
    "d1_industrial_speed": q_industrial_speed,
    "e5_snap_sites": q_snap_sites,
    "e5_snap_postal": q_snap_postal,
    "e6_routes": q_routes,
    "e7_route_answers": q_route_answers,
    "e7_j8_request_answers": q_request_answers_from_routes,
    "l1_way_relations": q_way_relations,
    "l2_parent_directions": q_parent_directions,
    "l4_match_refs": q_match_refs,
    "l5_way_refs": q_way_refs,
    "u2_merge_extracts": q_merge_extracts,
}

ORACLE = S.ORACLE
