"""Golden rows (FIXTURES.md) for the column builders and single rules."""

import pytest
from pyspark.sql import functions as F

from conftest import ways_df
from odspark.functions import tags as T
from odspark.functions.units import drive_zone, round5
from odspark.plans import bicycle as B
from odspark.plans import nodes_turns as K
from odspark.plans import ways as W
from odspark.plans.profiles import BICYCLE, CAR, FOOT, TESTBOT


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_drive_zone(spark):
    assert one_col(spark, [9.99, 10.0, 59.99, 60.0, None], drive_zone, "double") == [1, 2, 6, 7, 7]
    assert one_col(spark, [float("nan")], drive_zone, "double") == [7]


def test_round5(spark):
    assert one_col(spark, [1.234567891], round5, "double") == [1.23457]


def test_parse_speed(spark):
    out = one_col(spark, ["50", "30 mph", "FR:urban", None, "20 mp/h"], T.parse_speed)
    assert out[0] == 50 and abs(out[1] - 48.27) < 1e-9 and out[2] is None and out[3] is None
    assert abs(out[4] - 32.18) < 1e-9


def test_parse_meters_and_height(spark):
    out = one_col(spark, ["6'10\"", "2,1 m", "narrow", "12."], T.parse_meters)
    assert abs(out[0] - 2.0828) < 1e-9 and abs(out[1] - 2.1) < 1e-12 and out[2] is None and out[3] == 12.0
    assert one_col(spark, ["default", "none", "1.8"], T.parse_height) == [4.5, 4.5, 1.8]


def test_parse_kilograms(spark):
    out = one_col(spark, ["1.5", "3500 kg", "4000 lbs"], T.parse_kilograms)
    assert out[0] == 1500 and out[1] == 3500 and abs(out[2] - 1814.36948) < 1e-9


def test_duration(spark):
    out = one_col(spark, ["00:10", "01:02:03", "PT5M", "15", "PT1H2S", "abc", "PT"], T.duration_seconds)
    assert out == [600.0, 3723.0, 300.0, 900.0, 3602.0, None, None]


def test_list_helpers(spark):
    assert one_col(spark, ["a; ;b;;c "], lambda c: F.array_join(T.list_tokens(c), "|")) == ["a||b|c"]
    assert one_col(spark, ["  US   101 "], lambda c: F.array_join(T.tokenize_common(c), "|")) == ["US|101"]
    assert one_col(spark, ["designated|designated", "designated|yes", None], T.all_lanes_designated) == [True, False, False]
    assert one_col(spark, ["A 1;B 7", "A 1;  B 7"], lambda c: T.canonical_list(c, ";")) == ["A 1; B 7", "A 1; B 7"]


def test_lane_helpers(spark):
    assert one_col(spark, ["left|through|right"], lambda c: W.trim_lanes(c, F.lit(1), F.lit(0))) == ["through|right"]
    assert one_col(spark, ["left|through|right"], lambda c: W.apply_access_tokens(c, F.lit("yes|no|yes"))) == ["left|right"]


def _car(spark, rows):
    return {r.way_id: r for r in W.flat_result(W.car_ways(ways_df(spark, rows), CAR)).collect()}


def test_car_speed_and_maxspeed(spark):
    r = _car(spark, [{"highway": "primary"}, {"highway": "primary", "maxspeed": "50"},
                     {"highway": "primary", "maxspeed": "FR:urban"}, {"highway": "motorway", "maxspeed": "none"},
                     {"highway": "motorway", "maxspeed": "de:motorway"}, {"building": "yes"}])
    assert r[0].forward_speed == 65 and r[0].backward_speed == 65
    assert r[1].forward_speed == 40 and r[2].forward_speed == 40
    assert r[3].forward_speed == 112 and r[4].forward_speed == 90
    assert 5 not in r  # quick check: neither highway nor route


def test_car_stops_keep_partial_result(spark):
    r = _car(spark, [{"highway": "service", "service": "emergency_access"}, {"highway": "steps"},
                     {"highway": "primary", "access": "no"}])
    assert r[0].alive is False and r[0].stopped_at == "service" and r[0].forward_mode == "inaccessible"
    assert r[1].stopped_at == "blocked_ways" and r[1].forward_mode == "driving" and r[1].forward_speed == -1
    assert r[2].stopped_at == "access"


def test_car_oneway_ferry_and_restricted(spark):
    r = _car(spark, [{"highway": "residential", "oneway": "-1"}, {"route": "ferry", "duration": "00:10"},
                     {"highway": "primary", "access": "private"}, {"highway": "motorway"}])
    assert r[0].forward_mode == "inaccessible" and r[0].backward_mode == "driving"
    assert r[1].forward_mode == "ferry" and r[1].duration == 600 and r[1].weight == 600
    assert r[2].forward_restricted and r[2].forward_classes == "restricted" and r[2].forward_mode == "driving"
    assert r[3].backward_mode == "inaccessible" and r[3].forward_classes == "motorway"


def test_foot_and_bicycle(spark):
    rows = [{"highway": "primary"}, {"highway": "footway"}, {"highway": "primary", "bicycle": "dismount"},
            {"highway": "residential", "oneway": "yes", "cycleway": "opposite"}]
    foot = {r.way_id: r for r in W.flat_result(W.foot_ways(ways_df(spark, rows), FOOT)).collect()}
    assert foot[0].forward_speed == 5 and foot[0].forward_mode == "walking"
    bike = {r.way_id: r for r in W.flat_result(B.bicycle_ways(ways_df(spark, rows), BICYCLE)).collect()}
    assert bike[0].forward_speed == 15 and bike[0].forward_mode == "cycling"
    assert bike[1].forward_mode == "pushing_bike" and bike[1].forward_speed == 4
    assert bike[2].forward_mode == "pushing_bike" and bike[2].backward_speed == 4
    assert bike[3].backward_mode == "cycling"  # opposite cycleway opens the closed direction


def test_testbot_speeds(spark):
    rows = [{"highway": "primary"}, {"highway": "secondary"}, {"highway": "tertiary"}]
    r = {x.way_id: x for x in B.testbot_ways(ways_df(spark, rows), TESTBOT).collect()}
    # 100 m take 10 / 20 / 30 s
    assert [round(100 / (r[i].forward_speed / 3.6), 6) for i in range(3)] == [10, 20, 30]


def _turn_df(spark, rows):
    return spark.createDataFrame(rows, "turn_id long, angle double, number_of_roads long, has_traffic_light boolean, "
                                       "is_u_turn boolean, is_left_hand_driving boolean, source_mode string, "
                                       "target_mode string, source_restricted boolean, target_restricted boolean")


def test_turn_goldens(spark):
    t = _turn_df(spark, [(1, 90.0, 2, False, False, False, "driving", "driving", False, False),
                         (2, -90.0, 2, False, False, False, "driving", "driving", False, False),
                         (3, 0.0, 2, True, True, False, "driving", "driving", False, False)])
    r5 = {r.turn_id: r.duration for r in K.turnbot_turns(t, TESTBOT).collect()}
    assert r5[2] == pytest.approx(10.0)
    r2 = {r.turn_id: r.duration for r in K.bicycle_turns(t, BICYCLE).collect()}
    assert r2[1] == pytest.approx(6 / 1.4) and r2[2] == pytest.approx(8.4)
    r3 = {r.turn_id: r.duration for r in K.foot_turns(t, FOOT).collect()}
    assert r3[3] == 2.0
    r1 = {r.turn_id: (r.duration, r.weight) for r in K.car_turns(t, CAR).collect()}
    assert r1[3][0] == pytest.approx(2 + K.sigmoid_check(0.0) + 20)


def test_car_nodes(spark):
    n = spark.createDataFrame([(1, {"barrier": "gate"}), (2, {"barrier": "wall"}), (3, {"access": "private"}),
                               (4, {"barrier": "bollard", "bollard": "rising"}), (5, {"highway": "traffic_signals"}),
                               (6, {"barrier": "height_restrictor", "maxheight": "1.9"})],
                              "node_id long, tags map<string,string>")
    r = {x.node_id: x for x in K.car_nodes(n, CAR).collect()}
    assert not r[1].barrier and r[2].barrier and not r[3].barrier and not r[4].barrier
    assert r[5].traffic_lights and r[6].barrier
