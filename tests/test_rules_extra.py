"""Car rules for tags the fixture does not carry (hov, lanes, driving side, bridges, penalties, …)."""

import pytest

from conftest import ways_df
from odspark.plans import ways as W
from odspark.plans.profiles import CAR

CASES = [
    ({"highway": "primary", "hov": "designated"}, {"forward_restricted": True, "backward_restricted": True}),
    ({"highway": "primary", "hov:lanes": "designated|designated"}, {"forward_restricted": True, "forward_mode": "driving"}),
    ({"highway": "primary", "turn:lanes": "left|through|right", "vehicle:lanes": "yes|no|yes"},
     {"turn_lanes_forward": "left|right"}),
    ({"highway": "primary", "turn:lanes": "left|through|right", "lanes:psv:backward": "1"},
     {"turn_lanes_forward": "through|right", "turn_lanes_backward": "left|through"}),
    ({"highway": "primary", "driving_side": "left"}, {"is_left_hand_driving": True}),
    ({"highway": "motorway_link", "junction:ref": "12;13"}, {"exits": "12; 13", "link_class": True,
                                                              "motorway_class": True, "road_priority_class": 1}),
    ({"highway": "primary", "bridge": "movable", "duration": "00:05"}, {"duration": 300.0, "forward_mode": "driving"}),
    # the bridge speed is kept: the speed handler skips once a speed is set
    ({"highway": "primary", "bridge": "movable"}, {"forward_speed": 5.0, "duration": 0.0}),
    ({"highway": "primary", "oneway": "alternating"}, {"forward_rate": pytest.approx(65 * 0.4 / 3.6)}),
    ({"highway": "primary", "side_road": "yes"}, {"forward_rate": pytest.approx(65 * 0.8 / 3.6)}),
    ({"highway": "primary", "width": "2"}, {"forward_rate": pytest.approx(65 * 0.5 / 3.6)}),
    ({"highway": "primary", "lanes": "1"}, {"forward_rate": pytest.approx(65 * 0.5 / 3.6), "num_lanes": 1}),
    ({"highway": "primary", "lanes": "1", "oneway": "yes"}, {"forward_rate": pytest.approx(65 / 3.6)}),
    ({"highway": "service", "service": "alley"}, {"forward_rate": pytest.approx(15 * 0.5 / 3.6),
                                                   "road_priority_class": 12}),
    ({"highway": "primary", "maxspeed": "100", "maxspeed:advisory": "50"}, {"forward_speed": 40.0}),
    ({"highway": "primary", "construction": "minor"}, {"alive": True}),
    ({"highway": "primary", "construction": "yes"}, {"alive": False, "stopped_at": "blocked_ways"}),
    ({"highway": "primary", "proposed": "primary"}, {"alive": False}),
    ({"highway": "primary", "maxweight": "1.5"}, {"forward_mode": "inaccessible", "backward_mode": "inaccessible"}),
    ({"highway": "primary", "maxwidth": "narrow"}, {"forward_mode": "driving"}),
    ({"highway": "motorway", "oneway": "no"}, {"backward_mode": "driving"}),
    ({"highway": "primary", "junction": "roundabout"}, {"roundabout": True, "backward_mode": "inaccessible"}),
    ({"highway": "primary", "lanes:forward": "2", "lanes:backward": "1"}, {"num_lanes": 3}),
    ({"highway": "primary", "lanes": "many", "lanes:forward": "2"}, {"num_lanes": 0}),
    ({"highway": "primary", "toll:forward": "yes", "oneway": "yes"}, {"forward_classes": "toll", "backward_classes": ""}),
    ({"highway": "service", "access": "private"}, {"is_startpoint": False, "forward_restricted": True}),
    # no car speed for tracks and no access tag: the chain stops at the speed handler
    ({"highway": "track"}, {"alive": False, "stopped_at": "speed", "forward_speed": -1.0}),
    ({"highway": "track", "access": "yes"}, {"alive": True, "forward_speed": 10.0, "road_priority_class": 16}),
    ({"highway": "residential", "oneway": "yes", "destination:ref": "A 1", "destination:street": "Main"},
     {"destinations": "A 1"}),
    ({"highway": "residential", "oneway": "-1", "destination:street": "Main"}, {"destinations": "Main"}),
    ({"highway": "primary", "maxheight": "default"}, {"forward_mode": "driving"}),
    ({"highway": "primary", "maxheight": "1.9"}, {"forward_mode": "inaccessible"}),
]


def test_extra_car_rules(spark):
    rows = [tags for tags, _ in CASES]
    got = {r.way_id: r for r in W.flat_result(W.car_ways(ways_df(spark, rows), CAR)).collect()}
    for i, (tags, want) in enumerate(CASES):
        for k, v in want.items():
            assert getattr(got[i], k) == v, (tags, k, getattr(got[i], k), v)


BIKE_CASES = [
    ({"highway": "residential", "oneway": "yes", "cycleway:left": "opposite_lane"},
     {"backward_mode": "cycling", "backward_speed": 15.0}),
    ({"highway": "residential", "oneway": "yes", "oneway:bicycle": "no"}, {"backward_mode": "cycling"}),
    ({"highway": "residential", "oneway:bicycle": "-1"}, {"forward_mode": "pushing_bike", "forward_speed": 4.0,
                                                        "backward_mode": "cycling"}),
    ({"railway": "platform"}, {"forward_mode": "cycling", "forward_speed": 4.0}),
    ({"amenity": "parking"}, {"forward_speed": 10.0}),
    ({"highway": "steps"}, {"forward_mode": "pushing_bike", "forward_speed": 2.0}),
    ({"highway": "primary", "maxspeed": "10"}, {"forward_speed": 10.0}),
    ({"highway": "primary", "bicycle": "use_sidepath"}, {"alive": False, "stopped_at": "bicycle_check"}),
    ({"route": "ferry", "duration": "00:10"}, {"forward_mode": "ferry", "duration": 600.0, "forward_speed": -1.0}),
    ({"highway": "construction"}, {"alive": False, "stopped_at": "blocked_ways"}),
    ({"highway": "path", "surface": "mud"}, {"forward_speed": 3.0}),
    ({"building": "yes"}, {"alive": False, "stopped_at": "bicycle_check"}),
    ({"highway": "motorway"}, {"backward_mode": "inaccessible"}),
    ({"highway": "primary", "tunnel": "yes"}, {"forward_classes": "tunnel", "is_startpoint": True}),
]

FOOT_CASES = [
    ({"highway": "primary", "oneway:foot": "yes"}, {"backward_mode": "inaccessible", "forward_mode": "walking"}),
    ({"highway": "primary", "oneway": "yes"}, {"backward_mode": "walking"}),
    ({"railway": "platform"}, {"forward_speed": 5.0}),
    ({"highway": "primary", "surface": "gravel"}, {"forward_speed": 3.75}),
    ({"highway": "primary", "access": "private"}, {"alive": False, "stopped_at": "access"}),
    ({"highway": "primary", "foot": "yes", "access": "no"}, {"alive": True, "forward_speed": 5.0}),
    ({"route": "ferry"}, {"forward_mode": "ferry", "forward_speed": 5.0}),
    ({"highway": "motorway"}, {"alive": False, "stopped_at": "speed"}),
]


def _check(rows, cases):
    for i, (tags, want) in enumerate(cases):
        for k, v in want.items():
            assert getattr(rows[i], k) == v, (tags, k, getattr(rows[i], k), v)


def test_extra_bicycle_rules(spark):
    from odspark.plans import bicycle as B
    from odspark.plans.profiles import BICYCLE
    got = {r.way_id: r for r in W.flat_result(B.bicycle_ways(ways_df(spark, [t for t, _ in BIKE_CASES]), BICYCLE)).collect()}
    _check(got, BIKE_CASES)


def test_extra_foot_rules(spark):
    from odspark.plans.profiles import FOOT
    got = {r.way_id: r for r in W.flat_result(W.foot_ways(ways_df(spark, [t for t, _ in FOOT_CASES]), FOOT)).collect()}
    _check(got, FOOT_CASES)
