"""Profile tables as data.

A profile is a plain dict of sets, sequences and value tables; the jobs in
``odspark.plans`` turn them into Catalyst expressions (``isin`` and literal
maps), so nothing here runs per row in Python. ``derive`` overrides entries
of a base profile (X1).
"""

from __future__ import annotations

import copy

# Travel modes and road priority classes of the route engine.
MODES = ["inaccessible", "driving", "cycling", "walking", "ferry", "train", "pushing_bike"]
MODE_CODES = {m: i for i, m in enumerate(MODES)}
ROAD_PRIORITY = {
    "motorway": 0, "motorway_link": 1, "trunk": 2, "trunk_link": 3, "primary": 4, "primary_link": 5,
    "secondary": 6, "secondary_link": 7, "tertiary": 8, "tertiary_link": 9, "main_residential": 10,
    "side_residential": 11, "alley": 12, "parking": 13, "link_road": 14, "unclassified": 15,
    "bike_path": 16, "foot_path": 18, "connectivity": 31,
}

# Guidance mapping of highway values to road priority classes.
HIGHWAY_CLASSES = {
    "motorway": "motorway", "motorway_link": "motorway_link", "trunk": "trunk", "trunk_link": "trunk_link",
    "primary": "primary", "primary_link": "primary_link", "secondary": "secondary",
    "secondary_link": "secondary_link", "tertiary": "tertiary", "tertiary_link": "tertiary_link",
    "unclassified": "unclassified", "residential": "main_residential", "service": "alley",
    "living_street": "side_residential", "track": "bike_path", "path": "bike_path", "footway": "foot_path",
    "pedestrian": "foot_path", "steps": "foot_path",
}
MOTORWAY_TYPES = ["motorway", "motorway_link", "trunk", "trunk_link"]
ROAD_TYPES = ["motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary",
              "secondary_link", "tertiary", "tertiary_link", "unclassified", "residential", "living_street"]
LINK_TYPES = ["motorway_link", "trunk_link", "primary_link", "secondary_link", "tertiary_link"]
PARKING_CLASS = ["parking_aisle", "driveway", "drive-through", "emergency_access"]

# Car profile.
CAR = {
    "name": "car",
    "weight_name": "routability",
    "u_turn_penalty": 20,
    "traffic_light_penalty": 2,
    "left_hand_driving": False,
    "default_mode": "driving",
    "default_speed": 10,
    "oneway_handling": True,
    "side_road_multiplier": 0.8,
    "turn_penalty": 7.5,
    "speed_reduction": 0.8,
    "turn_bias": 1.075,
    "cardinal_directions": False,
    "max_turn_weight": 3276.7,
    "vehicle_height": 2.0,
    "vehicle_width": 1.9,
    "vehicle_length": 4.8,
    "vehicle_weight": 2000,
    "barrier_whitelist": ["cattle_grid", "border_control", "toll_booth", "sally_port", "gate", "lift_gate", "no",
                          "entrance", "height_restrictor", "arch"],
    "access_tag_whitelist": ["yes", "motorcar", "motor_vehicle", "vehicle", "permissive", "designated", "hov"],
    "access_tag_blacklist": ["no", "agricultural", "forestry", "emergency", "psv", "customers", "private",
                             "delivery", "destination"],
    "service_access_tag_blacklist": ["private"],
    "restricted_access_tag_list": ["private", "delivery", "destination", "customers"],
    "access_tags_hierarchy": ["motorcar", "motor_vehicle", "vehicle", "access"],
    "service_tag_forbidden": ["emergency_access"],
    "restrictions": ["motorcar", "motor_vehicle", "vehicle"],
    "classes": ["toll", "motorway", "ferry", "restricted", "tunnel"],
    "excludable": [["toll"], ["motorway"], ["ferry"]],
    "avoid": ["area", "reversible", "impassable", "hov_lanes", "steps", "construction", "proposed"],
    "speeds": {"highway": {
        "motorway": 90, "motorway_link": 45, "trunk": 85, "trunk_link": 40, "primary": 65, "primary_link": 30,
        "secondary": 55, "secondary_link": 25, "tertiary": 40, "tertiary_link": 20, "unclassified": 25,
        "residential": 25, "living_street": 10, "service": 15}},
    "service_penalties": {"alley": 0.5, "parking": 0.5, "parking_aisle": 0.5, "driveway": 0.5,
                          "drive-through": 0.5, "drive-thru": 0.5},
    "restricted_highway_whitelist": ["motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link",
                                     "secondary", "secondary_link", "tertiary", "tertiary_link", "residential",
                                     "living_street", "unclassified", "service"],
    "construction_whitelist": ["no", "widening", "minor"],
    "route_speeds": {"ferry": 5, "shuttle_train": 10},
    "bridge_speeds": {"movable": 5},
    "surface_speeds": {
        "cement": 80, "compacted": 80, "fine_gravel": 80, "paving_stones": 60, "metal": 60, "bricks": 60,
        "grass": 40, "wood": 40, "sett": 40, "grass_paver": 40, "gravel": 40, "unpaved": 40, "ground": 40,
        "dirt": 40, "pebblestone": 40, "tartan": 40, "cobblestone": 30, "clay": 30, "earth": 20, "stone": 20,
        "rocky": 20, "sand": 20, "mud": 10},
    "tracktype_speeds": {"grade1": 60, "grade2": 40, "grade3": 30, "grade4": 25, "grade5": 20},
    "smoothness_speeds": {"intermediate": 80, "bad": 40, "very_bad": 20, "horrible": 10, "very_horrible": 5,
                          "impassable": 0},
    "maxspeed_table_default": {"urban": 50, "rural": 90, "trunk": 110, "motorway": 130},
    "maxspeed_table": {
        "at:rural": 100, "at:trunk": 100, "be:motorway": 120, "be-bru:rural": 70, "be-bru:urban": 30,
        "be-vlg:rural": 70, "by:urban": 60, "by:motorway": 110, "ch:rural": 80, "ch:trunk": 100,
        "ch:motorway": 120, "cz:trunk": 0, "cz:motorway": 0, "de:living_street": 7, "de:rural": 100,
        "de:motorway": 0, "dk:rural": 80, "fr:rural": 80, "gb:nsl_single": (60 * 1609) / 1000,
        "gb:nsl_dual": (70 * 1609) / 1000, "gb:motorway": (70 * 1609) / 1000, "nl:rural": 80, "nl:trunk": 100,
        "no:rural": 80, "no:motorway": 110, "pl:rural": 100, "pl:trunk": 120, "pl:motorway": 140,
        "ro:trunk": 100, "ru:living_street": 20, "ru:urban": 60, "ru:motorway": 110,
        "uk:nsl_single": (60 * 1609) / 1000, "uk:nsl_dual": (70 * 1609) / 1000, "uk:motorway": (70 * 1609) / 1000,
        "za:urban": 60, "za:rural": 100, "none": 140},
    "relation_types": ["route"],
    "highway_turn_classification": {},
    "access_turn_classification": {},
}

# Foot profile.
_WALK = 5
FOOT = {
    "name": "foot",
    "weight_name": "duration",
    "traffic_light_penalty": 2,
    "u_turn_penalty": 2,
    "left_hand_driving": False,
    "default_mode": "walking",
    "default_speed": _WALK,
    "oneway_handling": "specific",
    "barrier_blacklist": ["yes", "wall", "fence"],
    "access_tag_whitelist": ["yes", "foot", "permissive", "designated"],
    "access_tag_blacklist": ["no", "agricultural", "forestry", "private", "delivery"],
    "restricted_access_tag_list": [],
    "restricted_highway_whitelist": [],
    "construction_whitelist": [],
    "access_tags_hierarchy": ["foot", "access"],
    "service_access_tag_blacklist": [],
    "restrictions": ["foot"],
    "avoid": ["impassable"],
    "speeds": {
        "highway": {k: _WALK for k in ["primary", "primary_link", "secondary", "secondary_link", "tertiary",
                                       "tertiary_link", "unclassified", "residential", "road", "living_street",
                                       "service", "track", "path", "steps", "pedestrian", "footway", "pier"]},
        "railway": {"platform": _WALK},
        "amenity": {"parking": _WALK, "parking_entrance": _WALK},
        "man_made": {"pier": _WALK},
        "leisure": {"track": _WALK},
    },
    "route_speeds": {"ferry": 5},
    "bridge_speeds": {},
    "surface_speeds": {"fine_gravel": _WALK * 0.75, "gravel": _WALK * 0.75, "pebblestone": _WALK * 0.75,
                       "mud": _WALK * 0.5, "sand": _WALK * 0.5},
    "tracktype_speeds": {},
    "smoothness_speeds": {},
    "prefetch": ["highway", "bridge", "route", "leisure", "man_made", "railway", "platform", "amenity",
                 "public_transport"],
}

# Bicycle profile.
_BIKE, _PUSH = 15, 4
BICYCLE = {
    "name": "bicycle",
    "weight_name": "duration",
    "u_turn_penalty": 20,
    "traffic_light_penalty": 2,
    "mode_change_penalty": 30,
    "left_hand_driving": False,
    "default_mode": "cycling",
    "default_speed": _BIKE,
    "walking_speed": _PUSH,
    "oneway_handling": True,
    "turn_penalty": 6,
    "turn_bias": 1.4,
    "use_public_transport": True,
    "allowed_start_modes": ["cycling", "pushing_bike"],
    "barrier_blacklist": ["yes", "wall", "fence"],
    "access_tag_whitelist": ["yes", "permissive", "designated"],
    "access_tag_blacklist": ["no", "private", "agricultural", "forestry", "delivery", "use_sidepath"],
    "restricted_access_tag_list": [],
    "restricted_highway_whitelist": [],
    "service_access_tag_blacklist": [],
    "construction_whitelist": ["no", "widening", "minor"],
    "access_tags_hierarchy": ["bicycle", "vehicle", "access"],
    "restrictions": ["bicycle"],
    "cycleway_tags": ["track", "lane", "share_busway", "sharrow", "shared", "shared_lane"],
    "opposite_cycleway_tags": ["opposite", "opposite_lane", "opposite_track"],
    "unsafe_highway_list": {"primary": 0.5, "secondary": 0.65, "tertiary": 0.8, "primary_link": 0.5,
                            "secondary_link": 0.65, "tertiary_link": 0.8},
    "service_penalties": {"alley": 0.5},
    "bicycle_speeds": {"cycleway": _BIKE, "primary": _BIKE, "primary_link": _BIKE, "secondary": _BIKE,
                       "secondary_link": _BIKE, "tertiary": _BIKE, "tertiary_link": _BIKE, "residential": _BIKE,
                       "unclassified": _BIKE, "living_street": _BIKE, "road": _BIKE, "service": _BIKE,
                       "track": 12, "path": 12},
    "pedestrian_speeds": {"footway": _PUSH, "pedestrian": _PUSH, "steps": 2},
    "railway_speeds": {"train": 10, "railway": 10, "subway": 10, "light_rail": 10, "monorail": 10, "tram": 10},
    "platform_speeds": {"platform": _PUSH},
    "amenity_speeds": {"parking": 10, "parking_entrance": 10},
    "man_made_speeds": {"pier": _PUSH},
    "route_speeds": {"ferry": 5},
    "bridge_speeds": {"movable": 5},
    "surface_speeds": {"asphalt": _BIKE, "cobblestone:flattened": 10, "paving_stones": 10, "compacted": 10,
                       "cobblestone": 6, "unpaved": 6, "fine_gravel": 6, "gravel": 6, "pebblestone": 6,
                       "ground": 6, "dirt": 6, "earth": 6, "grass": 6, "mud": 3, "sand": 3, "sett": 10},
    "classes": ["ferry", "tunnel"],
    "excludable": [],
    "tracktype_speeds": {},
    "smoothness_speeds": {},
    "avoid": ["impassable", "construction"],
}

# Test profile (100 m take 10 / 20 / 30 s on primary / secondary / tertiary).
TESTBOT = {
    "name": "testbot",
    "weight_name": "duration",
    "u_turn_penalty": 20,
    "traffic_light_penalty": 7,
    "classes": ["motorway", "toll", "TooWords2"],
    "excludable": [["motorway"], ["toll"], ["motorway", "toll"]],
    "default_speed": 24,
    "speeds": {"primary": 36, "secondary": 18, "tertiary": 12, "steps": 6},
}

def derive(base: dict, **overrides) -> dict:
    """A profile that reuses another and overrides some entries or callbacks."""
    p = copy.deepcopy(base)
    p.update(overrides)
    return p


# The turn test profile is the test profile with its own turn callback (see nodes_turns.turnbot_turns)
TURNBOT = derive(TESTBOT, name="turnbot", process_turn="turnbot")
# bicycle weighted by cyclability (B7) instead of duration
BICYCLE_CYCLABILITY = derive(BICYCLE, name="bicycle_cyclability", weight_name="cyclability")

# car weighted by distance (W27), with road classes on its turns (W28): steps down the classes cost weight
CAR_DISTANCE = derive(CAR, name="car_distance", weight_name="distance", turn_class_penalty=1.5,
                      highway_turn_classification={"motorway": 4, "motorway_link": 4, "trunk": 3, "primary": 2, "secondary": 1, "residential": 0, "service": 0},
                      access_turn_classification={"private": 1, "destination": 2})

PROFILES = {"car_distance": CAR_DISTANCE, "car": CAR, "foot": FOOT, "bicycle": BICYCLE, "testbot": TESTBOT, "turnbot": TURNBOT,
            "bicycle_cyclability": BICYCLE_CYCLABILITY}
