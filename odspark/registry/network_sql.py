"""DuckDB oracle SQL for the road-network queries.

DuckDB sees the tagged fixtures with one column per tag; a tag the fixture
never carries is the NULL literal here. The SQL is written independently of
"""

from __future__ import annotations

from odspark.functions.geo import haversine_sql
from odspark.plans.profiles import BICYCLE, BICYCLE_CYCLABILITY, CAR, CAR_DISTANCE, FOOT, TESTBOT
from odspark.sources.fixtures import NODE_TAGS, RASTER_BOUNDS, WAY_TAGS, with_clause

WAY_KEYS = {k for k, _, _ in WAY_TAGS}
NODE_KEYS = {k for k, _, _ in NODE_TAGS}


def w(key: str) -> str:
    """Way tag column (NULL when the fixture has no such tag)."""
    return f'w."{key}"' if key in WAY_KEYS else "CAST(NULL AS VARCHAR)"


def n(key: str) -> str:
    return f'n."{key}"' if key in NODE_KEYS else "CAST(NULL AS VARCHAR)"


def q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def in_list(x: str, values) -> str:
    values = list(values)
    if not values:
        return "FALSE"
    return f"COALESCE({x} IN ({', '.join(q(v) for v in values)}), FALSE)"


def case_table(x: str, table: dict) -> str:
    if not table:
        return "CAST(NULL AS DOUBLE)"
    whens = " ".join(f"WHEN {q(k)} THEN {float(v)!r}" for k, v in table.items())
    return f"CAST(CASE {x} {whens} END AS DOUBLE)"


def coalesce(*xs: str) -> str:
    return f"COALESCE({', '.join(xs)})" if len(xs) > 1 else xs[0]


def speed(x: str) -> str:
    num = f"TRY_CAST(NULLIF(regexp_extract({x}, '^([0-9]*)', 1), '') AS DOUBLE)"
    return f"(CASE WHEN contains({x}, 'mph') OR contains({x}, 'mp/h') THEN {num} * 1.609 ELSE {num} END)"


def _first_num(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(replace({x}, ',', '.'), '([0-9]+\\.?[0-9]*)', 1), '') AS DOUBLE)"


def meters(x: str) -> str:
    nval = _first_num(x)
    inches = f"COALESCE(TRY_CAST(NULLIF(regexp_extract({x}, '''[^0-9]*([0-9]+)', 1), '') AS DOUBLE), 0)"
    return (f"(CASE WHEN {nval} IS NULL THEN NULL WHEN contains({x}, '''') "
            f"THEN ({nval} * 12 + {inches}) * 0.0254 ELSE {nval} END)")


def kilograms(x: str) -> str:
    nval = _first_num(x)
    return (f"(CASE WHEN contains({x}, 'lbs') THEN {nval} * 0.45359237 WHEN contains({x}, 'kg') THEN {nval}"
            f" ELSE {nval} * 1000 END)")


def height(x: str) -> str:
    return f"(CASE WHEN {x} IN ('default', 'none', 'no-sign', 'unsigned') THEN 4.5 ELSE {meters(x)} END)"


def duration(x: str) -> str:
    hms = "'^([0-9]+):([0-9]{1,2}):([0-9]{1,2})$'"
    hm = "'^([0-9]+):([0-9]{1,2})$'"
    mins = "'^([0-9]+)$'"
    iso = "'^PT(([0-9]+)H)?(([0-9]+)M)?(([0-9]+)S)?$'"

    def g(p, i):
        return f"COALESCE(TRY_CAST(NULLIF(regexp_extract({x}, {p}, {i}), '') AS DOUBLE), 0)"
    return (f"(CASE WHEN regexp_matches({x}, {hms}) THEN {g(hms, 1)} * 3600 + {g(hms, 2)} * 60 + {g(hms, 3)}"
            f" WHEN regexp_matches({x}, {hm}) THEN {g(hm, 1)} * 3600 + {g(hm, 2)} * 60"
            f" WHEN regexp_matches({x}, {mins}) THEN {g(mins, 1)} * 60"
            f" WHEN regexp_matches({x}, {iso}) AND {x} <> 'PT' THEN {g(iso, 2)} * 3600 + {g(iso, 4)} * 60 + {g(iso, 6)}"
            f" END)")


def limit_speed(sp: str, common: str, directional: str) -> str:
    return (f"(CASE WHEN {directional} > 0 THEN least({sp}, {directional}) WHEN {common} > 0 THEN least({sp}, {common})"
            f" ELSE {sp} END)")


def r6(x: str) -> str:
    return f"round({x}, 6)"


# ---- tag helpers --------------------------------------------------------------------------------

_KMH = speed(w("maxspeed"))
TAG_PARSE = with_clause("ways") + f"""SELECT w.way_id,
 {coalesce(*[w(k) for k in CAR['access_tags_hierarchy']])} AS access_first,
 {r6(_KMH)} AS maxspeed_kmh,
 {r6(height(w('maxheight')))} AS maxheight_m,
 {r6(meters(w('maxwidth')))} AS maxwidth_m,
 {r6(kilograms(w('maxweight')))} AS maxweight_kg,
 {r6(meters(w('maxlength')))} AS maxlength_m,
 {coalesce(w('motor_vehicle:forward'), w('motor_vehicle'))} AS mv_forward,
 {coalesce(w('motor_vehicle:backward'), w('motor_vehicle'))} AS mv_backward,
 replace({coalesce(w('destination:forward'), w('destination'))}, ';', ', ') AS dest_forward,
 array_to_string(list_transform(list_filter(string_split({w('ref')}, ';'), lambda x: x <> ''), lambda x: trim(x)), '|') AS ref_tokens,
 len(list_filter(regexp_split_to_array({w('name')}, '\\s+'), lambda x: x <> '')) AS name_tokens,
 TRY_CAST(trim({w('lanes')}) AS DOUBLE) IS NOT NULL AS lanes_is_number,
 COALESCE(list_bool_and(list_transform(string_split({w('hov:lanes')}, '|'), lambda x: x = 'designated')), FALSE) AS hov_all_designated,
 {w('oneway:bicycle')} AS oneway_bicycle,
 {w('motor_vehicle:forward')} AS mv_postfixed,
 {r6(duration(w('duration')))} AS duration_s,
 {r6(limit_speed('50.0', f'COALESCE({_KMH}, 0)', f"COALESCE({speed(w('maxspeed:forward'))}, 0)"))} AS speed_limited,
 {case_table(w('highway'), CAR['speeds']['highway'])} AS highway_speed
FROM ways w"""

TAG_USAGE = with_clause("ways") + "SELECT tag_key, n_ways FROM (" + " UNION ALL ".join(
    f"SELECT {q(k)} AS tag_key, count(w.\"{k}\") AS n_ways FROM ways w" for k, _, _ in WAY_TAGS) + ") t WHERE n_ways > 0"

# ---- nodes ----------------------------------------------------------------------------------------

_LIGHT = "COALESCE(n.\"highway\" = 'traffic_signals', FALSE) AS traffic_lights"


def _car_nodes() -> str:
    acc = coalesce(*[n(k) for k in CAR["access_tags_hierarchy"]])
    bar = n("barrier")
    by_acc = f"({in_list(acc, CAR['access_tag_blacklist'])} AND NOT {in_list(acc, CAR['restricted_access_tag_list'])})"
    by_height = f"(COALESCE({bar} = 'height_restrictor', FALSE) AND COALESCE({height(n('maxheight'))} < {CAR['vehicle_height']}, FALSE))"
    by_bar = (f"({bar} IS NOT NULL AND ((NOT {in_list(bar, CAR['barrier_whitelist'])}"
              f" AND NOT COALESCE({n('bollard')} = 'rising', FALSE)"
              f" AND NOT COALESCE({n('kerb')} IN ('lowered', 'flush'), FALSE)"
              f" AND NOT (COALESCE({bar} = 'kerb', FALSE) AND COALESCE({n('highway')} = 'crossing', FALSE))) OR {by_height}))")
    return (with_clause("node_tags") + f"SELECT n.node_id, CASE WHEN {acc} IS NOT NULL THEN {by_acc} ELSE {by_bar} END"
            f" AS barrier, {_LIGHT} FROM node_tags n")


def _bicycle_nodes() -> str:
    acc = coalesce(*[n(k) for k in BICYCLE["access_tags_hierarchy"]])
    bar = n("barrier")
    crossing = f"COALESCE({n('highway')} = 'crossing', FALSE)"
    return (with_clause("node_tags") + f"SELECT n.node_id, CASE WHEN {acc} IS NOT NULL AND {acc} <> '' THEN"
            f" ({in_list(acc, BICYCLE['access_tag_blacklist'])} AND NOT {crossing}) ELSE"
            f" ({bar} IS NOT NULL AND {bar} <> '' AND {in_list(bar, BICYCLE['barrier_blacklist'])}) END AS barrier,"
            f" {_LIGHT} FROM node_tags n")


def _foot_nodes() -> str:
    acc = coalesce(*[n(k) for k in FOOT["access_tags_hierarchy"]])
    bar = n("barrier")
    return (with_clause("node_tags") + f"SELECT n.node_id, CASE WHEN {acc} IS NOT NULL THEN"
            f" {in_list(acc, FOOT['access_tag_blacklist'])} ELSE ({bar} IS NOT NULL AND"
            f" {in_list(bar, FOOT['barrier_blacklist'])} AND NOT COALESCE({n('bollard')} = 'rising', FALSE)) END AS barrier,"
            f" {_LIGHT} FROM node_tags n")


# ---- turns ----------------------------------------------------------------------------------------

def _turn_sql(duration_expr: str, weight_expr: str) -> str:
    return (with_clause("turns") + f"SELECT turn_id, {r6(f'CAST({duration_expr} AS DOUBLE)')} AS duration,"
            f" {r6(f'CAST({weight_expr} AS DOUBLE)')} AS weight"
            f" FROM (SELECT *, CAST(angle AS DOUBLE) AS a FROM turns) t")


def _car_turns() -> str:
    p = CAR
    bias = f"(CASE WHEN COALESCE(is_left_hand_driving, FALSE) THEN {1.0 / p['turn_bias']!r} ELSE {float(p['turn_bias'])!r} END)"
    base = f"(CASE WHEN COALESCE(has_traffic_light, FALSE) THEN {float(p['traffic_light_penalty'])} ELSE 0.0 END)"
    right = f"{p['turn_penalty']} / (1 + exp(-((13 / {bias}) * a / 180 - 6.5 * {bias})))"
    left = f"{p['turn_penalty']} / (1 + exp(-((13 * {bias}) * (-a) / 180 - 6.5 / {bias})))"
    uturn = "COALESCE(is_u_turn, FALSE)"
    choice = f"(number_of_roads > 2 OR source_mode <> target_mode OR {uturn})"
    dur = (f"({base} + CASE WHEN {choice} THEN (CASE WHEN a >= 0 THEN {right} ELSE {left} END)"
           f" + (CASE WHEN {uturn} THEN {float(p['u_turn_penalty'])} ELSE 0.0 END) ELSE 0.0 END)")
    weight = (f"(CASE WHEN NOT COALESCE(source_restricted, FALSE) AND COALESCE(target_restricted, FALSE)"
              f" THEN {p['max_turn_weight']} ELSE {dur} END)")
    return _turn_sql(dur, weight)


def _bicycle_turns() -> str:
    p = BICYCLE
    sq = f"(a / 90.0) * (a / 90.0) * {float(p['turn_penalty'])}"
    dur = (f"((CASE WHEN a / 90.0 >= 0 THEN {sq} / {p['turn_bias']} ELSE {sq} * {p['turn_bias']} END)"
           f" + (CASE WHEN COALESCE(is_u_turn, FALSE) THEN {float(p['u_turn_penalty'])} ELSE 0.0 END)"
           f" + (CASE WHEN COALESCE(has_traffic_light, FALSE) THEN {float(p['traffic_light_penalty'])} ELSE 0.0 END))")
    weight = (f"(CASE WHEN COALESCE(source_mode = 'cycling', FALSE) AND COALESCE(target_mode <> 'cycling', TRUE)"
              f" THEN {float(p['mode_change_penalty'])} ELSE 0.0 END)")
    return _turn_sql(dur, weight)


def _foot_turns() -> str:
    dur = ("(CASE WHEN COALESCE(has_traffic_light, FALSE) THEN 2.0 WHEN COALESCE(is_u_turn, FALSE) THEN 2.0"
           " ELSE 0.0 END)")
    return _turn_sql(dur, "0.0")


def _testbot_turns() -> str:
    u = "(CASE WHEN COALESCE(is_u_turn, FALSE) THEN 20.0 ELSE 0.0 END)"
    light = "(CASE WHEN COALESCE(has_traffic_light, FALSE) THEN 7.0 ELSE 0.0 END)"
    return _turn_sql(f"({u} + {light})", u)


# ---- test profile ways and the edges built from them ---------------------------------------------

def _testbot_cte() -> str:
    hw = w("highway")
    base = f"COALESCE({case_table(hw, TESTBOT['speeds'])}, {float(TESTBOT['default_speed'])})"
    mx = f"TRY_CAST(trim({w('maxspeed')}) AS DOUBLE)"
    mxf = f"TRY_CAST(trim({w('maxspeed:forward')}) AS DOUBLE)"
    mxb = f"TRY_CAST(trim({w('maxspeed:backward')}) AS DOUBLE)"
    river = f"COALESCE({hw} = 'river', FALSE)"
    steps = f"COALESCE({hw} = 'steps', FALSE)"
    sf0 = f"(CASE WHEN {river} THEN {base} * 1.5 ELSE {base} END)"
    sb0 = f"(CASE WHEN {river} THEN {base} / 1.5 ELSE {base} END)"
    sf = f"(CASE WHEN COALESCE({mxf} > 0, FALSE) THEN {mxf} WHEN COALESCE({mx} > 0 AND {sf0} > {mx}, FALSE) THEN {mx} ELSE {sf0} END)"
    sb = f"(CASE WHEN COALESCE({mxb} > 0, FALSE) THEN {mxb} WHEN COALESCE({mx} > 0 AND {sb0} > {mx}, FALSE) THEN {mx} ELSE {sb0} END)"
    dur = duration(w("duration"))
    ow = w("oneway")
    no = in_list(ow, ["no", "0", "false"])
    rev = f"(NOT {no} AND COALESCE({ow} = '-1', FALSE))"
    fwd = f"(NOT {no} AND NOT {rev} AND ({in_list(ow, ['yes', '1', 'true'])} OR COALESCE({w('junction')} = 'roundabout', FALSE)))"
    fmode = (f"(CASE WHEN {rev} THEN 'inaccessible' WHEN {dur} IS NOT NULL THEN 'route' WHEN {river} THEN 'river_down'"
             f" WHEN {steps} THEN 'steps_down' ELSE 'driving' END)")
    bmode = (f"(CASE WHEN {fwd} THEN 'inaccessible' WHEN {dur} IS NOT NULL THEN 'route' WHEN {river} THEN 'river_up'"
             f" WHEN {steps} THEN 'steps_up' ELSE 'driving' END)")
    classes = (f"array_to_string(list_sort(list_filter([CASE WHEN COALESCE({hw} = 'motorway', FALSE) THEN 'motorway' END,"
               f" CASE WHEN COALESCE({w('toll')} = 'yes', FALSE) THEN 'toll' END], lambda x: x IS NOT NULL)), ',')")
    return (f"tb AS (SELECT w.way_id, {fmode} AS forward_mode, {bmode} AS backward_mode,"
            f" CASE WHEN {dur} IS NOT NULL THEN -1.0 ELSE {sf} END AS forward_speed,"
            f" CASE WHEN {dur} IS NOT NULL THEN -1.0 ELSE {sb} END AS backward_speed,"
            f" CASE WHEN {dur} IS NOT NULL THEN greatest(1.0, {dur}) ELSE 0.0 END AS duration,"
            f" {w('name')} AS name, {classes} AS classes,"
            f" COALESCE({w('junction')} = 'roundabout', FALSE) AS roundabout FROM ways w)")


HAV = haversine_sql("a.lon", "a.lat", "b.lon", "b.lat")
SEG_CTE = (f"seg AS (SELECT x.way_id, x.seq, x.node_id AS from_node, y.node_id AS to_node,"
           f" a.lon AS from_lon, a.lat AS from_lat, b.lon AS to_lon, b.lat AS to_lat, round({HAV}, 3) AS distance_m"
           f" FROM way_nodes x JOIN way_nodes y ON x.way_id = y.way_id AND y.seq = x.seq + 1"
           f" JOIN nodes a ON a.node_id = x.node_id JOIN nodes b ON b.node_id = y.node_id)")


def _edges_from(way_cte_name: str, classes_expr: str) -> str:
    """Directed edges from a way-result CTE with mode/speed/duration columns (no rates, no way weight)."""
    def side(fwd: bool):
        mode, spd = ("forward_mode", "forward_speed") if fwd else ("backward_mode", "backward_speed")
        src, dst = ("from", "to") if fwd else ("to", "from")
        share = "(CASE WHEN l.way_len > 0 THEN s.distance_m / l.way_len ELSE 0.0 END)"
        dur = f"(CASE WHEN r.duration > 0 THEN r.duration * {share} WHEN r.{spd} > 0 THEN s.distance_m / (r.{spd} / 3.6) END)"
        return (f"SELECT s.way_id, s.seq, {str(fwd).upper()} AS forward, s.{src}_node AS source, s.{dst}_node AS target,"
                f" r.{mode} AS mode, s.distance_m, round({dur}, 6) AS duration_s, round({dur}, 6) AS weight,"
                f" {classes_expr} AS classes FROM seg s JOIN {way_cte_name} r ON r.way_id = s.way_id"
                f" JOIN (SELECT way_id, sum(distance_m) AS way_len FROM seg GROUP BY way_id) l ON l.way_id = s.way_id"
                f" WHERE r.{mode} <> 'inaccessible' AND (r.{spd} > 0 OR r.duration > 0)")
    return side(True) + " UNION ALL " + side(False)


TESTBOT_WAYS = (with_clause("ways") + ", " + _testbot_cte() + "\nSELECT way_id, forward_mode, backward_mode,"
                " round(forward_speed, 6) AS forward_speed, round(backward_speed, 6) AS backward_speed,"
                " round(duration, 6) AS duration, name, classes, roundabout FROM tb")

TESTBOT_EDGES = (with_clause("ways", "way_nodes", "nodes") + ", " + _testbot_cte() + ", " + SEG_CTE + "\n"
                 + _edges_from("tb", "r.classes"))

SEGMENTS = with_clause("way_nodes", "nodes") + ", " + SEG_CTE + "\nSELECT way_id, seq, from_node, to_node, distance_m FROM seg"


# ---- rasterbot: every way cycling at 15 km/h, slope from the raster --------------------------------

def _raster_q1() -> str:
    b = RASTER_BOUNDS
    rb = ("rb AS (SELECT w.way_id, 'cycling' AS forward_mode, 'cycling' AS backward_mode, 15.0 AS forward_speed,"
          " 15.0 AS backward_speed, 0.0 AS duration FROM ways w)")

    def near(lon, lat):
        inside = f"({lon} >= {b['lon_min']} AND {lon} <= {b['lon_max']} AND {lat} >= {b['lat_min']} AND {lat} <= {b['lat_max']})"
        col = f"CAST(round(({lon} - {b['lon_min']}) / ({b['lon_max']} - {b['lon_min']}) * {b['ncols'] - 1}) AS INTEGER)"
        row = f"CAST(round(({b['lat_max']} - {lat}) / ({b['lat_max']} - {b['lat_min']}) * {b['nrows'] - 1}) AS INTEGER)"
        return f"CASE WHEN {inside} THEN {row} END", f"CASE WHEN {inside} THEN {col} END"
    fr, fc = near("s.from_lon", "s.from_lat")
    tr, tc = near("s.to_lon", "s.to_lat")
    # edges in both directions: source / target ends swap
    body = f"""edges AS ({_edges_from('rb', "''")}),
ends AS (SELECT e.*, CASE WHEN e.forward THEN {fr} ELSE {tr} END AS sr, CASE WHEN e.forward THEN {fc} ELSE {tc} END AS sc,
 CASE WHEN e.forward THEN {tr} ELSE {fr} END AS tr_, CASE WHEN e.forward THEN {tc} ELSE {fc} END AS tc_
 FROM edges e JOIN seg s ON s.way_id = e.way_id AND s.seq = e.seq)
SELECT x.way_id, x.seq, x.source, x.target, x.distance_m,
 round(CASE WHEN ok THEN x.weight / f ELSE x.weight END, 6) AS weight,
 round(CASE WHEN ok THEN x.duration_s / f ELSE x.duration_s END, 6) AS duration_s
FROM (SELECT e.*, rs.datum IS NOT NULL AND rt.datum IS NOT NULL AND e.distance_m > 0 AS ok,
 1.0 - (rt.datum - rs.datum) / e.distance_m * 5.0 AS f
 FROM ends e LEFT JOIN raster rs ON rs.row = e.sr AND rs.col = e.sc LEFT JOIN raster rt ON rt.row = e.tr_ AND rt.col = e.tc_) x"""
    return with_clause("ways", "way_nodes", "nodes", "raster") + ", " + rb + ", " + SEG_CTE + ",\n" + body


# ---- D1 industrial areas -------------------------------------------------------------------------------

INDUSTRIAL = with_clause("ways", "way_nodes", "nodes", "areas") + f"""SELECT h.way_id, round(v.val, 6) AS val,
 round(CASE WHEN v.val > 10 THEN 20.0 / log10(v.val) ELSE 20.0 END, 6) AS forward_speed
FROM (SELECT way_id FROM ways w WHERE w."highway" IS NOT NULL AND w."highway" <> '') h
LEFT JOIN (SELECT way_id, sum(sqrt(area)) AS val FROM (
  SELECT DISTINCT wn.way_id, ar.area_id, ar.area FROM way_nodes wn JOIN nodes b ON b.node_id = wn.node_id
  JOIN (SELECT area_id, area, lon, lat FROM areas WHERE type = 'industrial') a ON {HAV} <= 100.0
  JOIN (SELECT area_id, area FROM areas) ar ON ar.area_id = a.area_id
  WHERE wn.way_id IN (SELECT way_id FROM ways w WHERE w."highway" IS NOT NULL AND w."highway" <> '')) t
 GROUP BY way_id) v ON v.way_id = h.way_id"""

# ---- relations ---------------------------------------------------------------------------------------

_DIRS = "('north', 'south', 'west', 'east')"
PARENT_DIRS = with_clause("relations", "relation_members") + f"""SELECT rel_id,
 CASE WHEN count(*) % 2 = 1 THEN arg_max(d, parent_id) END AS super_dir FROM (
  SELECT m.member_id AS rel_id, m.rel_id AS parent_id,
   CASE WHEN m.role IN {_DIRS} THEN m.role WHEN p.direction IN {_DIRS} THEN p.direction END AS d
  FROM relation_members m JOIN relations p ON p.rel_id = m.rel_id
  WHERE m.member_type = 'relation' AND p.type = 'route') t WHERE d IS NOT NULL GROUP BY rel_id"""

_PARENT_BODY = PARENT_DIRS[PARENT_DIRS.index("SELECT rel_id,"):]
WAY_RELATIONS = with_clause("relations", "relation_members") + f""", pd AS ({_PARENT_BODY}),
base AS (SELECT m.member_id AS way_id, r.rel_id, m.role, r.route, r.name, r.ref,
  CASE WHEN r.route = 'road' AND m.role IN {_DIRS} THEN m.role END AS role_dir,
  CASE WHEN lower(r.direction) IN {_DIRS} THEN lower(r.direction) END AS tag_dir, pd.super_dir
 FROM relation_members m JOIN relations r ON r.rel_id = m.rel_id LEFT JOIN pd ON pd.rel_id = r.rel_id
 WHERE m.member_type = 'way' AND r.type = 'route'),
own AS (SELECT *, CASE WHEN role_dir IS NOT NULL AND tag_dir IS NOT NULL AND role_dir <> tag_dir THEN NULL
  ELSE COALESCE(role_dir, tag_dir) END AS own_dir FROM base)
SELECT way_id, rel_id,
 CASE WHEN own_dir IS NOT NULL AND super_dir IS NOT NULL AND own_dir <> super_dir THEN NULL
  ELSE COALESCE(own_dir, super_dir) END AS route_direction,
 CASE WHEN role = 'forward' THEN TRUE WHEN role = 'backward' THEN FALSE END AS route_forward,
 name AS route_name, ref AS route_ref FROM own"""

# ---- U2 merge of regional extracts ------------------------------------------------------------------

MERGE = with_clause("ways", "way_nodes", "nodes") + """SELECT l.way_id,
 n_tags FROM (
  SELECT e.way_id, e.n_tags FROM (SELECT w.way_id, min(n.lon) AS min_lon, max(n.lon) AS max_lon
   FROM way_nodes w JOIN nodes n ON n.node_id = w.node_id GROUP BY w.way_id) e0
  JOIN (SELECT way_id, """ + " + ".join(f'(CASE WHEN w."{k}" IS NOT NULL THEN 1 ELSE 0 END)' for k, _, _ in WAY_TAGS) + \
    """ AS n_tags FROM ways w) e ON e.way_id = e0.way_id
  WHERE e0.min_lon < 10.5 OR e0.max_lon >= 10.0) l"""

ORACLE = {
    "g_tag_parse": TAG_PARSE,
    "x3_tag_usage": TAG_USAGE,
    "k1_car_nodes": _car_nodes(),
    "k2_bicycle_nodes": _bicycle_nodes(),
    "k3_foot_nodes": _foot_nodes(),
    "r1_car_turns": _car_turns(),
    "r2_bicycle_turns": _bicycle_turns(),
    "r3_foot_turns": _foot_turns(),
    "r4_testbot_turns": _testbot_turns(),
    "r5_turnbot_turns": _turn_sql("20.0 * abs(a) / 180.0", "0.0"),
    "b8_testbot_ways": TESTBOT_WAYS,
    "e1_segments": SEGMENTS,
    "e2_testbot_edges": TESTBOT_EDGES,
    "q1_raster_nearest": _raster_q1(),
    "d1_industrial_speed": INDUSTRIAL,
    "l2_parent_directions": PARENT_DIRS,
    "l1_way_relations": WAY_RELATIONS,
    "u2_merge_extracts": MERGE,
}


# ---- W29: car rule chain ----------------------------------------------------------------------------
# One CTE per handler. ``alive`` turns false where a handler stops; later CTEs
# change a row only while it is alive. Tags are the wide fixture columns.

def t(key: str) -> str:
    return f'"{key}"' if key in WAY_KEYS else "CAST(NULL AS VARCHAR)"


def _dbl(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def _upd(cols: dict) -> str:
    return ", ".join(f"CASE WHEN alive THEN {v} ELSE {k} END AS {k}" for k, v in cols.items())


class _Chain:
    def __init__(self, first: str):
        self.ctes = [("s0", first)]

    @property
    def last(self) -> str:
        return self.ctes[-1][0]

    def add(self, sql: str):
        self.ctes.append((f"s{len(self.ctes)}", sql.replace("{prev}", self.last)))

    def update(self, cols: dict):
        self.add(f"SELECT * REPLACE ({_upd(cols)}) FROM {{prev}}")

    def extra(self, cols: dict):
        self.add("SELECT *, " + ", ".join(f"{v} AS {k}" for k, v in cols.items()) + " FROM {prev}")

    def stop(self, name: str, cond: str):
        c = f"COALESCE({cond}, FALSE)"
        self.add(f"SELECT * REPLACE (alive AND NOT {c} AS alive, CASE WHEN alive AND {c} THEN '{name}'"
                 f" ELSE stopped_at END AS stopped_at) FROM {{prev}}")

    def sql(self) -> str:
        return ",\n".join(f"{n} AS ({s})" for n, s in self.ctes)


def _inacc(cond: str, col: str) -> str:
    return f"CASE WHEN COALESCE({cond}, FALSE) THEN 'inaccessible' ELSE {col} END"


def _g2(key: str) -> tuple[str, str]:
    """Forward/backward value of one key given the one-way state columns."""
    f, b, common = t(f"{key}:forward"), t(f"{key}:backward"), t(key)
    fwd = f"CASE WHEN d_oneway IS NULL OR d_fow THEN COALESCE({f}, {common}) ELSE {f} END"
    bwd = f"CASE WHEN d_oneway IS NULL OR d_row THEN COALESCE({b}, {common}) ELSE {b} END"
    return fwd, bwd


def _g3(keys) -> tuple[str, str]:
    return (coalesce(*[x for k in keys for x in (t(f"{k}:forward"), t(k))]),
            coalesce(*[x for k in keys for x in (t(f"{k}:backward"), t(k))]))


def _maxspeed(x: str, p: dict) -> str:
    low = f"lower({x})"
    kind = f"NULLIF(regexp_extract({low}, '[a-zA-Z]{{2}}:([a-zA-Z]+)', 1), '')"
    return (f"(CASE WHEN {x} IS NULL THEN 0.0 ELSE COALESCE({speed(x)}, {case_table(low, p['maxspeed_table'])},"
            f" {case_table(kind, p['maxspeed_table_default'])}, 0.0) END)")


def car_ways_sql(p: dict = CAR, chain_only: bool = False, extra_fixtures: tuple = ()):
    from odspark.plans.profiles import HIGHWAY_CLASSES, LINK_TYPES, MOTORWAY_TYPES, ROAD_PRIORITY, ROAD_TYPES
    hw_tag, rt_tag = t("highway"), t("route")
    ch = _Chain(
        f"SELECT *, TRUE AS alive, CAST(NULL AS VARCHAR) AS stopped_at, 'inaccessible' AS fm, 'inaccessible' AS bm,"
        f" {_dbl(-1)} AS fs, {_dbl(-1)} AS bs, CAST(NULL AS DOUBLE) AS fr, CAST(NULL AS DOUBLE) AS br,"
        f" {_dbl(0)} AS dur, CAST(NULL AS DOUBLE) AS wt, FALSE AS frs, FALSE AS brs, '' AS fcl, '' AS bcl,"
        f" CAST(NULL AS VARCHAR) AS nm, CAST(NULL AS VARCHAR) AS rf, CAST(NULL AS VARCHAR) AS ex,"
        f" CAST(NULL AS VARCHAR) AS dst, CAST(NULL AS VARCHAR) AS tlf, CAST(NULL AS VARCHAR) AS tlb,"
        f" FALSE AS mc, FALSE AS lc, CAST(NULL AS INTEGER) AS prio, CAST(NULL AS BOOLEAN) AS mbi,"
        f" CAST(0 AS INTEGER) AS nl, FALSE AS rb, FALSE AS circ, CAST(NULL AS BOOLEAN) AS isp, FALSE AS lhd,"
        f" {hw_tag} AS d_hw, {rt_tag} AS d_route, {t('bridge')} AS d_bridge, CAST(NULL AS VARCHAR) AS d_oneway,"
        f" FALSE AS d_fow, FALSE AS d_row, CAST(NULL AS VARCHAR) AS d_fa, CAST(NULL AS VARCHAR) AS d_ba"
        f" FROM ways WHERE ({hw_tag} IS NOT NULL AND {hw_tag} <> '') OR ({rt_tag} IS NOT NULL AND {rt_tag} <> '')")
    avoid = set(p["avoid"])
    # default mode
    ch.update({"fm": f"'{p['default_mode']}'", "bm": f"'{p['default_mode']}'"})
    # blocked ways
    conds = []
    if "area" in avoid:
        conds.append(f"{t('area')} = 'yes'")
    if "toll" in avoid:
        conds.append(f"{t('toll')} = 'yes'")
    if "steps" in avoid:
        conds.append("d_hw = 'steps'")
    if "construction" in avoid:
        conds.append(f"(d_hw = 'construction' OR {t('railway')} = 'construction')")
        conds.append(f"({t('construction')} IS NOT NULL AND NOT {in_list(t('construction'), p['construction_whitelist'])})")
    if "proposed" in avoid:
        conds.append(f"{t('proposed')} IS NOT NULL")
    if "reversible" in avoid:
        conds.append(f"{t('oneway')} = 'reversible'")
    if "impassable" in avoid:
        conds.append(f"({t('impassable')} = 'yes' OR {t('status')} = 'impassable')")
    ch.stop("blocked_ways", " OR ".join(f"COALESCE({c}, FALSE)" for c in conds))
    ch.stop("avoid_ways", in_list("d_hw", p["avoid"]))
    # physical limits
    hf, hb = _g3(["maxheight:physical", "maxheight"])
    ch.update({"fm": _inacc(f"{height(hf)} < {p['vehicle_height']}", "fm"),
               "bm": _inacc(f"{height(hb)} < {p['vehicle_height']}", "bm")})
    wf, wb = _g3(["maxwidth:physical", "maxwidth", "width", "est_width"])
    wide = "TRUE" if p["vehicle_width"] > 2.2 else "FALSE"

    def closed_w(x):
        nar = f"COALESCE((({x} = 'narrow') OR ({t('narrow')} = 'yes')) AND {wide}, FALSE)"
        return f"({nar} OR (NOT {nar} AND {x} IS NOT NULL AND COALESCE({meters(x)} <= {p['vehicle_width']}, FALSE)))"
    ch.update({"fm": _inacc(closed_w(wf), "fm"), "bm": _inacc(closed_w(wb), "bm")})
    lf, lb = _g3(["maxlength"])
    ch.update({"fm": _inacc(f"{meters(lf)} < {p['vehicle_length']}", "fm"),
               "bm": _inacc(f"{meters(lb)} < {p['vehicle_length']}", "bm")})
    gf, gb = _g3(["maxweight"])
    ch.update({"fm": _inacc(f"{kilograms(gf)} < {p['vehicle_weight']}", "fm"),
               "bm": _inacc(f"{kilograms(gb)} < {p['vehicle_weight']}", "bm")})
    # access
    af, ab = _g3(p["access_tags_hierarchy"])
    ch.extra({"_af": af, "_ab": ab})
    rhw = in_list("d_hw", p["restricted_highway_whitelist"])
    nfrs = f"(frs OR ({rhw} AND {in_list('_af', p['restricted_access_tag_list'])}))"
    nbrs = f"(brs OR ({rhw} AND {in_list('_ab', p['restricted_access_tag_list'])}))"
    ch.update({"d_fa": "_af", "d_ba": "_ab", "frs": nfrs, "brs": nbrs,
               "fm": f"CASE WHEN {in_list('_af', p['access_tag_blacklist'])} AND NOT {nfrs} THEN 'inaccessible' ELSE fm END",
               "bm": f"CASE WHEN {in_list('_ab', p['access_tag_blacklist'])} AND NOT {nbrs} THEN 'inaccessible' ELSE bm END"})
    ch.stop("access", "fm = 'inaccessible' AND bm = 'inaccessible'")
    # one-way
    ow = coalesce(*[t(f"oneway:{k}") for k in p["restrictions"]], t("oneway"))
    rev = f"COALESCE({ow} = '-1', FALSE)"
    fwd = (f"(COALESCE({ow} IN ('yes', '1', 'true'), FALSE) OR (NOT {rev} AND COALESCE(d_hw = 'motorway'"
           f" OR {t('junction')} IN ('roundabout', 'circular'), FALSE) AND COALESCE({ow} <> 'no', TRUE)))")
    ch.update({"d_oneway": ow, "d_row": rev, "d_fow": fwd,
               "fm": f"CASE WHEN {rev} THEN 'inaccessible' ELSE fm END",
               "bm": f"CASE WHEN {fwd} THEN 'inaccessible' ELSE bm END"})

    # destinations
    def dest(forward: bool):
        d = "forward" if forward else "backward"

        def dt(k):
            return f"replace({coalesce(t(f'{k}:{d}'), t(k))}, ';', ', ')"
        ref, de, st = dt("destination:ref"), dt("destination"), dt("destination:street")
        return f"(CASE WHEN {ref} IS NOT NULL AND {de} IS NOT NULL THEN {ref} || ': ' || {de} ELSE COALESCE({ref}, {de}, {st}, '') END)"
    ch.update({"dst": f"CASE WHEN d_fow OR d_row THEN regexp_replace(CASE WHEN d_fow THEN {dest(True)} ELSE {dest(False)} END,"
                      f" ', *', ', ', 'g') ELSE dst END"})
    # ferries
    parsed = duration(t("duration"))
    rs = case_table("d_route", p["route_speeds"])
    on = f"COALESCE({rs} > 0, FALSE)"
    ch.update({"dur": f"CASE WHEN {on} AND {parsed} IS NOT NULL THEN greatest({parsed}, 1.0) ELSE dur END",
               "fm": f"CASE WHEN {on} THEN 'ferry' ELSE fm END", "bm": f"CASE WHEN {on} THEN 'ferry' ELSE bm END",
               "fs": f"CASE WHEN {on} THEN {rs} ELSE fs END", "bs": f"CASE WHEN {on} THEN {rs} ELSE bs END"})
    # movable bridges
    bsp = case_table("d_bridge", p["bridge_speeds"])
    on = f"COALESCE({bsp} > 0, FALSE)"
    dm = f"'{p['default_mode']}'"
    ch.update({"fm": f"CASE WHEN {on} THEN {dm} ELSE fm END", "bm": f"CASE WHEN {on} THEN {dm} ELSE bm END",
               "dur": f"CASE WHEN {on} AND {parsed} IS NOT NULL THEN greatest({parsed}, 1.0) ELSE dur END",
               "fs": f"CASE WHEN {on} AND {parsed} IS NULL THEN {bsp} ELSE fs END",
               "bs": f"CASE WHEN {on} AND {parsed} IS NULL THEN {bsp} ELSE bs END"})
    # service
    bad = in_list(t("service"), p["service_tag_forbidden"])
    ch.update({"fm": f"CASE WHEN {bad} THEN 'inaccessible' ELSE fm END",
               "bm": f"CASE WHEN {bad} THEN 'inaccessible' ELSE bm END"})
    ch.stop("service", bad)
    # hov
    if "hov_lanes" in avoid:
        desig = f"COALESCE({t('hov')} = 'designated', FALSE)"
        lf_, lb_ = _g2("hov:lanes")

        def alld(x):
            return f"COALESCE(list_bool_and(list_transform(string_split({x}, '|'), lambda l: l = 'designated')), FALSE)"
        if p["weight_name"] == "routability":
            ch.update({"frs": f"frs OR {desig} OR {alld(lf_)}", "brs": f"brs OR {desig} OR {alld(lb_)}"})
        else:
            ch.update({"frs": f"frs OR {desig}", "brs": f"brs OR {desig}", "fm": f"CASE WHEN {alld(lf_)} THEN 'inaccessible' ELSE fm END",
                       "bm": f"CASE WHEN {alld(lb_)} THEN 'inaccessible' ELSE bm END"})
    # speed
    spd = case_table(t("highway"), p["speeds"]["highway"])
    ch.extra({"_skip": "fs <> -1", "_spd": spd})
    wl, bl = p["access_tag_whitelist"], p["access_tag_blacklist"]
    dflt = _dbl(p["default_speed"])

    def acc_speed(a, s):
        return (f"CASE WHEN {in_list(a, wl)} THEN {dflt} WHEN {a} IS NOT NULL AND NOT {in_list(a, bl)} THEN {dflt}"
                f" ELSE {s} END")
    ch.update({"fs": f"CASE WHEN _skip THEN fs WHEN _spd IS NOT NULL THEN _spd ELSE {acc_speed('d_fa', 'fs')} END",
               "bs": f"CASE WHEN _skip THEN bs WHEN _spd IS NOT NULL THEN _spd ELSE {acc_speed('d_ba', 'bs')} END",
               "fm": "CASE WHEN _skip OR _spd IS NOT NULL THEN fm WHEN d_fa IS NULL AND d_ba IS NOT NULL THEN 'inaccessible' ELSE fm END",
               "bm": "CASE WHEN _skip OR _spd IS NOT NULL THEN bm WHEN d_ba IS NULL AND d_fa IS NOT NULL THEN 'inaccessible' ELSE bm END"})
    ch.stop("speed", "NOT _skip AND fs = -1 AND bs = -1 AND dur <= 0")
    # maxspeed
    mf, mb = _g3(["maxspeed:advisory", "maxspeed", "source:maxspeed", "maxspeed:type"])
    pf, pb = _maxspeed(mf, p), _maxspeed(mb, p)
    ch.update({"fs": f"CASE WHEN {pf} > 0 THEN {pf} * {p['speed_reduction']} ELSE fs END",
               "bs": f"CASE WHEN {pb} > 0 THEN {pb} * {p['speed_reduction']} ELSE bs END"})
    # surface, tracktype, smoothness caps
    for key, table in (("surface", p["surface_speeds"]), ("tracktype", p["tracktype_speeds"]),
                       ("smoothness", p["smoothness_speeds"])):
        v = case_table(t(key), table)
        ch.update({"fs": f"CASE WHEN {v} IS NOT NULL THEN least({v}, fs) ELSE fs END",
                   "bs": f"CASE WHEN {v} IS NOT NULL THEN least({v}, bs) ELSE bs END"})
    # penalties (routability)
    sp = f"COALESCE({case_table(t('service'), p['service_penalties'])}, 1.0)"
    width = f"TRY_CAST(NULLIF(regexp_extract({t('width')}, '^([0-9]*)', 1), '') AS DOUBLE)"
    lanes = f"TRY_CAST(NULLIF(regexp_extract({t('lanes')}, '^([0-9]*)', 1), '') AS DOUBLE)"
    bidir = "(fm <> 'inaccessible' AND bm <> 'inaccessible')"
    wp = f"CASE WHEN COALESCE({width} <= 3, FALSE) OR (COALESCE({lanes} <= 1, FALSE) AND {bidir}) THEN 0.5 ELSE 1.0 END"
    ap = "CASE WHEN COALESCE(d_oneway = 'alternating', FALSE) THEN 0.4 ELSE 1.0 END"
    srp = f"CASE WHEN COALESCE({t('side_road')} IN ('yes', 'rotary'), FALSE) THEN {p['side_road_multiplier']} ELSE 1.0 END"
    pen = f"CAST(least({sp}, {wp}, {ap}, {srp}) AS DOUBLE)"
    if p["weight_name"] == "routability":
        ch.update({"fr": f"CASE WHEN fs > 0 THEN fs * {pen} / 3.6 ELSE fr END",
                   "br": f"CASE WHEN bs > 0 THEN bs * {pen} / 3.6 ELSE br END",
                   "wt": f"CASE WHEN dur > 0 THEN dur / {pen} ELSE wt END"})
    # classes
    allowed = set(p["classes"])
    tf, tb_ = _g2("toll")
    rf_, rb_ = _g2("route")
    tunnel = t("tunnel")

    def cls(toll, route, restricted):
        items = []
        if "ferry" in allowed:
            items.append(f"CASE WHEN COALESCE({route} = 'ferry', FALSE) THEN 'ferry' END")
        if "motorway" in allowed:
            items.append("CASE WHEN COALESCE(d_hw IN ('motorway', 'motorway_link'), FALSE) THEN 'motorway' END")
        if "restricted" in allowed:
            items.append(f"CASE WHEN {restricted} THEN 'restricted' END")
        if "toll" in allowed:
            items.append(f"CASE WHEN COALESCE({toll} = 'yes', FALSE) THEN 'toll' END")
        if "tunnel" in allowed:
            items.append(f"CASE WHEN {tunnel} IS NOT NULL AND {tunnel} <> 'no' THEN 'tunnel' END")
        return f"array_to_string(list_sort(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)), ',')"
    ch.update({"fcl": cls(tf, rf_, "frs"), "bcl": cls(tb_, rb_, "brs")})
    # turn lanes (psv counts and vehicle lanes absent in the fixture → plain turn lanes)
    tlf, tlb = _g2("turn:lanes")
    ch.update({"tlf": tlf, "tlb": tlb})
    # classification
    prio_map = {k: ROAD_PRIORITY[v] for k, v in HIGHWAY_CLASSES.items()}
    lc_ = f"TRY_CAST(trim({t('lanes')}) AS DOUBLE)"
    ch.update({"mc": f"mc OR {in_list('d_hw', MOTORWAY_TYPES)}", "lc": f"lc OR {in_list('d_hw', LINK_TYPES)}",
               "prio": f"CAST(CASE WHEN d_hw = 'service' THEN {ROAD_PRIORITY['alley']} ELSE COALESCE("
                       f"{case_table('d_hw', prio_map)}, {ROAD_PRIORITY['connectivity']}) END AS INTEGER)",
               "mbi": f"NOT {in_list('d_hw', ROAD_TYPES)}",
               "nl": f"CASE WHEN {t('lanes')} IS NOT NULL THEN COALESCE(CAST({lc_} AS INTEGER), nl) ELSE nl END"})
    ch.update({"rb": f"rb OR COALESCE({t('junction')} = 'roundabout', FALSE)",
               "circ": f"circ OR COALESCE({t('junction')} = 'circular', FALSE)"})
    ch.update({"isp": f"CASE WHEN COALESCE(d_hw = 'service', FALSE) AND {in_list('d_fa', p['service_access_tag_blacklist'])}"
                      f" THEN FALSE ELSE (fm = '{p['default_mode']}' OR bm = '{p['default_mode']}') END"})
    ch.update({"lhd": f"CASE WHEN {t('driving_side')} = 'left' THEN TRUE WHEN {t('driving_side')} = 'right' THEN FALSE"
                      f" ELSE {str(p['left_hand_driving']).upper()} END"})
    ch.update({"nm": f"COALESCE({t('name')}, nm)", "rf": f"COALESCE(regexp_replace({t('ref')}, '; *', '; ', 'g'), rf)",
               "ex": f"COALESCE(regexp_replace({t('junction:ref')}, '; *', '; ', 'g'), ex)"})
    more = ""
    if p["weight_name"] == "distance":
        ch.update({"wt": "CAST(-1 AS DOUBLE)", "fr": "CASE WHEN fm <> 'inaccessible' AND fs > 0 THEN CAST(1 AS DOUBLE) ELSE fr END",
                   "br": "CASE WHEN bm <> 'inaccessible' AND bs > 0 THEN CAST(1 AS DOUBLE) ELSE br END"})
    if p["highway_turn_classification"]:
        # the classes are set at the chain's end: stopped ways have none
        ch.extra({"htc": f"CASE WHEN alive THEN CAST({case_table(t('highway'), p['highway_turn_classification'])} AS INTEGER) END",
                  "atc": f"CASE WHEN alive THEN CAST({case_table(t('access'), p['access_turn_classification'])} AS INTEGER) END"})
        more = ", htc AS highway_turn_classification, atc AS access_turn_classification"
    if chain_only:
        return with_clause("ways", *extra_fixtures).rstrip("\n") + ",\n" + ch.sql(), ch.last
    final = (f"SELECT way_id, alive, stopped_at, fm AS forward_mode, bm AS backward_mode, round(fs, 6) AS forward_speed,"
             f" round(bs, 6) AS backward_speed, round(fr, 6) AS forward_rate, round(br, 6) AS backward_rate,"
             f" round(dur, 6) AS duration, round(wt, 6) AS weight, frs AS forward_restricted, brs AS backward_restricted,"
             f" fcl AS forward_classes, bcl AS backward_classes, nm AS name, rf AS ref, dst AS destinations, ex AS exits,"
             f" tlf AS turn_lanes_forward, tlb AS turn_lanes_backward, mc AS motorway_class, lc AS link_class,"
             f" prio AS road_priority_class, mbi AS may_be_ignored, nl AS num_lanes, rb AS roundabout, circ AS circular,"
             f" isp AS is_startpoint, lhd AS is_left_hand_driving{more} FROM {ch.last}")
    return with_clause("ways").rstrip("\n") + ",\n" + ch.sql() + "\n" + final


ORACLE["w29_car_ways"] = car_ways_sql(CAR)
ORACLE["w29_car_routable"] = (car_ways_sql(CAR).rsplit("SELECT way_id, alive", 1)[0]
                              + "SELECT way_id, fm AS forward_mode, bm AS backward_mode FROM "
                              + car_ways_sql(CAR).rsplit(" FROM ", 1)[1]
                              + " WHERE alive AND ((fm <> 'inaccessible' AND (fs > 0 OR dur > 0))"
                              " OR (bm <> 'inaccessible' AND (bs > 0 OR dur > 0)))")


def _car_edges_with(*more: str, profile: dict = CAR) -> str:
    """WITH … car chain, segments and directed car edges (CTE ``edges``)."""
    chain, last = car_ways_sql(profile, chain_only=True, extra_fixtures=("way_nodes", "nodes", "node_tags", *more))

    def side(fwd: bool) -> str:
        m, sp, rate, cl = ("fm", "fs", "fr", "fcl") if fwd else ("bm", "bs", "br", "bcl")
        src, dst = ("from", "to") if fwd else ("to", "from")
        share = "(CASE WHEN l.way_len > 0 THEN s.distance_m / l.way_len ELSE 0.0 END)"
        dur = f"(CASE WHEN c.dur > 0 THEN c.dur * {share} WHEN c.{sp} > 0 THEN s.distance_m / (c.{sp} / 3.6) END)"
        wt = f"(CASE WHEN c.{rate} > 0 THEN s.distance_m / c.{rate} WHEN c.wt > 0 THEN c.wt * {share} ELSE {dur} END)"
        return (f"SELECT s.way_id, s.seq, {str(fwd).upper()} AS forward, s.{src}_node AS source, s.{dst}_node AS target,"
                f" c.{m} AS mode, s.distance_m, round({dur}, 6) AS duration_s, round({wt}, 6) AS weight, c.{cl} AS classes"
                f" FROM seg s JOIN {last} c ON c.way_id = s.way_id JOIN way_len l ON l.way_id = s.way_id"
                f" WHERE c.alive AND c.{m} <> 'inaccessible' AND (c.{sp} > 0 OR c.dur > 0)")
    return (chain + ",\n" + SEG_CTE + ",\nway_len AS (SELECT way_id, sum(distance_m) AS way_len FROM seg GROUP BY way_id),"
            "\nedges AS (" + side(True) + " UNION ALL " + side(False) + ")")


def _car_node_cte() -> str:
    body = _car_nodes()
    return "car_nodes AS (" + body[body.index("SELECT n.node_id"):] + ")"


_EDGES = _car_edges_with()
ORACLE["e2_car_edges"] = _EDGES + "\nSELECT * FROM edges"
ORACLE["e3_edges_no_barriers"] = (_EDGES + ",\n" + _car_node_cte() + "\nSELECT e.way_id, e.seq, e.forward, e.source,"
                                  " e.target, e.duration_s, COALESCE(k.traffic_lights, FALSE) AS target_traffic_light"
                                  " FROM edges e LEFT JOIN (SELECT node_id, traffic_lights FROM car_nodes WHERE traffic_lights)"
                                  " k ON k.node_id = e.target"
                                  " WHERE e.source NOT IN (SELECT node_id FROM car_nodes WHERE barrier)"
                                  " AND e.target NOT IN (SELECT node_id FROM car_nodes WHERE barrier)")
ORACLE["e4_node_degree"] = (_EDGES + "\nSELECT node_id, count(DISTINCT way_id) AS number_of_roads FROM ("
                            "SELECT source AS node_id, way_id FROM edges UNION ALL SELECT target, way_id FROM edges) t"
                            " GROUP BY node_id")
ORACLE["b9_exclude_classes"] = (_EDGES + "\nSELECT way_id, seq, forward, source, target FROM edges"
                                " WHERE NOT regexp_matches(classes, '(^|,)(toll|motorway)(,|$)')")


def _snap(points_cte: str, fixture: str) -> str:
    hav = haversine_sql("p.longitude", "p.latitude", "n.lon", "n.lat")
    return (_car_edges_with(fixture) + ",\n" + points_cte + ",\nnet AS (SELECT * FROM nodes WHERE node_id IN"
            " (SELECT source FROM edges UNION SELECT target FROM edges))\n"
            f"SELECT key, arg_min(n.node_id, ({hav}, n.node_id)) AS node_id, round(min({hav}), 3) AS snap_m"
            " FROM pts p, net n GROUP BY p.key, p.longitude, p.latitude")


def _site_pts_cte() -> str:
    from odspark.registry.distance import _CTE
    return ("site_typed AS (" + _CTE["site_typed"] + "), site_max AS (" + _CTE["site_max"] + "), site_pts AS ("
            + _CTE["site_pts"] + "), pts AS (SELECT DISTINCT kh_key AS key, longitude, latitude FROM site_pts)")


def _postal_pts_cte() -> str:
    from odspark.registry.distance import _CTE
    return ("postal_pts AS (" + _CTE["postal_pts"] + "), pts AS (SELECT plz AS key, longitude_plz AS longitude,"
            " latitude_plz AS latitude FROM postal_pts)")


ORACLE["e5_snap_sites"] = _snap(_site_pts_cte(), "sites")
ORACLE["e5_snap_postal"] = _snap(_postal_pts_cte(), "postal")


def _raster_q2() -> str:
    """Bilinear datum at both edge ends; slope = |source − target| / distance."""
    b = RASTER_BOUNDS
    base = _raster_q1()
    head = base[:base.index("ends AS (")]

    def interp(lon, lat, name):
        fx = f"(({lon} - {b['lon_min']}) / ({b['lon_max']} - {b['lon_min']}) * {b['ncols'] - 1})"
        fy = f"(({b['lat_max']} - {lat}) / ({b['lat_max']} - {b['lat_min']}) * {b['nrows'] - 1})"
        inside = f"({fx} >= 0 AND {fx} <= {b['ncols'] - 1} AND {fy} >= 0 AND {fy} <= {b['nrows'] - 1})"
        x0 = f"least(floor({fx}), {b['ncols'] - 2})"
        y0 = f"least(floor({fy}), {b['nrows'] - 2})"
        return (f"CASE WHEN {inside} THEN {fx} END AS {name}_fx, CASE WHEN {inside} THEN {fy} END AS {name}_fy,"
                f" CASE WHEN {inside} THEN {x0} END AS {name}_x0, CASE WHEN {inside} THEN {y0} END AS {name}_y0")

    def val(name):
        def d(dy, dx):
            return (f"(SELECT datum FROM raster r WHERE r.row = e.{name}_y0 + {dy} AND r.col = e.{name}_x0 + {dx})")
        tx, ty = f"(e.{name}_fx - e.{name}_x0)", f"(e.{name}_fy - e.{name}_y0)"
        return (f"((1 - {ty}) * ((1 - {tx}) * {d(0, 0)} + {tx} * {d(0, 1)})"
                f" + {ty} * ((1 - {tx}) * {d(1, 0)} + {tx} * {d(1, 1)}))")

    ends = (f"ends AS (SELECT e.*, {interp('CASE WHEN e.forward THEN s.from_lon ELSE s.to_lon END', 'CASE WHEN e.forward THEN s.from_lat ELSE s.to_lat END', 'sd')},"
            f" {interp('CASE WHEN e.forward THEN s.to_lon ELSE s.from_lon END', 'CASE WHEN e.forward THEN s.to_lat ELSE s.from_lat END', 'td')}"
            f" FROM edges e JOIN seg s ON s.way_id = e.way_id AND s.seq = e.seq),"
            f"\nvals AS (SELECT e.*, {val('sd')} AS sd, {val('td')} AS td FROM ends e)")
    return (head + ends + "\nSELECT x.way_id, x.seq, x.source, x.target, x.distance_m,"
            " round(CASE WHEN ok THEN x.weight / f ELSE x.weight END, 6) AS weight,"
            " round(CASE WHEN ok THEN x.duration_s / f ELSE x.duration_s END, 6) AS duration_s"
            " FROM (SELECT *, sd IS NOT NULL AND td IS NOT NULL AND distance_m > 0 AS ok,"
            " 1.0 - abs(sd - td) / distance_m * 5.0 AS f FROM vals) x")


ORACLE["q2_raster_interpolated"] = _raster_q2()


def foot_ways_sql(p: dict = FOOT) -> str:
    """Foot chain: mode, blocked, access, specific one-way, ferries, speed table, surface, guidance, names."""
    from odspark.plans.profiles import HIGHWAY_CLASSES, LINK_TYPES, MOTORWAY_TYPES, ROAD_PRIORITY, ROAD_TYPES
    keep = " OR ".join(f"{t(k)} IS NOT NULL" for k in p["prefetch"])
    ch = _Chain(
        f"SELECT *, TRUE AS alive, CAST(NULL AS VARCHAR) AS stopped_at, 'inaccessible' AS fm, 'inaccessible' AS bm,"
        f" {_dbl(-1)} AS fs, {_dbl(-1)} AS bs, {_dbl(0)} AS dur, FALSE AS frs, FALSE AS brs,"
        f" CAST(NULL AS VARCHAR) AS nm, CAST(NULL AS VARCHAR) AS rf, CAST(NULL AS VARCHAR) AS ex,"
        f" CAST(NULL AS VARCHAR) AS dst, FALSE AS mc, FALSE AS lc, CAST(NULL AS INTEGER) AS prio,"
        f" CAST(NULL AS BOOLEAN) AS mbi, CAST(0 AS INTEGER) AS nl, FALSE AS rb, FALSE AS circ,"
        f" CAST(NULL AS BOOLEAN) AS isp, {t('highway')} AS d_hw, {t('route')} AS d_route, {t('bridge')} AS d_bridge,"
        f" CAST(NULL AS VARCHAR) AS d_oneway, FALSE AS d_fow, FALSE AS d_row, CAST(NULL AS VARCHAR) AS d_fa,"
        f" CAST(NULL AS VARCHAR) AS d_ba FROM ways WHERE {keep}")
    ch.update({"fm": f"'{p['default_mode']}'", "bm": f"'{p['default_mode']}'"})
    if "impassable" in p["avoid"]:
        ch.stop("blocked_ways", f"COALESCE({t('impassable')} = 'yes' OR {t('status')} = 'impassable', FALSE)")
    af, ab = _g3(p["access_tags_hierarchy"])
    ch.extra({"_af": af, "_ab": ab})
    ch.update({"d_fa": "_af", "d_ba": "_ab",
               "fm": f"CASE WHEN {in_list('_af', p['access_tag_blacklist'])} THEN 'inaccessible' ELSE fm END",
               "bm": f"CASE WHEN {in_list('_ab', p['access_tag_blacklist'])} THEN 'inaccessible' ELSE bm END"})
    ch.stop("access", "fm = 'inaccessible' AND bm = 'inaccessible'")
    ow = coalesce(*[t(f"oneway:{k}") for k in p["restrictions"]])
    rev = f"COALESCE({ow} = '-1', FALSE)"
    fwd = f"COALESCE({ow} IN ('yes', '1', 'true'), FALSE)"
    ch.update({"d_oneway": ow, "d_row": rev, "d_fow": fwd, "fm": f"CASE WHEN {rev} THEN 'inaccessible' ELSE fm END",
               "bm": f"CASE WHEN {fwd} THEN 'inaccessible' ELSE bm END"})
    parsed = duration(t("duration"))
    rs = case_table("d_route", p["route_speeds"])
    on = f"COALESCE({rs} > 0, FALSE)"
    ch.update({"dur": f"CASE WHEN {on} AND {parsed} IS NOT NULL THEN greatest({parsed}, 1.0) ELSE dur END",
               "fm": f"CASE WHEN {on} THEN 'ferry' ELSE fm END", "bm": f"CASE WHEN {on} THEN 'ferry' ELSE bm END",
               "fs": f"CASE WHEN {on} THEN {rs} ELSE fs END", "bs": f"CASE WHEN {on} THEN {rs} ELSE bs END"})
    spd = coalesce(*[case_table(t(k), table) for k, table in p["speeds"].items()])
    ch.extra({"_skip": "fs <> -1", "_spd": spd})
    wl, bl = p["access_tag_whitelist"], p["access_tag_blacklist"]
    dflt = _dbl(p["default_speed"])

    def acc_speed(a, s):
        return (f"CASE WHEN {in_list(a, wl)} THEN {dflt} WHEN {a} IS NOT NULL AND NOT {in_list(a, bl)} THEN {dflt}"
                f" ELSE {s} END")
    ch.update({"fs": f"CASE WHEN _skip THEN fs WHEN _spd IS NOT NULL THEN _spd ELSE {acc_speed('d_fa', 'fs')} END",
               "bs": f"CASE WHEN _skip THEN bs WHEN _spd IS NOT NULL THEN _spd ELSE {acc_speed('d_ba', 'bs')} END",
               "fm": "CASE WHEN _skip OR _spd IS NOT NULL THEN fm WHEN d_fa IS NULL AND d_ba IS NOT NULL THEN 'inaccessible' ELSE fm END",
               "bm": "CASE WHEN _skip OR _spd IS NOT NULL THEN bm WHEN d_ba IS NULL AND d_fa IS NOT NULL THEN 'inaccessible' ELSE bm END"})
    ch.stop("speed", "NOT _skip AND fs = -1 AND bs = -1 AND dur <= 0")
    v = case_table(t("surface"), p["surface_speeds"])
    ch.update({"fs": f"CASE WHEN {v} IS NOT NULL THEN least({v}, fs) ELSE fs END",
               "bs": f"CASE WHEN {v} IS NOT NULL THEN least({v}, bs) ELSE bs END"})
    prio_map = {k: ROAD_PRIORITY[x] for k, x in HIGHWAY_CLASSES.items()}
    lc_ = f"TRY_CAST(trim({t('lanes')}) AS DOUBLE)"
    ch.update({"mc": f"mc OR {in_list('d_hw', MOTORWAY_TYPES)}", "lc": f"lc OR {in_list('d_hw', LINK_TYPES)}",
               "prio": f"CAST(CASE WHEN d_hw = 'service' THEN {ROAD_PRIORITY['alley']} ELSE COALESCE("
                       f"{case_table('d_hw', prio_map)}, {ROAD_PRIORITY['connectivity']}) END AS INTEGER)",
               "mbi": f"NOT {in_list('d_hw', ROAD_TYPES)}",
               "nl": f"CASE WHEN {t('lanes')} IS NOT NULL THEN COALESCE(CAST({lc_} AS INTEGER), nl) ELSE nl END"})
    ch.update({"rb": f"rb OR COALESCE({t('junction')} = 'roundabout', FALSE)",
               "circ": f"circ OR COALESCE({t('junction')} = 'circular', FALSE)"})
    ch.update({"isp": f"(fm = '{p['default_mode']}' OR bm = '{p['default_mode']}')"})
    ch.update({"nm": f"COALESCE({t('name')}, nm)", "rf": f"COALESCE(regexp_replace({t('ref')}, '; *', '; ', 'g'), rf)",
               "ex": f"COALESCE(regexp_replace({t('junction:ref')}, '; *', '; ', 'g'), ex)"})
    final = (f"SELECT way_id, alive, stopped_at, fm AS forward_mode, bm AS backward_mode, round(fs, 6) AS forward_speed,"
             f" round(bs, 6) AS backward_speed, CAST(NULL AS DOUBLE) AS forward_rate, CAST(NULL AS DOUBLE) AS backward_rate,"
             f" round(dur, 6) AS duration, CAST(NULL AS DOUBLE) AS weight, frs AS forward_restricted,"
             f" brs AS backward_restricted, '' AS forward_classes, '' AS backward_classes, nm AS name, rf AS ref,"
             f" dst AS destinations, ex AS exits, CAST(NULL AS VARCHAR) AS turn_lanes_forward,"
             f" CAST(NULL AS VARCHAR) AS turn_lanes_backward, mc AS motorway_class, lc AS link_class,"
             f" prio AS road_priority_class, mbi AS may_be_ignored, nl AS num_lanes, rb AS roundabout, circ AS circular,"
             f" isp AS is_startpoint, FALSE AS is_left_hand_driving FROM {ch.last}")
    return with_clause("ways").rstrip("\n") + ",\n" + ch.sql() + "\n" + final


ORACLE["w29_foot_ways"] = foot_ways_sql(FOOT)


def bicycle_ways_sql(p: dict = BICYCLE) -> str:
    """Bicycle chain: check + access, speed ladder, one-way ladder, cycleways, pushing, caps, surface, guidance."""
    from odspark.plans.profiles import HIGHWAY_CLASSES, LINK_TYPES, MOTORWAY_TYPES, ROAD_PRIORITY, ROAD_TYPES
    ch = _Chain(
        f"SELECT *, TRUE AS alive, CAST(NULL AS VARCHAR) AS stopped_at, 'inaccessible' AS fm, 'inaccessible' AS bm,"
        f" {_dbl(-1)} AS fs, {_dbl(-1)} AS bs, {_dbl(0)} AS dur, '' AS fcl, '' AS bcl, CAST(NULL AS DOUBLE) AS fr,"
        f" CAST(NULL AS DOUBLE) AS br, CAST(NULL AS DOUBLE) AS wt,"
        f" CAST(NULL AS VARCHAR) AS nm, CAST(NULL AS VARCHAR) AS rf, CAST(NULL AS VARCHAR) AS ex,"
        f" FALSE AS mc, FALSE AS lc, CAST(NULL AS INTEGER) AS prio, CAST(NULL AS BOOLEAN) AS mbi,"
        f" CAST(0 AS INTEGER) AS nl, FALSE AS rb, FALSE AS circ, CAST(NULL AS BOOLEAN) AS isp,"
        f" {t('highway')} AS d_hw, {t('route')} AS d_route, {t('bridge')} AS d_bridge, CAST(NULL AS VARCHAR) AS d_oneway,"
        f" CAST(NULL AS VARCHAR) AS d_acc, CAST(NULL AS VARCHAR) AS d_branch, CAST(NULL AS DOUBLE) AS d_dur,"
        f" FALSE AS d_push, FALSE AS d_implied, FALSE AS d_rev FROM ways")
    ch.update({"fm": f"'{p['default_mode']}'", "bm": f"'{p['default_mode']}'"})
    conds = [f"(d_hw = 'construction' OR {t('railway')} = 'construction')",
             f"({t('construction')} IS NOT NULL AND NOT {in_list(t('construction'), p['construction_whitelist'])})",
             f"({t('impassable')} = 'yes' OR {t('status')} = 'impassable')"]
    ch.stop("blocked_ways", " OR ".join(f"COALESCE({c}, FALSE)" for c in conds))

    def empty(x):
        return f"({x} IS NULL OR {x} = '')"
    nothing = " AND ".join(empty(x) for x in ["d_hw", t("route"), t("railway"), t("amenity"), t("man_made"),
                                               t("public_transport"), t("bridge")])
    acc = coalesce(*[t(k) for k in p["access_tags_hierarchy"]])
    ch.update({"d_acc": acc})
    ch.stop("bicycle_check", f"({nothing}) OR {in_list('d_acc', p['access_tag_blacklist'])}")
    bridge_sp = case_table("d_bridge", p["bridge_speeds"])
    route_sp = case_table("d_route", p["route_speeds"])
    plat = case_table(t("railway"), p["platform_speeds"])
    plat_pt = case_table(t("public_transport"), p["platform_speeds"])
    rail = case_table(t("railway"), p["railway_speeds"])
    amen = case_table(t("amenity"), p["amenity_speeds"])
    bike = case_table("d_hw", p["bicycle_speeds"])
    wl = in_list("d_acc", p["access_tag_whitelist"])
    branch = (f"CASE WHEN COALESCE({bridge_sp} > 0, FALSE) THEN 'bridge' WHEN {route_sp} IS NOT NULL THEN 'route'"
              f" WHEN {plat} IS NOT NULL THEN 'platform' WHEN {plat_pt} IS NOT NULL THEN 'platform_pt'"
              f" WHEN {rail} IS NOT NULL AND {wl} THEN 'rail' WHEN {amen} IS NOT NULL THEN 'amenity'"
              f" WHEN {bike} IS NOT NULL THEN 'highway' WHEN {wl} THEN 'access' END")
    ch.update({"d_branch": branch, "d_dur": duration(t("duration"))})
    sp = (f"CASE WHEN d_branch = 'bridge' THEN {bridge_sp} WHEN d_branch = 'route' AND d_dur IS NULL THEN {route_sp}"
          f" WHEN d_branch = 'platform' THEN {plat} WHEN d_branch = 'platform_pt' THEN {plat_pt}"
          f" WHEN d_branch = 'rail' THEN {rail} WHEN d_branch = 'amenity' THEN {amen} WHEN d_branch = 'highway' THEN {bike}"
          f" WHEN d_branch = 'access' THEN {_dbl(p['default_speed'])} END")
    md = "CASE WHEN d_branch = 'route' THEN 'ferry' WHEN d_branch = 'rail' THEN 'train' END"
    ch.update({"fs": f"COALESCE({sp}, fs)", "bs": f"COALESCE({sp}, bs)", "fm": f"COALESCE({md}, fm)",
               "bm": f"COALESCE({md}, bm)",
               "dur": "CASE WHEN COALESCE(d_branch IN ('bridge', 'route'), FALSE) AND d_dur IS NOT NULL"
                      " THEN greatest(d_dur, 1.0) ELSE dur END",
               "d_push": "COALESCE(d_branch IN ('bridge', 'platform', 'platform_pt', 'amenity', 'highway', 'access'), FALSE)",
               "d_hw": "CASE WHEN COALESCE(d_branch = 'bridge', FALSE) THEN d_bridge ELSE d_hw END"})
    ob, o = t("oneway:bicycle"), t("oneway")
    implied = f"(COALESCE({t('junction')} IN ('roundabout', 'circular'), FALSE) OR COALESCE(d_hw = 'motorway', FALSE))"
    ladder_close_b = (f"CASE WHEN COALESCE({ob} IN ('yes', '1', 'true'), FALSE) THEN TRUE"
                      f" WHEN COALESCE({ob} IN ('no', '0', 'false', '-1'), FALSE) THEN FALSE"
                      f" WHEN COALESCE({o} IN ('yes', '1', 'true'), FALSE) THEN TRUE"
                      f" WHEN COALESCE({o} IN ('no', '0', 'false', '-1'), FALSE) THEN FALSE ELSE {implied} END")
    ladder_rev = (f"CASE WHEN COALESCE({ob} IN ('yes', '1', 'true', 'no', '0', 'false'), FALSE) THEN FALSE"
                  f" WHEN COALESCE({ob} = '-1', FALSE) THEN TRUE"
                  f" WHEN COALESCE({o} IN ('yes', '1', 'true', 'no', '0', 'false'), FALSE) THEN FALSE"
                  f" WHEN COALESCE({o} = '-1', FALSE) THEN TRUE ELSE FALSE END")
    ch.update({"d_implied": implied, "d_rev": ladder_rev, "d_oneway": o,
               "fm": f"CASE WHEN {ladder_rev} THEN 'inaccessible' ELSE fm END",
               "bm": f"CASE WHEN {ladder_close_b} THEN 'inaccessible' ELSE bm END"})
    cw, cwl, cwr = t("cycleway"), t("cycleway:left"), t("cycleway:right")
    tg, op = p["cycleway_tags"], p["opposite_cycleway_tags"]
    twoway = "(fm <> 'inaccessible' AND bm <> 'inaccessible' AND NOT d_implied)"
    two_f = f"({in_list(cw, tg)} OR {in_list(cwr, tg)} OR {in_list(cwl, op)})"
    two_b = f"({in_list(cw, tg)} OR {in_list(cwl, tg)} OR {in_list(cwr, op)})"
    has_two = f"({in_list(cw, op)} OR {in_list(cwr, op)} OR {in_list(cwl, op)})"
    has_opp = f"({in_list(cwl, op)} OR {in_list(cwr, op)})"
    has_one = f"({in_list(cw, tg)} OR {in_list(cwr, tg)} OR {in_list(cwl, tg)})"
    one_f = (f"CASE WHEN {has_two} THEN TRUE WHEN {has_opp} THEN d_rev WHEN {has_one} THEN NOT d_rev ELSE FALSE END")
    one_b = (f"CASE WHEN {has_two} THEN TRUE WHEN {has_opp} THEN NOT d_rev WHEN {has_one} THEN d_rev ELSE FALSE END")
    cf = f"(CASE WHEN {twoway} THEN {two_f} ELSE {one_f} END)"
    cb = f"(CASE WHEN {twoway} THEN {two_b} ELSE {one_b} END)"
    csp = _dbl(p["bicycle_speeds"]["cycleway"])
    ch.extra({"_tw": twoway, "_cf": cf, "_cb": cb})
    ch.update({"fm": "CASE WHEN _cf THEN 'cycling' ELSE fm END", "bm": "CASE WHEN _cb THEN 'cycling' ELSE bm END",
               "fs": f"CASE WHEN _cf THEN {csp} ELSE fs END", "bs": f"CASE WHEN _cb THEN {csp} ELSE bs END"})
    walk = _dbl(p["walking_speed"])
    foot, ff, fb = t("foot"), t("foot:forward"), t("foot:backward")
    table = coalesce(case_table("d_hw", p["pedestrian_speeds"]), case_table(t("man_made"), p["man_made_speeds"]))
    push_f = (f"CASE WHEN {table} IS NOT NULL THEN {table} WHEN COALESCE({foot} = 'yes', FALSE) THEN {walk}"
              f" WHEN COALESCE({ff} = 'yes', FALSE) THEN {walk} WHEN COALESCE({fb} = 'yes', FALSE) THEN NULL"
              f" WHEN d_push THEN {walk} END")
    push_b = (f"CASE WHEN {table} IS NOT NULL THEN {table} WHEN COALESCE({foot} = 'yes', FALSE) THEN"
              f" (CASE WHEN NOT d_implied THEN {walk} END) WHEN COALESCE({ff} = 'yes', FALSE) THEN NULL"
              f" WHEN COALESCE({fb} = 'yes', FALSE) THEN {walk} WHEN d_push THEN (CASE WHEN NOT d_implied THEN {walk} END) END")
    need = "(fm = 'inaccessible' OR bm = 'inaccessible' OR fs = -1 OR bs = -1)"
    foot_ok = f"COALESCE({foot} <> 'no', TRUE)"
    do_f = f"({need} AND {foot_ok} AND {push_f} IS NOT NULL AND (fm = 'inaccessible' OR fs = -1))"
    do_b = f"({need} AND {foot_ok} AND {push_b} IS NOT NULL AND (bm = 'inaccessible' OR bs = -1))"
    dis = f"COALESCE({t('bicycle')} = 'dismount', FALSE)"
    ch.update({"fm": f"CASE WHEN {dis} OR {do_f} THEN 'pushing_bike' ELSE fm END",
               "bm": f"CASE WHEN {dis} OR {do_b} THEN 'pushing_bike' ELSE bm END",
               "fs": f"CASE WHEN {dis} THEN {walk} WHEN {do_f} THEN {push_f} ELSE fs END",
               "bs": f"CASE WHEN {dis} THEN {walk} WHEN {do_b} THEN {push_b} ELSE bs END"})
    mx = f"COALESCE({speed(t('maxspeed'))}, 0.0)"
    mxf = f"COALESCE({speed(t('maxspeed:forward'))}, 0.0)"
    mxb = f"COALESCE({speed(t('maxspeed:backward'))}, 0.0)"
    ch.update({"fs": limit_speed("fs", mx, mxf), "bs": limit_speed("bs", mx, mxb)})
    ch.update({"fm": "CASE WHEN fs <= 0 AND dur <= 0 THEN 'inaccessible' ELSE fm END",
               "bm": "CASE WHEN bs <= 0 AND dur <= 0 THEN 'inaccessible' ELSE bm END"})
    if p.get("weight_name") == "cyclability":
        pen0 = f"COALESCE({case_table('d_hw', p['unsafe_highway_list'])}, 1.0)"
        unsafe = f"({pen0} < 1)"
        pen = (f"(CASE WHEN {unsafe} AND COALESCE(d_hw = 'primary', FALSE) AND NOT _tw THEN {pen0} * 0.5"
               f" WHEN {unsafe} AND COALESCE(d_hw = 'secondary', FALSE) AND NOT _tw THEN {pen0} * 0.6 ELSE {pen0} END)")
        svc = case_table(t("service"), p["service_penalties"])
        undes = f"(COALESCE(d_hw = 'service', FALSE) AND {svc} IS NOT NULL)"

        def dp(cyc):
            base = f"(CASE WHEN {unsafe} AND NOT {cyc} THEN least(1.0, {pen}) ELSE 1.0 END)"
            return f"(CASE WHEN {undes} THEN least({base}, {svc}) ELSE {base} END)"
        ch.update({"fr": f"CASE WHEN fs > 0 THEN fs / 3.6 * {dp('_cf')} ELSE fr END",
                   "br": f"CASE WHEN bs > 0 THEN bs / 3.6 * {dp('_cb')} ELSE br END",
                   "wt": f"CASE WHEN dur > 0 THEN dur / {dp('_cf')} ELSE wt END"})
    v = case_table(t("surface"), p["surface_speeds"])
    ch.update({"fs": f"CASE WHEN {v} IS NOT NULL THEN least({v}, fs) ELSE fs END",
               "bs": f"CASE WHEN {v} IS NOT NULL THEN least({v}, bs) ELSE bs END"})
    prio_map = {k: ROAD_PRIORITY[x] for k, x in HIGHWAY_CLASSES.items()}
    lc_ = f"TRY_CAST(trim({t('lanes')}) AS DOUBLE)"
    ch.update({"mc": f"mc OR {in_list('d_hw', MOTORWAY_TYPES)}", "lc": f"lc OR {in_list('d_hw', LINK_TYPES)}",
               "prio": f"CAST(CASE WHEN d_hw = 'service' THEN {ROAD_PRIORITY['alley']} ELSE COALESCE("
                       f"{case_table('d_hw', prio_map)}, {ROAD_PRIORITY['connectivity']}) END AS INTEGER)",
               "mbi": f"NOT {in_list('d_hw', ROAD_TYPES)}",
               "nl": f"CASE WHEN {t('lanes')} IS NOT NULL THEN COALESCE(CAST({lc_} AS INTEGER), nl) ELSE nl END"})
    starts = ", ".join(f"'{m}'" for m in p["allowed_start_modes"])
    ch.update({"isp": f"(fm IN ({starts}) OR bm IN ({starts}))"})
    ch.update({"rb": f"rb OR COALESCE({t('junction')} = 'roundabout', FALSE)",
               "circ": f"circ OR COALESCE({t('junction')} = 'circular', FALSE)"})
    ch.update({"nm": f"COALESCE({t('name')}, nm)", "rf": f"COALESCE(regexp_replace({t('ref')}, '; *', '; ', 'g'), rf)",
               "ex": f"COALESCE(regexp_replace({t('junction:ref')}, '; *', '; ', 'g'), ex)"})
    # classes: the bicycle one-way ladder never sets the direction flags, so with any oneway value
    # only the :forward / :backward keys count
    rf_f = f"CASE WHEN d_oneway IS NULL THEN COALESCE({t('route:forward')}, {t('route')}) ELSE {t('route:forward')} END"
    rf_b = f"CASE WHEN d_oneway IS NULL THEN COALESCE({t('route:backward')}, {t('route')}) ELSE {t('route:backward')} END"
    tun = t("tunnel")

    def cls(route):
        items = [f"CASE WHEN COALESCE({route} = 'ferry', FALSE) THEN 'ferry' END",
                 f"CASE WHEN {tun} IS NOT NULL AND {tun} <> 'no' THEN 'tunnel' END"]
        return f"array_to_string(list_sort(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)), ',')"
    ch.update({"fcl": cls(rf_f), "bcl": cls(rf_b)})
    final = (f"SELECT way_id, alive, stopped_at, fm AS forward_mode, bm AS backward_mode, round(fs, 6) AS forward_speed,"
             f" round(bs, 6) AS backward_speed, round(fr, 6) AS forward_rate, round(br, 6) AS backward_rate,"
             f" round(dur, 6) AS duration, round(wt, 6) AS weight, FALSE AS forward_restricted,"
             f" FALSE AS backward_restricted, fcl AS forward_classes, bcl AS backward_classes, nm AS name, rf AS ref,"
             f" CAST(NULL AS VARCHAR) AS destinations, ex AS exits, CAST(NULL AS VARCHAR) AS turn_lanes_forward,"
             f" CAST(NULL AS VARCHAR) AS turn_lanes_backward, mc AS motorway_class, lc AS link_class,"
             f" prio AS road_priority_class, mbi AS may_be_ignored, nl AS num_lanes, rb AS roundabout, circ AS circular,"
             f" isp AS is_startpoint, FALSE AS is_left_hand_driving FROM {ch.last}")
    return with_clause("ways").rstrip("\n") + ",\n" + ch.sql() + "\n" + final


ORACLE["b_bicycle_ways"] = bicycle_ways_sql(BICYCLE)
ORACLE["b7_bicycle_cyclability"] = bicycle_ways_sql(BICYCLE_CYCLABILITY)


def _ref_match_sql() -> str:
    """L4: per (way, ref token) the forward / backward direction from the best-matching route relations."""
    wr_body = WAY_RELATIONS[WAY_RELATIONS.index("pd AS ("):]
    wr_body = wr_body[:wr_body.rindex("SELECT way_id, rel_id,")].rstrip() + ",\n"
    wr_select = WAY_RELATIONS[WAY_RELATIONS.rindex("SELECT way_id, rel_id,"):]

    def toks(x):
        return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda s: s <> '')"

    def score(tok, tag):
        return (f"COALESCE(list_sum(list_transform(list_filter({toks(tok)}, lambda s: list_contains({toks(tag)}, s)),"
                f" lambda s: CASE WHEN TRY_CAST(trim(s) AS DOUBLE) IS NOT NULL THEN 2 ELSE 1 END)), 0)")
    # the ref that the car chain set, not the raw tag
    chain, last = car_ways_sql(CAR, chain_only=True, extra_fixtures=("relations", "relation_members"))
    return (chain + ",\n" + wr_body +
            f"wr AS ({wr_select}),\n"
            "refs AS (SELECT way_id, list_transform(list_filter(string_split(rf, ';'), lambda x: x <> ''), lambda x: trim(x)) AS tl"
            f" FROM {last} WHERE rf IS NOT NULL),\n"
            "toks AS (SELECT way_id, unnest(tl) AS token, unnest(range(len(tl))) AS pos FROM refs),\n"
            "firstpos AS (SELECT way_id, token, min(pos) AS tpos FROM toks GROUP BY way_id, token),\n"
            "cand AS (SELECT t.way_id, t.pos, t.token, f.tpos, r.rel_id, r.route_name, r.route_ref FROM toks t"
            " JOIN firstpos f ON f.way_id = t.way_id AND f.token = t.token"
            " JOIN wr r ON r.way_id = t.way_id WHERE r.route_direction IS NOT NULL),\n"
            f"scored AS (SELECT way_id, rel_id, token, tpos, 0 AS src, {score('token', 'route_name')} AS score FROM cand"
            f" WHERE route_name IS NOT NULL UNION ALL SELECT way_id, rel_id, token, tpos, 1 AS src,"
            f" {score('token', 'route_ref')} AS score FROM cand WHERE route_ref IS NOT NULL),\n"
            "best AS (SELECT way_id, rel_id, arg_max(token, (score, -src, -tpos)) AS token FROM scored GROUP BY way_id, rel_id),\n"
            "assigned AS (SELECT b.way_id, b.token, r.rel_id, r.route_direction, r.route_forward FROM best b"
            " JOIN wr r ON r.way_id = b.way_id AND r.rel_id = b.rel_id),\n"
            "pertok AS (SELECT way_id, token,"
            " arg_max(route_direction, rel_id) FILTER (WHERE route_forward IS NULL OR route_forward) AS forward_dir,"
            " arg_max(route_direction, rel_id) FILTER (WHERE route_forward IS NULL OR NOT route_forward) AS backward_dir"
            " FROM assigned GROUP BY way_id, token),\n"
            "matched AS (SELECT t.way_id, t.pos, t.token, p.forward_dir, p.backward_dir FROM toks t"
            " LEFT JOIN pertok p ON p.way_id = t.way_id AND p.token = t.token)\n")


ORACLE["l4_match_refs"] = _ref_match_sql() + "SELECT * FROM matched"
ORACLE["l5_way_refs"] = (_ref_match_sql() + "SELECT way_id,"
                         " string_agg(CASE WHEN forward_dir IS NOT NULL THEN token || ' $' || forward_dir ELSE token END,"
                         " '; ' ORDER BY pos) AS forward_ref,"
                         " string_agg(CASE WHEN backward_dir IS NOT NULL THEN token || ' $' || backward_dir ELSE token END,"
                         " '; ' ORDER BY pos) AS backward_ref FROM matched GROUP BY way_id")


def _routes_sql() -> str:
    """E6 oracle: barrier-free car edges, site points snapped to their nodes, and a recursive
    least-(duration, distance) relaxation keyed by (origin, node)."""
    hav = haversine_sql("p.longitude", "p.latitude", "n.lon", "n.lat")
    body = (_car_edges_with("sites") + ",\n" + _car_node_cte() +
            ",\neb AS (SELECT * FROM edges WHERE source NOT IN (SELECT node_id FROM car_nodes WHERE barrier)"
            " AND target NOT IN (SELECT node_id FROM car_nodes WHERE barrier))"
            ",\n" + _site_pts_cte() +
            ",\nnet AS (SELECT * FROM nodes WHERE node_id IN (SELECT source FROM eb UNION SELECT target FROM eb))"
            f",\nsnapped AS (SELECT key, arg_min(n.node_id, ({hav}, n.node_id)) AS node_id FROM pts p, net n"
            " GROUP BY p.key, p.longitude, p.latitude)"
            ",\norig AS (SELECT DISTINCT node_id AS node FROM snapped)"
            ",\nsp(origin, node, d, m) USING KEY (origin, node) AS ("
            "SELECT node AS origin, node, CAST(0 AS DOUBLE) AS d, CAST(0 AS DOUBLE) AS m FROM orig"
            " UNION (SELECT c.origin, c.node, c.d, c.m FROM ("
            "SELECT s.origin, e.target AS node, arg_min(s.d + e.duration_s, (s.d + e.duration_s, s.m + e.distance_m)) AS d,"
            " arg_min(s.m + e.distance_m, (s.d + e.duration_s, s.m + e.distance_m)) AS m"
            " FROM sp s JOIN eb e ON e.source = s.node GROUP BY s.origin, e.target) c"
            " LEFT JOIN recurring.sp r ON r.origin = c.origin AND r.node = c.node"
            " WHERE r.node IS NULL OR (c.d, c.m) < (r.d, r.m)))\n"
            "SELECT origin, node, round(d, 3) AS duration_s, round(m, 3) AS distance_m FROM sp")
    assert body.startswith("WITH ")
    return "WITH RECURSIVE " + body[len("WITH "):]


ORACLE["e6_routes"] = _routes_sql()


def _route_table_sql() -> str:
    """E7 oracle body: WITH … routes, snapped sites and postal codes → legs (key1, key2, distance_m, duration_s)."""
    from odspark.registry.distance import _CTE
    base = _routes_sql()
    head = base[:base.rindex("SELECT origin, node, round(d, 3)")].rstrip()
    hav = haversine_sql("p.longitude", "p.latitude", "n.lon", "n.lat")
    head = head.replace("WITH RECURSIVE sites AS", "WITH RECURSIVE postal AS (" + with_clause("postal")[
        len("WITH postal AS ("):].strip()[:-1] + "), sites AS", 1) if "WITH RECURSIVE sites AS" in head else head
    extra = (",\npostal_pts AS (" + _CTE["postal_pts"] + ")"
             ",\nppts AS (SELECT plz AS key, longitude_plz AS longitude, latitude_plz AS latitude FROM postal_pts)"
             f",\npsnap AS (SELECT key, arg_min(n.node_id, ({hav}, n.node_id)) AS node_id FROM ppts p, net n"
             " GROUP BY p.key, p.longitude, p.latitude)"
             ",\nrt_raw AS (SELECT s.key AS key1, t.key AS key2, sp.m AS distance_m, sp.d AS duration_s"
             " FROM snapped s JOIN sp ON sp.origin = s.node_id JOIN psnap t ON t.node_id = sp.node)"
             ",\nrt AS (SELECT key1, key2, round(distance_m, 3) AS distance_m, round(duration_s, 3) AS duration_s"
             " FROM rt_raw)\n")
    return head + extra


ORACLE["e7_route_answers"] = _route_table_sql() + "SELECT * FROM rt"


def _route_requests_sql() -> str:
    from odspark.registry.distance import _CTE
    return (_route_table_sql().rstrip() +
            ",\nreq AS (" + _CTE["req"] + ")"
            ",\nbestrt AS (SELECT key1, key2, distance_m, duration_s FROM (SELECT *, row_number() OVER"
            " (PARTITION BY key1, key2 ORDER BY duration_s, distance_m) AS rn FROM rt) t WHERE rn = 1)\n"
            # F3 is "%.5f": halves by the exact binary value
            "SELECT r.*, CAST(printf('%.5f', b.distance_m / 1000.0) AS DOUBLE) AS distance,"
            " CAST(printf('%.5f', b.duration_s / 60.0) AS DOUBLE) AS duration"
            " FROM req r LEFT JOIN bestrt b ON r.key1 = b.key1 AND r.key2 = b.key2")


ORACLE["e7_j8_request_answers"] = _route_requests_sql()


ORACLE["w27_car_distance"] = car_ways_sql(CAR_DISTANCE)
ORACLE["q3_ascii_grid"] = """SELECT CAST(dense_rank() OVER (ORDER BY r) - 1 AS INTEGER) AS row, CAST(row_number() OVER (PARTITION BY r ORDER BY c) - 1 AS INTEGER) AS col,
 CASE WHEN p_size % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS datum
 FROM (SELECT CAST(floor(p_partkey / 25) AS BIGINT) AS r, p_partkey % 25 AS c, p_size FROM part) g"""


def _turns_cte(given: str, lights: bool) -> str:
    """CTEs of E4: edges with bearings, the given turns and their angles."""
    b = ("degrees(atan2(sin(radians(t.lon) - radians(s.lon)) * cos(radians(t.lat)), cos(radians(s.lat)) * sin(radians(t.lat))"
         " - sin(radians(s.lat)) * cos(radians(t.lat)) * cos(radians(t.lon) - radians(s.lon)))) + 360.0")
    light = "n.node_id IN (SELECT node_id FROM car_nodes WHERE traffic_lights)" if lights else "FALSE"
    return (f",\nbe AS (SELECT e.*, round((({b}) - 360.0 * floor(({b}) / 360.0)) * 1e6) / 1e6 AS bearing FROM edges e JOIN nodes s ON s.node_id = e.source JOIN nodes t ON t.node_id = e.target)"
            f",\ngiven AS ({given})"
            ",\ndeg AS (SELECT node_id, count(DISTINCT way_id) AS number_of_roads FROM (SELECT source AS node_id, way_id FROM edges UNION ALL SELECT target, way_id FROM edges) u GROUP BY node_id)"
            ",\nmet AS (SELECT g.turn_id, i.way_id AS in_way, o.way_id AS out_way, i.target AS node_id, o.bearing - i.bearing AS d, i.source = o.target AS is_u_turn,"
            " i.mode AS source_mode, o.mode AS target_mode FROM given g JOIN be i ON i.way_id = g.in_way AND i.seq = g.in_seq AND i.forward = g.in_forward"
            " JOIN be o ON o.way_id = g.out_way AND o.seq = g.out_seq AND o.forward = g.out_forward WHERE i.target = o.source)"
            ",\nturns AS (SELECT turn_id, in_way, out_way, n.node_id, CASE WHEN d - 360 * floor(d / 360) > 180 THEN d - 360 * floor(d / 360) - 360 ELSE d - 360 * floor(d / 360) END AS angle,"
            f" number_of_roads, {light} AS has_traffic_light, is_u_turn, FALSE AS is_left_hand_driving, source_mode, target_mode, FALSE AS source_restricted, FALSE AS target_restricted"
            " FROM met n JOIN deg ON deg.node_id = n.node_id)\n")


_GIVEN = ("SELECT *, in_way || ':' || in_seq || ':' || CAST(in_forward AS INT) || ':' || out_seq || ':' || CAST(out_forward AS INT) AS turn_id FROM ("
          "SELECT way_id AS in_way, seq AS in_seq, forward AS in_forward, way_id AS out_way, CASE WHEN forward THEN seq + 1 ELSE seq - 1 END AS out_seq, forward AS out_forward FROM edges"
          " UNION ALL SELECT way_id, seq, forward, way_id, seq, NOT forward FROM edges) g0")
_TURNS = _car_edges_with() + ",\n" + _car_node_cte() + _turns_cte(_GIVEN, True)
ORACLE["e4_turn_angles"] = _TURNS + ("SELECT turn_id, node_id, round(angle, 6) AS angle, number_of_roads, has_traffic_light, is_u_turn, source_mode, target_mode FROM turns")


def _priced(digits: int = 5) -> str:
    """R1's duration and weight over the CTE ``turns``."""
    body = _car_turns()
    return body[body.index("SELECT turn_id,"):].replace(", 6) AS", f", {digits}) AS")


ORACLE["e4_r1_turn_costs"] = _TURNS + _priced()
_OVER = ("SELECT l.way_id AS in_way, l.in_seq, TRUE AS in_forward, f.way_id AS out_way, f.seq AS out_seq, TRUE AS out_forward, l.way_id || ':' || f.way_id AS turn_id"
         " FROM (SELECT way_id, arg_max(target, seq) AS at, max(seq) AS in_seq FROM edges WHERE forward GROUP BY way_id) l"
         " JOIN edges f ON f.forward AND f.seq = 1 AND f.source = l.at")
ORACLE["w28_class_turns"] = (
    _car_edges_with(profile=CAR_DISTANCE) + _turns_cte(_OVER, False).rstrip() + ",\npriced AS (" + _priced(9) + "),\n"
    + "cls AS (SELECT way_id, htc, atc FROM " + car_ways_sql(CAR_DISTANCE, chain_only=True)[1] + ")\n"
    "SELECT p.turn_id, s.htc AS source_highway_class, t.htc AS target_highway_class, round(p.duration, 5) AS duration,"
    " CAST((greatest(COALESCE(s.htc, 0) - COALESCE(t.htc, 0), 0) + CASE WHEN COALESCE(s.atc, 0) <> COALESCE(t.atc, 0) THEN 1 ELSE 0 END) * 1.5 AS DOUBLE) AS weight"
    " FROM priced p JOIN turns u ON u.turn_id = p.turn_id LEFT JOIN cls s ON s.way_id = u.in_way LEFT JOIN cls t ON t.way_id = u.out_way")
