"""Way rules as table-wide jobs.

Each handler returns ``(updates, stop)``: new expressions for some state
columns and an optional stop condition. ``run_stages`` applies handlers in
profile order as one projection each; a row whose handler stopped keeps its
partial result and is skipped by every later handler (``alive`` = false).
Everything is a Catalyst expression over the ``tags`` map: one scan, no
shuffle, whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odspark.functions import tags as T
from odspark.plans.profiles import (HIGHWAY_CLASSES, LINK_TYPES, MODE_CODES, MOTORWAY_TYPES, ROAD_PRIORITY,
                                    ROAD_TYPES)

INACC = "inaccessible"
# handlers fused into one generated method before a codegen boundary
STAGES_PER_CODEGEN = 6
NO_MERGE_PARTITIONS = 1 << 30
Handler = Callable[[dict], tuple[dict, Column | None]]


def c(name: str) -> Column:
    return T.col(name)


def lit_bool(v: bool) -> Column:
    return T.L(bool(v))


# ---- state ----------------------------------------------------------------------------------

def initial_state(ways: DataFrame) -> DataFrame:
    """Default result record plus the prefetched tags (``d_*`` = handler scratch data)."""
    extra = [x for x in ("location_maxheight", "location_driving_side") if x in ways.columns]
    empty = F.array().cast("array<string>")
    return ways.select(
        "way_id", "tags", *extra,
        F.lit(True).alias("alive"), F.lit(None).cast("string").alias("stopped_at"),
        F.lit(INACC).alias("forward_mode"), F.lit(INACC).alias("backward_mode"),
        F.lit(-1.0).alias("forward_speed"), F.lit(-1.0).alias("backward_speed"),
        F.lit(None).cast("double").alias("forward_rate"), F.lit(None).cast("double").alias("backward_rate"),
        F.lit(0.0).alias("duration"), F.lit(None).cast("double").alias("weight"),
        F.lit(False).alias("forward_restricted"), F.lit(False).alias("backward_restricted"),
        empty.alias("forward_classes"), empty.alias("backward_classes"),
        *[F.lit(None).cast("string").alias(n) for n in
          ("name", "ref", "pronunciation", "exits", "destinations", "turn_lanes_forward", "turn_lanes_backward")],
        F.lit(False).alias("motorway_class"), F.lit(False).alias("link_class"),
        F.lit(None).cast("int").alias("road_priority_class"), F.lit(None).cast("boolean").alias("may_be_ignored"),
        F.lit(0).cast("int").alias("num_lanes"),
        F.lit(False).alias("roundabout"), F.lit(False).alias("circular"),
        F.lit(None).cast("boolean").alias("is_startpoint"), F.lit(False).alias("is_left_hand_driving"),
        F.lit(None).cast("int").alias("highway_turn_classification"),
        F.lit(None).cast("int").alias("access_turn_classification"),
        T.tag("highway").alias("d_highway"), T.tag("bridge").alias("d_bridge"), T.tag("route").alias("d_route"),
        F.lit(None).cast("string").alias("d_oneway"),
        F.lit(False).alias("d_fwd_oneway"), F.lit(False).alias("d_rev_oneway"),
        F.lit(None).cast("string").alias("d_fwd_access"), F.lit(None).cast("string").alias("d_bwd_access"),
    )


def apply_stage(df: DataFrame, name: str, updates: dict, stop: Column | None,
                cols: list[str] | None = None) -> DataFrame:
    alive = c("alive")
    cols = cols or df.columns
    missing = [k for k in updates if k not in cols]
    sel = []
    for col in cols:
        if col in updates:
            sel.append(F.when(alive, updates[col]).otherwise(c(col)).alias(col))
        elif col == "alive" and stop is not None:
            sel.append((alive & ~F.coalesce(stop, F.lit(False))).alias(col))
        elif col == "stopped_at" and stop is not None:
            sel.append(F.when(alive & F.coalesce(stop, F.lit(False)), F.lit(name)).otherwise(c(col)).alias(col))
        else:
            sel.append(c(col))
    for col in missing:  # new scratch columns
        sel.append(F.when(alive, updates[col]).alias(col))
    return df.select(*sel)


def run_stages(df: DataFrame, profile: dict, handlers: list[tuple[str, Handler]],
               per_segment: int | None = None) -> DataFrame:
    """Apply handlers in order; a stop ends the chain for that row only.

    Tags used by any handler are first read once from the map into columns
    (a dry run of the handlers collects the keys), which keeps the generated
    code small and avoids repeated map searches.
    """
    # handler expressions name columns only, so they are built before the struct exists
    with T.recording_tags() as rec:
        built = [(name, *h(profile)) for name, h in handlers]
    df = T.prefetch_tags(df, rec.keys)
    cols = df.columns
    applied = 0
    for name, upd, stop in built:
        if upd or stop is not None:
            df = apply_stage(df, name, upd, stop, cols)
            cols = cols + [k for k in upd if k not in cols]
            applied += 1
            if applied % (per_segment or STAGES_PER_CODEGEN) == 0:
                # a coalesce to more partitions than exist moves no data; it only ends
                # the generated-code segment so each segment compiles small
                df = df.coalesce(NO_MERGE_PARTITIONS)
    return df.drop(T.PREFETCH)


# ---- shared handlers ------------------------------------------------------------------------

def default_mode(p):  # W2
    m = F.lit(p["default_mode"])
    return {"forward_mode": m, "backward_mode": m}, None


def blocked_ways(p):  # W3
    avoid = set(p.get("avoid", []))
    hw = c("d_highway")
    conds = []
    if "area" in avoid:
        conds.append(T.tag("area") == "yes")
    if "toll" in avoid:
        conds.append(T.tag("toll") == "yes")
    if "steps" in avoid:
        conds.append(hw == "steps")
    if "construction" in avoid:
        conds.append((hw == "construction") | (T.tag("railway") == "construction"))
        cons = T.tag("construction")
        conds.append(cons.isNotNull() & ~T.in_set(p.get("construction_whitelist", []), cons))
    if "proposed" in avoid:
        conds.append(T.tag("proposed").isNotNull())
    if "reversible" in avoid:
        conds.append(T.tag("oneway") == "reversible")
    if "impassable" in avoid:
        conds.append((T.tag("impassable") == "yes") | (T.tag("status") == "impassable"))
    stop = F.lit(False)
    for x in conds:
        stop = stop | F.coalesce(x, F.lit(False))
    return {}, stop


def avoid_ways(p):  # W4
    return {}, T.in_set(p.get("avoid", []), c("d_highway"))


def _close(cond: Column, mode_col: str) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(INACC)).otherwise(c(mode_col))


def handle_height(p, loc: Column | None = None):  # W5
    f, b = T.forward_backward_by_set(["maxheight:physical", "maxheight"])
    vh = F.lit(p["vehicle_height"])
    return {"forward_mode": _close(T.parse_height(f, loc) < vh, "forward_mode"),
            "backward_mode": _close(T.parse_height(b, loc) < vh, "backward_mode")}, None


def handle_width(p):  # W6
    f, b = T.forward_backward_by_set(["maxwidth:physical", "maxwidth", "width", "est_width"])
    narrow = T.tag("narrow")
    wide_vehicle = p["vehicle_width"] > 2.2

    def closed(x):
        by_narrow = (((x == "narrow") | (narrow == "yes")) & lit_bool(wide_vehicle))
        by_narrow = F.coalesce(by_narrow, F.lit(False))
        return by_narrow | (~by_narrow & x.isNotNull() & (T.parse_meters(x) <= F.lit(p["vehicle_width"])))
    return {"forward_mode": _close(closed(f), "forward_mode"), "backward_mode": _close(closed(b), "backward_mode")}, None


def handle_length(p):  # W7
    f, b = T.forward_backward_by_set(["maxlength"])
    vl = F.lit(p["vehicle_length"])
    return {"forward_mode": _close(T.parse_meters(f) < vl, "forward_mode"),
            "backward_mode": _close(T.parse_meters(b) < vl, "backward_mode")}, None


def handle_weight(p):  # W8
    f, b = T.forward_backward_by_set(["maxweight"])
    vw = F.lit(p["vehicle_weight"])
    return {"forward_mode": _close(T.parse_kilograms(f) < vw, "forward_mode"),
            "backward_mode": _close(T.parse_kilograms(b) < vw, "backward_mode")}, None


def access(p):  # W9
    fa, ba = T.forward_backward_by_set(p["access_tags_hierarchy"])
    hw_ok = T.in_set(p.get("restricted_highway_whitelist", []), c("d_highway"))
    fr = c("forward_restricted") | (hw_ok & T.in_set(p.get("restricted_access_tag_list", []), fa))
    br = c("backward_restricted") | (hw_ok & T.in_set(p.get("restricted_access_tag_list", []), ba))
    bl = p["access_tag_blacklist"]
    fm = F.when(T.in_set(bl, fa) & ~fr, F.lit(INACC)).otherwise(c("forward_mode"))
    bm = F.when(T.in_set(bl, ba) & ~br, F.lit(INACC)).otherwise(c("backward_mode"))
    stop = (fm == INACC) & (bm == INACC)
    return {"d_fwd_access": fa, "d_bwd_access": ba, "forward_restricted": fr, "backward_restricted": br,
            "forward_mode": fm, "backward_mode": bm}, stop


def oneway(p):  # W10
    h = p.get("oneway_handling")
    if not h:
        return {}, None
    plain = T.tag("oneway")
    specific = T.by_prefixed_sequence(p["restrictions"], "oneway")
    if h is True:
        ow = F.coalesce(specific, plain)
    elif h == "specific":
        ow = specific
    elif h == "conditional":
        ow = F.when(T.tag("oneway:conditional").isNotNull(), F.lit("no")).otherwise(F.coalesce(specific, plain))
    else:
        raise ValueError(f"unknown oneway_handling {h!r}")
    rev = F.coalesce(ow == "-1", F.lit(False))
    fwd = F.coalesce(ow.isin("yes", "1", "true"), F.lit(False))
    if h is True:
        j = T.tag("junction")
        implied_road = F.coalesce((c("d_highway") == "motorway") | j.isin("roundabout", "circular"), F.lit(False))
        fwd = fwd | (~rev & implied_road & F.coalesce(ow != "no", F.lit(True)))
    return {"d_oneway": ow, "d_rev_oneway": rev, "d_fwd_oneway": fwd,
            "forward_mode": F.when(rev, F.lit(INACC)).otherwise(c("forward_mode")),
            "backward_mode": F.when(fwd, F.lit(INACC)).otherwise(c("backward_mode"))}, None


def _destination(forward: bool) -> Column:
    ref = T.directional_tag("destination:ref", forward)
    dest = T.directional_tag("destination", forward)
    street = T.directional_tag("destination:street", forward)
    return F.when(ref.isNotNull() & dest.isNotNull(), F.concat(ref, F.lit(": "), dest)) \
        .otherwise(F.coalesce(ref, dest, street, F.lit("")))


def destinations(p):  # W11
    isf, isr = c("d_fwd_oneway"), c("d_rev_oneway")
    d = F.when(isf, _destination(True)).otherwise(_destination(False))
    return {"destinations": F.when(isf | isr, T.canonical_list(d, ",")).otherwise(c("destinations"))}, None


def _valid_duration() -> Column:
    return T.duration_seconds(T.tag("duration"))


def ferries(p):  # W12
    rs = T.lookup(p.get("route_speeds", {}), c("d_route"))
    on = F.coalesce(rs > 0, F.lit(False))
    dur = _valid_duration()
    return {"duration": F.when(on & dur.isNotNull(), F.greatest(dur, F.lit(1.0))).otherwise(c("duration")),
            "forward_mode": F.when(on, F.lit("ferry")).otherwise(c("forward_mode")),
            "backward_mode": F.when(on, F.lit("ferry")).otherwise(c("backward_mode")),
            "forward_speed": F.when(on, rs.cast("double")).otherwise(c("forward_speed")),
            "backward_speed": F.when(on, rs.cast("double")).otherwise(c("backward_speed"))}, None


def movables(p):  # W13 (the capacity:car test compares text with a number: always true)
    bs = T.lookup(p.get("bridge_speeds", {}), c("d_bridge"))
    on = F.coalesce(bs > 0, F.lit(False))
    dur = _valid_duration()
    has_dur = dur.isNotNull()
    m = F.lit(p["default_mode"])
    return {"forward_mode": F.when(on, m).otherwise(c("forward_mode")),
            "backward_mode": F.when(on, m).otherwise(c("backward_mode")),
            "duration": F.when(on & has_dur, F.greatest(dur, F.lit(1.0))).otherwise(c("duration")),
            "forward_speed": F.when(on & ~has_dur, bs.cast("double")).otherwise(c("forward_speed")),
            "backward_speed": F.when(on & ~has_dur, bs.cast("double")).otherwise(c("backward_speed"))}, None


def service(p):  # W14
    bad = T.in_set(p.get("service_tag_forbidden", []), T.tag("service"))
    return {"forward_mode": F.when(bad, F.lit(INACC)).otherwise(c("forward_mode")),
            "backward_mode": F.when(bad, F.lit(INACC)).otherwise(c("backward_mode"))}, bad


def hov(p):  # W15
    if "hov_lanes" not in p.get("avoid", []):
        return {}, None
    desig = F.coalesce(T.tag("hov") == "designated", F.lit(False))
    lf, lb = T.forward_backward_by_key("hov:lanes", c("d_oneway"), c("d_fwd_oneway"), c("d_rev_oneway"))
    all_f, all_b = T.all_lanes_designated(lf), T.all_lanes_designated(lb)
    fr = c("forward_restricted") | desig
    br = c("backward_restricted") | desig
    if p.get("weight_name") == "routability":
        return {"forward_restricted": fr | all_f, "backward_restricted": br | all_b}, None
    return {"forward_restricted": fr, "backward_restricted": br,
            "forward_mode": F.when(all_f, F.lit(INACC)).otherwise(c("forward_mode")),
            "backward_mode": F.when(all_b, F.lit(INACC)).otherwise(c("backward_mode"))}, None


def speed(p):  # W16
    skip = c("forward_speed") != -1
    spd = T.constant_by_key_value(p["speeds"]).cast("double")
    fa, ba = c("d_fwd_access"), c("d_bwd_access")
    wl, bl = p["access_tag_whitelist"], p["access_tag_blacklist"]
    dflt = F.lit(float(p["default_speed"]))

    def by_access(a, other, speed_col, mode_col):
        sp = (F.when(T.in_set(wl, a), dflt)
              .when(a.isNotNull() & ~T.in_set(bl, a), dflt)
              .otherwise(c(speed_col)))
        md = F.when(a.isNull() & other.isNotNull(), F.lit(INACC)).otherwise(c(mode_col))
        return sp, md

    fs_acc, fm_acc = by_access(fa, ba, "forward_speed", "forward_mode")
    bs_acc, bm_acc = by_access(ba, fa, "backward_speed", "backward_mode")
    has = spd.isNotNull()
    fs = F.when(skip, c("forward_speed")).when(has, spd).otherwise(fs_acc)
    bs = F.when(skip, c("backward_speed")).when(has, spd).otherwise(bs_acc)
    fm = F.when(skip | has, c("forward_mode")).otherwise(fm_acc)
    bm = F.when(skip | has, c("backward_mode")).otherwise(bm_acc)
    stop = ~skip & (fs == -1) & (bs == -1) & (c("duration") <= 0)
    return {"forward_speed": fs, "backward_speed": bs, "forward_mode": fm, "backward_mode": bm}, stop


def parse_maxspeed(x: Column, p: dict) -> Column:
    """Number, else the country:type table, else the type default, else 0 (0 = unknown)."""
    n = T.parse_speed(x)
    low = F.lower(x)
    table = T.lookup(p["maxspeed_table"], low)
    kind = F.nullif(F.regexp_extract(low, r"[a-zA-Z]{2}:([a-zA-Z]+)", 1), F.lit(""))
    dflt = T.lookup(p["maxspeed_table_default"], kind)
    return F.when(x.isNull(), F.lit(0.0)).otherwise(F.coalesce(n, table.cast("double"), dflt.cast("double"),
                                                               F.lit(0.0)))


def maxspeed(p):  # W17
    f, b = T.forward_backward_by_set(["maxspeed:advisory", "maxspeed", "source:maxspeed", "maxspeed:type"])
    pf, pb = parse_maxspeed(f, p), parse_maxspeed(b, p)
    r = F.lit(p["speed_reduction"])
    return {"forward_speed": F.when(pf > 0, pf * r).otherwise(c("forward_speed")),
            "backward_speed": F.when(pb > 0, pb * r).otherwise(c("backward_speed"))}, None


def surface(p):  # W18
    fs, bs = c("forward_speed"), c("backward_speed")
    for key, table in (("surface", p.get("surface_speeds", {})), ("tracktype", p.get("tracktype_speeds", {})),
                       ("smoothness", p.get("smoothness_speeds", {}))):
        if not table:
            continue
        v = T.lookup(table, T.tag(key)).cast("double")
        fs = F.when(v.isNotNull(), F.least(v, fs)).otherwise(fs)
        bs = F.when(v.isNotNull(), F.least(v, bs)).otherwise(bs)
    return {"forward_speed": fs, "backward_speed": bs}, None


def penalties(p):  # W19
    sp = F.coalesce(T.lookup(p.get("service_penalties", {}), T.tag("service")).cast("double"), F.lit(1.0))
    width = T.leading_number(T.tag("width"))
    lanes = T.leading_number(T.tag("lanes"))
    bidir = (c("forward_mode") != INACC) & (c("backward_mode") != INACC)
    narrow = F.coalesce(width <= 3, F.lit(False)) | (F.coalesce(lanes <= 1, F.lit(False)) & bidir)
    wp = F.when(narrow, F.lit(0.5)).otherwise(F.lit(1.0))
    ap = F.when(F.coalesce(c("d_oneway") == "alternating", F.lit(False)), F.lit(0.4)).otherwise(F.lit(1.0))
    srp = F.when(F.coalesce(T.tag("side_road").isin("yes", "rotary"), F.lit(False)),
                 F.lit(p["side_road_multiplier"])).otherwise(F.lit(1.0))
    pen = F.least(sp, wp, ap, srp)
    if p.get("weight_name") != "routability":
        return {}, None
    fs, bs, d = c("forward_speed"), c("backward_speed"), c("duration")
    return {"forward_rate": F.when(fs > 0, fs * pen / 3.6).otherwise(c("forward_rate")),
            "backward_rate": F.when(bs > 0, bs * pen / 3.6).otherwise(c("backward_rate")),
            "weight": F.when(d > 0, d / pen).otherwise(c("weight"))}, None


def classes(p):  # W20
    allowed = set(p.get("classes") or [])
    if not allowed:
        return {}, None
    ow, isf, isr = c("d_oneway"), c("d_fwd_oneway"), c("d_rev_oneway")
    ft, bt = T.forward_backward_by_key("toll", ow, isf, isr)
    fr, br = T.forward_backward_by_key("route", ow, isf, isr)
    tunnel = T.tag("tunnel")
    motorway = c("d_highway").isin("motorway", "motorway_link")

    def flags(toll, route, restricted):
        items = []
        if "tunnel" in allowed:
            items.append(F.when(tunnel.isNotNull() & (tunnel != "no"), F.lit("tunnel")))
        if "toll" in allowed:
            items.append(F.when(toll == "yes", F.lit("toll")))
        if "ferry" in allowed:
            items.append(F.when(route == "ferry", F.lit("ferry")))
        if "restricted" in allowed:
            items.append(F.when(restricted, F.lit("restricted")))
        if "motorway" in allowed:
            items.append(F.when(motorway, F.lit("motorway")))
        return F.array(*items)

    def merged(col, new):
        return F.array_sort(F.array_distinct(F.concat(c(col), F.array_compact(new))))
    return {"forward_classes": merged("forward_classes", flags(ft, fr, c("forward_restricted"))),
            "backward_classes": merged("backward_classes", flags(bt, br, c("backward_restricted")))}, None


def trim_lanes(lanes: Column, left: Column, right: Column) -> Column:
    """Drop ``left`` lanes on the left and ``right`` lanes on the right of a ``|`` list."""
    arr = F.split(lanes, r"\|", -1)
    n = F.size(arr)
    return F.array_join(F.filter(arr, lambda x, i: (i >= left) & (i < n - right)), "|")


def apply_access_tokens(lanes: Column, vehicle_lanes: Column) -> Column:
    """Keep the lanes whose access token is not ``no``."""
    arr = F.split(lanes, r"\|", -1)
    tok = F.split(vehicle_lanes, r"\|", -1)
    return F.array_join(F.filter(arr, lambda x, i: F.coalesce(F.try_element_at(tok, i + 1) != "no", F.lit(True))),
                        "|")


def turn_lanes(p):  # W21
    ow, isf, isr = c("d_oneway"), c("d_fwd_oneway"), c("d_rev_oneway")
    pf, pb = T.forward_backward_by_key("lanes:psv", ow, isf, isr)
    pf = F.coalesce(F.trim(pf).try_cast("double"), F.lit(0.0))
    pb = F.coalesce(F.trim(pb).try_cast("double"), F.lit(0.0))
    tf, tb = T.forward_backward_by_key("turn:lanes", ow, isf, isr)
    vf, vb = T.forward_backward_by_key("vehicle:lanes", ow, isf, isr)

    def process(turn, veh, first, second):
        return (F.when(turn.isNull(), F.lit(None).cast("string"))
                .when(veh.isNotNull(), apply_access_tokens(turn, veh))
                .when((first != 0) | (second != 0), trim_lanes(turn, first, second))
                .otherwise(turn))
    # backward lanes swap the psv counts
    return {"turn_lanes_forward": process(tf, vf, pb, pf), "turn_lanes_backward": process(tb, vb, pf, pb)}, None


_PRIORITY_BY_HIGHWAY = {k: ROAD_PRIORITY[v] for k, v in HIGHWAY_CLASSES.items()}


def classification(p):  # W22 (every service road is an alley)
    hw = c("d_highway")
    prio = F.when(hw == "service", F.lit(ROAD_PRIORITY["alley"])).otherwise(
        F.coalesce(T.lookup(_PRIORITY_BY_HIGHWAY, hw), F.lit(ROAD_PRIORITY["connectivity"])))
    lanes = T.tag("lanes")
    lc = F.trim(lanes).try_cast("double")
    lf = F.coalesce(F.trim(T.tag("lanes:forward")).try_cast("double"), F.lit(0.0))
    lb = F.coalesce(F.trim(T.tag("lanes:backward")).try_cast("double"), F.lit(0.0))
    total = lf + lb
    num = (F.when(lanes.isNotNull(), F.when(lc.isNotNull(), lc.cast("int")).otherwise(c("num_lanes")))
           .when(total != 0, total.cast("int")).otherwise(c("num_lanes")))
    return {"motorway_class": c("motorway_class") | T.in_set(MOTORWAY_TYPES, hw),
            "link_class": c("link_class") | T.in_set(LINK_TYPES, hw),
            "road_priority_class": prio.cast("int"),
            "may_be_ignored": ~T.in_set(ROAD_TYPES, hw),
            "num_lanes": num}, None


def roundabouts(p):  # W23
    j = T.tag("junction")
    return {"roundabout": c("roundabout") | F.coalesce(j == "roundabout", F.lit(False)),
            "circular": c("circular") | F.coalesce(j == "circular", F.lit(False))}, None


def startpoint(p):  # W24
    fm, bm = c("forward_mode"), c("backward_mode")
    if p.get("allowed_start_modes"):
        sp = fm.isin(p["allowed_start_modes"]) | bm.isin(p["allowed_start_modes"])
    else:
        sp = (fm == p["default_mode"]) | (bm == p["default_mode"])
    blocked = F.coalesce(c("d_highway") == "service", F.lit(False)) & \
        T.in_set(p.get("service_access_tag_blacklist", []), c("d_fwd_access"))
    return {"is_startpoint": F.when(blocked, F.lit(False)).otherwise(sp)}, None


def driving_side(p, loc: Column | None = None):  # W25
    ds = T.tag("driving_side") if loc is None else F.coalesce(T.tag("driving_side"), loc)
    return {"is_left_hand_driving": F.when(ds == "left", F.lit(True)).when(ds == "right", F.lit(False))
            .otherwise(lit_bool(p.get("left_hand_driving", False)))}, None


def names(p):  # W26
    name, ref, pron, exits = T.tag("name"), T.tag("ref"), T.tag("name:pronunciation"), T.tag("junction:ref")
    return {"name": F.coalesce(name, c("name")),
            "ref": F.coalesce(T.canonical_list(ref, ";"), c("ref")),
            "pronunciation": F.coalesce(pron, c("pronunciation")),
            "exits": F.coalesce(T.canonical_list(exits, ";"), c("exits"))}, None


def weights(p):  # W27
    if p.get("weight_name") != "distance":
        return {}, None
    return {"weight": F.lit(-1.0),
            "forward_rate": F.when((c("forward_mode") != INACC) & (c("forward_speed") > 0), F.lit(1.0))
            .otherwise(c("forward_rate")),
            "backward_rate": F.when((c("backward_mode") != INACC) & (c("backward_speed") > 0), F.lit(1.0))
            .otherwise(c("backward_rate"))}, None


def way_classification_for_turn(p):  # W28
    ht, at = p.get("highway_turn_classification", {}), p.get("access_turn_classification", {})
    for table in (ht, at):
        if any(v >= 16 for v in table.values()):
            raise ValueError("turn classification values must be smaller than 16")
    if not ht and not at:
        return {}, None
    return {"highway_turn_classification": F.coalesce(T.lookup(ht, T.tag("highway")).cast("int"),
                                                      c("highway_turn_classification")),
            "access_turn_classification": F.coalesce(T.lookup(at, T.tag("access")).cast("int"),
                                                     c("access_turn_classification"))}, None


# ---- profile chains -------------------------------------------------------------------------

def _with_locations(df: DataFrame, handlers: list) -> list:
    """Bind optional location columns (maxheight, driving side) to the handlers that read them."""
    loc_h = c("location_maxheight") if "location_maxheight" in df.columns else None
    loc_d = c("location_driving_side") if "location_driving_side" in df.columns else None
    out = []
    for name, h in handlers:
        if h is handle_height:
            out.append((name, lambda p, _l=loc_h: handle_height(p, _l)))
        elif h is driving_side:
            out.append((name, lambda p, _l=loc_d: driving_side(p, _l)))
        else:
            out.append((name, h))
    return out


CAR_HANDLERS = [
    ("default_mode", default_mode), ("blocked_ways", blocked_ways), ("avoid_ways", avoid_ways),
    ("handle_height", handle_height), ("handle_width", handle_width), ("handle_length", handle_length),
    ("handle_weight", handle_weight), ("access", access), ("oneway", oneway), ("destinations", destinations),
    ("ferries", ferries), ("movables", movables), ("service", service), ("hov", hov), ("speed", speed),
    ("maxspeed", maxspeed), ("surface", surface), ("penalties", penalties), ("classes", classes),
    ("turn_lanes", turn_lanes), ("classification", classification), ("roundabouts", roundabouts),
    ("startpoint", startpoint), ("driving_side", driving_side), ("names", names), ("weights", weights),
    ("way_classification_for_turn", way_classification_for_turn),
]

FOOT_HANDLERS = [
    ("default_mode", default_mode), ("blocked_ways", blocked_ways), ("access", access), ("oneway", oneway),
    ("destinations", destinations), ("ferries", ferries), ("movables", movables), ("speed", speed),
    ("surface", surface), ("classification", classification), ("roundabouts", roundabouts),
    ("startpoint", startpoint), ("names", names), ("weights", weights),
]


def result_table(df: DataFrame, only: list[str] | None = None) -> DataFrame:
    """The way-result table, written once as parquet into the shared checkpoint folder; ``only`` (optional): the columns that are read later, so
    that the rules for the others cost nothing.

    Later filters and joins then start from stored rows and read only the columns that they use: Catalyst would
    otherwise push predicates down through every handler projection, and each edge side would recompute the whole chain.
    """
    from odspark.sources.files import scratch_dir

    keep = only or [x for x in df.columns if not x.startswith("d_") and x not in ("tags", T.PREFETCH)]
    kinds = dict(df.dtypes)
    out = df.select(*[F.col(x).cast("string").alias(x) if kinds[x] == "void" else F.col(x) for x in keep])
    path = scratch_dir(df.sparkSession, "way-results")
    out.write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def car_ways(ways: DataFrame, profile: dict, only: list[str] | None = None) -> DataFrame:
    """Car: W1 quick check (highway or route non-empty), then the car handler chain; ``only`` (optional): the result columns that are wanted."""
    hw, rt = T.tag("highway"), T.tag("route")
    keep = (hw.isNotNull() & (hw != "")) | (rt.isNotNull() & (rt != ""))
    df = initial_state(ways.filter(keep))
    return result_table(run_stages(df, profile, _with_locations(df, CAR_HANDLERS)), only)


def foot_ways(ways: DataFrame, profile: dict) -> DataFrame:
    """Foot: W1 quick check (any prefetched tag present), then the foot chain."""
    keep = F.coalesce(*[T.tag(k) for k in profile["prefetch"]]).isNotNull()
    df = initial_state(ways.filter(keep))
    return result_table(run_stages(df, profile, _with_locations(df, FOOT_HANDLERS)))


def routable(result: DataFrame) -> DataFrame:
    """Rows that finished the chain with an open direction and a speed or duration."""
    open_f = (c("forward_mode") != INACC) & ((c("forward_speed") > 0) | (c("duration") > 0))
    open_b = (c("backward_mode") != INACC) & ((c("backward_speed") > 0) | (c("duration") > 0))
    return result.filter(c("alive") & (open_f | open_b))


FLAT_COLUMNS = ["way_id", "alive", "stopped_at", "forward_mode", "backward_mode", "forward_speed", "backward_speed",
                "forward_rate", "backward_rate", "duration", "weight", "forward_restricted", "backward_restricted",
                "forward_classes", "backward_classes", "name", "ref", "destinations", "exits",
                "turn_lanes_forward", "turn_lanes_backward", "motorway_class", "link_class", "road_priority_class",
                "may_be_ignored", "num_lanes", "roundabout", "circular", "is_startpoint", "is_left_hand_driving"]


def flat_result(result: DataFrame) -> DataFrame:
    """Scalar columns only (class sets as sorted comma text, speeds rounded to 6 decimals)."""
    cols = []
    for n in FLAT_COLUMNS:
        if n in ("forward_classes", "backward_classes"):
            cols.append(F.array_join(F.array_sort(c(n)), ",").alias(n))
        elif n in ("forward_speed", "backward_speed", "forward_rate", "backward_rate", "duration", "weight"):
            cols.append(F.round(c(n), 6).alias(n))
        else:
            cols.append(c(n))
    return result.select(*cols)


def mode_code(col: Column) -> Column:
    return T.lookup(MODE_CODES, col).cast("int")
