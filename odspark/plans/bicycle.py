"""Bicycle way chain (B1-B7) and the fixed-speed test profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odspark.functions import tags as T
from odspark.plans import ways as W
from odspark.plans.ways import INACC, c

_TRUE = ["yes", "1", "true"]
_FALSE = ["no", "0", "false"]


def _eq(x: Column, v) -> Column:
    return F.coalesce(x == v, T.L(False))


def _isin(x: Column, values) -> Column:
    return T.in_set(values, x)


def _bt(name):
    return T.tag(name)


def bicycle_check(p):
    """Quick tag check and B1 access: a way with nothing routable or blacklisted access stops."""
    hw = c("d_highway")

    def empty(x):
        return x.isNull() | (x == "")
    no_rail = empty(_bt("railway")) if p.get("use_public_transport") else T.L(True)
    nothing = (empty(hw) & empty(_bt("route")) & no_rail & empty(_bt("amenity")) & empty(_bt("man_made"))
               & empty(_bt("public_transport")) & empty(_bt("bridge")))
    acc = T.first_tag(p["access_tags_hierarchy"])
    stop = nothing | _isin(acc, p["access_tag_blacklist"])
    return {"d_access": acc, "d_route": _bt("route"), "d_bridge": _bt("bridge")}, stop


def bicycle_speed(p):
    """B2 speed ladder (first matching branch wins)."""
    hw, acc, route, bridge = c("d_highway"), c("d_access"), c("d_route"), c("d_bridge")
    railway, public_transport = _bt("railway"), _bt("public_transport")
    dur = T.duration_seconds(_bt("duration"))
    bridge_speed = T.lookup(p["bridge_speeds"], bridge).cast("double")
    route_speed = T.lookup(p["route_speeds"], route).cast("double")
    platform_rail = T.lookup(p["platform_speeds"], railway).cast("double")
    platform_pt = T.lookup(p["platform_speeds"], public_transport).cast("double")
    rail_speed = T.lookup(p["railway_speeds"], railway).cast("double")
    amenity_speed = T.lookup(p["amenity_speeds"], _bt("amenity")).cast("double")
    bike_speed = T.lookup(p["bicycle_speeds"], hw).cast("double")
    whitelisted = _isin(acc, p["access_tag_whitelist"])
    use_pt = T.L(bool(p.get("use_public_transport")))
    branch = (F.when(F.coalesce(bridge_speed > 0, T.L(False)), T.L("bridge"))
              .when(route_speed.isNotNull(), T.L("route"))
              .when(platform_rail.isNotNull(), T.L("platform"))
              .when(platform_pt.isNotNull(), T.L("platform_pt"))
              .when(use_pt & rail_speed.isNotNull() & whitelisted, T.L("rail"))
              .when(amenity_speed.isNotNull(), T.L("amenity"))
              .when(bike_speed.isNotNull(), T.L("highway"))
              .when(whitelisted, T.L("access")))
    return {"d_branch": branch, "d_dur": dur}, None


def bicycle_speed_apply(p):
    b, dur = c("d_branch"), c("d_dur")
    hw, route, bridge = c("d_highway"), c("d_route"), c("d_bridge")
    has_dur = dur.isNotNull()
    speed = (F.when(b == "bridge", T.lookup(p["bridge_speeds"], bridge).cast("double"))
             .when((b == "route") & ~has_dur, T.lookup(p["route_speeds"], route).cast("double"))
             .when(b == "platform", T.lookup(p["platform_speeds"], _bt("railway")).cast("double"))
             .when(b == "platform_pt", T.lookup(p["platform_speeds"], _bt("public_transport")).cast("double"))
             .when(b == "rail", T.lookup(p["railway_speeds"], _bt("railway")).cast("double"))
             .when(b == "amenity", T.lookup(p["amenity_speeds"], _bt("amenity")).cast("double"))
             .when(b == "highway", T.lookup(p["bicycle_speeds"], hw).cast("double"))
             .when(b == "access", T.L(float(p["default_speed"]))))
    mode = F.when(b == "route", T.L("ferry")).when(b == "rail", T.L("train"))
    return {"forward_speed": F.coalesce(speed, c("forward_speed")),
            "backward_speed": F.coalesce(speed, c("backward_speed")),
            "forward_mode": F.coalesce(mode, c("forward_mode")),
            "backward_mode": F.coalesce(mode, c("backward_mode")),
            "duration": F.when(F.coalesce(b.isin("bridge", "route"), T.L(False)) & has_dur,
                               F.greatest(dur, T.L(1.0))).otherwise(c("duration")),
            "d_pushing_ok": F.coalesce(b.isin("bridge", "platform", "platform_pt", "amenity", "highway", "access"),
                                       T.L(False)),
            # a movable bridge replaces the highway value for the handlers after this one
            "d_highway": F.when(F.coalesce(b == "bridge", T.L(False)), bridge).otherwise(hw)}, None


def bicycle_oneway(p):
    """``oneway:bicycle`` first, then ``oneway``, then implied one-way roads."""
    oneway, oneway_bike = _bt("oneway"), _bt("oneway:bicycle")
    implied = F.coalesce(_bt("junction").isin("roundabout", "circular"), T.L(False)) | _eq(c("d_highway"), "motorway")
    ob_t, ob_f, ob_r = _isin(oneway_bike, _TRUE), _isin(oneway_bike, _FALSE), _eq(oneway_bike, "-1")
    o_t, o_f, o_r = _isin(oneway, _TRUE), _isin(oneway, _FALSE), _eq(oneway, "-1")
    close_b = ob_t | (~ob_t & ~ob_f & ~ob_r & (o_t | (~o_t & ~o_f & ~o_r & implied)))
    reverse = (~ob_t & ~ob_f & ob_r) | (~ob_t & ~ob_f & ~ob_r & ~o_t & ~o_f & o_r)
    return {"forward_mode": F.when(reverse, T.L(INACC)).otherwise(c("forward_mode")),
            "backward_mode": F.when(close_b, T.L(INACC)).otherwise(c("backward_mode")),
            "d_implied_oneway": implied, "d_reverse": reverse, "d_oneway": oneway}, None


def bicycle_cycleways(p):
    """Cycleways on two-way roads, and opposite / one-way cycleways on one-way roads."""
    cw, cw_l, cw_r = _bt("cycleway"), _bt("cycleway:left"), _bt("cycleway:right")
    tags_set, opp_set = p["cycleway_tags"], p["opposite_cycleway_tags"]
    reverse, implied = c("d_reverse"), c("d_implied_oneway")
    twoway = (c("forward_mode") != INACC) & (c("backward_mode") != INACC) & ~implied
    cw_both = _isin(cw, tags_set)
    fwd_tw = _isin(cw_r, tags_set) | _isin(cw_l, opp_set)
    bwd_tw = _isin(cw_l, tags_set) | _isin(cw_r, opp_set)
    has_twoway = _isin(cw, opp_set) | _isin(cw_r, opp_set) | _isin(cw_l, opp_set)
    has_opposite = _isin(cw_l, opp_set) | _isin(cw_r, opp_set)
    has_oneway = _isin(cw, tags_set) | _isin(cw_r, tags_set) | _isin(cw_l, tags_set)
    ow_fwd = has_twoway | (~has_twoway & has_opposite & reverse) | (~has_twoway & ~has_opposite & has_oneway & ~reverse)
    ow_bwd = has_twoway | (~has_twoway & has_opposite & ~reverse) | (~has_twoway & ~has_opposite & has_oneway & reverse)
    cyc_f = F.when(twoway, cw_both | fwd_tw).otherwise(ow_fwd)
    cyc_b = F.when(twoway, cw_both | bwd_tw).otherwise(ow_bwd)
    sp = T.L(float(p["bicycle_speeds"]["cycleway"]))
    return {"forward_mode": F.when(cyc_f, T.L("cycling")).otherwise(c("forward_mode")),
            "backward_mode": F.when(cyc_b, T.L("cycling")).otherwise(c("backward_mode")),
            "forward_speed": F.when(cyc_f, sp).otherwise(c("forward_speed")),
            "backward_speed": F.when(cyc_b, sp).otherwise(c("backward_speed")),
            "d_is_twoway": twoway, "d_cycleway_forward": cyc_f, "d_cycleway_backward": cyc_b}, None


def bicycle_push(p):
    """Pushing speed where a direction is closed or has no speed; ``bicycle=dismount`` forces it."""
    fm, bm, fs, bs = c("forward_mode"), c("backward_mode"), c("forward_speed"), c("backward_speed")
    implied, pushing_ok = c("d_implied_oneway"), c("d_pushing_ok")
    foot = _bt("foot")
    walk = T.L(float(p["walking_speed"]))
    need = (fm == INACC) | (bm == INACC) | (fs == -1) | (bs == -1)
    foot_ok = F.coalesce(foot != "no", T.L(True))
    by_table = F.coalesce(T.lookup(p["pedestrian_speeds"], c("d_highway")).cast("double"),
                          T.lookup(p["man_made_speeds"], _bt("man_made")).cast("double"))
    foot_yes, ff_yes, fb_yes = _eq(foot, "yes"), _eq(_bt("foot:forward"), "yes"), _eq(_bt("foot:backward"), "yes")
    none = T.L(None).cast("double")
    push_f = (F.when(by_table.isNotNull(), by_table).when(foot_yes, walk).when(ff_yes, walk)
              .when(fb_yes, none).when(pushing_ok, walk))
    push_b = (F.when(by_table.isNotNull(), by_table).when(foot_yes, F.when(~implied, walk)).when(ff_yes, none)
              .when(fb_yes, walk).when(pushing_ok, F.when(~implied, walk)))
    do_f = need & foot_ok & push_f.isNotNull() & ((fm == INACC) | (fs == -1))
    do_b = need & foot_ok & push_b.isNotNull() & ((bm == INACC) | (bs == -1))
    dismount = _eq(_bt("bicycle"), "dismount")
    push = T.L("pushing_bike")
    return {"forward_mode": F.when(dismount | do_f, push).otherwise(fm),
            "backward_mode": F.when(dismount | do_b, push).otherwise(bm),
            "forward_speed": F.when(dismount, walk).when(do_f, push_f).otherwise(fs),
            "backward_speed": F.when(dismount, walk).when(do_b, push_b).otherwise(bs)}, None


def bicycle_limit(p):
    """Maxspeed caps (G16), then close a direction with no speed and no duration."""
    maxspeed = F.coalesce(T.parse_speed(_bt("maxspeed")), T.L(0.0))
    max_f = F.coalesce(T.parse_speed(_bt("maxspeed:forward")), T.L(0.0))
    max_b = F.coalesce(T.parse_speed(_bt("maxspeed:backward")), T.L(0.0))
    fs = T.limit_speed(c("forward_speed"), maxspeed, max_f)
    bs = T.limit_speed(c("backward_speed"), maxspeed, max_b)
    d = c("duration")
    return {"forward_speed": fs, "backward_speed": bs,
            "forward_mode": F.when((fs <= 0) & (d <= 0), T.L(INACC)).otherwise(c("forward_mode")),
            "backward_mode": F.when((bs <= 0) & (d <= 0), T.L(INACC)).otherwise(c("backward_mode"))}, None


def safety(p):
    """Cyclability rates; only when the profile weighs by cyclability."""
    if p.get("weight_name") != "cyclability":
        return {}, None
    hw = c("d_highway")
    pen = F.coalesce(T.lookup(p["unsafe_highway_list"], hw).cast("double"), T.L(1.0))
    unsafe = pen < 1
    twoway = F.coalesce(c("d_is_twoway"), T.L(False))
    pen = F.when(unsafe & _eq(hw, "primary") & ~twoway, pen * 0.5).otherwise(pen)
    pen = F.when(unsafe & _eq(hw, "secondary") & ~twoway, pen * 0.6).otherwise(pen)
    f_unsafe = unsafe & ~F.coalesce(c("d_cycleway_forward"), T.L(False))
    b_unsafe = unsafe & ~F.coalesce(c("d_cycleway_backward"), T.L(False))
    svc = T.lookup(p["service_penalties"], T.tag("service")).cast("double")
    undesirable = _eq(hw, "service") & svc.isNotNull()
    fp = F.when(f_unsafe, F.least(T.L(1.0), pen)).otherwise(T.L(1.0))
    bp = F.when(b_unsafe, F.least(T.L(1.0), pen)).otherwise(T.L(1.0))
    fp = F.when(undesirable, F.least(fp, svc)).otherwise(fp)
    bp = F.when(undesirable, F.least(bp, svc)).otherwise(bp)
    fs, bs, d = c("forward_speed"), c("backward_speed"), c("duration")
    return {"forward_rate": F.when(fs > 0, fs / 3.6 * fp).otherwise(c("forward_rate")),
            "backward_rate": F.when(bs > 0, bs / 3.6 * bp).otherwise(c("backward_rate")),
            "weight": F.when(d > 0, d / fp).otherwise(c("weight"))}, None


BICYCLE_HANDLERS = [
    ("default_mode", W.default_mode), ("blocked_ways", W.blocked_ways), ("bicycle_check", bicycle_check),
    ("bicycle_speed", bicycle_speed), ("bicycle_speed_apply", bicycle_speed_apply), ("bicycle_oneway", bicycle_oneway),
    ("bicycle_cycleways", bicycle_cycleways), ("bicycle_push", bicycle_push), ("bicycle_limit", bicycle_limit),
    ("safety", safety), ("surface", W.surface), ("classification", W.classification),
    ("startpoint", W.startpoint), ("roundabouts", W.roundabouts), ("names", W.names), ("classes", W.classes),
    ("weights", W.weights),
]


def bicycle_ways(ways: DataFrame, profile: dict) -> DataFrame:
    """Bicycle chain; the quick tag check is a stop inside the main handler."""
    df = W.initial_state(ways)
    df = df.select("*", *[F.lit(None).cast(t).alias(n) for n, t in (
        ("d_access", "string"), ("d_implied_oneway", "boolean"), ("d_is_twoway", "boolean"),
        ("d_cycleway_forward", "boolean"), ("d_cycleway_backward", "boolean"), ("d_branch", "string"),
        ("d_dur", "double"), ("d_pushing_ok", "boolean"), ("d_reverse", "boolean"))])
    # the bicycle one-way handler never sets the direction flags that G2 reads
    # the bicycle handlers are large expressions: three per generated-code segment
    return W.result_table(W.run_stages(df, profile, BICYCLE_HANDLERS, per_segment=3))


# ---- test profile -----------------------------------------------------------------------------

def testbot_ways(ways: DataFrame, profile: dict) -> DataFrame:
    """Fixed speeds, river and steps modes, plain-number maxspeed caps, one-way, classes."""
    tag = T.tag
    hw, toll, name, oneway = tag("highway"), tag("toll"), tag("name"), tag("oneway")
    junction = tag("junction")
    dur = T.duration_seconds(tag("duration"))
    mx = F.trim(tag("maxspeed")).try_cast("double")
    mxf = F.trim(tag("maxspeed:forward")).try_cast("double")
    mxb = F.trim(tag("maxspeed:backward")).try_cast("double")
    base = F.coalesce(T.lookup(profile["speeds"], hw).cast("double"), T.L(float(profile["default_speed"])))
    river = _eq(hw, "river")
    steps = _eq(hw, "steps")
    sf = F.when(river, base * 1.5).otherwise(base)
    sb = F.when(river, base / 1.5).otherwise(base)
    sf = F.when(F.coalesce(mxf > 0, T.L(False)), mxf).when(F.coalesce((mx > 0) & (sf > mx), T.L(False)), mx).otherwise(sf)
    sb = F.when(F.coalesce(mxb > 0, T.L(False)), mxb).when(F.coalesce((mx > 0) & (sb > mx), T.L(False)), mx).otherwise(sb)
    has_dur = dur.isNotNull()
    fmode = (F.when(has_dur, T.L("route")).when(river, T.L("river_down")).when(steps, T.L("steps_down"))
             .otherwise(T.L("driving")))
    bmode = (F.when(has_dur, T.L("route")).when(river, T.L("river_up")).when(steps, T.L("steps_up"))
             .otherwise(T.L("driving")))
    no = _isin(oneway, _FALSE)
    rev = ~no & _eq(oneway, "-1")
    fwd = ~no & ~rev & (_isin(oneway, _TRUE) | _eq(junction, "roundabout"))
    fmode = F.when(rev, T.L(INACC)).otherwise(fmode)
    bmode = F.when(fwd, T.L(INACC)).otherwise(bmode)
    classes = F.array_sort(F.array_compact(F.array(F.when(_eq(hw, "motorway"), T.L("motorway")),
                                                   F.when(_eq(toll, "yes"), T.L("toll")))))
    return W.result_table(ways.select(
        "way_id", T.L(True).alias("alive"), fmode.alias("forward_mode"), bmode.alias("backward_mode"),
        F.when(has_dur, T.L(-1.0)).otherwise(sf).alias("forward_speed"),
        F.when(has_dur, T.L(-1.0)).otherwise(sb).alias("backward_speed"),
        F.when(has_dur, F.greatest(T.L(1.0), dur)).otherwise(T.L(0.0)).alias("duration"),
        name.alias("name"), classes.alias("forward_classes"), classes.alias("backward_classes"),
        _eq(junction, "roundabout").alias("roundabout")))


def exclude_classes(edges: DataFrame, excluded: list[str], classes_col: str = "classes") -> DataFrame:
    """Drop edges carrying any class of the chosen exclude set."""
    if not excluded:
        return edges
    arr = F.array(*[F.lit(x) for x in excluded])
    return edges.filter(~F.coalesce(F.arrays_overlap(F.col(classes_col), arr), F.lit(False)))
