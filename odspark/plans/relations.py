"""Route relations: per-way direction (L1-L3), ref matching (L4) and direction-tagged refs.

Inputs: ``relations(rel_id, type, route, direction, name, ref)`` and
``relation_members(rel_id, member_type, member_id, role)``. Relation order
(where later ones overwrite earlier ones) is rel_id order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odspark.functions import tags as T

# The cardinal directions a role or direction tag may carry.
DIRECTIONS = ["north", "south", "west", "east"]


def _is_dir(x: Column) -> Column:
    return F.coalesce(x.isin(DIRECTIONS), F.lit(False))


def parent_directions(relations: DataFrame, members: DataFrame) -> DataFrame:
    """L2: direction a relation gets from its route parents (rel_id, super_dir).

    Each parent with a direction role (else a direction tag, not lower-cased)
    toggles: the 1st sets, the 2nd cancels, the 3rd sets again → odd count
    keeps the last parent's direction (by parent rel_id), even count → null.
    """
    parents = relations.filter(F.col("type") == "route").select(
        F.col("rel_id").alias("parent_id"), F.col("direction").alias("p_direction"))
    sub = members.filter(F.col("member_type") == "relation").select(
        F.col("rel_id").alias("parent_id"), F.col("member_id").alias("rel_id"), "role")
    j = sub.join(parents, "parent_id")
    d = F.when(_is_dir(F.col("role")), F.col("role")).when(_is_dir(F.col("p_direction")), F.col("p_direction"))
    j = j.withColumn("_d", d).filter(F.col("_d").isNotNull())
    agg = j.groupBy("rel_id").agg(F.count(F.lit(1)).alias("_n"), F.max_by("_d", "parent_id").alias("_last"))
    return agg.select("rel_id", F.when(F.col("_n") % 2 == 1, F.col("_last")).alias("super_dir"))


def way_route_relations(relations: DataFrame, members: DataFrame) -> DataFrame:
    """L1 + L3: (way_id, rel_id, route_direction, route_forward, route_name, route_ref) for route relations."""
    rel = relations.filter(F.col("type") == "route")
    wm = members.filter(F.col("member_type") == "way").select(
        "rel_id", F.col("member_id").alias("way_id"), "role")
    j = wm.join(rel, "rel_id").join(parent_directions(relations, members), "rel_id", "left")
    role = F.col("role")
    role_dir = F.when((F.col("route") == "road") & _is_dir(role), role)
    low = F.lower(F.col("direction"))
    tag_dir = F.when(_is_dir(low), low)
    own = F.when(role_dir.isNotNull() & tag_dir.isNotNull() & (role_dir != tag_dir), F.lit(None)) \
        .otherwise(F.coalesce(role_dir, tag_dir))
    sup = F.col("super_dir")
    final = F.when(own.isNotNull() & sup.isNotNull() & (own != sup), F.lit(None)).otherwise(F.coalesce(own, sup))
    fwd = F.when(role == "forward", F.lit(True)).when(role == "backward", F.lit(False))
    return j.select("way_id", "rel_id", final.alias("route_direction"), fwd.alias("route_forward"),
                    F.col("name").alias("route_name"), F.col("ref").alias("route_ref"))


def _score(ref_token: Column, tag_value: Column) -> Column:
    """Tokens of the way ref found among the tokens of the tag: numbers 2, others 1."""
    tag_tokens = T.tokenize_common(tag_value)
    hits = F.filter(T.tokenize_common(ref_token), lambda t: F.array_contains(tag_tokens, t))
    return F.aggregate(hits, F.lit(0), lambda acc, t: acc + F.when(T.is_number(t), 2).otherwise(1))


def match_refs(car: DataFrame, way_rels: DataFrame) -> DataFrame:
    """L4: per (way, ref token) the forward / backward direction from the best-matching relations.

    ``car``: way results (way_id, ref); only ways on which the handler chain set a ref take part. Per relation with a direction:
    best token by score (name before ref, strictly greater replaces, ties → earlier token); later relations overwrite.
    The tokens of a way are scored as one array, so ways and relations meet in one join on way_id.
    """
    refs = car.filter(F.col("ref").isNotNull()).select("way_id", T.list_tokens(F.col("ref")).alias("tokens"))
    rels = way_rels.filter(F.col("route_direction").isNotNull())
    cand = refs.join(rels, "way_id")

    def scored(tag: str, src: int) -> Column:
        each = F.transform(F.array_distinct("tokens"), lambda t: F.struct(
            _score(t, F.col(tag)).alias("score"), F.lit(-src).alias("nsrc"), (-F.array_position(F.col("tokens"), t)).alias("npos"), t.alias("token")))
        return F.when(F.col(tag).isNotNull(), each).otherwise(F.array().cast("array<struct<score:int,nsrc:int,npos:bigint,token:string>>"))

    # best: max score, then name before ref, then the earlier token
    best = cand.withColumn("_b", F.array_max(F.concat(scored("route_name", 0), scored("route_ref", 1)))).filter(F.col("_b").isNotNull())
    f_ok = F.col("route_forward").isNull() | F.col("route_forward")
    b_ok = F.col("route_forward").isNull() | ~F.col("route_forward")
    per_tok = best.groupBy("way_id", F.col("_b.token").alias("token")).agg(
        F.max_by(F.when(f_ok, F.col("route_direction")), F.when(f_ok, F.col("rel_id"))).alias("forward_dir"),
        F.max_by(F.when(b_ok, F.col("route_direction")), F.when(b_ok, F.col("rel_id"))).alias("backward_dir"))
    toks = refs.select("way_id", F.posexplode("tokens").alias("pos", "token")).withColumn("pos", F.col("pos").cast("bigint"))
    return toks.join(per_tok, ["way_id", "token"], "left").select("way_id", "pos", "token", "forward_dir",
                                                                 "backward_dir")


def way_refs(matched: DataFrame) -> DataFrame:
    """``forward_ref`` / ``backward_ref`` text ``ref $dir; …`` per way (token order kept)."""
    def text(d):
        return F.when(F.col(d).isNotNull(), F.concat(F.col("token"), F.lit(" $"), F.col(d))).otherwise(F.col("token"))
    g = matched.groupBy("way_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", text("forward_dir").alias("t")))).alias("_f"),
        F.sort_array(F.collect_list(F.struct("pos", text("backward_dir").alias("t")))).alias("_b"))
    return g.select("way_id", F.array_join(F.col("_f.t"), "; ").alias("forward_ref"),
                    F.array_join(F.col("_b.t"), "; ").alias("backward_ref"))
