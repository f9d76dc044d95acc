"""Tag helpers over a ``tags map<string,string>`` column.

Lua truth rules are kept: an absent tag is null; any present text (even
"" or "no") counts as set.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

TAGS = "tags"

# When set, ``tag()`` records the key and reads a prefetched column instead of
# searching the map again (see ``prefetch_tags``).
_RECORD: set | None = None

# Fixed conversion factors (public unit definitions used by the rules)
INCH_TO_METERS = 0.0254
FEET_TO_INCHES = 12
POUND_TO_KILOGRAMS = 0.45359237
MILES_TO_KILOMETERS = 1.609
DEFAULT_MAXHEIGHT = 4.5
HEIGHT_NON_NUMERICAL = ["default", "none", "no-sign", "unsigned"]


_CACHE: dict = {}


def cached(key, build):
    """Reuse immutable Column objects: every builder call is a round trip to the JVM."""
    from pyspark import SparkContext
    gw = id(SparkContext._gateway)
    k = (gw, key)
    col = _CACHE.get(k)
    if col is None:
        col = _CACHE[k] = build()
    return col


def L(value) -> Column:
    """Cached literal."""
    return cached(("lit", type(value).__name__, value), lambda: F.lit(value))


def col(name: str) -> Column:
    """Cached column reference."""
    return cached(("col", name), lambda: F.col(name))


def tag(key: str, tags: str = TAGS) -> Column:
    """Value of one tag, null when absent."""
    if _RECORD is not None:
        _RECORD.add(key)
        return cached(("tagf", key), lambda: F.col(PREFETCH).getField(key))
    return cached(("tagm", tags, key), lambda: F.try_element_at(F.col(tags), F.lit(key)))


PREFETCH = "_t"


class recording_tags:
    """Context: ``tag(k)`` reads field ``k`` of the prefetched struct; keys used are collected."""

    def __init__(self):
        self.keys: set = set()

    def __enter__(self):
        global _RECORD
        self._prev = _RECORD
        _RECORD = self.keys
        return self

    def __exit__(self, *exc):
        global _RECORD
        _RECORD = self._prev
        return False


def prefetch_tags(df, keys, tags: str = TAGS):
    """Read each used tag once from the map into one struct column (one field per key)."""
    fields = [F.try_element_at(F.col(tags), F.lit(k)).alias(k) for k in sorted(keys)]
    if not fields:
        fields = [F.lit(None).cast("string").alias("_none")]
    return df.withColumn(PREFETCH, F.struct(*fields))


def first_tag(keys: Iterable[str]) -> Column:
    """G1: first present tag of a hierarchy."""
    return F.coalesce(*[tag(k) for k in keys])


def forward_backward_by_key(key: str, oneway: Column, is_forward_oneway: Column,
                            is_reverse_oneway: Column) -> tuple[Column, Column]:
    """``key:forward`` / ``key:backward``, the plain key filling in.

    When the way carries any one-way value, the plain key fills only the
    direction flagged one-way; without one-way value it fills both.
    """
    f, b, common = tag(f"{key}:forward"), tag(f"{key}:backward"), tag(key)
    no_oneway = oneway.isNull()
    fwd = F.when(no_oneway | F.coalesce(is_forward_oneway, F.lit(False)), F.coalesce(f, common)).otherwise(f)
    bwd = F.when(no_oneway | F.coalesce(is_reverse_oneway, F.lit(False)), F.coalesce(b, common)).otherwise(b)
    return fwd, bwd


def forward_backward_by_set(keys: Iterable[str]) -> tuple[Column, Column]:
    """Per direction, first of ``k1:dir, k1, k2:dir, k2, …``."""
    keys = list(keys)
    fwd = F.coalesce(*[c for k in keys for c in (tag(f"{k}:forward"), tag(k))])
    bwd = F.coalesce(*[c for k in keys for c in (tag(f"{k}:backward"), tag(k))])
    return fwd, bwd


def by_prefixed_sequence(seq: Iterable[str], prefix: str) -> Column:
    """First of ``prefix:k`` over the sequence."""
    return F.coalesce(*[tag(f"{prefix}:{k}") for k in seq])


def by_postfixed_sequence(seq: Iterable[str], postfix: str) -> Column:
    """First of ``k:postfix`` over the sequence."""
    return F.coalesce(*[tag(f"{k}:{postfix}") for k in seq])


def lookup(table: Mapping, key: Column) -> Column:
    """Value of a small constant table for ``key`` (null when missing or key null)."""
    if not table:
        return L(None)
    items = tuple(table.items())
    m = cached(("map", items), lambda: F.create_map(*[x for k, v in items for x in (F.lit(k), F.lit(v))]))
    return F.when(key.isNotNull(), F.try_element_at(m, key))


def in_set(values: Iterable[str], key: Column) -> Column:
    """Set membership; false for a null key (Lua ``set[nil]`` is nil)."""
    values = tuple(values)
    if not values:
        return L(False)
    arr = cached(("set", values), lambda: F.array(*[F.lit(v) for v in values]))
    return F.coalesce(F.array_contains(arr, key), L(False))


def constant_by_key_value(lookups: Mapping[str, Mapping]) -> Column:
    """Constant for the first (key, value) pair present in ``lookups``."""
    return F.coalesce(*[lookup(table, tag(key)) for key, table in lookups.items()])


def leading_number(s: Column) -> Column:
    """Digits at the very start of the text as a number (null if none)."""
    return F.nullif(F.regexp_extract(s, r"^([0-9]*)", 1), F.lit("")).try_cast("double")


def parse_speed(s: Column) -> Column:
    """km/h from leading digits; ×1.609 if the text says mph or mp/h."""
    n = leading_number(s)
    mph = s.contains("mph") | s.contains("mp/h")
    return F.when(mph, n * F.lit(MILES_TO_KILOMETERS)).otherwise(n)


def _first_decimal(s: Column) -> Column:
    return F.nullif(F.regexp_extract(F.regexp_replace(s, ",", "."), r"([0-9]+\.?[0-9]*)", 1), F.lit("")) \
        .try_cast("double")


def parse_meters(s: Column) -> Column:
    """Metres; first number (comma = point); with a ``'`` feet and inches."""
    n = _first_decimal(s)
    has_feet = s.contains("'")
    inches = F.nullif(F.regexp_extract(s, r"'[^0-9]*([0-9]+)", 1), F.lit("")).try_cast("double")
    imperial = (n * F.lit(FEET_TO_INCHES) + F.coalesce(inches, F.lit(0.0))) * F.lit(INCH_TO_METERS)
    return F.when(n.isNull(), F.lit(None).cast("double")).when(has_feet, imperial).otherwise(n)


def parse_kilograms(s: Column) -> Column:
    """Kg; ``lbs`` pounds, ``kg`` kilograms, else metric tons."""
    n = _first_decimal(s)
    return (F.when(s.contains("lbs"), n * F.lit(POUND_TO_KILOGRAMS))
            .when(s.contains("kg"), n)
            .otherwise(n * F.lit(1000.0)))


def parse_height(s: Column, location_maxheight: Column | None = None) -> Column:
    """Non-numeric defaults → location value or 4.5 m; else G8."""
    loc = F.lit(None).cast("double") if location_maxheight is None else location_maxheight.try_cast("double")
    return F.when(s.isin(HEIGHT_NON_NUMERICAL), F.coalesce(loc, F.lit(DEFAULT_MAXHEIGHT))).otherwise(parse_meters(s))


def directional_tag(key: str, forward: bool) -> Column:
    """``key:forward|backward`` or ``key``, with ``;`` shown as ``, ``."""
    d = "forward" if forward else "backward"
    return F.replace(F.coalesce(tag(f"{key}:{d}"), tag(key)), F.lit(";"), F.lit(", "))


def list_tokens(s: Column) -> Column:
    """Split on ``;``, drop empty pieces, trim each."""
    return F.transform(F.filter(F.split(s, ";", -1), lambda x: x != ""), lambda x: F.trim(x))


def tokenize_common(s: Column) -> Column:
    """Split on white space."""
    return F.filter(F.split(s, r"\s+", -1), lambda x: x != "")


def is_number(s: Column) -> Column:
    """G14."""
    return F.trim(s).try_cast("double").isNotNull()


def all_lanes_designated(lanes: Column) -> Column:
    """Every ``|``-separated lane is ``designated`` (false when absent)."""
    return F.coalesce(F.forall(F.split(lanes, r"\|", -1), lambda x: x == "designated"), F.lit(False))


def limit_speed(speed: Column, common: Column, directional: Column) -> Column:
    """Cap by the directional limit if > 0, else by the common limit if > 0."""
    return (F.when(directional > 0, F.least(speed, directional))
            .when(common > 0, F.least(speed, common))
            .otherwise(speed))


def canonical_list(s: Column, delim: str) -> Column:
    """Exactly one blank after each delimiter."""
    return F.regexp_replace(s, delim + " *", delim + " ")


def duration_seconds(s: Column) -> Column:
    """Duration text → seconds: ``HH:MM``, ``HH:MM:SS``, bare minutes, ``PTnHnMnS``; else null."""
    hm = F.regexp_extract(s, r"^([0-9]+):([0-9]{1,2})$", 0) != ""
    hms = F.regexp_extract(s, r"^([0-9]+):([0-9]{1,2}):([0-9]{1,2})$", 0) != ""
    mins = F.regexp_extract(s, r"^([0-9]+)$", 0) != ""
    iso = (F.regexp_extract(s, r"^PT(([0-9]+)H)?(([0-9]+)M)?(([0-9]+)S)?$", 0) != "") & (s != "PT")

    def g(pattern: str, i: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(s, pattern, i), F.lit("")).try_cast("double"), F.lit(0.0))

    iso_pat = r"^PT(([0-9]+)H)?(([0-9]+)M)?(([0-9]+)S)?$"
    hms_pat = r"^([0-9]+):([0-9]{1,2}):([0-9]{1,2})$"
    hm_pat = r"^([0-9]+):([0-9]{1,2})$"
    return (F.when(hms, g(hms_pat, 1) * 3600 + g(hms_pat, 2) * 60 + g(hms_pat, 3))
            .when(hm, g(hm_pat, 1) * 3600 + g(hm_pat, 2) * 60)
            .when(mins, g(r"^([0-9]+)$", 1) * 60)
            .when(iso, g(iso_pat, 2) * 3600 + g(iso_pat, 4) * 60 + g(iso_pat, 6)))
