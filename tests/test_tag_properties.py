"""Property test: the tag parsers against plain-Python versions of the same rules."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from odspark.functions import tags as T

PIECES = ["0", "1", "2", "5", "9", "12", "3.5", "2,1", ".", ",", " ", "'", '"', "mph", "mp/h", "kg", "lbs", "lb",
          "m", "t", "ft", "FR:urban", "none", "x", "PT", "H", "M", "S", ":", "-"]


def py_speed(s):
    m = re.match(r"[0-9]*", s).group(0)
    if not m:
        return None
    n = float(m)
    return n * 1.609 if ("mph" in s or "mp/h" in s) else n


def py_first_number(s):
    m = re.search(r"[0-9]+\.?[0-9]*", s.replace(",", "."))
    return float(m.group(0)) if m else None


def py_meters(s):
    n = py_first_number(s)
    if n is None:
        return None
    if "'" in s:
        tail = s[s.index("'"):]
        m = re.search(r"[0-9]+", tail)
        n = (n * 12 + (float(m.group(0)) if m else 0.0)) * 0.0254
    return n


def py_kilograms(s):
    n = py_first_number(s)
    if n is None:
        return None
    if "lbs" in s:
        return n * 0.45359237
    if "kg" in s:
        return n
    return n * 1000


def py_duration(s):
    m = re.fullmatch(r"([0-9]+):([0-9]{1,2}):([0-9]{1,2})", s)
    if m:
        return int(m[1]) * 3600 + int(m[2]) * 60 + int(m[3])
    m = re.fullmatch(r"([0-9]+):([0-9]{1,2})", s)
    if m:
        return int(m[1]) * 3600 + int(m[2]) * 60
    if re.fullmatch(r"[0-9]+", s):
        return int(s) * 60
    m = re.fullmatch(r"PT(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+)S)?", s)
    if m and s != "PT":
        return sum(int(g or 0) * k for g, k in zip(m.groups(), (3600, 60, 1)))
    return None


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= 1e-9 * max(1.0, abs(b))


texts = st.lists(st.lists(st.sampled_from(PIECES), min_size=1, max_size=5).map("".join), min_size=20, max_size=60)


@settings(max_examples=8, deadline=None)
@given(texts)
def test_parsers_match_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select("s", T.parse_speed(F.col("s")).alias("sp"), T.parse_meters(F.col("s")).alias("me"),
                     T.parse_kilograms(F.col("s")).alias("kg"), T.duration_seconds(F.col("s")).alias("du")).collect()
    for r in rows:
        assert close(r.sp, py_speed(r.s)), r
        assert close(r.me, py_meters(r.s)), r
        assert close(r.kg, py_kilograms(r.s)), r
        assert close(r.du, py_duration(r.s)), r
