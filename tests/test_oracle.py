"""Registered queries against their DuckDB oracle SQL on the smallest fixture (the driver uses sf0.01)."""

import math

import duckdb
import pytest

from conftest import SF001

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
FAST = ["zone_counts", "p1_site_points", "j1_request_pairs", "f6_request_chunks", "j8_answers", "j3_remaining",
        "a5_coverage", "v1_scd2_diff", "v2_scd2_apply", "v3_close_versions", "v5_snapshot", "g_tag_parse",
        "x3_tag_usage", "w29_car_ways", "k1_car_nodes", "r1_car_turns", "r2_bicycle_turns", "b8_testbot_ways",
        "e1_segments", "e2_testbot_edges", "d1_industrial_speed", "l1_way_relations", "l2_parent_directions"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:10] if s.endswith("T00:00:00") else s.replace("T", " ")
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(norm(r[i])) for i in order) for r in data)


def test_every_query_is_registered_with_callable():
    qs = E.queries()
    assert "zone_counts" in qs and all(callable(f) for f in qs.values())
    assert set(E.oracle_sql()) <= set(qs)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    want_cols, want = [d[0] for d in res.description], res.fetchall()
    assert sorted(got_cols) == sorted(want_cols)
    assert rows(got_cols, got) == rows(want_cols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["kh_key", "fahrzone", "n_plz"] and df.count() > 0
