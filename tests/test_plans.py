"""Plan-shape guardrails: the physical strategies the design relies on at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF01, ways_df
from odspark.operators import answers, publish, versions
from odspark.plans import network as N
from odspark.plans import ways as W
from odspark.plans.profiles import CAR
from odspark.registry import distance as D


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_pairs_are_an_equi_join(spark):
    p = plan(D._requests(spark, SF01))
    assert "HashJoin" in p or "SortMergeJoin" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_snapshot_does_not_shuffle_stored_rows(spark):
    p = plan(publish.snapshot(D._fx(spark, SF01, "versions")))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_way_chain_has_no_exchange(spark):
    df = W.initial_state(ways_df(spark, [{"highway": "primary"}]))
    chain = W.run_stages(df, CAR, W.CAR_HANDLERS)
    p = plan(chain)
    assert "Exchange" not in p and "Window" not in p


def test_segments_without_window(spark):
    p = plan(N.segments(D._fx(spark, SF01, "way_nodes"), D._fx(spark, SF01, "nodes")))
    assert "Window" not in p


def test_scan_prunes_columns(spark):
    p = plan(D._fx(spark, SF01, "versions").select("kh_key"))
    assert "ReadSchema: struct<kh_key:string>" in p


def test_error_checks(spark):
    res = D._results(spark, SF01)
    with pytest.raises(ValueError, match="keys without full postal coverage"):
        versions.check_coverage(res, D._postal_pts(spark, SF01))
    with pytest.raises(ValueError, match="requests without an answer"):
        answers.require_answers(D._answers(spark, SF01))
    answers.require_answers(D._answers(spark, SF01).filter(F.col("duration").isNotNull()))
