"""Every registered query against its SQL twin, and the plans they run as."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as contract
from proofmark.plans import catalog
from tests import compare

STREAMS = {n for n in catalog.QUERIES if n.startswith("stream_") or n in ("monitor_stream", "late_data")}


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    got = compare.spark_rows(catalog.QUERIES[name](spark, sf_dir))
    assert compare.difference(got, compare.sql_rows(con, catalog.ORACLES[name])) is None


def test_entry_gives_a_verdict(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 1 and rows[0].passed in ("true", "false")
    assert set(contract.oracle_sql()) <= set(contract.queries())


def plan_of(df) -> str:
    shown = io.StringIO()
    with redirect_stdout(shown):
        df.explain("formatted")
    return shown.getvalue()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - STREAMS))
def test_no_query_pairs_all_rows(spark, sf_dir, name):
    plan = plan_of(catalog.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_time_bound_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(catalog.QUERIES["traffic_health"](spark, sf_dir))
    assert "GreaterThan(ts," in plan
    scan = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "props" not in scan and "user_id" not in scan


def test_top_n_is_not_a_full_sort(spark, sf_dir):
    for name in ("recent_requests", "blocked_requests", "worst_rows"):
        assert "TakeOrderedAndProject" in plan_of(catalog.QUERIES[name](spark, sf_dir))


def test_scores_of_a_monitor_share_one_scan(spark, sf_dir):
    plan = plan_of(catalog.QUERIES["evaluate"](spark, sf_dir))
    assert plan.count("Scan parquet") <= 2 * 2  # the pair's two sides, listed twice by the formatted plan
