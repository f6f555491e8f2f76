"""Every registered query against its SQL on the test tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

from __spark_entry__ import LLM_ORACLES, LLM_QUERIES, entry, oracle_sql, queries

QUERIES = {k: v for k, v in queries().items() if k not in LLM_QUERIES}
SQL = {k: v for k, v in oracle_sql().items() if k not in LLM_ORACLES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_results_do_not_depend_on_the_session_zone(spark, con, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("trips_clean", "demand_daily", "event_window_demand", "net_flow_baseline", "holiday_impact_by_hour"):
            assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == [], name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
