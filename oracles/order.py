"""SQL for places in an order, and for the list of failed tests."""

from __future__ import annotations

from oracles import clusters, marts
from oracles.inputs import r, query
from oracles.quality import KEYS, ROLLUP

SQL: dict[str, str] = {}


def places(inner: str, order: str, columns: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) AS rank, {columns} FROM ({inner})"


SQL["order_holiday_areas"] = places(
    marts.SQL["holiday_impact_by_area"], "holiday_date, trips_pct_change DESC NULLS LAST, area_name", "holiday_date, area_name, trips_pct_change"
)
SQL["order_rebalancing"] = places(
    marts.SQL["event_rebalancing"],
    "stadium_name, abs(avg_net_flow) DESC, station_id, interval_offset",
    "stadium_name, station_id, interval_offset, avg_net_flow",
)
SQL["order_clusters"] = places(
    clusters.SQL["station_clusters"], "cluster_id, distance_from_centroid_km, station_id", "cluster_id, station_id, distance_from_centroid_km"
)
SQL["order_nearby"] = places(marts.SQL["station_proximity"], "stadium_id, distance_km, station_id", "stadium_id, station_id, distance_km")
SQL["order_line_items"] = f"""SELECT row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber) AS rank,
    l_orderkey, l_linenumber, {r('l_extendedprice')} FROM lineitem"""
SQL["dq_failed_tests"] = query(
    f"""SELECT test_name, test_type, source_name, coalesce(failure_message, 'No additional details available') AS details
    FROM (SELECT test_name, test_type, source_name, failure_message, status FROM ({ROLLUP})
        UNION ALL SELECT 'dbt_test_suite', 'dbt', 'all', 'Failed ' || sum(cast(bad > 0 AS integer)) || ' tests', if(sum(bad) = 0, 'pass', 'fail') FROM (
        {" UNION ALL ".join(f"SELECT count(*) - count(DISTINCT {k}) AS bad FROM {t} UNION ALL SELECT count(*) - count({k}) FROM {t}" for t, k in KEYS)}))
    WHERE status = 'fail'""",
    "suite_results",
)
