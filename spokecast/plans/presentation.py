"""The order in which each table is shown (F1): sorted when read, never when written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokecast.operators.ranking import ranked

# Sort expressions per table; a leading minus means descending.
ORDER = {
    "fct_trips_daily": ("ride_date", "member_casual"),
    "fct_station_proximity": ("stadium_id", "distance_km"),
    "dim_station_clusters": ("cluster_id", "distance_from_centroid_km"),
    "mart_demand_daily": ("ride_date",),
    "mart_weather_effect": ("date",),
    "mart_station_stats": ("-start_trip_count",),
    "mart_holiday_impact_summary": ("holiday_date",),
    "mart_holiday_impact_by_hour": ("holiday_date", "hour_of_day"),
    "mart_holiday_impact_by_station": ("holiday_date", "-trips_pct_change"),
    "mart_holiday_impact_by_area": ("holiday_date", "-trips_pct_change"),
    "mart_game_day_demand": ("game_date", "stadium_name", "station_id", "interval_offset"),
    "mart_game_rebalancing": ("stadium_name", "-abs(avg_net_flow)", "station_id", "interval_offset"),
    "mart_baseline_net_flow": ("cluster_id", "day_of_week", "hour"),
    "mart_adjustment_factors": ("factor_name",),
}


def order_of(name: str) -> list[Column]:
    """The table's sort columns, nulls last either way."""
    return [
        F.expr(e[1:]).desc_nulls_last() if e.startswith("-") else F.expr(e).asc_nulls_last() for e in ORDER.get(name, ())
    ]


def shown(name: str, table: DataFrame) -> DataFrame:
    """The table in its order, nulls last either way."""
    return table.orderBy(*order_of(name))


def placed(name: str, table: DataFrame, *ties: str) -> DataFrame:
    """The table with each row's ``rank`` in its order; ``ties`` names columns that settle equal ones."""
    return ranked(table, [*order_of(name), *[F.col(c).asc_nulls_last() for c in ties]])
