"""The declared checks: four raw-table suites and the model tests.

Fixed values throughout: which columns are checked, against which ranges and word lists.
"""

from __future__ import annotations

from dataclasses import replace

from spokecast.functions.calendar import DAY_NAMES
from spokecast.functions.geo import AREA_BOXES, CITY_BOX
from spokecast.operators.factors import WEATHER_FACTORS
from spokecast.operators.quality import Check

RIDERS = ("member", "casual")
AREAS = (*[box[0] for box in AREA_BOXES], "Other")
FACTOR_NAMES = (*[f[0] for f in WEATHER_FACTORS], *[d.lower() for d in DAY_NAMES])
STADIUM_NAMES = ("Yankee Stadium", "Citi Field", "London Stadium", "Journey Bank Ballpark")


def not_null(*columns: str) -> tuple[Check, ...]:
    return tuple(Check("not_null", c) for c in columns)


def key(column: str) -> tuple[Check, ...]:
    return Check("unique", column), Check("not_null", column)


def _near(column: str, low: float, high: float) -> Check:
    return Check("between", column, low=low, high=high, mostly=0.99)


RAW_SUITES: dict[str, tuple[Check, ...]] = {
    "bike_trips": (
        Check("not_null", "ride_id"),
        Check("unique", "ride_id"),
        *not_null("started_at", "ended_at", "ride_mins"),
        _near("ride_mins", 1.0, 720.0),
        Check("not_null", "member_casual"),
        Check("in_set", "member_casual", values=RIDERS),
        Check("not_null", "rideable_type"),
        _near("start_lat", *CITY_BOX[:2]),
        _near("start_lng", *CITY_BOX[2:]),
        _near("end_lat", *CITY_BOX[:2]),
        _near("end_lng", *CITY_BOX[2:]),
        Check("row_count", low=1),
    ),
    "weather": (
        Check("not_null", "date"),
        Check("unique", "date"),
        Check("between", "tmax", low=-50.0, high=50.0),
        Check("between", "tmin", low=-50.0, high=50.0),
        Check("pair_greater", "tmax", other="tmin", or_equal=True, mostly=0.99),
        Check("between", "precip", low=0.0, high=1000.0),
        Check("between", "wind_max", low=0.0, high=200.0),
        Check("row_count", low=1),
    ),
    "holidays": (
        Check("not_null", "date"),
        Check("unique", "date"),
        Check("not_null", "holiday_name"),
        Check("row_count", low=1),
    ),
    "games": (
        Check("not_null", "game_id"),
        Check("unique", "game_id"),
        *not_null("game_date", "venue_name"),
        Check("row_count", low=1),
    ),
}

SOURCE_KEYS: dict[str, tuple[Check, ...]] = {
    "bike_trips": key("ride_id"),
    "weather": key("date"),
    "holidays": key("date"),
    "games": key("game_id"),
}

MODEL_SUITES: dict[str, tuple[Check, ...]] = {
    "stg_bike_trips": (
        *key("ride_id"),
        *not_null("started_at", "ended_at", "ride_date", "ride_mins"),
        Check("between", "ride_mins", low=1, high=720),
        Check("in_set", "member_casual", values=RIDERS),
    ),
    "stg_weather": (
        *key("date"),
        Check("expression", "precip", expression="precip >= 0"),
        Check("expression", "wind_max", expression="wind_max >= 0"),
    ),
    "stg_holidays": (
        *key("date"),
        Check("not_null", "holiday_name"),
        Check("in_set", "country_code", values=("US",)),
        *not_null("is_major", "is_working_day"),
    ),
    "stg_games": (
        *key("game_id"),
        *not_null("game_date", "game_datetime_rounded", "game_datetime_original", "stadium_name"),
        Check("in_set", "stadium_name", values=STADIUM_NAMES),
        *not_null("is_yankees_home", "is_mets_home", "estimated_end_datetime"),
    ),
    "dim_stations": (
        *key("station_id"),
        *not_null("station_name", "latitude", "longitude", "area"),
        Check("in_set", "area", values=AREAS),
    ),
    "fct_trips_daily": (
        *not_null("ride_date", "member_casual"),
        Check("in_set", "member_casual", values=RIDERS),
        Check("not_null", "trips"),
        Check("expression", "trips", expression="trips > 0"),
        Check("not_null", "avg_duration_mins"),
    ),
    "dim_stadiums": (
        *key("stadium_id"),
        *not_null("stadium_name", "latitude", "longitude", "address", "city", "state"),
    ),
    "fct_station_proximity": (
        *not_null("stadium_id", "station_id", "distance_km"),
        Check("expression", "distance_km", expression="distance_km >= 0"),
        Check("not_null", "within_1km"),
        Check("in_set", "within_1km", values=(True, False)),
    ),
    "dim_station_clusters": (
        *key("station_id"),
        Check("not_null", "cluster_id"),
        Check("between", "cluster_id", low=0, high=29),
        Check("not_null", "distance_from_centroid_km"),
        Check("between", "distance_from_centroid_km", low=0, high=5),
    ),
    "mart_demand_daily": (
        *key("ride_date"),
        Check("not_null", "trips_total"),
        Check("expression", "trips_total", expression="trips_total > 0"),
        *not_null("member_trips", "casual_trips"),
        Check("in_set", "day_type", values=("Weekday", "Weekend")),
    ),
    "mart_weather_effect": (
        *key("date"),
        Check("not_null", "trips_total"),
        Check("in_set", "temp_category", values=("Very Cold", "Cold", "Moderate", "Warm"), severity="warn"),
        Check("in_set", "rain_category", values=("No Rain", "Light Rain", "Heavy Rain"), severity="warn"),
    ),
    "mart_station_stats": (
        *key("station_id"),
        *not_null(
            "station_name",
            "start_trip_count",
            "end_trip_count",
            "total_trip_count",
            "member_start_trips",
            "casual_start_trips",
        ),
    ),
    "mart_holiday_impact_summary": (
        *key("holiday_date"),
        *not_null("holiday_name", "is_major", "is_working_day", "baseline_days_count"),
        Check("between", "baseline_days_count", low=1, high=30),
        *not_null("total_trips_holiday", "total_trips_baseline"),
    ),
    "mart_holiday_impact_by_station": (
        *not_null("holiday_date", "holiday_name", "station_id", "station_name", "area"),
        Check("in_set", "area", values=AREAS),
        *not_null("latitude", "longitude", "trips_holiday"),
        Check("unique_combination", columns=("holiday_date", "station_id")),
    ),
    "mart_holiday_impact_by_hour": (
        *not_null("holiday_date", "holiday_name", "hour_of_day"),
        Check("between", "hour_of_day", low=0, high=23),
        *not_null("trips_holiday", "trips_baseline"),
        Check("unique_combination", columns=("holiday_date", "hour_of_day")),
    ),
    "mart_holiday_impact_by_area": (
        *not_null("holiday_date", "holiday_name", "area_name"),
        Check("in_set", "area_name", values=AREAS),
        *not_null("station_count", "trips_holiday", "trips_baseline"),
        Check("unique_combination", columns=("holiday_date", "area_name")),
    ),
    "mart_game_day_demand": (
        *not_null("game_id", "station_id", "hour_offset", "trips_started_game_day"),
        Check("expression", "trips_started_game_day", expression="trips_started_game_day >= 0"),
        Check("not_null", "trips_ended_game_day"),
        Check("expression", "trips_ended_game_day", expression="trips_ended_game_day >= 0"),
    ),
    "mart_game_rebalancing": not_null(
        "stadium_name", "station_id", "bikes_to_add_or_remove", "rebalancing_recommendation"
    ),
    "mart_baseline_net_flow": (
        Check("not_null", "cluster_id"),
        Check("relationship", "cluster_id", parent="dim_station_clusters"),
        Check("not_null", "day_of_week"),
        Check("in_set", "day_of_week", values=tuple(range(7))),
        Check("not_null", "hour"),
        Check("in_set", "hour", values=tuple(range(24))),
        *not_null("trips_started", "trips_ended", "net_flow"),
    ),
    "mart_adjustment_factors": (
        Check("not_null", "factor_name"),
        Check("unique", "factor_name"),
        Check("in_set", "factor_name", values=FACTOR_NAMES),
        *not_null("description", "impact_pct", "adjustment_multiplier"),
    ),
}


def model_suites(clusters: int = 30) -> dict[str, tuple[Check, ...]]:
    """The model tests for a dimension of so many station clusters."""
    labels = tuple(
        replace(c, high=clusters - 1) if c.kind == "between" and c.column == "cluster_id" else c
        for c in MODEL_SUITES["dim_station_clusters"]
    )
    return {**MODEL_SUITES, "dim_station_clusters": labels}
