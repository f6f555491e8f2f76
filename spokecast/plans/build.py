"""The full refresh: raw tables to staging views, core tables and marts.

Trips are scanned for the station dimension, the daily fact, the station statistics, the
game legs, the net flow and one cube of starts; everything else reads the cube or smaller
tables.  Each core table and mart is written once and read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from spokecast.operators import (
    clusters,
    daily,
    events,
    factors,
    holidays,
    net_flow,
    proximity,
    quality,
    staging,
    stations,
    suites,
)
from spokecast.sources.tables import Warehouse

RAW_TABLES = ("bike_trips", "weather", "holidays", "games")


def stage(warehouse: Warehouse, raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four staging models as views."""
    models = {
        "stg_bike_trips": staging.clean_trips(raw["bike_trips"]),
        "stg_weather": staging.clean_weather(raw["weather"]),
        "stg_holidays": staging.stage_holidays(raw["holidays"]),
        "stg_games": staging.stage_games(raw["games"]),
    }
    return {name: warehouse.view(name, df) for name, df in models.items()}


def build_core(
    warehouse: Warehouse,
    staged: dict[str, DataFrame],
    stadiums: tuple[tuple, ...] = proximity.STADIUMS,
    k: int = clusters.CLUSTERS,
) -> dict[str, DataFrame]:
    """Dimensions, the daily fact and the cube of starts."""
    trips = staged["stg_bike_trips"]
    core: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, **how) -> None:
        core[name] = warehouse.view(name, warehouse.store("core", name, df, **how))

    keep("dim_stations", stations.dim_stations(trips))
    keep("dim_stadiums", proximity.dim_stadiums(warehouse.spark, stadiums))
    keep("fct_station_proximity", proximity.station_proximity(core["dim_stations"], stadiums))
    keep("dim_station_clusters", clusters.station_clusters(core["dim_stations"], k=k))
    keep("fct_trips_daily", daily.trips_daily(trips))
    keep("int_start_cube", holidays.start_cube(trips), rebalance=True)
    return core


def build_marts(
    warehouse: Warehouse,
    staged: dict[str, DataFrame],
    core: dict[str, DataFrame],
    ride_ids_unique: bool | None = None,
) -> dict[str, DataFrame]:
    """The eleven marts.

    ``ride_ids_unique`` may be set when the raw trips were loaded by the keyed merge; left
    open, it is checked.
    """
    if ride_ids_unique is None:
        ride_ids_unique = stations.rides_are_unique(staged["stg_bike_trips"])
    trips, feasts, games = staged["stg_bike_trips"], staged["stg_holidays"], staged["stg_games"]
    cube, places = core["int_start_cube"], core["dim_stations"]
    marts: dict[str, DataFrame] = {}

    def keep(name: str, build: Callable[[], DataFrame]) -> None:
        marts[name] = warehouse.view(name, warehouse.store("marts", name, build()))

    keep("mart_demand_daily", lambda: daily.demand_daily(core["fct_trips_daily"]))
    keep("mart_weather_effect", lambda: daily.weather_effect(marts["mart_demand_daily"], staged["stg_weather"]))
    keep("mart_station_stats", lambda: stations.station_stats(places, trips, ride_ids_unique))
    keep("mart_holiday_impact_summary", lambda: holidays.impact_summary(feasts, cube))
    keep("mart_holiday_impact_by_hour", lambda: holidays.impact_by_hour(feasts, cube))
    keep("mart_holiday_impact_by_station", lambda: holidays.impact_by_station(feasts, cube, places))
    keep("mart_holiday_impact_by_area", lambda: holidays.impact_by_area(feasts, cube, places))
    keep(
        "mart_game_day_demand",
        lambda: events.game_day_demand(trips, games, core["fct_station_proximity"], feasts),
    )
    keep("mart_game_rebalancing", lambda: events.rebalancing(marts["mart_game_day_demand"], places))
    keep("mart_baseline_net_flow", lambda: net_flow.baseline_net_flow(trips, core["dim_station_clusters"]))
    keep(
        "mart_adjustment_factors",
        lambda: factors.adjustment_factors(
            factors.daily_conditions_from_days(
                core["fct_trips_daily"].groupBy("ride_date").agg({"trips": "sum"}).toDF("ride_date", "day_trips"),
                staged["stg_weather"],
                feasts,
            )
        ),
    )
    return marts


def refresh(
    warehouse: Warehouse,
    raw: dict[str, DataFrame],
    stadiums: tuple[tuple, ...] = proximity.STADIUMS,
    k: int = clusters.CLUSTERS,
    ride_ids_unique: bool | None = None,
) -> dict[str, DataFrame]:
    """Build everything; returns all models by name."""
    staged = stage(warehouse, raw)
    core = build_core(warehouse, staged, stadiums, k)
    marts = build_marts(warehouse, staged, core, ride_ids_unique)
    return {**staged, **core, **marts}


def check_quality(
    raw: dict[str, DataFrame], models: dict[str, DataFrame], path: str, k: int = clusters.CLUSTERS
) -> DataFrame:
    """Run the raw suites and the model tests, append one run, return its records; ``k`` as in ``refresh``."""
    raw_results = quality.run_suites(raw, suites.RAW_SUITES)
    tests = reduce(
        DataFrame.unionByName,
        [quality.run_suites(raw, suites.SOURCE_KEYS), quality.run_suites(models, suites.model_suites(k))],
    )
    records = quality.source_records(raw_results).unionByName(quality.model_record(tests))
    stamped = quality.stamp_run(records)
    quality.append_results(stamped, path)
    spark = raw_results.sparkSession
    return quality.latest_run(quality.stored_results(spark, path))
