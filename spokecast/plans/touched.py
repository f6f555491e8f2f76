"""Refresh of what has changed: cleaned trips by month, a cube for each month, and the marts rows that depend on it.

A refresh cleans the trips of the months that a load has touched, counts them in two scans (``trip_ends`` and the
game legs) and writes both by month.  A day whose part of the cube differs has changed.  A changed day spreads to the
holidays that have it within their window, and only these holidays' rows are built anew; if a station or a holiday
has changed, all are, as every row may name it.  What is as small as days, stations or weekdays is built from
the cubes whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokecast.operators import clusters, daily, events, factors, holidays, proximity, trip_ends
from spokecast.plans.build import stage
from spokecast.session import cut_lineage
from spokecast.sources.tables import Warehouse

TRIP_COLUMNS = (
    "ride_id", "started_at", "ended_at", "ride_date", "ride_mins", "start_station_id", "start_station_name", "start_lat",
    "start_lng", "end_station_id", "end_station_name", "end_lat", "end_lng", "member_casual",
)


def _stored(warehouse: Warehouse, layer: str, name: str) -> DataFrame | None:
    try:
        return warehouse.read(layer, name)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return None


def _keep_months(warehouse: Warehouse, name: str, df: DataFrame, months: list[str], part: str) -> DataFrame:
    """Writes the rows of ``months`` over those stored; a month without rows is emptied, others stay as they are."""
    path = warehouse.path("core", name)
    df.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    layout = df.schema
    table = warehouse.spark.read.schema(layout).parquet(path)
    left = table.where(F.col(part).isin(months)).select(part).distinct().join(df.select(part).distinct(), part, "left_anti")
    for row in left.collect():  # names of months
        table.limit(0).drop(part).write.mode("overwrite").parquet(f"{path}/{part}={row[0]}")
    return warehouse.spark.read.schema(layout).parquet(path)


def _differ(old: DataFrame | None, new: DataFrame, key: str) -> DataFrame:
    """Keys whose rows are not the same in both tables, by a checksum of all columns."""
    columns = sorted(new.columns)
    rounded = [F.round(f.name, 6) if f.dataType.simpleString() == "double" else F.col(f.name) for f in sorted(new.schema, key=lambda f: f.name)]

    def sums(df: DataFrame, name: str) -> DataFrame:
        row = F.xxhash64(*rounded)
        return df.select(*columns).groupBy(key).agg(F.struct(F.bit_xor(row), F.count("*")).alias(name))

    now = sums(new, "now")
    if old is None or sorted(old.columns) != columns:
        return now.select(key)
    both = sums(old, "old").join(now, key, "full")
    return both.where(~F.col("old").eqNullSafe(F.col("now"))).select(key)


def _affected(feasts: DataFrame, days: DataFrame) -> DataFrame:
    """Holidays that have one of ``days`` in their window."""
    window = F.sequence(F.date_sub("date", holidays.BASELINE_DAYS), F.date_add("date", holidays.BASELINE_DAYS))
    around = feasts.where("date is not null").select(F.col("date").alias("holiday_date"), F.explode(window).alias("ride_date"))
    return around.join(days, "ride_date", "left_semi").select("holiday_date").distinct()


def refresh_touched(
    warehouse: Warehouse,
    raw: dict[str, DataFrame],
    months: list[str] | None = None,
    stadiums: tuple[tuple, ...] = proximity.STADIUMS,
    k: int = clusters.CLUSTERS,
    part: str = "source_month",
    baseline: str = "same_window",
) -> dict[str, DataFrame]:
    """All core tables and marts after a load that touched ``months``; the first refresh, or None, takes all months.

    ``raw["bike_trips"]`` is merged on its ride id and has its month in ``part``; months are those of rows that came,
    went or moved.  The result equals a full build.
    """
    spark = warehouse.spark
    staged = stage(warehouse, raw)
    trips = staged["stg_bike_trips"]
    trips = trips.select(part, *[c for c in TRIP_COLUMNS if c in trips.columns])
    before = _stored(warehouse, "core", "int_trip_ends")
    if months is None or before is None:
        known = raw["bike_trips"].select(part).distinct()
        if before is not None:
            known = known.union(before.select(part).distinct()).distinct()
        months = [r[0] for r in known.collect()]
    touched: Column = F.col(part).isin(months)
    core: dict[str, DataFrame] = {}
    models: dict[str, DataFrame] = dict(staged)

    def keep(layer: str, name: str, df: DataFrame) -> DataFrame:
        models[name] = warehouse.view(name, warehouse.store(layer, name, df))
        return models[name]

    old_days = None if before is None else cut_lineage(before.where(touched))
    core["int_trips"] = _keep_months(warehouse, "int_trips", trips.where(touched), months, part)
    now = core["int_trips"].where(touched)
    ends = _keep_months(warehouse, "int_trip_ends", trip_ends.trip_ends(now, part), months, part)
    days = cut_lineage(_differ(old_days, ends.where(touched).select(*(old_days or ends).columns), "ride_date"))

    old_places = _stored(warehouse, "core", "dim_stations")
    old_places = None if old_places is None else cut_lineage(old_places)
    places = keep("core", "dim_stations", trip_ends.dim_stations(ends))
    moved = old_places is None or not _differ(old_places, places, "station_id").isEmpty()
    keep("core", "dim_stadiums", proximity.dim_stadiums(spark, stadiums))
    if moved or _stored(warehouse, "core", "dim_station_clusters") is None:
        near = keep("core", "fct_station_proximity", proximity.station_proximity(places, stadiums))
        keep("core", "dim_station_clusters", clusters.station_clusters(places, k=k))
    else:
        near = warehouse.view("fct_station_proximity", warehouse.read("core", "fct_station_proximity"))
        models["fct_station_proximity"] = near
        models["dim_station_clusters"] = warehouse.view("dim_station_clusters", warehouse.read("core", "dim_station_clusters"))
    keep("core", "fct_trips_daily", trip_ends.trips_daily(ends))
    cube = keep("core", "int_start_cube", trip_ends.start_cube(ends))

    watched = near.filter("within_1km").select("station_id").distinct()
    old_watched = _stored(warehouse, "core", "int_watched_stations")
    same_watch = old_watched is not None and _differ(old_watched, watched, "station_id").isEmpty()
    some = now if same_watch else core["int_trips"]
    legs_of = months if same_watch else [r[0] for r in ends.select(part).distinct().collect()] + months
    legs = events.leg_counts(some, watched, (part,))
    legs = _keep_months(warehouse, "int_event_legs", legs, sorted(set(legs_of)), part)
    keep("core", "int_watched_stations", watched)

    feasts, games = staged["stg_holidays"], staged["stg_games"]
    old_feasts = _stored(warehouse, "core", "int_holidays")
    old_feasts = None if old_feasts is None else cut_lineage(old_feasts)
    feasts = keep("core", "int_holidays", feasts)
    all_anew = moved or old_feasts is None or not _differ(old_feasts, feasts, "date").isEmpty()
    affected = cut_lineage(_affected(feasts, days))

    def mart(name: str, df: DataFrame) -> DataFrame:
        return keep("marts", name, df)

    def holiday_mart(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
        old = None if all_anew else _stored(warehouse, "marts", name)
        if old is None:
            mart(name, build(cube))
            return
        window = F.sequence(F.date_sub("holiday_date", holidays.BASELINE_DAYS), F.date_add("holiday_date", holidays.BASELINE_DAYS))
        wanted = affected.select(F.explode(window).alias("ride_date")).distinct()
        anew = build(cube.join(wanted, "ride_date", "left_semi")).join(affected, "holiday_date", "left_semi")
        mart(name, cut_lineage(old.join(affected, "holiday_date", "left_anti").unionByName(anew)))

    mart("mart_demand_daily", daily.demand_daily(models["fct_trips_daily"]))
    mart("mart_weather_effect", daily.weather_effect(models["mart_demand_daily"], staged["stg_weather"]))
    mart("mart_station_stats", trip_ends.station_stats(places, ends))
    holiday_mart("mart_holiday_impact_summary", lambda c: holidays.impact_summary(feasts, c))
    holiday_mart("mart_holiday_impact_by_hour", lambda c: holidays.impact_by_hour(feasts, c))
    holiday_mart("mart_holiday_impact_by_station", lambda c: holidays.impact_by_station(feasts, c, places))
    holiday_mart("mart_holiday_impact_by_area", lambda c: holidays.impact_by_area(feasts, c, places))
    mart("mart_game_day_demand", events.demand_from_legs(legs.drop(part), games, near, feasts, baseline))
    mart("mart_game_rebalancing", events.rebalancing(models["mart_game_day_demand"], places))
    mart("mart_baseline_net_flow", trip_ends.baseline_net_flow(ends, models["dim_station_clusters"]))
    counted_days = models["fct_trips_daily"].groupBy("ride_date").agg(F.sum("trips").alias("day_trips"))
    conditions = factors.daily_conditions_from_days(counted_days, staged["stg_weather"], feasts)
    mart("mart_adjustment_factors", factors.adjustment_factors(conditions))
    return models
