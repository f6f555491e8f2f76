"""The registered queries: each operator over whole test tables, from raw input to result.

Doubles are rounded to six places, as the order of a distributed sum is not fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from spokecast.operators import (
    clusters,
    daily,
    events,
    factors,
    holidays,
    net_flow,
    proximity,
    quality,
    ranking,
    staging,
    stations,
    statistics,
    suites,
)
from spokecast.plans import presentation
from spokecast.session import scratch_path
from spokecast.sources import api_json, merge, periods, trip_files
from spokecast.sources import driver_tables as raw
from spokecast.sources.tables import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Stations count as near a venue within this distance in the registered event queries.
NEAR_KM = 9.0
CLUSTER_COUNT = 12
# Numbers of clusters of the holiday page.
PAGE_KS = (10, 30)


def register_exact(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """For results without distributed sums of doubles: values are left as they are."""
    QUERIES[build.__name__] = build
    return build


def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(build(spark, sf_dir))

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to six places, without negative zero."""
    return df.select(
        *[
            (F.round(f.name, 6) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# Shared inputs ---------------------------------------------------------------------------


def trips_of(spark: SparkSession, sf: str) -> DataFrame:
    return staging.clean_trips(raw.raw_trips(spark, sf))


def stations_of(spark: SparkSession, sf: str) -> DataFrame:
    return stations.dim_stations(trips_of(spark, sf))


def weather_of(spark: SparkSession, sf: str) -> DataFrame:
    return staging.clean_weather(raw.raw_weather(spark, sf))


def holidays_of(spark: SparkSession) -> DataFrame:
    return staging.stage_holidays(raw.raw_holidays(spark))


def games_of(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_games(raw.raw_games(spark, sf))


def demand_of(spark: SparkSession, sf: str) -> DataFrame:
    return daily.demand_daily(daily.trips_daily(trips_of(spark, sf)))


def effect_of(spark: SparkSession, sf: str) -> DataFrame:
    return daily.weather_effect(demand_of(spark, sf), weather_of(spark, sf))


def near_of(places: DataFrame) -> DataFrame:
    return proximity.station_proximity(places, raw.TEST_STADIUMS, walking_km=NEAR_KM)


def event_demand_of(spark: SparkSession, sf: str, baseline: str = "same_window") -> DataFrame:
    trips = trips_of(spark, sf)
    near = near_of(stations.dim_stations(trips))
    return events.game_day_demand(trips, games_of(spark, sf), near, holidays_of(spark), baseline)


def station_stats_of(spark: SparkSession, sf: str) -> DataFrame:
    trips = trips_of(spark, sf)
    return stations.station_stats(stations.dim_stations(trips), trips)


def factors_of(spark: SparkSession, sf: str, per_day_weather: bool = False) -> DataFrame:
    return factors.adjustment_factors(
        factors.daily_conditions(trips_of(spark, sf), weather_of(spark, sf), holidays_of(spark), per_day_weather)
    )


def net_flow_of(spark: SparkSession, sf: str) -> DataFrame:
    # Every station named by a trip has a cluster, so the trips' own stations are enough here.
    ids = (
        trips_of(spark, sf)
        .select(F.explode(F.array("start_station_id", "end_station_id")).alias("station_id"))
        .filter("station_id is not null")
        .distinct()
    )
    return net_flow.baseline_net_flow(trips_of(spark, sf), raw.station_clusters_by_rule(ids))


# Staging ---------------------------------------------------------------------------------


@register_exact
def trips_clean(spark, sf):
    """M1, B1."""
    return trips_of(spark, sf)


@register_exact
def weather_clean(spark, sf):
    """M2, B2."""
    return weather_of(spark, sf)


@register
def holidays_dedup(spark, sf):
    """M3: A16, G2, E1, B6."""
    return staging.stage_holidays(raw.order_holidays(spark, sf)).select(
        "date", "holiday_name", "country_code", "counties", "holiday_types", "is_major", "is_working_day", "source_year"
    )


@register
def holiday_rules(spark, sf):
    """Rule dates of every year seen in the orders."""
    return staging.rule_holidays(raw.order_holidays(spark, sf)).select(
        "date", "holiday_name", "holiday_types", "source_year"
    )


@register
def games_staged(spark, sf):
    """M4: B4, B5."""
    return staging.stage_games(raw.order_games(spark, sf))


# Core ------------------------------------------------------------------------------------


@register
def trips_daily(spark, sf):
    """M10, D1."""
    return daily.trips_daily(trips_of(spark, sf))


@register
def stations_dim(spark, sf):
    """M6: G1, D4, D5, B7, B8, C2."""
    return stations_of(spark, sf)


@register
def station_proximity(spark, sf):
    """M9: A15, C5, K1, B20."""
    return proximity.station_proximity(stations_of(spark, sf), raw.TEST_STADIUMS)


@register
def nearby_stations(spark, sf):
    """C12."""
    stadiums = proximity.dim_stadiums(spark, raw.TEST_STADIUMS)
    places = stations_of(spark, sf)
    return proximity.nearby_stations(near_of(places), places, stadiums)


@register
def nearby_pairs_banded(spark, sf):
    """M9 restricted to a radius by latitude bands."""
    stadiums = proximity.dim_stadiums(spark, raw.TEST_STADIUMS)
    return proximity.nearby_pairs(stadiums, stations_of(spark, sf), NEAR_KM)


@register
def station_clusters(spark, sf):
    """M8: K2, C14, with labels, centroids and distances."""
    return clusters.station_clusters(stations_of(spark, sf), k=CLUSTER_COUNT)


@register
def customer_clusters(spark, sf):
    """M8 over as many stations as customers, with the dimension's own k and restarts."""
    return clusters.station_clusters(raw.customer_stations(spark, sf))


@register
def station_clusters_check(spark, sf):
    """K2 invariants: stations, labels used, stations nearer to another centroid."""
    labelled = clusters.station_clusters(stations_of(spark, sf), k=CLUSTER_COUNT)
    centroids = labelled.select(
        F.col("cluster_id").alias("c"), F.col("centroid_lat").alias("lat"), F.col("centroid_lon").alias("lon")
    ).distinct()
    # At most CLUSTER_COUNT centroids, held in one array beside each station.
    listed = centroids.agg(F.collect_list(F.struct("lat", "lon"))).scalar()

    def squared(lat, lon):
        return F.pow(F.col("latitude") - lat, 2) + F.pow(F.col("longitude") - lon, 2)

    nearest = F.array_min(F.transform("centroids", lambda c: squared(c["lat"], c["lon"])))
    own = squared(F.col("centroid_lat"), F.col("centroid_lon"))
    return (
        labelled.withColumn("centroids", listed)
        .select("cluster_id", (own > nearest + 1e-12).alias("misplaced"))
        .agg(
            F.count(F.lit(1)).alias("stations"),
            F.countDistinct("cluster_id").alias("clusters"),
            F.count(F.when(F.col("misplaced"), 1)).alias("misplaced"),
        )
    )


# Daily marts -----------------------------------------------------------------------------


@register
def demand_daily(spark, sf):
    """D2, B9."""
    return demand_of(spark, sf)


@register
def weather_effect(spark, sf):
    """C2, B10."""
    return effect_of(spark, sf)


@register
def weather_rainy_days(spark, sf):
    """B17."""
    return daily.filter_rain(effect_of(spark, sf), "rainy").select("date", "trips_total", "precip", "rain_category")


@register
def station_stats(spark, sf):
    """C3, D3."""
    return station_stats_of(spark, sf)


@register
def top_stations(spark, sf):
    """the ten busiest start stations."""
    return stations.top_stations(station_stats_of(spark, sf))


@register
def home_kpis(spark, sf):
    """M23, D13."""
    return statistics.home_kpis(demand_of(spark, sf))


@register
def trips_by_day_type(spark, sf):
    """D14, D16."""
    return statistics.trips_by_day_type(demand_of(spark, sf))


# Holiday marts ---------------------------------------------------------------------------


def hour_cube(spark, sf):
    return holidays.start_cube(trips_of(spark, sf), "ride_date", "hour_of_day")


def day_cube(spark, sf):
    return holidays.start_cube(trips_of(spark, sf), "ride_date")


def by_station_of(spark, sf):
    """The station mart and the station dimension it used."""
    trips = trips_of(spark, sf)
    places = stations.dim_stations(trips)
    cube = holidays.start_cube(trips, "ride_date", "station_id")
    return holidays.impact_by_station(holidays_of(spark), cube, places), places


@register
def holiday_impact_summary(spark, sf):
    """C6, C9, D6, D26, D27."""
    return holidays.impact_summary(holidays_of(spark), day_cube(spark, sf))


@register
def holiday_impact_by_hour(spark, sf):
    """M15."""
    return holidays.impact_by_hour(holidays_of(spark), hour_cube(spark, sf))


@register
def holiday_impact_by_station(spark, sf):
    """M16."""
    return by_station_of(spark, sf)[0]


@register
def holiday_impact_by_area(spark, sf):
    """M17."""
    trips = trips_of(spark, sf)
    cube = holidays.start_cube(trips, "ride_date", "station_id")
    return holidays.impact_by_area(holidays_of(spark), cube, stations.dim_stations(trips))


@register
def holiday_station_slice(spark, sf):
    """B18 on M16."""
    return holidays.for_holiday(by_station_of(spark, sf)[0], "2024-01-15")


@register
def holiday_peak_hours(spark, sf):
    """D19."""
    return holidays.peak_hours(holidays.impact_by_hour(holidays_of(spark), hour_cube(spark, sf)))


@register
def holiday_top_bottom(spark, sf):
    """F3, B14."""
    return holidays.top_and_bottom(by_station_of(spark, sf)[0])


@register
def holiday_comparison(spark, sf):
    """B23."""
    return holidays.comparison(holidays.impact_summary(holidays_of(spark), day_cube(spark, sf)))


@register
def holiday_significance(spark, sf):
    """K7."""
    cube = day_cube(spark, sf)
    return holidays.significance(holidays.impact_summary(holidays_of(spark), cube), cube)


@register
def cluster_holiday_rollup(spark, sf):
    """D17 over a fixed station assignment."""
    by_station, places = by_station_of(spark, sf)
    return holidays.cluster_rollup(by_station, raw.station_clusters_by_rule(places))


def holiday_clusters_of(spark: SparkSession, by_station: DataFrame) -> DataFrame:
    return clusters.grouped_clusters(by_station, by=("holiday_date",), ks=PAGE_KS)


@register
def holiday_station_clusters(spark, sf):
    """K3, clusters of each holiday's stations for several k."""
    return holiday_clusters_of(spark, by_station_of(spark, sf)[0])


@register
def holiday_cluster_rollup(spark, sf):
    """K3 into D17, the change of each holiday in its own clusters."""
    by_station, _ = by_station_of(spark, sf)
    return holidays.cluster_rollup(by_station, holiday_clusters_of(spark, by_station), own=True, ks=("k",))


# Game marts ------------------------------------------------------------------------------


@register
def event_window_demand(spark, sf):
    """C7, C8, C10, D9 with the mart's own (empty) baseline."""
    return event_demand_of(spark, sf)


@register
def event_baseline_fixed(spark, sf):
    """M18 against the same time of day on other weeks."""
    return event_demand_of(spark, sf, "time_of_day")


@register
def event_rebalancing(spark, sf):
    """D10, B12."""
    return events.rebalancing(event_demand_of(spark, sf), stations_of(spark, sf))


@register
def event_rebalancing_slice(spark, sf):
    """B18, B22, F4 on M19."""
    plan = events.rebalancing(event_demand_of(spark, sf), stations_of(spark, sf))
    return events.rebalancing_slice(plan, "Yankee Stadium", 1.0)


@register
def event_extremes(spark, sf):
    """D24."""
    return events.rebalancing_extremes(events.rebalancing(event_demand_of(spark, sf), stations_of(spark, sf)))


@register
def event_profile(spark, sf):
    """D18."""
    return events.event_profile(event_demand_of(spark, sf, "time_of_day"))


@register
def event_list(spark, sf):
    """B19, B22 over games of whole ``orders``."""
    games = staging.stage_games(raw.order_games(spark, sf).withColumn("home_team_name", F.lit("Home")).withColumn("away_team_name", F.col("venue_name")))
    return events.game_list(games)


# Net flow, factors, forecast -------------------------------------------------------------


@register
def net_flow_baseline(spark, sf):
    """C1, C4, D8, B11."""
    return net_flow_of(spark, sf)


@register
def net_flow_per_day(spark, sf):
    """M20 divided by the days observed per weekday."""
    return net_flow.per_observed_day(net_flow_of(spark, sf), trips_of(spark, sf))


@register
def adjustment_factors(spark, sf):
    """C2, D11, D12, G3, B16."""
    return factors_of(spark, sf)


@register
def adjustment_factors_per_day(spark, sf):
    """M21 with each day's own precipitation."""
    return factors_of(spark, sf, per_day_weather=True)


@register
def scenario_effects(spark, sf):
    """Effects of every scenario."""
    return factors.factor_effects(factors.scenario_factors(factors.all_scenarios(spark), factors_of(spark, sf)))


@register
def forecast_grid(spark, sf):
    """K10, C13, B13 for all scenarios."""
    scenarios = factors.scenario_factors(factors.all_scenarios(spark), factors_of(spark, sf))
    return factors.forecast(net_flow_of(spark, sf), scenarios)


@register
def forecast_point(spark, sf):
    """The hours of one cluster under one scenario; the choices reach the join's inputs."""
    scenarios = factors.scenario_factors(factors.all_scenarios(spark), factors_of(spark, sf))
    grid = factors.forecast(net_flow_of(spark, sf), scenarios)
    first = factors.all_scenarios(spark).agg(*[F.min(s).alias(s) for s in factors.SLOTS]).first().asDict()
    return factors.forecast_for(grid, 2, **first)


# Statistics ------------------------------------------------------------------------------


@register
def weather_correlation(spark, sf):
    """K4."""
    return statistics.correlations(effect_of(spark, sf))


def by_rain(effect, figures):
    """The same figures over rainy and over dry days."""
    parts = [figures(daily.filter_rain(effect, days)).withColumn("days_kept", F.lit(days)) for days in ("rainy", "dry")]
    return parts[0].unionByName(parts[1])


@register
def weather_correlation_by_rain(spark, sf):
    """Correlations over rainy and over dry days."""
    return by_rain(effect_of(spark, sf), statistics.correlations)


@register
def whatif_by_rain(spark, sf):
    """The temperature line fitted to rainy and to dry days."""
    return by_rain(effect_of(spark, sf), lambda days: statistics.what_if(days, (-10.0, -2.5, 0.0, 2.5, 10.0)))


@register
def complete_case_correlation(spark, sf):
    """K4 as in the exploration."""
    return statistics.complete_case_correlations(effect_of(spark, sf))


@register
def whatif_regression(spark, sf):
    """K5."""
    return statistics.what_if(effect_of(spark, sf), (-10.0, -2.5, 0.0, 2.5, 10.0))


@register
def trend_by_rain(spark, sf):
    """K6: temperature trend of rainy and dry days."""
    return statistics.trend_lines(effect_of(spark, sf), "temp_avg", "is_rain")


@register
def trend_by_day_type(spark, sf):
    """K6: precipitation trend per day type."""
    return statistics.trend_lines(effect_of(spark, sf), "precip", "day_type")


@register
def bin_means_temperature(spark, sf):
    """D15, D16."""
    return statistics.bin_means(effect_of(spark, sf), "temp_category")


@register
def bin_means_rain(spark, sf):
    """D15, D16."""
    return statistics.bin_means(effect_of(spark, sf), "rain_category")


@register_exact
def iqr_outliers(spark, sf):
    """K8 over hourly demand; like every mart of days and hours its size is set by the calendar."""
    return statistics.iqr_outliers(hour_cube(spark, sf).select("ride_date", "hour_of_day", "trips"), "trips")


@register
def iqr_bounds(spark, sf):
    """K8."""
    return statistics.iqr_bounds(demand_of(spark, sf), "trips_total")


@register
def demand_distribution(spark, sf):
    """K9."""
    return statistics.distribution(demand_of(spark, sf), "trips_total")


@register
def demand_histogram(spark, sf):
    """K9: thirty bins of daily trips."""
    return statistics.histogram(demand_of(spark, sf), "trips_total")


@register
def eda_summary(spark, sf):
    """D23."""
    return statistics.describe(demand_of(spark, sf), "trips_total", "avg_duration_mins", "member_trips", "casual_trips")


@register
def eda_nulls(spark, sf):
    """D23."""
    return statistics.null_counts(effect_of(spark, sf))


# Quality ---------------------------------------------------------------------------------


def raw_tables(spark, sf):
    return {
        "bike_trips": trip_files.add_ride_mins(raw.raw_trips(spark, sf)),
        "weather": raw.raw_weather(spark, sf),
        "holidays": raw.raw_holidays(spark),
        "games": raw.raw_games(spark, sf),
    }


@register
def dq_suite_results(spark, sf):
    """The four raw suites."""
    return quality.run_suites(raw_tables(spark, sf), suites.RAW_SUITES).drop("severity")


@register
def dq_model_tests(spark, sf):
    """Model tests of four marts."""
    models = {
        "stg_bike_trips": trips_of(spark, sf),
        "mart_demand_daily": demand_of(spark, sf),
        "mart_weather_effect": effect_of(spark, sf),
        "mart_holiday_impact_by_hour": holidays.impact_by_hour(holidays_of(spark), hour_cube(spark, sf)),
    }
    return quality.with_status(quality.run_suites(models, suites.MODEL_SUITES))


@register
def dq_unique_combination(spark, sf):
    """L9 on ``lineitem``, which has repeated keys."""
    check = quality.Check("unique_combination", columns=("l_orderkey", "l_linenumber"))
    return quality.run_suite(raw.load(spark, sf, "lineitem"), (check,), "lineitem")


@register
def dq_relationships(spark, sf):
    """End stations that never start a trip."""
    trips = trips_of(spark, sf)
    check = quality.Check("relationship", "end_station_id", other="start_station_id", parent="starts")
    return quality.run_suite(trips, (check,), "trips", {"starts": trips})


@register
def dq_source_rollup(spark, sf):
    """L16."""
    return quality.source_records(quality.run_suites(raw_tables(spark, sf), suites.RAW_SUITES))


@register
def dq_freshness(spark, sf):
    """L11, D22, B21."""
    tables = raw_tables(spark, sf)
    return quality.freshness(
        {
            "bike_trips": (tables["bike_trips"], "started_at"),
            "weather": (tables["weather"], "date"),
            "holidays": (tables["holidays"], "date"),
            "games": (tables["games"], "game_date"),
        },
        "2024-02-10",
    )


@register
def dq_row_loss(spark, sf):
    """L12, C11."""
    return quality.row_loss(raw.raw_weather(spark, sf), weather_of(spark, sf), "date")


@register
def dq_monitor(spark, sf):
    """Two stored runs, figures of the newer one."""
    path = scratch_path(spark, "quality-results")
    tables = raw_tables(spark, sf)
    records = quality.source_records(quality.run_suites(tables, suites.RAW_SUITES))
    tests = quality.model_record(quality.run_suites(tables, suites.SOURCE_KEYS))
    quality.append_results(quality.stamp_run(tests, "first", "2024-01-30 06:00:00"), path)
    quality.append_results(quality.stamp_run(records.unionByName(tests), "second", "2024-01-31 06:00:00"), path)
    return quality.run_kpis(quality.latest_run(quality.stored_results(spark, path)))


@register
def dq_failed_tests(spark, sf):
    """The failed tests of the newest stored run with their messages."""
    path = scratch_path(spark, "quality-results")
    tables = raw_tables(spark, sf)
    records = quality.source_records(quality.run_suites(tables, suites.RAW_SUITES))
    tests = quality.model_record(quality.run_suites(tables, suites.SOURCE_KEYS))
    quality.append_results(quality.stamp_run(records, "first", "2024-01-30 06:00:00"), path)
    quality.append_results(quality.stamp_run(records.unionByName(tests), "second", "2024-01-31 06:00:00"), path)
    return quality.failed_tests(quality.latest_run(quality.stored_results(spark, path)))


# Order -----------------------------------------------------------------------------------


@register
def order_holiday_areas(spark, sf):
    """areas of each holiday by change, with their places."""
    mart = QUERIES["holiday_impact_by_area"](spark, sf)
    return presentation.placed("mart_holiday_impact_by_area", mart, "area_name").select("rank", "holiday_date", "area_name", "trips_pct_change")


@register
def order_rebalancing(spark, sf):
    """moves of each venue, largest mean flow first, with their places."""
    plan = QUERIES["event_rebalancing"](spark, sf)
    return presentation.placed("mart_game_rebalancing", plan).select("rank", "stadium_name", "station_id", "interval_offset", "avg_net_flow")


@register
def order_clusters(spark, sf):
    """stations of each cluster by distance from its centroid, with their places."""
    made = QUERIES["station_clusters"](spark, sf)
    return presentation.placed("dim_station_clusters", made, "station_id").select("rank", "cluster_id", "station_id", "distance_from_centroid_km")


@register
def order_nearby(spark, sf):
    """stations of each venue by distance, with their places."""
    near = QUERIES["station_proximity"](spark, sf)
    return presentation.placed("fct_station_proximity", near, "station_id").select("rank", "stadium_id", "station_id", "distance_km")


@register
def order_line_items(spark, sf):
    """line items by price, dearest first, with their places."""
    items = raw.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ranking.ranked(items, [F.desc_nulls_last("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")])


# Sources ---------------------------------------------------------------------------------


@register_exact
def weather_arrays_explode(spark, sf):
    """A5."""
    return api_json.parse_weather(
        raw.order_weather_responses(spark, sf), "40.73,-73.94", keep=("o_orderkey",)
    ).drop("_dlt_load_timestamp")


@register
def holiday_merge(spark, sf):
    """A7, A8."""
    entries = api_json.parse_holidays(raw.order_holiday_responses(spark, sf), ("source_year", "o_orderkey"))
    placed = entries.withColumn("position", F.col("o_orderkey") * 2 + F.col("position"))
    return api_json.merge_holidays(placed).drop("_dlt_load_timestamp")


@register
def schedule_flatten(spark, sf):
    """A6."""
    return api_json.parse_schedule(raw.order_schedule_responses(spark, sf)).drop("_dlt_load_timestamp")


@register_exact
def merge_upsert(spark, sf):
    """Later line items replace earlier ones of the same key.

    A line item without a date is the earliest of its key; where a key has no date at all, one is kept.
    """
    items = raw.load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.to_date("l_shipdate").alias("l_shipdate")
    )
    cut = F.lit("1997-01-01").cast("date")
    newest = [F.desc("l_shipdate"), F.desc("l_extendedprice"), F.desc("l_quantity")]
    keys = ["l_orderkey", "l_linenumber"]
    undated = items.filter("l_shipdate is null")
    dated = items.filter("l_shipdate is not null").select(*(F.col(k).alias(f"dated_{k}") for k in keys)).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"dated_{k}")) for k in keys]
    return merge.merge_by_key(
        items.filter(F.col("l_shipdate") < cut).unionAll(undated.join(dated, same, "left_semi")),
        items.filter(F.col("l_shipdate") >= cut).unionAll(undated.join(dated, same, "left_anti")),
        keys,
        newest,
    )


@register_exact
def upsert_table(spark, sf):
    """Line items loaded in three batches into a stored table, with a null partition."""
    path = scratch_path(spark, "upsert")
    items = raw.load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.to_date("l_shipdate").alias("l_shipdate")
    )
    items = items.withColumn("ship_year", F.when(F.col("l_quantity") != 7, F.year("l_shipdate")))
    batch = F.when(F.col("l_shipdate") < "1994-01-01", 1).when(F.col("l_shipdate") < "1996-01-01", 2).otherwise(3)
    newest = [F.desc("l_shipdate"), F.desc("l_extendedprice"), F.desc("l_quantity")]
    for number in (1, 2, 3):
        merge.upsert_partitions(
            spark, path, items.filter(batch == number), ["l_orderkey", "l_linenumber"], "ship_year", newest
        )
    return merge.read_table(spark, path, "ship_year")


@register_exact
def csv_ingest_drift(spark, sf):
    """A1, A2: a month's files with columns in another order, missing and added."""
    folder = scratch_path(spark, "trip-drift")
    trips = raw.raw_trips(spark, sf).select(
        F.col("ride_id").alias("Ride ID"),
        F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("Started At"),
        F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss").alias("Ended At"),
        F.col("start_station_id").alias("Start Station Id"),
        F.col("member_casual"),
        F.date_format("started_at", "yyyyMM").alias("month"),
    )
    third = F.col("Ride ID") % 3
    whole = ["Ride ID", "Started At", "Ended At", "Start Station Id", "member_casual"]
    parts = [
        trips.filter(third == 0).select(*whole, "month"),
        trips.filter(third == 1).select(*whole[3::-1], "month"),
        trips.filter((third == 2) | third.isNull()).select(*whole[::-1], F.lit("late").alias("Note"), "month"),
    ]
    for part in parts:
        part.write.mode("append").partitionBy("month").option("header", True).csv(folder)
    months = periods.months_between(spark, "2023-12-31", "2024-02-01")
    return trip_files.read_months(spark, folder + "/month={month}", months).drop("_dlt_load_timestamp")


@register_exact
def csv_ingest(spark, sf):
    """A1-A4, A10: trips written as monthly CSV files, read back for a period."""
    folder = scratch_path(spark, "trip-files")
    trips = raw.raw_trips(spark, sf)
    cells = trips.select(
        F.col("ride_id").alias("Ride ID"),
        F.when(F.col("ride_id") % 97 == 0, "unknown")
        .otherwise(F.date_format("started_at", "yyyy-MM-dd HH:mm:ss"))
        .alias("Started At"),
        F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss").alias("Ended At"),
        F.col("start_station_id").alias("Start Station Id"),
        F.col("start_lat").alias("Start Lat"),
        F.col("member_casual"),
        F.date_format("started_at", "yyyyMM").alias("month"),
    )
    cells.write.partitionBy("month").option("header", True).csv(folder)
    months = periods.months_between(spark, "2023-12-31", "2024-02-01")
    return trip_files.read_months(spark, folder + "/month={month}", months).drop("_dlt_load_timestamp")


@register
def partition_calendar(spark, sf):
    """A10: months of the orders' period and the orders each one prunes to, from a table stored by month."""
    folder = scratch_path(spark, "orders-by-month")
    orders = raw.load(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("source_month"))
    orders.hint("rebalance", "source_month").write.partitionBy("source_month").parquet(folder)
    stored = spark.read.schema("o_orderkey bigint, source_month string").parquet(folder)
    kept = periods.in_period(stored, periods.month_calendar(spark, "1994-01-31", "1996-02-15"))
    return kept.groupBy("source_month").agg(F.count(F.lit(1)).alias("orders"))


@register
def warehouse_roundtrip(spark, sf):
    """The daily fact stored in its layer, read back by name."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    stored = warehouse.store("core", "fct_trips_daily", daily.trips_daily(trips_of(spark, sf)))
    return stored.groupBy("member_casual").agg(
        F.sum("trips").alias("trips"), F.countDistinct("ride_date").alias("days")
    )
