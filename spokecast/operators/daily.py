"""Daily demand and weather effect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.functions import calendar as cal

# Bins of precipitation (mm) and mean temperature (degrees C).
HEAVY_RAIN_MM = 10
TEMPERATURE_BINS = ((5, "Very Cold"), (15, "Cold"), (25, "Moderate"))


def trips_daily(trips: DataFrame) -> DataFrame:
    """Trips per day and rider type, with distinct stations at either end.

    One scan: both ends of a trip are counted per (day, rider, side, station), combined
    before the shuffle, so shuffled rows grow with days x stations and not with trips; the
    stations of a day are then its groups.
    """
    keys = ["ride_date", "member_casual"]
    sides = F.array(
        F.struct(F.col("start_station_id").alias("station_id"), F.col("ride_mins").alias("mins")),
        F.struct(F.col("end_station_id").alias("station_id"), F.lit(None).cast("double").alias("mins")),
    )
    per_station = (
        trips.select(*keys, F.posexplode(sides).alias("side", "e"))
        .groupBy(*keys, "side", F.col("e.station_id").alias("station_id"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("e.mins").alias("mins"),
            F.min("e.mins").alias("shortest"),
            F.max("e.mins").alias("longest"),
        )
    )
    return per_day(per_station)


def per_day(per_station: DataFrame) -> DataFrame:
    """Days and rider types from rows (day, rider, side, station)."""
    keys = ["ride_date", "member_casual"]
    starts, ends = F.col("side") == 0, F.col("side") == 1
    count = F.sum(F.when(starts, F.col("n")))
    return per_station.groupBy(*keys).agg(
        count.alias("trips"),
        (F.sum("mins") / count).alias("avg_duration_mins"),
        F.min("shortest").alias("min_duration_mins"),
        F.max("longest").alias("max_duration_mins"),
        F.count(F.when(starts, F.col("station_id"))).alias("unique_start_stations"),
        F.count(F.when(ends, F.col("station_id"))).alias("unique_end_stations"),
    )


def _trips_of(rider: str):
    return F.sum(F.when(F.col("member_casual") == rider, F.col("trips")).otherwise(0))


def demand_daily(daily: DataFrame) -> DataFrame:
    """Days with totals, the rider split and the day type.

    The mean duration is the plain mean of the rider types' means, and the station totals
    add the rider types' distinct counts, as the mart defines them.
    """
    return (
        daily.groupBy("ride_date")
        .agg(
            F.sum("trips").alias("trips_total"),
            F.avg("avg_duration_mins").alias("avg_duration_mins"),
            _trips_of("member").alias("member_trips"),
            _trips_of("casual").alias("casual_trips"),
            F.sum("unique_start_stations").alias("total_start_stations"),
            F.sum("unique_end_stations").alias("total_end_stations"),
        )
        .withColumn("day_of_week", cal.day_name(F.col("ride_date")))
        .withColumn("day_of_week_num", cal.day_number(F.col("ride_date")))
        .withColumn("day_type", cal.day_type(F.col("ride_date")))
    )


def weather_effect(demand: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily demand beside the day's weather and its bins.

    A day without weather falls into the last bins, ``No Rain`` and ``Warm``.
    """
    day = weather.select("date", "tmax", "tmin", "precip", "wind_max").withColumn(
        "temp_avg", (F.col("tmax") + F.col("tmin")) / 2.0
    )
    (limit, label), *rest = TEMPERATURE_BINS
    temperature = F.when(F.col("temp_avg") < limit, label)
    for limit, label in rest:
        temperature = temperature.when(F.col("temp_avg") < limit, label)
    return (
        demand.withColumnRenamed("ride_date", "date")
        .join(day, "date", "left")
        .select(
            "date",
            "trips_total",
            "avg_duration_mins",
            "member_trips",
            "casual_trips",
            "day_of_week",
            "day_type",
            "tmax",
            "tmin",
            "temp_avg",
            "precip",
            "wind_max",
            F.when(F.col("precip") > 0, 1).otherwise(0).alias("is_rain"),
            F.when(F.col("precip") > HEAVY_RAIN_MM, "Heavy Rain")
            .when(F.col("precip") > 0, "Light Rain")
            .otherwise("No Rain")
            .alias("rain_category"),
            temperature.otherwise("Warm").alias("temp_category"),
        )
    )


def filter_rain(effect: DataFrame, condition: str = "all") -> DataFrame:
    """``rainy``, ``dry`` or ``all`` days."""
    if condition == "all":
        return effect
    return effect.filter(F.col("is_rain") == {"rainy": 1, "dry": 0}[condition])
