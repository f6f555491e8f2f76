"""Both ends of trips counted by day, hour, station and rider: what every mart but the games' can be built from.

A cube is kept for each stored part of the trips (a month), so a refresh counts the trips of the months that
have changed and rebuilds the rest from cubes.  The functions below give what their namesakes give from trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.functions import calendar as cal
from spokecast.functions import geo
from spokecast.operators import daily, holidays, net_flow, stations

KEYS = ("ride_date", "side", "station_id", "station_name", "member_casual", "day_of_week", "hour")
START, END = 0, 1


def trip_ends(trips: DataFrame, *parts: str) -> DataFrame:
    """The cube, by further columns ``parts`` of the trips if named; one scan, combined before the shuffle."""
    lat, lng = F.col("start_lat"), F.col("start_lng")
    pick = F.when(geo.in_city(lat, lng), F.xxhash64("ride_id"))

    def end(side: int, place: str, at: str):
        own = side == START
        return F.struct(
            F.lit(side).alias("side"),
            F.col(f"{place}_station_id").alias("station_id"),
            F.col(f"{place}_station_name").alias("station_name"),
            cal.day_number(F.col(at)).alias("day_of_week"),
            F.hour(at).cast("bigint").alias("hour"),
            *[
                (c if own else F.lit(None).cast(kind)).alias(name)
                for name, c, kind in (
                    ("mins", F.col("ride_mins"), "double"),
                    ("lat", lat.cast("double"), "double"),
                    ("lng", lng.cast("double"), "double"),
                    ("pick", pick, "bigint"),
                )
            ],
        )

    sides = F.array(end(START, "start", "started_at"), end(END, "end", "ended_at"))
    legs = trips.select(*parts, "ride_date", "member_casual", "ride_id", F.explode(sides).alias("e"))
    return (
        legs.select(*parts, "ride_date", "member_casual", F.col("ride_id").isNotNull().cast("int").alias("known"), "e.*")
        .groupBy(*parts, *KEYS)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("known").alias("known"),
            F.sum("mins").alias("mins"),
            F.count("mins").alias("timed"),
            F.min("mins").alias("shortest"),
            F.max("mins").alias("longest"),
            F.min("pick").alias("pick"),
            F.min_by("lat", "pick").alias("lat"),
            F.min_by("lng", "pick").alias("lng"),
        )
    )


def dim_stations(ends: DataFrame) -> DataFrame:
    named = (
        ends.filter("station_id is not null")
        .groupBy("station_id", "station_name")
        .agg(
            F.min_by("lat", "pick").alias("lat"),
            F.min_by("lng", "pick").alias("lng"),
            F.min("pick").alias("pick"),
            F.sum("n").alias("uses"),
        )
    )
    return stations.dimension(named)


def trips_daily(ends: DataFrame) -> DataFrame:
    per_station = ends.groupBy("ride_date", "member_casual", "side", "station_id").agg(
        F.sum("n").alias("n"), F.sum("mins").alias("mins"), F.min("shortest").alias("shortest"), F.max("longest").alias("longest")
    )
    return daily.per_day(per_station)


def start_cube(ends: DataFrame) -> DataFrame:
    def riders(kind: str):
        return F.sum(F.when(F.col("member_casual") == kind, F.col("n")).otherwise(0))

    return (
        ends.filter(F.col("side") == START)
        .groupBy("ride_date", F.col("hour").alias("hour_of_day"), "station_id")
        .agg(
            F.sum("n").alias("trips"),
            F.sum("mins").alias("mins"),
            riders("member").alias("member_trips"),
            riders("casual").alias("casual_trips"),
        )
        .select(*holidays.CUBE_KEYS, *holidays.CUBE_MEASURES)
    )


def station_flow(ends: DataFrame) -> DataFrame:
    def on(side: int):
        return F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0))

    return (
        ends.filter("station_id is not null")
        .groupBy("station_id", "day_of_week", "hour")
        .agg(on(START).alias("trips_started"), on(END).alias("trips_ended"))
    )


def baseline_net_flow(ends: DataFrame, clusters: DataFrame) -> DataFrame:
    return net_flow.by_cluster(station_flow(ends), clusters)


def station_stats(places: DataFrame, ends: DataFrame) -> DataFrame:
    """Holds where ride ids are unique, as in a table merged on them."""
    start = F.col("side") == START

    def known(condition):
        return F.sum(F.when(condition, F.col("known")).otherwise(0))

    per_station = ends.filter("station_id is not null").groupBy("station_id").agg(
        known(start).alias("starts"),
        known(F.col("side") == END).alias("ends"),
        known(start & (F.col("member_casual") == "member")).alias("member"),
        known(start & (F.col("member_casual") == "casual")).alias("casual"),
        (F.sum("mins") / F.nullif(F.sum("timed"), F.lit(0))).alias("avg_start_duration"),
    )
    return stations.stats_of(places, per_station)
