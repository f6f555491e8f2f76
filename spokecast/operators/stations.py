"""Station dimension and station statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.functions import geo


def dim_stations(trips: DataFrame) -> DataFrame:
    """One row per station seen at either end of a trip.

    One scan: each trip gives its two ends, and names become grouping keys, so the wide
    aggregate keeps only fixed-width buffers (hash aggregation, combined before the
    shuffle; a busy station costs one row per task).  The coordinates are those of one
    start inside the city box, picked by the hash of its ride id, so reruns agree; the name
    is the commonest one.
    """
    lat, lng = F.col("start_lat"), F.col("start_lng")
    pick = F.when(geo.in_city(lat, lng), F.xxhash64("ride_id"))
    ends = F.array(
        F.struct(
            F.col("start_station_id").alias("station_id"),
            F.col("start_station_name").alias("station_name"),
            lat.cast("double").alias("lat"),
            lng.cast("double").alias("lng"),
            pick.alias("pick"),
        ),
        F.struct(
            F.col("end_station_id").alias("station_id"),
            F.col("end_station_name").alias("station_name"),
            F.lit(None).cast("double").alias("lat"),
            F.lit(None).cast("double").alias("lng"),
            F.lit(None).cast("bigint").alias("pick"),
        ),
    )
    names = (
        trips.select(F.explode(ends).alias("e"))
        .select("e.*")
        .filter("station_id is not null")
        .groupBy("station_id", "station_name")
        .agg(
            F.min_by("lat", "pick").alias("lat"),
            F.min_by("lng", "pick").alias("lng"),
            F.min("pick").alias("pick"),
            F.count(F.lit(1)).alias("uses"),
        )
    )
    return dimension(names)


def dimension(names: DataFrame) -> DataFrame:
    """Stations from their names: how often each is used, and the picked coordinates."""
    by_use = F.when(F.col("station_name").isNotNull(), F.struct(-F.col("uses"), F.col("station_name")))
    return (
        names.groupBy("station_id")
        .agg(
            F.min_by("station_name", by_use).alias("station_name"),
            F.count(F.lit(1)).alias("name_variations"),
            F.min_by("lat", "pick").alias("latitude"),
            F.min_by("lng", "pick").alias("longitude"),
        )
        .withColumn("area", geo.area_of(F.col("latitude"), F.col("longitude")))
    )


def rides_are_unique(trips: DataFrame) -> bool:
    """Whether every known ride id occurs once.

    The check moves ride ids only, a fraction of what grouping whole trip ends would.
    """
    repeated = trips.filter("ride_id is not null").groupBy("ride_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeated.isEmpty()


def station_stats(stations: DataFrame, trips: DataFrame, ride_ids_unique: bool = False) -> DataFrame:
    """Starts, ends, duration and member share per station; unused stations count 0.

    Distinct rides are counted exactly by grouping on (station, ride) once for both trip
    ends; that shuffle is keyed by the ride as well, so no station can be hot.  On a table
    already merged on ``ride_id`` pass ``ride_ids_unique=True``: plain counts then give the
    same result without that shuffle.
    """
    flags = {"starts": 1, "ends": 2, "member": 4, "casual": 8}
    rider = F.when(F.col("member_casual") == "member", 4).when(F.col("member_casual") == "casual", 8).otherwise(0)
    known = F.col("ride_id").isNotNull()
    ends = F.array(
        F.struct(
            F.col("start_station_id").alias("station_id"),
            F.when(known, rider + flags["starts"]).otherwise(0).alias("flags"),
            F.col("ride_mins").alias("mins"),
        ),
        F.struct(
            F.col("end_station_id").alias("station_id"),
            F.when(known, flags["ends"]).otherwise(0).alias("flags"),
            F.lit(None).cast("double").alias("mins"),
        ),
    )
    legs = trips.select("ride_id", F.explode(ends).alias("e")).select("ride_id", "e.*").filter("station_id is not null")
    if ride_ids_unique:
        per_ride = legs.withColumn("timed", F.when(F.col("mins").isNotNull(), 1).otherwise(0))
    else:
        per_ride = legs.groupBy("station_id", "ride_id").agg(
            F.bit_or("flags").alias("flags"), F.sum("mins").alias("mins"), F.count("mins").alias("timed")
        )
    per_station = per_ride.groupBy("station_id").agg(
        *[F.count(F.when(F.col("flags").bitwiseAND(bit) != 0, 1)).alias(f) for f, bit in flags.items()],
        (F.sum("mins") / F.nullif(F.sum("timed"), F.lit(0))).alias("avg_start_duration"),
    )
    return stats_of(stations, per_station)


def stats_of(stations: DataFrame, per_station: DataFrame) -> DataFrame:
    """The statistics' columns from counts per station; stations without any count 0."""
    count = {f: F.coalesce(F.col(f), F.lit(0)) for f in ("starts", "ends", "member", "casual")}
    return stations.select("station_id", "station_name").join(per_station, "station_id", "left").select(
        "station_id",
        "station_name",
        count["starts"].alias("start_trip_count"),
        count["ends"].alias("end_trip_count"),
        (count["starts"] + count["ends"]).alias("total_trip_count"),
        "avg_start_duration",
        count["member"].alias("member_start_trips"),
        count["casual"].alias("casual_start_trips"),
        F.round(count["member"] * 100.0 / F.nullif(count["starts"], F.lit(0)).cast("double"), 2).alias("member_pct"),
    )


def top_stations(stats: DataFrame, n: int = 10) -> DataFrame:
    """Stations with most starts; equal counts go by station id (F2)."""
    return (
        stats.orderBy(F.desc("start_trip_count"), "station_id")
        .limit(n)
        .select("station_name", F.col("start_trip_count").alias("trip_count"))
    )
