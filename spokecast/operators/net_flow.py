"""Baseline net flow per cluster, weekday and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.functions import calendar as cal


def station_flow(trips: DataFrame) -> DataFrame:
    """Departures and arrivals per station, weekday and hour, in one scan.

    Both ends of a trip become rows of one aggregate, which also replaces the full outer
    join of departures and arrivals: a missing side sums to zero (C4).
    """

    def end(station: str, at: str, started: int):
        return F.struct(
            F.col(station).alias("station_id"),
            cal.day_number(F.col(at)).alias("day_of_week"),
            F.hour(at).cast("bigint").alias("hour"),
            F.lit(started).alias("started"),
            F.lit(1 - started).alias("ended"),
        )

    ends = F.array(end("start_station_id", "started_at", 1), end("end_station_id", "ended_at", 0))
    return (
        trips.select(F.explode(ends).alias("e"))
        .select("e.*")
        .filter("station_id is not null")
        .groupBy("station_id", "day_of_week", "hour")
        .agg(F.sum("started").alias("trips_started"), F.sum("ended").alias("trips_ended"))
    )


def baseline_net_flow(trips: DataFrame, clusters: DataFrame) -> DataFrame:
    """Totals per cluster, weekday and hour; trips meet clusters after station totals."""
    return by_cluster(station_flow(trips), clusters)


def by_cluster(flow: DataFrame, clusters: DataFrame) -> DataFrame:
    """The baseline from flows per station, weekday and hour."""
    return (
        flow.join(clusters.select("station_id", "cluster_id"), "station_id")
        .groupBy("cluster_id", "day_of_week", "hour")
        .agg(F.sum("trips_started").alias("trips_started"), F.sum("trips_ended").alias("trips_ended"))
        .withColumn("net_flow", F.col("trips_ended") - F.col("trips_started"))
        .withColumn("day_name", cal.day_name_of(F.col("day_of_week")))
        .withColumn("hour_label", cal.hour_label(F.col("hour")))
    )


def per_observed_day(net_flow: DataFrame, trips: DataFrame) -> DataFrame:
    """Net flow as a mean over the days seen per weekday; the baseline itself holds totals."""
    days = (
        trips.select("ride_date")
        .distinct()
        .groupBy(cal.day_number(F.col("ride_date")).alias("day_of_week"))
        .agg(F.count(F.lit(1)).alias("observed_days"))
    )
    return net_flow.join(days, "day_of_week", "left").select(
        "cluster_id",
        "day_of_week",
        "hour",
        "observed_days",
        (F.col("net_flow") / F.col("observed_days")).alias("net_flow_per_day"),
    )
