"""Holiday impact marts.

All four marts read one cube of starts (day x hour x station) and one small calendar of
(holiday, day) pairs, so trips are scanned and shuffled once and the +-15 day range join
becomes an equi-join on days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokecast.functions import calendar as cal
from spokecast.functions import measures as m
from spokecast.functions.student import two_sided_p

# Window around a holiday, least days for a test, its level.
BASELINE_DAYS = 15
MIN_TEST_DAYS = 5
SIGNIFICANCE = 0.05

HOLIDAY_KEYS = ("holiday_date", "holiday_name", "is_major", "is_working_day")
CUBE_KEYS = ("ride_date", "hour_of_day", "station_id")
CUBE_MEASURES = ("trips", "mins", "member_trips", "casual_trips")


def start_cube(trips: DataFrame, *keys: str) -> DataFrame:
    """Starts per any of ``CUBE_KEYS``; combined before the shuffle, so hot keys do not matter."""
    source = {
        "ride_date": F.col("ride_date"),
        "hour_of_day": F.hour("started_at").cast("bigint"),
        "station_id": F.col("start_station_id"),
    }

    def riders(kind: str) -> Column:
        return F.sum(F.when(F.col("member_casual") == kind, 1).otherwise(0))

    return trips.groupBy(*[source[k].alias(k) for k in keys or CUBE_KEYS]).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("ride_mins").alias("mins"),
        riders("member").alias("member_trips"),
        riders("casual").alias("casual_trips"),
    )


def roll_up(cube: DataFrame, *keys: str) -> DataFrame:
    """The cube on fewer keys; no further aggregation when it already has just these."""
    if set(cube.columns) == {*keys, *CUBE_MEASURES}:
        return cube
    return cube.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in CUBE_MEASURES])


def holiday_calendar(holidays: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """Each holiday's own day and its baseline days.

    Baseline days are weekdays in the window that are no holiday.  At most ``2 * days + 1``
    rows per holiday.
    """
    named = holidays.select(
        F.col("date").alias("holiday_date"), "holiday_name", "is_major", "is_working_day"
    ).filter("holiday_date is not null")
    window = F.sequence(F.date_sub("holiday_date", days), F.date_add("holiday_date", days))
    around = named.withColumn("ride_date", F.explode(window))
    own = around.filter("ride_date = holiday_date").withColumn("on_holiday", F.lit(True))
    taken = holidays.select(F.col("date").alias("ride_date"))
    baseline = (
        around.filter(~cal.is_weekend(F.col("ride_date")))
        .join(taken, "ride_date", "left_anti")
        .withColumn("on_holiday", F.lit(False))
    )
    return own.unionByName(baseline)


def _on(column: str) -> Column:
    return F.sum(F.when(F.col("on_holiday"), F.col(column)))


def _off(column: str) -> Column:
    return F.sum(F.when(~F.col("on_holiday"), F.col(column)))


def _per_base_day(column: str) -> Column:
    return _off(column) / F.nullif(F.count(F.when(~F.col("on_holiday"), 1)), F.lit(0))


def _compare(calendar: DataFrame, totals: DataFrame, *keys: str) -> DataFrame:
    """Holiday count and mean per observed baseline day for each key.

    ``totals`` has one row per day and key, so baseline rows are the distinct days.
    """
    return (
        calendar.join(totals, "ride_date")
        .groupBy(*HOLIDAY_KEYS, *keys)
        .agg(
            _on("trips").alias("trips_holiday"),
            _per_base_day("trips").alias("trips_baseline"),
            *([_on("stations").alias("station_count")] if "stations" in totals.columns else []),
        )
        .filter("trips_holiday is not null")
        .withColumn("trips_abs_change", F.col("trips_holiday") - F.col("trips_baseline"))
        .withColumn("trips_pct_change", m.pct_change(F.col("trips_holiday"), F.col("trips_baseline")))
    )


def impact_summary(holidays: DataFrame, cube: DataFrame) -> DataFrame:
    """One row per holiday: trips, duration and rider split against the baseline."""
    off_day = ~F.col("on_holiday")
    base = (
        holiday_calendar(holidays)
        .join(roll_up(cube, "ride_date"), "ride_date")
        .groupBy(*HOLIDAY_KEYS)
        .agg(
            _on("trips").alias("total_trips_holiday"),
            _per_base_day("trips").alias("total_trips_baseline"),
            (_on("mins") / _on("trips")).alias("avg_duration_holiday"),
            (_off("mins") / _off("trips")).alias("avg_duration_baseline"),
            _on("member_trips").alias("member_trips_holiday"),
            _per_base_day("member_trips").alias("member_trips_baseline"),
            _on("casual_trips").alias("casual_trips_holiday"),
            _per_base_day("casual_trips").alias("casual_trips_baseline"),
            F.min(F.when(off_day, F.col("ride_date"))).alias("baseline_start_date"),
            F.max(F.when(off_day, F.col("ride_date"))).alias("baseline_end_date"),
            F.count(F.when(off_day, 1)).alias("baseline_days_count"),
        )
        .filter("total_trips_holiday is not null and baseline_days_count > 0")
    )

    def block(prefix: str, out: str) -> list[Column]:
        on, off = F.col(f"{prefix}_holiday"), F.col(f"{prefix}_baseline")
        return [on, off, (on - off).alias(f"{out}_abs_change"), m.pct_change(on, off).alias(f"{out}_pct_change")]

    return base.select(
        *HOLIDAY_KEYS,
        *block("total_trips", "trips"),
        *block("avg_duration", "duration"),
        *block("member_trips", "member_trips"),
        *block("casual_trips", "casual_trips"),
        "baseline_start_date",
        "baseline_end_date",
        "baseline_days_count",
    )


def impact_by_hour(holidays: DataFrame, cube: DataFrame) -> DataFrame:
    """Holiday x hour, where both sides have trips."""
    totals = roll_up(cube, "ride_date", "hour_of_day")
    return _compare(holiday_calendar(holidays), totals, "hour_of_day").filter("trips_baseline is not null")


def impact_by_station(holidays: DataFrame, cube: DataFrame, stations: DataFrame) -> DataFrame:
    """Holiday x start station; stations without a baseline stay, with nulls."""
    totals = roll_up(cube.filter("station_id is not null"), "ride_date", "station_id")
    places = stations.select("station_id", "station_name", "area", "latitude", "longitude")
    return (
        _compare(holiday_calendar(holidays), totals, "station_id")
        .join(places, "station_id", "left")
        .select(
            *HOLIDAY_KEYS,
            "station_id",
            "station_name",
            "area",
            "latitude",
            "longitude",
            "trips_holiday",
            "trips_baseline",
            "trips_abs_change",
            "trips_pct_change",
        )
    )


def impact_by_area(holidays: DataFrame, cube: DataFrame, stations: DataFrame) -> DataFrame:
    """Holiday x area with per-station means; trips without an area drop out."""
    per_station = roll_up(cube.filter("station_id is not null"), "ride_date", "station_id")
    totals = (
        per_station.join(stations.select("station_id", F.col("area").alias("area_name")), "station_id")
        .filter("area_name is not null")
        .groupBy("ride_date", "area_name")
        .agg(F.sum("trips").alias("trips"), F.count(F.lit(1)).alias("stations"))
    )
    per_holiday = _compare(holiday_calendar(holidays), totals, "area_name").filter("trips_baseline is not null")
    stations_used = F.nullif(F.col("station_count"), F.lit(0))
    return per_holiday.select(
        *HOLIDAY_KEYS,
        "area_name",
        "station_count",
        "trips_holiday",
        "trips_baseline",
        "trips_abs_change",
        "trips_pct_change",
        (F.col("trips_holiday") / stations_used).alias("avg_station_trips_holiday"),
        (F.col("trips_baseline") / stations_used).alias("avg_station_trips_baseline"),
    )


def for_holiday(mart: DataFrame, holiday_date: str) -> DataFrame:
    """One holiday's slice of any of the marts."""
    return mart.filter(F.col("holiday_date") == F.lit(holiday_date).cast("date"))


def peak_hours(by_hour: DataFrame) -> DataFrame:
    """Busiest hour in the baseline and on the holiday; the earlier one on ties."""

    def busiest(value: str) -> Column:
        return F.max_by("hour_of_day", F.struct(F.col(value), -F.col("hour_of_day")))

    return by_hour.groupBy("holiday_date", "holiday_name").agg(
        busiest("trips_baseline").alias("baseline_peak_hour"),
        F.max("trips_baseline").alias("baseline_peak_trips"),
        busiest("trips_holiday").alias("holiday_peak_hour"),
        F.max("trips_holiday").alias("holiday_peak_trips"),
    )


def top_and_bottom(by_station: DataFrame, n: int = 10) -> DataFrame:
    """Per holiday the ``n`` stations with the largest and the smallest change.

    Both rankings keep ``n`` rows per holiday before the shuffle.
    """
    known = by_station.filter("trips_pct_change is not null")
    pieces = []
    for side, order in (("increase", F.desc("trips_pct_change")), ("decrease", F.asc("trips_pct_change"))):
        ranked = Window.partitionBy("holiday_date").orderBy(order, "station_id")
        pieces.append(
            known.withColumn("rank", F.row_number().over(ranked))
            .filter(F.col("rank") <= n)
            .withColumn("direction", F.lit(side))
        )
    return (
        pieces[0]
        .unionByName(pieces[1])
        .select(
            "holiday_date",
            "direction",
            F.col("rank").cast("bigint").alias("rank"),
            "station_id",
            "station_name",
            "area",
            "trips_pct_change",
            "trips_holiday",
            "trips_baseline",
            m.rebalancing_flag(F.col("trips_pct_change")).alias("rebalancing_flag"),
        )
    )


def comparison(summary: DataFrame) -> DataFrame:
    """The holidays side by side, with Yes/No flags."""
    return summary.select(
        "holiday_name",
        F.col("holiday_date").cast("string").alias("holiday_date"),
        m.yes_no(F.col("is_major")).alias("major_holiday"),
        m.yes_no(F.col("is_working_day")).alias("working_day"),
        "trips_pct_change",
        "duration_pct_change",
        "total_trips_holiday",
        "baseline_days_count",
    )


def significance(summary: DataFrame, cube: DataFrame) -> DataFrame:
    """One-sample t-test of each holiday against its baseline days, all in one job (K7).

    The sample is every weekday between the baseline's first and last day but the holiday
    itself; other holidays stay in.  The days are expanded per holiday and met by equality.
    """
    daily = roll_up(cube, "ride_date").select("ride_date", "trips")
    days = (
        summary.select("holiday_date", "holiday_name", "total_trips_holiday", "baseline_start_date", "baseline_end_date")
        .withColumn("ride_date", F.explode(F.sequence("baseline_start_date", "baseline_end_date")))
        .filter("ride_date <> holiday_date")
        .filter(~cal.is_weekend(F.col("ride_date")))
    )
    sample = (
        days.join(daily, "ride_date")
        .groupBy("holiday_date", "holiday_name", "total_trips_holiday")
        .agg(
            F.count(F.lit(1)).alias("sample_days"),
            F.avg("trips").alias("sample_mean"),
            F.stddev_samp("trips").alias("sample_std"),
        )
    )
    enough = F.col("sample_days") >= MIN_TEST_DAYS
    error = F.nullif(F.col("sample_std"), F.lit(0.0)) / F.sqrt("sample_days")
    t = F.when(enough, (F.col("sample_mean") - F.col("total_trips_holiday")) / error)
    return (
        sample.withColumn("t_stat", t)
        .withColumn("p_value", two_sided_p(F.col("t_stat"), F.col("sample_days") - 1))
        .select(
            "holiday_date",
            "holiday_name",
            "sample_days",
            "t_stat",
            "p_value",
            F.coalesce(F.col("p_value") < SIGNIFICANCE, F.lit(False)).alias("is_significant"),
            F.when(enough, "t_test").otherwise("insufficient_data").alias("test_type"),
        )
    )


def cluster_rollup(by_station: DataFrame, clusters: DataFrame, own: bool = False, ks: Sequence[str] = ()) -> DataFrame:
    """Holiday change per station cluster, with its commonest area.

    With ``own`` each holiday has clusters of its own, and ``ks`` names columns of ``clusters`` that tell several
    clusterings of one holiday apart.  Sums go through (holiday, cluster, area) first, so the commonest area is a maximum over
    a few rows; ties go to the first name, no area at all to ``Mixed``.
    """
    keys = ["station_id", "holiday_date"] if own else ["station_id"]
    joined = by_station.join(clusters.select(*keys, *ks, "cluster_id"), keys)
    cluster = ["holiday_date", *ks, "cluster_id"]
    per_area = joined.groupBy(*cluster, "area").agg(
        F.sum("trips_holiday").alias("trips_holiday"),
        F.coalesce(F.sum("trips_baseline"), F.lit(0.0)).alias("trips_baseline"),
        F.coalesce(F.sum("trips_abs_change"), F.lit(0.0)).alias("trips_abs_change"),
        F.sum("latitude").alias("lat"),
        F.sum("longitude").alias("lon"),
        F.count("latitude").alias("located"),
        F.count("station_id").alias("stations"),
    )
    rank = F.when(F.col("area").isNotNull(), F.struct(-F.col("stations"), F.col("area")))
    located = F.nullif(F.sum("located"), F.lit(0))
    return (
        per_area.groupBy(*cluster)
        .agg(
            F.sum("trips_holiday").alias("trips_holiday"),
            F.sum("trips_baseline").alias("trips_baseline"),
            F.sum("trips_abs_change").alias("trips_abs_change"),
            (F.sum("lat") / located).alias("latitude"),
            (F.sum("lon") / located).alias("longitude"),
            F.sum("stations").alias("station_count"),
            F.coalesce(F.min_by("area", rank), F.lit("Mixed")).alias("area"),
        )
        .withColumn("trips_pct_change", m.pct_change(F.col("trips_holiday"), F.col("trips_baseline")))
        .withColumn("rebalancing_flag", m.rebalancing_flag(F.col("trips_pct_change")))
    )
