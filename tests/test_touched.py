"""Refresh of touched months against a full build."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spokecast.operators import daily, holidays, net_flow, stations, trip_ends
from spokecast.plans import build, registered, touched
from spokecast.sources import driver_tables
from spokecast.sources.tables import Warehouse


def rows(df):
    names = sorted(set(df.columns) - {"geocoded_at"})  # the time of the build
    return sorted(map(str, registered.tidy(df).select(*names).collect()))


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    """The test tables with weeks for months."""
    week = F.floor(F.dayofmonth("started_at") / 7).cast("string")
    trips = driver_tables.raw_trips(spark, sf_dir).withColumn("source_month", F.concat(F.lit("w"), week))
    return {
        "bike_trips": trips.checkpoint(),
        "weather": driver_tables.raw_weather(spark, sf_dir),
        "holidays": driver_tables.raw_holidays(spark),
        "games": driver_tables.raw_games(spark, sf_dir),
    }


def test_cubes_give_what_trips_give(spark, raw):
    trips = build.staging.clean_trips(raw["bike_trips"])
    ends = trip_ends.trip_ends(trips, "source_month").checkpoint()
    places = stations.dim_stations(trips)
    labels = driver_tables.station_clusters_by_rule(places)
    for from_ends, from_trips in (
        (trip_ends.dim_stations(ends), places),
        (trip_ends.trips_daily(ends), daily.trips_daily(trips)),
        (trip_ends.start_cube(ends), holidays.start_cube(trips)),
        (trip_ends.station_stats(places, ends), stations.station_stats(places, trips)),
        (trip_ends.baseline_net_flow(ends, labels), net_flow.baseline_net_flow(trips, labels)),
    ):
        assert rows(from_ends) == rows(from_trips)


def all_equal(models, raw, root, spark):
    whole = build.refresh(Warehouse(spark, root), raw, stadiums=driver_tables.TEST_STADIUMS, k=4)
    for name, df in whole.items():
        if not name.startswith(("stg_", "int_")):
            assert rows(models[name]) == rows(df), name


def test_a_late_month_is_refreshed_like_a_full_build(spark, raw, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))

    def refresh(tables, months):
        return touched.refresh_touched(warehouse, tables, months, stadiums=driver_tables.TEST_STADIUMS, k=4)

    trips = raw["bike_trips"]
    late = trips.where("source_month = 'w3' and ride_id % 3 = 0")
    first = raw | {"bike_trips": trips.join(late.select("ride_id"), "ride_id", "left_anti").checkpoint()}
    all_equal(refresh(first, None), first, str(tmp_path / "a"), spark)

    scans, seen = [], []
    for module, name in ((touched.trip_ends, "trip_ends"), (touched.events, "leg_counts")):
        build_one = getattr(module, name)

        def spied(trips, *more, build_one=build_one, name=name):
            scans.append((name, trips._jdf.queryExecution().executedPlan().toString()))
            return build_one(trips, *more)

        monkeypatch.setattr(module, name, spied)
    affected = touched._affected

    def counted(feasts, days):
        seen.append((days.count(), affected(feasts, days).count()))
        return affected(feasts, days)

    monkeypatch.setattr(touched, "_affected", counted)
    models = refresh(raw, ["w3"])
    assert [n for n, _ in scans] == ["trip_ends", "leg_counts"]
    assert all("source_month" in text.split("PartitionFilters")[1].split("PushedFilters")[0] and "w3" in text for _, text in scans)
    assert 0 < seen[0][0] <= 7 and 0 < seen[0][1] <= 3
    all_equal(models, raw, str(tmp_path / "b"), spark)
    all_equal(refresh(raw, ["w3"]), raw, str(tmp_path / "c"), spark)  # nothing has changed
    assert seen[1] == (0, 0)
    gone = raw | {"bike_trips": trips.where("source_month <> 'w4'").checkpoint()}
    all_equal(refresh(gone, ["w4"]), gone, str(tmp_path / "d"), spark)  # a month without rows
    assert spark.read.parquet(warehouse.path("core", "int_trips")).where("source_month = 'w4'").count() == 0


def test_holiday_rows_of_other_dates_stay(spark, raw, tmp_path, monkeypatch):
    """With windows of two days a change reaches the holidays next to it only."""
    monkeypatch.setattr(holidays, "BASELINE_DAYS", 2)
    days = spark.createDataFrame([("2024-01-16",), ("2024-01-30",)], "d string").select(F.to_date("d").alias("ride_date"))
    feasts = spark.createDataFrame([("2024-01-15",), ("2024-01-26",), (None,)], "d string").select(F.to_date("d").alias("date"))
    assert [str(r[0]) for r in touched._affected(feasts, days).collect()] == ["2024-01-15"]
