"""Plan shapes that matter at scale, and the whole warehouse build."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import LLM_QUERIES, queries
from spokecast.operators import events, holidays, quality, stations
from spokecast.plans import build, registered
from spokecast.plans.presentation import ORDER, shown
from spokecast.sources import driver_tables, periods, trip_files
from spokecast.sources.tables import Warehouse

QUERIES = {k: v for k, v in queries().items() if k not in LLM_QUERIES}
CLUSTERED = {"station_clusters", "station_clusters_check", "customer_clusters", "holiday_station_clusters", "holiday_cluster_rollup", "order_clusters"}
STORED = {"dq_monitor", "csv_ingest", "warehouse_roundtrip"} | CLUSTERED


def jobs(spark, run):
    """What ``run`` returns, and how many jobs it started."""
    group = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_take_as_many_jobs_for_many_files_as_for_few(spark, tmp_path):
    few, many = tmp_path / "few", tmp_path / "many"
    for folder, n in ((few, 120), (many, 200)):
        folder.mkdir()
        for i in range(n):
            names = ["ride_id", "started_at", "ended_at"]
            head = names if i % 3 else names[::-1]
            cells = {"ride_id": f"r{i}", "started_at": "2024-01-01 00:00:00", "ended_at": "2024-01-01 00:10:00"}
            blank = "\n" if i % 2 else ""
            (folder / f"{i:03} trips.csv").write_text(blank + ",".join(head) + "\n" + ",".join(cells[c] for c in head) + "\n")
        (folder / "empty.csv").write_text("")
    counts = []
    for folder, n in ((few, 120), (many, 200)):
        df, made = jobs(spark, lambda folder=folder: trip_files.read_trips(spark, str(folder), "202401"))
        rows = df.collect()
        assert {r.ride_id for r in rows} == {f"r{i}" for i in range(n)} and {r.ride_mins for r in rows} == {10.0}
        counts.append(made)
    assert counts[0] == counts[1]


def test_a_period_reads_its_months_only(spark, sf_dir):
    df = QUERIES["partition_calendar"](spark, sf_dir)
    assert "dynamicpruning" in plan(df).lower()
    months = {r.source_month for r in df.collect()}
    whole = spark.read.schema("o_orderkey bigint, source_month string").parquet(df.inputFiles()[0].split("/source_month=")[0])
    kept = periods.in_period(whole, periods.month_calendar(spark, "1994-01-31", "1996-02-15"))
    of_period = [f for f in whole.inputFiles() if any(f"source_month={m}/" in f for m in months)]
    assert scanned_files(kept) == len(of_period) < len(whole.inputFiles())


def scanned_files(df):
    """Files that the scans of an executed plan have read, by their metric."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if "QueryStageExec" in node.getClass().getSimpleName():
            todo.append(node.plan())
            continue
        metric = node.metrics().get("numFiles")
        if metric.isDefined():
            found += metric.get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_no_cross_or_nested_loop_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_first_per_key_is_cut_before_the_shuffle(spark, sf_dir):
    for name in ("holidays_dedup", "merge_upsert", "holiday_top_bottom"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert text.count("WindowGroupLimit") >= 2, name


@pytest.mark.parametrize(
    "name", ["trips_daily", "holiday_impact_by_hour", "net_flow_baseline", "dq_unique_combination"]
)
def test_wide_aggregates_hash(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "partial_" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_trips_are_never_sorted_for_the_station_dimension(spark, sf_dir):
    """The aggregate over single trips is a hash aggregate, also when callers drop columns."""
    trips = registered.trips_of(spark, sf_dir)
    for df in (stations.dim_stations(trips), stations.dim_stations(trips).select("station_id", "station_name")):
        lines = plan(df).splitlines()
        explode = next(i for i, line in enumerate(lines) if "Generate explode" in line)
        nearest = [line for line in lines[:explode] if "Aggregate(" in line][-1]
        assert "HashAggregate" in nearest


def test_scans_read_needed_columns_only(spark, sf_dir):
    text = plan(QUERIES["holiday_impact_summary"](spark, sf_dir))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and all("props" not in line for line in scans)


def test_trip_filters_reach_the_scan(spark, tmp_path, sf_dir):
    from spokecast.operators import staging

    path = str(tmp_path / "raw")
    driver_tables.raw_trips(spark, sf_dir).write.parquet(path)
    text = plan(staging.clean_trips(spark.read.parquet(path)).select("ride_mins"))
    assert "IsNotNull(started_at)" in text and "IsNotNull(ended_at)" in text and "start_station_id" not in text


def test_large_sides_are_not_broadcast_without_a_size_check(spark, sf_dir):
    """With broadcasts by size switched off, only the bounded slot table keeps its hint."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("holiday_impact_by_station", "net_flow_baseline", "station_stats", "event_window_demand"):
            assert "BroadcastHashJoin" not in plan(QUERIES[name](spark, sf_dir)), name
        assert plan(QUERIES["event_baseline_fixed"](spark, sf_dir)).count("BroadcastHashJoin") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_results_hold_without_broadcasts(spark, sf_dir):
    def rows(name):
        return sorted(map(str, QUERIES[name](spark, sf_dir).collect()))

    names = ("holiday_impact_by_area", "event_baseline_fixed", "adjustment_factors", "station_stats")
    usual = {n: rows(n) for n in names}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {n: rows(n) for n in names} == usual
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_full_refresh_and_quality_run(spark, sf_dir, tmp_path):
    raw = {
        "bike_trips": trip_files.add_ride_mins(driver_tables.raw_trips(spark, sf_dir)),
        "weather": driver_tables.raw_weather(spark, sf_dir),
        "holidays": driver_tables.raw_holidays(spark),
        "games": driver_tables.raw_games(spark, sf_dir),
    }
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    models = build.refresh(warehouse, raw, stadiums=driver_tables.TEST_STADIUMS, k=5)
    assert len(models) == 4 + 6 + 11
    changes = [r.trips_pct_change for r in shown("mart_holiday_impact_by_area", models["mart_holiday_impact_by_area"]).filter(
        "holiday_date = '2024-01-15'").collect()]
    assert changes == sorted(changes, reverse=True)
    assert set(ORDER) <= set(models)
    assert all(models[n].count() > 0 for n in models if n != "mart_game_rebalancing")

    def same(model, query):
        got = registered.tidy(models[model])
        return sorted(map(str, got.collect())) == sorted(map(str, QUERIES[query](spark, sf_dir).collect()))

    for model, query in (
        ("mart_demand_daily", "demand_daily"),
        ("mart_weather_effect", "weather_effect"),
        ("mart_station_stats", "station_stats"),
        ("mart_holiday_impact_summary", "holiday_impact_summary"),
        ("mart_holiday_impact_by_hour", "holiday_impact_by_hour"),
        ("mart_holiday_impact_by_station", "holiday_impact_by_station"),
        ("mart_holiday_impact_by_area", "holiday_impact_by_area"),
        ("mart_adjustment_factors", "adjustment_factors"),
    ):
        assert same(model, query), model
    assert spark.sql("select count(*) from mart_demand_daily").first()[0] == models["mart_demand_daily"].count()

    records = build.check_quality(raw, models, str(tmp_path / "dq"), k=5)
    assert records.count() == 5
    assert quality.run_kpis(records).first().total_tests == 5


@pytest.mark.parametrize("baseline", ["same_window", "time_of_day"])
def test_games_take_one_scan_of_trips(spark, sf_dir, tmp_path, baseline):
    trips, near = str(tmp_path / "trips"), str(tmp_path / "near")
    registered.trips_of(spark, sf_dir).write.parquet(trips)
    registered.near_of(registered.stations_of(spark, sf_dir)).write.parquet(near)
    demand = events.game_day_demand(
        spark.read.parquet(trips), registered.games_of(spark, sf_dir), spark.read.parquet(near), registered.holidays_of(spark), baseline
    )
    rows = demand.collect()
    assert rows == [] or len(rows) > 50
    text = plan(demand).split("== Initial Plan ==")[0]
    assert sum("FileScan" in line and "started_at" in line for line in text.splitlines()) == 1
    lines = text.splitlines()
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    counted = max(i for i, line in enumerate(lines) if "HashAggregate(keys=[ride_date" in line and "partial_sum" in line)
    assert counted < semi  # stations far from every venue go before anything is counted


def test_one_cube_serves_all_holiday_marts(spark, sf_dir):
    trips = registered.trips_of(spark, sf_dir)
    feasts = registered.holidays_of(spark)
    whole = holidays.start_cube(trips)
    direct = holidays.start_cube(trips, "ride_date")
    a = registered.tidy(holidays.impact_summary(feasts, whole)).collect()
    b = registered.tidy(holidays.impact_summary(feasts, direct)).collect()
    assert sorted(a) == sorted(b)
