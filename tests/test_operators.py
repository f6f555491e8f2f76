"""Edge cases on small hand-made frames."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spokecast.functions import calendar as cal
from spokecast.functions import measures as m
from spokecast.functions.student import two_sided_p
from spokecast.operators import (
    clusters,
    daily,
    events,
    factors,
    holidays,
    net_flow,
    proximity,
    ranking,
    staging,
    stations,
    statistics,
)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def ts(text):
    return dt.datetime.fromisoformat(text)


def column(df, name):
    return [r[name] for r in df.collect()]


TRIP = (
    "ride_id string, started_at timestamp_ntz, ended_at timestamp_ntz, start_station_id string, start_station_name string,"
    " start_lat double, start_lng double, end_station_id string, end_station_name string, member_casual string"
)


def trip(ride, start, end, a="A", b="B", rider="member", lat=40.7, lng=-74.0, name=None):
    return (ride, ts(start), end and ts(end), a, name or (a and f"Name {a}"), lat, lng, b, b and f"Name {b}", rider)


def trips(spark, *rows):
    return staging.clean_trips(frame(spark, list(rows), TRIP))


# Staging ---------------------------------------------------------------------------------


def test_trip_length_limits(spark):
    kept = trips(
        spark,
        trip("reversed", "2024-01-01 10:00:00", "2024-01-01 09:00:00"),
        trip("59s", "2024-01-01 10:00:00", "2024-01-01 10:00:59"),
        trip("60s", "2024-01-01 10:00:00", "2024-01-01 10:01:00"),
        trip("720m", "2024-01-01 10:00:00", "2024-01-01 22:00:00"),
        trip("720m1s", "2024-01-01 10:00:00", "2024-01-01 22:00:01"),
        trip("open", "2024-01-01 10:00:00", None),
    )
    assert {r.ride_id: r.ride_mins for r in kept.collect()} == {"60s": 1.0, "720m": 720.0}


def test_trip_length_counts_second_boundaries(spark):
    kept = trips(spark, trip("x", "2024-01-01 10:00:00.900000", "2024-01-01 10:01:00.100000"))
    assert column(kept, "ride_mins") == [1.0]


@pytest.mark.parametrize(
    ("high", "low", "kept"),
    [(3.5, 3.5, 1), (3.5, 3.4, 1), (3.5, 3.6, 0), (-8.0, -7.9, 0), (None, -40.0, 1), (0.0, None, 1), (None, None, 1)],
)
def test_partial_temperatures_are_kept(spark, high, low, kept):
    raw = frame(
        spark, [("2024-05-01", high, low, 0.0, 1.0)], "date string, tmax double, tmin double, precip double, wind_max double"
    )
    assert staging.clean_weather(raw).count() == kept


def test_hour_rounding_moves_the_date(spark):
    raw = frame(
        spark,
        [(1, "2024-05-01T18:29:59"), (2, "2024-05-01T18:30:00"), (3, "2024-05-01T23:45:00")],
        "game_id int, game_datetime string",
    ).selectExpr("*", "147 as home_team_id", "'Yankee Stadium II' as venue_name")
    rows = {r.game_id: r for r in staging.stage_games(raw).collect()}
    assert [rows[i].game_time for i in (1, 2, 3)] == ["18:00:00", "19:00:00", "00:00:00"]
    assert rows[3].game_date == dt.date(2024, 5, 2)
    assert rows[1].estimated_end_datetime == ts("2024-05-01 21:00:00")
    assert rows[1].stadium_name == "Yankee Stadium" and rows[1].is_yankees_home and not rows[1].is_mets_home


def test_games_in_a_local_zone(spark):
    raw = frame(spark, [(1, "2024-05-01T23:05:00")], "game_id int, game_datetime string").selectExpr(
        "*", "121 as home_team_id", "'Citi Field' as venue_name"
    )
    row = staging.stage_games(raw, tz="America/New_York").first()
    assert row.game_datetime_rounded == ts("2024-05-01 19:00:00")


def test_rule_holidays(spark):
    rules = staging.rule_holidays(frame(spark, [(2024,), (2025,)], "source_year int"))
    got = {(r.source_year, r.holiday_name): str(r.date) for r in rules.collect()}
    assert got == {
        (2024, staging.MARATHON): "2024-11-03",
        (2025, staging.MARATHON): "2025-11-02",
        (2024, staging.PARADE): "2024-06-09",
        (2025, staging.PARADE): "2025-06-08",
    }


def test_one_holiday_per_date(spark):
    raw = frame(
        spark,
        [
            ("2024-11-03", "Election Feast", "Public", 2024),
            ("2024-03-01", "B Day", "Local", 2024),
            ("2024-03-01", "A Day", "Local", 2024),
            ("2024-04-01", "No type", None, 2024),
        ],
        "date string, holiday_name string, holiday_types string, source_year int",
    )
    rows = {str(r.date): r for r in staging.stage_holidays(raw).collect()}
    assert rows["2024-11-03"].holiday_name == "Election Feast"  # beats the generated marathon
    assert rows["2024-03-01"].holiday_name == "A Day"
    assert rows["2024-11-03"].is_major and not rows["2024-11-03"].is_working_day
    assert not rows["2024-04-01"].is_major and rows["2024-04-01"].is_working_day
    assert len(rows) == 4  # the parade is generated


# Stations --------------------------------------------------------------------------------


def test_stations_from_both_ends(spark):
    data = trips(
        spark,
        trip("1", "2024-01-01 10:00:00", "2024-01-01 10:10:00", "A", "B"),
        trip("2", "2024-01-01 10:00:00", "2024-01-01 10:10:00", "A", None, name="Name A (moved)"),
        trip("3", "2024-01-01 10:00:00", "2024-01-01 10:10:00", "A", "C"),
        trip("4", "2024-01-01 10:00:00", "2024-01-01 10:10:00", "D", "C", lat=10.0),
    )
    rows = {r.station_id: r for r in stations.dim_stations(data).collect()}
    assert set(rows) == {"A", "B", "C", "D"}
    assert rows["A"].name_variations == 2 and rows["A"].station_name == "Name A"
    assert (rows["A"].latitude, rows["A"].area) == (40.7, "Manhattan - Financial")
    assert rows["B"].latitude is None and rows["B"].area == "Other"
    assert rows["D"].latitude is None  # outside the city box


def test_station_stats_distinct_rides_and_unused_stations(spark):
    data = trips(
        spark,
        trip("1", "2024-01-01 10:00:00", "2024-01-01 10:10:00", "A", "B"),
        trip("1", "2024-01-01 10:00:00", "2024-01-01 10:20:00", "A", "B"),
        trip("2", "2024-01-01 10:00:00", "2024-01-01 10:30:00", "A", "A", rider="casual"),
    )
    rows = {r.station_id: r for r in stations.station_stats(stations.dim_stations(data), data).collect()}
    a, b = rows["A"], rows["B"]
    assert (a.start_trip_count, a.end_trip_count, a.member_start_trips, a.casual_start_trips) == (2, 1, 1, 1)
    assert a.avg_start_duration == 20.0 and a.member_pct == 50.0
    assert (b.start_trip_count, b.end_trip_count, b.avg_start_duration, b.member_pct) == (0, 1, None, None)


def test_unique_rides_check(spark):
    df = frame(spark, [("1",), ("2",), (None,), (None,)], "ride_id string")
    assert stations.rides_are_unique(df) and not stations.rides_are_unique(df.union(df))


def test_station_stats_shortcut_on_unique_rides(spark, sf_dir):
    from spokecast.plans.registered import trips_of

    data = trips_of(spark, sf_dir)
    dim = stations.dim_stations(data)
    exact = stations.station_stats(dim, data)
    short = stations.station_stats(dim, data, ride_ids_unique=True)
    cols = [c for c in exact.columns if c != "avg_start_duration"]
    assert sorted(exact.select(cols).collect()) == sorted(short.select(cols).collect())


def test_bands_find_what_the_full_product_finds(spark):
    near = [(f"S{i}", f"S{i}", 40.6 + i * 0.004, -74.0 + (i % 7) * 0.01) for i in range(60)]
    places = frame(spark, near, "station_id string, station_name string, latitude double, longitude double")
    venues = spark.createDataFrame(proximity.STADIUMS, proximity.STADIUM_SCHEMA)
    for radius in (1.0, 4.0, 12.0):
        banded = proximity.nearby_pairs(venues, places, radius).select("stadium_id", "station_id")
        full = proximity.station_proximity(places).filter(F.col("distance_km") <= radius).select("stadium_id", "station_id")
        assert sorted(banded.collect()) == sorted(full.collect())


def test_walking_flag_is_inclusive(spark):
    places = frame(spark, [("x", "x", 40.8296, -73.9265)], "station_id string, station_name string, latitude double, longitude double")
    rows = {r.stadium_id: r for r in proximity.station_proximity(places).collect()}
    assert rows[1].distance_km == 0 and rows[1].within_1km and not rows[2].within_1km


# Daily and weather -----------------------------------------------------------------------


def test_weather_bins(spark):
    demand = frame(
        spark, [(dt.date(2024, 1, d), 1, 1.0, 1, 0, "x", "y") for d in range(1, 6)],
        "ride_date date, trips_total bigint, avg_duration_mins double, member_trips bigint, casual_trips bigint,"
        " day_of_week string, day_type string",
    )
    weather = frame(
        spark,
        [
            (dt.date(2024, 1, 1), 4.9, 4.9, None, 1.0),
            (dt.date(2024, 1, 2), 5.0, 5.0, 0.0, 1.0),
            (dt.date(2024, 1, 3), 25.0, 25.0, 10.0, 1.0),
            (dt.date(2024, 1, 4), None, 3.0, 10.1, 1.0),
        ],
        "date date, tmax double, tmin double, precip double, wind_max double",
    )
    rows = daily.weather_effect(demand, weather).orderBy("date").collect()
    assert [r.rain_category for r in rows] == ["No Rain", "No Rain", "Light Rain", "Heavy Rain", "No Rain"]
    assert [r.temp_category for r in rows] == ["Very Cold", "Cold", "Warm", "Warm", "Warm"]
    assert [r.is_rain for r in rows] == [0, 0, 1, 1, 0]


# Rules and labels ------------------------------------------------------------------------


def test_rebalancing_rules(spark):
    df = frame(spark, [(-3.0,), (-3.5,), (3.0,), (4.2,), (-4.5,)], "net double").select(
        m.station_move(F.col("net")).alias("move"),
        m.station_move_text(F.col("net")).alias("text"),
        m.forecast_move(F.col("net")).alias("f"),
        m.forecast_move_text(F.col("net")).alias("ft"),
        m.capacity_share(F.col("net")).alias("pct"),
    )
    rows = df.collect()
    assert [r.move for r in rows] == [0.0, 4.0, 0.0, -4.0, 5.0]
    assert [r.text for r in rows][:4] == ["No action needed", "Add 4.0 bikes", "No action needed", "Remove 4.0 bikes"]
    assert (rows[4].f, rows[4].ft) == (4, "Add 4 bikes")
    assert [r.pct for r in rows] == [0.0, 17.5, 0.0, -21.0, 22.5]


def test_holiday_flags(spark):
    df = frame(spark, [(30.0,), (30.1,), (-30.1,), (None,)], "p double").select(m.rebalancing_flag(F.col("p")).alias("f"))
    assert column(df, "f") == ["No action", "Add bikes", "Remove bikes", "No action"]


def test_impact_labels(spark):
    df = frame(spark, [(1.5,), (-20.0,), (0.0,), (None,)], "p double").select(m.impact_label(F.col("p")).alias("f"))
    assert column(df, "f") == ["+1.5% increase", "-20.0% decrease", "No impact", "No impact"]


def test_two_sided_p_against_tabulated_points(spark):
    five_percent = [(12.706, 1), (3.182, 3), (2.776, 4), (2.571, 5), (2.228, 10), (2.042, 30)]
    one_percent = [(63.657, 1), (9.925, 2), (3.169, 10)]
    df = frame(spark, five_percent + one_percent, "t double, df int").select(
        two_sided_p(F.col("t"), F.col("df")).alias("p")
    )
    got = column(df, "p")
    assert got[:6] == pytest.approx([0.05] * 6, abs=5e-5) and got[6:] == pytest.approx([0.01] * 3, abs=5e-5)


# Holidays --------------------------------------------------------------------------------

HOLIDAY = "date date, holiday_name string, is_major boolean, is_working_day boolean"
CUBE = "ride_date date, trips bigint, mins double, member_trips bigint, casual_trips bigint"


def cube(spark, days):
    return frame(spark, [(d, n, float(n), n, 0) for d, n in days], CUBE)


def test_insufficient_and_sufficient_significance(spark):
    day = dt.date(2024, 7, 4)
    feast = frame(spark, [(day, "Independence Day", True, False)], HOLIDAY)

    def outcome(days):
        c = cube(spark, [(day, 50), *[(dt.date(2024, 7, d), 100 + d) for d in days]])
        return holidays.significance(holidays.impact_summary(feast, c), c).first()

    few = outcome((1, 2, 3, 5))
    assert (few.test_type, few.p_value, few.is_significant) == ("insufficient_data", None, False)
    enough = outcome((1, 2, 3, 5, 8, 9))
    assert enough.test_type == "t_test" and enough.is_significant and 0 < enough.p_value < 0.01


def test_constant_sample_has_no_p_value(spark):
    day = dt.date(2024, 7, 4)
    feast = frame(spark, [(day, "Independence Day", True, False)], HOLIDAY)
    c = cube(spark, [(day, 50), *[(dt.date(2024, 7, d), 100) for d in (1, 2, 3, 5, 8, 9)]])
    row = holidays.significance(holidays.impact_summary(feast, c), c).first()
    assert row.p_value is None and not row.is_significant


def test_baseline_window_skips_weekends_and_other_holidays(spark):
    feast = frame(
        spark, [(dt.date(2024, 7, 4), "A", True, False), (dt.date(2024, 7, 8), "B", False, True)], HOLIDAY
    )
    days = {
        r.ride_date for r in holidays.holiday_calendar(feast).filter("holiday_name = 'A' and not on_holiday").collect()
    }
    assert dt.date(2024, 7, 8) not in days and dt.date(2024, 7, 6) not in days
    assert min(days) == dt.date(2024, 6, 19) and max(days) == dt.date(2024, 7, 19) and len(days) == 21


def test_peak_hour_ties_take_the_earlier_hour(spark):
    rows = [(dt.date(2024, 7, 4), "A", h, n, float(b)) for h, n, b in ((8, 5, 9), (9, 5, 9), (17, 4, 1))]
    mart = frame(spark, rows, "holiday_date date, holiday_name string, hour_of_day bigint, trips_holiday bigint, trips_baseline double")
    peak = holidays.peak_hours(mart).first()
    assert (peak.baseline_peak_hour, peak.holiday_peak_hour) == (8, 8)


def test_cluster_area_ties_and_mixed(spark):
    day = dt.date(2024, 7, 4)
    rows = [(day, s, a, 40.7, -74.0, 10, 5.0, 5.0) for s, a in (("1", "Queens"), ("2", "Bronx"), ("3", None))]
    rows.append((day, "4", None, 40.7, -74.0, 3, None, None))
    mart = frame(
        spark, rows,
        "holiday_date date, station_id string, area string, latitude double, longitude double, trips_holiday bigint,"
        " trips_baseline double, trips_abs_change double",
    )
    assigned = frame(spark, [("1", 0), ("2", 0), ("3", 0), ("4", 1)], "station_id string, cluster_id int")
    rows = {r.cluster_id: r for r in holidays.cluster_rollup(mart, assigned).collect()}
    assert rows[0].area == "Bronx" and rows[0].station_count == 3 and rows[0].rebalancing_flag == "Add bikes"
    assert rows[1].area == "Mixed" and rows[1].trips_pct_change is None


# Games -----------------------------------------------------------------------------------


def game_frame(spark, start="2024-01-03 19:00:00"):
    raw = frame(spark, [(1, ts(start), 147, "Yankee Stadium")], "game_id int, game_datetime timestamp_ntz, home_team_id int, venue_name string")
    return staging.stage_games(raw)


NEAR = "stadium_name string, station_id string, station_name string, within_1km boolean"
NO_HOLIDAYS = "date date, holiday_name string"


def test_round_trip_counts_once_in_both(spark):
    data = trips(
        spark,
        trip("loop", "2024-01-03 19:05:00", "2024-01-03 20:05:00", "A", "A"),
        trip("open end", "2024-01-03 19:05:00", "2024-01-03 20:05:00", "A", None),
        trip("arrives", "2024-01-03 19:05:00", "2024-01-03 20:05:00", None, "A"),
        trip("elsewhere", "2024-01-03 19:05:00", "2024-01-03 20:05:00", "X", "Y"),
    )
    near = frame(spark, [("Yankee Stadium", "A", "Name A", True)], NEAR)
    rows = events.game_day_demand(data, game_frame(spark), near, frame(spark, [], NO_HOLIDAYS)).collect()
    got = {r.interval_offset: (r.trips_started_game_day, r.trips_ended_game_day) for r in rows}
    assert got == {0: (2, 1), 2: (0, 1)}
    assert all(r.trips_started_baseline == 0 and r.trips_started_pct_change is None for r in rows)


def test_time_of_day_baseline_uses_other_weeks_only(spark):
    data = trips(
        spark,
        trip("game", "2024-01-03 19:05:00", "2024-01-03 19:20:00", "A", "B"),
        trip("week1", "2024-01-10 19:05:00", "2024-01-10 19:20:00", "A", "B"),
        trip("week2a", "2024-01-17 19:05:00", "2024-01-17 19:20:00", "A", "B"),
        trip("week2b", "2024-01-17 19:06:00", "2024-01-17 19:20:00", "A", "B"),
        trip("holiday", "2024-01-24 19:05:00", "2024-01-24 19:20:00", "A", "B"),
        trip("other day", "2024-01-11 19:05:00", "2024-01-11 19:20:00", "A", "B"),
    )
    near = frame(spark, [("Yankee Stadium", "A", "Name A", True)], NEAR)
    feast = frame(spark, [(dt.date(2024, 1, 24), "Feast")], NO_HOLIDAYS)
    row = events.game_day_demand(data, game_frame(spark), near, feast, "time_of_day").first()
    assert row.trips_started_baseline == 1.5 and round(row.trips_started_pct_change, 4) == -33.3333


# Net flow, factors, forecast -------------------------------------------------------------


def test_net_flow_with_only_arrivals(spark):
    data = trips(spark, trip("1", "2024-01-01 10:00:00", "2024-01-01 11:10:00", "A", "B"))
    assigned = frame(spark, [("A", 0), ("B", 1)], "station_id string, cluster_id int")
    rows = {r.cluster_id: r for r in net_flow.baseline_net_flow(data, assigned).collect()}
    assert (rows[1].trips_started, rows[1].trips_ended, rows[1].net_flow) == (0, 1, 1)
    assert (rows[0].day_name, rows[0].hour_label, rows[1].hour_label) == ("Monday", "10:00", "11:00")


def conditions(spark):
    return frame(
        spark, [(dt.date(2024, 1, d), 10 * d, 10.0, 0.0, 5.0, None) for d in (1, 2, 3)],
        "trip_date date, total_trips bigint, avg_temp double, total_precip double, avg_wind_speed double, holiday_types string",
    )


def test_factors_without_matching_days(spark):
    rows = {r.factor_name: r for r in factors.adjustment_factors(conditions(spark)).collect()}
    assert len(rows) == 17
    assert (rows["hot_weather"].impact_pct, rows["hot_weather"].impact_label) == (0.0, "No impact")
    assert (rows["sunday"].impact_pct, rows["sunday"].adjustment_multiplier, rows["sunday"].impact_label) == (
        None,
        None,
        "No impact",
    )
    assert rows["monday"].impact_pct == -50.0 and rows["monday"].adjustment_multiplier == 0.5


def test_forecast_choice_without_factor_counts_one(spark):
    found = factors.adjustment_factors(conditions(spark)).filter("factor_name <> 'cold_weather'")
    scenario = factors.scenario_factors(factors.all_scenarios(spark), found)
    picked = scenario.filter("day = 'Monday' and temperature like 'Cold%' and wind like 'Weak%' and rain = 'None' and holiday = 'None'")
    assert picked.first().combined_factor == 0.5
    assert scenario.count() == 504
    sunday = scenario.filter("day = 'Sunday'").first()
    assert sunday.combined_factor is None
    flow = frame(spark, [(0, 0, 7, "07:00", 90), (0, 1, 7, "07:00", 9)], "cluster_id int, day_of_week bigint, hour bigint, hour_label string, net_flow bigint")
    grid = factors.forecast(flow, scenario)
    assert grid.filter("day = 'Sunday'").first().recommendation == "No action needed"
    hour = factors.forecast_for(grid, 0, day="Monday", temperature="Cold (<15°C)", wind="Weak (≤15 km/h)", rain="None", holiday="None")
    assert hour.first().recommendation == "Remove 4 bikes"


# Places and nearby pairs -----------------------------------------------------------------


def test_places_are_those_of_one_sort(spark):
    rows = [(i, None if i % 7 == 0 else i * 37 % 11, f"k{i % 5}") for i in range(500)]
    df = frame(spark, rows, "i int, x int, k string").repartition(7)
    order = [F.col("k"), F.desc_nulls_last("x"), F.col("i")]
    want = sorted(rows, key=lambda r: (r[2], r[1] is None, -(r[1] or 0), r[0]))
    got = {r.i: r["rank"] for r in ranking.ranked(df, order).collect()}
    assert got == {r[0]: n + 1 for n, r in enumerate(want)}
    assert ranking.ranked(df.where("false"), order).count() == 0
    same = ranking.ranked(frame(spark, [(1,)] * 50, "x int"), [F.col("x")])
    assert sorted(r["rank"] for r in same.collect()) == list(range(1, 51))


def test_nearby_pairs_anywhere_on_earth(spark):
    import math
    import random

    rnd = random.Random(8)
    spots = [(0, 0), (89.97, 10), (-89.99, -170), (60, 179.99), (60, -179.99), (40.7, -74)]

    def around(n):
        return [(i, f"p{i}", max(-90.0, min(90.0, a + rnd.uniform(-0.2, 0.2))), (b + rnd.uniform(-0.4, 0.4) + 180) % 360 - 180) for i, (a, b) in enumerate(spots * n)]

    venues, places = around(8), around(60)
    for radius in (3.0, 15.0):
        def km(v, s):
            p, q = math.radians(v[2]), math.radians(s[2])
            a = math.sin((p - q) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(v[3] - s[3]) / 2) ** 2
            return 2 * 6371 * math.asin(math.sqrt(min(a, 1)))

        want = sorted((v[0], s[0]) for v in venues for s in places if km(v, s) <= radius)
        v = frame(spark, venues, "stadium_id int, stadium_name string, latitude double, longitude double")
        s = frame(spark, [*places, (-1, "nowhere", None, 1.0)], "station_id int, station_name string, latitude double, longitude double")
        assert sorted((r.stadium_id, r.station_id) for r in proximity.nearby_pairs(v, s, radius).collect()) == want != []


def test_candidate_pairs_follow_the_density_of_cells(spark):
    n = 60  # a city of one latitude band and many columns
    places = frame(spark, [(i, "s", 40.7, -74 + i * 0.02) for i in range(n)], "station_id int, station_name string, latitude double, longitude double")
    venues = places.toDF("stadium_id", "stadium_name", "latitude", "longitude")
    pairs = proximity.near_cells(venues, places, 1.7)
    assert pairs.count() <= 5 * n
    assert pairs.count() == pairs.select("stadium_id", "station_id").distinct().count()


# Statistics and clusters -----------------------------------------------------------------


def test_correlation_needs_two_rows(spark):
    effect = frame(spark, [(10, 1.0, None, 2.0), (20, None, None, 4.0)], "trips_total bigint, temp_avg double, precip double, wind_max double")
    row = statistics.correlations(effect).first()
    assert (row.temp_corr, row.precip_corr) == (0.0, 0.0) and row.wind_corr == pytest.approx(1.0)


def test_histogram_closes_the_last_bin(spark):
    rows = statistics.histogram(frame(spark, [(0,), (1,), (30,), (60,)], "x bigint"), "x").collect()
    assert {r.bin: r.days for r in rows} == {0: 2, 15: 1, 29: 1}


def test_approximate_quartiles_agree_on_small_input(spark):
    df = frame(spark, [(float(i),) for i in range(1, 101)] + [(1000.0,)], "x double")
    assert statistics.iqr_outliers(df, "x").count() == statistics.iqr_outliers(df, "x", approximate=True).count() == 1


def test_clusters_are_stable_and_nearest(spark):
    rows = [(f"S{i}", f"S{i}", 40.6 + (i % 8) * 0.02 + i * 1e-5, -74.0 + (i // 8) * 0.02) for i in range(64)]
    places = frame(spark, rows, "station_id string, station_name string, latitude double, longitude double")
    first = clusters.station_clusters(places, k=8, restarts=3).collect()
    again = clusters.station_clusters(places.repartition(7), k=8, restarts=3).collect()
    assert sorted(first) == sorted(again)
    centres = {r.cluster_id: (r.centroid_lat, r.centroid_lon) for r in first}
    assert len(centres) == 8 and len(first) == 64
    for r in first:
        squared = {c: (r.latitude - y) ** 2 + (r.longitude - x) ** 2 for c, (y, x) in centres.items()}
        assert squared[r.cluster_id] <= min(squared.values()) + 1e-12
    assert all(0 <= r.distance_from_centroid_km < 10 for r in first)


STATIONS = "day string, station_id string, station_name string, latitude double, longitude double"


def squares(day, n, step):
    return [(day, f"{day}{i}", "x", 40.5 + (i * 37 % 101) * step, -74.0 + (i * 53 % 89) * step) for i in range(n)]


def test_fits_of_groups_are_those_of_each_group_alone(spark, monkeypatch):
    rows = squares("a", 60, 0.002) + squares("b", 25, 0.01) + [(None, "z", "x", 40.6, -74.0), ("b", "nowhere", "x", None, -74.0)]
    places = frame(spark, rows, STATIONS)

    def found(**more):
        made = clusters.grouped_clusters(places, ("day",), (4, 9), restarts=3, **more)
        return sorted(map(repr, made.collect()))

    together = found()
    alone = []
    for day in ("a", "b", None):
        own = places.filter(F.col("day").eqNullSafe(day))
        for k in (4, 9):
            alone += clusters.station_clusters(own, k=k, restarts=3).select(
                F.lit(day).cast("string").alias("day"), F.lit(k).alias("k"), "*"
            ).collect()
    assert together == sorted(map(repr, alone)) and len(together) == 2 * 86
    monkeypatch.setattr(clusters, "CENTRES_AT_ONCE", 1)
    assert found() == together


def test_steps_read_places_and_send_a_row_for_each_centre(spark, monkeypatch):
    read, sent, over = [], [], clusters._over

    def watched(places, fits, work, schema):
        found, shared = over(places, fits, work, schema)
        read.append(places.count())
        sent.append((found.count(), places.rdd.getNumPartitions() * sum(len(c) for _, c in fits)))
        return found, shared

    monkeypatch.setattr(clusters, "_over", watched)
    monkeypatch.setattr(clusters, "CELLS", 64)
    rows = [("a", str(i), f"s{i}", 40 + i % 7 / 100, -74 + i % 11 / 100) for i in range(700)]
    made = clusters.station_clusters(frame(spark, rows, STATIONS), k=4, restarts=2).collect()
    assert len(made) == 700 and set(read) == {77} and all(n <= most for n, most in sent)


def test_sums_of_a_step_are_exact():
    rnd = random.Random(3)
    places = [(1, rnd.randrange(10**9), rnd.randrange(10**9), rnd.randrange(1, 10**6)) for _ in range(500)]
    centres = [[(0, 0)], [(5, 5), (5, 5), (10**9, 10**9)]]
    first, flat = np.array([0, 1, 4]), np.array([c for f in centres for c in f]).T
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*places, strict=True)], names=["g", "x", "y", "n"])
    got = clusters._sums(clusters._blocks([batch], {1: ([0, 1], first, flat)})).to_pylist()
    want = {}
    for _, x, y, n in places:
        for f, own in enumerate(centres):
            d, i = min(((x - a) ** 2 + (y - b) ** 2, i) for i, (a, b) in enumerate(own))
            want[f, i] = [a + b for a, b in zip(want.get((f, i), [0] * 4), (n, n * x, n * y, n * d), strict=True)]
    assert {(r["f"], r["i"]): [r["n"], r["x"], r["y"], (r["upper"] << 32) + r["lower"]] for r in got} == want
    far = clusters._far(clusters._blocks([batch], {1: ([0, 1], first, flat)})).to_pylist()
    assert [(r["d"], r["x"], r["y"]) for r in far] == [max((min((x - a) ** 2 + (y - b) ** 2 for a, b in own), x, y) for _, x, y, _ in places) for own in centres]
    with pytest.raises(OverflowError):
        clusters._sums(clusters._blocks([batch], {1: ([0], np.array([0, 1]), np.array([[-(10**10)], [0]]))}))


def test_fewer_places_than_clusters(spark):
    rows = [("d", f"s{i}", "x", 40.6 + i % 3, -74.0) for i in range(9)]
    made = clusters.station_clusters(frame(spark, rows, STATIONS), k=5, restarts=2).collect()
    assert len(made) == 9 and len({r.cluster_id for r in made}) == 3
    assert all(r.distance_from_centroid_km == pytest.approx(0, abs=1e-6) for r in made)
    assert clusters.station_clusters(frame(spark, [], STATIONS), k=5).count() == 0


def test_a_fit_costs_no_more_than_its_starts(spark):
    rows = squares("a", 120, 0.002)
    made = clusters.station_clusters(frame(spark, rows, STATIONS), k=6, restarts=1).collect()
    cost = sum((r.latitude - r.centroid_lat) ** 2 + (r.longitude - r.centroid_lon) ** 2 for r in made)
    members = {}
    for r in made:
        members.setdefault(r.cluster_id, []).append((r.latitude, r.longitude, r.centroid_lat, r.centroid_lon))
    for points in members.values():
        assert sum(p[0] for p in points) / len(points) == pytest.approx(points[0][2], abs=2e-6)
        assert sum(p[1] for p in points) / len(points) == pytest.approx(points[0][3], abs=2e-6)
    import hashlib

    first = min(rows, key=lambda r: hashlib.md5(f"{r[1]}|42".encode()).hexdigest())
    centres = [first[3:]]
    far = lambda p: min((p[0] - a) ** 2 + (p[1] - b) ** 2 for a, b in centres)
    for _ in range(5):
        centres.append(max((r[3:] for r in rows), key=far))
    assert cost < sum(far(r[3:]) for r in rows)


def test_a_fit_cut_short_warns(spark):
    with pytest.warns(UserWarning, match="did not converge"):
        clusters.station_clusters(frame(spark, squares("a", 80, 0.003), STATIONS), k=7, restarts=1, max_iterations=1)


def test_members_come_nearest_first(spark):
    made = clusters.station_clusters(frame(spark, squares("a", 40, 0.002), STATIONS), k=3, restarts=1)
    found = [r.distance_from_centroid_km for r in clusters.cluster_members(made, 1).collect()]
    assert found == sorted(found) and len(found) > 3


def test_more_restarts_never_cost_more(spark):
    rows = [(f"S{i}", f"S{i}", 40.6 + (i * 37 % 101) * 0.002, -74.0 + (i * 53 % 89) * 0.002) for i in range(120)]
    places = frame(spark, rows, "station_id string, station_name string, latitude double, longitude double")

    def cost(restarts):
        found = clusters.station_clusters(places, k=6, restarts=restarts).collect()
        return sum((r.latitude - r.centroid_lat) ** 2 + (r.longitude - r.centroid_lon) ** 2 for r in found)

    assert cost(4) <= cost(1) + 1e-12


def test_half_hours_round_away_from_the_start(spark):
    start = "2024-01-01 19:00:00"
    cases = {
        "2024-01-01 18:45:00": -1,
        "2024-01-01 18:45:00.000001": 0,
        "2024-01-01 18:44:59.999999": -1,
        "2024-01-01 18:15:00": -2,
        "2024-01-01 19:00:00": 0,
        "2024-01-01 19:14:59.999999": 0,
        "2024-01-01 19:15:00": 1,
        "2024-01-01 20:45:00": 4,
    }
    df = frame(spark, [(ts(t), ts(start)) for t in cases], "t timestamp_ntz, s timestamp_ntz")
    assert column(df.select(cal.interval_offset(F.col("t"), F.col("s"), 1800).alias("x")), "x") == list(cases.values())


def test_games_starting_together_share_counts(spark):
    raw = frame(
        spark,
        [(1, ts("2024-01-03 19:00:00"), 147, "Yankee Stadium"), (2, ts("2024-01-03 19:10:00"), 121, "Citi Field")],
        "game_id int, game_datetime timestamp_ntz, home_team_id int, venue_name string",
    )
    data = trips(spark, trip("1", "2024-01-03 19:05:00", "2024-01-03 20:05:00", "A", "B"))
    near = frame(spark, [("Yankee Stadium", "A", "Name A", True), ("Citi Field", "B", "Name B", True)], NEAR)
    rows = events.game_day_demand(data, staging.stage_games(raw), near, frame(spark, [], NO_HOLIDAYS)).collect()
    assert sorted((r.game_id, r.station_id, r.trips_started_game_day, r.trips_ended_game_day) for r in rows) == [
        (1, "A", 1, 0),
        (2, "B", 0, 1),
    ]
