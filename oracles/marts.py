"""SQL for staging, core tables and marts."""

from __future__ import annotations

from oracles.inputs import cte, query, r, rs, rules, staged_games, staged_holidays

SQL: dict[str, str] = {}

SQL["trips_clean"] = query("SELECT * FROM trips", "trips")
SQL["weather_clean"] = query("SELECT * FROM weather", "weather")
SQL["holidays_dedup"] = query(
    f"""SELECT date, holiday_name, country_code, counties, holiday_types, is_major, is_working_day, source_year
    FROM ({staged_holidays('order_holidays')})""",
    "order_holidays",
)
SQL["holiday_rules"] = query(
    f"SELECT date, holiday_name, holiday_types, source_year FROM ({rules('order_holidays')})", "order_holidays"
)
SQL["games_staged"] = query(staged_games("order_games"), "order_games")

DAILY = f"""ride_date, member_casual, trips, {rs('avg_duration_mins', 'min_duration_mins', 'max_duration_mins')},
    unique_start_stations, unique_end_stations"""
SQL["trips_daily"] = query(f"SELECT {DAILY} FROM daily", "daily")
SQL["stations_dim"] = query(
    f"SELECT station_id, station_name, name_variations, {rs('latitude', 'longitude')}, area FROM stations", "stations"
)
SQL["station_proximity"] = query(
    f"""SELECT stadium_id, stadium_name, station_id, station_name, {r('distance_km')},
    distance_km <= 1 AS within_1km FROM distances""",
    "distances",
)
SQL["nearby_stations"] = query(
    f"""SELECT stadium_name, station_name, {rs('latitude', 'longitude')}, round(distance_km, 3) AS distance_km
    FROM distances WHERE distance_km <= 9""",
    "distances",
)
SQL["nearby_pairs_banded"] = query(
    f"""SELECT stadium_id, stadium_name, station_id, station_name, {r('distance_km')}
    FROM distances WHERE distance_km <= 9""",
    "distances",
)
SQL["station_clusters_check"] = query(
    """SELECT count(*) AS stations, least(count(*), 12) AS clusters, cast(0 AS bigint) AS misplaced
    FROM stations WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "stations",
)

DEMAND = f"""trips_total, {r('avg_duration_mins')}, member_trips, casual_trips"""
SQL["demand_daily"] = query(
    f"""SELECT ride_date, {DEMAND}, total_start_stations, total_end_stations, day_of_week, day_of_week_num, day_type
    FROM demand""",
    "demand",
)
SQL["weather_effect"] = query(
    f"""SELECT date, {DEMAND}, day_of_week, day_type, {rs('tmax', 'tmin', 'temp_avg', 'precip', 'wind_max')},
    is_rain, rain_category, temp_category FROM effect""",
    "effect",
)
SQL["weather_rainy_days"] = query(
    f"SELECT date, trips_total, {r('precip')}, rain_category FROM effect WHERE is_rain = 1", "effect"
)
cte(
    "stats",
    """
    SELECT s.station_id, s.station_name,
        (SELECT count(DISTINCT ride_id) FROM trips WHERE start_station_id = s.station_id) AS start_trip_count,
        (SELECT count(DISTINCT ride_id) FROM trips WHERE end_station_id = s.station_id) AS end_trip_count,
        (SELECT avg(ride_mins) FROM trips WHERE start_station_id = s.station_id) AS avg_start_duration,
        (SELECT count(DISTINCT ride_id) FROM trips
            WHERE start_station_id = s.station_id AND member_casual = 'member') AS member_start_trips,
        (SELECT count(DISTINCT ride_id) FROM trips
            WHERE start_station_id = s.station_id AND member_casual = 'casual') AS casual_start_trips
    FROM stations s""",
    "stations",
    "trips",
)
SQL["station_stats"] = query(
    f"""SELECT station_id, station_name, start_trip_count, end_trip_count,
    start_trip_count + end_trip_count AS total_trip_count, {r('avg_start_duration')}, member_start_trips, casual_start_trips,
    round(100e0 * member_start_trips / nullif(start_trip_count, 0), 2) AS member_pct FROM stats""",
    "stats",
)
SQL["top_stations"] = query(
    "SELECT station_name, start_trip_count AS trip_count FROM stats ORDER BY start_trip_count DESC, station_id LIMIT 10",
    "stats",
)
SQL["home_kpis"] = query(
    f"""SELECT cast(sum(trips_total) AS bigint) AS total_trips, {r('avg(trips_total)', 'avg_daily_trips')},
    {r('avg(avg_duration_mins)', 'avg_duration')}, {r('100e0 * sum(member_trips) / sum(trips_total)', 'member_pct')},
    cast(sum(member_trips) AS bigint) AS member_trips, cast(sum(casual_trips) AS bigint) AS casual_trips FROM demand""",
    "demand",
)
SQL["trips_by_day_type"] = query(
    f"""SELECT day_type, cast(sum(trips_total) AS bigint) AS trips_total, {r('avg(trips_total)', 'avg_trips')},
    {r('stddev_samp(trips_total)', 'std_trips')} FROM demand GROUP BY day_type""",
    "demand",
)

# Holiday marts: the range join over single trips, as a user would first write it.
cte(
    "base_trips",
    """
    SELECT h.date AS holiday_date, t.*, cast(hour(t.started_at) AS bigint) AS hour_of_day
    FROM holidays h JOIN trips t ON abs(datediff('day', h.date, t.ride_date)) <= 15
    WHERE isodow(t.ride_date) <= 5 AND NOT EXISTS (SELECT 1 FROM holidays x WHERE x.date = t.ride_date)""",
    "holidays",
    "trips",
)
cte(
    "feast_trips",
    """
    SELECT h.date AS holiday_date, h.holiday_name, h.is_major, h.is_working_day, t.*,
        cast(hour(t.started_at) AS bigint) AS hour_of_day
    FROM holidays h JOIN trips t ON t.ride_date = h.date""",
    "holidays",
    "trips",
)
HOLIDAY = "holiday_date, holiday_name, is_major, is_working_day"


def versus(on: str, off: str, out: str) -> str:
    return f"{r(f'{on} - {off}', out + '_abs_change')}, {r(f'({on} - {off}) / nullif({off}, 0) * 100', out + '_pct_change')}"


cte(
    "summary",
    f"""
    SELECT * FROM (
        SELECT {HOLIDAY}, count(*) AS total_trips_holiday, avg(ride_mins) AS avg_duration_holiday,
            count(*) FILTER (member_casual = 'member') AS member_trips_holiday,
            count(*) FILTER (member_casual = 'casual') AS casual_trips_holiday
        FROM feast_trips GROUP BY ALL)
    JOIN (
        SELECT holiday_date, count(*) / count(DISTINCT ride_date) AS total_trips_baseline,
            avg(ride_mins) AS avg_duration_baseline,
            count(*) FILTER (member_casual = 'member') / count(DISTINCT ride_date) AS member_trips_baseline,
            count(*) FILTER (member_casual = 'casual') / count(DISTINCT ride_date) AS casual_trips_baseline,
            min(ride_date) AS baseline_start_date, max(ride_date) AS baseline_end_date,
            count(DISTINCT ride_date) AS baseline_days_count
        FROM base_trips GROUP BY holiday_date) USING (holiday_date)""",
    "feast_trips",
    "base_trips",
)
SQL["holiday_impact_summary"] = query(
    f"""SELECT {HOLIDAY}, total_trips_holiday, {r('total_trips_baseline')},
    {versus('total_trips_holiday', 'total_trips_baseline', 'trips')},
    {rs('avg_duration_holiday', 'avg_duration_baseline')},
    {versus('avg_duration_holiday', 'avg_duration_baseline', 'duration')},
    member_trips_holiday, {r('member_trips_baseline')},
    {versus('member_trips_holiday', 'member_trips_baseline', 'member_trips')},
    casual_trips_holiday, {r('casual_trips_baseline')},
    {versus('casual_trips_holiday', 'casual_trips_baseline', 'casual_trips')},
    baseline_start_date, baseline_end_date, baseline_days_count FROM summary""",
    "summary",
)
SQL["holiday_comparison"] = query(
    f"""SELECT holiday_name, cast(holiday_date AS varchar) AS holiday_date, if(is_major, 'Yes', 'No') AS major_holiday,
    if(is_working_day, 'Yes', 'No') AS working_day,
    {r('(total_trips_holiday - total_trips_baseline) / nullif(total_trips_baseline, 0) * 100', 'trips_pct_change')},
    {r('(avg_duration_holiday - avg_duration_baseline) / nullif(avg_duration_baseline, 0) * 100', 'duration_pct_change')},
    total_trips_holiday, baseline_days_count FROM summary""",
    "summary",
)
cte(
    "by_hour",
    f"""
    SELECT * FROM (SELECT {HOLIDAY}, hour_of_day, count(*) AS trips_holiday FROM feast_trips GROUP BY ALL)
    JOIN (SELECT holiday_date, hour_of_day, count(*) / count(DISTINCT ride_date) AS trips_baseline
        FROM base_trips GROUP BY ALL) USING (holiday_date, hour_of_day)""",
    "feast_trips",
    "base_trips",
)
CHANGE = f"trips_holiday, {r('trips_baseline')}, {versus('trips_holiday', 'trips_baseline', 'trips')}"
SQL["holiday_impact_by_hour"] = query(f"SELECT {HOLIDAY}, hour_of_day, {CHANGE} FROM by_hour", "by_hour")
SQL["holiday_peak_hours"] = query(
    f"""SELECT holiday_date, holiday_name,
    (list(hour_of_day ORDER BY trips_baseline DESC, hour_of_day))[1] AS baseline_peak_hour,
    {r('max(trips_baseline)', 'baseline_peak_trips')},
    (list(hour_of_day ORDER BY trips_holiday DESC, hour_of_day))[1] AS holiday_peak_hour,
    max(trips_holiday) AS holiday_peak_trips FROM by_hour GROUP BY ALL""",
    "by_hour",
)
cte(
    "by_station",
    f"""
    SELECT f.*, b.trips_baseline, s.station_name, s.area, s.latitude, s.longitude
    FROM (SELECT {HOLIDAY}, start_station_id AS station_id, count(*) AS trips_holiday
        FROM feast_trips WHERE start_station_id IS NOT NULL GROUP BY ALL) f
    LEFT JOIN (SELECT holiday_date, start_station_id AS station_id, count(*) / count(DISTINCT ride_date) AS trips_baseline
        FROM base_trips GROUP BY ALL) b USING (holiday_date, station_id)
    LEFT JOIN stations s USING (station_id)""",
    "feast_trips",
    "base_trips",
    "stations",
)
STATION = f"{HOLIDAY}, station_id, station_name, area, {rs('latitude', 'longitude')}, {CHANGE}"
SQL["holiday_impact_by_station"] = query(f"SELECT {STATION} FROM by_station", "by_station")
SQL["holiday_station_slice"] = query(
    f"SELECT {STATION} FROM by_station WHERE holiday_date = DATE '2024-01-15'", "by_station"
)
SQL["holiday_impact_by_area"] = query(
    f"""SELECT {HOLIDAY}, area_name, station_count, {CHANGE},
    {r('trips_holiday / station_count', 'avg_station_trips_holiday')},
    {r('trips_baseline / station_count', 'avg_station_trips_baseline')}
    FROM (SELECT {HOLIDAY}, area AS area_name, count(DISTINCT start_station_id) AS station_count, count(*) AS trips_holiday
        FROM feast_trips JOIN stations ON station_id = start_station_id GROUP BY ALL)
    JOIN (SELECT holiday_date, area AS area_name, count(*) / count(DISTINCT ride_date) AS trips_baseline
        FROM base_trips JOIN stations ON station_id = start_station_id GROUP BY ALL) USING (holiday_date, area_name)""",
    "feast_trips",
    "base_trips",
    "stations",
)
PCT = "(trips_holiday - trips_baseline) / nullif(trips_baseline, 0) * 100"
FLAG = "CASE WHEN pct > 30 THEN 'Add bikes' WHEN pct < -30 THEN 'Remove bikes' ELSE 'No action' END AS rebalancing_flag"
SQL["holiday_top_bottom"] = query(
    f"""SELECT holiday_date, direction, rank, station_id, station_name, area, {r('pct', 'trips_pct_change')}, trips_holiday,
    {r('trips_baseline')}, {FLAG} FROM (
        SELECT *, 'increase' AS direction, row_number() OVER (PARTITION BY holiday_date ORDER BY pct DESC, station_id) AS rank
        FROM (SELECT *, {PCT} AS pct FROM by_station) WHERE pct IS NOT NULL
        UNION ALL
        SELECT *, 'decrease', row_number() OVER (PARTITION BY holiday_date ORDER BY pct, station_id)
        FROM (SELECT *, {PCT} AS pct FROM by_station) WHERE pct IS NOT NULL)
    WHERE rank <= 10""",
    "by_station",
)
cte("clustered", "SELECT *, cast(substr(station_id, 2) AS integer) % 5 AS cluster_id FROM by_station", "by_station")
SQL["cluster_holiday_rollup"] = query(
    f"""SELECT holiday_date, cluster_id, trips_holiday, {rs('trips_baseline', 'trips_abs_change', 'latitude', 'longitude')},
    station_count, area, {r('pct', 'trips_pct_change')}, {FLAG}
    FROM (SELECT *, (trips_holiday - trips_baseline) / nullif(trips_baseline, 0) * 100 AS pct FROM (
        SELECT holiday_date, cluster_id, cast(sum(trips_holiday) AS bigint) AS trips_holiday,
            coalesce(sum(trips_baseline), 0) AS trips_baseline,
            coalesce(sum(trips_holiday - trips_baseline), 0) AS trips_abs_change, avg(latitude) AS latitude,
            avg(longitude) AS longitude, count(*) AS station_count FROM clustered GROUP BY ALL))
    JOIN (SELECT holiday_date, cluster_id, (list(area ORDER BY n DESC, area))[1] AS area
        FROM (SELECT holiday_date, cluster_id, area, count(*) AS n FROM clustered GROUP BY ALL) GROUP BY ALL)
        USING (holiday_date, cluster_id)""",
    "clustered",
)

# Game marts: the OR-join over both stations and the weekday baseline, in the direct form.
cte("near", "SELECT stadium_name, station_id, station_name FROM distances WHERE distance_km <= 9", "distances")
OFFSET = (
    "cast(round((epoch(CASE WHEN t.start_station_id = n.station_id THEN t.started_at ELSE t.ended_at END)"
    " - epoch({anchor})) / 1800e0) AS bigint)"
)
INSIDE = (
    "(t.started_at BETWEEN {a} - INTERVAL 3 HOUR AND {a} + INTERVAL 6 HOUR"
    " OR t.ended_at BETWEEN {a} - INTERVAL 3 HOUR AND {a} + INTERVAL 6 HOUR)"
)
COUNTS = """count(*) FILTER (t.start_station_id = n.station_id) AS trips_started,
        count(*) FILTER (t.end_station_id = n.station_id) AS trips_ended"""
cte(
    "game_counts",
    f"""
    SELECT g.game_id, g.game_date, g.game_datetime_rounded AS game_datetime, g.stadium_name, g.home_team_name,
        g.away_team_name, n.station_id, n.station_name, {OFFSET.format(anchor='g.game_datetime_rounded')} AS interval_offset,
        {COUNTS}
    FROM home_games g JOIN near n USING (stadium_name)
    JOIN trips t ON t.ride_date = g.game_date AND {INSIDE.format(a='g.game_datetime_rounded')}
        AND (t.start_station_id = n.station_id OR t.end_station_id = n.station_id)
    GROUP BY ALL""",
    "home_games",
    "near",
    "trips",
)
cte(
    "free_days",
    "SELECT game_date AS d FROM home_games UNION SELECT date FROM holidays",
    "home_games",
    "holidays",
)


def baseline(anchor: str) -> str:
    return f"""
    SELECT g.game_id, n.station_id, {OFFSET.format(anchor=anchor)} AS interval_offset,
        (count(*) FILTER (t.start_station_id = n.station_id)) / count(DISTINCT t.ride_date) AS avg_started,
        (count(*) FILTER (t.end_station_id = n.station_id)) / count(DISTINCT t.ride_date) AS avg_ended
    FROM home_games g JOIN near n USING (stadium_name)
    JOIN trips t ON dayofweek(t.ride_date) = dayofweek(g.game_date) AND t.ride_date <> g.game_date
        AND {INSIDE.format(a=anchor)}
        AND (t.start_station_id = n.station_id OR t.end_station_id = n.station_id)
    WHERE t.ride_date NOT IN (SELECT d FROM free_days)
    GROUP BY ALL"""


cte("window_base", baseline("g.game_datetime_rounded"), "home_games", "near", "trips", "free_days")
cte(
    "clock_base",
    baseline("(t.ride_date + (g.game_datetime_rounded - date_trunc('day', g.game_datetime_rounded)))"),
    "home_games",
    "near",
    "trips",
    "free_days",
)


def event_demand(base: str) -> str:
    return f"""
    SELECT game_id, game_date, game_datetime, stadium_name, home_team_name, away_team_name, station_id, station_name,
        interval_offset, interval_offset * 0.5e0 AS hour_offset, trips_started AS trips_started_game_day,
        trips_ended AS trips_ended_game_day, trips_ended - trips_started AS net_flow_game_day,
        coalesce(avg_started, 0) AS trips_started_baseline, coalesce(avg_ended, 0) AS trips_ended_baseline,
        coalesce(avg_ended, 0) - coalesce(avg_started, 0) AS net_flow_baseline,
        CASE WHEN avg_started > 0 THEN (trips_started / avg_started - 1) * 100 END AS trips_started_pct_change,
        CASE WHEN avg_ended > 0 THEN (trips_ended / avg_ended - 1) * 100 END AS trips_ended_pct_change
    FROM game_counts LEFT JOIN {base} USING (game_id, station_id, interval_offset)"""


cte("event_demand", event_demand("window_base"), "game_counts", "window_base")
cte("event_demand_fixed", event_demand("clock_base"), "game_counts", "clock_base")
EVENT = f"""game_id, game_date, game_datetime, stadium_name, home_team_name, away_team_name, station_id, station_name,
    interval_offset, {r('hour_offset')}, trips_started_game_day, trips_ended_game_day, net_flow_game_day,
    {rs('trips_started_baseline', 'trips_ended_baseline', 'net_flow_baseline', 'trips_started_pct_change',
        'trips_ended_pct_change')}"""
SQL["event_window_demand"] = query(f"SELECT {EVENT} FROM event_demand", "event_demand")
SQL["event_baseline_fixed"] = query(f"SELECT {EVENT} FROM event_demand_fixed", "event_demand_fixed")
cte(
    "plan",
    """
    SELECT p.*, s.station_name,
        CASE WHEN net < -3 THEN round(-net) WHEN net > 3 THEN -round(net) ELSE 0e0 END AS move
    FROM (SELECT stadium_name, station_id, interval_offset, hour_offset, avg(trips_started_game_day) AS avg_trips_started,
            avg(trips_ended_game_day) AS avg_trips_ended, avg(net_flow_game_day) AS net, count(DISTINCT game_id) AS num_games
        FROM event_demand GROUP BY ALL HAVING count(DISTINCT game_id) > 1) p
    LEFT JOIN stations s USING (station_id)""",
    "event_demand",
    "stations",
)
ADVICE = """CASE WHEN move > 0 THEN 'Add ' || move || ' bikes' WHEN move < 0 THEN 'Remove ' || -move || ' bikes'
        ELSE 'No action needed' END AS rebalancing_recommendation"""
SHARE = "CASE WHEN abs(net) > 3 THEN -round(net * 5, 1) ELSE 0e0 END"
SQL["event_rebalancing"] = query(
    f"""SELECT stadium_name, station_id, station_name, interval_offset, {r('hour_offset')},
    {rs('avg_trips_started', 'avg_trips_ended')}, {r('net', 'avg_net_flow')}, num_games, {r('move', 'bikes_to_add_or_remove')},
    {ADVICE}, {r(SHARE, 'pct_capacity_adjustment')} FROM plan""",
    "plan",
)
SQL["event_rebalancing_slice"] = query(
    f"""SELECT station_name, {r('hour_offset')}, {r('round(net, 2)', 'avg_net_flow')}, {r('move', 'bikes_to_add_or_remove')},
    {ADVICE}, {r('round(avg_trips_started, 1)', 'avg_trips_started')}, {r('round(avg_trips_ended, 1)', 'avg_trips_ended')},
    num_games, {r(SHARE, 'pct_capacity_adjustment')} FROM plan WHERE stadium_name = 'Yankee Stadium' AND hour_offset = 1""",
    "plan",
)
SQL["event_extremes"] = query(
    f"""SELECT stadium_name, {r('hour_offset')}, count(*) AS stations_analyzed, {r('min(net)', 'max_depletion')},
    {r('max(net)', 'max_accumulation')} FROM plan GROUP BY stadium_name, plan.hour_offset""",
    "plan",
)
SQL["event_profile"] = query(
    f"""SELECT stadium_name, {r('hour_offset')}, {r('avg(trips_started_game_day)', 'avg_trips_started_game')},
    {r('avg(trips_started_baseline)', 'avg_trips_started_baseline')}, {r('avg(trips_ended_game_day)', 'avg_trips_ended_game')},
    {r('avg(trips_ended_baseline)', 'avg_trips_ended_baseline')}
    FROM event_demand_fixed GROUP BY stadium_name, event_demand_fixed.hour_offset""",
    "event_demand_fixed",
)
SQL["event_list"] = query(
    f"""SELECT stadium_name, game_id, game_date, game_datetime_rounded AS game_datetime,
    'Home vs ' || venue_name AS matchup, dayname(game_date) AS day_of_week
    FROM ({staged_games('order_games')}) WHERE stadium_name IN ('Yankee Stadium', 'Citi Field')""",
    "order_games",
)

# Net flow by a full outer join of departures and arrivals.
cte(
    "net_flow",
    """
    SELECT cluster_id, day_of_week, hour, coalesce(s, 0) AS trips_started, coalesce(e, 0) AS trips_ended,
        coalesce(e, 0) - coalesce(s, 0) AS net_flow,
        ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][day_of_week + 1] AS day_name,
        format('{:02d}:00', hour) AS hour_label
    FROM (SELECT cast(substr(start_station_id, 2) AS integer) % 5 AS cluster_id, dayofweek(started_at) AS day_of_week,
            hour(started_at) AS hour, count(*) AS s FROM trips WHERE start_station_id IS NOT NULL GROUP BY ALL)
    FULL JOIN (SELECT cast(substr(end_station_id, 2) AS integer) % 5 AS cluster_id, dayofweek(ended_at) AS day_of_week,
            hour(ended_at) AS hour, count(*) AS e FROM trips WHERE end_station_id IS NOT NULL GROUP BY ALL)
        USING (cluster_id, day_of_week, hour)""",
    "trips",
)
SQL["net_flow_baseline"] = query("SELECT * FROM net_flow", "net_flow")

SQL["net_flow_per_day"] = query(
    f"""SELECT cluster_id, day_of_week, hour, observed_days, {r('net_flow / observed_days', 'net_flow_per_day')}
    FROM net_flow LEFT JOIN (SELECT dayofweek(ride_date) AS day_of_week, count(DISTINCT ride_date) AS observed_days
        FROM trips GROUP BY 1) USING (day_of_week)""",
    "net_flow",
    "trips",
)

# Factors: weather joined to single trips.
for name, precip in (("conditions", "sum(w.precip)"), ("conditions_per_day", "any_value(w.precip)")):
    cte(
        name,
        f"""
    SELECT t.ride_date AS day, count(*) AS n, avg(w.tmax) AS heat, {precip} AS rain, avg(w.wind_max) AS wind,
        any_value(h.holiday_types) AS types
    FROM trips t LEFT JOIN weather w ON w.date = t.ride_date LEFT JOIN holidays h ON h.date = t.ride_date
    GROUP BY t.ride_date""",
        "trips",
        "weather",
        "holidays",
    )
RULES = (
    ("hot_weather", "Temperature > 28°C", "heat > 28", True),
    ("neutral_weather", "Temperature 15-19°C", "heat >= 15 AND heat < 20", True),
    ("warm_weather", "Temperature 20-28°C", "heat BETWEEN 20 AND 28", True),
    ("cold_weather", "Temperature < 15°C", "heat < 15", True),
    ("light_rain", "Light rain (≤5 mm)", "rain > 0 AND rain <= 5", True),
    ("heavy_rain", "Heavy rain (>5 mm)", "rain > 5", True),
    ("weak_wind", "Weak wind (≤15 km/h)", "wind <= 15", True),
    ("strong_wind", "Strong wind (>15 km/h)", "wind > 15", True),
    ("major_holiday", "Major holidays (Federal)", "regexp_matches(types, 'Federal|Public')", True),
    ("minor_holiday", "Minor holidays (Local)", "types = 'Local'", True),
    *[
        (d.lower(), d, f"dayname(day) = '{d}'", False)
        for d in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
    ],
)


def factor_rows(source: str) -> str:
    rows = []
    for name, text, rule, zero in RULES:
        pct = f"round((avg(n) FILTER ({rule}) / avg(n) - 1) * 100, 1)"
        rows.append(f"SELECT '{name}' AS factor_name, '{text}' AS description, "
                    f"{f'coalesce({pct}, 0e0)' if zero else pct} AS impact_pct FROM {source}")
    return " UNION ALL ".join(rows)


for name, source in (("factors", "conditions"), ("factors_per_day", "conditions_per_day")):
    cte(name, factor_rows(source), source)
LABEL = """CASE WHEN impact_pct > 0 THEN '+' || impact_pct || '% increase' WHEN impact_pct < 0 THEN impact_pct || '% decrease'
    ELSE 'No impact' END AS impact_label"""
for key, source in (("adjustment_factors", "factors"), ("adjustment_factors_per_day", "factors_per_day")):
    SQL[key] = query(
        f"""SELECT factor_name, description, {r('impact_pct')}, {r('round(1 + impact_pct / 100e0, 3)', 'adjustment_multiplier')},
    {LABEL} FROM {source}""",
        source,
    )

OPTIONS = {
    "temperature": (
        ("Cold (<15°C)", "cold_weather"),
        ("Neutral (15-19°C)", "neutral_weather"),
        ("Warm (20-28°C)", "warm_weather"),
        ("Hot (>28°C)", "hot_weather"),
    ),
    "wind": (("Weak (≤15 km/h)", "weak_wind"), ("Strong (>15 km/h)", "strong_wind")),
    "rain": (("None", ""), ("Light (≤5 mm)", "light_rain"), ("Heavy (>5 mm)", "heavy_rain")),
    "holiday": (("None", ""), ("Minor Holiday (Local)", "minor_holiday"), ("Major Holiday (Federal)", "major_holiday")),
}
DAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
_day_rows = ", ".join(f"({i}, '{d}', '{d.lower()}')" for i, d in enumerate(DAYS))


def _factor(column: str) -> str:
    return (
        f"CASE WHEN {column} IN (SELECT factor_name FROM factors)"
        f" THEN (SELECT round(1 + impact_pct / 100e0, 3) FROM factors WHERE factor_name = {column}) ELSE 1e0 END"
    )


cte(
    "scenarios",
    f"""
    SELECT cast(dn AS bigint) AS day_of_week, day, temperature, wind, rain, holiday,
        {_factor('df')} AS f_day, {_factor('tf')} AS f_temperature, {_factor('wf')} AS f_wind,
        {_factor('rf')} AS f_rain, {_factor('hf')} AS f_holiday
    FROM (VALUES {_day_rows}) AS a(dn, day, df), """
    + ", ".join(
        "(VALUES " + ", ".join(f"('{label}', '{f}')" for label, f in values) + f") AS {slot}_o({slot}, {slot[0]}f)"
        for slot, values in OPTIONS.items()
    ),
    "factors",
)
PRODUCT = "f_day * f_temperature * f_wind * f_rain * f_holiday"
SQL["scenario_effects"] = query(
    "SELECT day_of_week, day, temperature, wind, rain, holiday, "
    + ", ".join(
        r(f"round((f_{s} - 1) * 100, 1)", f"{s}_effect_pct") for s in ("day", "temperature", "wind", "rain", "holiday")
    )
    + f", {r(f'round(({PRODUCT} - 1) * 100, 1)', 'combined_effect_pct')} FROM scenarios",
    "scenarios",
)
GRID = f"""SELECT cluster_id, day_of_week, hour, hour_label, day, temperature, wind, rain, holiday, net_flow,
    {r('factor', 'combined_factor')}, {r('x', 'adjusted_net_flow')},
    cast(CASE WHEN x < -3 OR x > 3 THEN -round_even(x, 0) ELSE 0 END AS bigint) AS bikes_to_add_or_remove,
    CASE WHEN x < -3 THEN 'Add ' || cast(round_even(-x, 0) AS bigint) || ' bikes'
        WHEN x > 3 THEN 'Remove ' || cast(round_even(x, 0) AS bigint) || ' bikes' ELSE 'No action needed' END AS recommendation
    FROM (SELECT *, {PRODUCT} AS factor, net_flow * ({PRODUCT}) AS x FROM net_flow JOIN scenarios USING (day_of_week))"""
SQL["forecast_grid"] = query(GRID, "net_flow", "scenarios")
_picked = " AND ".join(f"{s} = (SELECT min({s}) FROM scenarios)" for s in ("day", "temperature", "wind", "rain", "holiday"))
SQL["forecast_point"] = query(f"SELECT * FROM ({GRID}) WHERE cluster_id = 2 AND {_picked}", "net_flow", "scenarios")
