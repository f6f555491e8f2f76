"""Common table expressions over the test tables, and small text helpers."""

from __future__ import annotations


def r(expr: str, name: str | None = None) -> str:
    """Six places, no negative zero."""
    return f"round(cast({expr} as double), 6) + 0e0 as {name or expr.split('.')[-1]}"


def rs(*names: str) -> str:
    return ", ".join(r(n) for n in names)


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (needs, sql)


def query(body: str, *needs: str) -> str:
    """``body`` preceded by the expressions it needs, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for n in CTES[name][0]:
            visit(n)
        if name not in ordered:
            ordered.append(name)

    for n in needs:
        visit(n)
    if not ordered:
        return body.strip()
    head = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in ordered)
    return f"WITH {head}\n{body.strip()}"


def place(number: str) -> tuple[str, str]:
    return (
        f"(40680 + ({number}) * 13 % 130) / 1000e0",
        f"(({number}) * 29 % 200 - 74030) / 1000e0",
    )


_START, _END = "(user_id % 40)", "((user_id * 7 + event_id) % 43)"

cte(
    "raw_trips",
    f"""
    SELECT event_id AS ride_id,
        CASE event_type WHEN 'purchase' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
        ts AS started_at,
        ts + to_seconds(cast(round(value * 60) AS bigint)) AS ended_at,
        'S' || {_START} AS start_station_id,
        'Station ' || {_START} || CASE WHEN event_id % 11 = 0 THEN ' (temp)' ELSE '' END AS start_station_name,
        CASE WHEN event_id % 17 <> 0 THEN 'S' || {_END} END AS end_station_id,
        CASE WHEN event_id % 17 <> 0 THEN 'Station ' || {_END} END AS end_station_name,
        {place(_START)[0]} AS start_lat, {place(_START)[1]} AS start_lng,
        CASE WHEN event_id % 17 <> 0 THEN {place(_END)[0]} END AS end_lat,
        CASE WHEN event_id % 17 <> 0 THEN {place(_END)[1]} END AS end_lng,
        CASE WHEN event_type IN ('view', 'click') THEN 'member' ELSE 'casual' END AS member_casual
    FROM events""",
)
cte(
    "trips",
    """
    SELECT * FROM (
        SELECT ride_id, started_at, ended_at, cast(started_at AS date) AS ride_date,
            datediff('second', started_at, ended_at) / 60e0 AS ride_mins,
            start_station_id, start_station_name, start_lat, start_lng,
            end_station_id, end_station_name, end_lat, end_lng, member_casual
        FROM raw_trips WHERE ended_at >= started_at)
    WHERE ride_mins >= 1 AND ride_mins <= 720""",
    "raw_trips",
)
cte(
    "raw_weather",
    """
    SELECT date,
        CASE WHEN d % 13 <> 0 THEN cast(d * 37 % 350 AS double) / 10e0 - 5 END AS tmax,
        CASE WHEN d % 11 <> 0 THEN cast(d * 37 % 350 AS double) / 10e0 - 5 - cast(d * 13 % 90 AS double) / 10e0
            + CASE WHEN d % 17 = 0 THEN 20 ELSE 0 END END AS tmin,
        CASE WHEN d % 3 = 0 THEN cast(d * 7 % 200 AS double) / 10e0 ELSE 0e0 END AS precip,
        cast(d * 11 % 300 AS double) / 10e0 AS wind_max
    FROM (SELECT DISTINCT cast(ts AS date) AS date, day(ts) AS d FROM events)""",
)
cte(
    "weather",
    "SELECT * FROM raw_weather WHERE tmax IS NULL OR tmin IS NULL OR tmax >= tmin",
    "raw_weather",
)
cte(
    "raw_holidays",
    """
    SELECT * FROM (VALUES ('2024-01-01', 'New Year', 'Public', 2024), ('2024-01-15', 'Civic Day', 'Federal,Optional', 2024),
        ('2024-01-15', 'Parade', 'Local', 2024), ('2024-01-26', 'Founders Day', 'Local', 2024))
        AS h(date, holiday_name, holiday_types, source_year)""",
)
cte(
    "order_holidays",
    """
    SELECT cast(cast(o_orderdate AS date) AS varchar) AS date, 'Day ' || (o_custkey % 50) AS holiday_name,
        CASE left(o_orderpriority, 1) WHEN '1' THEN 'Public' WHEN '2' THEN 'Federal,Optional'
            WHEN '3' THEN 'Local' WHEN '5' THEN 'Observance' END AS holiday_types,
        cast(year(o_orderdate) AS integer) AS source_year
    FROM orders""",
)


def rules(source: str) -> str:
    """Rule dates by searching the calendar: the n-th Sunday of the month in each year."""
    return f"""
    SELECT cast(d AS date) AS date, n AS holiday_name, 'Local' AS holiday_types, 'US' AS country_code,
        'US-NY' AS counties, source_year
    FROM (SELECT DISTINCT source_year FROM {source}) y,
        (VALUES ('NYC Marathon', 11, 1), ('Puerto Rican Day Parade', 6, 8)) AS rule(n, m, first_day),
        (SELECT unnest(generate_series(0, 6)) AS i) days,
        LATERAL (SELECT make_date(source_year, m, cast(first_day + i AS integer)) AS d)
    WHERE dayofweek(d) = 0"""


def staged_holidays(source: str) -> str:
    return f"""
    SELECT date, holiday_name, holiday_types, country_code, counties, source_year,
        coalesce(holiday_types LIKE '%Public%' OR holiday_types LIKE '%Federal%', false) AS is_major,
        NOT coalesce(holiday_types LIKE '%Public%' OR holiday_types LIKE '%Federal%', false) AS is_working_day
    FROM (
        SELECT cast(date AS date) AS date, holiday_name, holiday_types, NULL AS country_code, NULL AS counties, source_year
        FROM {source}
        UNION ALL
        SELECT date, holiday_name, holiday_types, country_code, counties, source_year FROM ({rules(source)})
    ) AS every_row
    QUALIFY row_number() OVER (PARTITION BY date ORDER BY
        CASE WHEN holiday_types LIKE '%Public%' THEN 1 WHEN holiday_types LIKE '%Federal%' THEN 2 ELSE 3 END,
        holiday_name NULLS LAST, holiday_types NULLS FIRST, counties NULLS FIRST, source_year) = 1"""


cte("holidays", staged_holidays("raw_holidays"), "raw_holidays")


def staged_games(source: str, extra: str = "") -> str:
    return f"""
    SELECT game_id, t AS game_datetime_rounded, game_datetime AS game_datetime_original, cast(t AS date) AS game_date,
        cast(hour(t) AS bigint) AS game_hour, strftime(t, '%H:%M:%S') AS game_time, home_team_id, {extra}venue_name,
        t + INTERVAL 3 HOUR AS estimated_end_datetime,
        home_team_id = 147 AS is_yankees_home, home_team_id = 121 AS is_mets_home,
        CASE WHEN contains(venue_name, 'Yankee') THEN 'Yankee Stadium' WHEN contains(venue_name, 'Citi Field') THEN 'Citi Field'
            ELSE venue_name END AS stadium_name
    FROM (SELECT *, date_trunc('hour', game_datetime + INTERVAL 30 MINUTE) AS t FROM {source})"""


cte(
    "raw_games",
    """
    SELECT n_nationkey AS game_id, CASE n_nationkey % 2 WHEN 0 THEN 147 ELSE 121 END AS home_team_id,
        CASE n_nationkey % 2 WHEN 0 THEN 'Yankees' ELSE 'Mets' END AS home_team_name, n_name AS away_team_name,
        CASE WHEN n_nationkey % 5 = 0 THEN 'Away Park' WHEN n_nationkey % 2 = 0 THEN 'Yankee Stadium II'
            ELSE 'Citi Field NY' END AS venue_name,
        TIMESTAMP '2024-01-02 19:00:00' + to_days(n_nationkey * 2 % 28) + to_minutes(n_nationkey * 7 % 60) AS game_datetime
    FROM nation""",
)
cte("games", staged_games("raw_games", "home_team_name, away_team_name, "), "raw_games")
cte("home_games", "SELECT * FROM games WHERE stadium_name IN ('Yankee Stadium', 'Citi Field')", "games")
cte(
    "order_games",
    """
    SELECT o_orderkey AS game_id, CASE o_custkey % 3 WHEN 0 THEN 147 WHEN 1 THEN 121 ELSE 110 END AS home_team_id,
        CASE o_custkey % 4 WHEN 0 THEN 'New Yankee Stadium' WHEN 1 THEN 'Citi Field NY' WHEN 2 THEN 'London Stadium' END AS venue_name,
        o_orderdate + to_minutes(o_orderkey * 37 % 1440) + to_seconds(o_orderkey * 13 % 60) AS game_datetime
    FROM orders""",
)

AREAS = (
    ("Manhattan - Financial", 40.70, 40.72, -74.02, -73.98),
    ("Manhattan - Midtown", 40.74, 40.78, -74.01, -73.97),
    ("Manhattan - Upper West", 40.78, 40.80, -74.00, -73.95),
    ("Manhattan - Upper East", 40.78, 40.80, -73.98, -73.94),
    ("Manhattan - Downtown", 40.70, 40.73, -73.97, -73.93),
    ("Brooklyn", 40.58, 40.74, -74.05, -73.833),
    ("Queens", 40.69, 40.80, -73.962, -73.70),
    ("Bronx", 40.79, 40.88, -73.93, -73.83),
    ("Jersey City", 40.68, 40.76, -74.08, -74.02),
)
cte(
    "boxes",
    "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{n}', {a}e0, {b}e0, {c}e0, {d}e0)" for i, (n, a, b, c, d) in enumerate(AREAS))
    + ") AS b(prio, area, lat0, lat1, lon0, lon1)",
)
cte(
    "stations",
    """
    SELECT s.station_id, s.station_name, s.name_variations, c.latitude, c.longitude,
        coalesce((SELECT arg_min(b.area, b.prio) FROM boxes b
            WHERE c.latitude >= lat0 AND c.latitude <= lat1 AND c.longitude >= lon0 AND c.longitude <= lon1), 'Other') AS area
    FROM (
        SELECT station_id, (list(station_name ORDER BY uses DESC, station_name))[1] AS station_name,
            count(*) AS name_variations
        FROM (SELECT station_id, station_name, count(*) AS uses
            FROM (SELECT start_station_id AS station_id, start_station_name AS station_name FROM trips
                UNION ALL SELECT end_station_id, end_station_name FROM trips) GROUP BY ALL)
        WHERE station_id IS NOT NULL GROUP BY station_id) s
    LEFT JOIN (
        SELECT start_station_id AS station_id, min(start_lat) AS latitude, min(start_lng) AS longitude
        FROM trips WHERE start_lat >= 40.5 AND start_lat <= 41 AND start_lng >= -74.3 AND start_lng <= -73.7
        GROUP BY 1) c USING (station_id)""",
    "trips",
    "boxes",
)
cte(
    "stadiums",
    "SELECT * FROM (VALUES (1, 'Yankee Stadium', 40.693e0, -74.001e0), (2, 'Citi Field', 40.719e0, -73.943e0))"
    " AS v(stadium_id, stadium_name, lat, lon)",
)
cte(
    "distances",
    """
    SELECT stadium_id, stadium_name, station_id, station_name, latitude, longitude,
        2 * 6371 * asin(sqrt(sin(radians(lat - latitude) / 2) ** 2
            + cos(radians(lat)) * cos(radians(latitude)) * sin(radians(lon - longitude) / 2) ** 2)) AS distance_km
    FROM stadiums, stations WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "stadiums",
    "stations",
)
cte(
    "daily",
    """
    SELECT ride_date, member_casual, count(*) AS trips, avg(ride_mins) AS avg_duration_mins,
        min(ride_mins) AS min_duration_mins, max(ride_mins) AS max_duration_mins,
        count(DISTINCT start_station_id) AS unique_start_stations, count(DISTINCT end_station_id) AS unique_end_stations
    FROM trips GROUP BY ALL""",
    "trips",
)
cte(
    "demand",
    """
    SELECT ride_date, cast(sum(trips) AS bigint) AS trips_total, avg(avg_duration_mins) AS avg_duration_mins,
        cast(coalesce(sum(trips) FILTER (member_casual = 'member'), 0) AS bigint) AS member_trips,
        cast(coalesce(sum(trips) FILTER (member_casual = 'casual'), 0) AS bigint) AS casual_trips,
        cast(sum(unique_start_stations) AS bigint) AS total_start_stations,
        cast(sum(unique_end_stations) AS bigint) AS total_end_stations,
        dayname(ride_date) AS day_of_week, dayofweek(ride_date) AS day_of_week_num,
        CASE WHEN isodow(ride_date) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type
    FROM daily GROUP BY ride_date""",
    "daily",
)
cte(
    "effect",
    """
    SELECT d.ride_date AS date, trips_total, avg_duration_mins, member_trips, casual_trips, day_of_week, day_type,
        tmax, tmin, (tmax + tmin) / 2 AS temp_avg, precip, wind_max,
        if(precip > 0, 1, 0) AS is_rain,
        if(precip > 10, 'Heavy Rain', if(precip > 0, 'Light Rain', 'No Rain')) AS rain_category,
        CASE WHEN tmax + tmin < 10 THEN 'Very Cold' WHEN tmax + tmin < 30 THEN 'Cold' WHEN tmax + tmin < 50 THEN 'Moderate'
            ELSE 'Warm' END AS temp_category
    FROM demand d LEFT JOIN weather w ON w.date = d.ride_date""",
    "demand",
    "weather",
)
