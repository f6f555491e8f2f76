"""SQL for the ingestion queries."""

from __future__ import annotations

from oracles import marts  # noqa: F401
from oracles.inputs import cte, query

SQL: dict[str, str] = {}

SQL["weather_arrays_explode"] = query(
    """SELECT o_orderkey, cast(day + i AS varchar) AS date, tmax, tmin, precip, wind_max,
    '40.73,-73.94' AS source_location
    FROM (SELECT o_orderkey, cast(o_orderdate AS date) AS day, i,
            CASE WHEN i < 2 THEN h + i END AS tmax,
            CASE i WHEN 0 THEN h - 4 WHEN 2 THEN h - 2 END AS tmin,
            CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 30 + i) / 2e0 END AS precip,
            CASE WHEN i = 0 THEN (o_orderkey % 90) / 4e0 END AS wind_max
        FROM (SELECT *, (o_orderkey * 37 % 350) / 10e0 - 5 AS h FROM orders WHERE o_orderkey % 7 <> 0),
            (SELECT cast(unnest([0, 1, 2]) AS integer) AS i))"""
)

cte(
    "entries",
    """
    SELECT o_orderkey * 2 + i AS pos, d AS date, cast(year(d) AS integer) AS source_year,
        'H' || ((o_custkey + i) % 7) AS name, CASE WHEN o_custkey % 6 <> i THEN 'L' || (o_custkey % 5) END AS local,
        o_orderkey % 2 = i AS fixed, o_custkey % 9 = i AS global,
        CASE o_orderkey % 3 WHEN 0 THEN ['Optional', 'Public'] WHEN 1 THEN ['School', 'Federal'] ELSE ['Local'] END AS types,
        CASE WHEN o_custkey % 4 <> 0 THEN ['US-' || (o_custkey % 8), 'US-' || (o_custkey % 3)] END AS counties,
        CASE WHEN o_custkey % 3 = 0 THEN cast(1900 + o_orderkey % 100 AS integer) END AS launched
    FROM (SELECT *, cast(o_orderdate AS date) + cast(o_custkey % 5 * 1000 AS integer) AS d FROM orders),
        (SELECT cast(unnest([0, 1]) AS integer) AS i) WHERE i = 0 OR o_orderkey % 4 = 0""",
)
cte(
    "per_date",
    """
    SELECT date, source_year, count(*) AS n, bool_or(fixed) AS fixed, bool_or(global) AS global, min(launched) AS launched,
        list(struct_pack(name := name, local := local, types := types, counties := counties, fixed := fixed,
            global := global, launched := launched) ORDER BY pos)[1] AS one
    FROM entries GROUP BY ALL""",
    "entries",
)


def in_order(value: str, name: str) -> str:
    return f"""LEFT JOIN (SELECT date, string_agg(v, ' and ' ORDER BY p) AS {name} FROM (
        SELECT date, {value} AS v, min(pos) AS p FROM entries WHERE {value} IS NOT NULL GROUP BY ALL) GROUP BY date)
        AS j_{name} USING (date)"""


def as_set(value: str, name: str, order: str) -> str:
    return f"""LEFT JOIN (SELECT date, string_agg(v, ',' ORDER BY {order}) AS {name} FROM (
        SELECT DISTINCT date, unnest({value}) AS v FROM entries) GROUP BY date) AS j_{name} USING (date)"""


SQL["holiday_merge"] = query(
    f"""SELECT cast(date AS varchar) AS date, if(n = 1, one.name, names) AS holiday_name,
    if(n = 1, one.local, coalesce(locals, one.local)) AS local_name, 'US' AS country_code,
    if(n = 1, one.fixed, fixed) AS is_fixed, if(n = 1, one.global, global) AS is_global,
    if(n = 1, array_to_string(one.counties, ','), all_counties) AS counties,
    if(n = 1, one.launched, launched) AS launch_year,
    if(n = 1, array_to_string(one.types, ','), all_types) AS holiday_types, source_year
    FROM per_date {in_order('name', 'names')} {in_order('local', 'locals')} {as_set('counties', 'all_counties', 'v')}
    {as_set('types', 'all_types', "CASE v WHEN 'Public' THEN 1 WHEN 'Federal' THEN 2 ELSE 3 END, v")}""",
    "per_date",
    "entries",
)
SQL["schedule_flatten"] = query(
    """SELECT o_orderkey * 2 AS game_id, d AS game_date, d || 'T23:05:00Z' AS game_datetime, d AS official_date,
    left(d, 4) AS season, 'R' AS game_type, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS game_status,
    cast(team AS integer) AS home_team_id, 'Team ' || team AS home_team_name,
    cast(100 + o_custkey % 20 AS integer) AS away_team_id, 'Team ' || (100 + o_custkey % 20) AS away_team_name,
    cast(o_custkey % 30 AS integer) AS venue_id, 'Park ' || (o_custkey % 30) AS venue_name, 'mlb_stats_api' AS source_api
    FROM (SELECT *, cast(cast(o_orderdate AS date) AS varchar) AS d, if(o_custkey % 2 = 0, 147, 121) AS team FROM orders)"""
)
SQL["merge_upsert"] = query(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate
    FROM (SELECT * REPLACE (cast(l_shipdate AS date) AS l_shipdate),
            max(cast(l_shipdate AS date)) OVER k >= DATE '1997-01-01' AS replaced,
            row_number() OVER (k ORDER BY l_shipdate DESC, l_extendedprice DESC, l_quantity DESC) AS place
        FROM lineitem WINDOW k AS (PARTITION BY l_orderkey, l_linenumber))
    WHERE NOT replaced OR place = 1"""
)
SQL["upsert_table"] = query(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate,
    cast(CASE WHEN l_quantity <> 7 THEN year(l_shipdate) END AS integer) AS ship_year
    FROM (SELECT * REPLACE (cast(l_shipdate AS date) AS l_shipdate), row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY cast(l_shipdate AS date) DESC NULLS LAST, l_extendedprice DESC, l_quantity DESC) AS place FROM lineitem)
    WHERE place = 1"""
)
SQL["csv_ingest_drift"] = query(
    """SELECT cast(ride_id AS varchar) AS ride_id, s AS started_at, e AS ended_at, start_station_id,
    CASE WHEN ride_id % 3 <> 1 THEN member_casual END AS member_casual, CASE WHEN ride_id % 3 = 2 THEN 'late' END AS note,
    datediff('second', s, e) / 60e0 AS ride_mins, strftime(started_at, '%Y%m') AS source_month
    FROM (SELECT *, date_trunc('second', started_at) AS s, date_trunc('second', ended_at) AS e FROM raw_trips)""",
    "raw_trips",
)
SQL["csv_ingest"] = query(
    """SELECT cast(ride_id AS varchar) AS ride_id, s AS started_at, e AS ended_at, start_station_id, start_lat,
    member_casual, datediff('second', s, e) / 60e0 AS ride_mins, strftime(started_at, '%Y%m') AS source_month
    FROM (SELECT *, CASE WHEN ride_id % 97 <> 0 THEN date_trunc('second', started_at) END AS s,
        date_trunc('second', ended_at) AS e FROM raw_trips)""",
    "raw_trips",
)
SQL["partition_calendar"] = query(
    """SELECT strftime(o_orderdate, '%Y%m') AS source_month, count(*) AS orders FROM orders
    WHERE o_orderdate >= TIMESTAMP '1994-01-01' AND o_orderdate < TIMESTAMP '1996-03-01' GROUP BY 1"""
)
SQL["warehouse_roundtrip"] = query(
    """SELECT member_casual, cast(sum(trips) AS bigint) AS trips, count(DISTINCT ride_date) AS days
    FROM daily GROUP BY member_casual""",
    "daily",
)
