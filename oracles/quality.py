"""SQL for the data-quality queries: one count pair per check."""

from __future__ import annotations

from oracles import marts  # noqa: F401
from oracles.inputs import cte, query, r

SQL: dict[str, str] = {}

cte(
    "suite_trips",
    "SELECT *, trunc(round(epoch(ended_at) - epoch(started_at), 6)) / 60e0 AS ride_mins FROM raw_trips",
    "raw_trips",
)


class Suite:
    """Collects one SELECT per check, numbered in order."""

    def __init__(self, source: str, table: str, severity: str | None = None):
        self.source, self.table, self.rows, self.severity = source, table, [], severity

    def add(self, kind: str, label: str, seen: str, bad: str, mostly: float = 1.0, severity: str = "error") -> Suite:
        evaluated = f"count(*) FILTER ({seen})"
        unexpected = f"count(*) FILTER (({seen}) AND ({bad}))"
        self.put(kind, label, evaluated, unexpected, f"{unexpected} <= {evaluated} * {1 - mostly:.2f}e0 + 1e-9", severity)
        return self

    def put(self, kind: str, label: str, evaluated: str, unexpected: str, success: str, severity: str = "error") -> None:
        extra = f", '{severity}' AS severity" if self.severity else ""
        self.rows.append(
            f"SELECT '{self.source}' AS source_name, {len(self.rows) + 1} AS check_no, '{kind}' AS check_type,"
            f" '{label}' AS column_name, {evaluated} AS evaluated, {unexpected} AS unexpected,"
            f" {success} AS success{extra} FROM {self.table}"
        )

    def not_null(self, *columns: str) -> Suite:
        for c in columns:
            self.add("not_null", c, "true", f"{c} IS NULL")
        return self

    def unique(self, column: str, kind: str = "unique", key: str | None = None) -> Suite:
        key = key or column
        only = f"WHERE {column} IS NOT NULL" if kind == "unique" else ""
        table = self.table
        self.table = f"(SELECT count(*) AS n FROM {table} {only} GROUP BY {key})"
        self.put(
            kind,
            column,
            "cast(coalesce(sum(n), 0) AS bigint)",
            "cast(coalesce(sum(n) FILTER (n > 1), 0) AS bigint)",
            "coalesce(max(n), 0) <= 1",
        )
        self.table = table
        return self

    def between(self, column: str, low: float, high: float, mostly: float = 1.0) -> Suite:
        return self.add("between", column, f"{column} IS NOT NULL", f"{column} < {low} OR {column} > {high}", mostly)

    def in_set(self, column: str, *values: str, severity: str = "error") -> Suite:
        listed = ", ".join(f"'{v}'" for v in values)
        return self.add("in_set", column, f"{column} IS NOT NULL", f"{column} NOT IN ({listed})", severity=severity)

    def expression(self, column: str, text: str) -> Suite:
        return self.add("expression", column, "true", f"NOT ({text})")

    def row_count(self) -> Suite:
        self.put("row_count", "table", "count(*)", "cast(count(*) < 1 AS bigint)", "count(*) >= 1")
        return self

    def sql(self) -> str:
        return "\nUNION ALL ".join(self.rows)


TRIPS = (
    Suite("bike_trips", "suite_trips")
    .not_null("ride_id")
    .unique("ride_id")
    .not_null("started_at", "ended_at", "ride_mins")
    .between("ride_mins", 1, 720, 0.99)
    .not_null("member_casual")
    .in_set("member_casual", "member", "casual")
    .not_null("rideable_type")
    .between("start_lat", 40.5, 41, 0.99)
    .between("start_lng", -74.3, -73.7, 0.99)
    .between("end_lat", 40.5, 41, 0.99)
    .between("end_lng", -74.3, -73.7, 0.99)
    .row_count()
)
WEATHER = (
    Suite("weather", "raw_weather")
    .not_null("date")
    .unique("date")
    .between("tmax", -50, 50)
    .between("tmin", -50, 50)
    .add("pair_greater", "tmax,tmin", "tmax IS NOT NULL OR tmin IS NOT NULL", "coalesce(tmax < tmin, true)", 0.99)
    .between("precip", 0, 1000)
    .between("wind_max", 0, 200)
    .row_count()
)
HOLIDAYS = Suite("holidays", "raw_holidays").not_null("date").unique("date").not_null("holiday_name").row_count()
GAMES = (
    Suite("games", "(SELECT *, cast(game_datetime AS date) AS game_date FROM raw_games)")
    .not_null("game_id")
    .unique("game_id")
    .not_null("game_date", "venue_name")
    .row_count()
)
cte(
    "suite_results",
    "\nUNION ALL ".join(s.sql() for s in (TRIPS, WEATHER, HOLIDAYS, GAMES)),
    "suite_trips",
    "raw_weather",
    "raw_holidays",
    "raw_games",
)
SQL["dq_suite_results"] = query("SELECT * FROM suite_results", "suite_results")

MODELS = (
    Suite("stg_bike_trips", "trips", "error")
    .unique("ride_id")
    .not_null("ride_id", "started_at", "ended_at", "ride_date", "ride_mins")
    .between("ride_mins", 1, 720)
    .in_set("member_casual", "member", "casual"),
    Suite("mart_demand_daily", "demand", "error")
    .unique("ride_date")
    .not_null("ride_date", "trips_total")
    .expression("trips_total", "trips_total > 0")
    .not_null("member_trips", "casual_trips")
    .in_set("day_type", "Weekday", "Weekend"),
    Suite("mart_weather_effect", "effect", "error")
    .unique("date")
    .not_null("date", "trips_total")
    .in_set("temp_category", "Very Cold", "Cold", "Moderate", "Warm", severity="warn")
    .in_set("rain_category", "No Rain", "Light Rain", "Heavy Rain", severity="warn"),
    Suite("mart_holiday_impact_by_hour", "by_hour", "error")
    .not_null("holiday_date", "holiday_name", "hour_of_day")
    .between("hour_of_day", 0, 23)
    .not_null("trips_holiday", "trips_baseline")
    .unique("holiday_date,hour_of_day", "unique_combination", "holiday_date, hour_of_day"),
)
SQL["dq_model_tests"] = query(
    """SELECT *, CASE WHEN success THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
    FROM ("""
    + "\nUNION ALL ".join(s.sql() for s in MODELS)
    + ")",
    "trips",
    "demand",
    "effect",
    "by_hour",
)
SQL["dq_unique_combination"] = query(
    Suite("lineitem", "lineitem", "error")
    .unique("l_orderkey,l_linenumber", "unique_combination", "l_orderkey, l_linenumber")
    .sql()
)
SQL["dq_relationships"] = query(
    """SELECT 'trips' AS source_name, 1 AS check_no, 'relationship' AS check_type, 'end_station_id' AS column_name,
    count(end_station_id) AS evaluated,
    count(*) FILTER (end_station_id IS NOT NULL AND end_station_id NOT IN (SELECT start_station_id FROM trips)) AS unexpected,
    count(*) FILTER (end_station_id IS NOT NULL AND end_station_id NOT IN (SELECT start_station_id FROM trips)) = 0 AS success,
    'error' AS severity FROM trips""",
    "trips",
)
ROLLUP = """SELECT 'gx' AS test_type, 'gx_' || source_name || '_validation' AS test_name,
    if(bool_and(success), 'pass', 'fail') AS status,
    CASE WHEN NOT bool_and(success) THEN 'Failed ' || count(*) FILTER (NOT success) || ' expectations' END AS failure_message,
    source_name FROM suite_results GROUP BY source_name"""
SQL["dq_source_rollup"] = query(ROLLUP, "suite_results")
SQL["dq_freshness"] = query(
    """SELECT source, last_date, days_old,
    CASE WHEN last_date IS NULL THEN 'NO DATA' WHEN days_old > 15 THEN 'STALE (' || days_old || 'd)'
        WHEN days_old > 10 THEN 'WARN (' || days_old || 'd)' ELSE 'OK (' || days_old || 'd)' END AS status,
    CASE WHEN days_old <= 10 THEN 'pass' WHEN days_old <= 15 THEN 'warn' ELSE 'error' END AS check_status
    FROM (SELECT source, last_date, datediff('day', last_date, DATE '2024-02-10') AS days_old FROM (
        SELECT 'bike_trips' AS source, cast(max(started_at) AS date) AS last_date FROM raw_trips
        UNION ALL SELECT 'weather', max(date) FROM raw_weather
        UNION ALL SELECT 'holidays', max(cast(date AS date)) FROM raw_holidays
        UNION ALL SELECT 'games', max(cast(game_datetime AS date)) FROM raw_games))""",
    "raw_trips",
    "raw_weather",
    "raw_holidays",
    "raw_games",
)
SQL["dq_row_loss"] = query(
    """SELECT raw_count, staged_count, raw_count - staged_count AS records_lost,
    NOT (raw_count - staged_count > raw_count * 0.01) AS success
    FROM (SELECT count(*) AS raw_count FROM raw_weather WHERE date IS NOT NULL), (SELECT count(*) AS staged_count FROM weather)""",
    "raw_weather",
    "weather",
)
KEYS = (("suite_trips", "ride_id"), ("raw_weather", "date"), ("raw_holidays", "date"), ("raw_games", "game_id"))
SQL["dq_monitor"] = query(
    f"""SELECT count(*) AS total_tests, count(*) FILTER (status = 'pass') AS passed,
    count(*) FILTER (status = 'fail') AS failed, {r("100e0 * count(*) FILTER (status = 'pass') / count(*)", 'pass_rate')}
    FROM (SELECT status FROM ({ROLLUP}) UNION ALL SELECT if(sum(bad) = 0, 'pass', 'fail') FROM (
        {" UNION ALL ".join(f"SELECT count(*) - count(DISTINCT {k}) AS bad FROM {t}" for t, k in KEYS)}))""",
    "suite_results",
)
