"""SQL for station clusters: k-means as two recursions over lists of centres."""

from __future__ import annotations

from oracles.inputs import query, r, rs
from oracles.marts import FLAG

SQL: dict[str, str] = {}


def k_means(points: str, ks: tuple[int, ...], restarts: int = 10, seed: int = 42) -> str:
    """Rows (g, k, station_id, latitude, longitude, cluster_id, centroid) for points (g, station_id, latitude, longitude)."""

    def squared(c: str) -> str:
        return f"(x - {c}.x) * (x - {c}.x) + (y - {c}.y) * (y - {c}.y)"

    nearest = f"list_min(list_transform(range(1, len(centres) + 1), lambda i: {{'d': {squared('centres[i]')}, 'i': i}}))"
    return f"""
    WITH RECURSIVE pts AS (
        SELECT g, station_id, latitude, longitude, cast(round((latitude + 90) * 1000000) AS bigint) AS x,
            cast(round((longitude + 180) * 1000000) AS bigint) AS y
        FROM ({points}) WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
    seeds AS (
        SELECT g, restart, 1 AS n, [arg_min({{'x': x, 'y': y}}, md5(station_id || '|' || (restart + {seed})))] AS centres
        FROM pts, range(0, {restarts}) t(restart) GROUP BY g, restart
        UNION ALL
        SELECT g, restart, any_value(n) + 1, list_append(any_value(centres), {{'x': max(s).x, 'y': max(s).y}})
        FROM (SELECT g, restart, n, centres,
                {{'d': list_min(list_transform(centres, lambda c: {squared('c')})), 'x': x, 'y': y}} AS s
            FROM seeds JOIN pts USING (g) WHERE n < {max(ks)})
        GROUP BY g, restart HAVING max(s).d > 0),
    steps AS (
        SELECT g, k, restart, 0 AS step, centres[1:k] AS centres, cast(0 AS hugeint) AS cost, true AS moved
        FROM (SELECT g, restart, arg_max(centres, n) AS centres FROM seeds GROUP BY g, restart),
            (VALUES {", ".join(f"({k})" for k in ks)}) t(k)
        UNION ALL
        SELECT g, k, restart, step + 1, now, cost, list_sum(list_transform(range(1, len(now) + 1), lambda j:
            (now[j].x - centres[j].x) * (now[j].x - centres[j].x) + (now[j].y - centres[j].y) * (now[j].y - centres[j].y))) > 250000 FROM (
            SELECT g, k, restart, any_value(step) AS step, any_value(centres) AS centres, cast(sum(d) AS hugeint) AS cost,
                list_transform(range(1, len(any_value(centres)) + 1), lambda j: coalesce(
                    list_filter(list({{'i': i, 'c': {{'x': cx, 'y': cy}}}}), lambda e: e.i = j)[1].c, any_value(centres)[j])) AS now
            FROM (SELECT g, k, restart, near.i AS i, any_value(step) AS step, any_value(centres) AS centres,
                    cast(sum(x) AS bigint) // count(*) AS cx, cast(sum(y) AS bigint) // count(*) AS cy, sum(near.d) AS d
                FROM (SELECT g, k, restart, step, centres, x, y, {nearest} AS near
                    FROM steps JOIN pts USING (g) WHERE moved AND step < 300)
                GROUP BY g, k, restart, near.i)
            GROUP BY g, k, restart)),
    fits AS (SELECT g, k, restart, arg_max(centres, step) AS centres, arg_max(cost, step) AS cost FROM steps GROUP BY g, k, restart),
    best AS (SELECT g, k, arg_min(centres, {{'c': cost, 'r': restart}}) AS centres FROM fits GROUP BY g, k),
    labelled AS (
        SELECT g, k, station_id, latitude, longitude, x, y, cast({nearest}.i - 1 AS integer) AS cluster_id
        FROM best JOIN pts USING (g))
    SELECT g, k, station_id, latitude, longitude, cluster_id,
        cast(sum(x) OVER w AS double) / count(*) OVER w / 1000000e0 - 90 AS centroid_lat,
        cast(sum(y) OVER w AS double) / count(*) OVER w / 1000000e0 - 180 AS centroid_lon
    FROM labelled WINDOW w AS (PARTITION BY g, k, cluster_id)"""


KM = """2 * 6371 * asin(sqrt(sin(radians(centroid_lat - latitude) / 2) ** 2
    + cos(radians(centroid_lat)) * cos(radians(latitude)) * sin(radians(centroid_lon - longitude) / 2) ** 2))"""
LABELS = f"{rs('latitude', 'longitude')}, cluster_id, {rs('centroid_lat', 'centroid_lon')}, {r(KM, 'distance_from_centroid_km')}"

SQL["station_clusters"] = query(
    f"""SELECT station_id, station_name, {LABELS}
    FROM ({k_means("SELECT 1 AS g, station_id, latitude, longitude FROM stations", (12,))})
    JOIN (SELECT station_id, station_name FROM stations) USING (station_id)""",
    "stations",
)
CUSTOMERS = """SELECT 1 AS g, 'C' || c_custkey AS station_id,
    CASE WHEN c_custkey % 97 <> 0 THEN (40500 + c_custkey * 7919 % 410) / 1000e0 END AS latitude,
    (c_custkey * 104729 % 530 - 74250) / 1000e0 AS longitude FROM customer"""
SQL["customer_clusters"] = f"""SELECT station_id, 'Corner ' || substr(station_id, 2) AS station_name, {LABELS}
    FROM ({k_means(CUSTOMERS, (30,))})"""

FEASTS = "SELECT holiday_date AS g, station_id, latitude, longitude FROM by_station"
SQL["holiday_station_clusters"] = query(
    f"""SELECT g AS holiday_date, k, station_id, station_name, {LABELS} FROM ({k_means(FEASTS, (10, 30))})
    JOIN (SELECT holiday_date AS g, station_id, station_name FROM by_station) USING (g, station_id)""",
    "by_station",
)
SQL["holiday_cluster_rollup"] = query(
    f"""SELECT holiday_date, k, cluster_id, trips_holiday, {rs('trips_baseline', 'trips_abs_change', 'latitude', 'longitude')},
    station_count, area, {r('pct', 'trips_pct_change')}, {FLAG}
    FROM (SELECT *, (trips_holiday - trips_baseline) / nullif(trips_baseline, 0) * 100 AS pct FROM (
        SELECT holiday_date, k, cluster_id, cast(sum(trips_holiday) AS bigint) AS trips_holiday,
            coalesce(sum(trips_baseline), 0) AS trips_baseline,
            coalesce(sum(trips_holiday - trips_baseline), 0) AS trips_abs_change, avg(b.latitude) AS latitude,
            avg(b.longitude) AS longitude, count(*) AS station_count, mode_of(list(area)) AS area
        FROM by_station b JOIN ({k_means(FEASTS, (10, 30))}) c ON c.g = b.holiday_date AND c.station_id = b.station_id
        GROUP BY holiday_date, k, cluster_id))""".replace(
        "mode_of(list(area))",
        "(list_transform(list_sort(list_transform(list_distinct(list(area)), lambda a: {'n': -len(list_filter(list(area), lambda z: z = a)), 'a': a})), lambda e: e.a))[1]",
    ),
    "by_station",
)
