"""SQL for the statistics queries."""

from __future__ import annotations

from oracles import marts  # noqa: F401  (defines the marts' expressions)
from oracles.inputs import cte, query, r, rs

SQL: dict[str, str] = {}

# Two-sided p by Simpson's rule on the t density, independent of the closed form.
SQL["holiday_significance"] = query(
    f"""SELECT holiday_date, holiday_name, sample_days, {r('t', 't_stat')}, {r('p', 'p_value')},
    coalesce(p < 0.05, false) AS is_significant, if(sample_days >= 5, 't_test', 'insufficient_data') AS test_type
    FROM (SELECT holiday_date, holiday_name, sample_days, t,
        1 - 2 * (abs(t) / 6000) * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
            * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi())
            * (1 + (abs(t) * i / 2000) ** 2 / v) ** (-(v + 1) / 2)) AS p
        FROM (SELECT holiday_date, holiday_name, count(*) AS sample_days, count(*) - 1e0 AS v,
                CASE WHEN count(*) >= 5 THEN (avg(n) - total_trips_holiday) / (stddev_samp(n) / sqrt(count(*))) END AS t
            FROM summary JOIN (SELECT ride_date, count(*) AS n FROM trips GROUP BY 1) d
                ON d.ride_date BETWEEN baseline_start_date AND baseline_end_date AND d.ride_date <> holiday_date
            WHERE isodow(d.ride_date) <= 5 GROUP BY holiday_date, holiday_name, total_trips_holiday),
            (SELECT unnest(generate_series(0, 2000)) AS i)
        GROUP BY holiday_date, holiday_name, sample_days, t)""",
    "summary",
    "trips",
)


def corr(x: str, name: str) -> str:
    known = f"FILTER ({x} IS NOT NULL)"
    still = " OR ".join(f"min({c}) {known} = max({c}) {known}" for c in (x, "trips_total"))
    return r(f"CASE WHEN count(*) {known} < 2 THEN 0 WHEN {still} THEN NULL ELSE corr(trips_total, {x}) END", name)


SQL["weather_correlation"] = query(
    f"SELECT {corr('temp_avg', 'temp_corr')}, {corr('precip', 'precip_corr')}, {corr('wind_max', 'wind_corr')} FROM effect",
    "effect",
)
DAYS_KEPT = "(VALUES ('rainy', 1), ('dry', 0)) AS k(days_kept, kept_rain)"
SQL["weather_correlation_by_rain"] = query(
    f"""SELECT days_kept, {corr('temp_avg', 'temp_corr')}, {corr('precip', 'precip_corr')}, {corr('wind_max', 'wind_corr')}
    FROM {DAYS_KEPT} LEFT JOIN effect ON is_rain = kept_rain GROUP BY days_kept""",
    "effect",
)
SQL["whatif_by_rain"] = query(
    f"""SELECT days_kept, {rs('temp_delta', 'slope', 'intercept')}, {r('slope * (x + temp_delta) + intercept', 'predicted_trips')},
    {r('slope * (x + temp_delta) + intercept - y', 'trip_change')}
    FROM (SELECT days_kept, regr_slope(trips_total, temp_avg) AS slope, regr_intercept(trips_total, temp_avg) AS intercept,
            avg(temp_avg) AS x, avg(trips_total) AS y FROM {DAYS_KEPT} JOIN effect ON is_rain = kept_rain
            WHERE temp_avg IS NOT NULL GROUP BY days_kept HAVING count(*) >= 2),
        (VALUES (-10e0), (-2.5e0), (0e0), (2.5e0), (10e0)) AS d(temp_delta)""",
    "effect",
)
SQL["complete_case_correlation"] = query(
    f"""SELECT {r('corr(temp_avg, trips_total)', 'temp_corr')}, {r('corr(precip, trips_total)', 'precip_corr')}
    FROM effect WHERE temp_avg IS NOT NULL AND precip IS NOT NULL""",
    "effect",
)
SQL["whatif_regression"] = query(
    f"""SELECT {rs('temp_delta', 'slope', 'intercept')}, {r('slope * (x + temp_delta) + intercept', 'predicted_trips')},
    {r('slope * (x + temp_delta) + intercept - y', 'trip_change')}
    FROM (SELECT regr_slope(trips_total, temp_avg) AS slope, regr_intercept(trips_total, temp_avg) AS intercept,
            avg(temp_avg) AS x, avg(trips_total) AS y FROM effect WHERE temp_avg IS NOT NULL),
        (VALUES (-10e0), (-2.5e0), (0e0), (2.5e0), (10e0)) AS d(temp_delta)""",
    "effect",
)
for name, x, by in (("trend_by_rain", "temp_avg", "is_rain"), ("trend_by_day_type", "precip", "day_type")):
    SQL[name] = query(
        f"""SELECT cast({by} AS varchar) AS series, {r(f'regr_slope(trips_total, {x})', 'slope')},
    {r(f'regr_intercept(trips_total, {x})', 'intercept')}, count(*) AS days FROM effect WHERE {x} IS NOT NULL GROUP BY {by}""",
        "effect",
    )
for name, by in (("bin_means_temperature", "temp_category"), ("bin_means_rain", "rain_category")):
    SQL[name] = query(
        f"""SELECT {by} AS category, {r('avg(trips_total)', 'avg_trips')}, count(*) AS days FROM effect
    GROUP BY {by} ORDER BY avg(trips_total) DESC, {by}""",
        "effect",
    )
cte(
    "hourly",
    """
    SELECT ride_date, cast(hour(started_at) AS bigint) AS hour_of_day, count(*) AS trips FROM trips GROUP BY ALL""",
    "trips",
)
FENCES = """SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median, quantile_cont({x}, 0.75) AS q3 FROM {t}"""
SQL["iqr_outliers"] = query(
    f"""SELECT ride_date, hour_of_day, trips FROM hourly, ({FENCES.format(x='trips', t='hourly')})
    WHERE trips < q1 - 1.5e0 * (q3 - q1) OR trips > q3 + 1.5e0 * (q3 - q1)""",
    "hourly",
)
BOUNDS = f"{r('q1 - 1.5e0 * (q3 - q1)', 'lower_bound')}, {r('q3 + 1.5e0 * (q3 - q1)', 'upper_bound')}"
SQL["iqr_bounds"] = query(
    f"SELECT {rs('q1', 'median', 'q3')}, {BOUNDS} FROM ({FENCES.format(x='trips_total', t='demand')})", "demand"
)
SQL["demand_distribution"] = query(
    f"""SELECT {rs('mean', 'median', 'std')}, min, max, {rs('q1', 'q3')}, {BOUNDS} FROM ({FENCES.format(x='trips_total', t='demand')}),
    (SELECT avg(trips_total) AS mean, stddev_samp(trips_total) AS std, min(trips_total) AS min, max(trips_total) AS max
        FROM demand)""",
    "demand",
)
SQL["demand_histogram"] = query(
    f"""SELECT bin, {r('lo + bin * (hi - lo) / 30', 'bin_start')}, {r('lo + (bin + 1) * (hi - lo) / 30', 'bin_end')},
    count(*) AS days
    FROM (SELECT lo, hi, cast(least(floor((trips_total - lo) * 30 / (hi - lo)), 29) AS bigint) AS bin
        FROM demand, (SELECT min(trips_total) AS lo, max(trips_total) AS hi FROM demand))
    GROUP BY bin, lo, hi""",
    "demand",
)
SQL["eda_summary"] = query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, count(*) - count({c}) AS nulls, {r(f'avg({c})', 'mean')},
    {r(f'stddev_samp({c})', 'std')}, {r(f'min({c})', 'min')}, {r(f'quantile_cont({c}, 0.25)', 'p25')},
    {r(f'quantile_cont({c}, 0.5)', 'median')}, {r(f'quantile_cont({c}, 0.75)', 'p75')}, {r(f'max({c})', 'max')} FROM demand"""
        for c in ("trips_total", "avg_duration_mins", "member_trips", "casual_trips")
    ),
    "demand",
)
SQL["eda_nulls"] = query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM effect"
        for c in (
            "date trips_total avg_duration_mins member_trips casual_trips day_of_week day_type tmax tmin temp_avg"
            " precip wind_max is_rain rain_category temp_category"
        ).split()
    ),
    "effect",
)
