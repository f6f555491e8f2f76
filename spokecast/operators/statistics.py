"""Figures behind the home, weather and exploration pages.

Exact quantiles keep one entry per distinct value, so they belong on marts of days or hours,
whose size the calendar sets; ``approximate=True`` is the form for anything larger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Outlier fence and histogram size.
FENCE = 1.5
BINS = 30


def home_kpis(demand: DataFrame) -> DataFrame:
    """Totals, means and the member share over all days."""
    trips, members = F.sum("trips_total"), F.sum("member_trips")
    return demand.agg(
        trips.alias("total_trips"),
        F.avg("trips_total").alias("avg_daily_trips"),
        F.avg("avg_duration_mins").alias("avg_duration"),
        F.coalesce(F.when(trips > 0, members / trips * 100), F.lit(0.0)).alias("member_pct"),
        members.alias("member_trips"),
        F.sum("casual_trips").alias("casual_trips"),
    )


def trips_by_day_type(demand: DataFrame) -> DataFrame:
    """Total, mean and deviation of daily trips per day type."""
    return demand.groupBy("day_type").agg(
        F.sum("trips_total").alias("trips_total"),
        F.avg("trips_total").alias("avg_trips"),
        F.stddev_samp("trips_total").alias("std_trips"),
    )


def bin_means(effect: DataFrame, by: str) -> DataFrame:
    """Mean trips and days per weather bin, largest first."""
    return (
        effect.groupBy(F.col(by).alias("category"))
        .agg(F.avg("trips_total").alias("avg_trips"), F.count("trips_total").alias("days"))
        .orderBy(F.desc("avg_trips"), "category")
    )


def _pearson(x: str, y: str) -> Column:
    """Correlation over rows where both are known (K4).

    Fewer than two rows give 0; a side that does not vary, such as the rain of dry days, gives null.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double"))
    return F.when(F.count(F.when(both, 1)) < 2, F.lit(0.0)).otherwise(
        F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    )


def correlations(effect: DataFrame) -> DataFrame:
    """Correlation of daily trips with temperature, rain and wind, in one pass (K4)."""
    return effect.agg(
        _pearson("trips_total", "temp_avg").alias("temp_corr"),
        _pearson("trips_total", "precip").alias("precip_corr"),
        _pearson("trips_total", "wind_max").alias("wind_corr"),
    )


def complete_case_correlations(effect: DataFrame) -> DataFrame:
    """Correlations over days with both temperature and rain (K4)."""
    known = effect.dropna(subset=["temp_avg", "precip", "trips_total"])
    return known.agg(
        F.corr("temp_avg", "trips_total").alias("temp_corr"), F.corr("precip", "trips_total").alias("precip_corr")
    )


def what_if(effect: DataFrame, deltas: tuple[float, ...]) -> DataFrame:
    """Predicted daily trips when the mean temperature moves by each delta (K5)."""
    known = effect.dropna(subset=["temp_avg", "trips_total"])
    y, x = F.col("trips_total").cast("double"), F.col("temp_avg")
    fit = known.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.avg(x).alias("mean_temp"),
        F.avg(y).alias("mean_trips"),
        F.count(F.lit(1)).alias("days"),
    ).filter("days >= 2")
    steps = F.explode(F.array(*[F.lit(float(d)) for d in deltas]))
    predicted = F.col("slope") * (F.col("mean_temp") + F.col("temp_delta")) + F.col("intercept")
    return (
        fit.withColumn("temp_delta", steps)
        .withColumn("predicted_trips", predicted)
        .select(
            "temp_delta",
            "slope",
            "intercept",
            "predicted_trips",
            (F.col("predicted_trips") - F.col("mean_trips")).alias("trip_change"),
        )
    )


def trend_lines(effect: DataFrame, x: str, by: str) -> DataFrame:
    """Least-squares line of daily trips on ``x`` per group (K6)."""
    known = effect.filter(F.col(x).isNotNull())
    y = F.col("trips_total").cast("double")
    return known.groupBy(F.col(by).cast("string").alias("series")).agg(
        F.regr_slope(y, F.col(x)).alias("slope"),
        F.regr_intercept(y, F.col(x)).alias("intercept"),
        F.count(F.lit(1)).alias("days"),
    )


def _quartiles(column: str, approximate: bool, accuracy: int) -> Column:
    fractions = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    if approximate:
        return F.percentile_approx(column, fractions, F.lit(accuracy))
    return F.percentile(column, fractions)


def iqr_bounds(df: DataFrame, column: str, approximate: bool = False, accuracy: int = 10000) -> DataFrame:
    """Quartiles and the 1.5 IQR fences of a column, one row (K8).

    Exact quartiles are linearly interpolated; approximate ones come from a bounded sketch.
    """
    q = F.col("q")
    iqr = q[2] - q[0]
    return df.agg(_quartiles(column, approximate, accuracy).alias("q")).select(
        q[0].alias("q1"),
        q[1].alias("median"),
        q[2].alias("q3"),
        (q[0] - FENCE * iqr).alias("lower_bound"),
        (q[2] + FENCE * iqr).alias("upper_bound"),
    )


def iqr_outliers(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Rows outside the fences, which enter as scalar subqueries (K8)."""
    bounds = iqr_bounds(df, column, approximate)
    lower, upper = bounds.select("lower_bound").scalar(), bounds.select("upper_bound").scalar()
    return df.filter((F.col(column) < lower) | (F.col(column) > upper))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Mean, median, deviation, range and box figures of a column, one row (K9)."""
    q = F.col("q")
    iqr = q[2] - q[0]
    return df.agg(
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        _quartiles(column, False, 0).alias("q"),
    ).select(
        "mean",
        q[1].alias("median"),
        "std",
        "min",
        "max",
        q[0].alias("q1"),
        q[2].alias("q3"),
        (q[0] - FENCE * iqr).alias("lower_bound"),
        (q[2] + FENCE * iqr).alias("upper_bound"),
    )


def histogram(df: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """Counts in equal bins from minimum to maximum; the last bin is closed (K9).

    Empty bins are left out.
    """
    low = df.agg(F.min(column).cast("double")).scalar()
    high = df.agg(F.max(column).cast("double")).scalar()
    value = F.col(column).cast("double")
    width = (F.col("high") - F.col("low")) / bins
    bucket = F.when(F.col("high") == F.col("low"), 0).otherwise(
        F.least(F.floor((value - F.col("low")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    )
    return (
        df.filter(F.col(column).isNotNull())
        .withColumn("low", low)
        .withColumn("high", high)
        .groupBy(bucket.cast("bigint").alias("bin"), "low", "high")
        .agg(F.count(F.lit(1)).alias("days"))
        .select(
            "bin",
            (F.col("low") + F.col("bin") * width).alias("bin_start"),
            (F.col("low") + (F.col("bin") + 1) * width).alias("bin_end"),
            "days",
        )
    )


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """Count, nulls, mean, deviation, range and quartiles per numeric column, in one pass."""
    summaries = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n"),
                F.count(F.when(F.col(c).isNull(), 1)).alias("nulls"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.percentile(c, F.lit(0.25)).alias("p25"),
                F.percentile(c, F.lit(0.5)).alias("median"),
                F.percentile(c, F.lit(0.75)).alias("p75"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return summaries.select(F.explode(F.array(*columns)).alias("s")).select("s.*")


def null_counts(df: DataFrame) -> DataFrame:
    """Null count of every column."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    return counts.select(F.explode(rows).alias("r")).select("r.*")
