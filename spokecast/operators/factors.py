"""Adjustment factors and the multiplicative forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokecast.functions import calendar as cal
from spokecast.functions import measures as m

# Factor names, descriptions and the condition each one averages over.
WEATHER_FACTORS = (
    ("hot_weather", "Temperature > 28°C", "avg_temp > 28"),
    ("neutral_weather", "Temperature 15-19°C", "avg_temp >= 15 and avg_temp < 20"),
    ("warm_weather", "Temperature 20-28°C", "avg_temp >= 20 and avg_temp <= 28"),
    ("cold_weather", "Temperature < 15°C", "avg_temp < 15"),
    ("light_rain", "Light rain (≤5 mm)", "total_precip > 0 and total_precip <= 5"),
    ("heavy_rain", "Heavy rain (>5 mm)", "total_precip > 5"),
    ("weak_wind", "Weak wind (≤15 km/h)", "avg_wind_speed <= 15"),
    ("strong_wind", "Strong wind (>15 km/h)", "avg_wind_speed > 15"),
    ("major_holiday", "Major holidays (Federal)", "holiday_types like '%Federal%' or holiday_types like '%Public%'"),
    ("minor_holiday", "Minor holidays (Local)", "holiday_types = 'Local'"),
)

# The choices a forecast offers and the factor behind each.
FORECAST_CHOICES = {
    "temperature": (
        ("Cold (<15°C)", "cold_weather"),
        ("Neutral (15-19°C)", "neutral_weather"),
        ("Warm (20-28°C)", "warm_weather"),
        ("Hot (>28°C)", "hot_weather"),
    ),
    "wind": (("Weak (≤15 km/h)", "weak_wind"), ("Strong (>15 km/h)", "strong_wind")),
    "rain": (("None", None), ("Light (≤5 mm)", "light_rain"), ("Heavy (>5 mm)", "heavy_rain")),
    "holiday": (
        ("None", None),
        ("Minor Holiday (Local)", "minor_holiday"),
        ("Major Holiday (Federal)", "major_holiday"),
    ),
}
SLOTS = ("day", *FORECAST_CHOICES)


def daily_conditions(
    trips: DataFrame, weather: DataFrame, holidays: DataFrame, per_day_weather: bool = False
) -> DataFrame:
    """Trips per day with the day's weather and holiday.

    The mart sums precipitation once per trip; trips are counted per day first and the
    count multiplies the day's figure, so weather never meets single trips.
    ``per_day_weather=True`` takes the day's figure itself.
    """
    days = trips.groupBy("ride_date").agg(F.count(F.lit(1)).alias("day_trips"))
    return daily_conditions_from_days(days, weather, holidays, per_day_weather)


def daily_conditions_from_days(
    days: DataFrame, weather: DataFrame, holidays: DataFrame, per_day_weather: bool = False
) -> DataFrame:
    """The same from days already counted (``ride_date``, ``day_trips``)."""
    sky = weather.groupBy(F.col("date").alias("ride_date")).agg(
        F.count(F.lit(1)).alias("readings"),
        F.avg("tmax").alias("avg_temp"),
        F.sum("precip").alias("precip"),
        F.avg("wind_max").alias("avg_wind_speed"),
    )
    feast = holidays.select(F.col("date").alias("ride_date"), "holiday_name", "holiday_types")
    return (
        days.join(sky, "ride_date", "left")
        .join(feast, "ride_date", "left")
        .select(
            F.col("ride_date").alias("trip_date"),
            (F.col("day_trips") * F.coalesce("readings", F.lit(1))).alias("total_trips"),
            "avg_temp",
            (F.col("precip") * (1 if per_day_weather else F.col("day_trips"))).alias("total_precip"),
            "avg_wind_speed",
            F.when(F.col("holiday_name").isNotNull(), 1).otherwise(0).alias("is_holiday"),
            "holiday_types",
        )
    )


def adjustment_factors(conditions: DataFrame) -> DataFrame:
    """Seventeen factors from one aggregate over the days.

    Conditions without any day give 0 per cent; an absent weekday gives null.
    """
    total = F.col("total_trips")
    weekday = [
        (name.lower(), name, (cal.day_number(F.col("trip_date")) == n)) for n, name in enumerate(cal.DAY_NAMES)
    ]
    rules = [(n, d, F.expr(c), True) for n, d, c in WEATHER_FACTORS] + [(n, d, c, False) for n, d, c in weekday]
    means = conditions.agg(
        F.avg(total).alias("overall"), *[F.avg(F.when(rule, total)).alias(name) for name, _, rule, _ in rules]
    )

    def impact(name: str, zero: bool) -> Column:
        pct = F.round((F.col(name) / F.col("overall") - 1) * 100, 1)
        return F.coalesce(pct, F.lit(0.0)) if zero else pct

    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("factor_name"),
                F.lit(text).alias("description"),
                impact(name, zero).alias("impact_pct"),
            )
            for name, text, _, zero in rules
        ]
    )
    return (
        means.select(F.explode(rows).alias("f"))
        .select("f.*")
        .withColumn("adjustment_multiplier", m.multiplier(F.col("impact_pct")))
        .withColumn("impact_label", m.impact_label(F.col("impact_pct")))
    )


def all_scenarios(spark: SparkSession) -> DataFrame:
    """Every combination of the forecast's choices: 7 x 4 x 2 x 3 x 3 rows."""

    def options(values) -> Column:
        return F.explode(
            F.array(
                *[
                    F.struct(F.lit(label).alias("label"), F.lit(factor).cast("string").alias("factor"))
                    for label, factor in values
                ]
            )
        )

    days = [
        F.struct(F.lit(name).alias("label"), F.lit(name.lower()).alias("factor"), F.lit(n).alias("num"))
        for n, name in enumerate(cal.DAY_NAMES)
    ]
    grid = spark.range(1).select(F.explode(F.array(*days)).alias("day"))
    for slot, values in FORECAST_CHOICES.items():
        grid = grid.withColumn(slot, options(values))
    return grid.select(
        F.col("day.num").cast("bigint").alias("day_of_week"),
        *[F.col(f"{s}.label").alias(s) for s in SLOTS],
        *[F.col(f"{s}.factor").alias(f"{s}_factor_name") for s in SLOTS],
    )


def scenario_factors(scenarios: DataFrame, factors: DataFrame) -> DataFrame:
    """Scenarios with one multiplier per choice and their product.

    Choices are looked up in one join; a choice without a factor counts 1.0.  A factor that
    is null (a weekday never seen) makes the product null.
    """
    picks = F.array(
        *[F.struct(F.lit(s).alias("slot"), F.col(f"{s}_factor_name").alias("factor_name")) for s in SLOTS]
    )
    keys = ["day_of_week", *SLOTS]
    value = F.when(F.col("known"), F.col("adjustment_multiplier")).otherwise(F.lit(1.0))
    looked_up = (
        scenarios.select(*keys, F.explode(picks).alias("p"))
        .select(*keys, "p.*")
        .join(
            factors.select("factor_name", "adjustment_multiplier", F.lit(True).alias("known")), "factor_name", "left"
        )
        .withColumn("value", value)
    )
    product = F.lit(1.0)
    for s in SLOTS:
        product = product * F.col(f"{s}_factor")
    return (
        looked_up.groupBy(*keys)
        .agg(*[F.max(F.when(F.col("slot") == s, F.col("value"))).alias(f"{s}_factor") for s in SLOTS])
        .withColumn("combined_factor", product)
    )


def factor_effects(scenarios: DataFrame) -> DataFrame:
    """Each factor's effect in per cent, one decimal."""
    names = [*[f"{s}_factor" for s in SLOTS], "combined_factor"]
    return scenarios.select(
        "day_of_week",
        *SLOTS,
        *[F.round((F.col(n) - 1) * 100, 1).alias(n.replace("_factor", "_effect_pct")) for n in names],
    )


def forecast(net_flow: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Adjusted net flow and advice for every cluster, hour and scenario.

    Scenarios meet the baseline by weekday.  The day factor multiplies a baseline that is
    already per weekday, as the forecast defines it.
    """
    net = F.col("adjusted_net_flow")
    return (
        net_flow.join(scenarios, "day_of_week")
        .withColumn("adjusted_net_flow", F.col("net_flow") * F.col("combined_factor"))
        .select(
            "cluster_id",
            "day_of_week",
            "hour",
            "hour_label",
            *SLOTS,
            "net_flow",
            "combined_factor",
            "adjusted_net_flow",
            m.forecast_move(net).alias("bikes_to_add_or_remove"),
            m.forecast_move_text(net).alias("recommendation"),
        )
    )


def forecast_for(grid: DataFrame, cluster_id: int, **choices: str) -> DataFrame:
    """The 24 hours of one cluster under the chosen options."""
    picked = grid.filter(F.col("cluster_id") == cluster_id)
    for slot, label in choices.items():
        picked = picked.filter(F.col(slot) == label)
    return picked.orderBy("hour")
