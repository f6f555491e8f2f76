"""Which month and year partitions a period covers (A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def month_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Months from ``start`` to ``end`` as ``YYYYMM``, each once, in order.

    Both ends are cut to their month, so month ends of any length are covered.
    """
    first, last = F.trunc(F.lit(start).cast("date"), "MM"), F.trunc(F.lit(end).cast("date"), "MM")
    months = F.sequence(first, last, F.expr("interval 1 month"))
    listed = F.when(first <= last, months).otherwise(F.array().cast("array<date>"))
    return (
        spark.range(1)
        .select(F.explode(listed).alias("month_start"))
        .select(
            F.date_format("month_start", "yyyyMM").alias("source_month"),
            F.year("month_start").alias("source_year"),
            "month_start",
        )
        # Says nothing new, but tells Spark that the calendar is worth pruning a partitioned table by.
        .where(F.col("month_start") >= first)
    )


def months_between(spark: SparkSession, start: str, end: str) -> list[str]:
    """The calendar's months as a list, one entry per month of the period."""
    return [r["source_month"] for r in month_calendar(spark, start, end).orderBy("source_month").collect()]


def years_between(start: str, end: str) -> list[int]:
    """Years a period touches."""
    return list(range(int(start[:4]), int(end[:4]) + 1))


def in_period(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows of the calendar's months; of a table partitioned by month only their files are read.

    The calendar has a row for each month of a period, so it is small; Spark finds the partitions at run time
    (dynamic partition pruning), whatever computed the calendar.
    """
    return df.join(F.broadcast(calendar.select("source_month")), "source_month", "left_semi")
