"""Loads of landed files into the four raw tables (A1-A10).

Each load parses what a period needs and merges it by key, so a rerun replaces the same
rows.  Tables are stored by month, year or season; a load rewrites only the partitions it
touches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokecast.sources import api_json, periods, trip_files
from spokecast.sources.merge import read_table, upsert_partitions

# Key and partition of each raw table.
TABLES = {
    "bike_trips": ("ride_id", "source_month"),
    "weather": ("date", "source_month"),
    "holidays": ("date", "source_year"),
    "games": ("game_id", "season"),
}


def _merge(spark: SparkSession, root: str, table: str, batch: DataFrame) -> None:
    key, partition = TABLES[table]
    # Later load first; the remaining columns settle equal loads the same way in every run.
    rest = [c for c in batch.columns if c not in (key, "_dlt_load_timestamp")]
    newest = [F.desc("_dlt_load_timestamp"), *[F.desc(c) for c in rest]]
    upsert_partitions(spark, f"{root}/{table}", batch, [key], partition, newest)


def load_trips(spark: SparkSession, pattern: str, start: str, end: str, root: str) -> None:
    """Monthly CSV files of a period; ``pattern`` has ``{month}``.  Absent months are skipped."""
    months = periods.months_between(spark, start, end)
    _merge(spark, root, "bike_trips", trip_files.read_months(spark, pattern, months))


def load_weather(spark: SparkSession, path: str, location: str, root: str) -> None:
    """Weather responses below ``path``."""
    days = api_json.parse_weather(api_json.read_bodies(spark, path), location)
    month = F.concat(F.substring("date", 1, 4), F.substring("date", 6, 2))
    _merge(spark, root, "weather", days.withColumn("source_month", month))


def load_holidays(spark: SparkSession, pattern: str, start: str, end: str, root: str) -> None:
    """Yearly holiday responses of a period, each year's newest; ``pattern`` has ``{year}``."""
    responses = [
        api_json.read_bodies(spark, pattern.format(year=year)).withColumn("source_year", F.lit(year))
        for year in periods.years_between(start, end)
    ]
    if not responses:
        raise FileNotFoundError(f"no holiday responses from {start} to {end}")
    newest = api_json.newest_response(reduce(DataFrame.unionByName, responses), "source_year")
    entries = api_json.parse_holidays(newest)
    _merge(spark, root, "holidays", api_json.merge_holidays(entries))


def load_games(spark: SparkSession, path: str, root: str, team_ids: tuple[int, ...] = api_json.HOME_TEAMS) -> None:
    """Schedule responses below ``path``; home games of the given teams."""
    _merge(spark, root, "games", api_json.parse_schedule(api_json.read_bodies(spark, path), team_ids))


def raw_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The raw tables by name, ready for the refresh."""
    return {name: read_table(spark, f"{root}/{name}", partition) for name, (_, partition) in TABLES.items()}
