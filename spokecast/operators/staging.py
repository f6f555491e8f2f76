"""Cleaning of the four raw tables (M1-M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spokecast.functions import calendar as cal

# Accepted ride length, team ids, weekday rules for the yearly local events.
MIN_RIDE_SECONDS = 60
MAX_RIDE_SECONDS = 720 * 60
YANKEES_ID = 147
METS_ID = 121
HOME_VENUES = ("Yankee Stadium", "Citi Field")
MARATHON = "NYC Marathon"
PARADE = "Puerto Rican Day Parade"

TRIP_COLUMNS = (
    "start_station_id",
    "start_station_name",
    "start_lat",
    "start_lng",
    "end_station_id",
    "end_station_name",
    "end_lat",
    "end_lng",
    "member_casual",
)
HOLIDAY_COLUMNS = {
    "holiday_name": "string",
    "local_name": "string",
    "country_code": "string",
    "is_fixed": "boolean",
    "is_global": "boolean",
    "counties": "string",
    "holiday_types": "string",
    "source_year": "int",
    "_dlt_load_timestamp": "timestamp",
}
METADATA_COLUMNS = ("_dlt_load_timestamp", "source_month", "source_location", "source_api")


def _present(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [n for n in names if n in df.columns]


def clean_trips(raw: DataFrame) -> DataFrame:
    """Trips with both times, in order, lasting 1 to 720 minutes (B1).

    Null checks reach the Parquet scan; the length is recomputed from the times.
    """
    seconds = cal.seconds_between(F.col("started_at"), F.col("ended_at"))
    return (
        raw.filter("started_at is not null and ended_at is not null and ended_at >= started_at")
        .filter(seconds.between(MIN_RIDE_SECONDS, MAX_RIDE_SECONDS))
        .select(
            "ride_id",
            "started_at",
            "ended_at",
            F.to_date("started_at").alias("ride_date"),
            (seconds / 60.0).cast("double").alias("ride_mins"),
            *_present(raw, TRIP_COLUMNS),
            *_present(raw, METADATA_COLUMNS),
        )
    )


def clean_weather(raw: DataFrame) -> DataFrame:
    """Dated days whose temperatures do not contradict each other; gaps are kept (B2)."""
    return raw.filter("date is not null and (tmax is null or tmin is null or tmax >= tmin)").select(
        F.to_date("date").alias("date"), "tmax", "tmin", "precip", "wind_max", *_present(raw, METADATA_COLUMNS)
    )


def rule_holidays(years: DataFrame) -> DataFrame:
    """Local events fixed by a weekday rule, for each ``source_year``."""
    year = F.col("source_year").cast("int")
    rules = F.array(
        F.struct(F.lit(MARATHON).alias("holiday_name"), cal.first_sunday(year, 11).alias("date")),
        F.struct(F.lit(PARADE).alias("holiday_name"), F.date_add(cal.first_sunday(year, 6), 7).alias("date")),
    )
    return (
        years.select("source_year")
        .distinct()
        .select(year.alias("source_year"), F.explode(rules).alias("r"))
        .select(
            "r.date",
            "r.holiday_name",
            F.col("r.holiday_name").alias("local_name"),
            F.lit("US").alias("country_code"),
            F.lit(False).alias("is_fixed"),
            F.lit(False).alias("is_global"),
            F.lit("US-NY").alias("counties"),
            F.lit("Local").alias("holiday_types"),
            "source_year",
            F.current_timestamp().alias("_dlt_load_timestamp"),
        )
    )


def stage_holidays(raw: DataFrame) -> DataFrame:
    """API and rule holidays, one per date: Public, then Federal, then by name.

    Dates are cast before the union, so a clash between the two origins is seen.
    ``row_number() = 1`` is planned with a group limit before the shuffle, so a date
    shared by many rows sends one row per task.
    """
    api = raw.select(
        F.to_date("date").alias("date"),
        *[
            (F.col(c) if c in raw.columns else F.lit(None)).cast(t).alias(c)
            for c, t in HOLIDAY_COLUMNS.items()
        ],
    )
    both = api.unionByName(rule_holidays(raw.select("source_year")))
    types = F.col("holiday_types")
    priority = F.when(types.like("%Public%"), 1).when(types.like("%Federal%"), 2).otherwise(3)
    first = Window.partitionBy("date").orderBy(
        priority, F.col("holiday_name").asc_nulls_last(), "holiday_types", "counties", "source_year"
    )
    major = F.coalesce(types.like("%Public%") | types.like("%Federal%"), F.lit(False))
    return (
        both.withColumn("row_num", F.row_number().over(first))
        .filter("row_num = 1")
        .select(
            "date",
            *[c for c in HOLIDAY_COLUMNS if c not in ("source_year", "_dlt_load_timestamp")],
            major.alias("is_major"),
            (~major).alias("is_working_day"),
            "source_year",
            "_dlt_load_timestamp",
        )
    )


def stage_games(raw: DataFrame, tz: str | None = None) -> DataFrame:
    """Games on the rounded start hour, with end estimate, team flags and venue name.

    ``tz`` moves UTC start times to a local zone first; by default they are taken as they are.
    """
    original = F.col("game_datetime").cast("timestamp_ntz")
    if tz is not None:
        original = F.convert_timezone(F.lit("UTC"), F.lit(tz), original)
    venue = F.col("venue_name")
    passed = (
        "season",
        "game_type",
        "game_status",
        "home_team_id",
        "home_team_name",
        "away_team_id",
        "away_team_name",
        "venue_id",
        "venue_name",
    )
    timed = raw.withColumn("game_datetime_original", original).withColumn(
        "game_datetime_rounded", cal.nearest_hour(F.col("game_datetime_original"))
    )
    start = F.col("game_datetime_rounded")
    return timed.select(
        "game_id",
        start,
        "game_datetime_original",
        F.to_date(start).alias("game_date"),
        F.hour(start).cast("bigint").alias("game_hour"),
        F.concat(F.lpad(F.hour(start).cast("string"), 2, "0"), F.lit(":00:00")).alias("game_time"),
        *_present(raw, passed),
        (start + cal.hours(3)).alias("estimated_end_datetime"),
        F.coalesce(F.col("home_team_id") == YANKEES_ID, F.lit(False)).alias("is_yankees_home"),
        F.coalesce(F.col("home_team_id") == METS_ID, F.lit(False)).alias("is_mets_home"),
        F.when(venue.like("%Yankee%"), HOME_VENUES[0])
        .when(venue.like("%Citi Field%"), HOME_VENUES[1])
        .otherwise(venue)
        .alias("stadium_name"),
        *_present(raw, METADATA_COLUMNS),
    )


def home_games(games: DataFrame) -> DataFrame:
    """Games at the two venues the event marts cover."""
    return games.filter(F.col("stadium_name").isin(*HOME_VENUES))
