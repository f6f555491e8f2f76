"""Landed API responses: weather, holidays and game schedules.

Each reader takes a DataFrame with one response text per row (``body``), so many response
files are parsed in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Response layouts, team ids and the order of holiday types.
WEATHER_SCHEMA = (
    "daily struct<time:array<string>, temperature_2m_max:array<double>, temperature_2m_min:array<double>,"
    " precipitation_sum:array<double>, wind_speed_10m_max:array<double>>"
)
WEATHER_FIELDS = {
    "tmax": "temperature_2m_max",
    "tmin": "temperature_2m_min",
    "precip": "precipitation_sum",
    "wind_max": "wind_speed_10m_max",
}
HOLIDAY_SCHEMA = (
    "array<struct<date:string, name:string, localName:string, countryCode:string, fixed:boolean, `global`:boolean,"
    " types:array<string>, counties:array<string>, launchYear:int>>"
)
TEAM = "struct<team:struct<id:int, name:string>>"
SCHEDULE_SCHEMA = (
    "dates array<struct<games:array<struct<gamePk:bigint, gameDate:string, officialDate:string, season:string,"
    f" gameType:string, status:struct<detailedState:string>, teams:struct<home:{TEAM}, away:{TEAM}>,"
    " venue:struct<id:int, name:string>>>>>"
)
HOME_TEAMS = (147, 121)
TYPE_ORDER = ("Public", "Federal")
SOURCE_API = "mlb_stats_api"


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Response files, one whole text per file, with the file they came from and its time."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )


def newest_response(responses: DataFrame, by: str) -> DataFrame:
    """Of the responses with equal ``by`` the one that landed last; entries of several are never merged."""
    order = Window.partitionBy(by).orderBy(F.desc("landed_at"), F.desc("source_file"))
    return responses.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def parse_weather(responses: DataFrame, location: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parallel arrays to one row per date; short arrays give nulls, no ``daily`` no rows (A5)."""
    daily = F.from_json("body", WEATHER_SCHEMA)["daily"]
    days = responses.select(*keep, daily.alias("d")).select(
        *keep, "d", F.posexplode("d.time").alias("at", "date")
    )
    return days.select(
        *keep,
        "date",
        *[F.get(f"d.{field}", F.col("at")).alias(name) for name, field in WEATHER_FIELDS.items()],
        F.current_timestamp().alias("_dlt_load_timestamp"),
        F.lit(location).cast("string").alias("source_location"),
    )


def parse_schedule(responses: DataFrame, team_ids: tuple[int, ...] = HOME_TEAMS) -> DataFrame:
    """Home games of the given teams from nested schedules.

    Missing levels give nulls.  A response may carry the team it was asked for as
    ``team_id``; its games then must be home games of just that team.
    """
    body = F.from_json("body", SCHEDULE_SCHEMA)
    asked = ["team_id"] if "team_id" in responses.columns else []
    games = (
        responses.select(*asked, F.explode(body["dates"]).alias("day"))
        .select(*asked, F.explode("day.games").alias("g"))
        .withColumn("home", F.col("g.teams.home.team"))
        .withColumn("away", F.col("g.teams.away.team"))
        .filter(F.col("home.id").isin(*team_ids))
    )
    if asked:
        games = games.filter("home.id = team_id")
    return games.select(
        F.col("g.gamePk").alias("game_id"),
        F.substring("g.gameDate", 1, 10).alias("game_date"),
        F.col("g.gameDate").alias("game_datetime"),
        F.col("g.officialDate").alias("official_date"),
        F.col("g.season").alias("season"),
        F.col("g.gameType").alias("game_type"),
        F.col("g.status.detailedState").alias("game_status"),
        F.col("home.id").alias("home_team_id"),
        F.col("home.name").alias("home_team_name"),
        F.col("away.id").alias("away_team_id"),
        F.col("away.name").alias("away_team_name"),
        F.col("g.venue.id").alias("venue_id"),
        F.col("g.venue.name").alias("venue_name"),
        F.current_timestamp().alias("_dlt_load_timestamp"),
        F.lit(SOURCE_API).alias("source_api"),
    )


def parse_holidays(responses: DataFrame, keep: tuple[str, ...] = ("source_year",)) -> DataFrame:
    """Holiday arrays to rows, keeping their place in the response as ``position``.

    ``source_year`` (and any other ``keep`` column) is taken over from the response row.
    """
    return responses.select(
        *keep, F.posexplode(F.from_json("body", HOLIDAY_SCHEMA)).alias("position", "h")
    ).select(
        *keep,
        "position",
        "h.date",
        "h.name",
        "h.localName",
        "h.countryCode",
        F.col("h.fixed"),
        F.col("h.global"),
        "h.types",
        "h.counties",
        "h.launchYear",
    )


def _non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _joined(items: Column) -> Column:
    """A CSV text of an array; null when it is null or empty."""
    return F.when(F.size(items) > 0, F.array_join(items, ","))


def merge_holidays(entries: DataFrame) -> DataFrame:
    """One row per year and date from ``parse_holidays`` rows.

    A lone holiday keeps its types and counties in source order.  Several on one date are
    merged: names in first-seen order, counties sorted, types Public, Federal, then by
    name, flags true if any is, the earliest launch year.

    Every entry becomes rows of (kind, value), cut to distinct values with their first place
    before a date is put together.  A date's lists hold distinct values only, however many
    entries it has, and the entries are read once.
    """
    day = ["source_year", "date"]

    # Names stay as they came here; empty ones are left out where they are listed.
    kinds = {
        "name": F.array("name"),
        "local": F.array("localName"),
        "country": F.array("countryCode"),
        "own_types": F.array(_joined(F.col("types"))),
        "own_counties": F.array(_joined(F.col("counties"))),
        "type": F.col("types"),
        "county": F.col("counties"),
    }
    flags = ("position", "fixed", "global", "launchYear")
    parts = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("values")) for k, v in kinds.items()])
    distinct = (
        entries.select(*day, *flags, F.explode(parts).alias("k"))
        .select(*day, *flags, "k.kind", F.explode("k.values").alias("value"))
        .groupBy(*day, "kind", "value")
        .agg(
            F.min("position").alias("position"),
            F.count(F.lit(1)).alias("entries"),
            F.bool_or("fixed").alias("fixed"),
            F.bool_or("global").alias("global"),
            F.min("launchYear").alias("launch_year"),
            F.min(F.nullif(F.col("launchYear"), F.lit(0))).alias("known_year"),
        )
    )
    type_rank = F.coalesce(
        *[F.when(F.col("value") == name, F.lit(i)) for i, name in enumerate(TYPE_ORDER)], F.lit(len(TYPE_ORDER))
    )

    def listed(kind: str, order: Column) -> Column:
        wanted = (F.col("kind") == kind) & _non_empty(F.col("value")).isNotNull()
        pairs = F.sort_array(F.collect_list(F.when(wanted, F.struct(order.alias("o"), "value"))))
        return F.transform(pairs, lambda p: p["value"]).alias(kind)

    def first(kind: str) -> Column:
        return F.min_by("value", F.when(F.col("kind") == kind, F.col("position")))

    dates = distinct.groupBy(*day).agg(
        F.sum(F.when(F.col("kind") == "country", F.col("entries"))).alias("n"),
        *[first(kind).alias(f"first_{kind}") for kind in ("name", "local", "country", "own_types", "own_counties")],
        listed("name", F.col("position")),
        listed("local", F.col("position")),
        listed("type", type_rank),
        listed("county", F.lit(0)),
        *[F.bool_or(c).alias(c) for c in ("fixed", "global")],
        *[F.min(c).alias(c) for c in ("launch_year", "known_year")],
    )

    def pick(single: Column, merged: Column) -> Column:
        return F.when(F.col("n") == 1, single).otherwise(merged)

    locals_ = F.when(F.size("local") > 0, F.array_join("local", " and ")).otherwise(F.col("first_local"))
    return dates.select(
        "date",
        pick(F.col("first_name"), F.array_join("name", " and ")).alias("holiday_name"),
        pick(F.col("first_local"), locals_).alias("local_name"),
        F.col("first_country").alias("country_code"),
        pick(F.col("fixed"), F.coalesce("fixed", F.lit(False))).alias("is_fixed"),
        pick(F.col("global"), F.coalesce("global", F.lit(False))).alias("is_global"),
        pick(F.col("first_own_counties"), _joined(F.col("county"))).alias("counties"),
        pick(F.col("launch_year"), F.col("known_year")).alias("launch_year"),
        pick(F.col("first_own_types"), _joined(F.col("type"))).alias("holiday_types"),
        F.current_timestamp().alias("_dlt_load_timestamp"),
        "source_year",
    )
