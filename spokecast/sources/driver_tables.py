"""Raw inputs in the library's layouts, derived from the star-schema test tables.

``events`` become trips (start station from the user, length from the value), ``nation``
games, days of ``events`` weather; ``orders`` become large holiday, schedule and weather
inputs.  Every derivation is a plain projection of whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokecast.sources.tables import literal_table

# Venues placed on two stations of the derived trips.
TEST_STADIUMS = (
    (1, "Yankee Stadium", "1 E 161st St, Bronx, NY 10451", 40.693, -74.001, "Bronx", "NY"),
    (2, "Citi Field", "41 Seaver Way, Queens, NY 11368", 40.719, -73.943, "Queens", "NY"),
)


# Layouts of the tables read here; stating them saves a job per read.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event; some ends are unknown, some names vary."""
    numbered = load(spark, sf_dir, "events").selectExpr(
        "*", "user_id % 40 as s", "case when event_id % 17 <> 0 then (user_id * 7 + event_id) % 43 end as e"
    )
    return numbered.selectExpr(
        "event_id as ride_id",
        "if(event_type = 'purchase', 'electric_bike', 'classic_bike') as rideable_type",
        "ts as started_at",
        "timestampadd(SECOND, floor(value * 60 + 0.5D), ts) as ended_at",
        "concat('S', s) as start_station_id",
        "concat('Station ', s, if(event_id % 11 = 0, ' (temp)', '')) as start_station_name",
        "concat('S', e) as end_station_id",
        "concat('Station ', e) as end_station_name",
        "(40680 + s * 13 % 130) / 1000D as start_lat",
        "(s * 29 % 200 - 74030) / 1000D as start_lng",
        "(40680 + e * 13 % 130) / 1000D as end_lat",
        "(e * 29 % 200 - 74030) / 1000D as end_lng",
        "if(event_type in ('view', 'click'), 'member', 'casual') as member_casual",
    )


def customer_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station per customer, spread over the city's box; a few lie at one place, some have no coordinates."""
    return load(spark, sf_dir, "customer").selectExpr(
        "concat('C', c_custkey) as station_id",
        "concat('Corner ', c_custkey) as station_name",
        "if(c_custkey % 97 = 0, null, (40500 + c_custkey * 7919 % 410) / 1000D) as latitude",
        "(c_custkey * 104729 % 530 - 74250) / 1000D as longitude",
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day of the events, with gaps and a contradiction."""
    days = load(spark, sf_dir, "events").selectExpr("to_date(ts) as date").distinct()
    return days.selectExpr("date", "day(date) as d").selectExpr(
        "date",
        "case when d % 13 <> 0 then (d * 37 % 350) / 10D - 5 end as tmax",
        "case when d % 11 <> 0 then (d * 37 % 350) / 10D - 5 - (d * 13 % 90) / 10D + if(d % 17 = 0, 20, 0) end as tmin",
        "if(d % 3 = 0, (d * 7 % 200) / 10D, 0D) as precip",
        "(d * 11 % 300) / 10D as wind_max",
    )


def raw_holidays(spark: SparkSession) -> DataFrame:
    """The holidays beside the events' month; two share a date."""
    return literal_table(
        spark,
        [
            ("2024-01-01", "New Year", "Public", 2024),
            ("2024-01-15", "Civic Day", "Federal,Optional", 2024),
            ("2024-01-15", "Parade", "Local", 2024),
            ("2024-01-26", "Founders Day", "Local", 2024),
        ],
        "date string, holiday_name string, holiday_types string, source_year int",
    )


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A game per nation, on every second January evening; some evenings have two."""
    n = F.col("n_nationkey")
    start = F.lit("2024-01-02 19:00:00").cast("timestamp_ntz") + F.make_dt_interval(n * 2 % 28, F.lit(0), n * 7 % 60)
    return load(spark, sf_dir, "nation").select(
        n.alias("game_id"),
        F.when(n % 2 == 0, 147).otherwise(121).alias("home_team_id"),
        F.when(n % 2 == 0, "Yankees").otherwise("Mets").alias("home_team_name"),
        F.col("n_name").alias("away_team_name"),
        F.when(n % 5 == 0, "Away Park")
        .when(n % 2 == 0, "Yankee Stadium II")
        .otherwise("Citi Field NY")
        .alias("venue_name"),
        start.alias("game_datetime"),
        F.to_date(start).cast("string").alias("game_date"),
    )


def order_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A holiday record per order, many to a date, of mixed types."""
    kind = F.substring("o_orderpriority", 1, 1)
    return load(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").cast("string").alias("date"),
        F.concat(F.lit("Day "), F.col("o_custkey") % 50).alias("holiday_name"),
        F.when(kind == "1", "Public").when(kind == "2", "Federal,Optional").when(kind == "3", "Local")
        .when(kind == "5", "Observance").alias("holiday_types"),
        F.year("o_orderdate").alias("source_year"),
    )


def order_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A game per order at a time of day spread over the clock."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    clock = F.make_dt_interval(F.lit(0), F.lit(0), (key * 37 % 1440).cast("int"), (key * 13 % 60).cast("int"))
    return load(spark, sf_dir, "orders").select(
        key.alias("game_id"),
        F.when(customer % 3 == 0, 147).when(customer % 3 == 1, 121).otherwise(110).alias("home_team_id"),
        F.when(customer % 4 == 0, "New Yankee Stadium")
        .when(customer % 4 == 1, "Citi Field NY")
        .when(customer % 4 == 2, "London Stadium")
        .alias("venue_name"),
        (F.col("o_orderdate").cast("timestamp_ntz") + clock).alias("game_datetime"),
    )


def order_weather_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weather response per order: three dates, short arrays, absent fields or no data."""
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    high = (key * 37 % 350).cast("double") / 10 - 5
    daily = F.struct(
        F.array(*[F.date_add(day, i).cast("string") for i in range(3)]).alias("time"),
        F.array(high, high + 1).alias("temperature_2m_max"),
        F.array(high - 4, F.lit(None).cast("double"), high - 2).alias("temperature_2m_min"),
        F.when(key % 5 != 0, F.array(*[(key % 30 + i).cast("double") / 2 for i in range(3)])).alias("precipitation_sum"),
        F.array((key % 90).cast("double") / 4).alias("wind_speed_10m_max"),
    )
    body = F.when(key % 7 == 0, F.lit('{"error": "No data"}')).otherwise(
        F.to_json(F.struct(daily.alias("daily")), {"ignoreNullFields": "false"})
    )
    return load(spark, sf_dir, "orders").select(key, body.alias("body"))


def order_holiday_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A holiday response per order with one or two entries, spread over many dates."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    day = F.date_add(F.to_date("o_orderdate"), (customer % 5 * 1000).cast("int"))

    def entry(i: int) -> Column:
        return F.struct(
            day.cast("string").alias("date"),
            F.concat(F.lit("H"), (customer + i) % 7).alias("name"),
            F.when(customer % 6 != i, F.concat(F.lit("L"), customer % 5)).alias("localName"),
            F.lit("US").alias("countryCode"),
            (key % 2 == i).alias("fixed"),
            (customer % 9 == i).alias("global"),
            F.when(key % 3 == 0, F.array(F.lit("Optional"), F.lit("Public")))
            .when(key % 3 == 1, F.array(F.lit("School"), F.lit("Federal")))
            .otherwise(F.array(F.lit("Local")))
            .alias("types"),
            F.when(
                customer % 4 != 0, F.array(F.concat(F.lit("US-"), customer % 8), F.concat(F.lit("US-"), customer % 3))
            ).alias("counties"),
            F.when(customer % 3 == 0, (1900 + key % 100).cast("int")).alias("launchYear"),
        )

    body = F.when(key % 4 == 0, F.to_json(F.array(entry(0), entry(1)))).otherwise(F.to_json(F.array(entry(0))))
    return load(spark, sf_dir, "orders").select(key, F.year(day).alias("source_year"), body.alias("body"))


def order_schedule_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule response per order, asked for one team: a home game and an away game."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    asked = F.when(customer % 2 == 0, 147).otherwise(121)

    def team(number: Column, name: Column) -> Column:
        return F.struct(F.struct(number.cast("int").alias("id"), name.alias("name")).alias("team"))

    def game(number: Column, home: Column, away: Column) -> Column:
        return F.struct(
            number.alias("gamePk"),
            F.concat(F.to_date("o_orderdate").cast("string"), F.lit("T23:05:00Z")).alias("gameDate"),
            F.to_date("o_orderdate").cast("string").alias("officialDate"),
            F.year("o_orderdate").cast("string").alias("season"),
            F.lit("R").alias("gameType"),
            F.when(key % 5 != 0, F.struct(F.col("o_orderstatus").alias("detailedState"))).alias("status"),
            F.struct(
                team(home, F.concat(F.lit("Team "), home)).alias("home"),
                team(away, F.concat(F.lit("Team "), away)).alias("away"),
            ).alias("teams"),
            F.struct((customer % 30).cast("int").alias("id"), F.concat(F.lit("Park "), customer % 30).alias("name")).alias(
                "venue"
            ),
        )

    other = (100 + customer % 20).cast("int")
    games = F.array(game(key * 2, asked, other), game(key * 2 + 1, other, asked))
    body = F.to_json(F.struct(F.array(F.struct(games.alias("games"))).alias("dates")))
    return load(spark, sf_dir, "orders").select(asked.alias("team_id"), body.alias("body"))


def station_clusters_by_rule(stations: DataFrame) -> DataFrame:
    """Five clusters by station number: a fixed assignment SQL can repeat."""
    number = F.substring("station_id", 2, 10).cast("int")
    return stations.select("station_id", (number % 5).alias("cluster_id"))
