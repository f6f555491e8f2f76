"""Venues, distances and nearby stations (M7, M9)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokecast.functions import geo
from spokecast.sources.tables import literal_table

# The venue dimension and the walking radius.
STADIUM_SCHEMA = (
    "stadium_id int, stadium_name string, address string, latitude double, longitude double, city string, state string"
)
STADIUMS = (
    (1, "Yankee Stadium", "1 E 161st St, Bronx, NY 10451", 40.8296, -73.9265, "Bronx", "NY"),
    (2, "Citi Field", "41 Seaver Way, Queens, NY 11368", 40.7573, -73.8459, "Queens", "NY"),
)
WALKING_KM = 1.0
KM_PER_DEGREE = math.pi * geo.EARTH_RADIUS_KM / 180
#: By so much cells are larger than they must be.
MARGIN = 1.001


def dim_stadiums(spark: SparkSession, stadiums: tuple[tuple, ...] = STADIUMS) -> DataFrame:
    """The two venues."""
    return literal_table(spark, stadiums, STADIUM_SCHEMA).withColumn("geocoded_at", F.current_timestamp())


def station_proximity(
    stations: DataFrame, stadiums: tuple[tuple, ...] = STADIUMS, walking_km: float = WALKING_KM
) -> DataFrame:
    """Distance of every located station to every venue, and the walking flag.

    The venues are a literal list: each station row is exploded by it, so there is no join
    and the work is one pass over the stations.
    """
    venues = F.array(
        *[
            F.struct(
                F.lit(v[0]).alias("stadium_id"),
                F.lit(v[1]).alias("stadium_name"),
                F.lit(v[3]).alias("lat"),
                F.lit(v[4]).alias("lon"),
            )
            for v in stadiums
        ]
    )
    return (
        stations.filter("latitude is not null and longitude is not null")
        .withColumn("v", F.explode(venues))
        .select(
            "v.stadium_id",
            "v.stadium_name",
            "station_id",
            "station_name",
            geo.haversine_km(F.col("v.lat"), F.col("v.lon"), F.col("latitude"), F.col("longitude")).alias("distance_km"),
        )
        .withColumn("within_1km", F.col("distance_km") <= walking_km)
    )


def _width(row: Column, radius_km: float, height: float) -> Column:
    """Degrees of longitude that a circle around a point of this latitude row or one beside it reaches to, at most."""
    highest = F.least(F.greatest(F.abs((row - 1) * height), F.abs((row + 2) * height)), F.lit(90.0))
    share = F.lit(math.sin(radius_km / geo.EARTH_RADIUS_KM / 2)) / F.cos(F.radians(highest))
    return F.when(share < 1, F.degrees(2 * F.asin(F.least(share, F.lit(1.0)))) * MARGIN).otherwise(360.0)


def _columns(row: Column, radius_km: float, height: float) -> Column:
    """How many cells of that width or more go around the earth."""
    return F.greatest(F.floor(360 / F.least(_width(row, radius_km, height), F.lit(360.0))), F.lit(1)).cast("bigint")


def near_cells(venues: DataFrame, stations: DataFrame, radius_km: float) -> DataFrame:
    """Venue-station pairs in the same or neighbouring cells, each pair once, with those within the radius among them.

    Cells are as high as the radius and, at their latitude, as wide; a venue looks into its own and the eight
    around it, so the join is an equi-join and a pair costs no more than the stations of nine cells, wherever
    they lie, at the poles and across the date line too.
    """
    height = radius_km / KM_PER_DEGREE * MARGIN

    def cell(row: Column, lon: Column, aside: Column) -> Column:
        around = _columns(row, radius_km, height)
        return F.pmod(F.floor((lon + 180) * around / 360).cast("bigint") + aside, around)

    row = F.floor(F.col("stadium_lat") / height).cast("bigint")
    beside = F.array(*[F.lit(i).cast("bigint") for i in (-1, 0, 1)])
    v = (
        venues.select("stadium_id", "stadium_name", F.col("latitude").alias("stadium_lat"), F.col("longitude").alias("stadium_lon"))
        .filter("stadium_lat is not null and stadium_lon is not null")
        .withColumn("row", F.explode(F.transform(beside, lambda i: row + i)))
    )
    columns = F.array_distinct(F.transform(beside, lambda i: cell(F.col("row"), F.col("stadium_lon"), i)))
    v = v.withColumn("cell", F.explode(columns))
    s = stations.filter("latitude is not null and longitude is not null").withColumn(
        "row", F.floor(F.col("latitude") / height).cast("bigint")
    )
    s = s.withColumn("cell", cell(F.col("row"), F.col("longitude"), F.lit(0)))
    return v.join(s, ["row", "cell"])


def nearby_pairs(venues: DataFrame, stations: DataFrame, radius_km: float) -> DataFrame:
    """Venue-station pairs within a radius, for a venue table of any size."""
    distance = geo.haversine_km(F.col("stadium_lat"), F.col("stadium_lon"), F.col("latitude"), F.col("longitude"))
    return (
        near_cells(venues, stations, radius_km)
        .withColumn("distance_km", distance)
        .filter(F.col("distance_km") <= radius_km)
        .select("stadium_id", "stadium_name", "station_id", "station_name", "distance_km")
    )


def nearby_stations(proximity: DataFrame, stations: DataFrame, stadiums: DataFrame) -> DataFrame:
    """Stations in walking distance of each venue, with their coordinates."""
    return (
        proximity.filter("within_1km")
        .select("stadium_id", "station_id", "distance_km", F.col("station_name"))
        .join(stations.select("station_id", "latitude", "longitude"), "station_id")
        .join(stadiums.select("stadium_id", "stadium_name"), "stadium_id")
        .select("stadium_name", "station_name", "latitude", "longitude", F.round("distance_km", 3).alias("distance_km"))
    )
