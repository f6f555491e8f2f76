"""Scheduled loads as a file stream: each micro-batch is merged by key (A9 on arrival).

With ``availableNow`` one run takes all files that arrived since the last run and stops,
which is the scheduled batch load; the stream's checkpoint remembers what was taken, and a
repeated batch merges to the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spokecast.sources.merge import upsert_partitions
from spokecast.sources.trip_files import TRIP_TYPES, add_ride_mins, normalise_header


def landed_trips(spark: SparkSession, folder: str, columns: tuple[str, ...]) -> DataFrame:
    """Trip files as a stream; ``columns`` are the file's own header names.

    A file with another header fails the load, rather than being read by position.
    """
    schema = StructType()
    for name in columns:
        schema = schema.add(name, "string")
    text = normalise_header(spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).csv(folder))
    typed = text.select(
        *[F.col(c).try_cast(TRIP_TYPES[c]).alias(c) if c in TRIP_TYPES else F.col(c) for c in text.columns]
    )
    return (
        add_ride_mins(typed)
        .withColumn("source_month", F.coalesce(F.date_format("started_at", "yyyyMM"), F.lit("unknown")))
        .withColumn("_dlt_load_timestamp", F.current_timestamp())
    )


def merge_stream(
    stream: DataFrame, table: str, checkpoint: str, keys: list[str], partition: str, newest: list[Column]
) -> None:
    """Merge everything that is waiting into ``table`` and return."""

    def merge(batch: DataFrame, _: int) -> None:
        upsert_partitions(batch.sparkSession, table, batch, keys, partition, newest)

    (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
