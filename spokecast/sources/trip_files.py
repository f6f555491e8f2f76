"""Monthly trip CSV files (A1-A4)."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

logger = logging.getLogger(__name__)

# Column types of the trip files; every other column stays text.
TRIP_TYPES = {
    "started_at": "timestamp_ntz",
    "ended_at": "timestamp_ntz",
    "start_lat": "double",
    "start_lng": "double",
    "end_lat": "double",
    "end_lng": "double",
    "ride_mins": "double",
}


def normalise_header(df: DataFrame) -> DataFrame:
    """Lower-case column names with underscores for spaces (A2)."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def add_ride_mins(df: DataFrame) -> DataFrame:
    """Ride length in minutes, unless the file has it or lacks a time column (A3)."""
    if "ride_mins" in df.columns or not {"started_at", "ended_at"} <= set(df.columns):
        return df
    # Whole seconds of the difference, toward zero.
    whole = (F.col("ended_at") - F.col("started_at")).cast("interval second").cast("bigint")
    return df.withColumn("ride_mins", whole / 60.0)


def _first_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each file that a task comes to."""
    last = None
    for batch in batches:
        runs = pc.run_end_encode(batch.column("file"))
        begins = [0, *runs.run_ends.to_pylist()][:-1]
        kept = [i for i, file in zip(begins, runs.values.to_pylist(), strict=True) if file != last]
        last = runs.values[-1].as_py() if len(runs.values) else last
        yield batch.take(pa.array(kept, pa.int64()))


def by_header(spark: SparkSession, paths: str | list[str]) -> list[list[str]]:
    """The files below ``paths`` in groups of equal header lines, empty files left out; one job for all files.

    A file's header is its first line that is not blank, in the part that begins at its first byte.  Lines before a
    file's second part pass the workers once, only first lines leave them.
    """
    begins = F.col("_metadata.file_block_start") == 0
    lines = spark.read.text(paths).where(begins & (F.length(F.trim("value")) > 0))
    first = lines.select(F.col("_metadata.file_path").alias("file"), "value").mapInArrow(_first_lines, "file string, value string")
    # Names of files, as any reader of them lists on the driver.
    alike = first.groupBy("value").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return sorted([unquote(f) for f in r.files] for r in alike)


def read_trips(spark: SparkSession, paths: str | list[str], month: str) -> DataFrame:
    """One month's files as typed trips, stamped with the load time and month (A1, A4).

    Each file is read by its own header: files of equal headers together, then all by column
    name, with nulls for columns that a file lacks.  Cells are read as text and cast one by
    one, so an unreadable cell becomes null and its row stays.  Station ids are text
    throughout; an old text variant of the end station id fills its gaps.
    """
    texts = []
    for files in by_header(spark, paths):
        names = spark.read.csv(files[0], header=True).columns
        layout = StructType([StructField(c, StringType()) for c in names])
        texts.append(normalise_header(spark.read.schema(layout).csv(files, header=True, mode="PERMISSIVE")))
    if not texts:
        raise FileNotFoundError(f"no trip file with a header in {paths}")
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), texts)
    typed = df.select(
        *[F.col(c).try_cast(TRIP_TYPES[c]).alias(c) if c in TRIP_TYPES else F.col(c) for c in df.columns]
    )
    if {"end_station_id", "end_station_id__v_text"} <= set(typed.columns):
        typed = typed.withColumn("end_station_id", F.coalesce("end_station_id", "end_station_id__v_text"))
    return (
        add_ride_mins(typed)
        .withColumn("_dlt_load_timestamp", F.current_timestamp())
        .withColumn("source_month", F.lit(month))
    )


def read_months(spark: SparkSession, pattern: str, months: list[str]) -> DataFrame:
    """Several months, each from ``pattern.format(month=...)``; columns are matched by name.

    A month whose files are absent is logged and left out, so one gap does not stop a load.
    """
    frames = []
    for month in months:
        try:
            frames.append(read_trips(spark, pattern.format(month=month), month))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            logger.warning("no trip files for %s", month)
    if not frames:
        raise FileNotFoundError(f"no trip files for any of {months}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
