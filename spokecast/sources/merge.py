"""Merge of a batch into a table by primary key."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spokecast.session import cut_lineage


def newest_per_key(batch: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """One row per key; ``newest`` orders the rows of a key, first one wins.

    ``row_number() = 1`` is limited before the shuffle, so a repeated key stays cheap.
    """
    order = Window.partitionBy(*keys).orderBy(*newest)
    return batch.withColumn("_row", F.row_number().over(order)).filter("_row = 1").drop("_row")


def merge_by_key(target: DataFrame, batch: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """``target`` without the batch's keys, plus the batch's newest row per key."""
    fresh = newest_per_key(batch, keys, newest)
    same = [target[k].eqNullSafe(fresh[k]) for k in keys]
    return target.join(fresh, same, "left_anti").unionByName(fresh, allowMissingColumns=True)


def _in(partition: str, names: set) -> Column:
    """Is the partition one of ``names``, which may hold null."""
    known = [n for n in names if n is not None]
    found = F.col(partition).isin(*known) if known else F.lit(False)
    return found | F.col(partition).isNull() if None in names else found


def _log(spark: SparkSession, path: str) -> list[Row]:
    """The entries of the table's last version, one for each partition; empty where there is no table yet."""
    try:
        log = spark.read.parquet(f"{path}/log")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return []
    last = log.agg(F.max("version")).first()[0]
    return log.where(F.col("version") == last).collect()


def _stored(spark: SparkSession, path: str, partition: str, entries: list[Row]) -> DataFrame:
    """The rows of some of a version's partitions; others are pruned by their folders."""
    schema = StructType.fromJson(json.loads(entries[0].layout))
    data = spark.read.schema(StructType([*schema.fields, StructField("load", StringType())])).parquet(f"{path}/data")
    loads: dict[str, set] = {}
    for e in entries:
        loads.setdefault(e.load, set()).add(e.part)
    named = [(F.col("load") == load) & _in(partition, parts) for load, parts in sorted(loads.items())]
    return data.where(reduce(lambda a, b: a | b, named)).drop("load")


def read_table(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """The table as its last load that was completed left it."""
    entries = _log(spark, path)
    if not entries:
        raise FileNotFoundError(f"no table at {path}")
    return _stored(spark, path, partition, entries)


def _ranges(df: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """Per partition the rows, the least and greatest value of each key, and the rows with a null in one."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(F.col(partition).alias("part")).agg(
        F.count("*").alias("n_rows"),
        F.count(F.when(missing, 1)).alias("n_null"),
        F.struct(*[F.min(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("low"),
        F.struct(*[F.max(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("high"),
    )


def _may_share(entry: Row, other: Row) -> bool:
    """Can a key of one range be one of the other's too."""
    if entry.n_null and other.n_null:
        return True
    pairs = zip(entry.low, entry.high, other.low, other.high, strict=True)
    return all(None not in p and p[0] <= p[3] and p[2] <= p[1] for p in pairs)


def upsert_partitions(
    spark: SparkSession, path: str, batch: DataFrame, keys: list[str], partition: str, newest: list[Column]
) -> None:
    """Merge a batch into the table at ``path``, which is stored by ``partition``; read it with ``read_table``.

    Only partitions that hold a batch key or receive a batch row are read in full and written anew; the search for
    them reads keys alone, and only of partitions whose range of keys meets that of a partition of the batch.  A
    null partition is one like the others.  The batch is stored once, so every pass sees the same rows.

    Rewritten partitions go to a folder of their own (``data/load=...``), beside those they replace.  Then a new
    version of the log, one file that lists each partition's folder and key range, is added: its commit is the
    moment at which readers change from the old table to the new one.  A load that fails before leaves the old
    table as it was.  One load at a time; ``clear_superseded`` empties folders that no version refers to any more.
    """
    batch = cut_lineage(batch)
    if batch.isEmpty():
        return
    entries = _log(spark, path)
    # Rows for partitions (months), here and below, not for keys.
    arriving = _ranges(batch, keys, partition).collect()
    touched = {r.part for r in arriving}
    candidates = [e for e in entries if e.part not in touched and any(_may_share(e, r) for r in arriving)]
    if candidates:
        old = _stored(spark, path, partition, candidates)
        same = [old[k].eqNullSafe(batch[k]) for k in keys]
        hit = old.select(*keys, partition).join(batch.select(*keys), same, "left_semi")
        touched |= {r[0] for r in hit.select(partition).distinct().collect()}
    replaced = [e for e in entries if e.part in touched]
    if replaced:
        merged = merge_by_key(_stored(spark, path, partition, replaced), batch, keys, newest)
    else:
        merged = newest_per_key(batch, keys, newest)
    # Columns that earlier loads had stay in the table's layout.
    layout = StructType.fromJson(json.loads(entries[0].layout)) if entries else StructType()
    layout = StructType([*layout.fields, *[f for f in merged.schema.fields if f.name not in layout.names]])
    load = uuid.uuid4().hex
    merged.hint("rebalance", partition).write.partitionBy(partition).parquet(f"{path}/data/load={load}")
    fresh = spark.read.schema(merged.schema).parquet(f"{path}/data/load={load}")
    text = json.dumps(layout.jsonValue())
    now = _ranges(fresh, keys, partition).select(F.lit(load).alias("load"), F.lit(text).alias("layout"), "*")
    kept = [e.part for e in entries if e.part not in touched]
    version = 1 + max((e.version for e in entries), default=0)
    if kept:
        last = spark.read.parquet(f"{path}/log").where((F.col("version") == version - 1) & _in("part", set(kept)))
        now = now.unionByName(last.drop("version").withColumn("layout", F.lit(text)))
    now.coalesce(1).write.parquet(f"{path}/log/version={version}")


def clear_superseded(spark: SparkSession, path: str, partition: str) -> int:
    """Empties the folders of loads that the last version does not refer to; returns how many."""
    used = {e.load for e in _log(spark, path)}
    loads = spark.read.schema("load string").parquet(f"{path}/data").select("load").distinct().collect()
    old = [r.load for r in loads if r.load not in used]
    for load in old:
        folder = f"{path}/data/load={load}"
        spark.read.parquet(folder).limit(0).write.mode("overwrite").partitionBy(partition).parquet(folder)
    return len(old)
