"""Named tables in layers (A12, A13): a folder per layer, a Parquet table per name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

def literal_table(spark: SparkSession, rows: list[tuple] | tuple[tuple, ...], schema: str) -> DataFrame:
    """A few fixed rows as literals of the plan, so that Spark knows how small the table is."""
    fields = StructType.fromDDL(schema).fields

    def row(values: tuple):
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, fields, strict=True)])

    return spark.range(1).select(F.inline(F.array(*[row(r) for r in rows])))


@dataclass(frozen=True)
class Warehouse:
    """Where tables live; ``root`` is a folder every executor can reach."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def store(
        self, layer: str, name: str, df: DataFrame, partition_by: str | None = None, rebalance: bool = False
    ) -> DataFrame:
        """Write a table and read it back.

        Readers of the stored table get its size, so Spark decides on broadcasts by real
        bytes, and a lost executor replays a file scan rather than the whole chain.
        """
        if partition_by or rebalance:
            df = df.hint("rebalance", *([partition_by] if partition_by else []))
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(layer, name))
        return self.read(layer, name)

    def view(self, name: str, df: DataFrame) -> DataFrame:
        """Register a lazy model under its name for SQL users."""
        df.createOrReplaceTempView(name)
        return df
