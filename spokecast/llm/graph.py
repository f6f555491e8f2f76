"""Connected components by contraction, on joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, one row for each node of ``edges`` (a, b); nodes of a component share a root.

    Each round every node moves to the neighbour first in a fixed random order, and from there once more;
    edges follow and those within a node fall away.  The order being random, a constant share of the
    nodes is left after a round, also in long chains.  Nothing is gathered by node: hubs are met
    by aggregates with partial sums and by joins that can be split.  A root is a member of its component.
    """
    first = lambda column: F.struct(F.xxhash64(column).alias("h"), F.col(column).alias("n"))
    edges = cut_lineage(edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a <> b").distinct())
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        ways = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = ways.groupBy("a").agg(F.min(first("b")).alias("m")).select(F.col("a").alias("node"), F.least("m", first("a"))["n"].alias("at"))
        near = cut_lineage(near)
        again = near.select(F.col("node").alias("at"), F.col("at").alias("further"))
        move = cut_lineage(near.join(again, "at").select("node", F.col("further").alias("at")))
        moves.append(move)
        to_a = move.select(F.col("node").alias("a"), F.col("at").alias("x"))
        to_b = move.select(F.col("node").alias("b"), F.col("at").alias("y"))
        moved = edges.join(to_a, "a").join(to_b, "b").where("x <> y")
        edges = cut_lineage(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = moves[-1].select("node", F.col("at").alias("root"))
    for move in reversed(moves[:-1]):
        later = out.select(F.col("node").alias("at"), "root")
        out = move.join(later, "at", "left").select("node", F.coalesce("root", "at").alias("root"))
    return out
