"""Student's t distribution as a column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_sided_p(t: Column, df: Column) -> Column:
    """Two-sided p-value of ``t`` for whole ``df`` >= 1, by the finite cosine series (K7)."""
    theta = F.atan(F.abs(t) / F.sqrt(df.cast("double")))
    cos = F.cos(theta)
    odd = df % 2 == 1
    last = F.when(odd, (df - 3) / 2).otherwise((df - 2) / 2).cast("int")
    terms = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def step(acc: Column, k: Column) -> Column:
        ratio = F.when(odd, (2 * k + 2) / (2 * k + 3)).otherwise((2 * k + 1) / (2 * k + 2))
        return F.struct((acc["term"] * ratio * cos * cos).alias("term"), (acc["total"] + acc["term"]).alias("total"))

    start = F.struct(F.when(odd, cos).otherwise(1.0).alias("term"), F.lit(0.0).alias("total"))
    series = F.sin(theta) * F.aggregate(terms, start, step, lambda acc: acc["total"])
    return 1 - F.when(odd, (theta + series) * (2 / math.pi)).otherwise(series)
