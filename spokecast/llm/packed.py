"""Rows of numbers shuffled as packed columns: one row of bytes for each chunk and bucket.

Ten thousand numbers in one binary value cost the shuffle little more than their bytes, and the task that
receives a bucket works on whole numpy columns.  Buckets follow from hashes of the content; the
number of partitions follows from the amount of data, so that what a task holds stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Buckets for each partition, so that hashing buckets to partitions evens out.
SPREAD = 4
#: Rows that a packed value should hold on average.
VALUE_ROWS = 1000
SCHEMA = "bucket int, kind int, data binary"


def pack(buckets: np.ndarray, columns: list[np.ndarray], kind: int = 0) -> Iterator[pa.RecordBatch]:
    """The columns' rows by bucket, each bucket's columns one after the other in one value.

    A column's bytes stand by significance, so that the shuffle's compression finds the equal ones; rows
    keep their order within a bucket.
    """
    if not len(buckets):
        return
    order = np.argsort(buckets, kind="stable")
    buckets = buckets[order]
    columns = [c[order] for c in columns]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)]])
    wide = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1) for c in columns]
    data = [b"".join(w[a:b].T.tobytes() for w in wide) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(buckets[cuts[:-1]].astype(np.int32)), pa.array(np.full(len(data), kind, np.int32)), pa.array(data, pa.binary())],
        names=["bucket", "kind", "data"],
    )


def unpack(data: list[bytes], kinds: list[str]) -> list[np.ndarray]:
    """The columns of all values, put together."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    out: list[list[np.ndarray]] = [[] for _ in kinds]
    for d in data:
        n, at = len(d) // width, 0
        for column, kind in zip(out, kinds, strict=True):
            size = np.dtype(kind).itemsize
            column.append(np.frombuffer(d, np.uint8, n * size, at).reshape(size, n).T.copy().view(kind).reshape(n))
            at += n * size
    return [np.concatenate(c) if c else np.empty(0, k) for c, k in zip(out, kinds, strict=True)]


def dealt(packed: DataFrame, partitions: int) -> DataFrame:
    return packed.repartition(partitions, "bucket")


def partitions_for(spark, amount: int, each: int) -> int:
    """Partitions that hold ``each`` at most on average, and no fewer than the session's shuffles have."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-amount // each))


def buckets_for(amount: int, partitions: int, each: int) -> int:
    """Buckets of a leg of ``amount`` rows between as many partitions: ``SPREAD`` for each where values then hold
    ``VALUE_ROWS``, fewer where there are few rows, and enough that a bucket holds a quarter of ``each`` at most.
    """
    held = amount // (VALUE_ROWS * partitions)
    return max(1, min(partitions * SPREAD, held), -(-SPREAD * amount // each))


def first_of_groups(*keys: np.ndarray) -> np.ndarray:
    """In columns sorted together: does a row differ from the one before it."""
    n = len(keys[0])
    out = np.ones(n, bool)
    if n > 1:
        out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out
