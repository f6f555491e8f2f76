"""Helpers for text columns: exact column picks, Arrow chunks of bounded size, word names."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
#: Entries after which a worker's table of word names is emptied; it only saves time.
NAMES_KEPT = 200_000

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, by exact spelling, whatever other columns are called.

    Spark resolves names without regard to case, so a table with ``text`` and ``TEXT`` has no
    plain ``df["text"]``; columns are therefore taken by position.
    """
    places = [df.columns.index(n) for n in names]
    numbered = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return numbered.select(*(F.col(f"c{i}").alias(n) for i, n in zip(places, names)))


def map_chunks(
    df: DataFrame, schema: str, text: str, make: Callable[[], Callable], chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """``make()`` runs once per task and gives a function from record batch to record batches.

    A batch holds at most ``chunk_bytes`` of ``text``, or one longer text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in chunks(batch, text, chunk_bytes):
                yield from work(part)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns freed memory to the system at a task's end, as workers wait idle for a minute with all they hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def chunks(batch: pa.RecordBatch, text: str, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.cast(pc.binary_length(batch.column(text)), pa.int64()), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    begin, done = 0, 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(ends, done + chunk_bytes, side="right")))
        yield batch.slice(begin, end - begin)
        begin, done = end, int(ends[end - 1])


def texts(batch: pa.RecordBatch, column: str, null: bytes | None = b"") -> list[bytes]:
    """The texts as UTF-8 bytes."""
    found = batch.column(column).cast(pa.binary()).to_pylist()
    return [null if x is None else x for x in found]


class Names(dict):
    """Word (bytes) to its 64-bit name, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        self[word] = name = xxhash.xxh3_64_intdigest(word)
        return name

    def of(self, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Names of all words in a row, and the place of each text's first word (one more at the end)."""
        if len(self) > NAMES_KEPT:
            self.clear()
        first = np.zeros(len(words) + 1, np.int64)
        np.cumsum([len(w) for w in words], out=first[1:])
        return np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.uint64, int(first[-1])), first


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_names(names: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A name for every ``width`` consecutive words, by doubling: as many steps as the width has bits."""
    if len(names) < width:
        return np.empty(0, np.uint64)
    salt = np.uint64((seed * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    power, size = mix(names + salt), 1
    out, covered = None, 0
    left = width
    while left:
        if left & 1:
            out = power[: len(names) - width + 1].copy() if out is None else mix(out * np.uint64(3) + power[covered : covered + len(out)])
            covered += size
        left >>= 1
        if left:
            power = mix(power[: len(power) - size] * np.uint64(3) + power[size:])
            size *= 2
    return out


def whole_windows(first: np.ndarray, width: int) -> np.ndarray:
    """For each place of a window in the row of all words: does it lie in one text."""
    n = int(first[-1])
    if n < width:
        return np.empty(0, bool)
    inside = np.ones(n - width + 1, bool)
    for k in range(1, width):
        at = first[1:-1] - k
        inside[at[(at >= 0) & (at < len(inside))]] = False
    return inside


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``starts``."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` for each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def owner(first: np.ndarray) -> np.ndarray:
    """For each word, the number of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def string_column(values: Iterable[bytes | None]) -> pa.Array:
    """UTF-8 bytes as an Arrow string column."""
    return pa.array(values, pa.binary()).cast(pa.string())


_tools: dict = {}


class Shared:
    """A value sent to every worker once, and the tool that a worker builds of it and keeps from task to task."""

    def __init__(self, spark, value, build: Callable):
        self.key, self.build = uuid.uuid4().hex, build
        self.sent = spark.sparkContext.broadcast(value)

    def tool(self):
        if self.key not in _tools:
            while len(_tools) >= 2:  # few at a time, so that a worker's memory stays bounded
                _tools.pop(next(iter(_tools)))
            _tools[self.key] = self.build(self.sent.value)
        return _tools[self.key]
