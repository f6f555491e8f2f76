"""Phrase collocations by dynamic itemset counting.

The documents lie in shards that are scanned in a cycle.  Words are counted from the first shard on.  A longer phrase
becomes active as soon as both phrases that it is made of, all words but the last and all but the first, have
reached the threshold in what has been scanned so far; from the next shard on it is counted, until the cycle has come
round once and it has met every shard.  Lengths are thus counted side by side, and the scans end when no phrase is
active any more: after little more than one cycle where phrases are common early, after one cycle for each length at
worst.

Counts are kept by 64-bit names, packed and summed by bucket of the name.  What has reached the threshold, and when,
is sent to the workers as a table of bounded size (``Reached``); it may say so of a phrase that has not, which costs
counting it and no more.  A last scan counts what the table names by the words themselves, so that results do
not rest on names across tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokecast.llm.packed import SCHEMA, SPREAD, dealt, first_of_groups, pack, unpack
from spokecast.llm.text import Shared, chunks, give_back, mix, pick
from spokecast.session import scratch_path

SHARDS = 4
CHUNK_BYTES = 1 << 20
#: Text of a task of the last scan.
SPELT_BYTES = 64 << 20
#: Counted names that a task holds before it sends them, and phrases with their words in the last scan.
HELD = 1 << 21
HELD_PHRASES = 1_000_000
#: Text of a partition of counts: as many partitions as the session shuffles with, but of these sizes at least and most.
LEAST_BYTES, MOST_BYTES = 4 << 20, 64 << 20
#: Cells of the table of reached phrases for so many bytes of text, and its least and greatest size in bits.
CELL_BYTES, LEAST_BITS, MOST_BITS = 64, 12, 26
NEVER = 255
GROUP_BITS = 16

#: Fixed value: what ends a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(0x0A if c in ENDS else 0x20 if c == 0x09 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


class Reached:
    """For a name the step at whose end its count had reached the threshold, or ``NEVER``.

    A name has two cells; the step is the later one of the two, so a name that was put in is always found, and its
    answer never changes from then on.
    """

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        self.shift = np.uint64(65 - len(cells).bit_length())

    def places(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (names >> self.shift).astype(np.int64), (mix(names) >> self.shift).astype(np.int64)

    def steps(self, names: np.ndarray) -> np.ndarray:
        one, two = self.places(names)
        return np.maximum(self.cells[one], self.cells[two])


class Chunk:
    """The words of some texts in a row, with names that differ by language, and the piece that each lies in."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        self.langs = langs
        self.bytes = b"\n".join(texts).translate(FOLD)
        data = np.frombuffer(self.bytes, np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        line = data == 0x0A
        inside = np.concatenate([[False], (data != 0x20) & ~line, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.stop = edges[::2], edges[1::2]
        self.text = np.searchsorted(ends, self.start)
        self.piece = np.cumsum(line, dtype=np.int32)[self.start] if len(self.start) else np.empty(0, np.int32)
        self.n_words = np.bincount(self.text, minlength=len(texts))
        size = self.stop - self.start
        # A sum of the word's bytes, each times a number of its own for the place in the word.
        flat = np.flatnonzero(inside[1:-1])
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        factor = mix(np.arange(1, int(size.max(initial=0)) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        salt = np.array([xxhash.xxh3_64_intdigest(x.encode(), seed=1) for x in langs], np.uint64)
        if len(size):
            sums = np.add.reduceat((data[flat].astype(np.uint64) + np.uint64(1)) * factor[place], np.cumsum(size) - size)
            self.names = mix(mix(sums + size.astype(np.uint64)) + salt[self.text])
        else:
            self.names = np.empty(0, np.uint64)

    def phrases(self, reached: Reached | None, step: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length, places of phrases that may be counted by now: where they begin, their names, and the step they begin at."""
        names, places, begins = self.names, np.arange(len(self.names)), np.zeros(len(self.names), np.uint8)
        for length in range(1, longest + 1):
            yield length, places, names, begins
            if reached is None or length == longest or len(self.names) <= length:
                return
            steps = np.full(len(self.names), NEVER, np.uint8)
            # A crowded table may name a step before the phrase itself began; what is made of it begins no earlier than it.
            steps[places] = np.maximum(reached.steps(names), np.maximum(begins, 1) - np.uint8(1))
            by_place = np.zeros(len(self.names), np.uint64)
            by_place[places] = names
            later = np.maximum(steps[:-1], steps[1:])[: len(self.names) - length]
            places = np.flatnonzero((later < min(step, NEVER)) & (self.piece[:-length] == self.piece[length:]))
            begins = later[places] + np.uint8(1)
            names = mix(by_place[places] * np.uint64(3) + by_place[places + 1] + np.uint64(length))

    def spelt(self, at: int, length: int) -> bytes:
        return b" ".join(self.bytes[self.start[at] : self.stop[at + length - 1]].split())


def _summed(names: np.ndarray, begins: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row for each name; a phrase begins at the same step wherever it stands."""
    order = np.argsort(names)
    names = names[order]
    at = np.flatnonzero(first_of_groups(names))
    if not len(at):
        return names, begins, lengths, counts
    return names[at], begins[order][at], lengths[order][at], np.add.reduceat(counts[order], at)


def _counter(shared: Shared | None, step: int, shards: int, longest: int, buckets: int):
    """Counts the active phrases of a shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.tool() if shared else None
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            columns = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield from pack((columns[0] % np.uint64(buckets)).astype(np.int64), [*columns])

        for whole in batches:
            for batch in chunks(whole, "text", CHUNK_BYTES):
                chunk = Chunk(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())
                parts = []
                for length, _, found, begins in chunk.phrases(known, step, longest):
                    active = begins.astype(np.int64) > step - shards
                    found, begins = found[active], begins[active]
                    parts.append((found, begins, np.full(len(found), length, np.uint8), np.ones(len(found), np.uint64)))
                held.append(_summed(*(np.concatenate(x) for x in zip(*parts, strict=True))))
                size += len(held[-1][0])
                if size > HELD:
                    yield from sent()
                    held.clear()
                    size = 0
        if size:
            yield from sent()
        give_back()

    return run


KINDS = [["u8", "u1", "u1", "u8"], ["u8", "u1", "u1", "u8", "u1"]]
STATE = f"{SCHEMA}, fresh bigint, shorter bigint"


def _merger(step: int, shards: int, least: int, longest: int):
    """Sums what a bucket has received with what it had; phrases that have met every shard and are rare go."""

    def bucket(number: int, values: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        new, old = (unpack(v, k) for v, k in zip(values, KINDS, strict=True))
        columns = [np.concatenate([a, b]) for a, b in zip(new, old, strict=False)]
        reach = np.concatenate([np.full(len(new[0]), NEVER, np.uint8), old[4]])
        order = np.argsort(columns[0])
        names, begins, lengths, counts = (c[order] for c in columns)
        at = np.flatnonzero(first_of_groups(names))
        counts, reach = np.add.reduceat(counts, at), np.minimum.reduceat(reach[order], at)
        names, begins, lengths = names[at], begins[at], lengths[at]
        fresh = (counts >= least) & (reach == NEVER)
        reach[fresh] = step
        kept = (reach != NEVER) | (begins.astype(np.int64) + shards - 1 > step)
        some = [pa.array([int(x.sum())], pa.int64()) for x in (fresh, fresh & (lengths < longest))]
        for out in pack(np.full(int(kept.sum()), number), [x[kept] for x in (names, begins, lengths, counts, reach)], kind=1):
            yield pa.RecordBatch.from_arrays([*out.columns, *some], names=["bucket", "kind", "data", "fresh", "shorter"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, values = None, [[], []]
        for batch in batches:
            for number, kind, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "data")), strict=True):
                if number != last and last is not None:
                    yield from bucket(last, values)
                    values = [[], []]
                last = number
                values[kind].append(data)
        if last is not None:
            yield from bucket(last, values)
        give_back()

    return run


def _newly(step: int, size: int):
    """The cells of the names that have reached the threshold at this step, by group of cells."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Reached(np.empty(0, np.uint8))
        table.shift = np.uint64(65 - size.bit_length())
        for batch in batches:
            for data in batch.column("data").to_pylist():
                names, _, _, _, reach = unpack([data], KINDS[1])
                cells = np.unique(np.concatenate(table.places(names[reach == step])))
                yield from pack(cells >> GROUP_BITS, [(cells & ((1 << GROUP_BITS) - 1)).astype("<u2")])
        give_back()

    return run


def _bitmaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bitmap for each group of cells."""
    bits: dict[int, np.ndarray] = {}
    for batch in batches:
        for group, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
            if group not in bits:
                bits[group] = np.zeros(1 << GROUP_BITS, bool)
            bits[group][unpack([data], ["<u2"])[0]] = True
    if bits:
        data = [np.packbits(b).tobytes() for b in bits.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(bits), pa.int32()), pa.array(data, pa.binary())], names=["cells", "bits"])


def _scan(spark: SparkSession, path: str, step: int, shards: int) -> DataFrame:
    stored = spark.read.schema("lang string, text string, shard int").parquet(path)
    return stored.where(F.col("shard") == step % shards).select("lang", "text")


def reached_phrases(spark: SparkSession, path: str, text_bytes: int, shards: int, least: int, longest: int) -> tuple[np.ndarray, int]:
    """The table of phrases that have reached ``least``, and after how many steps no phrase was active any more.

    The driver holds the table, of ``1 << MOST_BITS`` bytes at most, and receives a bitmap of its cells a step.
    """
    bits = min(max(LEAST_BITS, (text_bytes // CELL_BYTES).bit_length()), MOST_BITS)
    cells = np.full(1 << bits, NEVER, np.uint8)
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(min(wanted, text_bytes // LEAST_BYTES + 1), text_bytes // MOST_BYTES + 1)
    folder, state = scratch_path(spark, "phrase-counts"), None
    step, last = 0, -1
    while step <= last + shards:
        shared = Shared(spark, cells, Reached) if step else None
        counts = _scan(spark, path, step, shards).mapInArrow(_counter(shared, step, shards, longest, partitions * SPREAD), SCHEMA)
        both = counts if state is None else counts.unionAll(state.drop("fresh", "shorter"))
        merged = dealt(both, partitions).sortWithinPartitions("bucket").mapInArrow(_merger(step, shards, least, longest), STATE)
        # Two tables in turn: the one before the last is overwritten.
        merged.write.mode("overwrite").parquet(f"{folder}/{step % 2}")
        state = spark.read.schema(STATE).parquet(f"{folder}/{step % 2}")
        if shared:
            shared.sent.destroy()
        found = state.agg(F.sum("fresh").alias("fresh"), F.sum("shorter").alias("shorter")).first()
        if found.shorter:
            last = step
        if found.fresh:
            groups = max(1, len(cells) >> GROUP_BITS)
            newly = state.mapInArrow(_newly(step, len(cells)), SCHEMA)
            for r in dealt(newly, min(groups, partitions)).mapInArrow(_bitmaps, "cells int, bits binary").collect():
                begin = r.cells << GROUP_BITS
                part = cells[begin : begin + (1 << GROUP_BITS)]
                on = np.unpackbits(np.frombuffer(r.bits, np.uint8))[: len(part)].astype(bool)
                part[on & (part == NEVER)] = step
        step += 1
    if state is not None:  # gives the space back
        state.limit(0).write.mode("overwrite").parquet(f"{folder}/{step % 2}")
    return cells, step


class _Spelt:
    """What a task has counted by name, and the words of each name that it has met."""

    def __init__(self):
        self.known = np.empty(0, np.uint64)
        self.names: list[np.ndarray] = []
        self.phrases: list[bytes] = []
        self.langs: list[str] = []
        self.lengths: list[np.ndarray] = []
        self.counts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, chunk: Chunk, length: int, places: np.ndarray, names: np.ndarray) -> None:
        order = np.argsort(names)
        at = np.flatnonzero(first_of_groups(names[order]))
        found, places = names[order[at]], places[order[at]]
        self.counts.append((found, np.diff(np.append(at, len(names)))))
        self.size += len(found)
        if len(self.known):
            near = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
            new = np.flatnonzero(self.known[near] != found)
            found, places = found[new], places[new]
        self.names.append(found)
        self.lengths.append(np.full(len(found), length, np.int32))
        self.phrases += [chunk.spelt(i, length) for i in places.tolist()]
        self.langs += [chunk.langs[i] for i in chunk.text[places].tolist()]

    def settle(self) -> None:
        """The names of a chunk are known to the next one; counts are summed when there are many."""
        self.known = np.sort(np.concatenate(self.names))
        if self.size > HELD:
            self.counts = [self.summed()]
            self.size = len(self.counts[0][0])

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        names, counts = (np.concatenate(x) for x in zip(*self.counts, strict=True))
        order = np.argsort(names)
        names = names[order]
        at = np.flatnonzero(first_of_groups(names))
        return names[at], np.add.reduceat(counts[order], at)

    def rows(self) -> pa.RecordBatch:
        names, sums = self.summed()
        own = np.searchsorted(names, np.concatenate(self.names))
        return _spelt_rows(self.langs, np.concatenate(self.lengths), self.phrases, sums[own])


def _spelt_rows(langs, lengths, phrases, counts) -> pa.RecordBatch:
    columns = [pa.array(langs, pa.string()), pa.array(lengths, pa.int32()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "length", "phrase", "n"])


def _speller(shared: Shared, longest: int):
    """Counts the phrases of the table by their words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words, spelt = shared.tool(), {}, _Spelt()
        for whole in batches:
            for batch in chunks(whole, "text", CHUNK_BYTES):
                chunk = Chunk(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())
                for lang, n in zip(chunk.langs, chunk.n_words.tolist(), strict=True):
                    words[lang] = words.get(lang, 0) + n
                for length, places, found, _ in chunk.phrases(known, NEVER, longest):
                    inside = np.flatnonzero(known.steps(found) != NEVER)
                    if len(inside):
                        spelt.add(chunk, length, places[inside], found[inside])
                if spelt.names:
                    spelt.settle()
                if len(spelt.phrases) > HELD_PHRASES:
                    yield spelt.rows()
                    spelt = _Spelt()
        if spelt.phrases:
            yield spelt.rows()
        if words:
            yield _spelt_rows(list(words), [0] * len(words), [b""] * len(words), list(words.values()))
        give_back()

    return run


def mine(
    docs: DataFrame,
    least: int = 30,
    top: int = 2000,
    longest: int = 4,
    inside: int = 80,
    lang_col: str = "lang",
    text_col: str = "text",
    shards: int = SHARDS,
) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words: ``lang, rank, phrase, a, l, r, n, score``.

    Words are folded to lower case (A-Z) and lie in pieces between ``.,;:!?`` and line ends; a phrase lies in one piece.
    ``a`` counts the phrase, at least ``least``; ``l`` and ``r`` count its parts at the cut of the lowest score
    2000000 a / (l + r), floored, the first of equal ones; ``n`` counts all words of the language.  A phrase with
    ``inside`` per cent of its occurrences in one longer phrase of ``least`` is left out.  Ranks go by score, then
    ``a``, then the phrase in byte order.

    A null language is ``und`` and one with it; null and empty texts and texts without words count nothing; repeated
    rows count as often as they come; other columns are not read.  A table without phrases gives no rows.
    """
    spark = docs.sparkSession
    slim = pick(docs, lang_col, text_col).toDF("lang", "text").where("text IS NOT NULL AND text <> ''")
    slim = slim.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    path = scratch_path(spark, "phrase-shards")
    numbered = slim.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int"))
    numbered.write.partitionBy("shard").parquet(path)
    stored = spark.read.schema("lang string, text string, shard int").parquet(path)
    text_bytes = stored.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells, _ = reached_phrases(spark, path, text_bytes, shards, least, longest)
    shared = Shared(spark, cells, Reached)
    # Each task sends each of its phrases once, so tasks are large.
    tasks = max(2 * spark.sparkContext.defaultParallelism, text_bytes // SPELT_BYTES + 1)
    spelt = stored.select("lang", "text").coalesce(tasks).mapInArrow(_speller(shared, longest), "lang string, length int, phrase string, n bigint")
    counted = scratch_path(spark, "phrases")
    spelt.groupBy("lang", "length", "phrase").agg(F.sum("n").alias("f")).where((F.col("length") == 0) | (F.col("f") >= least)).write.parquet(counted)
    return ranked(spark.read.parquet(counted), top, inside)


def ranked(counts: DataFrame, top: int, inside: int) -> DataFrame:
    """The best phrases from ``(lang, length, phrase, f)``, where length 0 counts all words of a language."""
    found = counts.where("length >= 1").select("lang", "phrase", "f")
    candidates = counts.where("length >= 2")
    cuts = candidates.select("lang", "phrase", "f", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("cut"))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', cut)"))
    cuts = cuts.withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    sides = cuts.join(found.toDF("lang", "left", "l"), ["lang", "left"]).join(found.toDF("lang", "right", "r"), ["lang", "right"])
    score = F.expr("(CAST(2000000 AS DECIMAL(9, 0)) * CAST(f AS DECIMAL(19, 0))) div (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))")
    lowest = sides.groupBy("lang", "phrase").agg(F.first("f").alias("a"), F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest"))
    words = candidates.where("length >= 3").withColumn("words", F.split("phrase", " "))
    sizes = words.select("lang", "words", "f", "length", F.explode(F.sequence(F.lit(2), F.col("length") - 1)).alias("size"))
    begins = sizes.select("lang", "words", "f", "size", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)).alias("begin"))
    within = begins.select("lang", F.expr("array_join(slice(words, begin, size), ' ')").alias("phrase"), "f")
    within = within.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    covered = F.expr(f"CAST(100 AS DECIMAL(9, 0)) * CAST(longer AS DECIMAL(19, 0)) >= CAST({inside} AS DECIMAL(9, 0)) * CAST(a AS DECIMAL(19, 0))")
    kept = lowest.join(within, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covered)
    best = Window.partitionBy("lang").orderBy(F.desc("lowest.score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    n = counts.where("length = 0").select("lang", F.col("f").alias("n"))
    return first.join(n, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "lowest.l", "lowest.r", "n", "lowest.score")
