"""Substring deduplication by recompression.

Rounds of naming turn each text into ever fewer symbols: a run of one symbol gets a name, then every
symbol is classed left or right by its own name, and a left symbol before a right one becomes a named pair.
Names follow from content alone, so they agree over the whole corpus.  For each symbol the words are
tracked that decide on it: a symbol decided within a window is found in every copy of that window.

1. Every window of ``width`` words takes the symbol of the highest round that it decides, consecutive
   windows with one symbol form a stretch, and stretches are dealt by their symbol's name.  A stretch whose
   words also stand earlier under the same symbol is repeated as a whole.  One whose symbol occurs in no
   other stretch has no copy.
2. Of the others, first stretches of symbols that occur in several contexts, each window is dealt by its
   own 128-bit name, and all but the first of equal windows are repeated.
3. The findings meet the texts again, by row.

The earliest copy of a window never lies in a stretch found repeated in step 1, so step 2 sees it.  Within
a chunk only the first of equal stretches or windows is sent on by name, the rest by row: what a third of
all texts share reaches its task with a row for each chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.llm.packed import SCHEMA, SPREAD, dealt, first_of_groups, pack, partitions_for, unpack
from spokecast.llm.text import Names, chunks, give_back, mix, owner, pick, string_column, sums, texts, whole_windows, window_names

WIDTH = 20
#: A third round's symbols are decided by so many words that few windows hold one.
ROUNDS = 2
CHUNK_BYTES = 2 << 20
#: Text bytes for each partition.
BYTES_EACH = 128 << 20
#: A stretch has at most so many windows, then its first and last window cover all its words.
STRETCH = 20

FAR = 1 << 40
REPEATED, SHARED = 1, 2
STRETCHES = ["u8", "u8", "u8", "i8", "i4", "u1", "u1"]
WINDOWS = ["u8", "u8", "u8", "i8", "i4", "u1"]


def symbols(names: np.ndarray, of: np.ndarray, rounds: int = ROUNDS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each round the symbols made in it: name, and the words (begin, end) that decide on it.

    Round 0 has the words themselves.  Where a text's edge decides, the interval is endless.
    """
    name, begin, end, text = names, np.arange(len(names)), np.arange(1, len(names) + 1), of
    out = [(name, begin, end)]
    for r in range(1, rounds + 1):
        if len(name) < 2:
            break
        joined = text[1:] == text[:-1]
        if r % 2:  # runs; that a neighbour differs is part of what decides
            same = joined & (name[1:] == name[:-1])
            head = np.append(True, ~same)
            at = np.flatnonzero(head)
            length = np.diff(np.append(at, len(name)))
            before = np.append(-FAR, np.where(joined, begin[:-1], -FAR))
            after = np.append(np.where(joined, end[1:], FAR), FAR)
            last = at + length - 1
            begin, end = np.minimum(begin[at], before[at]), np.maximum(end[last], after[last])
            name = np.where(length > 1, mix(name[at] * np.uint64(5) + length.astype(np.uint64)), name[at])
            text = text[at]
            joined = text[1:] == text[:-1]
        right = (mix(name + np.uint64(r * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(63)).astype(bool)
        pair = np.append(joined & ~right[:-1] & right[1:], False)
        second = np.append(False, pair[:-1])
        before = np.append(-FAR, np.where(joined, begin[:-1], -FAR))
        after = np.append(np.where(joined, end[1:], FAR), FAR)
        made = np.flatnonzero(pair)
        name, begin, end = name.copy(), begin.copy(), end.copy()
        alone_left, alone_right = ~pair & ~right, ~second & right
        new_name = mix(mix(name[made] + np.uint64(r)) * np.uint64(3) + name[made + 1])
        new_end = end[made + 1]
        end[alone_left] = np.maximum(end, after)[alone_left]
        begin[alone_right] = np.minimum(begin, before)[alone_right]
        name[made], end[made] = new_name, new_end
        out.append((new_name, begin[made], new_end))
        kept = ~second
        name, begin, end, text = name[kept], begin[kept], end[kept], text[kept]
    return out


def anchors(names: np.ndarray, first: np.ndarray, width: int, rounds: int = ROUNDS) -> np.ndarray:
    """For each window in one text, the least name among the symbols of the highest round decided in it; else 0."""
    of = owner(first)
    inside = whole_windows(first, width)
    best = np.full(len(inside), np.iinfo(np.uint64).max, np.uint64)
    free = inside.copy()
    levels = symbols(names, of, rounds)
    powers = [window_names(names, 1 << k) for k in range(width.bit_length())]
    for r in range(len(levels) - 1, -1, -1):
        if not free.any():
            break
        name, begin, end = levels[r]
        low, high = np.maximum(end - width, 0), np.minimum(begin, len(inside) - 1)
        open_ = np.concatenate([[0], np.cumsum(free)])
        use = (end - begin <= width) & (begin >= 0) & (low <= high)
        use[use] = open_[high[use] + 1] > open_[low[use]]
        low, high, name = low[use], high[use], name[use]
        # The round is part of the name: a window's symbols of lower rounds are not looked at.
        key = (_with_context(name, begin[use], end[use], powers) >> np.uint64(4)) | np.uint64((15 - r) << 60)
        length = high - low + 1
        at = np.arange(length.sum()) + np.repeat(low - np.cumsum(length) + length, length)
        keep = free[at]
        np.minimum.at(best, at[keep], np.repeat(key, length)[keep])
        free &= best == np.iinfo(np.uint64).max
    best[~inside] = 0
    return best


def _with_context(name: np.ndarray, begin: np.ndarray, end: np.ndarray, powers: list[np.ndarray]) -> np.ndarray:
    """A symbol's name together with the words that decide on it: two windows of a power of two cover them."""
    out = mix(name)
    size = np.floor(np.log2(end - begin)).astype(int)
    for k, rolled in enumerate(powers):
        at = np.flatnonzero(size == k)
        if len(at):
            out[at] = mix(mix(out[at] + rolled[begin[at]]) * np.uint64(3) + rolled[end[at] - (1 << k)])
    return out


def _order(ids: pa.Array) -> np.ndarray:
    """Integer keys as unsigned numbers in the same order; null comes first."""
    signed = np.array([-(1 << 63) if x is None else x for x in ids.to_pylist()], np.int64)
    return signed.view(np.uint64) ^ np.uint64(1 << 63)


class _Chunk:
    def __init__(self, batch: pa.RecordBatch, names_of: Names):
        self.words = [t.split() for t in texts(batch, "text")]
        self.names, self.first = names_of.of(self.words)
        self.row = np.array(batch.column("row").to_pylist(), np.int64)
        self.doc = _order(batch.column("id"))


def _send_stretches(chunk: _Chunk, width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    best = anchors(chunk.names, chunk.first, width)
    if not len(best):
        return
    of = owner(chunk.first)[: len(best)]
    at = np.flatnonzero(best)
    head = np.ones(len(at), bool)
    head[1:] = (np.diff(at) != 1) | (best[at[1:]] != best[at[:-1]]) | (of[at[1:]] != of[at[:-1]])
    run = np.flatnonzero(head)
    since = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
    begin = np.flatnonzero(since % STRETCH == 0)
    count = np.diff(np.append(begin, len(at)))
    start = at[begin]
    rolled = window_names(chunk.names, width)
    periodic = np.zeros(len(begin), bool)  # a window of the stretch comes again in the same stretch
    number = np.full(len(best), -1)
    number[at] = np.repeat(np.arange(len(begin)), count)
    for period in range(1, STRETCH):
        again = np.flatnonzero(rolled[:-period] == rolled[period:])
        again = again[(number[again] == number[again + period]) & (number[again] >= 0)]
        periodic[number[again]] = True
    words = mix(mix(rolled[start] * np.uint64(3) + rolled[start + count - 1]) + count.astype(np.uint64))
    text = of[start]
    columns = [best[start], words, chunk.doc[text], chunk.row[text], (start - chunk.first[text]).astype("i4"), count.astype("u1")]
    order = np.lexsort(columns[4::-1])
    columns, periodic = [c[order] for c in columns], periodic[order]
    new = first_of_groups(columns[0], columns[1])
    flag = np.where(new, 0, REPEATED).astype("u1")
    kept = np.flatnonzero(new)
    head = first_of_groups(columns[0][kept])
    group = np.cumsum(head) - 1
    several = np.bincount(group)[group] > 1
    flag[kept[several | periodic[kept]]] = SHARED
    by_name = (columns[0] >> np.uint64(8)) % np.uint64(buckets)
    scattered = mix(columns[1] + columns[3].view(np.uint64)) % np.uint64(buckets)
    sent_by_name = np.zeros(len(new), bool)
    sent_by_name[kept[head | ~several]] = True
    yield from _packed(np.where(sent_by_name, by_name, scattered), [*columns, flag])


def _packed(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((columns[4], columns[3]))
    yield from pack(bucket[order].astype(np.int64), [c[order] for c in columns])


def _replies(row: np.ndarray, kind: np.ndarray, start: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One value for each row: (start, windows, kind) of all its findings."""
    order = np.lexsort((start, row))
    row = row[order]
    data = np.stack([start[order], count[order], kind[order]], axis=1).astype("<i4")
    cuts = np.append(np.flatnonzero(first_of_groups(row)), len(row))
    if len(row):
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[cuts[:-1]]), pa.array([data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
            names=["row", "found"],
        )


def _judge_stretches(data: list[bytes]) -> Iterator[pa.RecordBatch]:
    name, words, doc, row, start, count, flag = unpack(data, STRETCHES)
    gone = (flag & REPEATED).astype(bool)
    at = np.flatnonzero(~gone)
    at = at[np.lexsort((start[at], row[at], doc[at], words[at], name[at]))]
    new = first_of_groups(name[at], words[at])
    gone[at[~new]] = True
    group = np.cumsum(first_of_groups(name[at])) - 1
    several = np.bincount(group, weights=new) > 1
    several |= np.bincount(group, weights=(flag[at] & SHARED) > 0) > 0
    unsure = at[new & several[group]] if len(at) else at
    chosen = np.concatenate([np.flatnonzero(gone), unsure])
    kind = np.concatenate([np.ones(gone.sum(), np.int32), np.zeros(len(unsure), np.int32)])
    yield from _replies(row[chosen], kind, start[chosen], count[chosen])


def _spans(found: list[bytes | None], first: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """The findings of one kind of all texts: their first words' places in the row of all words, and window counts."""
    parts, at = [], []
    for i, f in enumerate(found):
        if f:
            part = np.frombuffer(f, "<i4").reshape(-1, 3)
            part = part[part[:, 2] == kind]
            parts.append(part)
            at.append(part[:, 0] + first[i])
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(at).astype(np.int64), np.concatenate(parts)[:, 1].astype(np.int64)


def _send_windows(chunk: _Chunk, found: list[bytes | None], width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    start, count = _spans(found, chunk.first, 0)
    at = np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)
    if not len(at):
        return
    text = owner(chunk.first)[at]
    keys = [window_names(chunk.names, width, seed)[at] for seed in (1, 2)]
    columns = [*keys, chunk.doc[text], chunk.row[text], (at - chunk.first[text]).astype("i4")]
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = first_of_groups(*columns[:2])
    bucket = np.where(new, columns[0] >> np.uint64(8), mix(columns[1] + columns[3].view(np.uint64))) % np.uint64(buckets)
    yield from _packed(bucket, [*columns, np.where(new, 0, REPEATED).astype("u1")])


def _judge_windows(data: list[bytes]) -> Iterator[pa.RecordBatch]:
    one, two, doc, row, start, flag = unpack(data, WINDOWS)
    gone = flag > 0
    at = np.flatnonzero(~gone)
    at = at[np.lexsort((start[at], row[at], doc[at], two[at], one[at]))]
    gone[at[~first_of_groups(one[at], two[at])]] = True
    chosen = np.flatnonzero(gone)
    ones = np.ones(len(chosen), np.int32)
    yield from _replies(row[chosen], ones, start[chosen], ones)


def _received(judge):
    def run(batches: Iterator[pa.RecordBatch]):
        yield from judge([d for batch in batches for d in batch.column("data").to_pylist()])
        give_back()

    return run


def _by_chunk(send, *more):
    def run(batches: Iterator[pa.RecordBatch]):
        names_of = Names()
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                chunk = _Chunk(part, names_of)
                yield from send(chunk, *(_together(part.column(c).to_pylist()) for c in more))
        give_back()

    return run


def _together(lists: list[list[bytes] | None]) -> list[bytes | None]:
    return [b"".join(x) if x else None for x in lists]


def repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), keep_text: bool = False) -> DataFrame:
    """Per document: the key, ``n_words``, ``n_removed``, ``removed`` spans of words, and the ``kept`` words.

    A word goes if a window of ``width`` words that covers it also starts earlier: in a document with a
    smaller key, or in the same one before it.  Windows are judged on the input.  Words are runs of anything
    but space and U+0009 to U+000D; ``kept`` joins them by one space.  Null and empty texts, and those of
    fewer words than a window, lose nothing.  Keys are integers; a null key counts as the smallest, and of
    rows with equal keys the one read first counts as earlier.  ``carry`` names columns to hand
    on, ``keep_text`` hands on the text too.
    """
    spark = docs.sparkSession
    names = [id_col, text_col, *carry]
    slim = pick(docs, *names).toDF("id", "text", *(f"x{i}" for i in range(len(carry))))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = partitions_for(spark, size, BYTES_EACH)
    buckets = partitions * SPREAD
    # All passes take all columns, so that they read one and the same shuffle.
    rows = slim.withColumn("row", F.monotonically_increasing_id()).repartition(partitions, "row")

    sent = rows.mapInArrow(_by_chunk(lambda c: _send_stretches(c, width, buckets)), SCHEMA)
    replies = dealt(sent, partitions).mapInArrow(_received(_judge_stretches), "row bigint, found binary")
    # By the same partitions as the texts, which then stay where they are.
    stretches = replies.repartition(partitions, "row").groupBy("row").agg(F.collect_list("found").alias("found"))
    unsure = rows.join(stretches, "row")
    sent = unsure.mapInArrow(_by_chunk(lambda c, found: _send_windows(c, found, width, buckets), "found"), SCHEMA)
    replies = dealt(sent, partitions).mapInArrow(_received(_judge_windows), "row bigint, found binary")
    windows = replies.repartition(partitions, "row").groupBy("row").agg(F.collect_list("found").alias("more"))

    def cut(chunk: _Chunk, part: pa.RecordBatch):
        gone = np.zeros(len(chunk.names), bool)
        for column in ("found", "more"):
            start, count = _spans(_together(part.column(column).to_pylist()), chunk.first, 1)
            change = np.zeros(len(gone) + 1, np.int32)
            np.add.at(change, start, 1)
            np.add.at(change, start + count + width - 1, -1)
            gone |= np.cumsum(change[:-1]) > 0
        return gone

    def apply(batches: Iterator[pa.RecordBatch]):
        names_of = Names()
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                chunk = _Chunk(part, names_of)
                gone = cut(chunk, part)
                removed = sums(gone, chunk.first)
                kept, spans = [], []
                for i, words in enumerate(chunk.words):
                    if removed[i]:
                        own = gone[chunk.first[i] : chunk.first[i + 1]]
                        kept.append(b" ".join([w for w, g in zip(words, own.tolist(), strict=True) if not g]))
                        edge = np.diff(np.concatenate([[0], own.view(np.int8), [0]]))
                        ends = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)
                        spans.append([{"begin": a, "end": b} for a, b in ends])
                    else:
                        kept.append(b" ".join(words))
                        spans.append([])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(np.diff(chunk.first)),
                        pa.array(removed),
                        pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                        string_column(kept),
                        *([part.column("text")] if keep_text else []),
                        *(part.column(f"x{i}") for i in range(len(carry))),
                    ],
                    schema=out_schema,
                )
        give_back()

    kind = slim.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words bigint, n_removed bigint, removed array<struct<begin:int,end:int>>, kept string"
    schema += ", text string" if keep_text else ""
    schema += "".join(f", x{i} {slim.schema[f'x{i}'].dataType.simpleString()}" for i in range(len(carry)))
    out_schema = _arrow_schema(spark, schema)
    met = rows.join(stretches, "row", "left").join(windows, "row", "left")
    out = met.mapInArrow(apply, schema)
    own = ["n_words", "n_removed", "removed", "kept"]
    return out.toDF(id_col, *own, *([text_col] if keep_text else []), *carry)


def _arrow_schema(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def without_repeats(
    docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None
) -> DataFrame:
    """``docs`` without the repeated words; a text that loses none stays as it is, to the last space.

    Every row stays, an empty text where all its words go.  Null and empty texts stay as they are.  Rows without a
    key come before all others, and of rows with equal keys the one read first keeps its words.  ``length_col`` names
    a column that follows the text's length in characters.  All columns are handed on, whatever their names.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    key, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    rest = tuple(c for c in names if c not in (key, text))
    found = repeats(docs.toDF(*names), width, key, text, carry=rest, keep_text=True)
    left = found.withColumn(text, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(text)))
    if length_col:
        length = names[docs.columns.index(length_col)]
        kind = docs.schema[docs.columns.index(length_col)].dataType
        left = left.withColumn(length, F.when(F.col("n_removed") > 0, F.length(text).cast(kind)).otherwise(F.col(length)))
    return left.select(*names).toDF(*docs.columns)
