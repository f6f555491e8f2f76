"""Benchmark decontamination: windows of benchmark words looked up in the windows of every document.

The distinct windows of the benchmark, which is bounded by a checked size, are broadcast as a hash set;
each task rolls window names over its documents, looks them up and verifies hits word by word.
A benchmark beyond the bound is cut into blocks by hash of item and text, and every block meets all documents.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.llm.text import CHUNK_BYTES, Names, Shared, chunks, covered, give_back, map_chunks, owner, pick, sums, texts, window_names, whole_windows

WIDTH = 13
#: Bytes of benchmark text that may be broadcast at once.
BROADCAST_BYTES = 32 << 20

#: Every byte to itself in lower case if it belongs to a word, else to a space: digits, a to z and all
#: bytes of characters beyond ASCII belong to words.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
FILTER_BITS = 22


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Windows:
    """The windows of the benchmark: by width, their sorted names and the words and items of each."""

    def __init__(self, items: list[tuple[int, bytes]], width: int = WIDTH):
        self.found: dict[int, dict[tuple[bytes, ...], set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = words_of(text)
            size = min(width, len(words))
            for i in range(len(words) - size + 1) if size else ():
                self.found[size][tuple(words[i : i + size])].add(item)
        names_of, self.tables = Names(), {}
        for size, windows in self.found.items():
            names = window_names(names_of.of([[w for key in windows for w in key]])[0], size)[::size]
            table = np.zeros(1 << FILTER_BITS, bool)
            table[names >> np.uint64(64 - FILTER_BITS)] = True
            self.tables[size] = (np.sort(names), table)
        self.found = {size: dict(windows) for size, windows in self.found.items()}

    def hits(self, words: list[list[bytes]], names: np.ndarray, first: np.ndarray):
        """Which words are hit, and the items found in each text."""
        of, hit = owner(first), np.zeros(len(names), bool)
        items: list[set] = [set() for _ in words]
        for size, (known, table) in self.tables.items():
            rolled = window_names(names, size)
            at = np.flatnonzero(table[rolled >> np.uint64(64 - FILTER_BITS)])
            at = at[np.isin(rolled[at], known) & whole_windows(first, size)[at]]
            sure = []
            for i, doc in zip(at.tolist(), of[at].tolist(), strict=True):
                begin = i - int(first[doc])
                if found := self.found[size].get(tuple(words[doc][begin : begin + size])):
                    items[doc] |= found
                    sure.append(i)
            if sure:
                hit |= covered(np.array(sure), size, len(names))
        return hit, items


def _blocks(benchmark: DataFrame, most: int) -> list[DataFrame]:
    """The benchmark in parts that may each be broadcast; one part unless its size, summed first, is beyond the bound.

    Parts are cut by hash of item and text, of equal rows one is kept.  Each part's size is summed before any is
    used, and a part beyond the bound is cut in two until it fits or is a single row.
    """
    size = F.sum(F.octet_length("text") + 16)
    parts = int((benchmark.agg(size).first()[0] or 0) // most) + 1
    if parts == 1:
        return [benchmark]
    rows, out, open_ = benchmark.distinct(), [], list(range(parts))
    while open_:
        part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
        sums = rows.groupBy(part.alias("part")).agg(size.alias("size"), F.count("*").alias("n")).where(F.col("part").isin(open_)).collect()
        out += [rows.where(part == r.part) for r in sums if r.size <= most or r.n == 1]
        open_ = [i for r in sums if r.size > most and r.n > 1 for i in (r.part, r.part + parts)]
        parts *= 2
    return out


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per document: the key, ``n_words``, ``spans`` of hit words and the sorted ``items`` found.

    A span is (begin, end), counted in words, end excluded; spans of a document do not touch.  Null and empty
    texts have no words and no spans; items without words have no window.  Documents with equal keys
    are judged one by one; items with equal keys count as one item, also those without a key: their windows are
    hits, and a null stands last in ``items``.  A single text above the
    bound is a block by itself.
    """
    slim = pick(docs, id_col, text_col).toDF("id", "text")
    bench = pick(benchmark, item_col, item_text_col).toDF("item", "text").where("text IS NOT NULL")
    kinds = slim.schema["id"].dataType.simpleString(), bench.schema["item"].dataType.simpleString()
    schema = f"id {kinds[0]}, row bigint, n_words bigint, spans array<struct<begin:int,end:int>>, items array<{kinds[1]}>"
    slim = slim.withColumn("row", F.monotonically_increasing_id())
    found = [_find_block(slim, block, schema, width) for block in _blocks(bench, broadcast_bytes)]
    if len(found) == 1:
        out = found[0]
    else:  # a row's findings of all blocks meet again
        out = (
            reduce(DataFrame.unionAll, found)
            .groupBy("row")
            .agg(
                F.first("id").alias("id"),
                F.first("n_words").alias("n_words"),
                F.flatten(F.collect_list("spans")).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            )
            .withColumn("spans", _joined_spans("spans"))
        )
    return out.drop("row").withColumnRenamed("id", id_col)


def _joined_spans(spans: str):
    """Spans in order, those that overlap or touch made one."""
    empty = F.expr("CAST(array() AS array<struct<begin:int,end:int>>)")

    def add(done, span):
        last = F.element_at(done, -1)
        longer = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"))
        touches = (F.size(done) > 0) & F.coalesce(F.try_element_at(done, F.lit(-1))["end"] >= span["begin"], F.lit(False))
        return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), empty, add)


def _shared(block: DataFrame, width: int) -> Shared:
    """The items of one block, bounded by ``_blocks``, on their way to the workers."""
    items = [(r.item, r.text.encode()) for r in block.collect()]
    return Shared(block.sparkSession, items, lambda sent: Windows(sent, width))


def _find_block(slim: DataFrame, bench: DataFrame, schema: str, width: int) -> DataFrame:
    shared = _shared(bench, width)
    kind = schema.rsplit("array<", 1)[1][:-1]

    def make():
        windows, names_of = shared.tool(), Names()

        def work(batch):
            words = [words_of(t) for t in texts(batch, "text")]
            names, first = names_of.of(words)
            hit, items = windows.hits(words, names, first)
            spans: list[list] = [[] for _ in words]
            of = owner(first)
            edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
            for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
                while a < b:  # a run of hit words may cross into the next text
                    doc = int(of[a])
                    end = min(b, int(first[doc + 1]))
                    spans[doc].append({"begin": a - int(first[doc]), "end": end - int(first[doc])})
                    a = end
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("row"),
                    pa.array(np.diff(first)),
                    pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                    pa.array([sorted(x, key=lambda i: (i is None, i)) for x in items], pa.list_(pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string())),
                ],
                names=["id", "row", "n_words", "spans", "items"],
            )

        return work

    return map_chunks(slim, schema, "text", make)


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """``find``'s rows with ``n_hit`` and ``contaminated``: at least one word in ``share`` is hit."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda t, s: t + s["end"] - s["begin"])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", share: int = 20, width: int = WIDTH, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The documents that are not contaminated, with all their columns, null texts included.

    One pass: whether a row stays is decided where the row is read.  With a benchmark beyond the bound
    the rows pass once for each block and their hit words are united before they are judged.
    """
    place = docs.columns.index(text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("row", F.monotonically_increasing_id())
    bench = pick(benchmark, "item_id", "text").toDF("item", "text").where("text IS NOT NULL")
    blocks = _blocks(bench, broadcast_bytes)
    if len(blocks) > 1:
        judged_rows = judged(find(rows, benchmark, "row", f"c{place}", width=width, broadcast_bytes=broadcast_bytes), share)
        return rows.join(judged_rows.where("NOT contaminated").select("row"), "row", "left_semi").select(*names).toDF(*docs.columns)
    shared = _shared(blocks[0], width)
    rows = docs.toDF(*names)
    column = f"c{place}"

    def run(batches):
        windows, names_of = shared.tool(), Names()
        for batch in batches:
            for part in chunks(batch, column, CHUNK_BYTES):
                words = [words_of(t) for t in texts(part, column)]
                word_names, first = names_of.of(words)
                hit, _ = windows.hits(words, word_names, first)
                n_hit = sums(hit, first)
                yield part.filter(pa.array(~((n_hit > 0) & (share * n_hit >= np.diff(first)))))
        give_back()

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
