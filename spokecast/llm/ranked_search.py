"""Ranked lexical search over an index in strata of equal length normaliser.

The index groups documents by their normaliser m and keeps, for every term of a stratum, one list of documents for
each term frequency.  A list's documents thus have one impact, computed once from tf and m.  The largest tf of a term
in a stratum bounds what the stratum can give a query; strata are visited in the order of that bound, and those
that cannot reach the k-th best score found so far are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokecast.llm.text import Shared, chunks, give_back, pick
from spokecast.session import scratch_path

#: Terms are runs of ASCII letters, digits and all characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FOLD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Documents and terms of a block of a stratum, if it has more than one document.
BLOCK_DOCS, BLOCK_TERMS = 4096, 1 << 21
CHUNK_BYTES = 8 << 20
#: Queries that are searched at a time, and pairs of query and term, if they have more than one query.
QUERIES_EACH, PAIRS_EACH = 512, 1 << 16
#: Documents in the strata visited first.
FIRST_DOCS = 2000
#: Cells of the dense table of impacts that a task multiplies at a time.
CELLS = 1 << 21
#: Whole numbers up to here are exact in doubles.
EXACT = 1 << 53


def _terms(column: pa.Array) -> np.ndarray:
    """How many terms each text has."""
    found = column.cast(pa.binary()).to_pylist()
    return np.fromiter((len(t.translate(FOLD).split()) if t else 0 for t in found), np.int64, len(found))


def _lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, docs = np.unique(_terms(batch.column("text")), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(docs.astype(np.int64))], names=["n", "docs"])


def _with_length(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunks(whole, "text", CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_terms(batch.column("text")))], names=["id", "text", "row", "n"])


def _normaliser(n, docs: int, terms: int) -> F.Column:
    return F.expr(f"25 + ({n} * 75 * {docs}L) div {terms}L")


def build(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the index of all documents below ``path``, a folder that all executors reach.

    ``lengths`` has the number of documents of each length.  ``postings`` has for every block of a stratum a row
    without term that lists its documents' keys, and rows (term, tf) that list places in that row.  Null and
    empty texts and texts without terms are in no list.  Rows of equal keys are documents of their own; an
    empty table gives an empty index; other columns are not read.  A stratum is cut in blocks of
    ``BLOCK_DOCS`` documents and ``BLOCK_TERMS`` terms on average, whatever their keys and texts.
    """
    spark = docs.sparkSession
    slim = pick(docs, id_col, text_col).toDF("id", "text").where("text IS NOT NULL")
    kind = slim.schema["id"].dataType.simpleString()
    # Counted in Python: the same by regular expressions takes Spark many times as long.
    counted = slim.select("text").mapInArrow(_lengths, "n bigint, docs bigint").where("n > 0")
    counted.groupBy("n").agg(F.sum("docs").alias("docs")).write.parquet(f"{path}/lengths")
    strata = _strata(spark, path)
    if strata is None:
        spark.createDataFrame([], _schema(kind)).write.parquet(f"{path}/postings")
        return
    # One row for each length of a text; Spark broadcasts it while it is small.
    dealt = (
        slim.withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(_with_length, f"id {kind}, text string, row bigint, n bigint")
        .join(strata, "n")
        .select("m", F.expr("pmod(row, blocks)").alias("block"), "id", "text")
    )
    grouped = dealt.repartition("m", "block").sortWithinPartitions("m", "block")
    grouped.mapInArrow(_postings, _schema(kind)).write.parquet(f"{path}/postings")


def _schema(kind: str) -> str:
    return f"m bigint, block bigint, term string, tf bigint, n_docs bigint, places array<int>, keys array<{kind}>"


def _totals(spark: SparkSession, path: str) -> tuple[int, int]:
    """Documents with terms, and all their terms."""
    lengths = spark.read.parquet(f"{path}/lengths")
    found = lengths.agg(F.sum("docs").alias("docs"), F.sum(F.col("docs") * F.col("n")).alias("terms")).first()
    return found.docs or 0, found.terms or 0


def _strata(spark: SparkSession, path: str) -> DataFrame | None:
    """For each length n: its normaliser m, the documents of m, and the blocks they are dealt to."""
    docs, terms = _totals(spark, path)
    if not docs:
        return None
    lengths = spark.read.parquet(f"{path}/lengths").withColumn("m", _normaliser("n", docs, terms))
    sizes = lengths.groupBy("m").agg(F.sum("docs").alias("docs"), F.sum(F.col("docs") * F.col("n")).alias("terms"))
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.least(F.col("docs"), F.ceil(F.col("terms") / BLOCK_TERMS)))
    return lengths.select("n", "m").join(sizes.select("m", "docs", blocks.alias("blocks")), "m")


def _postings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come block by block; whole blocks are worked on together, some megabytes at a time."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for whole in batches:
        for batch in chunks(whole, "text", CHUNK_BYTES):
            m, block = (batch.column(c).to_numpy() for c in ("m", "block"))
            new = np.append(last is None or (m[0], block[0]) != last, (m[1:] != m[:-1]) | (block[1:] != block[:-1]))
            if size >= CHUNK_BYTES and new.any():
                cut = int(np.argmax(new))
                yield from _lists([*held, batch.slice(0, cut)])
                held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += batch.column("text").nbytes
            last = m[-1], block[-1]
    if held:
        yield from _lists(held)
    give_back()


def _lists(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    m, block, keys, text = (pa.concat_arrays([b.column(c) for b in held]) for c in ("m", "block", "id", "text"))
    m, block = m.to_numpy(), block.to_numpy()
    names: dict[bytes, int] = {}
    found: list[np.ndarray] = []
    for t in text.cast(pa.binary()).to_pylist():
        words = t.translate(FOLD).split()
        found.append(np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words)))
    terms = sorted(names)
    rank = np.empty(len(terms), np.int64)
    rank[[names[t] for t in terms]] = np.arange(len(terms))
    new = np.append(True, (m[1:] != m[:-1]) | (block[1:] != block[:-1]))
    group = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    place = np.arange(len(m)) - begin[group]
    # One number for each occurrence, ordered by block, term and document.
    doc = np.repeat(np.arange(len(m)), [len(f) for f in found])
    cell = (group[doc] * len(terms) + rank[np.concatenate(found)]) * len(m) + doc
    cell, tf = np.unique(cell, return_counts=True)
    cell, doc = np.divmod(cell, len(m))
    order = np.lexsort((tf, cell))  # stable: documents stay in order
    cell, tf, doc = cell[order], tf[order], doc[order]
    first = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (tf[1:] != tf[:-1])))
    of, term = np.divmod(cell[first], len(terms))
    n = np.diff(np.append(first, len(cell)))
    nothing = pa.nulls(len(begin), pa.string())
    ends = np.append(begin, len(m)).astype(np.int32)
    columns = [pa.array(x) for x in (m[begin], block[begin])]
    yield pa.RecordBatch.from_arrays(
        [
            *columns,
            nothing,
            pa.array(np.zeros(len(begin), np.int64)),
            pa.array(np.diff(ends).astype(np.int64)),
            pa.nulls(len(begin), pa.list_(pa.int32())),
            pa.ListArray.from_arrays(pa.array(ends), keys),
        ],
        names=["m", "block", "term", "tf", "n_docs", "places", "keys"],
    )
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(cell)).astype(np.int32)), pa.array(place[doc].astype(np.int32)))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(m[begin][of]),
            pa.array(block[begin][of]),
            pa.array(terms, pa.binary()).cast(pa.string()).take(pa.array(term)),
            pa.array(tf[first].astype(np.int64)),
            pa.array(n.astype(np.int64)),
            lists,
            pa.nulls(len(first), pa.list_(keys.type)),
        ],
        names=["m", "block", "term", "tf", "n_docs", "places", "keys"],
    )


def impact(tf, m):
    """What an occurrence count is worth in a stratum, in whole numbers."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def search(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text", key: str = "doc_id"
) -> DataFrame:
    """The ``k`` best documents of the index at ``path`` for each row of ``queries``.

    Returns the query's key, ``rank`` from 1, the document's key, and ``score`` above 0; equal scores are ranked by
    the document's key, those without one last.  A query without text or terms has no rows; queries with equal keys are
    searched each for itself.  Queries are taken in blocks of a proven size, and for each block the index is read:
    once for document frequencies and bounds, once for the strata of the highest bounds, and once for those others
    whose bound reaches the k-th best score of the first.
    """
    postings = spark.read.parquet(f"{path}/postings")
    kind = pick(queries, item_col).schema[0].dataType.simpleString()
    key_kind = postings.schema["keys"].dataType.elementType.simpleString()
    folded = F.translate("text", UPPER, LOWER)
    asked = (
        pick(queries, item_col, text_col)
        .toDF("item", "text")
        .withColumn("q", F.monotonically_increasing_id())
        .select("q", "item", F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("term"))
        .groupBy("q", "item", "term")
        .agg(F.count("*").alias("times"))
    )
    stored = scratch_path(spark, "queries")
    asked.write.parquet(stored)
    asked = spark.read.parquet(stored)
    out = spark.createDataFrame([], f"item {kind}, rank int, id {key_kind}, score bigint")
    strata = _strata(spark, path)
    if strata is not None:
        for block in _query_blocks(asked):
            out = out.unionAll(_search_block(spark, path, postings, strata, block, k, key_kind))
    return out.withColumnsRenamed({"item": item_col, "id": key})


def _query_blocks(asked: DataFrame) -> list[DataFrame]:
    """The queries by hash in blocks; each block's size is counted, and one beyond the bounds is cut in two."""
    parts, todo, out = 1, [0], []
    sizes = asked.groupBy("q").agg(F.count("*").alias("pairs"))
    while todo:
        part = F.pmod(F.xxhash64("q"), F.lit(parts))
        found = sizes.groupBy(part.alias("part")).agg(F.count("*").alias("queries"), F.sum("pairs").alias("pairs")).where(F.col("part").isin(todo))
        todo = []
        for r in found.collect():
            if r.queries == 1 or (r.queries <= QUERIES_EACH and r.pairs <= PAIRS_EACH):
                out.append(asked.where(part == r.part))
            else:
                todo += [r.part, r.part + parts]
        parts *= 2
    return out


def _search_block(spark: SparkSession, path: str, postings: DataFrame, strata: DataFrame, block: DataFrame, k: int, key_kind: str) -> DataFrame:
    docs, _ = _totals(spark, path)
    terms = block.select("term").distinct()
    best_tf = (
        postings.where("term IS NOT NULL")
        .join(F.broadcast(terms), "term")  # the terms of one block of queries
        .groupBy("term", "m")
        .agg(F.sum("n_docs").alias("n_docs"), F.max("tf").alias("tf"))
    )
    stored = scratch_path(spark, "bounds")
    best_tf.write.parquet(stored)
    best_tf = spark.read.parquet(stored)
    weights = best_tf.groupBy("term").agg(F.sum("n_docs").alias("df")).select(
        "term", F.floor(F.lit(1000) * F.log(F.lit(2.0 * docs + 2) / (2 * F.col("df") + 1))).alias("w")
    )
    # At most one block's pairs of query and term.
    pairs = block.join(weights, "term").select("q", "item", "term", "times", "w").collect()
    pairs = [p for p in pairs if p.w > 0]
    if not pairs:
        return spark.createDataFrame([], f"item {block.schema['item'].dataType.simpleString()}, rank int, id {key_kind}, score bigint")
    numbers = {q: i for i, q in enumerate(sorted({p.q for p in pairs}))}
    names = {t: i for i, t in enumerate(sorted({p.term for p in pairs}))}
    table = np.array([(names[p.term], numbers[p.q], p.times * p.w) for p in pairs], np.int64).reshape(-1, 3)
    weighted = spark.createDataFrame([(numbers[p.q], p.term, p.times * p.w) for p in pairs], "q int, term string, weight bigint")
    known = F.broadcast(spark.createDataFrame(list(names.items()), "term string, t int"))
    sizes = strata.select("m", "docs").distinct()
    worth = F.expr("1000000000 * tf div (1000 * tf + 8 * m)")
    by_bound = Window.partitionBy("q").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    stored = scratch_path(spark, "visits")
    (
        F.broadcast(weighted)
        .join(best_tf.select("term", "m", worth.alias("worth")), "term")
        .groupBy("q", "m")
        .agg(F.sum(F.col("weight") * F.col("worth")).alias("bound"))
        .join(sizes, "m")
        .select("q", "m", "bound", F.coalesce(F.sum("docs").over(by_bound), F.lit(0)).alias("before"))
        .write.parquet(stored)
    )
    visits = spark.read.parquet(stored)

    def scored(visited: DataFrame, least: np.ndarray, safe: bool) -> DataFrame:
        wanted = visited.groupBy("m").agg(F.sort_array(F.collect_list("q")).alias("queries"))
        heads = postings.where("term IS NULL").join(wanted, "m").withColumn("t", F.lit(None).cast("int"))
        lists = postings.where("term IS NOT NULL").join(known, "term").join(wanted.select("m"), "m")
        columns = ("m", "block", "t", "tf", "places", "keys")
        rows = heads.select(*columns, "queries").unionAll(lists.select(*columns, F.lit(None).cast("array<int>")))
        grouped = rows.repartition("m", "block").sortWithinPartitions("m", "block", F.col("t").asc_nulls_first())
        shared = Shared(spark, (table, len(numbers), len(names), least, k, safe), lambda x: _Scorer(*x))
        return grouped.mapInArrow(lambda batches: shared.tool().run(batches), f"q int, id {key_kind}, score bigint")

    safe = (visits.agg(F.max("bound")).first()[0] or 0) < EXACT
    first_path = scratch_path(spark, "first")
    scored(visits.where(F.col("before") < FIRST_DOCS), np.ones(len(numbers), np.int64), safe).write.parquet(first_path)
    first = spark.read.parquet(first_path)
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    ranked = first.withColumn("rank", F.row_number().over(best))
    least = np.ones(len(numbers), np.int64)
    for r in ranked.where(F.col("rank") == k).select("q", "score").collect():
        least[r.q] = r.score
    rest = _remaining(visits, least)
    both = first.unionAll(scored(rest, least, safe))
    items = block.select("q", "item").distinct().join(F.broadcast(spark.createDataFrame(list(numbers.items()), "q bigint, number int")), "q")
    top = both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.join(F.broadcast(items.select(F.col("number").alias("q"), "item")), "q").select("item", "rank", "id", "score")


def _remaining(visits: DataFrame, least: np.ndarray) -> DataFrame:
    """Strata not visited yet whose bound reaches a query's k-th best score."""
    reached = visits.sparkSession.createDataFrame([(i, x) for i, x in enumerate(least.tolist())], "q int, least bigint")
    return visits.where(F.col("before") >= FIRST_DOCS).join(F.broadcast(reached), "q").where("bound >= least")


class _Scorer:
    """Scores the documents of whole blocks for the queries that visit their stratum, and keeps each query's best."""

    def __init__(self, table: np.ndarray, queries: int, terms: int, least: np.ndarray, k: int, safe: bool):
        self.least, self.k = least, k
        self.kind = np.float64 if safe else np.int64
        self.weights = np.zeros((terms, queries), self.kind)
        self.weights[table[:, 0], table[:, 1]] = table[:, 2]

    def run(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, least = None, self.least.copy()
        open_: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            m, block = (batch.column(c).to_numpy() for c in ("m", "block"))
            cuts = (np.flatnonzero((m[1:] != m[:-1]) | (block[1:] != block[:-1])) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if open_ and (m[a], block[a]) != last:
                    best = self._kept(best, self._block(open_, least), least)
                    open_ = []
                open_.append(batch.slice(a, b - a))
                last = m[a], block[a]
        if open_:
            best = self._kept(best, self._block(open_, least), least)
        if best is not None:
            yield from best.select(["q", "id", "score"]).to_batches()
        give_back()

    def _block(self, parts: list[pa.RecordBatch], least: np.ndarray) -> pa.Table:
        head = parts[0]
        keys, queries = head.column("keys")[0].values, head.column("queries")[0].values.to_numpy()
        m = head.column("m")[0].as_py()
        rows = [p.slice(1) if i == 0 else p for i, p in enumerate(parts)]
        t, tf = (np.concatenate([r.column(c).to_numpy(zero_copy_only=False) for r in rows]) for c in ("t", "tf"))
        t, tf = t.astype(np.int64), tf.astype(np.int64)
        sizes = np.concatenate([pc.list_value_length(r.column("places")).to_numpy(zero_copy_only=False) for r in rows]).astype(np.int64)
        place = np.concatenate([r.column("places").flatten().to_numpy() for r in rows]).astype(np.int64)
        own, column = np.unique(t, return_inverse=True)
        column, worth = np.repeat(column, sizes), np.repeat(impact(tf, m), sizes)
        weights = self.weights[own][:, queries]
        step = max(1, CELLS // max(1, len(own)))
        order = np.argsort(place, kind="stable")
        place, column, worth = place[order], column[order], worth[order]
        found = []
        for begin in range(0, len(keys), step):
            a, b = np.searchsorted(place, [begin, begin + step])
            impacts = np.zeros((min(step, len(keys) - begin), len(own)), self.kind)
            impacts[place[a:b] - begin, column[a:b]] = worth[a:b]
            scores = (impacts @ weights).astype(np.int64)
            floor = least[queries]
            if len(scores) > self.k:
                floor = np.maximum(floor, np.partition(scores, -self.k, axis=0)[-self.k])
            doc, q = np.nonzero(scores >= floor)
            found.append((doc + begin, queries[q], scores[doc, q]))
        doc, q, score = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"q": pa.array(q.astype(np.int32)), "id": keys.take(pa.array(doc)), "score": pa.array(score)})

    def _kept(self, best: pa.Table | None, more: pa.Table, least: np.ndarray) -> pa.Table | None:
        """The best so far with ``more``; ``least`` rises to the k-th score of each query that has as many."""
        if not more.num_rows:
            return best
        both = more if best is None else pa.concat_tables([best, more])
        order = pc.sort_indices(both, [("q", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_end")
        both = both.take(order)
        q = both.column("q").to_numpy()
        rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        last = rank == self.k - 1
        least[q[last]] = np.maximum(least[q[last]], both.column("score").to_numpy()[last])
        return both.filter(pa.array(rank < self.k)).combine_chunks()
