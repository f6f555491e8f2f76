"""N-gram Jaccard self-join: documents that share enough word shingles, and their components.

Two sets of similarity ``t`` differ in at most a known number D of shingles.  A document's shingles are dealt by
hash into more than D token classes; all its shingles of one class are one k-token combination, a single
token where the class has no other.  A similar pair differs in D classes at most, so of its f
combinations a document shares f - D at least.  Combinations are ordered rare ones first, which no other document
has, then the frequent ones of many tokens before those of few; the prefix of D + 1 combinations holds one that the pair
shares, and single tokens, which documents share by chance, stand behind it.
Documents whose prefix is all rare have no partner, the others are indexed by the frequent combinations of
their prefix.  What is connected through the index is verified shingle by shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.llm.graph import components
from spokecast.llm.marks import Marks, without
from spokecast.llm.packed import SCHEMA, buckets_for, dealt, first_of_groups, pack, partitions_for, unpack
from spokecast.llm.text import CHUNK_BYTES, LOWER, Names, chunks, give_back, map_chunks, mix, owner, pick, texts, whole_windows, window_names
from spokecast.session import cut_lineage, scratch_path

#: Combinations that one task sorts, and shingles of a group that one task compares.
KEYS_EACH = 1 << 21
GROUP_SHINGLES = 1 << 19
#: Each size class ends at so many times its begin; two sets similar by two thirds are in the same class or in neighbours.
CLASS_RATIO = 1.5
#: Per cent of token classes beyond those that can differ: the more, the fewer documents share enough by chance.
SPARE = 60
#: Shingles from which on combinations count as equally large: what four bits of a name hold.
MOST_HELD = 15


class Sizes:
    """Size classes, and the number of token classes for each."""

    def __init__(self, percent: int):
        bounds = [1]
        while bounds[-1] < 1 << 50:
            bounds.append(max(bounds[-1] + 1, int(bounds[-1] * CLASS_RATIO)))
        self.percent, self.bounds = percent, np.array(bounds)
        # y shingles and at most y / t on the other side: they differ in y (1 - t) / t at most.
        self.differ = (self.bounds[1:] - 1) * (100 - percent) // percent
        self.classes = self.differ + 1 + (self.differ * SPARE + 99) // 100
        #: The largest size of each class.
        self.most = self.bounds[1:] - 1
        #: Size classes from that of a set's least partner to its own, at most.
        self.named = int((np.arange(len(bounds)) - self.of_least_partner(self.bounds)).max()) + 1

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, sizes, side="right") - 1

    def of_least_partner(self, sizes: np.ndarray) -> np.ndarray:
        return self.of((sizes * self.percent + 99) // 100)

    def may_differ(self, sizes: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Shingles that each set and a partner may have one without the other, where they meet in size class ``kind``:
        in a set's own the partner can be larger, in one below it is no larger than the class allows.
        """
        smaller = (sizes + np.minimum(sizes, self.most[kind])) * (100 - self.percent) // (100 + self.percent)
        return np.where(self.of(sizes) == kind, sizes * (100 - self.percent) // self.percent, smaller)


def shingle_sets(words: list[list[bytes]], names_of: Names, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle names of all texts in a row, sorted within each, and where each text begins.

    A text of fewer words than ``width``, but not none, has its whole sequence as its one shingle.
    """
    names, first = names_of.of(words)
    rolled = window_names(names, width)[whole_windows(first, width)] if len(names) >= width else np.empty(0, np.uint64)
    counts = np.diff(first)
    ends = np.cumsum(np.maximum(counts - width + 1, 0)).tolist()
    sets, begin = [], 0
    for i, end in enumerate(ends):
        if end > begin:
            own = np.sort(rolled[begin:end])
            sets.append(own[first_of_groups(own)])
        elif counts[i]:
            sets.append(window_names(names[first[i] : first[i + 1]], int(counts[i]), seed=int(counts[i])))
        else:
            sets.append(names[:0])
        begin = end
    at = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=at[1:])
    return np.concatenate([names[:0], *sets]), at


def combinations(tokens: np.ndarray, first: np.ndarray, sizes: Sizes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the sets' own size class and each one below, down to that of their least partner: the names of all
    combinations, where each set's begin, and how many combinations of a set a partner may lack beyond its prefix.

    A set with no more combinations than may differ has its empty classes named too, and all as its prefix.
    Names of combinations of more shingles are less.
    """
    count = np.diff(first)
    spread, value = mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), mix(tokens)
    own, least = sizes.of(np.maximum(count, 1)), sizes.of_least_partner(np.maximum(count, 1))
    of, out = owner(first), []
    for below in range(sizes.named):
        kind, chosen = np.maximum(own - below, 0), (count > 0) & (own - below >= least)
        classes = np.where(chosen, sizes.classes[kind], 0)
        begin = np.concatenate([[0], np.cumsum(classes)])
        mine = chosen[of]
        place = begin[of[mine]] + (spread[mine] % np.maximum(classes, 1)[of[mine]].astype(np.uint64)).astype(np.int64)
        total, held = np.zeros(begin[-1], np.uint64), np.bincount(place, minlength=begin[-1])
        np.add.at(total, place, value[mine])
        filled = held > 0
        of_class = np.repeat(np.arange(len(count)), classes)
        full = np.bincount(of_class, filled, len(count)).astype(np.int64)
        differ = sizes.may_differ(np.maximum(count, 1), kind)
        few = full <= differ
        used = filled | few[of_class]
        label = (kind[of_class] << 32) + np.arange(begin[-1]) - begin[of_class]
        weak = np.uint64(MOST_HELD) - np.minimum(held[used], MOST_HELD).astype(np.uint64)
        names = weak << np.uint64(60) | mix(mix(total[used]) + mix(label[used].astype(np.uint64))) >> np.uint64(4)
        at = np.concatenate([[0], np.cumsum(np.bincount(of_class[used], minlength=len(count)))])
        out.append((names, at, np.where(few, 0, full - differ - 1)))
    return out


def _tokens(batch: pa.RecordBatch, names_of: Names, width: int) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets([t.translate(LOWER).split() for t in texts(batch, "text")], names_of, width)


def _meta(rows: DataFrame, width: int, sizes: Sizes) -> DataFrame:
    """Per row its key, size and fingerprint of the set, and how many combinations it has."""

    def make():
        names_of = Names()

        def work(batch):
            tokens, first = _tokens(batch, names_of, width)
            prints = []
            for seed in (1, 2):
                total = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens + np.uint64(seed)), dtype=np.uint64)])
                prints.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            n_keys = sum((np.diff(at) for _, at, _ in combinations(tokens, first, sizes)), np.zeros(batch.num_rows, np.int64))
            columns = [batch.column("row"), batch.column("id"), *map(pa.array, (np.diff(first), *prints, n_keys))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "n_shingles", "print1", "print2", "n_keys"])

        return work

    kind = rows.schema["id"].dataType.simpleString()
    return map_chunks(rows, f"row bigint, id {kind}, n_shingles bigint, print1 bigint, print2 bigint, n_keys bigint", "text", make)


SENT = ["u8", "i8", "i4", "u1", "u1"]
KNOWN = 1


def _prefixes(rows: DataFrame, width: int, partitions: int, n_keys: int, sizes: Sizes) -> DataFrame:
    """Per row with any the frequent combinations (``keys``) of its prefix.

    Combinations take as much room as the texts, so they are made where they are sent and not stored.

    Within a chunk, a combination that several rows have is known to be frequent; one row asks for it by
    name, to tell the other chunks, and the rest go by row.
    """
    buckets = np.uint64(buckets_for(n_keys, partitions, KEYS_EACH))

    def send(batches: Iterator[pa.RecordBatch]):
        held: list[tuple[np.ndarray, ...]] = []
        names_of, amount = Names(), 0

        def out():
            if not held:
                return
            keys, row, spare, kind = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((row, keys))
            keys, row, spare, kind = keys[order], row[order], spare[order], kind[order]
            new = first_of_groups(keys)
            group = np.cumsum(new) - 1
            several = np.bincount(group)[group] > 1
            bucket = np.where(new, keys >> np.uint64(20), mix(row.view(np.uint64))) % buckets
            order = np.argsort(row, kind="stable")
            yield from pack(bucket[order].astype(np.int64), [c[order] for c in (keys, row, spare, kind, np.where(several, KNOWN, 0).astype("u1"))])

        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                number = part.column("row").to_numpy()
                for kind, (keys, at, spare) in enumerate(combinations(*_tokens(part, names_of, width), sizes)):
                    n = np.diff(at)
                    held.append((keys, np.repeat(number, n), np.repeat(spare.astype("i4"), n), np.full(len(keys), kind, "u1")))
                    amount += len(keys)
                if amount >= 1 << 19:
                    yield from out()
                    held.clear()
                    amount = 0
        yield from out()
        give_back()

    def receive(batches: Iterator[pa.RecordBatch]):
        keys, row, spare, kind, flag = unpack([d for b in batches for d in b.column("data").to_pylist()], SENT)
        order = np.argsort(keys, kind="stable")
        keys, row, spare, kind, flag = keys[order], row[order], spare[order], kind[order], flag[order]
        group = np.cumsum(first_of_groups(keys)) - 1
        frequent = (np.bincount(group) > 1)[group] | (flag == KNOWN)
        at = np.flatnonzero(frequent)
        at = at[np.argsort(row[at], kind="stable")]
        columns = [c[at] for c in (keys, row, spare, kind)]
        yield from pack((mix(columns[1].view(np.uint64)) % buckets).astype(np.int64), columns)
        give_back()

    def choose(batches: Iterator[pa.RecordBatch]):
        keys, row, spare, kind = unpack([d for b in batches for d in b.column("data").to_pylist()], SENT[:4])
        order = np.lexsort((keys, kind, row))
        keys, row, spare, kind = keys[order], row[order], spare[order], kind[order]
        new = first_of_groups(row, kind)
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(keys)))
        place = np.arange(len(keys)) - np.repeat(begin, size)
        used = np.flatnonzero(place < np.repeat(size, size) - spare)
        cuts = np.append(np.flatnonzero(first_of_groups(row[used])), len(used)).tolist()
        if len(used):
            data = [keys[used[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(row[used[cuts[:-1]]]), pa.array(data, pa.binary())], names=["row", "keys"])
        give_back()

    sent = rows.select("row", "text").mapInArrow(send, SCHEMA)
    replies = dealt(sent, partitions).mapInArrow(receive, SCHEMA)
    return dealt(replies, partitions).mapInArrow(choose, "row bigint, keys binary")


def _near(prefixes: DataFrame, partitions: int, n_keys: int) -> DataFrame:
    """Distinct pairs (a, b) of rows with an equal combination, as stars: every row with the least of its combination.

    Within a chunk each combination is sent on once, so one that a third of all rows share reaches
    its task with a row for each chunk.  Near copies meet under many combinations, in as many tasks; a second
    shuffle, of packed pairs by their greater row, leaves each pair once.
    """
    buckets = np.uint64(buckets_for(n_keys, partitions, KEYS_EACH))

    def star(keys, rows):
        order = np.lexsort((rows, keys))
        keys, rows = keys[order], rows[order]
        new = first_of_groups(keys)
        least = rows[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        pairs = np.unique(np.stack([least, rows])[:, ~new], axis=1) if not new.all() else np.empty((2, 0), np.int64)
        return keys[new], rows[new], pairs[:, pairs[0] != pairs[1]]

    def send(batches: Iterator[pa.RecordBatch]):
        held, amount = [], 0

        def out():
            keys = np.concatenate([np.frombuffer(k, np.uint64) for _, k in held] or [np.empty(0, np.uint64)])
            rows = np.concatenate([np.full(len(k) // 8, r, np.int64) for r, k in held] or [np.empty(0, np.int64)])
            keys, rows, pairs = star(keys, rows)
            yield from pack(((keys >> np.uint64(20)) % buckets).astype(np.int64), [keys, rows])
            yield from pack((mix(pairs[1].view(np.uint64)) % buckets).astype(np.int64), [pairs[0], pairs[1]], kind=1)

        for batch in batches:
            for row, keys in zip(batch.column("row").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                held.append((row, keys))
                amount += len(keys)
                if amount >= 4 << 20:
                    yield from out()
                    held, amount = [], 0
        yield from out()
        give_back()

    def receive(batches: Iterator[pa.RecordBatch]):
        data: list[list[bytes]] = [[], []]
        for batch in batches:
            for kind, d in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist(), strict=True):
                data[kind].append(d)
        keys, rows = unpack(data[0], ["u8", "i8"])
        _, _, pairs = star(keys, rows)
        pairs = np.unique(np.concatenate([pairs, np.stack(unpack(data[1], ["i8", "i8"]))], axis=1), axis=1)
        yield from pack((mix(pairs[1].view(np.uint64)) % buckets).astype(np.int64), [pairs[0], pairs[1]])
        give_back()

    def once(batches: Iterator[pa.RecordBatch]):
        pairs = np.stack(unpack([d for b in batches for d in b.column("data").to_pylist()], ["i8", "i8"]))
        a, b = np.unique(pairs, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        give_back()

    sent = prefixes.mapInArrow(send, SCHEMA)
    met = dealt(sent, partitions).mapInArrow(receive, SCHEMA)
    return dealt(met, partitions).mapInArrow(once, "a bigint, b bigint")


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _links(sets: list[np.ndarray], side: list[int], weight: list[int], percent: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links of a group that hold it together: of all similar pairs (across sides, if there are two) a forest; and
    for each set the summed weight of all sets similar to it.

    Every pair is counted, through the lists of the sets that hold each shingle.
    """
    forest, out = _Forest(len(sets)), []
    size, weights, n = np.array([len(s) for s in sets]), np.array(weight, np.int64), np.zeros(len(sets), np.int64)
    two = len(set(side)) > 1
    if len(sets) <= 3:
        for j in range(len(sets)):
            for i in range(j):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (size[i] + size[j] - both) and (not two or side[i] != side[j]):
                    n[i] += weights[j]
                    n[j] += weights[i]
                    if forest.join(i, j):
                        out.append((i, j))
        return out, n
    tokens, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    known, place = np.unique(tokens, return_inverse=True)
    order = np.argsort(place, kind="stable")
    holders = of[order]
    begin = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(known)))])
    ends = np.cumsum(size)
    sides = np.array(side)
    for i in range(len(sets)):
        mine = place[ends[i] - size[i] : ends[i]]
        length = begin[mine + 1] - begin[mine]
        at = np.arange(length.sum()) + np.repeat(begin[mine] - np.cumsum(length) + length, length)
        both = np.bincount(holders[at], minlength=len(sets))
        similar = (100 * both >= percent * (size + size[i] - both)) & (np.arange(len(sets)) < i)
        if two:
            similar &= sides != sides[i]
        n[i] += weights[similar].sum()
        n[similar] += weights[i]
        out += [(j, i) for j in np.flatnonzero(similar).tolist() if forest.join(i, j)]
    return out, n


def _verified(grouped: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) of rows that come sorted by cell, one cell of bounded size at a time; and without ``b`` how many
    documents ``n`` the cell finds similar to a row.  A cell of two blocks, one of them empty, has no pair.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        names_of, cell, rows, side, weight, held = Names(), None, [], [], [], []

        def out():
            if len(held) > 1 and (cell[1] == cell[2] or len(set(side)) > 1):
                found, n = _links(held, side, weight, percent)
                some = np.flatnonzero(n).tolist()
                a = [rows[i] for i, _ in found] + [rows[i] for i in some]
                b = [rows[j] for _, j in found] + [None] * len(some)
                amount = [None] * len(found) + n[some].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, amount)], names=["a", "b", "n"])

        for batch in (part for b in batches for part in chunks(b, "text", CHUNK_BYTES)):
            cells = zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j")), strict=True)
            columns = [batch.column(c).to_pylist() for c in ("row", "block", "weight")]
            for now, row, block, documents, text in zip(cells, *columns, texts(batch, "text"), strict=True):
                if now != cell:
                    yield from out()
                    cell, rows, side, weight, held = now, [], [], [], []
                rows.append(row)
                side.append(block)
                weight.append(documents)
                held.append(shingle_sets([text.translate(LOWER).split()], names_of, width)[0])
        yield from out()
        give_back()

    return grouped.mapInArrow(run, "a bigint, b bigint, n bigint")


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` with ``row``, a number for each row, stored in the shared folder.

    The numbers follow from the splits of a scan, and these from the cores of that moment; they are therefore
    made once and read back by every pass.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _components(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """``row``, ``id``, ``n_shingles``, ``n_links``, ``root`` and ``component_id`` of every row (row, id, text) of a
    table stored by ``_numbered``; rows without words have no root.
    """
    spark = rows.sparkSession
    sizes = Sizes(percent)
    path = scratch_path(spark, "sets")
    _meta(rows, width, sizes).write.parquet(path)
    meta = spark.read.parquet(path)
    n_keys = meta.agg(F.sum("n_keys")).first()[0] or 0
    meta = meta.drop("n_keys")
    partitions = partitions_for(spark, n_keys, KEYS_EACH)
    near = components(_near(_prefixes(rows, width, partitions, n_keys, sizes), partitions, n_keys))

    # Of equal sets one is compared.
    same = ["print1", "print2", "n_shingles"]
    classes = meta.where("n_shingles > 0").groupBy(*same).agg(F.min("row").alias("row"), F.min("id").alias("least"), F.count("*").alias("weight"))
    classes = cut_lineage(classes)
    members = classes.join(near.withColumnRenamed("node", "row"), "row").select("row", "root", "n_shingles", "weight")
    groups = members.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).where("n > 1")
    # Stored, so that a group with very many members is a skewed join that can be split.
    groups = cut_lineage(groups.withColumn("blocks", F.ceil(F.col("shingles") / GROUP_SHINGLES)))
    blocks = cut_lineage(members.join(groups, "root").withColumn("block", F.pmod(F.xxhash64("row"), "blocks")))
    cells = blocks.select("row", "root", "block", "weight", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("row", "root", "block", "weight", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    wanted = Marks(blocks).on(rows.select("row", "text"))
    grouped = cells.join(wanted, "row").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    verified = cut_lineage(_verified(grouped, width, percent))
    linked = components(verified.where("b IS NOT NULL").select("a", "b"))
    others = verified.where("b IS NULL").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("others"))

    placed = classes.join(linked.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    # Equal documents link with each other, and each with all of the similar sets.
    placed = placed.join(others, "row", "left").withColumn("n_links", F.col("weight") - 1 + F.coalesce("others", F.lit(0)))
    placed = cut_lineage(placed)
    least = cut_lineage(placed.groupBy("root").agg(F.min("least").alias("component_id")))
    placed = placed.join(least, "root").select(*same, "n_links", "root", "component_id")
    columns = ["row", "id", "n_shingles", "n_links", "root", "component_id"]
    of_words = meta.where("n_shingles > 0").join(placed, same).select(*columns)
    none = {"n_links": F.lit(0).cast("bigint"), "root": F.lit(None).cast("bigint"), "component_id": F.col("id")}
    rest = meta.where("n_shingles = 0").withColumns(none)
    return of_words.unionAll(rest.select(*columns))


def join(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the key, ``n_shingles``, ``n_links``, the number of documents it links with, and
    ``component_id``, the least key reachable by links.

    Texts are lower-cased in A to Z; words are runs of anything but space and U+0009 to U+000D.  Two documents
    link when 100 * intersection >= ``percent`` * union of their sets of ``width``-word shingles.  Null and
    empty texts have no shingle and link with nothing.  Rows with equal keys are documents of their own; a
    null key is a component's id only if no member has another.  Groups beyond a bound are compared block by
    block, every block with every other.
    """
    found = _components(_numbered(pick(docs, id_col, text_col).toDF("id", "text")), width, percent)
    return found.select(F.col("id").alias(id_col), "n_shingles", "n_links", "component_id")


def representatives(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the least key, and all without words.

    Null and empty texts and texts without words are in no component and stay.  Of several rows with the least key
    one stays; a row without a key stays only where its component has no other.  An empty table stays empty; all
    columns are handed on, whatever their names.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = _numbered(docs.toDF(*names))
    key, text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    slim = rows.select("row", F.col(key).alias("id"), F.col(text).alias("text"))
    found = cut_lineage(_components(slim, width, percent).where("root IS NOT NULL"))
    first = F.min(F.struct(F.col("id").isNull().alias("without"), "id", "row"))
    groups = cut_lineage(found.groupBy("root").agg(F.count("*").alias("n"), first["row"].alias("first")).where("n > 1"))
    gone = cut_lineage(found.join(groups, "root").where("row <> first").select("row"))
    return without(rows, gone).select(*names).toDF(*docs.columns)
