"""Sharding by a keyed permutation of global row numbers; DataFrame functions only.

Rows are numbered from 0 in the order of a hash of their key and content, bucket by bucket, with no
global sort.  A Feistel network on a grid a * b of at least n cells permutes the numbers; numbers that
fall outside 0 to n - 1 are permuted again until they fall inside (cycle walking), which keeps it a
permutation of 0 to n - 1.  The permuted number modulo the shards is the shard, divided by them the slot: counts
are at most one apart, slots have no gaps, and both can be computed from the row number, and back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 8
#: Rows are numbered in 16 to the power of so many buckets.
BUCKET_DIGITS = 3
PRIME = (1 << 31) - 1
#: Walks of so many steps are tried before the longest that there can be.
WALK = 8


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Factor and shift of each round, by rule from the seed."""
    state, out = seed % (PRIME - 1) + 1, []
    for _ in range(2 * rounds):
        state = state * 48271 % PRIME
        out.append(state)
    return list(zip(out[::2], out[1::2], strict=True))


def _scramble(value: Column, factor: Column, shift: Column) -> Column:
    """A round's function; all products are of numbers below 2^31."""
    once = (value % PRIME * factor + shift) % PRIME
    return (F.shiftright(once, 13) * 40503 + once % 8192 * 9973) % PRIME


def _rounds(keys: list[tuple[int, int]]) -> Column:
    return F.array(
        *(F.struct(F.lit(i % 2 == 1).alias("odd"), F.lit(f).cast("bigint").alias("f"), F.lit(s).cast("bigint").alias("s")) for i, (f, s) in enumerate(keys))
    )


def _halves(x: Column, a: Column) -> Column:
    return F.struct((x % a).alias("l"), ((x - x % a) / a).cast("bigint").alias("r"))


def _step(x: Column, a: Column, b: Column, keys: list[tuple[int, int]], back: bool = False) -> Column:
    """One pass of the network, or of its inverse, over the cells of the grid."""
    sign = -1 if back else 1

    def one(h: Column, k: Column) -> Column:
        moved_r = F.pmod(h["r"] + sign * _scramble(h["l"], k["f"], k["s"]), b)
        moved_l = F.pmod(h["l"] + sign * _scramble(h["r"], k["f"], k["s"]), a)
        return F.struct(F.when(k["odd"], h["l"]).otherwise(moved_l).alias("l"), F.when(k["odd"], moved_r).otherwise(h["r"]).alias("r"))

    rounds = _rounds(keys)
    return F.aggregate(F.reverse(rounds) if back else rounds, _halves(x, a), one, lambda h: h["r"] * a + h["l"])


def permuted(x: Column, n: Column, seed: int = 0, back: bool = False) -> Column:
    """Where the permutation of 0 to n - 1 puts ``x``; with ``back``, what it puts there."""
    a = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    b = ((n + a - 1 - (n + a - 1) % a) / a).cast("bigint")
    keys = round_keys(seed)

    def walk(y: Column, steps: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1).cast("bigint"), steps), y, lambda z, _: F.when(z < n, z).otherwise(_step(z, a, b, keys, back)))

    # A walk meets each cell beyond n - 1 once at most; nearly all rows need none, so the long ones come last.
    once = _step(x, a, b, keys, back)
    short = F.transform(F.array(once), lambda y: F.when(y < n, y).otherwise(walk(y, F.lit(WALK).cast("bigint"))))
    return F.transform(short, lambda y: F.when(y < n, y).otherwise(walk(y, a * b - n + 1)))[0]


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``row``, numbers from 0 without gaps, and their count ``n``.

    The order is that of a hash of the columns ``order`` and then of these columns, null first; rows equal in all
    of them stand next to each other in any order.  Buckets of the hash are numbered apart and moved by the
    counts of the buckets before them; these are the only rows that meet in one task, 4096 at most.
    """
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order)))
    hashed = rows.withColumn("digest", digest).withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))
    counts = hashed.groupBy("bucket").agg(F.count("*").alias("rows"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(
        F.col("bucket"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(whole).alias("n"),
    )
    inner = Window.partitionBy("bucket").orderBy("digest", *(F.col(c).asc_nulls_first() for c in order))
    placed = hashed.withColumn("inner", F.row_number().over(inner)).join(F.broadcast(offsets), "bucket")
    return placed.select(*rows.columns, (F.col("before") + F.col("inner") - 1).alias("row"), "n")


def shard(
    docs: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Per input row: the key, ``size``, ``text_crc32``, ``row``, ``shard``, ``slot`` and the columns ``keep``.

    The law is rows: shards are at most one row apart.  Size is the text's UTF-8 bytes plus 8; a null text has
    no bytes, so size 8 and checksum 0.  Rows equal in key and text are interchangeable; null keys are keys.
    An empty table has no rows in any shard.  Kept columns take the names ``kept_`` and their place if
    they clash with those of the result.
    """
    chosen = [id_col, text_col, *keep]
    places = [docs.columns.index(c) for c in chosen]
    rows = docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))).select(*(F.col(f"c{i}").alias(f"k{j}") for j, i in enumerate(places)))
    text = F.coalesce(F.col("k1"), F.lit(""))
    sized = rows.select(
        F.col("k0").alias("id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *(F.col(f"k{j}") for j in range(2, len(chosen))),
    )
    dealt = numbered(sized, ["id", "size", "text_crc32"]).withColumn("at", permuted(F.col("row"), F.col("n"), seed))
    taken = {id_col, "size", "text_crc32", "row", "shard", "slot"}
    names = [c if c not in taken else f"kept_{j}" for j, c in enumerate(keep)]
    return dealt.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "row",
        (F.col("at") % shards).cast("int").alias("shard"),
        ((F.col("at") - F.col("at") % shards) / shards).cast("bigint").alias("slot"),
        *(F.col(f"k{j}").alias(c) for j, c in enumerate(names, 2)),
    )


def row_at(shard_: Column, slot: Column, shards: int, n: Column, seed: int = 0) -> Column:
    """The row number that stands in a slot of a shard."""
    return permuted(slot * shards + shard_, n, seed, back=True)
