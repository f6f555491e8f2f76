"""Rows of a numbered table found by their numbers, without a shuffle of the table.

The numbers are bits of pieces, each of 1024 consecutive ones, which are broadcast and looked up where the table is read.
At most ``PIECES`` of 128 bytes are broadcast; of more, several share one, and a row may then be marked by another's number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.session import cut_lineage

#: Pieces that are broadcast at most, some 15 MB as a hash table.
PIECES = 1 << 16
_BIT = "getbit(cast(conv(hex(substring(bits, cast(row % 1024 div 8 as int) + 1, 1)), 16, 10) as int), cast(row % 8 as int)) = 1"
#: The small pieces of a bitmap of 32768 bits; those without a bit are left out.
_PIECES = "filter(transform(sequence(0, 31), i -> struct(32 * place + i as place, substring(bits, 128 * i + 1, 128) as bits)), p -> p.bits <> X'" + "00" * 128 + "')"


class Marks:
    """The numbers ``row``, none negative, of ``keys``; ``exact`` tells whether no other row is marked."""

    def __init__(self, keys: DataFrame):
        # Dealt as numbers: tasks that see all numbers mixed would each send every bitmap.
        dealt = keys.select("row", F.expr("row div 32768").alias("place")).repartition("place")
        bitmaps = dealt.groupBy("place").agg(F.expr("bitmap_construct_agg(row % 32768)").alias("bits"))
        bits = cut_lineage(bitmaps.select(F.expr(f"inline({_PIECES})")))
        self.exact = bits.limit(PIECES + 1).count() <= PIECES
        self.place = F.expr("row div 1024")
        if not self.exact:
            shared = lambda place: F.pmod(F.xxhash64(place), F.lit(PIECES))
            self.place = shared(self.place)
            # Pieces meet as the first bytes of a whole bitmap, which is what Spark can unite.
            bits = bits.select(shared("place").alias("place"), F.concat("bits", F.lit(bytes(4096 - 128))).alias("bits"))
            bits = cut_lineage(bits.groupBy("place").agg(F.bitmap_or_agg("bits").alias("bits")).withColumn("bits", F.expr("substring(bits, 1, 128)")))
        self.bits = bits

    def _found(self, rows: DataFrame, want: bool) -> DataFrame:
        met = rows.withColumn("place", self.place).join(F.broadcast(self.bits), "place", "left")
        return met.where(F.coalesce(F.expr(_BIT), F.lit(False)) == F.lit(want)).select(*rows.columns)

    def on(self, rows: DataFrame) -> DataFrame:
        """The marked rows."""
        return self._found(rows, True)

    def off(self, rows: DataFrame) -> DataFrame:
        """The others, whose numbers are surely not among the keys."""
        return self._found(rows, False)


def without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` whose ``row`` is not in ``keys``; a shuffle gets only those that share a mark."""
    marks = Marks(keys)
    if marks.exact:
        return marks.off(rows)
    return marks.off(rows).unionAll(marks.on(rows).join(keys, "row", "left_anti").select(*rows.columns))
