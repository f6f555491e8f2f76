"""URL filters: rules of hosts and paths, and a list of canonical URLs behind a blocked Bloom filter.

The list's URLs set bits in a Bloom filter of 512-bit blocks, one block for each URL, built by one
aggregate.  The filter has a bounded size and is broadcast; the urls it lets through, few of them false, are
joined exactly with the list, which removes the false ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokecast.llm.text import pick

WORDS = 8
#: Blocks of 8 words of 64 bits; with more urls than these can tell apart, more go to the exact join.
MOST_BLOCKS = 1 << 17
URLS_PER_BLOCK = 32

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: query parameters that do not name a page.
TRACKING = r"^(utm_[a-z]+|ref|gclid|fbclid)="


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host and a path, such as ``example.net/en/``."""

    pattern: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.pattern.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without slashes at its end, and the sorted parameters
    that are not for tracking; no scheme, no fragment.  Null without ``://``."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    whole = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(_rest(url).isNotNull(), whole)


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks)).cast("int")


def _bits(url: Column) -> list[Column]:
    """One bit in each word of the block, from a second hash."""
    second = F.xxhash64(F.lit("bits"), url)
    return [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63).cast("bigint")).cast("int") for i in range(WORDS)]


def _power(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def bloom(urls: DataFrame, blocks: int) -> DataFrame:
    """The filter: a row for each block that has a bit, of ``w0`` to ``w7``."""
    set_ = urls.select(_block(F.col("url"), blocks).alias("block"), *(_power(b).alias(f"w{i}") for i, b in enumerate(_bits(F.col("url")))))
    return set_.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))


def listed(rows: DataFrame, urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts, those whose ``url`` is in ``urls`` and the others; a null url is in no list."""
    known = urls.where("url IS NOT NULL").select("url").distinct()
    count = urls.agg(F.approx_count_distinct("url")).first()[0]
    blocks = 1
    while blocks < MOST_BLOCKS and blocks * URLS_PER_BLOCK < count:
        blocks *= 2
    filter_ = bloom(known, blocks)  # MOST_BLOCKS rows of 9 numbers at most
    met = rows.withColumn("block", _block(F.col("url"), blocks)).join(F.broadcast(filter_), "block", "left")
    possible = F.col("url").isNotNull() & F.col("w0").isNotNull()
    for i, b in enumerate(_bits(F.col("url"))):
        possible = possible & (F.col(f"w{i}").bitwiseAND(_power(b)) != 0)
    met = met.withColumn("possible", F.coalesce(possible, F.lit(False)))
    maybe = met.where("possible").select(*rows.columns)
    sure = known.withColumn("found", F.lit(True))
    checked = maybe.join(sure, "url", "left")
    hit = checked.where("found").select(*rows.columns)
    other = met.where("NOT possible").select(*rows.columns).unionAll(checked.where("found IS NULL").select(*rows.columns))
    return hit, other


def judge(pages: DataFrame, block_list: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page: the key, ``host``, ``path``, the longest ``rule`` that fits, and the ``verdict``.

    The rule's verdict holds; without a rule a page is blocked if its canonical url is one of the canonical
    urls of ``block_list`` (column ``url``), else allowed.  A null url, or one without ``://``, has empty host
    and path and is allowed.  Repeated rows are judged one by one; other columns are not read.
    """
    rows = pick(pages, id_col, url_col).toDF("id", "raw")
    rows = rows.select("id", host_of(F.col("raw")).alias("host"), path_of(F.col("raw")).alias("path"), canonical(F.col("raw")).alias("url"))
    hit, other = listed(rows, block_list.select(canonical(F.col("url")).alias("url")))
    judged = hit.withColumn("listed", F.lit(True)).unionAll(other.withColumn("listed", F.lit(False)))
    longest = sorted(rules, key=lambda r: -len(r.pattern))
    fitting = [(r, r.fits(F.col("host"), F.col("path"))) for r in longest]
    rule = F.coalesce(*(F.when(fits, r.pattern) for r, fits in fitting), F.lit(None).cast("string"))
    own = F.coalesce(*(F.when(fits, r.verdict) for r, fits in fitting), F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), own.alias("verdict"))
