"""Ranked search against brute force: all documents, all queries."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from spokecast.llm import ranked_search
from spokecast.llm.registered import QUERIES
from spokecast.llm.sql import ORACLES
from spokecast.session import scratch_path

TERM = re.compile(ranked_search.TERM)
DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(docs, items, k):
    found = [(key, Counter(terms_of(t))) for key, t in docs]
    found = [(key, c) for key, c in found if c]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        best = []
        for key, c in found:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = 0
            for t in terms_of(text):
                if t in c:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                best.append((-score, key is None, key or 0, key))
        best.sort()
        out += [(item, i + 1, b[3], -b[0]) for i, b in enumerate(best[:k])]
    return sorted(out, key=repr)


def searched(spark, docs, items, k=10):
    path = scratch_path(spark, "index")
    ranked_search.build(docs, path)
    return sorted((tuple(r) for r in ranked_search.search(spark, path, items, k).collect()), key=repr)


def test_matches_sql(spark, sf_dir):
    name = "op13_ranked_search"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "漢字", "X1"]
    texts = [" ".join(rnd.choices(words, k=rnd.choice([3, 8, 8, 8, 30]), weights=[1 / (i + 1) for i in range(len(words))])) for _ in range(n)]
    items = [", ".join(rnd.choices(words, k=rnd.randint(1, 12))) for _ in range(25)]
    return list(enumerate(texts)), list(enumerate(items))


@pytest.mark.parametrize(("first", "block", "each", "cells"), [(2000, 4096, 512, 1 << 21), (1, 3, 4, 40), (0, 50, 1, 1)])
def test_against_brute_force(spark, monkeypatch, first, block, each, cells):
    for name, value in (("FIRST_DOCS", first), ("BLOCK_DOCS", block), ("QUERIES_EACH", each), ("CELLS", cells)):
        monkeypatch.setattr(ranked_search, name, value)
    if each == 1:  # a query block for each of many queries takes long
        docs, items = corpus(1, 60)
        items = items[:3]
    else:
        docs, items = corpus(2, 300)
    got = searched(spark, spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), k=5)
    assert got == brute(docs, items, 5)


def test_exact_beyond_doubles(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "EXACT", 1)
    docs, items = corpus(3, 80)
    assert searched(spark, spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)) == brute(docs, items, 10)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 4)
    docs = [(1, None), (2, ""), (3, " .\x00,"), (None, "a b"), (None, "A-B"), (4, "a b"), (4, "a b"), (4, "a c"), (9, "long " * 30000 + "tail"), *((100 + i, "copy of one text") for i in range(40))]
    items = [(1, "a"), (1, "a"), (None, "B a copy"), (5, None), (6, ""), (7, "nothing like it"), (8, "tail long LONG")]
    clash = [F.lit("x").alias("TEXT"), F.lit(1).alias("m"), F.lit(2).alias("id")]
    d, i = spark.createDataFrame(docs, DOCS).select("*", *clash), spark.createDataFrame(items, ITEMS).select("*", *clash, F.lit(3).alias("q"))
    assert searched(spark, d, i) == brute(docs, items, 10)
    assert searched(spark, d.where("false"), i) == [] == searched(spark, d, i.where("false"))
    assert searched(spark, d.where("doc_id < 4"), i) == []


def test_blocks_are_bounded_and_lists_follow_tf(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 16)
    docs = spark.range(400).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("same text same").alias("text"))
    path = scratch_path(spark, "index")
    ranked_search.build(docs, path)
    rows = spark.read.parquet(f"{path}/postings")
    heads = [r.n_docs for r in rows.where("term IS NULL").collect()]
    assert sum(heads) == 400 and max(heads) <= 40 and len(heads) >= 20
    assert {(r.term, r.tf) for r in rows.where("term IS NOT NULL").collect()} == {("same", 2), ("text", 1)}


def test_strata_that_cannot_win_are_not_read(spark, monkeypatch):
    rnd = random.Random(1)
    docs = [(i, " ".join(["goal"] * 20 if i < 40 else ["goal"] + [f"x{rnd.random()}" for _ in range(200 + i % 50)])) for i in range(300)]
    monkeypatch.setattr(ranked_search, "FIRST_DOCS", 20)
    remaining, left = ranked_search._remaining, []

    def counted(visits, least):
        left.append((visits.count(), remaining(visits, least).count()))
        return remaining(visits, least)

    monkeypatch.setattr(ranked_search, "_remaining", counted)
    found = searched(spark, spark.createDataFrame(docs, DOCS), spark.createDataFrame([(0, "goal")], ITEMS))
    assert [key for _, _, key, _ in sorted(found, key=lambda r: r[1])] == list(range(10))
    assert left[0][0] > 15 and left[0][1] == 0
