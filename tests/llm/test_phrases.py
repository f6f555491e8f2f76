"""Phrase mining against SQL and against counting every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from spokecast.llm import phrases
from spokecast.llm.registered import QUERIES
from spokecast.llm.sql import ORACLES
from spokecast.session import scratch_path

DOCS = "lang string, text string"


def brute(rows, least, top, longest=4, inside=80):
    count, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda c: c[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                count[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        longer = defaultdict(int)
        for p in candidates:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], f[p])
        best = []
        for p in candidates:
            score, _, left, right = min((2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if 100 * longer[p] < inside * f[p]:
                best.append((-score, -f[p], " ".join(p).encode(), left, right))
        out += [(lang, i + 1, b[2].decode(), -b[1], b[3], b[4], n[lang], -b[0]) for i, b in enumerate(sorted(best)[:top])]
    return sorted(out)


def mined(docs, **more):
    return sorted(tuple(r) for r in phrases.mine(docs, **more).collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    assert differences(QUERIES["op11_phrases"](spark, path), connect(path), ORACLES["op11_phrases"]) == []


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Éa", "éa", "X", "x", "漢"]
    passage = "one two three four five"
    texts = []
    for _ in range(n):
        parts = [rnd.choice(words) for _ in range(rnd.randint(0, 25))] + [passage] * (rnd.random() < 0.2)
        rnd.shuffle(parts)
        texts.append("".join(p + rnd.choice([" ", " ", " ", "\t", ". ", ",", "\x0b", "\n"]) for p in parts))
    return [(rnd.choice(["en", "en", "en", "de", None, "und"]), t) for t in texts]


@pytest.mark.parametrize(("shards", "least", "longest"), [(1, 3, 4), (4, 5, 4), (7, 12, 3), (3, 2, 2)])
def test_against_all_phrases(spark, monkeypatch, shards, least, longest):
    monkeypatch.setattr(phrases, "HELD", 100)
    monkeypatch.setattr(phrases, "HELD_PHRASES", 20)
    rows = corpus(shards, 300)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert mined(docs, shards=shards, least=least, longest=longest, top=50) == brute(rows, least, 50, longest)


def test_a_crowded_table_costs_counting_only(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST_BITS", 3)
    monkeypatch.setattr(phrases, "MOST_BITS", 3)
    rows = corpus(9, 200)
    assert mined(spark.createDataFrame(rows, DOCS), least=4, top=30) == brute(rows, 4, 30)


def test_a_phrase_begins_no_earlier_than_its_parts():
    chunk, cells = phrases.Chunk(["en"], [b"a b c"]), np.zeros(1 << 16, np.uint8)
    (_, _, words, _), (_, _, pairs, _), _ = chunk.phrases(phrases.Reached(cells), 5, 3)
    cells[:] = phrases.NEVER
    table = phrases.Reached(cells)
    for names, step in ((words, 2), (pairs, 0)):  # others have filled the pairs' cells before the pairs were counted
        cells[np.concatenate(table.places(names))] = step
    assert [b.tolist() for _, _, _, b in chunk.phrases(table, 5, 3)] == [[0, 0, 0], [3, 3], [3]]


def test_longer_phrases_begin_before_shorter_ones_end(spark):
    path = scratch_path(spark, "shards")
    rows = [("en", "a b c d", i % 4) for i in range(400)]
    spark.createDataFrame(rows, "lang string, text string, shard int").write.partitionBy("shard").parquet(path)
    cells, steps = phrases.reached_phrases(spark, path, 4000, 4, 30, 4)
    assert steps == 7  # words from shard 0 on, pairs from 1, triples from 2, the whole from 3 to 6
    assert set(cells.tolist()) == {0, 1, 2, 3, phrases.NEVER}


def test_a_phrase_is_counted_one_full_cycle(spark):
    late = [("en", "x y", s) for s in (3, 3, 2, 1, 0)]
    path = scratch_path(spark, "shards")
    spark.createDataFrame(late, "lang string, text string, shard int").write.partitionBy("shard").parquet(path)
    cells, steps = phrases.reached_phrases(spark, path, 4000, 4, 5, 2)
    assert steps == 8 and set(cells.tolist()) == {3, 7, phrases.NEVER}


def test_odd_rows(spark):
    rows = [(None, None), ("en", None), ("en", ""), ("en", " .,\n"), (None, "a b. A\tB"), ("und", "a b"), ("en", "long word " * 30000), *[("fr", "same text")] * 40, ("", "no lang name")]
    docs = spark.createDataFrame(rows, DOCS).select("*", F.lit("z").alias("TEXT"), F.lit(0).alias("shard"), F.lit(1).alias("n"))
    assert mined(docs, least=3, top=10) == brute(rows, 3, 10) != []
    assert mined(docs.where("false")) == [] == mined(spark.createDataFrame(rows[:2], DOCS))


def test_large_counts_are_exact(spark):
    big = 4 * 10**17
    rows = [("en", 0, "", big), ("en", 1, "a", big - 1), ("en", 1, "b", big - 3), ("en", 2, "a b", big - 5), ("en", 3, "a b c", big - 9), ("en", 1, "c", big - 8), ("en", 2, "b c", big - 9)]
    got = {r.phrase: (r.score, r.a) for r in phrases.ranked(spark.createDataFrame(rows, "lang string, length int, phrase string, f bigint"), 10, 100).collect()}
    assert got["a b"] == (2000000 * (big - 5) // (2 * big - 4), big - 5)
    assert set(got) == {"a b", "a b c"}
