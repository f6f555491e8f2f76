"""The corpus operators against SQL, libraries and brute force, and their edge cases."""

from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from spokecast.llm import bpe, decontaminate, jaccard, language, quality, recompression, repetition, sharding, toxicity, url_filter
from spokecast.llm.registered import QUERIES, vocabulary
from spokecast.llm.sql import ORACLES

BLANK = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id bigint, text string"
#: Nulls, empty and blank texts, ties, repeated rows, a long text.
ODD = [(1, None), (2, ""), (None, " \n\t"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "A B c d E f"), (7, "x"), (8, "long word " * 3000), (9, "é ß 漢字 🎉 ok")]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def odd(spark, rows=None):
    """The rows with columns whose names clash with each other and with the operators' own."""
    df = spark.createDataFrame(ODD if rows is None else rows, DOCS)
    return df.select("*", F.lit(1).alias("row"), F.lit("x").alias("id"), F.lit("y").alias("TEXT"), F.lit(0).alias("n_words"), F.lit(0).alias("c0"))


OPERATORS = {
    "bpe": lambda d: bpe.decode(bpe.encode(d, vocabulary()), vocabulary()),
    "jaccard": lambda d: jaccard.join(d, 3, 90),
    "sharding": lambda d: sharding.shard(d, 5, keep=("row",)),
    "decontaminate": lambda d: decontaminate.find(d, d.sparkSession.createDataFrame([(1, "c d e f"), (2, None), (None, "x")], "item_id int, text string")),
    "language": lambda d: language.predict(d, language.fit(d.select("*", F.lit("en").alias("lang")))),
    "recompression": lambda d: recompression.repeats(d),
    "quality": lambda d: quality.score(d, None),
    "toxicity": lambda d: toxicity.score(d, None),
    "repetition": lambda d: repetition.measure(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_and_empty_tables(spark, name):
    assert OPERATORS[name](odd(spark)).count() == len(ODD)
    assert OPERATORS[name](odd(spark, [])).count() == 0


def test_encoding_equals_the_library(spark, sf_dir):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(vocabulary())
    rnd = random.Random(3)
    parts = [*"aab  \n\t'stlre é中🎉²½٣!?", "<|endoftext|>", " the", "'ll", " ", "​​​", "\x85", "\x1c"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 50))) for _ in range(500)]
    rows = [(i, t) for i, t in enumerate(made)] + [(-1, None)]
    docs = spark.createDataFrame(rows, DOCS).unionAll(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id") + 1000, "text"))
    got = {r.doc_id: (r.ids, r.decoded) for r in OPERATORS["bpe"](docs).collect()}
    for r in docs.collect():
        ids = tool.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id] == (ids, tool.decode(ids, skip_special_tokens=False))
    bad = bpe.decode(spark.createDataFrame([(1, [162, 162]), (2, None)], "doc_id int, ids array<int>"), vocabulary())
    assert {r.doc_id: r.decoded for r in bad.collect()} == {1: tool.decode([162, 162]), 2: ""}


def family(n, words, edits, seed):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, edits)):
            own[rnd.randrange(words)] = f"e{rnd.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def brute_components(rows, width, percent):
    sets, up = {}, {}
    for i, t in rows:
        w = BLANK.findall((t or "").lower())
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
        up[i] = i

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(sorted(sets), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = root(i), root(j)
            up[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard_against_all_pairs(spark, monkeypatch, width, percent):
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", 1500)  # several blocks for one group
    found = [t for s, (n, w, e) in enumerate([(40, 120, 8), (20, 30, 2), (15, 9, 1), (10, 4, 1), (3, 2, 0)]) for t in family(n, w, e, s)]
    rows = list(enumerate([*found, None, "", "one", "ONE"]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(spark.createDataFrame(rows, DOCS), width, percent).collect()}
    want = brute_components(rows, width, percent)
    assert got == want
    kept = {r.doc_id for r in jaccard.representatives(spark.createDataFrame(rows, DOCS), width, percent).collect()}
    assert kept == {i for i, (_, root) in want.items() if root == i}


@pytest.mark.parametrize("percent", [30, 50, 60, 66])
def test_jaccard_of_sets_of_very_different_sizes(spark, percent):
    rnd, texts = random.Random(percent), []
    for group, (less, more) in enumerate([(4, 6), (13, 19), (5, 9), (20, 31), (9, 28)]):
        words = [f"g{group}w{i}" for i in range(more)]
        texts += [" ".join(words[:less]), " ".join(words), " ".join(rnd.sample(words, less))]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(spark.createDataFrame(rows, DOCS), 1, percent).collect()}
    assert got == brute_components(rows, 1, percent)


def brute_links(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    out = dict.fromkeys(sets, 0)
    for i, j in combinations(sets, 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            out[i] += 1
            out[j] += 1
    return out


@pytest.mark.parametrize("group_shingles", [1500, 1 << 19])
def test_jaccard_counts_links(spark, monkeypatch, group_shingles):
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", group_shingles)
    found = [t for s, (n, w, e) in enumerate([(40, 120, 8), (15, 30, 2), (3, 40, 1), (2, 40, 1)]) for t in family(n, w, e, 70 + s)]
    rows = list(enumerate([*found, *found[::3], None, "", "one", "ONE"]))
    got = {r.doc_id: r.n_links for r in jaccard.join(spark.createDataFrame(rows, DOCS), 3, 80).collect()}
    assert got == brute_links(rows, 3, 80) and max(got.values()) > 5


def test_jaccard_when_splits_change_between_passes(spark, monkeypatch, tmp_path):
    rows = list(enumerate(t for s in range(12) for t in family(4, 60, 1, 50 + s)))
    random.Random(1).shuffle(rows)
    path, setting = str(tmp_path / "docs"), "spark.sql.files.minPartitionNum"
    spark.createDataFrame(rows, DOCS).repartition(12).write.parquet(path)
    connected = jaccard.components

    def after_a_change(edges):
        found = connected(edges)
        spark.conf.set(setting, "12")
        return found

    monkeypatch.setattr(jaccard, "components", after_a_change)
    want = brute_components(rows, 5, 80)
    try:
        spark.conf.set(setting, "2")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(spark.read.parquet(path)).collect()}
        spark.conf.set(setting, "2")
        kept = sorted(r.doc_id for r in jaccard.representatives(spark.read.parquet(path)).collect())
    finally:
        spark.conf.unset(setting)
    assert got == want
    assert kept == sorted(i for i, (_, root) in want.items() if root == i)


def brute_repeats(rows, width=20):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = BLANK.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if (x := tuple(w[k : k + width])) in seen:
                gone[k : k + width] = [True] * width
            seen.add(x)
        out[i] = " ".join(a for a, g in zip(w, gone, strict=True) if not g)
    return out


def test_repeats_against_all_windows(spark):
    rnd = random.Random(5)
    texts = [*family(12, 90, 3, 1), *family(6, 200, 2, 2), "a b c d e " * 12, "z " * 70, "z " * 41, "a b " * 30, "b a " * 30]
    passage = " ".join(f"p{i}" for i in range(55))
    texts += [f"{' '.join(str(rnd.random()) for _ in range(9))} {passage} tail {i}" for i in range(8)]
    rows = list(enumerate([*texts, None, ""]))
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert {r.doc_id: r.kept for r in recompression.repeats(docs).collect()} == brute_repeats(rows)
    left = {r.doc_id: r.text for r in recompression.without_repeats(docs).collect()}
    assert all(left[i] == t or BLANK.findall(left[i] or "") == brute_repeats(rows)[i].split() for i, t in rows)


def test_benchmark_in_blocks_gives_the_same(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    one, many = (
        {r.doc_id: (r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in decontaminate.find(docs, bench, broadcast_bytes=size).collect()}
        for size in (1 << 20, 4000)
    )
    assert one == many and any(x[1] for x in one.values())
    sizes = [decontaminate.without_contaminated(docs, bench, broadcast_bytes=size).count() for size in (1 << 20, 4000)]
    judged = decontaminate.judged(decontaminate.find(docs, bench))
    assert sizes == [judged.where("NOT contaminated").count()] * 2 and sizes[0] < docs.count()


@pytest.mark.parametrize("size", [1 << 20, 60])
def test_items_without_key_count(spark, monkeypatch, tmp_path, size):
    docs = [(1, "see one two three now"), (2, "four five six"), (3, "one two three four five six"), (4, "nothing"), (5, None)]
    bench = [(None, "one two three"), (None, "four five six"), (7, "Four five six"), (None, None), (8, "")]
    spark.createDataFrame(docs, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    one = decontaminate.find
    monkeypatch.setattr(decontaminate, "find", lambda *a, **more: one(*a, **more | {"broadcast_bytes": size}))
    assert differences(QUERIES["op5_decontamination"](spark, str(tmp_path)), connect(str(tmp_path)), ORACLES["op5_decontamination"]) == []
    tables = [spark.read.parquet(str(tmp_path / f"{t}.parquet")) for t in ("documents", "benchmark")]
    assert {r.doc_id for r in decontaminate.without_contaminated(*tables, broadcast_bytes=size).collect()} == {4, 5}


def test_blocks_of_an_item_with_many_texts_are_bounded(spark):
    rows = [(1, f"text {i} " + "word " * (i % 40)) for i in range(300)] + [(2, "again " * 20)] * 300 + [(3, "long " * 1000), (None, "x y")]
    bench = spark.createDataFrame(rows, "item bigint, text string")
    blocks = [b.collect() for b in decontaminate._blocks(bench, 3000)]
    assert sorted(map(tuple, sum(blocks, [])), key=repr) == sorted(set(rows), key=repr)
    assert all(len(b) == 1 or sum(len(r.text) + 16 for r in b) <= 3000 for b in blocks)


def test_shards_are_computable(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    dealt = sharding.shard(rows, 7, seed=3)
    back = dealt.withColumn("again", sharding.row_at(F.col("shard"), F.col("slot"), 7, F.lit(1000).cast("bigint"), 3))
    assert back.where("again <> row").count() == 0
    counts = [r["count"] for r in dealt.groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1 and dealt.select("shard", "slot").distinct().count() == 1000
    assert dealt.where("shard * 1000 + slot = row").count() < 20


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://WWW.Spam.io/a/?utm_source=x&b=2&a=1#f"), (4, "https://spam.io/a?a=1&b=2"), (5, "http://spam.io/b"), (6, "http://x.net/en/1"), (7, "http://net")]
    pages = spark.createDataFrame([*rows, rows[3]], "page_id int, url string").select("*", F.lit("z").alias("URL"))
    listed = spark.createDataFrame([("ftp://m.spam.io/a///?b=2&a=1",), (None,)], "url string")
    judged = url_filter.judge(pages, listed, [url_filter.Rule("net/", "block")]).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged}
    assert len(judged) == 8
    assert got[1] == got[2] == ("", "", None, "allow")
    assert [got[i][3] for i in (3, 4, 5, 6, 7)] == ["block", "block", "allow", "block", "allow"]
    assert got[6][2] == "net/" and got[7] == ("net", "", None, "allow")


def test_classifiers_on_rows_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    said = language.predict(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert said.where("lang = lang_pred").count() >= 0.97 * said.count()
    good = quality.score(docs, quality.fit(docs, labels, "quality")).join(labels, "doc_id").where("held_out")
    assert good.where("quality = predicted").count() >= 0.97 * good.count()
    model = toxicity.fit(docs, labels)
    bad = toxicity.score(docs, model).join(labels, "doc_id").where("held_out")
    assert bad.where("predicted = 1 AND toxic = 0").count() <= 0.02 * bad.count()
    assert bad.where("predicted = 1 AND toxic = 1").count() >= 0.5 * bad.where("toxic = 1").count()
    assert 0 < toxicity.without_toxic(docs, model).count() < docs.count()
