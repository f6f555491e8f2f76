"""Fits against slow versions of themselves, and what filters and stages make of odd tables."""

from __future__ import annotations

import hashlib
import re

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import DOCS, ODD, brute_components, brute_repeats, odd

from spokecast.llm import decontaminate, jaccard, language, linear, quality, recompression, toxicity, url_filter
from spokecast.llm.registered import vocabulary

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def primal(weights, x, y, costs):
    return 0.5 * weights @ weights + costs @ np.maximum(0, 1 - y * (x @ weights))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hinge_fit_reaches_the_least_objective(seed):
    rnd = np.random.default_rng(seed)
    n, size = 40, 6
    dense = np.where(rnd.random((n, size)) < 0.5, rnd.normal(size=(n, size)), 0)
    y = np.where(dense[:, 0] + 0.5 * rnd.normal(size=n) > 0, 1, -1)
    costs = rnd.uniform(0.1, 2, n)
    rows = linear.Rows.of([np.flatnonzero(r) for r in dense], [r[r != 0] for r in dense])
    got = linear.hinge(rows, y, size, costs, epochs=400)
    x = np.column_stack([dense, np.ones(n)])
    # The dual by plain projected gradient: alpha within 0 and the costs.
    q = (y[:, None] * x) @ (y[:, None] * x).T
    alpha, step = np.zeros(n), 1 / np.linalg.eigvalsh(q).max()
    for _ in range(40_000):
        alpha = np.clip(alpha + step * (1 - q @ alpha), 0, costs)
    slow = (alpha * y) @ x
    assert primal(got, x, y, costs) <= primal(slow, x, y, costs) * (1 + 1e-3) + 1e-6
    assert np.abs(got - slow).max() < 0.02


def plain_label_model(rows, model, first, rounds):
    """Expectation and maximisation by loops over texts and votes."""
    n = len(first[0])
    rates, prior, share = model.rates.copy(), model.prior, model.share.copy()
    for r in range(rounds):
        count, hits = [0.0, 0.0], [[0.0] * n, [0.0] * n]
        both = [[0.0] * n for _ in range(n)]
        for mask, times in rows:
            votes = [(mask >> k) & 1 for k in range(n)]
            z = np.log(prior / (1 - prior))
            for k, v in enumerate(votes):
                p = (rates[0][k], rates[1][k]) if v else (1 - rates[0][k], 1 - rates[1][k])
                z += share[k] * np.log(p[0] / p[1])
            toxic = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            for y, p in enumerate((toxic, 1 - toxic)):
                count[y] += times * p
                for k, v in enumerate(votes):
                    hits[y][k] += times * p * v
            for k, v in enumerate(votes):
                for j, w in enumerate(votes):
                    both[k][j] += times * toxic * v * w
        rates = np.clip([[(hits[y][k] + toxicity.ANCHOR * first[y][k] + 0.01) / (count[y] + toxicity.ANCHOR + 0.02) for k in range(n)] for y in (0, 1)], 1e-6, 1 - 1e-6)
        prior = min(max((count[0] + 1) / (sum(count) + 2), 1e-4), 0.9)
        if r == 1:
            mean = [h / count[0] for h in hits[0]]
            for k in range(n):
                total = 0.0
                for j in range(n):
                    a, b = (np.sqrt(max(both[i][i] / count[0] - mean[i] ** 2, 1e-12)) for i in (k, j))
                    c = 1.0 if k == j else ((both[k][j] / count[0] - mean[k] * mean[j]) / (a * b) if a * b > 1e-9 else 0.0)
                    total += c if c > 0.2 else 0.0
                share[k] = 1 / max(total, 1.0)
    return rates, prior, share


def test_label_model_against_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "VOTERS", 5)
    n = 5 + toxicity.PATTERNS
    rnd = np.random.default_rng(4)
    rows = {}
    for _ in range(400):
        bad = rnd.random() < 0.2
        votes = rnd.random(n) < (0.6 if bad else 0.05)
        votes[1] = votes[0]  # two voters that say the same
        mask = int(sum(1 << k for k in np.flatnonzero(votes)))
        rows[mask] = rows.get(mask, 0) + 1
    first = np.array([[0.5] * n, [0.05] * n])
    model = toxicity.Model([], first.copy(), np.ones(n), np.eye(n), 0.3, [], np.zeros(0), 0.0, (1.0, 0.0))
    want = plain_label_model(list(rows.items()), model, first, toxicity.ROUNDS)
    # Workers read the number of voters from the module as it is installed, so the sums are taken here.
    monkeypatch.setattr(toxicity, "_moments", lambda patterns, m: local_moments(patterns, m, n))
    toxicity._label_model(list(rows.items()), model, first)
    assert np.allclose(model.rates, want[0], atol=1e-9) and abs(model.prior - want[1]) < 1e-9
    assert np.allclose(model.share, want[2], atol=1e-9) and model.share[0] < 0.75 <= model.share[4]


def local_moments(rows, model, n):
    votes = toxicity._bits(np.array([m for m, _ in rows]), n)
    count = np.array([c for _, c in rows], float)
    one = np.column_stack([np.ones(len(votes)), votes])
    return np.stack([one.T @ (one * (p * count)[:, None]) for p in (model.posterior(votes), 1 - model.posterior(votes))])


def test_moments_are_sums_over_all_documents(spark):
    n = toxicity.VOTERS + toxicity.PATTERNS
    rnd = np.random.default_rng(6)
    rows = [(int(rnd.integers(0, 1 << 40)), int(rnd.integers(1, 9))) for _ in range(60)]
    rates = np.vstack([rnd.uniform(0.2, 0.8, n), rnd.uniform(0.01, 0.2, n)])
    model = toxicity.Model([], rates, np.ones(n), np.eye(n), 0.3, [], np.zeros(0), 0.0, (1.0, 0.0))
    got = toxicity._moments(spark.createDataFrame(rows, "mask bigint, n bigint").repartition(5), model)
    assert np.allclose(got, local_moments(rows, model, n))


def trained(spark):
    """Documents whose words tell their label."""
    bad, good = "vile awful scum", "calm river stone"
    texts = [(i, f"{bad if i % 3 == 0 else good} w{i % 17} w{i % 5} plain text") for i in range(400)]
    labels = [(i, int(i % 3 == 0), int(i % 3 != 0)) for i in range(400)]
    return spark.createDataFrame(texts, DOCS), spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int")


@pytest.mark.parametrize(("operator", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_real_models_on_odd_rows(spark, operator, label):
    docs, labels = trained(spark)
    model = operator.fit(docs, labels, label)
    assert model is not None
    got = operator.score(odd(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    by_key = {}
    for r in got:
        by_key.setdefault(r.doc_id, []).append(r.score)
    assert by_key[1] == by_key[2] and len(set(by_key[4])) == 1  # null and empty, and repeated rows, score alike
    assert operator.score(odd(spark, []), model).count() == 0
    own = {r.doc_id: r for r in operator.score(docs, model).collect()}
    truth = {r.doc_id: r[label] for r in labels.collect()}
    assert sum(own[i].predicted == truth[i] for i in own) >= 0.99 * len(own)
    one_class = labels.withColumn(label, F.lit(1))
    for none in (labels.where("false"), one_class, labels.withColumn(label, F.lit(None).cast("int"))):
        assert operator.fit(docs, none, label) is None
    assert operator.fit(docs.where("false"), labels, label) is None
    nulls = labels.unionAll(spark.createDataFrame([(None, 1, 1), (5000, None, None)], labels.schema))
    assert operator.fit(docs.select("*", F.lit("z").alias("TEXT")), nulls, label) is not None


def test_language_without_anything_to_learn(spark):
    rows = odd(spark).select("*", F.lit(None).cast("string").alias("lang"))
    got = language.predict(rows, language.fit(rows)).collect()
    assert len(got) == len(ODD) and {r.lang_pred for r in got} == {"und"}


def clashing(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return df.select("*", F.lit("x").alias("TEXT"), F.lit(1).alias("row"), F.lit(2).alias("c0"), F.lit(3).alias("id"))


FILTERS = {
    "representatives": lambda d: jaccard.representatives(d, 2, 80),
    "without_repeats": lambda d: recompression.without_repeats(d, width=3),
    "without_toxic": lambda d: toxicity.without_toxic(d, None),
    "without_contaminated": lambda d: decontaminate.without_contaminated(
        d, d.sparkSession.createDataFrame([(1, "q q q"), (None, None)], "item_id int, text string")
    ),
    "without_contaminated in blocks": lambda d: decontaminate.without_contaminated(
        d, d.sparkSession.createDataFrame([(1, "q q q"), (2, "z z")], "item_id int, text string"), broadcast_bytes=10
    ),
}
TABLE = [(None, "a b c d e", "l"), (1, "a b c d e", None), (1, "a b c d e", None), (2, None, "m"), (2, None, "m"), (3, "", "n"), (None, None, None), (4, "q q q", "o"), (5, "f " * 5000, "p")]


@pytest.mark.parametrize("name", sorted(FILTERS))
def test_filters_on_odd_tables(spark, name):
    docs = clashing(spark, TABLE)
    out = FILTERS[name](docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    kept = [(r[0], r[1], r[2]) for r in out.collect()]
    whole = {
        # Of equal sets the row of the least key stays, one of them if there are several; rows without words all stay.
        "representatives": [(1, "a b c d e", None), *TABLE[3:]],
        "without_toxic": TABLE,
        "without_contaminated": [r for r in TABLE if r[1] != "q q q"],
        "without_contaminated in blocks": [r for r in TABLE if r[1] != "q q q"],
        # A null key comes first, so its words stay; of repeated words the first windows do.
        "without_repeats": [TABLE[0], (1, "", None), (1, "", None), *TABLE[3:8], (5, "f", "p")],
    }[name]
    assert sorted(map(repr, kept)) == sorted(map(repr, whole))
    empty = FILTERS[name](docs.where("doc_id < 0"))
    assert empty.count() == 0 and empty.columns == docs.columns


def test_urls_without_pages_lists_or_rules(spark):
    rows = [(1, None), (None, ""), (2, "http://A.b/c"), (2, "http://A.b/c"), (3, "x" * 50_000), (4, "http://a.b/" + "y" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id int, url string").select("*", F.lit(1).alias("URL"), F.lit(2).alias("host"), F.lit(3).alias("c0"))
    nothing, listed = (spark.createDataFrame(x, "url string") for x in ([], [("https://a.b/c",), (None,), ("",)]))
    rules = [url_filter.Rule("b/", "allow")]
    for block_list, own in ((nothing, []), (nothing, rules), (listed, []), (listed, rules)):
        got = url_filter.judge(pages, block_list, own).collect()
        assert sorted(str(r.page_id) for r in got) == sorted(str(i) for i, _ in rows)
        blocked = [r.page_id for r in got if r.verdict == "block"]
        assert blocked == ([2, 2] if block_list is listed and not own else [])
        assert {r.rule for r in got} == ({None, "b/"} if own else {None})
        assert url_filter.judge(pages.where("false"), block_list, own).count() == 0


def brute_contaminated(rows, items, width=13, share=20):
    windows = set()
    for text in items:
        w = WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
        windows |= {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    out = set()
    for key, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
        hit = set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
        if hit and share * len(hit) >= len(w):
            out.add(key)
    return out


def test_last_stages_against_brute_force(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    free = stage["benchmark decontamination"](spark, docs, sf_dir).checkpoint()
    bad = brute_contaminated(rows, items)
    assert bad and {r.doc_id for r in free.collect()} == {i for i, _ in rows} - bad
    tool = Tokenizer.from_file(vocabulary())
    for r in stage["BPE encoding and decoding"](spark, free, sf_dir).collect():
        ids = tool.encode(dict(rows)[r.doc_id] or "", add_special_tokens=False).ids
        text = tool.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids, r.text_sha256) == (len(ids), ids, hashlib.sha256(text.encode()).hexdigest())


def test_stages_take_odd_documents(spark, sf_dir):
    layout = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    rows = [(i if i % 4 else None, t, "en", "s", len(t or "")) for i, t in enumerate([None, "", " \n", "one", "one", "é 漢 🎉 " * 40, "long " * 4000])]
    for some in (rows, []):
        docs = spark.createDataFrame(some, layout)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            if name == corpus_pipeline.STAGES[-1][0]:
                assert out.count() == len(some)
                continue
            assert out.columns == docs.columns
            texts = [(r.doc_id, r.text) for r in out.collect()]
            if name == "n-gram Jaccard join" and some:
                keyed = [(n, t) for n, (_, t, *_) in enumerate(some)]
                groups = brute_components(keyed, 5, 80)
                assert len(texts) == sum(root == i or not t or not t.split() for (i, (_, root)), (_, t) in zip(groups.items(), keyed, strict=True))
            elif name == "substring dedup" and some:
                assert sorted(" ".join((t or "").split()) for _, t in texts) == sorted(brute_repeats([(n, t) for n, (_, t, *_) in enumerate(some)]).values())
            else:
                assert len(texts) == len(some)
