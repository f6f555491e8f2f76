"""What the index of the n-gram Jaccard join ties together, and how rows are found by number."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spokecast.llm import jaccard

DOCS = "doc_id bigint, text string"


def test_single_shingles_met_by_chance_tie_no_families(spark, monkeypatch):
    """Families of three share passages of one shingle with others; none is similar to another family, and few meet."""
    rnd = random.Random(5)
    passages = [[f"p{i}w{k}" for k in range(5)] for i in range(60)]
    rows = []
    for family in range(50):
        words = [f"f{family}w{i}" for i in range(300)]
        for at, passage in enumerate(rnd.sample(passages, 12)):
            words[at * 24 : at * 24 + 5] = passage
        for copy in range(3):
            rows.append((len(rows), " ".join(words[: 290 + 4 * copy])))
    tied, connected = [], jaccard.components

    def seen(edges):
        found = connected(edges)
        tied.append(Counter(r.root for r in found.collect()))
        return found

    monkeypatch.setattr(jaccard, "components", seen)
    got = {r.doc_id: r.component_id for r in jaccard.join(spark.createDataFrame(rows, DOCS), 5, 80).collect()}
    assert got == {i: i - i % 3 for i, _ in rows}
    assert max(tied[0].values()) <= 6


@pytest.mark.parametrize("percent", [30, 50, 66, 80, 90, 100])
def test_similar_sets_differ_in_no_more_than_the_prefix_allows(percent):
    sizes = jaccard.Sizes(percent)
    small, large = (x.ravel() for x in np.meshgrid(np.arange(1, 150), np.arange(1, 500)))
    small, large = small[small <= large], large[small <= large]
    both = -(-percent * (small + large) // (100 + percent))  # least overlap of a similar pair
    met = both <= small
    small, large, both = small[met], large[met], both[met]
    kind = sizes.of(small)
    apart = small + large - 2 * both
    assert (apart <= sizes.may_differ(small, kind)).all() and (apart <= sizes.may_differ(large, kind)).all()
    assert (sizes.may_differ(large, kind) <= sizes.differ[kind]).all()


NUMBERS = [0, 1, 7, 8, 1023, 1024, 32767, 32768, 32769, 65536, 1 << 33, (1 << 33) + 5, (1 << 33) + 40000, (5 << 33) + 3]


@pytest.mark.parametrize("pieces", [1, 2, 1 << 12])
def test_rows_found_by_number(spark, monkeypatch, pieces):
    from spokecast.llm import marks

    monkeypatch.setattr(marks, "PIECES", pieces)
    numbers = sorted({n + k for n in NUMBERS for k in range(20)})
    rows = spark.createDataFrame([(n, f"t{n}") for n in numbers], "row bigint, text string")
    for chosen in (NUMBERS, numbers, []):
        keys = spark.createDataFrame([(n,) for n in [*chosen, *chosen[:3], 1 << 40]], "row bigint")
        found = marks.Marks(keys)
        on, off = ([r.row for r in x.collect()] for x in (found.on(rows), found.off(rows)))
        assert sorted(on + off) == numbers and set(chosen) <= set(on)
        assert found.exact == (pieces > 2 or not chosen) and (not found.exact or set(on) == set(chosen))
        left = marks.without(rows, keys)
        assert left.columns == rows.columns and sorted(r.row for r in left.collect()) == sorted(set(numbers) - set(chosen))


def test_representatives_shuffle_no_texts(spark):
    rows = [(i, f"{'same words in all of these' if i % 3 == 0 else f'text of its own {i}'} again") for i in range(60)]
    out = jaccard.representatives(spark.createDataFrame(rows, DOCS).withColumn("more", F.lit("x")))
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.doc_id for r in out.collect()) == sorted({0, *(i for i in range(60) if i % 3)})
