"""Quality classifier: naive Bayes support vectors.

Each text's n-gram indicators are scaled by the log-count ratios of the two classes, and a linear model with
hinge loss is fitted to them by dual coordinate descent.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.llm.grams import Indicators
from spokecast.llm.linear import Rows, hinge, logistic, part_of, sampled, sigmoid
from spokecast.llm.text import Shared, map_chunks, pick, texts

BITS = 15
#: About so many labelled rows of each class are fitted; this bounds what the driver holds.
SAMPLE_EACH = 3000
COST = 1.0


@dataclass
class Model:
    bits: int
    weight: np.ndarray  # of an indicator, already scaled by its ratio
    square: np.ndarray  # of its ratio
    bias: float
    curve: tuple[float, float]

    def margins(self, text: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
        total = np.bincount(text, self.weight[gram], n)
        length = np.sqrt(np.bincount(text, self.square[gram], n))
        return total / np.maximum(length, 1e-9) + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return sigmoid(self.curve[0] * margins + self.curve[1])


def _indicators(docs: DataFrame, bits: int) -> DataFrame:
    """Per labelled text its label and the n-grams that it has."""

    def make():
        indicators = Indicators(bits)

        def work(batch):
            text, gram = indicators.of(texts(batch, "text"))
            cuts = np.searchsorted(text, np.arange(batch.num_rows + 1)).tolist()
            gram = gram.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([gram[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                names=["label", "grams"],
            )

        return work

    return map_chunks(docs.select("label", "text"), "label int, grams binary", "text", make)


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", sample_each: int = SAMPLE_EACH, parts: int = 5) -> Model | None:
    """The model, or none without labelled rows of both classes.

    Only rows whose CRC-32 of the key modulo ``parts`` is not 0 are read.  About ``sample_each`` labelled rows
    of each class are fitted, every fifth of them kept for the curve that turns margins into scores.
    """
    known = pick(labels, id_col, label_col).toDF("id", "label").where("label IS NOT NULL")
    known = known.where(part_of(F.col("id"), parts) != 0).select("id", F.col("label").cast("int").alias("label"))
    chosen, counts = sampled(known, "id", "label", sample_each)
    rows = pick(docs, id_col, text_col).toDF("id", "text")
    # 4 times the sample's bound at most, so safe to broadcast.
    got = _indicators(rows.join(F.broadcast(chosen), "id"), BITS).collect()
    label = np.array([1 if r.label else -1 for r in got])
    grams = [np.frombuffer(r.grams, "<u4").astype(np.int64) for r in got]
    if len(set(label.tolist())) < 2:
        return None
    by_content = sorted(range(len(grams)), key=lambda i: (label[i], got[i].grams))  # whatever order they came in
    label, grams = label[by_content], [grams[i] for i in by_content]
    held = np.arange(len(label)) % 5 == 0
    size = 1 << BITS
    count = {y: np.ones(size) for y in (1, -1)}
    for y, g, h in zip(label.tolist(), grams, held.tolist(), strict=True):
        if not h:
            count[y][g] += 1
    n = {y: (label[~held] == y).sum() + 2 for y in (1, -1)}
    ratio = np.log(count[1] / n[1]) - np.log(count[-1] / n[-1])
    scaled = [ratio[g] / max(np.sqrt((ratio[g] ** 2).sum()), 1e-9) for g in grams]
    train = np.flatnonzero(~held)
    rows_ = Rows.of([grams[i] for i in train], [scaled[i] for i in train])
    weights = hinge(rows_, label[train], size, np.full(len(train), COST))
    model = Model(BITS, weights[:-1] * ratio, ratio**2, float(weights[-1]), (1.0, 0.0))
    margins = Rows.of(grams, scaled).dot(weights[:-1]) + weights[-1]
    total = {y: sum(c for v, c in counts.items() if (1 if v else -1) == y) for y in (1, -1)}
    importance = np.array([total[y] / max((label == y).sum(), 1) for y in label.tolist()])
    importance *= len(label) / importance.sum()
    model.curve = logistic(margins[held], (label[held] + 1) / 2, importance[held])
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", parts: int = 5, least: float = 0.3) -> DataFrame:
    """Per document: the key, ``held_out``, ``score`` and ``predicted``.

    Null and empty texts get the score of a text without n-grams.  Without a model every score is 0.5.
    A null key is not held out.  Rows are judged one by one.
    """
    rows = pick(docs, id_col, text_col).toDF("id", "text")
    shared = Shared(docs.sparkSession, model, lambda m: (m, Indicators(BITS)))

    def make():
        m, indicators = shared.tool()

        def work(batch):
            n = batch.num_rows
            if m is None:
                found = np.full(n, 0.5)
            else:
                found = m.scores(m.margins(*indicators.of(texts(batch, "text")), n))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found)], names=["id", "score"])

        return work

    kind = rows.schema["id"].dataType.simpleString()
    scored = map_chunks(rows, f"id {kind}, score double", "text", make)
    held = F.coalesce(part_of(F.col("id"), parts) == 0, F.lit(False))
    return scored.select(F.col("id").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
