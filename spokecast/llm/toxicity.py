"""Toxicity by weak supervision.

Voters are words (lexicon) and word beginnings (patterns), at all or in some share of a text's words, that
labelled toxic texts have far more often than others, and a few patterns over their hits.  A generative model of all documents' votes estimates each
voter's rate in toxic and other texts and the voters' correlations by expectation maximisation;
evidence of voters that say the same counts once.  A linear classifier is trained on the posterior labels.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.llm.linear import Rows, hinge, logistic, part_of, sampled, sigmoid
from spokecast.llm.text import Shared, map_chunks, pick, texts
from spokecast.session import cut_lineage

#: Word beginnings of so many characters are patterns.
BEGINNINGS = (3, 4, 5, 6)
#: About so many labelled rows of each class are read for the voters and for the classifier.
SAMPLE_EACH = 5000
#: A feature must be in this share of the labelled toxic texts, and in so many of them at least.
LEAST_SHARE, LEAST_TEXTS = 0.004, 4
VOTERS, PATTERNS, FEATURES = 58, 3, 2000
ROUNDS = 8
#: Weight of the labelled counts in the label model, in texts of each class.
ANCHOR = 50.0
COST = 0.5
FLUSH = 100_000
#: Words without features that a worker remembers; it only saves time.
WORDS_KEPT = 100_000
#: How far a feature's gain must be above what the best of as many features has by chance.
SURE = 2.0
#: Levels of a feature in a text: present, and these shares of its words.
LEVELS = (0.0, 0.003, 0.008)

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters, lower-cased; characters beyond ASCII count as letters."""
    return text.decode("utf-8", errors="replace").lower().encode().translate(_LETTERS).split()


def features_of(word: bytes) -> list[str]:
    """The word itself and its beginnings."""
    text = word.decode("utf-8", errors="replace")
    return [f"{text}$", *(text[:n] for n in BEGINNINGS if len(text) > n)]


class Table(dict):
    """Word to the row of its known features; row 0 has none.  A feature has the level from which it counts."""

    def __init__(self, features: list[tuple[str, int]]):
        super().__init__()
        self.places = {f: i for i, (f, _) in enumerate(features)}
        self.least = np.array([LEVELS[level] for _, level in features] or [0.0])
        self.size, self.width = max(1, len(features)), 1 + len(BEGINNINGS)
        self.rows: list[list[int]] = [[-1] * self.width]

    def __missing__(self, word: bytes) -> int:
        known = [self.places[f] for f in features_of(word) if f in self.places]
        row = 0
        if known:
            row = len(self.rows)
            self.rows.append(known + [-1] * (self.width - len(known)))
        if len(self) < WORDS_KEPT or row:
            self[word] = row
        return row

    def of(self, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text numbers and features, each pair once; and the words with a feature in each text."""
        n = sum(map(len, words))
        row = np.fromiter((self[w] for t in words for w in t), np.int64, n)
        of = np.repeat(np.arange(len(words)), [len(t) for t in words])
        at = np.flatnonzero(row)
        found = np.array(self.rows)[row[at]]
        pairs = (of[at][:, None] * self.size + found)[found >= 0]
        pairs, times = np.unique(pairs, return_counts=True)
        text, feature = pairs // self.size, pairs % self.size
        counts = times >= self.least[feature] * np.array([len(t) for t in words])[text]
        return text[counts], feature[counts], np.bincount(of[at], minlength=len(words))


def _counted(rows: DataFrame) -> DataFrame:
    """Features of labelled texts, with the numbers of toxic and of other texts that have them at each level."""
    columns = [f"{y}{k}" for y in ("other", "toxic") for k in range(len(LEVELS))]

    def run(batches):
        counts: dict[str, list[int]] = defaultdict(lambda: [0] * len(columns))

        def out():
            values = list(zip(*counts.values(), strict=True)) or [[]] * len(columns)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array(v, pa.int64()) for v in values)], names=["feature", *columns])
            counts.clear()

        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), texts(batch, "text"), strict=True):
                words = Counter(words_of(text))
                found: Counter[str] = Counter()
                for word, times in words.items():
                    for feature in features_of(word):
                        found[feature] += times
                least = [x * words.total() for x in LEVELS]
                for feature, times in found.items():
                    own = counts[feature]
                    for k, x in enumerate(least):
                        own[label * len(LEVELS) + k] += times >= x
                if len(counts) > FLUSH:
                    yield from out()
        yield from out()

    counted = rows.select("label", "text").mapInArrow(run, "feature string, " + ", ".join(f"{c} bigint" for c in columns))
    return counted.groupBy("feature").agg(*(F.sum(c).alias(c) for c in columns))


def _gain(toxic: np.ndarray, other: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """How much better a text's class is known from the feature: the log-likelihood ratio, 0 where it speaks against."""
    p1, p0, p = (toxic + 0.5) / (n1 + 1), (other + 0.5) / (n0 + 1), (toxic + other + 1) / (n1 + n0 + 2)
    ratio = toxic * np.log(p1 / p) + other * np.log(p0 / p) + (n1 - toxic) * np.log((1 - p1) / (1 - p)) + (n0 - other) * np.log((1 - p0) / (1 - p))
    return np.where(p1 > 4 * p0, ratio, 0.0)


@dataclass
class Model:
    voters: list[tuple[str, int]]
    rates: np.ndarray  # of each vote in toxic and in other texts
    share: np.ndarray  # how far each voter's evidence counts
    correlations: np.ndarray
    prior: float
    features: list[tuple[str, int]]
    weight: np.ndarray
    bias: float
    curve: tuple[float, float]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance that a text is toxic, from its votes (texts by voters)."""
        yes, no = np.log(self.rates[0] / self.rates[1]), np.log((1 - self.rates[0]) / (1 - self.rates[1]))
        return sigmoid(np.log(self.prior / (1 - self.prior)) + no @ self.share + votes @ ((yes - no) * self.share))


def _bits(masks: np.ndarray, n: int) -> np.ndarray:
    return ((masks[:, None] >> np.arange(n)) & 1).astype(float)


def _mask(table: Table, words: list[list[bytes]]) -> np.ndarray:
    """Votes of each text in the bits of a number: the voters, then the patterns over their hits."""
    text, voter, hits = table.of(words)
    masks = np.zeros(len(words), np.int64)
    np.bitwise_or.at(masks, text, np.int64(1) << voter)
    size = np.array([len(t) for t in words])
    several = np.bincount(text, minlength=len(words))
    for k, pattern in enumerate(((hits >= 2) & (hits * 200 >= size), several >= 3, (hits > 0) & (hits * 100 >= size))):
        masks |= pattern.astype(np.int64) << (VOTERS + k)
    return masks


def votes(docs: DataFrame, voters: list[tuple[str, int]]) -> DataFrame:
    """Per text its votes as the bits of ``mask``."""
    shared = Shared(docs.sparkSession, voters, Table)

    def make():
        table = shared.tool()

        def work(batch):
            yield pa.RecordBatch.from_arrays([pa.array(_mask(table, [words_of(t) for t in texts(batch, "text")]))], names=["mask"])

        return work

    return map_chunks(docs.select("text"), "mask bigint", "text", make)


def _moments(patterns: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Over all documents: for each class the number of texts, of votes and of common votes, by posterior."""
    n = VOTERS + PATTERNS

    def run(batches):
        total = np.zeros((2, n + 1, n + 1))
        for batch in batches:
            votes_ = _bits(batch.column("mask").to_numpy(), n)
            count = batch.column("n").to_numpy().astype(float)
            toxic = model.posterior(votes_)
            one = np.column_stack([np.ones(len(votes_)), votes_])
            for y, p in enumerate((toxic, 1 - toxic)):
                total[y] += one.T @ (one * (p * count)[:, None])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    got = patterns.mapInArrow(run, "sums binary").collect()  # a matrix of fixed size for each task
    return sum((np.frombuffer(r.sums).reshape(2, n + 1, n + 1) for r in got), np.zeros((2, n + 1, n + 1)))


def _label_model(patterns: DataFrame, model: Model, first: np.ndarray) -> None:
    """Fits rates, prior and correlations to the votes of all documents, in place."""
    for r in range(ROUNDS):
        total = _moments(patterns, model)
        count = total[:, 0, 0]
        model.rates = np.clip((total[:, 0, 1:] + ANCHOR * first + 0.01) / (count[:, None] + ANCHOR + 0.02), 1e-6, 1 - 1e-6)
        model.prior = float(np.clip((count[0] + 1) / (count.sum() + 2), 1e-4, 0.9))
        if r == 1:  # the posterior is settled enough to tell which votes come together within a class
            mean = total[0, 0, 1:] / max(count[0], 1e-9)
            both = total[0, 1:, 1:] / max(count[0], 1e-9) - np.outer(mean, mean)
            spread = np.sqrt(np.maximum(np.diag(both), 1e-12))
            model.correlations = np.where(np.outer(spread, spread) > 1e-9, both / np.outer(spread, spread), 0.0)
            np.fill_diagonal(model.correlations, 1.0)
            model.share = 1 / np.maximum(np.where(model.correlations > 0.2, model.correlations, 0.0).sum(axis=1), 1.0)


def _chosen(rows, n1: int, n0: int) -> tuple[list[tuple[str, int]], list[tuple[str, int]], np.ndarray]:
    """Voters and features of the classifier, each with its level, and the voters' rates in the labelled texts."""
    rows = sorted(rows, key=lambda r: r.feature)
    toxic, other = (np.array([[r[f"{y}{k}"] for k in range(len(LEVELS))] for r in rows], float).reshape(-1, len(LEVELS)) for y in ("toxic", "other"))
    gain = _gain(toxic, other, n1, n0)
    level = gain.argmax(axis=1) if len(rows) else np.empty(0, int)
    each = np.arange(len(rows))
    gain, toxic, other = gain[each, level], toxic[each, level], other[each, level]
    names = [(r.feature, int(k)) for r, k in zip(rows, level, strict=True)]
    bar = np.log(max(2, len(rows))) + SURE  # so many features were tried
    order = [i for i in np.argsort(-gain, kind="stable").tolist() if gain[i] > bar]
    voters: list[int] = []
    for i in order:
        name = rows[i].feature
        nested = (j for j in voters if name.startswith(rows[j].feature.rstrip("$")) or rows[j].feature.startswith(name.rstrip("$")))
        if len(voters) < VOTERS and not any(abs(toxic[i] - toxic[j]) <= 0.05 * toxic[j] for j in nested):
            voters.append(i)
    rates = np.array([[(toxic[i] + 0.1) / (n1 + 0.2) for i in voters], [(other[i] + 0.1) / (n0 + 0.2) for i in voters]])
    return [names[i] for i in voters], [names[i] for i in order[:FEATURES]], rates


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample_each: int = SAMPLE_EACH, parts: int = 5) -> Model | None:
    """The model, or none if there are no labelled rows of both classes or no voter.

    Of the labels only rows whose CRC-32 of the key modulo ``parts`` is not 0 are read, about
    ``sample_each`` of each class.  The label model is fitted to the votes of all documents.
    """
    known = pick(labels, id_col, label_col).toDF("id", "label").where("label IS NOT NULL")
    known = known.where(part_of(F.col("id"), parts) != 0).select("id", (F.col("label") != 0).cast("int").alias("label"))
    chosen, counts = sampled(known, "id", "label", sample_each)
    if len(counts) < 2:
        return None
    rows = pick(docs, id_col, text_col).toDF("id", "text")
    sample = rows.join(F.broadcast(chosen), "id")  # 4 times sample_each rows at most
    size = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    least = max(LEAST_TEXTS, int(LEAST_SHARE * n1))
    # A feature is in a given share of the toxic texts, so there are no more than that many times a text's words.
    voters, features, rates = _chosen(_counted(sample).where(F.col("toxic0") >= least).collect(), n1, n0)
    if not voters:
        return None
    n = VOTERS + PATTERNS
    first = np.full((2, n), 1e-4)
    first[:, : len(voters)] = rates
    first[0, VOTERS:], first[1, VOTERS:] = (0.7, 0.6, 0.6), (0.005, 0.002, 0.005)
    prior = counts[1] / sum(counts.values())
    model = Model(voters, np.clip(first, 1e-6, 1 - 1e-6), np.ones(n), np.eye(n), prior, features, np.zeros(0), 0.0, (1.0, 0.0))
    patterns = cut_lineage(votes(rows, voters).groupBy("mask").agg(F.count("*").alias("n")))
    _label_model(patterns, model, np.clip(first, 1e-6, 1 - 1e-6))
    _classifier(sample, model)
    return model


def _classifier(sample: DataFrame, model: Model) -> None:
    """Trains the linear classifier on the sample's posterior labels, in place."""
    shared = Shared(sample.sparkSession, (model.voters, model.features), lambda x: (Table(x[0]), Table(x[1])))

    def make():
        voters, features = shared.tool()

        def work(batch):
            words = [words_of(t) for t in texts(batch, "text")]
            text, feature, _ = features.of(words)
            cuts = np.searchsorted(text, np.arange(len(words) + 1)).tolist()
            found = [feature[a:b].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(_mask(voters, words)), pa.array(found, pa.binary())], names=["mask", "found"])

        return work

    got = sorted(map_chunks(sample.select("text"), "mask bigint, found binary", "text", make).collect(), key=lambda r: (r.mask, r.found))
    posterior = model.posterior(_bits(np.array([r.mask for r in got], np.int64), VOTERS + PATTERNS))
    places = [np.frombuffer(r.found, "<u4").astype(np.int64) for r in got]
    rows = Rows.of(places, [np.ones(len(p)) for p in places])
    label = np.where(posterior >= 0.5, 1, -1)
    weights = hinge(rows, label, len(model.features), COST * np.abs(2 * posterior - 1))
    # The sample has more toxic texts than the corpus; the curve is fitted in the corpus's proportions.
    toxic = max(float((label == 1).mean()), 1e-6)
    importance = np.where(label == 1, model.prior / toxic, (1 - model.prior) / max(1 - toxic, 1e-6))
    model.weight, model.bias = weights[:-1], float(weights[-1])
    model.curve = logistic(rows.dot(weights[:-1]) + weights[-1], posterior, importance)


def _scorer(shared: Shared):
    def make():
        model, table = shared.tool()

        def scores(found: list[bytes]) -> np.ndarray:
            if model is None:
                return np.zeros(len(found))
            text, feature, _ = table.of([words_of(t) for t in found])
            return sigmoid(model.curve[0] * (np.bincount(text, model.weight[feature], len(found)) + model.bias) + model.curve[1])

        return scores

    return make


def _shared(spark, model: Model | None) -> Shared:
    return Shared(spark, model, lambda m: (m, Table(m.features if m else [])))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", parts: int = 5, least: float = 0.5) -> DataFrame:
    """Per document: the key, ``held_out``, ``score`` and ``predicted``.

    Null and empty texts score as texts without votes.  Without a model every score is 0.  A null key is
    not held out.  Rows are judged one by one; other columns are not read.
    """
    rows = pick(docs, id_col, text_col).toDF("id", "text")
    make_scores = _scorer(_shared(docs.sparkSession, model))

    def make():
        scores = make_scores()

        def work(batch):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores(texts(batch, "text")))], names=["id", "score"])

        return work

    kind = rows.schema["id"].dataType.simpleString()
    scored = map_chunks(rows, f"id {kind}, score double", "text", make)
    held = F.coalesce(part_of(F.col("id"), parts) == 0, F.lit(False))
    return scored.select(F.col("id").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model | None, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents below ``least``, with all their columns, in one pass.

    Null and empty texts score as texts without votes.  Rows are judged one by one, so repeated rows stay or go
    together and keys do not matter.  Without a model all stay; an empty table stays empty.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    rows = docs.toDF(*names)
    make_scores = _scorer(_shared(docs.sparkSession, model))

    def make():
        scores = make_scores()

        def work(batch):
            yield batch.filter(pa.array(scores(texts(batch, text)) < least))

        return work

    return map_chunks(rows, rows.schema, text, make).toDF(*docs.columns)
