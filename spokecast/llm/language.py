"""Language identification in two steps: the family, then one-versus-one within it.

Texts are profiles of hashed byte n-grams of their lower-cased letters.  One-versus-one linear support
vector machines decide between families; others between the languages of the winning family.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.llm.grams import byte_grams
from spokecast.llm.linear import Rows, hinge, logistic, part_of, sampled, sigmoid
from spokecast.llm.text import Shared, map_chunks, pick, string_column

BITS = 15
SIZES = (1, 2, 3)
#: About so many labelled texts of each language are fitted; this bounds what the driver holds.
SAMPLE_EACH = 1200
COST = 10.0
UNKNOWN = "und"

#: Fixed value: languages by family; any other code is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sr", "hr", "sk"),
    "uralic": ("fi", "et", "hu"),
}

_WORD = re.compile(r"[^\W\d_]")
#: ASCII but a to z becomes a space.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def letters(text: str | None) -> bytes | None:
    """The lower-cased letters, words between single spaces; none if the text has no letter."""
    if not text:
        return None
    first = _WORD.search(text)
    if first is None or not (first.group().isalpha() or any(map(str.isalpha, text))):
        return None
    return b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "


def grams_of(found: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length the hashed n-grams of all texts and their text's number.

    Texts begin and end with a space, so n-grams that cross from one to the next are of no weight.
    """
    data = np.frombuffer(b"".join(found), np.uint8)
    of = np.repeat(np.arange(len(found)), [len(f) for f in found])
    out = []
    for n in SIZES:
        grams = byte_grams(data, n, BITS)
        whole = of[: len(grams)] == of[n - 1 :][: len(grams)]
        out.append((grams[whole], of[: len(grams)][whole]))
    return out


@dataclass
class Model:
    """``votes``: for each pair of classes of a group its row of weights, bias and curve."""

    groups: list[list[str]]  # languages of each family
    weight: np.ndarray  # machines by n-grams
    bias: np.ndarray
    curve: np.ndarray
    between: dict[tuple, int]  # pair of classes to machine

    def margins(self, found: list[bytes]) -> np.ndarray:
        total = np.zeros((len(self.bias), len(found)))
        count = np.zeros(len(found))
        for grams, of in grams_of(found):
            count += np.bincount(of, minlength=len(found))
            for k in range(len(self.bias)):
                total[k] += np.bincount(of, self.weight[k][grams], len(found))
        return total / np.maximum(count, 1) + self.bias[:, None]

    def chances(self, margins: np.ndarray, classes: list) -> np.ndarray:
        """Of each class, from the pairwise machines."""
        out = np.ones((len(classes), margins.shape[1]))
        for i, a in enumerate(classes):
            for j, b in enumerate(classes[:i]):
                k = self.between[b, a]
                p = sigmoid(self.curve[k, 0] * margins[k] + self.curve[k, 1])
                out[j] *= p
                out[i] *= 1 - p
        return out / np.maximum(out.sum(axis=0), 1e-300)

    def predict(self, found: list[bytes]) -> tuple[list[str], np.ndarray]:
        margins = self.margins(found)
        family = self.chances(margins, [tuple(g) for g in self.groups])
        best = family.argmax(axis=0)
        labels, score = [""] * len(found), family[best, np.arange(len(found))]
        for f, group in enumerate(self.groups):
            mine = np.flatnonzero(best == f)
            own = self.chances(margins[:, mine], group)
            at = own.argmax(axis=0)
            score[mine] *= own[at, np.arange(len(mine))]
            for i, k in zip(mine.tolist(), at.tolist(), strict=True):
                labels[i] = group[k]
        return labels, score


def _profiles(docs: DataFrame) -> DataFrame:
    """Per labelled text with a letter its language, its n-grams and their shares."""

    def make():
        def work(batch):
            rows = [(lang, f) for lang, f in zip(batch.column("lang").to_pylist(), map(letters, batch.column("text").to_pylist()), strict=True) if f]
            out = []
            for _, f in rows:
                grams = np.concatenate([g for g, _ in grams_of([f])])
                known, count = np.unique(grams, return_counts=True)
                out.append((known.astype("<u2").tobytes(), (count / len(grams)).astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in rows], pa.string()), pa.array([g for g, _ in out], pa.binary()), pa.array([v for _, v in out], pa.binary())],
                names=["lang", "grams", "shares"],
            )

        return work

    return map_chunks(docs.select("lang", "text"), "lang string, grams binary, shares binary", "text", make)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_each: int = SAMPLE_EACH, parts: int = 4, held: int = 2) -> Model | None:
    """The model, or none if no text has a language.

    Only rows with a language whose CRC-32 of the key modulo ``parts`` is not ``held`` are read, of each
    language about ``sample_each``, and of them only text and language are used.
    """
    rows = pick(docs, id_col, text_col, lang_col).toDF("id", "text", "lang")
    rows = rows.where(F.col("lang").isNotNull() & (part_of(F.col("id"), parts) != held))
    chosen, _ = sampled(rows, "id", "lang", sample_each)
    got = sorted(_profiles(chosen).collect(), key=lambda r: (r.lang, r.grams, r.shares))
    if not got:
        return None
    langs = sorted({r.lang for r in got})
    family_of = {code: name for name, codes in FAMILIES.items() for code in codes}
    by_family: dict[str, list[str]] = {}
    for lang in langs:
        by_family.setdefault(family_of.get(lang, lang), []).append(lang)
    groups = list(by_family.values())
    scale = 40.0  # shares are small; rows get lengths about 1
    places = [np.frombuffer(r.grams, "<u2").astype(np.int64) for r in got]
    values = [np.frombuffer(r.shares, "<f4").astype(float) * scale for r in got]
    lang = np.array([r.lang for r in got])
    family = np.array([next(i for i, g in enumerate(groups) if x in g) for x in lang])
    tasks: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    for i, a in enumerate(groups):
        for j, b in enumerate(groups[:i]):
            tasks[tuple(b), tuple(a)] = (np.flatnonzero((family == i) | (family == j)), family == j)
        for k, x in enumerate(a):
            for y in a[:k]:
                tasks[y, x] = (np.flatnonzero((lang == x) | (lang == y)), lang == y)
    weight, bias, curve = np.zeros((len(tasks), 1 << BITS)), np.zeros(len(tasks)), np.ones((len(tasks), 2))
    for k, (mine, first) in enumerate(tasks.values()):
        label = np.where(first[mine], 1, -1)
        rows_ = Rows.of([places[i] for i in mine], [values[i] for i in mine])
        w = hinge(rows_, label, 1 << BITS, np.full(len(mine), COST), epochs=15)
        weight[k], bias[k] = w[:-1] * scale, w[-1]
        curve[k] = logistic(rows_.dot(w[:-1]) + w[-1], (label + 1) / 2, np.ones(len(mine)))
    return Model(groups, weight.astype(np.float32), bias, curve, {pair: k for k, pair in enumerate(tasks)})


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", parts: int = 4, held: int = 2) -> DataFrame:
    """Per document: the key, ``held_out``, ``lang_pred`` and ``score``.

    Null texts and texts without a letter are ``und`` with score 0, as is every text without a model.  A null
    key is not held out.  Rows are judged one by one; other columns are not read.
    """
    rows = pick(docs, id_col, text_col).toDF("id", "text")
    shared = Shared(docs.sparkSession, model, lambda m: m)

    def make():
        m = shared.tool()

        def work(batch):
            found = [letters(t) for t in batch.column("text").to_pylist()]
            known = [i for i, f in enumerate(found) if f and m is not None]
            labels, score = [UNKNOWN] * len(found), np.zeros(len(found))
            if known:
                best, chance = m.predict([found[i] for i in known])
                score[known] = chance
                for i, x in zip(known, best, strict=True):
                    labels[i] = x
            yield pa.RecordBatch.from_arrays([batch.column("id"), string_column([x.encode() for x in labels]), pa.array(score)], names=["id", "lang_pred", "score"])

        return work

    kind = rows.schema["id"].dataType.simpleString()
    said = map_chunks(rows, f"id {kind}, lang_pred string, score double", "text", make)
    is_held = F.coalesce(part_of(F.col("id"), parts) == held, F.lit(False))
    return said.select(F.col("id").alias(id_col), is_held.alias("held_out"), "lang_pred", "score")
