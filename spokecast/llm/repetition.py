"""Quality rules on repetition: characters inside repeated n-grams and lines.

For every text one pass in numpy over a chunk of texts names each word, rolls the names into
n-gram names, finds n-grams met twice or more in their text, and measures which share of the
characters of all words lies in them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokecast.llm.text import Names, covered, map_chunks, owner, pick, sums, texts, whole_windows, window_names

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    """Limits; a text that exceeds one is not kept.

    ``repeat_width``: words of the windows behind ``n_repeat_words``; ``widths``: n-gram lengths whose
    share of characters is measured, each with its limit in per cent; ``line_limit``: limit in per cent
    of the characters of lines equal to an earlier one.
    """

    least_words: int = 50
    repeat_width: int = 3
    repeat_limit: int = 50
    widths: tuple[tuple[int, int], ...] = ((5, 30), (7, 28), (10, 26))
    line_limit: int = 30


def _repeated(names: np.ndarray, first: np.ndarray, of: np.ndarray, width: int) -> np.ndarray:
    """For each word: is it in a ``width``-word window found twice or more in its text."""
    n = len(names)
    if n < width:
        return np.zeros(n, bool)
    at = np.flatnonzero(whole_windows(first, width))
    rolled = window_names(names, width)[at]
    order = np.lexsort((rolled, of[at]))
    a, b = at[order[:-1]], at[order[1:]]
    same = (of[a] == of[b]) & (rolled[order[:-1]] == rolled[order[1:]])
    for k in range(width):  # equal names of windows are verified word by word
        same &= names[a + k] == names[b + k]
    return covered(np.unique(np.concatenate([a[same], b[same]])), width, n)


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier one, and the characters of their words."""
    seen: set[bytes] = set()
    count = chars = 0
    for line in text.split(b"\n"):
        if line in seen:
            count += 1
            chars += sum(len(w.decode()) for w in line.split())
        elif line.strip():
            seen.add(line)
    return count, chars


def measure(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the key, counts, covered characters and the two verdicts.

    Words are runs of anything but space and U+0009 to U+000D.  Null and empty texts have no words, all
    counts 0, and fail the base rules.  Repeated rows are judged one by one; columns other than the key
    and the text are not read.  ``covered_N``: characters of words inside N-word windows found twice or
    more; ``line_chars``: characters of words in lines equal to an earlier line.
    """
    symbols = np.zeros(256, np.int64)
    symbols[list(SYMBOLS)] = 1
    char_starts = np.array([(b & 0xC0) != 0x80 for b in range(256)], np.int64)
    blanks = np.zeros(256, np.int64)
    blanks[[32, 9, 10, 11, 12, 13]] = 1

    def make():
        names_of = Names()

        def work(batch: pa.RecordBatch):
            found = texts(batch, "text")
            words = [t.split() for t in found]
            names, first = names_of.of(words)
            of = owner(first)
            bytes_in = np.array([np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in found]).reshape(-1, 256)
            word_chars = bytes_in @ (char_starts - blanks)
            lengths = np.fromiter((len(w.decode()) for t in words for w in t), np.int64, len(names))
            lines = np.array([_lines(t) for t in found], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.diff(first)),
                    pa.array(word_chars),
                    pa.array(bytes_in @ symbols),
                    pa.array(lines[:, 0]),
                    pa.array(lines[:, 1]),
                    pa.array(sums(_repeated(names, first, of, rules.repeat_width), first)),
                    *(pa.array(sums(lengths * _repeated(names, first, of, n), first)) for n, _ in rules.widths),
                ],
                names=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "line_chars", "n_repeat_words"]
                + [f"covered_{n}" for n, _ in rules.widths],
            )

        return work

    slim = pick(docs, id_col, text_col).toDF("id", "text")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "line_chars", "n_repeat_words"]
    counts += [f"covered_{n}" for n, _ in rules.widths]
    schema = f"id {slim.schema['id'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in counts)
    judged = map_chunks(slim, schema, "text", make)
    base_failed = (F.col("n_words") < rules.least_words) | (
        100 * F.col("n_repeat_words") > rules.repeat_limit * F.col("n_words")
    )
    repeats = 100 * F.col("line_chars") > rules.line_limit * F.col("word_chars")
    for n, limit in rules.widths:
        repeats = repeats | (100 * F.col(f"covered_{n}") > limit * F.col("word_chars"))
    return judged.withColumns({"base_failed": base_failed, "kept": ~base_failed & ~repeats}).withColumnRenamed("id", id_col)
