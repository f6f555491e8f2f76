"""Hashed n-grams of bytes and of word shapes, for chunks of texts."""

from __future__ import annotations

import re

import numpy as np

from spokecast.llm.text import Names

#: Texts of one presence table.
TEXTS_EACH = 512


def byte_grams(data: np.ndarray, size: int, bits: int) -> np.ndarray:
    """For each place of a row of bytes the hashed n-gram that begins there, ``size - 1`` fewer than bytes."""
    x = data.astype(np.uint32)
    n = len(x) - size + 1
    h = np.full(max(n, 0), size, np.uint32)
    for k in range(size):
        h = (h * np.uint32(0x01000193)) ^ x[k : k + len(h)] * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return h >> np.uint32(32 - bits)


class Shapes(dict):
    """Word (bytes) to a small number that tells its shape: case, digits, symbols, last character."""

    SYMBOL = re.compile(rb"[#*$%&|<>!]")

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", errors="replace")
        letters = [c for c in text if c.isalpha()]
        code = 1 + bool(letters and letters[0].isupper())
        code += 2 * bool(len(letters) > 1 and all(c.isupper() for c in letters))
        code += 4 * any(c.isdigit() for c in text) + 8 * bool(self.SYMBOL.search(word)) + 16 * (not text[-1].isalnum()) + 32 * (not letters)
        if len(self) < 100_000:
            self[word] = code
        return code


class Indicators:
    """Which hashed n-grams each text has: bytes of 1 to 3, and 1 to 3 words told by their shapes.

    A word's shape also says whether it repeats the word before it, so runs of one word are n-grams too.
    """

    def __init__(self, bits: int):
        self.bits, self.names, self.shapes = bits, Names(), Shapes()

    def of(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Text numbers and n-grams, in order, each pair once."""
        parts = []
        for begin in range(0, len(found), TEXTS_EACH):
            text, gram = self._table(found[begin : begin + TEXTS_EACH])
            parts.append((text + begin, gram))
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _table(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = 1 << self.bits
        present = np.zeros(len(found) * size, bool)
        data = np.frombuffer(b"".join(found), np.uint8)
        base = np.repeat(np.arange(len(found)) * size, [len(t) for t in found])
        of = base // size
        for n in (1, 2, 3):
            grams = byte_grams(data, n, self.bits)
            whole = of[: len(grams)] == of[n - 1 :] if n > 1 else np.ones(len(grams), bool)
            present[(base[: len(grams)] + grams)[whole]] = True
        words = [t.split() for t in found]
        names, first = self.names.of(words)
        shape = np.fromiter((self.shapes[w] for t in words for w in t), np.uint8, len(names))
        owner = np.repeat(np.arange(len(found)), np.diff(first))
        again = np.append(False, (names[1:] == names[:-1]) & (owner[1:] == owner[:-1])) if len(names) else np.empty(0, bool)
        shape = shape + np.uint8(128) * again.astype(np.uint8)
        for n in (1, 2, 3):
            grams = _shape_grams(shape, n, self.bits)
            whole = owner[: len(grams)] == owner[n - 1 :] if n > 1 else np.ones(len(grams), bool)
            present[(owner[: len(grams)] * size + grams)[whole]] = True
        at = np.flatnonzero(present)
        return at // size, at % size


def _shape_grams(shape: np.ndarray, size: int, bits: int) -> np.ndarray:
    grams = byte_grams(shape, size, 32)
    return ((grams ^ np.uint32(0x5BD1E995)) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)
