"""Byte-level BPE encoding and decoding with a pair occurrence index.

Each task gathers the distinct pre-tokens of a chunk that it has not met before, indexes every pair of
neighbouring symbols by its merge rank with all its positions, takes the active ranks in ascending order
from a heap, merges all positions of a rank at once and updates the lists of the pairs that arise.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame

from spokecast.llm.text import Shared, give_back, map_chunks, pick, string_column

CHUNK_BYTES = 2 << 20
#: Entries after which a worker's tables of known pieces are emptied; they only save time.
PIECES_KEPT = 120_000

#: Fixed value: the published pre-token pattern of byte-level BPE vocabularies; white space is spelt out,
#: since the vocabularies mean the Unicode property.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    out.update({chr(256 + i): b for i, b in enumerate(rest)})
    return out


class Vocabulary:
    """Ids, merges and added tokens of a byte-level BPE file in the JSON form of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        if not plain or pre.get("add_prefix_space") or spec.get("normalizer") or model.get("dropout"):
            raise ValueError(f"{path}: only byte-level BPE without normalizer, prefix space or dropout")
        alphabet, vocab = byte_alphabet(), model["vocab"]
        if any(c not in vocab for c in alphabet):
            raise ValueError(f"{path}: a byte has no token")
        self.byte_ids = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.byte_ids[b] = vocab[c]
        self.added: dict[str, int] = {}
        for t in spec.get("added_tokens", []):
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError(f"{path}: added tokens must match literally")
            self.added[t["content"]] = t["id"]
        self.bytes_of: dict[int, bytes] = {}
        for token, i in [*vocab.items(), *self.added.items()]:
            known = all(c in alphabet for c in token)
            self.bytes_of[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        keys, made = [], []
        ready = {vocab[c]: -1 for c in alphabet}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, new = vocab[left], vocab[right], vocab[left + right]
            if max(ready.get(a, rank), ready.get(b, rank)) >= rank or new in ready:
                raise ValueError(f"{path}: merge {rank} does not follow those that make its parts")
            ready[new] = rank
            keys.append((a << 32) + b)
            made.append(new)
        order = np.argsort(keys)
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = order.astype(np.int64)
        self.made = np.array(made, np.int64)
        self.pairs = np.array(keys, np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, -1 where there is none."""
        key = (left << 32) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


class PairIndex:
    """Positions of every mergeable pair of a row of words, by rank; the words are not empty."""

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        self.v = vocabulary
        joined = np.frombuffer("".join(words).encode(), np.uint8)
        self.n = n = len(joined)
        starts = np.append(np.flatnonzero((joined & 0xC0) != 0x80), n)  # of characters
        self.ends = starts[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
        self.symbol = np.append(vocabulary.byte_ids[joined], -1)  # one more, beyond both ends of a word
        self.next = np.arange(1, n + 2)
        self.next[self.ends - 1] = n
        self.previous = np.arange(-1, n)
        self.previous[0] = n
        self.previous[self.ends] = n
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._add(np.flatnonzero(self.next[:n] != n))

    def _add(self, at: np.ndarray) -> None:
        ranks = self.v.ranks_of(self.symbol[at], self.symbol[self.next[at]])
        known = ranks >= 0
        at, ranks = at[known], ranks[known]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
            if rank in self.lists:
                self.lists[rank].append(part)
            else:
                self.lists[rank] = [part]
                heapq.heappush(self.active, rank)

    def _merge(self, rank: int) -> None:
        left, right = divmod(int(self.v.pairs[rank]), 1 << 32)
        lists = self.lists.pop(rank)
        at = np.sort(np.concatenate(lists))
        at = at[(self.symbol[at] == left) & (self.symbol[self.next[at]] == right) & np.append(True, at[1:] != at[:-1])]
        if left == right and len(at) > 1:  # in a run of one symbol, from the left, every second pair
            i = np.arange(len(at))
            begin = np.concatenate([[True], self.next[at[:-1]] != at[1:]])
            at = at[(i - np.maximum.accumulate(np.where(begin, i, 0))) % 2 == 0]
        if not len(at):
            return
        gone = self.next[at]
        after = self.next[gone]
        self.symbol[at], self.symbol[gone] = self.v.made[rank], -2
        self.next[at] = after
        self.previous[after] = at
        before = self.previous[at]
        self._add(np.concatenate([before[before != self.n], at[after != self.n]]))

    def encode(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where in it each word ends."""
        while self.active:
            self._merge(heapq.heappop(self.active))
        kept = self.symbol[: self.n] >= 0
        return self.symbol[: self.n][kept].astype("<i4"), np.concatenate([[0], np.cumsum(kept)])[self.ends]


#: Does a piece begin with a space before anything but white space.
SPACED = re.compile(r" \S").match


def _words_in(pieces: list[str], words: list[str]) -> list[int]:
    """How many of the consecutive words each of the consecutive pieces has, by their lengths."""
    lengths = [np.cumsum(np.fromiter(map(len, x), np.int64, len(x))) for x in (words, pieces)]
    return np.diff(np.searchsorted(*lengths) + 1, prepend=0).tolist()


class Encoder:
    """Encodes chunks of texts; pieces met before are looked up."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pre_token = regex.compile(PRE_TOKEN)
        added = sorted(vocabulary.added, key=len, reverse=True)
        self.split_added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        # A space before anything but white space begins a pre-token, so pieces can be encoded alone.
        self.split_pieces = re.compile(r"(?= \S)")
        self.pieces: dict[str, bytes] = {}

    def _pieces(self, text: str) -> list[str]:
        if self.split_added is None or not any(t in text for t in self.v.added):
            return self.split_pieces.split(text)
        out = []
        for part in self.split_added.split(text):
            out += [part] if part in self.v.added else self.split_pieces.split(part)
        return out

    def _learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces; those that begin with a space can stand in one text without touching each other."""
        spaced, bare = [], []
        for p in pieces:
            (spaced if SPACED(p) else bare).append(p)
        words = self.pre_token.findall("".join(spaced))
        counts = _words_in(spaced, words)
        for p in bare:
            found = self.pre_token.findall(p)
            words += found
            counts.append(len(found))
        if not words:
            return
        ids, ends = PairIndex(self.v, words).encode()
        data, cuts = ids.tobytes(), (4 * ends[np.cumsum(counts) - 1]).tolist()
        self.pieces.update(zip(spaced + bare, (data[a:b] for a, b in zip([0, *cuts], cuts)), strict=True))

    def encode(self, found: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of little-endian 32-bit numbers."""
        if len(self.pieces) > PIECES_KEPT:
            self.pieces.clear()
        self.pieces.update({"": b""} | {t: np.int32(i).tobytes() for t, i in self.v.added.items()})
        cut = [self._pieces(t) for t in found]
        new: set[str] = set()
        for c in cut:
            new.update(filterfalse(self.pieces.__contains__, c))
        self._learn(new)
        return [b"".join(map(self.pieces.__getitem__, c)) for c in cut]


def _int_lists(rows: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row the key and ``ids``, as the tokenizers library encodes without adding special tokens.

    ``vocabulary`` is the path of a file on the driver.  Literal strings of the file's added tokens become
    those tokens.  Null and empty texts have no ids.  Rows are independent of each other: repeated rows
    get equal ids, an empty table gives an empty result, other columns are not read.
    """
    slim = pick(docs, id_col, text_col).toDF("id", "text")
    shared = Shared(docs.sparkSession, Vocabulary(vocabulary), Encoder)

    def make():
        encoder = shared.tool()

        def work(batch):
            found = ["" if t is None else t for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), _int_lists(encoder.encode(found))], names=["id", "ids"])

        return work

    kind = slim.schema["id"].dataType.simpleString()
    return map_chunks(slim, f"id {kind}, ids array<int>", "text", make, CHUNK_BYTES).withColumnRenamed("id", id_col)


class Decoder:
    """Texts of rows of ids."""

    def __init__(self, vocabulary: Vocabulary):
        top = max(vocabulary.bytes_of) + 1
        sizes = np.zeros(top, np.int64)
        for i, b in vocabulary.bytes_of.items():
            sizes[i] = len(b)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.data = np.frombuffer(b"".join(vocabulary.bytes_of.get(i, b"") for i in range(top)), np.uint8)

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        ids = np.where((ids >= 0) & (ids < len(self.first) - 1), ids, 0) if len(ids) and (ids.min() < 0 or ids.max() >= len(self.first) - 1) else ids
        sizes = self.first[ids + 1] - self.first[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) + np.repeat(self.first[ids] - ends[:-1], sizes)
        joined = self.data[at].tobytes()
        cuts = ends[first].tolist()
        return [joined[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def decode(rows: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per input row the key, its ids and the text ``decoded`` that they stand for, special tokens included.

    Bytes that are not UTF-8 become U+FFFD, as the tokenizers library has it; null or empty ids give the
    empty text.
    """
    slim = pick(rows, id_col, ids_col).toDF("id", "ids")
    shared = Shared(rows.sparkSession, Vocabulary(vocabulary), Decoder)

    def run(batches):
        decoder = shared.tool()
        for whole in batches:
            sizes = pa.compute.fill_null(pa.compute.list_value_length(whole.column("ids")), 0).to_numpy(zero_copy_only=False)
            groups = np.cumsum(sizes.astype(np.int64)) // (1 << 18)
            for begin, end in _runs(groups):
                batch = whole.slice(begin, end - begin)
                first = np.zeros(end - begin + 1, np.int64)
                np.cumsum(sizes[begin:end], out=first[1:])
                ids = batch.column("ids").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts_ = [_repaired(b) for b in decoder.decode(ids, first)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("ids"), string_column(texts_)], names=["id", "ids", "decoded"])
        give_back()

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnsRenamed({"id": id_col, "ids": ids_col})


def _runs(groups: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
    return [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def _repaired(data: bytes) -> bytes:
    try:
        data.decode()
    except UnicodeDecodeError:
        return data.decode("utf-8", errors="replace").encode()
    return data
