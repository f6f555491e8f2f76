"""Token ids of documents in compressed binary files, in the order of the keys, and the way back.

A file is a Parquet table of frames.  A frame holds whole documents, one after the other: their keys, how many
ids each has, and a binary value of blocks that are compressed and checksummed one by one (``rangecoder``).  Files
are written by Spark's own writer to a path that all executors reach, so that a lost task is simply run
again, and any frame can be read without the others.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokecast.llm import rangecoder
from spokecast.llm.text import Shared, chunks, give_back, pick

#: Ids of a frame, if no single document has more, and ids that a task codes and decodes at a time.
FRAME_IDS = 1 << 17
BATCH_IDS = 1 << 22
READ_IDS = 3 << 21
CHUNK_BYTES = 2 << 20
#: Pieces after which a worker's table of known pieces is emptied; it only saves time.
PIECES_KEPT = 1_000_000
#: Pieces that go to the tokenizer in one text.
JOINED = 500

#: Kinds of bytes.  Letters are those that lower-casing and normalising leave alone, the lead byte of the accented
#: ones with them; a byte of any other kind makes the whole word between white space an odd one.
SPACE, LETTER, MARK, DIGIT, ODD = range(5)
KINDS = np.full(256, ODD, np.uint8)
KINDS[list(b" \t\n\x0b\x0c\r")] = SPACE
KINDS[[*range(ord("a"), ord("z") + 1), 0xC3, *range(0xA0, 0xB7), *range(0xB8, 0xC0)]] = LETTER
KINDS[list(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')] = MARK
KINDS[list(b"0123456789")] = DIGIT
#: The first bytes of a little-endian number, by how many.
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: The normalizers and the split of vocabularies that drop white space between words.
NORMALIZERS = ({"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"})
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Pieces:
    """A growing hash table, in numpy, of pieces of 1 to 16 bytes without zeros: two numbers of eight bytes each, and a value."""

    def __init__(self, bits: int = 16):
        self.bits, self.used = bits, 0
        self.first, self.second = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.value = np.full(1 << bits, -1, np.int64)

    def _slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        mixed = second * np.uint64(0x9E3779B97F4A7C15)
        mixed += first
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed >>= np.uint64(64 - self.bits)
        return mixed.view(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The value of each piece; -1 for one that is not known."""
        slots = self._slots(first, second)
        found = self.value.take(slots)
        left = np.flatnonzero(((self.first.take(slots) != first) | (self.second.take(slots) != second)) & (found >= 0))
        slots, first, second = slots[left], first[left], second[left]
        while len(left):
            slots = (slots + 1) & ((1 << self.bits) - 1)
            values = self.value.take(slots)
            found[left] = values
            more = ((self.first.take(slots) != first) | (self.second.take(slots) != second)) & (values >= 0)
            left, slots, first, second = left[more], slots[more], first[more], second[more]
        return found

    def add(self, first: np.ndarray, second: np.ndarray, value: np.ndarray) -> None:
        """Takes in distinct pieces that are not known."""
        if 2 * (self.used + len(first)) > 1 << self.bits:
            known = np.flatnonzero(self.value >= 0)
            first, second, value = (np.concatenate([a[known], b]) for a, b in ((self.first, first), (self.second, second), (self.value, value)))
            self.__init__((2 * len(first)).bit_length())
        self.used += len(first)
        slots = self._slots(first, second)
        while len(slots):
            free = self.value.take(slots) < 0
            at = slots[free]
            self.first[at], self.second[at], self.value[at] = first[free], second[free], value[free]
            lost = (self.first.take(slots) != first) | (self.second.take(slots) != second)
            # Of pieces that meet in a slot the last one written stays.
            slots, first, second, value = (slots[lost] + 1) & ((1 << self.bits) - 1), first[lost], second[lost], value[lost]


def _places(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all runs of ``sizes`` from ``begin`` on, in a row."""
    ends = np.cumsum(sizes)
    out = np.repeat(begin - (ends - sizes), sizes)
    out += np.arange(len(out))
    return out


class Tokens:
    """Encodes chunks of texts with the tokenizers library, which is asked for a piece of text once.

    That holds for vocabularies that split texts at white space and drop it; with others whole texts are encoded.
    Pieces are what the vocabulary's split makes of plain words; an odd word is one piece, and goes through all
    steps of the vocabulary, while plain pieces go through those that change them.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_str(spec)
        self.tool.no_truncation()
        self.tool.no_padding()
        known = json.loads(spec)
        normalizer, split = known.get("normalizer") or {}, known.get("pre_tokenizer") or {}
        first, *rest = split.get("pretokenizers") or [{}]
        suffix, vocab = known["model"].get("end_of_word_suffix"), known["model"]["vocab"]
        self.by_word = (
            tuple(normalizer.get("normalizers", ())) == NORMALIZERS
            and first.get("type") == "Split"
            and first["pattern"] == {"Regex": SPLIT}
            and (first["behavior"], first["invert"]) == ("Removed", True)
            and all(r["type"] == "ByteLevel" and not r["add_prefix_space"] and not r.get("use_regex", True) for r in rest)
            and not any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in known["added_tokens"])
            and bool(suffix)
        )
        self.added = [x["content"].encode() for x in known["added_tokens"]]
        if not self.by_word:
            return
        steps = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *rest]}
        self.plain = Tokenizer.from_str(json.dumps(known | {"normalizer": None, "pre_tokenizer": steps, "post_processor": None, "added_tokens": [], "truncation": None, "padding": None}))
        self.last = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.pieces = Pieces()
        self.others: dict[bytes, int] = {}
        self.pool, self.filled = np.empty(1 << 16, np.int32), 0

    def encode(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        if not self.by_word:
            made = _ids(self.tool, [t.decode() for t in found])
            return np.concatenate([*made, np.empty(0, np.int32)]), np.array([len(m) for m in made], np.int64)
        if self.pieces.used + len(self.others) > PIECES_KEPT:
            self._forget()
        # All is lower-cased by the tokenizer anyway, but for added tokens, which it looks for in the text as it stands.
        text = b"\n".join([*found, b""]).lower()
        marked = any(a in text for a in self.added)
        if marked:
            text = b"".join((t if any(a in t.lower() for a in self.added) else t.lower()) + b"\n" for t in found)
        begin, size, odd = self._cut(text, marked)
        value = self._values(text, begin, size, odd)
        count = value & 0xFFFFFFFF
        ids = self.pool.take(_places(value >> 32, count))
        before = np.concatenate([[0], np.cumsum(count)])
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
        return ids, np.diff(before[np.searchsorted(begin, ends)], prepend=0)

    def _cut(self, text: bytes, marked: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and size of every piece, and whether it is an odd word."""
        kind = np.frombuffer(bytearray(text.translate(KINDS.tobytes())), np.uint8)
        for token in self.added if marked else ():
            at = text.find(token)
            while at >= 0:
                kind[at : at + len(token)] = ODD
                at = text.find(token, at + 1)
        odd = np.flatnonzero(kind == ODD)
        if len(odd):
            gaps = np.concatenate([[-1], np.flatnonzero(kind == SPACE)])
            behind = np.unique(np.searchsorted(gaps, odd))
            begin = gaps[behind - 1] + 1
            kind[_places(begin, gaps[behind] - begin)] = ODD
        edge = kind == DIGIT
        edge[:1] = True
        edge[1:] |= kind[1:] != kind[:-1]
        at = np.flatnonzero(edge)
        size = np.diff(at, append=len(kind))
        what = kind.take(at)
        kept = np.flatnonzero(what != SPACE)
        return at.take(kept), size.take(kept), what.take(kept) == ODD

    def _values(self, text: bytes, begin: np.ndarray, size: np.ndarray, odd: np.ndarray) -> np.ndarray:
        """For every piece the place of its ids in the pool, and in the lower 32 bits how many they are."""
        every = np.ndarray(len(text) + 9, "<u8", text + bytes(16), strides=(1,))
        first = every[begin] & FIRST_BYTES.take(np.minimum(size, 8))
        second = every[begin + 8] & FIRST_BYTES.take(np.clip(size - 8, 0, 8))
        value = self.pieces.find(first, second)
        other = odd | (size > 16)
        value[other] = -1
        new = np.flatnonzero((value < 0) & ~other)
        if len(new):
            ends = begin + size
            names = {text[a:b]: i for a, b, i in zip(begin[new].tolist(), ends[new].tolist(), new.tolist(), strict=True)}
            at = np.fromiter(names.values(), np.int64, len(names))
            self.pieces.add(first[at], second[at], self._keep(*self._joined(list(names))))
            value[new] = self.pieces.find(first[new], second[new])
        other = np.flatnonzero(other)
        words = [text[a : a + n] for a, n in zip(begin[other].tolist(), size[other].tolist(), strict=True)]
        new = list(set(words).difference(self.others))
        if new:
            made = _ids(self.tool, [w.decode() for w in new])
            self.others.update(zip(new, self._keep(np.concatenate(made), np.array([len(m) for m in made], np.int64)).tolist(), strict=True))
        value[other] = np.fromiter(map(self.others.__getitem__, words), np.int64, len(words))
        return value

    def _keep(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Puts ids into the pool; the values of their pieces."""
        begin = self.filled + np.cumsum(counts) - counts
        self.filled += len(ids)
        if self.filled > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(self.filled, np.int32)])
        self.pool[self.filled - len(ids) : self.filled] = ids
        return (begin << 32) + counts

    def _joined(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain pieces, many to a text; the ids that end a piece tell them apart.  All ids, and how many each has."""
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        out, counts = [], []
        for group, ids in zip(groups, _ids(self.plain, [b" ".join(g).decode() for g in groups]), strict=True):
            ends = np.flatnonzero(self.last.take(ids)) + 1
            if len(ends) == len(group) and ends[-1] == len(ids):
                out.append(ids)
                counts.append(np.diff(ends, prepend=0))
            else:
                made = _ids(self.plain, [w.decode() for w in group])
                out += made
                counts.append(np.array([len(m) for m in made], np.int64))
        return np.concatenate(out), np.concatenate(counts)


def _ids(tool, texts: list[str]) -> list[np.ndarray]:
    return [np.array(e.ids, np.int32) for e in tool.encode_batch_fast(texts, add_special_tokens=False)]


def _frames(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of documents with ``most`` ids together, or of one longer document."""
    ends, out, begin, done = np.cumsum(sizes), [], 0, 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
        out.append((begin, end))
        begin, done = end, int(ends[end - 1])
    return out


def write(
    docs: DataFrame, vocabulary: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encodes every text, adds ``end_id``, and writes all ids to files below ``path`` in ascending order of the key.

    ``vocabulary`` is the path of a tokenizers file on the driver; no special tokens are added.  Null and empty texts
    have the end id alone.  Rows without a key come first; rows of equal keys stand in the order of a hash of their
    text, equal rows are kept as often as they come.  An empty table gives files without frames.  Other columns are
    not read.  Rows are dealt out by ranges of key, hash and row, so that no key can fill a task; a task holds the ids
    of ``BATCH_IDS`` at most, or of one longer text.  Ids from ``rangecoder.TOP_ID`` on are an error.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    top = max([*json.loads(spec)["model"]["vocab"].values(), *(t["id"] for t in json.loads(spec)["added_tokens"]), end_id])
    if top >= rangecoder.TOP_ID or end_id < 0:
        raise ValueError(f"ids must lie from 0 to {rangecoder.TOP_ID - 1}")
    high = (top >> 8) + 1
    shared = Shared(docs.sparkSession, spec, Tokens)
    slim = pick(docs, id_col, text_col).toDF("id", "text").withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("id").asc_nulls_first(), "hash", "row"]
    rows = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text", F.spark_partition_id().alias("part"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, at = shared.tool(), 0
        keys: list[pa.Array] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        amount, part = 0, 0

        def coded() -> Iterator[pa.RecordBatch]:
            nonlocal at, amount
            ids, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
            key = pa.concat_arrays(keys)
            held.clear()
            keys.clear()
            cuts = _frames(sizes, FRAME_IDS)
            ends = np.cumsum(sizes)
            begin = ends - sizes
            blocks = rangecoder.pack_frames([ids[begin[a] : ends[b - 1]] for a, b in cuts], high)
            begin += at
            for (a, b), data in zip(cuts, blocks, strict=True):
                offsets = pa.array([0, b - a], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([begin[a]], pa.int64()),
                        pa.array([int(sizes[a:b].sum())], pa.int64()),
                        pa.ListArray.from_arrays(offsets, key.slice(a, b - a)),
                        pa.ListArray.from_arrays(offsets, pa.array(sizes[a:b], pa.int64())),
                        pa.array([data], pa.binary()),
                    ],
                    names=["part", "at", "n_ids", "keys", "sizes", "blocks"],
                )
            at += int(sizes.sum())
            amount = 0

        for whole in batches:
            for batch in chunks(whole, "text", CHUNK_BYTES):
                part = batch.column("part")[0].as_py()
                found = [b"" if t is None else t for t in batch.column("text").cast(pa.binary()).to_pylist()]
                keys.append(batch.column("id"))
                ids, sizes = tool.encode(found)
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                held.append((ids, sizes + 1))
                amount += len(ids)
                if amount >= BATCH_IDS:
                    yield from coded()
        if held:
            yield from coded()
        give_back()

    rows.mapInArrow(run, f"part int, at bigint, n_ids bigint, keys array<{kind}>, sizes array<bigint>, blocks binary").write.parquet(path)


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document of the files: the key, ``start`` (the ids of all documents before it), ``n_tokens`` and ``ids``,
    little-endian unsigned 32-bit numbers.

    A block whose ids do not have the checksum they were written with is an error.  Files without frames give an
    empty table.
    """
    frames = spark.read.parquet(path)
    kind = frames.schema["keys"].dataType.elementType.simpleString()
    # A row for each part: as many as the writer had tasks.
    totals = frames.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("bigint")).alias("before"))
    placed = frames.join(starts, "part").select((F.col("at") + F.col("before")).alias("start"), "n_ids", "keys", "sizes", "blocks")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            ends = np.cumsum(whole.column("n_ids").to_numpy())
            begin = 0
            while begin < whole.num_rows:
                done = int(ends[begin - 1]) if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, done + READ_IDS, side="right")))
                yield from _documents(whole.slice(begin, stop - begin))
                begin = stop
        give_back()

    return placed.mapInArrow(run, f"id {kind}, start bigint, n_tokens bigint, ids binary").withColumnRenamed("id", id_col)


def _documents(frames: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    unpacked = rangecoder.unpack_frames(frames.column("blocks").to_pylist())
    for i, ids in enumerate(unpacked):
        sizes = frames.column("sizes")[i].values.to_numpy()
        ends = np.cumsum(sizes)
        if len(ids) != (ends[-1] if len(ends) else 0):
            raise ValueError("a frame has other ids than its documents")
        data = ids.astype("<u4").tobytes()
        offsets = pa.array(np.concatenate([[0], 4 * ends]), pa.int64())
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, offsets.buffers()[1], pa.py_buffer(data)])
        start = frames.column("start")[i].as_py() + ends - sizes
        yield pa.RecordBatch.from_arrays(
            [frames.column("keys")[i].values, pa.array(start, pa.int64()), pa.array(sizes, pa.int64()), column.cast(pa.binary())],
            names=["id", "start", "n_tokens", "ids"],
        )
