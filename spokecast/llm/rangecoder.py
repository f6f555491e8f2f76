"""An adaptive context-mixing range coder for token ids, over many independent blocks at once.

A block begins with a fresh model.  Orders 1 and 2 each predict the id that last followed their context, with a
confidence that grows as the prediction holds; order 0 has the id frequencies of the block so far.  The three
predictions are mixed: the shares of order 2, order 1 and order 0 are learned for every pair of confidences, and
the id is coded by the range coder in the share of the highest order that foretold it.

Blocks do not depend on each other, so a chunk of blocks is worked through side by side: step t codes id t of
every block with numpy.  The decoder takes the model through the same steps.  The encoder knows all ids, so that it
finds what each order foretells by sorting a few blocks' ids by context and time, and all shares between two refreshes
at once; only the arithmetic of the range coder goes step by step.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids of a block, at most 2 to the power of ``TIME_BITS``, and blocks that are coded side by side, 65536 at most.
BLOCK_IDS, TIME_BITS = 2048, 11
LANES = 4096
#: Ids lie below; they are split in a high part and a low part of eight bits.
TOP_ID = 1 << 18
HASH_1, HASH_2 = 10, 11
#: Order-0 tables of low parts; a high part goes with one of them.
PARTS = 4
#: Blocks that are modelled at a time where all ids are known: their tables stay in a core's cache.
MODELLED = 64
SHARE_BITS, HIGH_BITS, LOW_BITS = 8, 11, 10
ALL_BITS = SHARE_BITS + HIGH_BITS + LOW_BITS
PLACE_BITS = 12
FREQ = (1 << PLACE_BITS) - 1
#: Steps at which frequencies and shares take in what has been counted since.
REFRESHED = (32, 128, 512, 1152)
#: What a block counts as seen at its begin, by confidence: the share of an order in 256, told by so many ids.
FIRST_SHARE, FIRST_WEIGHT = (3, 70, 120, 180), 6
MAGIC = b"TIDS"
HEAD, ENTRY = struct.Struct("<4sHHI"), struct.Struct("<III")
VERSION = 2
WORD = np.uint64(32)
MASK = np.uint64(0xFFFFFFFF)
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _zeros(n: int) -> np.ndarray:
    """Numpy asks for large memory pages in ``empty``, not in ``zeros``; tables that are read here and there need them."""
    out = np.empty(n, np.int32)
    out.fill(0)
    return out


class Counts:
    """What blocks have counted so far: high parts, low parts, and outcomes by confidence."""

    def __init__(self, lanes: int, high: int):
        self.sizes = (high, PARTS << 8, 96)
        self.counts = [np.zeros((lanes, n), np.int32) for n in self.sizes]

    def add(self, a: int, b: int, ids: np.ndarray, outcomes: np.ndarray) -> None:
        """A row of ids, and of confidences by outcome, for each block from ``a`` to ``b``."""
        own = np.arange(b - a)[:, None]
        for count, size, seen in zip(self.counts, self.sizes, (ids >> 8, low_place(ids), outcomes), strict=True):
            count[a:b] += np.bincount((seen + own * size).ravel(), minlength=(b - a) * size).reshape(b - a, size)

    def tables(self, n: int, inverse: bool, fresh: bool) -> tuple:
        """Ranges and ways back of high and of low parts, and the ends of shares, for the first ``n`` blocks.

        In ``fresh`` blocks nothing is counted, so that all have the same tables.
        """
        high, low, seen = (c[: 1 if fresh else n] for c in self.counts)
        out = (*_ranges(high, HIGH_BITS, inverse), *_ranges(low.reshape(-1, 256), LOW_BITS, inverse), _edges(seen))
        return tuple(x if x is None or not fresh else np.tile(x, n) for x in out)


def _edges(count: np.ndarray) -> np.ndarray:
    confidence, share = np.arange(32), np.array(FIRST_SHARE)
    two, one, rest = count.reshape(-1, 32, 3).astype(np.int64).transpose(2, 0, 1)
    first = FIRST_WEIGHT * 256
    edge_2 = (256 * 256 * two + first * share[confidence >> 3]) // (256 * (two + one + rest) + first)
    edge_2 = np.clip(edge_2, 1, 250)
    part_1 = (256 * 256 * one + first * share[(confidence >> 1) & 3]) // (256 * (one + rest) + first)
    edge_1 = np.clip(edge_2 + ((256 - edge_2) * part_1 >> 8), edge_2 + 1, 254)
    return (edge_2 + (edge_1 << 8)).astype(np.int32).ravel()


def _ranges(count: np.ndarray, bits: int, inverse: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Each symbol's sum of the frequencies before it and, in the lower bits, its own; and the symbol at each place."""
    size = count.shape[1]
    # A little less than its part for each, so that no rounding makes them more than the whole.
    scale = ((1 << bits) - size) * (1 - 1e-5) / np.maximum(count.sum(axis=1, keepdims=True), 1)
    freq = (count.astype(np.float32) * scale.astype(np.float32)).astype(np.int32)
    freq += 1
    share, rest = np.divmod((1 << bits) - freq.sum(axis=1, dtype=np.int32), size)  # all of it in a block without counts
    freq += share[:, None].astype(np.int32)
    freq[:, 0] += rest
    back = None
    if inverse:
        back = np.repeat(np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), len(count)), freq.ravel())
    sums = np.cumsum(freq, axis=1, dtype=np.int32)
    sums -= freq
    sums <<= PLACE_BITS
    sums += freq
    return sums.ravel(), back


class Model:
    """The state of the models of blocks that are decoded side by side; ``ids`` takes their ids from ``first`` on."""

    def __init__(self, lanes: int, high: int, ids: np.ndarray, first: np.ndarray):
        self.ids, self.first = ids, first
        number = np.arange(lanes)
        self.base_1, self.base_2, self.base_c = (number << n for n in (HASH_1, HASH_2, 5))
        self.last_1, self.last_2 = _zeros(lanes << HASH_1), _zeros(lanes << HASH_2)
        self.base_h, self.base_l = number * high, number * (PARTS << 8)
        self.place_h, self.place_l = number << HIGH_BITS, number * (PARTS << LOW_BITS)
        self.counts = Counts(lanes, high)
        self.previous = np.zeros(lanes, np.uint32)
        self.before = np.zeros(lanes, np.uint32)
        self.outcomes = np.empty((BLOCK_IDS, lanes), np.uint8)
        self.begun = 0
        self.refresh(0, lanes)

    def refresh(self, t: int, n: int) -> None:
        """The tables of the first ``n`` blocks, with what was seen since the last time."""
        since = np.arange(self.begun, t)
        for a in range(0, n if t else 0, MODELLED):
            b = min(a + MODELLED, n)
            self.counts.add(a, b, self.ids.take(self.first[a:b, None] + since), self.outcomes[self.begun : t, a:b].T)
        self.begun = t
        self.range_h, self.back_h, self.range_l, self.back_l, self.edges = self.counts.tables(n, True, not t)

    def predict(self, n: int) -> None:
        """What orders 2 and 1 foretell, and the ends of their shares of 256."""
        mixed = self.previous[:n] * np.uint32(2654435761)
        self.at_1 = self.base_1[:n] + (mixed >> np.uint32(32 - HASH_1))
        mixed += self.before[:n] * np.uint32(2246822519)
        mixed >>= np.uint32(32 - HASH_2)
        self.at_2 = self.base_2[:n] + mixed
        entry_1, entry_2 = self.last_1.take(self.at_1), self.last_2.take(self.at_2)
        self.guess_1, self.guess_2 = entry_1 & (TOP_ID - 1), entry_2 & (TOP_ID - 1)
        self.sure_1, self.sure_2 = entry_1 >> 18, entry_2 >> 18
        self.context = (self.sure_2 << 3) + (self.sure_1 << 1)
        self.context += self.guess_1 == self.guess_2
        edges = self.edges.take(self.base_c[:n] + self.context)
        self.edge_2, self.edge_1 = edges & 255, edges >> 8

    def learn(self, t: int, n: int, ids: np.ndarray, hit_2: np.ndarray, hit_1: np.ndarray) -> None:
        """A prediction that held gains confidence, else the id takes its place; the rest is counted at the next refresh."""
        for table, at, sure, guess in ((self.last_1, self.at_1, self.sure_1, self.guess_1), (self.last_2, self.at_2, self.sure_2, self.guess_2)):
            sure += 1
            np.minimum(sure, 3, out=sure)
            sure *= guess == ids
            sure <<= 18
            sure += ids
            table[at] = sure
        outcome = self.outcomes[t, :n]
        outcome[:] = self.context
        outcome *= 3
        outcome += 2
        outcome -= hit_1
        outcome -= hit_2
        self.before[:n] = self.previous[:n]
        self.previous[:n] = ids


def low_place(ids: np.ndarray) -> np.ndarray:
    """The place of an id's low part in a block's order-0 tables."""
    return (part(ids >> 8) << 8) + (ids & 255)


def part(high: np.ndarray) -> np.ndarray:
    """Which of the order-0 tables of low parts goes with a high part."""
    return np.minimum(high >> 1, PARTS - 1)


def _order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks by falling length, and how many of them are longer than t, for each step t."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
    return order, active


def encode(ids: np.ndarray, lengths: np.ndarray, high: int) -> list[bytes]:
    """The code words of consecutive blocks of ``ids``; all ids have a high part below ``high``."""
    out: list[bytes] = []
    first = np.concatenate([[0], np.cumsum(lengths)])
    for a in range(0, len(lengths), LANES):
        out += _encode(ids, first[a : a + LANES], lengths[a : a + LANES], high)
    return out


def _foretold(ids: np.ndarray, mixed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a row of ids of each block: the id that last followed an equal hash, the confidence, and whether it held.

    In the order of block, hash and time, an id's neighbour is the one that last followed the same hash.
    """
    lanes, steps = ids.shape
    order = (np.arange(lanes, dtype=np.uint32) << np.uint32(bits))[:, None] + (mixed >> np.uint32(32 - bits))
    order <<= np.uint32(TIME_BITS)
    order += np.arange(steps, dtype=np.uint32)
    order = np.sort(order, axis=None)
    group = order >> np.uint32(TIME_BITS)
    at = (group >> np.uint32(bits)).astype(np.int64) * steps
    at += order & np.uint32((1 << TIME_BITS) - 1)
    now = ids.take(at)
    same = group[1:] == group[:-1]
    guess = np.zeros_like(now)
    guess[1:] = now[:-1] * same
    held = guess == now
    sure = np.zeros((4, len(now)), bool)
    sure[1, 1:] = same & held[:-1]
    sure[2, 1:] = sure[1, 1:] & sure[1, :-1]
    sure[3, 1:] = sure[1, 1:] & sure[2, :-1]
    out = np.empty_like(now)
    out[at] = guess + (sure.sum(axis=0, dtype=np.int32) << 18) + (held.astype(np.int32) << 20)
    out = out.reshape(lanes, steps)
    return out & (TOP_ID - 1), out >> 18 & 3, out >> 20 == 1


def _modelled(ids: np.ndarray, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the share of every id begins in the whole of ``ALL_BITS``, and its size, for a row of ids of each block."""
    lanes, steps = ids.shape
    before = np.zeros((lanes, steps + 2), np.uint32)
    before[:, 2:] = ids
    mixed = before[:, 1:-1] * np.uint32(2654435761)
    guess_1, sure_1, hit_1 = _foretold(ids, mixed, HASH_1)
    mixed += before[:, :-2] * np.uint32(2246822519)
    guess_2, sure_2, hit_2 = _foretold(ids, mixed, HASH_2)
    hit_1 |= hit_2
    context = (sure_2 << 3) + (sure_1 << 1) + (guess_1 == guess_2)
    outcome = context * 3 + 2 - hit_1 - hit_2
    top, low = ids >> 8, low_place(ids)
    number = np.arange(lanes)[:, None]
    counts = Counts(lanes, high)
    begin, size = np.empty((lanes, steps), np.uint32), np.empty((lanes, steps), np.uint32)
    for t, end in zip((0, *REFRESHED), (*REFRESHED, steps), strict=True):
        if t >= steps:
            break
        now = np.s_[:, t:end]
        range_h, _, range_l, _, edges = counts.tables(lanes, False, not t)
        range_h, range_l = range_h.take(top[now] + number * high), range_l.take(low[now] + number * (PARTS << 8))
        edges = edges.take(context[now] + (number << 5))
        freq, left = range_h & FREQ, 256 - (edges >> 8)
        edge_1, edge_2 = edges >> 8 << (HIGH_BITS + LOW_BITS), (edges & 255) << (HIGH_BITS + LOW_BITS)
        literal = edge_1 + left * ((range_h >> PLACE_BITS << LOW_BITS) + freq * (range_l >> PLACE_BITS))
        begin[now] = np.where(hit_2[now], 0, np.where(hit_1[now], edge_2, literal))
        size[now] = np.where(hit_2[now], edge_2, np.where(hit_1[now], edge_1 - edge_2, left * (freq * (range_l & FREQ))))
        if end < steps:
            counts.add(0, lanes, ids[now], outcome[now])
    return begin, size


def _encode(ids: np.ndarray, first: np.ndarray, lengths: np.ndarray, high: int) -> list[bytes]:
    order, active = _order(lengths)
    first, lengths, lanes = first[order], lengths[order], len(order)
    begins, sizes = (np.empty((len(active), lanes), np.uint32) for _ in range(2))
    for a in range(0, lanes, MODELLED):
        steps = int(lengths[a])
        if not steps:
            break
        # Behind the end of a shorter block stands anything; nothing of it is coded.
        begin, size = _modelled(ids.take(first[a : a + MODELLED, None] + np.arange(steps), mode="clip"), high)
        begins[:steps, a : a + MODELLED], sizes[:steps, a : a + MODELLED] = begin.T, size.T
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, FULL)
    words, used = np.empty(max(1024, int(lengths.sum())), np.uint64), 0
    owner, last = np.empty(len(words), np.int32), np.full(lanes, -1)

    for t, n in enumerate(active.tolist()):
        unit = span[:n] >> np.uint64(ALL_BITS)
        add = unit * begins[t, :n]
        low[:n] += add
        over = np.flatnonzero(low[:n] < add)
        words[last[over]] += np.uint64(1)
        unit *= sizes[t, :n]
        span[:n] = unit
        full = np.flatnonzero(unit <= MASK)
        if used + len(full) > len(words):
            words, owner = (np.concatenate([x, np.empty(len(x), x.dtype)]) for x in (words, owner))
        now_low = low.take(full)
        words[used : used + len(full)] = now_low >> WORD
        owner[used : used + len(full)] = full
        last[full] = np.arange(used, used + len(full))
        used += len(full)
        low[full] = now_low << WORD
        span[full] <<= WORD
    own = owner[:used]
    by = np.argsort(own.astype(np.uint16), kind="stable")  # numbers this short are sorted in linear time
    each = np.bincount(own, minlength=lanes)
    ends = np.cumsum(each + 2)
    flat = np.empty(used + 2 * lanes, np.uint64)
    at = np.arange(used) + 2 * own[by]
    flat[at] = words[:used][by]
    flat[ends - 2], flat[ends - 1] = low >> WORD, low & MASK
    over = np.flatnonzero(flat > MASK)
    while len(over):  # carries go up a block's words
        flat[over] &= MASK
        flat[over - 1] += np.uint64(1)
        over = (over - 1)[flat[over - 1] > MASK]
    data = flat.astype("<u4").tobytes()
    cut = [data[4 * (e - n - 2) : 4 * e] for e, n in zip(ends.tolist(), each.tolist(), strict=True)]
    found = [b""] * lanes
    for i, x in zip(order.tolist(), cut, strict=True):
        found[i] = x
    return found


def decode(words: list[bytes], lengths: np.ndarray, high: int) -> np.ndarray:
    """The ids of all blocks, in a row."""
    first = np.concatenate([[0], np.cumsum(lengths)])
    ids = np.empty(int(first[-1]), np.int32)
    for a in range(0, len(lengths), LANES):
        _decode(words[a : a + LANES], first[a : a + LANES], lengths[a : a + LANES], high, ids)
    return ids


def _decode(code: list[bytes], first: np.ndarray, lengths: np.ndarray, high: int, ids: np.ndarray) -> None:
    order, active = _order(lengths)
    lanes, first = len(order), first[order]
    sizes = np.array([len(c) // 4 for c in code], np.int64)
    words = np.frombuffer(b"".join(code) + bytes(8), "<u4").astype(np.uint64)
    at = (np.cumsum(sizes) - sizes)[order]
    model = Model(lanes, high, ids, first)
    value, span = (words[at] << WORD) | words[at + 1], np.full(lanes, FULL)
    at += 2
    for t, n in enumerate(active.tolist()):
        if t in REFRESHED:
            model.refresh(t, n)
        model.predict(n)
        unit = span[:n] >> np.uint64(ALL_BITS)
        place = (value[:n] // unit).astype(np.int32)
        edge_1, edge_2 = model.edge_1 << (HIGH_BITS + LOW_BITS), model.edge_2 << (HIGH_BITS + LOW_BITS)
        hit_2, hit_1 = place < edge_2, place < edge_1
        left = 256 - model.edge_1
        # Quotients of such small numbers, in doubles, are exact when cut.
        place -= edge_1
        inner = (np.maximum(place, 0, out=place) / left).astype(np.int32)
        np.minimum(inner, (1 << HIGH_BITS + LOW_BITS) - 1, out=inner)
        top = model.back_h.take(model.place_h[:n] + (inner >> LOW_BITS)).astype(np.int32)
        range_h = model.range_h.take(model.base_h[:n] + top)
        freq, start = range_h & FREQ, range_h >> PLACE_BITS << LOW_BITS
        table = part(top)
        inner -= start
        low = model.back_l.take(model.place_l[:n] + ((table << LOW_BITS) + (inner / freq).astype(np.int32)))
        range_l = model.range_l.take(model.base_l[:n] + ((table << 8) + low))
        start += freq * (range_l >> PLACE_BITS)
        start *= left
        start += edge_1
        freq *= range_l & FREQ
        freq *= left
        top <<= 8
        top += low
        for literal, told_1, told_2 in ((start, edge_2, 0), (freq, edge_1 - edge_2, edge_2), (top, model.guess_1, model.guess_2)):
            np.putmask(literal, hit_1, told_1)
            np.putmask(literal, hit_2, told_2)
        now = top
        value[:n] -= unit * start.view(np.uint32)
        unit *= freq.view(np.uint32)
        span[:n] = unit
        full = np.flatnonzero(unit <= MASK)
        where = at.take(full)
        value[full] = (value.take(full) << WORD) | words.take(where, mode="clip")
        span[full] <<= WORD
        at[full] = where + 1
        ids[first[:n] + t] = now
        model.learn(t, n, now, hit_2, hit_1)


def block_lengths(n: int) -> np.ndarray:
    """The blocks of ``n`` consecutive ids: whole ones and the rest."""
    whole, rest = divmod(n, BLOCK_IDS)
    return np.array([BLOCK_IDS] * whole + [rest] * (rest > 0), np.int64)


def checksums(ids: np.ndarray, lengths: np.ndarray) -> list[int]:
    """The CRC-32 of each block's ids as little-endian 32-bit numbers."""
    data = memoryview(ids.astype("<u4").tobytes())
    ends = 4 * np.cumsum(lengths)
    return [zlib.crc32(data[a:b]) for a, b in zip((ends - 4 * lengths).tolist(), ends.tolist(), strict=True)]


def pack_frames(rows: list[np.ndarray], high: int) -> list[bytes]:
    """A self-contained binary frame for each array of ids: head, directory of blocks, code words."""
    lengths = [block_lengths(len(r)) for r in rows]
    every = np.concatenate([*lengths, np.empty(0, np.int64)])
    ids = np.concatenate([*rows, np.empty(0, np.int32)])
    words, sums = iter(encode(ids, every, high)), iter(checksums(ids, every))
    out = []
    for own in lengths:
        code = [next(words) for _ in own]
        entries = [ENTRY.pack(n, len(c) // 4, next(sums)) for n, c in zip(own.tolist(), code, strict=True)]
        out.append(b"".join([HEAD.pack(MAGIC, VERSION, high, len(own)), *entries, *code]))
    return out


def unpack_frames(frames: list[bytes]) -> list[np.ndarray]:
    """The ids of each frame; ``ValueError`` where a frame is not whole or a block's checksum differs."""
    lengths, words, sums, blocks, highs = [], [], [], [], set()
    for f in frames:
        if len(f) < HEAD.size:
            raise ValueError("a frame is cut off")
        magic, version, high, n = HEAD.unpack_from(f)
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError("not a frame of token ids")
        highs.add(high)
        blocks.append(n)
        at = HEAD.size + n * ENTRY.size
        if len(f) < at:
            raise ValueError("a frame is cut off")
        for i in range(n):
            ids, size, crc = ENTRY.unpack_from(f, HEAD.size + i * ENTRY.size)
            if ids > BLOCK_IDS or size < 2 or at + 4 * size > len(f):
                raise ValueError("a frame's directory is damaged")
            lengths.append(ids)
            words.append(f[at : at + 4 * size])
            sums.append(crc)
            at += 4 * size
    if len(highs) > 1 or any(not 0 < h <= TOP_ID >> 8 for h in highs):
        raise ValueError("frames of several vocabularies, or of none")
    every = np.array(lengths, np.int64)
    ids = decode(words, every, highs.pop() if highs else 1)
    if checksums(ids, every) != sums:
        raise ValueError("a block's checksum differs")
    ends = np.concatenate([[0], np.cumsum(every)])[np.cumsum(blocks)] if blocks else []
    return np.split(ids, ends[:-1]) if blocks else []
