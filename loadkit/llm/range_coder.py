"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks of equal length that are coded side by side: every step
codes one id of each block, as numpy vectors over blocks. Each block has its
own model, coder and checksum, reset at its begin, so that it can be read without any other.

Model of a block. Order 2 and order 1 each predict the id that last followed
the same two ids, or the same id, with a count of how often running that was
right. Order 0 numbers the block's ids by their first occurrence, so a frequent
id has a small rank. A symbol says: order 2 is right, order 1 is right, the width of the
rank, or, for an id that is new in the block, the width of the id; the lower
bits of rank or id follow. The distribution of symbols mixes what was counted
under the predictions' present counts with what was counted in the whole block,
each weighing as much as it has seen. It adapts every `CHUNK` ids.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SYMBOLS = 32
ORDER2, ORDER1, RANK, NEW = 0, 1, 2, 15  # RANK + w: a rank of w bits (0 to 12); NEW + w: an id of w bits (1 to 16)
SLOTS, CONTEXTS, CHUNK = 1 << 10, 16, 128
TOTAL, LEAST = 1 << 15, 16
MOST_BLOCKS, LONGEST = 2048, 4096
#: Blocks whose predictions are sorted at once, so that the sorts stay small.
TOGETHER = 128
MAGIC = b"TKR1"
U64, WORD, TOP, SHIFT = np.uint64, np.uint64(16), np.uint64(48), np.uint64(15)
LOW, ONE = np.uint64((1 << 48) - 1), np.uint64(1)
_WIDTH = np.array([int(i).bit_length() for i in range(1 << 16)], np.int32)
#: Plain bits after a symbol, and what they are added to.
_PLAIN = np.array([0, 0, *[max(w - 1, 0) for w in range(13)], 0, *[w - 1 if w > 1 else 1 for w in range(1, 17)]], np.uint64)
_BASE = np.array([0, 0, *[(1 << w) >> 1 for w in range(13)], 0, *[(1 << w) >> 1 if w > 1 else 0 for w in range(1, 17)]], np.int32)
_PRIOR = np.array([2, 2, *[2] * 13, 0, *[1 if w < 8 else 2 for w in range(1, 17)]], np.int64)


class Coder:
    """Range coders of many blocks: 64 bits of `low` and `span`; words of 16 bits come out or go in."""

    def __init__(self, blocks: int, steps: int = 0, words: np.ndarray | None = None, begin: np.ndarray | None = None):
        self.low, self.span = np.zeros(blocks, U64), np.full(blocks, 2 ** 64 - 1, U64)
        self.words = words
        if words is None:
            self.room = 4 + 3 * steps
            self.out, self.at = np.zeros(blocks * self.room, np.uint16), np.arange(blocks) * self.room
        else:
            self.at, self.code = begin.copy(), np.zeros(blocks, U64)
            every = np.arange(blocks)
            for _ in range(4):
                self.code = (self.code << WORD) | self._next(every)

    def _next(self, some: np.ndarray) -> np.ndarray:
        at = self.at[some]
        self.at[some] = at + 1
        return self.words[np.minimum(at, len(self.words) - 1)].astype(U64)

    def renew(self) -> None:
        """Shift out the words that are settled until every span has more than 48 bits.

        A span that is short and crosses a word's border is cut at the border.
        """
        some = np.flatnonzero(self.span <= LOW)
        while len(some):
            low, span = self.low[some], self.span[some]
            edge = LOW - (low & LOW)
            span = np.minimum(span, edge + ONE)
            if self.words is None:
                self.out[self.at[some]] = low >> TOP
                self.at[some] += 1
            else:
                self.code[some] = (self.code[some] << WORD) | self._next(some)
            span <<= WORD
            self.low[some], self.span[some] = low << WORD, span
            some = some[span <= LOW]

    def finish(self) -> list[bytes]:
        blocks = len(self.low)
        for _ in range(4):
            self.out[self.at] = self.low >> TOP
            self.at += 1
            self.low <<= WORD
        return [self.out[b * self.room:self.at[b]].astype("<u2").tobytes() for b in range(blocks)]


class Predictor:
    """The ids that last followed two ids and one id, each with a count from 0 to 3."""

    def __init__(self, blocks: int):
        self.base = np.arange(blocks, dtype=np.int32) * SLOTS
        self.two, self.one = np.zeros(blocks * SLOTS, np.int32), np.zeros(blocks * SLOTS, np.int32)
        self.last, self.last2 = np.zeros(blocks, np.int32), np.zeros(blocks, np.int32)

    @staticmethod
    def slots(last2: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots of two ids and of one; 32 and 64 bits give the same."""
        return ((last2 * 40503 + last * 10007) >> 3) & (SLOTS - 1), (last * 40503 >> 4) & (SLOTS - 1)

    def guess(self) -> np.ndarray:
        """Sets id2 and id1 (-1 where nothing is known) and returns the context number."""
        self.at2, self.at1 = (self.base + slot for slot in self.slots(self.last2, self.last))
        self.e2, self.e1 = self.two[self.at2], self.one[self.at1]
        self.id2, self.id1 = (self.e2 & 0x1FFFF) - 1, (self.e1 & 0x1FFFF) - 1
        return (self.e2 >> 17) * 4 + (self.e1 >> 17)

    def learn(self, now: np.ndarray, right2: np.ndarray, right1: np.ndarray) -> None:
        count2 = np.minimum((self.e2 >> 17) * right2 + 1, 3)
        count1 = np.minimum((self.e1 >> 17) * right1 + 1, 3)
        self.two[self.at2] = (now + 1) | (count2 << 17)
        self.one[self.at1] = (now + 1) | (count1 << 17)
        self.last2, self.last = self.last, now


class Distributions:
    """Counts of symbols per block and context, and the mixed distributions made of them."""

    def __init__(self, blocks: int):
        self.counts = np.zeros((blocks, CONTEXTS, SYMBOLS), np.int32)
        self.base = np.arange(blocks, dtype=np.int32) * CONTEXTS
        self.adapt()

    def adapt(self) -> None:
        """Cumulative distributions, all 32 lower ends per context; every symbol has a least share."""
        whole = self.counts.sum(axis=1, keepdims=True) + _PRIOR.astype(np.int32)
        # An id counted under the context weighs 2, those of the whole block come to 16 in all.
        mixed = self.counts * 2.0 + whole * (16.0 / whole.sum(axis=2, keepdims=True)) + 1 / 32
        parts = (mixed * ((TOTAL - SYMBOLS * LEAST) / mixed.sum(axis=2, keepdims=True))).astype(np.int32) + LEAST
        ends = np.cumsum(parts, axis=2, dtype=np.int32)
        lower = np.zeros_like(ends)
        lower[:, :, 1:] = ends[:, :, :-1]
        self.lower = np.ascontiguousarray(lower.reshape(-1, SYMBOLS), np.int32)
        self.flat = self.lower.reshape(-1)
        parts[:, :, -1] = TOTAL - lower[:, :, -1]
        self.sizes = parts.reshape(-1)

    def count(self, context: np.ndarray, symbol: np.ndarray) -> None:
        """Add the symbols of a chunk (steps x blocks)."""
        at = (self.base * SYMBOLS + context * SYMBOLS + symbol).reshape(-1)
        self.counts += np.bincount(at, minlength=self.counts.size).reshape(self.counts.shape).astype(np.int32)

    def part(self, context: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (self.base + context) * SYMBOLS + symbol
        return self.flat[at], self.sizes[at]


def _first_ranks(rows: np.ndarray) -> np.ndarray:
    """For each id of each block (blocks x steps) its number by first occurrence in the block, -1 where it occurs first."""
    blocks, steps = rows.shape
    order = np.argsort(rows.astype(np.uint16), axis=1, kind="stable")
    ordered = np.take_along_axis(rows, order, axis=1)
    fresh = np.ones((blocks, steps), bool)
    fresh[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    is_first = np.zeros((blocks, steps), bool)
    np.put_along_axis(is_first, order, fresh, axis=1)
    number = np.cumsum(is_first, axis=1, dtype=np.int32) - 1
    at = np.maximum.accumulate(np.where(fresh, np.arange(steps, dtype=np.int32), 0), axis=1)
    first_at = np.take_along_axis(order, at, axis=1)
    rank = np.empty((blocks, steps), np.int32)
    np.put_along_axis(rank, order, np.take_along_axis(number, first_at, axis=1), axis=1)
    rank[is_first] = -1
    return rank


def _followed(rows: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a table of `Predictor` says at each step of each block, from one sort by slot: its count, and whether its id is right."""
    order = np.argsort(slot, axis=1, kind="stable")
    ordered, now = np.take_along_axis(slot, order, axis=1), np.take_along_axis(rows, order, axis=1)
    known, right = np.zeros(rows.shape, bool), np.zeros(rows.shape, bool)
    known[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
    right[:, 1:] = known[:, 1:] & (now[:, 1:] == now[:, :-1])
    # An id leaves a count of one, and one more for each time, up to two, that it was right just before.
    left = right.astype(np.uint8) + 1
    left[:, 1:] += right[:, 1:] & right[:, :-1]
    count = np.zeros(rows.shape, np.uint8)
    count[:, 1:] = left[:, :-1] * known[:, 1:]
    counts, rights = np.empty_like(count), np.empty_like(right)
    np.put_along_axis(counts, order, count, axis=1)
    np.put_along_axis(rights, order, right, axis=1)
    return counts, rights


def _modelled(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank, context and symbol of each id (blocks x steps)."""
    rank = _first_ranks(rows)
    last, last2 = np.zeros(rows.shape, np.int64), np.zeros(rows.shape, np.int64)
    last[:, 1:], last2[:, 2:] = rows[:, :-1], rows[:, :-2]
    slot2, slot1 = Predictor.slots(last2, last)
    count2, right2 = _followed(rows, slot2.astype(np.uint16))
    count1, right1 = _followed(rows, slot1.astype(np.uint16))
    by_rank = np.where(rank < 0, NEW + np.maximum(_WIDTH[rows], 1), RANK + _WIDTH[rank])
    return rank, count2 * 4 + count1, np.where(right2, ORDER2, np.where(right1, ORDER1, by_rank))


def _encode_rows(rows: np.ndarray) -> list[bytes]:
    """The codes of blocks of ids (blocks x steps)."""
    blocks, steps = rows.shape
    ids, rank = np.ascontiguousarray(rows.T), np.empty((steps, blocks), np.int32)
    contexts, symbols = np.empty((steps, blocks), np.uint8), np.empty((steps, blocks), np.uint8)
    for at in range(0, blocks, TOGETHER):
        some = slice(at, at + TOGETHER)
        rank[:, some], contexts[:, some], symbols[:, some] = (x.T for x in _modelled(rows[some]))
    made, coder = Distributions(blocks), Coder(blocks, steps)
    for at in range(0, steps, CHUNK):
        some = slice(at, min(at + CHUNK, steps))
        context, symbol = contexts[some].astype(np.int32), symbols[some].astype(np.int32)
        plain = _PLAIN[symbol]
        value = np.where(symbol > NEW, ids[some], np.maximum(rank[some], 0)) - _BASE[symbol]
        value = np.where(symbol < RANK, 0, value).astype(U64)
        begin, size = (x.astype(U64) for x in made.part(context, symbol))
        for k in range(len(begin)):
            unit = coder.span >> SHIFT
            small = (unit * size[k]) >> plain[k]
            coder.low += unit * begin[k] + small * value[k]
            coder.span = small
            coder.renew()
        made.count(context, symbol)
        made.adapt()
    return coder.finish()


def _decode_rows(words: np.ndarray, begin: np.ndarray, steps: int) -> np.ndarray:
    """The ids (blocks x steps) whose codes begin at the given words."""
    blocks = len(begin)
    coder, made, predictor = Coder(blocks, words=words, begin=begin), Distributions(blocks), Predictor(blocks)
    out = np.empty((steps, blocks), np.int32)
    listed, used, base = np.zeros(blocks * (steps + 1), np.int32), np.zeros(blocks, np.int64), np.arange(blocks) * (steps + 1)
    contexts, symbols = np.empty((CHUNK, blocks), np.int32), np.empty((CHUNK, blocks), np.int32)
    ones = U64(0x0101010101010101)
    for step in range(steps):
        context = predictor.guess()
        unit = coder.span >> SHIFT
        offset = coder.code - coder.low
        value = np.minimum(offset // unit, U64(TOTAL - 1)).astype(np.int32)
        lower = made.lower.take(made.base + context, axis=0)
        under = (lower <= value[:, None]).view(U64).reshape(blocks, 4)
        symbol = ((((under[:, 0] + under[:, 1] + under[:, 2] + under[:, 3]) * ones) >> U64(56)) - ONE).astype(np.int32)
        first, size = made.part(context, symbol)
        skipped = unit * first.astype(U64)
        plain = _PLAIN[symbol]
        small = (unit * size.astype(U64)) >> plain
        bits = np.minimum((offset - skipped) // small, (ONE << plain) - ONE)
        coder.low += skipped + small * bits
        coder.span = small
        coder.renew()
        whole = bits.astype(np.int32) + _BASE[symbol]
        now = np.where(symbol > NEW, whole, listed[base + np.where(symbol > NEW, 0, np.minimum(whole, steps))])
        now = np.where(symbol == ORDER2, predictor.id2, np.where(symbol == ORDER1, predictor.id1, now))
        new = np.flatnonzero(symbol > NEW)
        listed[base[new] + used[new]] = now[new]
        used[new] += 1
        out[step] = now
        predictor.learn(now, predictor.id2 == now, predictor.id1 == now)
        k = step % CHUNK
        contexts[k], symbols[k] = context, symbol
        if k == CHUNK - 1 or step == steps - 1:
            made.count(contexts[:k + 1], symbols[:k + 1])
            made.adapt()
    return out.T


def block_length(ids: int) -> int:
    """Ids per block: 256 to 2048, so that short inputs too make many blocks."""
    return min(2048, max(256, 1 << max(0, (ids // 1024).bit_length() - 1)))


def encode(ids: np.ndarray, block: int | None = None) -> bytes:
    """All ids (below 65,536) as one string of blocks.

    Layout, little-endian: magic, number of ids (8), ids per block (4), number of
    blocks (4); for every block the bytes of its code (4) and the crc32 of its
    ids as 16-bit integers (4); then the codes. The last block is filled up with id 0.
    """
    block = block or block_length(len(ids))
    if not 0 < block <= LONGEST or len(ids) and not 0 <= int(np.min(ids)) <= int(np.max(ids)) < 1 << 16:
        raise ValueError("blocks have up to 4096 ids of 16 bits")
    blocks = -(-len(ids) // block)
    filled = np.zeros(blocks * block, np.int32)
    filled[:len(ids)] = ids
    rows, codes = filled.reshape(blocks, block), []
    for at in range(0, blocks, MOST_BLOCKS):
        codes += _encode_rows(rows[at:at + MOST_BLOCKS])
    index = b"".join(struct.pack("<II", len(c), zlib.crc32(r.astype("<u2").tobytes())) for c, r in zip(codes, rows))
    return MAGIC + struct.pack("<QII", len(ids), block, blocks) + index + b"".join(codes)


def decode(data: bytes) -> np.ndarray:
    """The ids of an encoded string; a damaged block raises an error."""
    if data[:4] != MAGIC:
        raise ValueError("not coded token ids")
    total, block, blocks = struct.unpack_from("<QII", data, 4)
    index = np.frombuffer(data, "<u4", 2 * blocks, 20).reshape(blocks, 2).astype(np.int64)
    words = np.frombuffer(data, "<u2", offset=20 + 8 * blocks)
    begin = np.concatenate([[0], np.cumsum(index[:, 0] // 2)])
    if begin[-1] != len(words):
        raise ValueError("the coded token ids are cut short")
    parts = []
    for at in range(0, blocks, MOST_BLOCKS):
        rows = np.ascontiguousarray(_decode_rows(words, begin[at:min(at + MOST_BLOCKS, blocks)], block), "<u2")
        for k, row in enumerate(rows):
            if zlib.crc32(row.tobytes()) != index[at + k, 1]:
                raise ValueError(f"the checksum of block {at + k} differs")
        parts.append(rows.reshape(-1))
    return np.concatenate(parts)[:total] if parts else np.zeros(0, "<u2")
