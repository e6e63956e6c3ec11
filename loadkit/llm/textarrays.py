"""Words, lines and windows of a batch of texts as flat numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts together, and where each begins; a missing text is empty."""
    filled = pc.fill_null(column, "") if column.null_count else column
    filled = filled.cast(pa.large_string())
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset:filled.offset + len(filled) + 1] if len(filled) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, cut at the offsets."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = offsets[(offsets > 0) & (offsets < len(inside))]
    before = np.empty(len(inside), bool)
    before[0], before[1:] = False, inside[:-1]
    before[edges] = False
    after = np.empty(len(inside), bool)
    after[-1], after[:-1] = False, inside[1:]
    after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary array from bytes without gaps."""
    at = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])


def codes(values: pa.Array | np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Equal values get equal numbers from 0; and the distinct values."""
    coded = (values if isinstance(values, pa.Array) else pa.array(values)).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def as_list(values: pa.Array) -> list[bytes]:
    """Python's bytes of a binary array without missing values; several times faster than to_pylist()."""
    _, offsets, data = values.buffers()
    if not len(values):
        return []
    at = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1].tolist()
    raw = data.to_pybytes() if data is not None else b""
    return [raw[a:b] for a, b in zip(at, at[1:])]


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a batch of texts.

    `first[d]:first[d + 1]` are the words of text d.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.solid = ~SPACE[data]
        self.start, self.end = spans(self.solid, offsets)
        self.first = np.searchsorted(self.start, offsets)

    def array(self) -> pa.Array:
        return strings(self.data[self.solid], self.end - self.start)

    def per_text(self, marked: np.ndarray) -> np.ndarray:
        """Marked words of each text."""
        total = np.zeros(len(marked) + 1, np.int64)
        np.cumsum(marked, out=total[1:])
        return np.diff(total[self.first])


def per_text_bytes(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marked bytes of each text."""
    total = np.zeros(len(marked) + 1, np.int64)
    np.cumsum(marked, out=total[1:])
    return np.diff(total[offsets])


def windows(first: np.ndarray, size: int) -> np.ndarray:
    """Indices of the words at which a window of `size` words begins; no window crosses texts."""
    counts = np.diff(first)
    free = np.ones(int(first[-1]), bool)
    for back in range(1, size):
        free[first[1:][counts >= back] - back] = False
    return np.flatnonzero(free)


def window_codes(word_code: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """Equal windows get equal numbers; exact, one word is added at a time."""
    code = word_code[begin]
    base = int(word_code.max()) + 1 if len(word_code) else 1
    for k in range(1, size):
        code, _ = codes(code * base + word_code[begin + k])
    return code
