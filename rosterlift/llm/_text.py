"""Word and shingle hashes of whole Arrow batches of texts, without a Python step per word.

Words are ``[^\\x20\\x09-\\x0D]+``; their hashes are 64 bits, so equality of words, shingles and lines is equality of
hashes up to collisions of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts are worked through in pieces of about this size; one text is never cut

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@dataclass
class Texts:
    """The UTF-8 bytes of several texts in a row: text i is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of an Arrow column in pieces; null counts as empty. Each piece's bytes start at offset 0."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + chunk_bytes, "right")) - 1)
        yield Texts(i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


@dataclass
class Words:
    """Words of several texts: text i has words ``first[i]:first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    edge = np.zeros(n + 1, bool)  # a text begins here, so no word goes on
    edge[offsets] = True
    inside = ~_SPACE[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes at a time."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = end - start
    h = mix(length.astype(np.uint64) * _ODD[0])
    left, at, todo = length.copy(), start.copy(), None
    while True:
        part = eights[at] & _MASKS[np.minimum(left, 8)]
        if todo is None:
            h = mix((h ^ part) * _ODD[1])
        else:
            h[todo] = mix((h[todo] ^ part) * _ODD[1])
        more = left > 8
        if not more.any():
            return h
        todo = np.flatnonzero(more) if todo is None else todo[more]
        left, at = left[more] - 8, at[more] + 8


def shingle_hashes(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles, in order, and where each text's begin.

    A text of 1 to ``size - 1`` words has one shingle, its whole sequence; a text without words has none.
    """
    n, count = len(h), np.diff(first)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total[:n - k] += mix(h[k:] + _ODD[k % 8] * U(k // 8 + 1)) if k < n else U(0)
    short = np.flatnonzero((count > 0) & (count < size))
    shingles = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(shingles)])
    at = np.repeat(first[:-1] - begin[:-1], shingles) + np.arange(begin[-1])
    out = mix(total[at] + U(size)) if len(at) else np.zeros(0, np.uint64)
    for i in short:  # the sum above ran on into the next text
        part = [mix(h[first[i] + k:first[i] + k + 1] + _ODD[k % 8] * U(k // 8 + 1))[0] for k in range(count[i])]
        out[begin[i]] = mix(np.array([np.add.reduce(np.array(part, np.uint64)) + U(1000 + count[i])], np.uint64))[0]
    return out, begin
