"""Words and their hashes, straight from the bytes of an Arrow text column.

A word is a run of bytes other than space and the five controls 0x09 to 0x0D. Bytes of
longer UTF-8 signs are never among these, so words of bytes are words of signs. Null
texts have no bytes and so count as empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; a longer text is handled alone.
CHUNK_BYTES = 4 << 20
#: Words are cut and hashed in pieces of about this many bytes, also within one text.
PIECE_BYTES = 1 << 19

WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A"):ord("Z") + 1] = True

U64 = np.uint64
MASK64 = (1 << 64) - 1


def _table(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, MASK64, 256, np.uint64, endpoint=True)


class Hasher:
    """Polynomial hash of byte strings modulo 2**64 over random byte values, then mixed.

    fold: A-Z count as a-z. Equal words get equal hashes in every task and run.
    """

    def __init__(self, seed: int = 1, fold: bool = False):
        self.values = _table(seed)
        if fold:
            self.values[ord("A"):ord("Z") + 1] = self.values[ord("a"):ord("z") + 1]
        self.base = (0x9E3779B97F4A7C15 * (2 * seed + 1)) & MASK64 | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        return self.up, self.down

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self.powers(len(data))
        return _ranges(self.values[data], up, down, starts, ends)

    def of(self, word: bytes) -> int:
        data = np.frombuffer(word, np.uint8)
        return int(self.ranges(data, np.array([0]), np.array([len(data)]))[0])


class WindowHasher:
    """Hash of runs of words from the words' hashes."""

    def __init__(self, seed: int = 1):
        self.base = (0xC2B2AE3D27D4EB4F * (2 * seed + 1)) & MASK64 | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def sums(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums and the powers that take a range of them back to position 0."""
        n = len(hashes)
        if len(self.up) < n + 1:
            n = max(n + 1, 2 * len(self.up))
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        total = np.zeros(len(hashes) + 1, U64)
        np.cumsum(hashes * self.up[:len(hashes)], out=total[1:])
        return total, self.down

    def windows(self, hashes: np.ndarray, starts: np.ndarray, length) -> np.ndarray:
        total, down = self.sums(hashes)
        return mix((total[starts + length] - total[starts]) * down[starts])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.cumprod(out)


def _ranges(values, up, down, starts, ends) -> np.ndarray:
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Chunk:
    """Some rows of a batch with the bytes of their texts; offsets has one entry more than rows."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array within each text."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


@dataclass
class Words:
    """Words of a chunk: first byte, byte after the last, hash; those of text i are first[i] to first[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def window_starts(self, length: int) -> np.ndarray:
        """Positions where `length` words of one text follow one another."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))
        return np.flatnonzero(left >= length)


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, ends, data = column.buffers()
        offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
        offsets = offsets.astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        low, n = 0, batch.num_rows
        while low < n:
            high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
            high = min(max(high, low + 1), n)
            yield Chunk(batch.slice(low, high - low), data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
            low = high


def _pieces(white: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges which end before white space or with a text."""
    low, n = 0, len(white)
    while low < n:
        high = min(low + PIECE_BYTES, n)
        if high < n:
            after = int(offsets[np.searchsorted(offsets, high)])
            gap = white[high:after]
            high = high + int(gap.argmax()) if gap.any() else after
        yield low, high
        low = high


def words(chunk: Chunk, hasher: Hasher) -> Words:
    data, offsets = chunk.data, chunk.offsets
    inside = ~WHITE[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[heads], end[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    hashes = np.empty(len(starts), U64)
    for low, high in _pieces(~inside, offsets):
        a, b = np.searchsorted(starts, [low, high])
        hashes[a:b] = hasher.ranges(data[low:high], starts[a:b] - low, ends[a:b] - low)
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def appended(rows: pa.RecordBatch, new: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    """The rows with further columns."""
    arrays = [*rows.columns, *(v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v) for v in new.values())]
    return pa.RecordBatch.from_arrays(arrays, names=[*rows.schema.names, *new])
