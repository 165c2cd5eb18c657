"""Words of a column of texts as numpy arrays: the shared small helper of the text operators.

A column is cut into chunks of whole texts.  Inside a chunk a word is a pair of byte
positions, so no Python object is made per word.  Words and runs of words are compared by
64-bit hashes; whoever needs certainty compares the bytes afterwards or takes two hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 1 << 20
_SPAN = 1 << 18
_LONG_WORD = 4096
#: Odd multipliers, one pair (bytes in a word, words in a run) per independent hash.
BASES = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))
_MASK = (1 << 64) - 1

SPACE_BYTES = np.ones(256, bool)
SPACE_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM_BYTES = np.zeros(256, bool)
ALNUM_BYTES[0x30:0x3A] = ALNUM_BYTES[0x61:0x7B] = ALNUM_BYTES[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=4)
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    n = _SPAN + 2 * _LONG_WORD
    tables = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n, b, np.uint64)
        steps[0] = 1
        tables.append(np.multiply.accumulate(steps))
    return tables[0], tables[1]


def plain(column: pa.Array) -> pa.Array:
    """The texts with 32-bit offsets from zero on, nulls as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    return column if column.type == pa.large_string() else column.cast(pa.large_string())


class Chunk:
    """Some whole texts: ``data`` bytes and the ``offsets`` of each text in them."""

    def __init__(self, first_row: int, data: np.ndarray, offsets: np.ndarray):
        self.first_row, self.data, self.offsets = first_row, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, lower: bool = False, table: np.ndarray = SPACE_BYTES) -> Words:
        data = LOWER[self.data] if lower else self.data
        return Words(data, self.offsets, table)


class Words:
    """Words of a chunk: byte ranges ``start``:``end``, and ``first[d]``, the first word of text d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = table[data]
        before, after = np.empty_like(inside), np.empty_like(inside)
        if len(data):
            before[1:], after[:-1] = inside[:-1], inside[1:]
            before[offsets[:-1][offsets[:-1] < len(data)]] = False
            after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        out = np.empty(len(self), np.uint64)
        up, down = _powers(BASES[which][0])
        a = 0
        while a < len(self):
            b = int(np.searchsorted(self.end, self.start[a] + _SPAN, side="right"))
            b = max(b, a + 1)
            start, end = self.start[a:b], self.end[a:b]
            if end[-1] - start[0] > _SPAN:  # a single word longer than that
                out[a] = 0
            else:
                base = start[0]
                sums = np.empty(end[-1] - base + 1, np.uint64)
                sums[0] = 0
                np.cumsum((self.data[base : end[-1]].astype(np.uint64) + np.uint64(1)) * up[: end[-1] - base], out=sums[1:])
                out[a:b] = (sums[end - base] - sums[start - base]) * down[start - base]
            a = b
        out = mix(out)
        for k in np.flatnonzero(self.end - self.start > _LONG_WORD):
            out[k] = xxhash.xxh64_intdigest(self.data[self.start[k] : self.end[k]].tobytes(), which)
        return out

    def runs(self, hashes: np.ndarray, length: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each run of ``length`` words that lies in one text."""
        starts = self.run_starts(length)
        return starts, run_hashes(hashes, length, which)[starts] if len(starts) else np.empty(0, np.uint64)

    def run_starts(self, length: int) -> np.ndarray:
        """First words of the runs of ``length`` words that lie in one text."""
        room = np.repeat(self.first[1:], self.counts) - np.arange(len(self))
        return np.flatnonzero(room >= length)


def run_hashes(hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` items, put together from runs of 1, 2, 4, ... items."""
    q = BASES[which][1]
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, done, piece, size = np.zeros(n, np.uint64), 0, hashes, 1
    while True:
        if length & size:
            total = total * np.uint64(pow(q, size, 1 << 64)) + piece[done : done + n]
            done += size
        if done == length:
            return mix(total)
        piece = piece[:-size] * np.uint64(pow(q, size, 1 << 64)) + piece[size:]
        size *= 2


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole texts, as many at a time as make about ``limit`` bytes; one longer text comes alone."""
    column = plain(column)
    if not len(column):
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.empty(0, np.uint8)
    a = 0
    while a < len(column):
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), len(column))
        yield Chunk(a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        a = b


def code_points_before(data: np.ndarray) -> np.ndarray:
    """For each byte position, the number of code points that begin before it; one entry more than bytes."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges sorted by start, with overlapping and touching ones put together."""
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(start) - 1]))
    return start[new], reach[last]
