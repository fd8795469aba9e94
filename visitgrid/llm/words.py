"""Words of many texts at once, on the UTF-8 bytes of an Arrow column.

A byte table says which bytes belong to words and lower-cases A-Z; every byte of a
character beyond ASCII belongs to a word.  Words get 64-bit hashes (one random factor per
place, summed and mixed), so later steps work on arrays instead of Python strings.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


@functools.cache
def plain_table() -> np.ndarray:
    """ASCII letters and digits and all bytes beyond ASCII; A-Z become a-z, other bytes 0."""
    out = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        out[low : high + 1] = np.arange(low, high + 1)
    out[0x41:0x5B] = out[0x61:0x7B]
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit integers (a fixed permutation)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def factors(count: int, seed: int) -> np.ndarray:
    """Random factors by place."""
    return mix((np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


@dataclass
class Words:
    raw: np.ndarray  # bytes of all texts
    data: np.ndarray  # the same through the table, 0 between words
    bounds: np.ndarray  # where each text starts, and the end of the last
    starts: np.ndarray  # of each word
    ends: np.ndarray
    doc: np.ndarray  # text of each word

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.bounds) - 1)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        sizes = self.ends - self.starts
        inside = self.data != 0
        place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        terms = self.data[inside].astype(np.uint64) * factors(int(sizes.max()), 1)[place]
        return mix(np.add.reduceat(terms, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))

    def text(self, first: int, count: int) -> bytes:
        """Words joined by a blank."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[first : first + count].tolist(), self.ends[first : first + count].tolist()))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column without gaps, and the bounds of its texts; null is empty."""
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    bounds = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def words_of(column: pa.Array, table: np.ndarray | None = None) -> Words:
    raw, bounds = column_bytes(column)
    data = (plain_table() if table is None else table)[raw]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = data != 0
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    before[bounds] = False  # a text never goes on with the word of the one before it
    starts = np.flatnonzero(inside & ~before)
    stop = ~inside
    stop[bounds] = True
    after = np.zeros(len(data) + 1, bool)
    after[1:] = inside[:-1]
    ends = np.flatnonzero(stop & after)
    doc = np.searchsorted(bounds, starts, side="right") - 1
    return Words(raw, data, bounds, starts, ends, doc)


def windows(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words of one text, and the place of its first word."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factor = factors(size, 2)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total += hashes[k : k + count] * factor[k]
    whole = np.flatnonzero(doc[:count] == doc[size - 1 :])
    return mix(total[whole]), whole
