"""Texts in Arrow batches: byte views, slices of bounded size, words and shingles as 64-bit hashes.

Everything here works on the UTF-8 bytes of whole texts. Memory is bounded by the slice, or by one document
where a document is larger than the slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_PRIME = 0x9E3779B97F4A7C15 | 1


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the offsets of the texts in them. Null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` bytes of text, or one document."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for at, length in enumerate(lengths):
        if at > start and total + length > limit:
            yield batch.slice(start, at - start)
            start, total = at, 0
        total += length
    yield batch.slice(start)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << bits
    with np.errstate(over="ignore"):
        inverse = pow(_PRIME, -1, 1 << 64)
        up = np.full(size, _PRIME, np.uint64)
        down = np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class WordRule:
    """Which bytes belong to words; A-Z are lowered."""

    def __init__(self, inside: np.ndarray):
        self.inside = inside
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words in ``data``, and each document's first word. Words don't cross documents."""
        border = np.zeros(len(data) + 1, bool)
        border[offsets] = True
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = self.inside[data]
        start = np.flatnonzero(inside[1:-1] & (border[:-1] | ~inside[:-2]))
        end = np.flatnonzero(inside[1:-1] & (border[1:] | ~inside[2:])) + 1
        return start, end, np.searchsorted(start, offsets)

    def hashes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each word."""
        with np.errstate(over="ignore"):
            up, down = _powers(max(12, int(len(data)).bit_length()))
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((self.lower[data].astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
            return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def _whitespace_words() -> WordRule:
    inside = np.ones(256, bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    return WordRule(inside)


def _letter_words() -> WordRule:
    inside = np.zeros(256, bool)
    inside[0x30:0x3A] = inside[0x41:0x5B] = inside[0x61:0x7B] = inside[0x80:] = True
    return WordRule(inside)


#: words are runs of anything but white space
WHITESPACE_WORDS = _whitespace_words()
#: words are runs of letters, digits and all characters beyond ASCII
LETTER_WORDS = _letter_words()


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the distinct shingles of one document, sorted; fewer words than ``size`` make one shingle."""
    if not len(words):
        return words
    with np.errstate(over="ignore"):
        width = min(size, len(words))
        count = len(words) - width + 1
        out = np.full(count, width, np.uint64)
        for at in range(width):
            out = mix(out * np.uint64(_PRIME) + words[at:at + count])
    return np.unique(out)
