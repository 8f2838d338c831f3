"""Words of Arrow text columns as numpy arrays: positions, 64-bit hashes, and hashes of word windows.

Text is taken in blocks of whole rows of about ``BLOCK_BYTES``, so the memory of a task does
not depend on the size of a batch; a single longer text is a block of its own. Everything
works on the UTF-8 bytes of the Arrow buffer, with no Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

#: Bytes that separate words: blank and the controls from tab to carriage return.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASE = 0xD1342543DE82EF95 | 1


class Block(NamedTuple):
    """Some whole rows of a text column: row ``first + i`` has bytes ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Words of a block in order: byte spans, and the block's row of each."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # index of each row's first word, and at the end the number of words


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self._base = (base, pow(base, -1, 1 << 64))
        self._made = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._made[0]) < n:
            size = max(n, 2 * len(self._made[0]), 1 << 16)
            for i, base in enumerate(self._base):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                self._made[i] = np.multiply.accumulate(powers)
        return self._made[0][:n], self._made[1][:n]


_BYTE_POWERS = Powers(_BASE)
_WORD_POWERS = Powers(_WINDOW_BASE)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks of whole rows; a null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, len(texts))
        yield Block(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def split_words(block: Block, separators: np.ndarray = SPACES) -> Words:
    """Maximal runs of other bytes than ``separators``, within each row."""
    data, offsets = block.data, block.offsets
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, row, first)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_words(block: Block, words: Words, table: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word's bytes, after a byte table such as :data:`LOWER`."""
    if not len(words.start):
        return np.zeros(0, np.uint64)
    data = block.data if table is None else table[block.data]
    power, inverse = _BYTE_POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    value = (total[words.end] - total[words.start]) * inverse[words.start]
    return mix(value + (words.end - words.start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def window_hashes(hashes: np.ndarray, words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of each word that starts a window of ``width`` words of its row, and the window's hash."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    power, inverse = _WORD_POWERS.upto(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * power[:-1], out=total[1:])
    at = np.flatnonzero(words.row[: n - width + 1] == words.row[width - 1 :])
    return at, mix((total[at + width] - total[at]) * inverse[at])
