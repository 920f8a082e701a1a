"""Words of a batch of texts as 64-bit hashes, by numpy over the whole batch.

A word is a run of bytes other than space and tab to carriage return; A-Z count as a-z. Its hash is a polynomial of
its bytes, taken from one running sum over the batch and mixed. Texts that differ get different hashes but for a
chance of 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256, dtype=np.uint8)
_IS_SPACE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < size:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[:1] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls as empty, and where each text starts and ends."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        offsets = np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else _BYTES[:0]
    return data, offsets - offsets[0]


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and for each text the index of its first word (one more entry at the end)."""
    data, offsets = utf8(column)
    size = len(data)
    if size == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_IS_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < size)]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power_table(size)
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(_VALUES[_LOWER[data]] * up[:size], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` words; runs that cross into the next text are for the caller to leave out."""
    total = np.full(max(0, len(hashes) - width + 1), width, dtype=np.uint64)
    for i in range(width):
        total = mix(total ^ hashes[i : len(hashes) - width + 1 + i]) + np.uint64(i + 1)
    return total
