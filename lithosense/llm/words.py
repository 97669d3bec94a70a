"""Words and word shingles of whole batches of texts as 64-bit hashes, in numpy.

Words are runs of bytes other than space and the controls 9-13, after A-Z are lowered.
A word's hash is a polynomial in its bytes, read off running sums over the batch, so no
Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19  # the work arrays take some 50 times as much

_rng = np.random.default_rng(20_240_101)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, CHUNK_BYTES + 65_536)
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _BASE, np.uint64)]))
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _BASE_INVERSE, np.uint64)]))


_powers = _Powers()


@dataclass
class Words:
    """Words of consecutive texts: hashes, where each text's words begin, byte places in ``data``."""

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string column of about ``most`` bytes (a longer text alone), with their first row."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield row, column.slice(row, stop - row)
        row = stop


def words(column: pa.Array, lower: bool = True) -> Words:
    """All words of a large-string column without nulls (as ``chunks`` gives)."""
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    n = len(data)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(n + 2, bool)
    np.logical_not(_SPACE[data], out=inside[1:-1])
    fresh = np.zeros(n + 1, bool)
    fresh[at[:-1]] = True
    starts = np.flatnonzero(inside[1:] & (fresh | ~inside[:-1]))
    ends = np.flatnonzero(inside[:-1] & (fresh | ~inside[1:]))
    _powers.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers.up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers.down[starts])
    return Words(hashes, np.searchsorted(starts, at), starts, ends, data)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words (of the whole sequence, if it is shorter but not empty)."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    out = np.full(n, np.uint64(width), np.uint64)
    for k in range(width):
        out = out * _BASE + hashes[k : k + n]
    return mix(out, 1)


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = words(column)
    return [np.unique(windows(w.hashes[a:b], width)) for a, b in zip(w.first[:-1], w.first[1:])]
