"""Words of whole Arrow batches at once: positions, 64-bit hashes, sequences.

The splitting rules only name ASCII separators, and every byte of a longer UTF-8 character is
above 0x7F, so words are found on bytes. A batch is cut into slices of about ``SLICE`` bytes
(one row at least), which bounds the memory of a task by its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_rng = np.random.default_rng(20240607)
_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Separators of words that keep punctuation: space and the five ASCII line and tab controls.
BLANKS = np.zeros(256, dtype=bool)
BLANKS[[32, 9, 10, 11, 12, 13]] = True
#: Separators of words of letters and digits; bytes above 0x7F are letters.
MARKS = np.ones(256, dtype=bool)
MARKS[48:58] = MARKS[97:123] = False
MARKS[128:] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a public finaliser of integer hashes)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base`` to 0, 1, ... n modulo 2^64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n + 1, SLICE * 2), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[: n + 1]


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for many spans, by one running sum."""
    n = len(values)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _power(_BASE, n)[:n], out=total[1:])
    part = (total[ends] - total[starts]) * _power(_INVERSE, n)[starts]
    return mix(part + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of the rows ``row0`` to ``row0 + rows`` of a batch.

    Row ``r`` has the words ``first[r]:first[r + 1]``.
    """

    row0: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    bounds: np.ndarray  # bytes of each row

    @property
    def rows(self) -> int:
        return len(self.first) - 1

    def row_of(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(self.rows), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return spans(_CODE[self.data], self.starts, self.ends)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def split(texts: pa.Array, separators: np.ndarray, lower: bool) -> Iterator[Words]:
    """Words of a column of texts, slice by slice; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, where, content = texts.buffers()
    where = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = np.frombuffer(content, dtype=np.uint8) if content is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(where, where[row] + SLICE, side="right")) - 1)
        bounds = where[row : stop + 1] - where[row]
        data = content[where[row] : where[stop]]
        if lower:
            data = _LOWER[data]
        inside = ~separators[data]
        begin, last = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = bounds[1:] > bounds[:-1]
        begin[bounds[:-1][full]] = inside[bounds[:-1][full]]
        last[bounds[1:][full] - 1] = inside[bounds[1:][full] - 1]
        starts = np.flatnonzero(begin)
        yield Words(row, data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds), bounds)
        row = stop


def long_column(x: np.ndarray) -> pa.Array:
    """64-bit hashes as the signed numbers that Spark has."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def lists(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    """A list column: row ``r`` holds ``values[bounds[r]:bounds[r + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)
