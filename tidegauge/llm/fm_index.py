"""A compressed FM-index over sequences of word codes, searched for many patterns at once.

Bits are packed 64 to a word with one count per word; the levels form a wavelet matrix, the
form of a wavelet tree for large alphabets. Sequences are separated by the symbol 0.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``text`` by their first ``depth`` symbols at least (doubling)."""
    n = len(text)
    rank, length = text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while length < depth:
        after = np.zeros(n, dtype=np.int64)
        after[: n - length] = rank[length:] + 1
        pair = rank * (n + 2) + after
        order = np.argsort(pair, kind="stable")
        sorted_ = pair[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate(([0], sorted_[1:] != sorted_[:-1])))
        rank, length = new, 2 * length
        if rank[order[-1]] == n - 1:
            break
    return order


class Wavelet:
    """Wavelet matrix: ``rank(c, i)`` is the number of ``c`` among the first ``i`` symbols."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        now = symbols.astype(np.int64)
        for level in range(self.bits - 1, -1, -1):
            bit = ((now >> level) & 1).astype(bool)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, dtype=bool)
            padded[: len(bit)] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))[:-1].astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate((now[~bit], now[bit]))
        self.base = self._down(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            block = i >> 6
            mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][block] + np.bitwise_count(self.words[k][block] & mask)
            i = np.where((c >> level) & 1, self.zeros[k] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._down(c, i) - self.base[c]


class FMIndex:
    """Index over weighted sequences of 64-bit codes; a weight says how often a sequence occurs."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray, weights: np.ndarray):
        """Sequence ``k`` is ``codes[bounds[k]:bounds[k + 1]]``."""
        lengths = np.diff(bounds)
        known, symbol = np.unique(codes, return_inverse=True)
        # Every sequence is followed by a separator.
        place = np.arange(len(codes)) + np.repeat(np.arange(len(lengths)), lengths)
        self.text = np.zeros(len(codes) + len(lengths), dtype=np.int64)
        self.text[place] = symbol + 1
        self.begin = bounds[:-1] + np.arange(len(lengths))
        order = suffix_array(self.text, int(lengths.max(initial=0)) + 1)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(self.text, minlength=len(known) + 1))))
        self.wavelet = Wavelet(self.text[order - 1], len(known) + 1)
        owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        self.weight = np.concatenate(([0], np.cumsum(weights[owner[order]])))

    def backward(self, first: np.ndarray, last: np.ndarray, least: int) -> np.ndarray:
        """Extend from ``last`` towards ``first`` (places in the text) while the occurrences
        weigh ``least`` at least; returns the first place that could not be added, or
        ``first - 1``."""
        at = last.copy()
        low = np.zeros(len(at), dtype=np.int64)
        high = np.full(len(at), len(self.text), dtype=np.int64)
        live = np.arange(len(at))
        while len(live):
            c = self.text[at[live]]
            both = self.wavelet.rank(np.concatenate((c, c)), np.concatenate((low[live], high[live])))
            a, b = self.below[c] + both[: len(c)], self.below[c] + both[len(c) :]
            fits = self.weight[b] - self.weight[a] >= least
            live, a, b = live[fits], a[fits], b[fits]
            low[live], high[live] = a, b
            at[live] -= 1
            live = live[at[live] >= first[live]]
        return at

    def repeated_windows(self, width: int, least: int = 2) -> list[np.ndarray]:
        """For each sequence a mask of its windows of ``width`` that occur ``least`` times.

        A region of window starts ``a..b`` is searched as a whole from its end. Where the
        match stops at ``f``, windows right of ``f`` are repeated and those that hold the
        unmatched part are not; what is left is searched on.
        """
        ends = np.concatenate((self.begin[1:], [len(self.text)])) - 1
        count = np.maximum(ends - self.begin - width + 1, 0)
        mark = np.zeros(len(self.text) + 1, dtype=np.int64)
        use = count > 0
        a, b, whole = self.begin[use], self.begin[use] + count[use] - 1, np.ones(int(use.sum()), dtype=bool)
        while len(a):
            f = self.backward(a, np.where(whole, b, a) + width - 1, least)
            full = f < a
            # Marks: all of a region, its first window, or what lies right of the stop.
            left = np.where(full, a, f + 1)
            right = np.where(whole, b, a)
            hit = left <= right
            np.add.at(mark, left[hit], 1)
            np.add.at(mark, right[hit] + 1, -1)
            parts = [
                (a, f, whole & ~full & (f < b), True),
                (a, np.minimum(f - width, b - 1), whole & ~full & (f >= b), True),
                (np.maximum(a, f - width + 1), b - 1, whole & ~full & (f >= b), False),
                (a + 1, b, ~whole & full, True),
                (f + 1, b, ~whole & ~full, True),
            ]
            new = [(x[m & (x <= y)], y[m & (x <= y)], kind) for x, y, m, kind in parts]
            a = np.concatenate([x for x, _, _ in new])
            b = np.concatenate([y for _, y, _ in new])
            whole = np.concatenate([np.full(len(x), kind) for x, _, kind in new])
        covered = np.cumsum(mark) > 0
        return [covered[s : s + n] for s, n in zip(self.begin.tolist(), count.tolist(), strict=True)]
