"""An FM-index over a sequence of small numbers, in numpy: all patterns are searched at once.

The Burrows-Wheeler transform lies in a wavelet matrix of packed bits. A backward search
narrows the rows of all patterns by one symbol per step, and rows are located by walking
back to the next sampled suffix position.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16  # every so many positions one suffix position is kept


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start places of the sorted suffixes of ``s``, whose last symbol is smaller than all others.

    Prefix doubling; only suffixes that still equal others are sorted again.
    """
    n = len(s)
    order = np.argsort(s, kind="stable")
    head = np.flatnonzero(np.concatenate([[True], s[order][1:] != s[order][:-1]]))
    size = np.diff(np.append(head, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(head, size)
    slots = np.flatnonzero(np.repeat(size, size) > 1)  # places in the order that are not settled
    h = 1
    while len(slots):
        who = order[slots]
        # Suffixes that are equal so far do not reach the end, which is unlike any symbol.
        key = rank[who] * np.int64(n + 1) + rank[who + h]
        by = np.argsort(key, kind="stable")
        who, key = who[by], key[by]
        order[slots] = who
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(slots)))
        rank[who] = np.repeat(slots[head], size)
        slots = slots[np.repeat(size, size) > 1]
        h *= 2
    return order


class Bits:
    """Packed bits with counts per 64 of them."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[:len(some)] = some
        self.words = packed.view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        at = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    """Symbols below ``sigma``; ranks and look-ups in as many steps as a symbol has bits."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = []
        bits = max(int(sigma - 1).bit_length(), 1)
        for shift in range(bits - 1, -1, -1):
            bit = (symbols >> shift) & 1 == 1
            ones = Bits(bit)
            self.levels.append((shift, ones, len(symbols) - int(bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        every = np.arange(sigma)
        self.start = self._down(every, np.zeros(sigma, np.int64))  # where a symbol's run begins at last

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, ones, zeros in self.levels:
            r = ones.rank(i)
            i = np.where((c >> shift) & 1 == 1, zeros + r, i - r)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._down(c, i) - self.start[c]

    def with_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and its occurrences before that place."""
        c = np.zeros(len(i), np.int64)
        for _, ones, zeros in self.levels:
            bit, r = ones.get(i), ones.rank(i)
            c = c << 1 | bit
            i = np.where(bit, zeros + r, i - r)
        return c, i - self.start[c]


class FMIndex:
    """Index of ``s``, symbols from 1 to ``sigma`` - 1."""

    def __init__(self, s: np.ndarray, sigma: int, sample: int = SAMPLE):
        s = np.concatenate([s, [0]]).astype(np.int64)
        order = suffix_array(s)
        self.n = len(s)
        self.tree = WaveletMatrix(s[order - 1], sigma)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=sigma))])[:sigma]
        kept = order % sample == 0
        self.kept, self.places = Bits(kept), order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [first, last) of the suffixes that begin with each pattern, a row of ``patterns`` up to its length."""
        first, last = np.zeros(len(patterns), np.int64), np.where(lengths > 0, self.n, 0)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            on = np.flatnonzero((lengths >= back) & (last > first))
            if not len(on):
                break
            c = patterns[on, lengths[on] - back]
            first[on] = self.smaller[c] + self.tree.rank(c, first[on])
            last[on] = self.smaller[c] + self.tree.rank(c, last[on])
        return first, np.maximum(first, last)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffixes, by walking back to the next kept place."""
        out = np.empty(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            there = self.kept.get(rows)
            out[left[there]] = self.places[self.kept.rank(rows[there])] + steps
            left, rows = left[~there], rows[~there]
            c, r = self.tree.with_rank(rows)
            rows = self.smaller[c] + r
            steps += 1
        return out
