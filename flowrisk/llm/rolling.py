"""Word sequences as hash arrays: rolling hashes of any length, and winnowing, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash


# Odd, so both have inverses modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_CHUNK = 1_500_000  # characters hashed together
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse, 0 to at least n."""
    if base not in _powers or len(_powers[base][0]) <= n:
        size = 1 << int(n + 1).bit_length()
        both = []
        for b in (base, pow(base, -1, 2 ** 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers[base] = tuple(both)
    return _powers[base]


@dataclass
class Texts:
    """Some texts as one row of words with 128-bit word hashes; text d has words first[d] to first[d + 1]."""

    rows: pd.DataFrame
    words: list[list[bytes]]
    first: np.ndarray
    hashes: tuple[np.ndarray, np.ndarray]

    def __post_init__(self) -> None:
        n = int(self.first[-1])
        self._sums = []
        for base, h in zip(_BASES, self.hashes):
            power, inverse = _power(base, n)
            with np.errstate(over="ignore"):
                sums = np.zeros(n + 1, np.uint64)
                np.cumsum(h * power[:n], out=sums[1:])
            self._sums.append((sums, inverse))

    def span(self, start: np.ndarray, end: np.ndarray, half: int = 0) -> np.ndarray:
        """Hashes of the word sequences [start, end), equal for equal sequences wherever they stand."""
        sums, inverse = self._sums[half]
        return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def hashed(batches: Iterator[pd.DataFrame], text: str = "text") -> Iterator[Texts]:
    """The texts of all batches, about ``_CHUNK`` characters at a time; a text is never cut."""
    for batch in batches:
        batch = batch.reset_index(drop=True)
        length = batch[text].str.len().fillna(0).to_numpy(np.int64)
        part = np.cumsum(length) // _CHUNK
        for _, rows in batch.groupby(part, sort=False):
            # Bytes split at ASCII white space alone, as words do.
            words = [t.encode().split() if isinstance(t, str) else [] for t in rows[text]]
            first = np.zeros(len(words) + 1, np.int64)
            np.cumsum([len(w) for w in words], out=first[1:])
            flat = np.empty(int(first[-1]), object)
            flat[:] = [w for ws in words for w in ws]
            codes, distinct = pd.factorize(flat)
            digest = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in distinct]), np.uint64).reshape(-1, 2)
            yield Texts(rows.reset_index(drop=True), words, first, (digest[codes, 0], digest[codes, 1]))


def window_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` consecutive hashes, the rightmost of equal ones."""
    at, size = np.arange(len(h)), 1
    while size * 2 <= width:
        a, b = at[:-size], at[size:]
        at = np.where(h[b] <= h[a], b, a)
        size *= 2
    if size < width:
        n = len(h) - width + 1
        a, b = at[:n], at[width - size:][:n]
        at = np.where(h[b] <= h[a], b, a)
    return at


def text_mark(text: object) -> int:
    """23 bits that tell apart different texts under one id."""
    return xxhash.xxh3_64_intdigest(text) >> 41 if isinstance(text, str) else 0
