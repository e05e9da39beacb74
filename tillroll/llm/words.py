"""Words of many texts at once: where they are and 64-bit hashes of them, all in numpy.

Words are runs of bytes other than space and 0x09-0x0D, found on the UTF-8 bytes, so no text is
decoded. A word's hash is a polynomial over its bytes modulo 2**64, taken from one running sum.
"""

from __future__ import annotations

import numpy as np

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = np.uint64(0x9E3779B97F4A7C55)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE**0 .. BASE**(n-1) modulo 2**64, grown by doubling and kept while the worker lives."""
    global _powers
    if n > 1 << 24:  # a very long text: not worth keeping
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, BASE)]), dtype=np.uint64)
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * np.uint64(pow(int(BASE), len(_powers), 1 << 64))])
    return _powers[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits (the finisher of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * MIX_1
    h = (h ^ (h >> np.uint64(27))) * MIX_2
    return h ^ (h >> np.uint64(31))


class Sums:
    """Running polynomial sums over bytes; ``of`` gives the hash of any byte ranges."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.power = powers(n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(self.total) - 1
        raw = (self.total[ends] - self.total[starts]) * self.power[n - starts]
        # the power left over depends on n only; taking it out makes hashes equal across parts
        raw = raw * _inverse_power(n)
        return mixed(raw ^ ((ends - starts).astype(np.uint64) * STEP))


def _inverse_power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), -n, 1 << 64))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True that do not cross rows: (starts, ends, first run of each row and the count)."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begin[cuts] = inside[cuts]
    end[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False):
    """(starts, ends, first word of each row and the count, hashes) of white-space words."""
    starts, ends, first = spans(~IS_SPACE[data], offsets)
    return starts, ends, first, Sums(LOWER[data] if lower else data).of(starts, ends)


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each run, from the first run of each row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def pairs_of(hashes: np.ndarray) -> np.ndarray:
    """A hash for each word and the one after it."""
    return mixed(hashes[:-1] * STEP + mixed(hashes[1:]))
