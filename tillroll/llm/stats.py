"""Surface figures of many texts or lines at once, from their bytes and word hashes."""

from __future__ import annotations

import numpy as np

from tillroll.llm import words as w

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"

_KINDS = 10  # upper, lower, digit, symbol, exclamation, bar, other sign, high byte, white, line feed


def _kind_table() -> np.ndarray:
    kind = np.full(256, 6, np.uint8)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 0, 1, 2, 7
    kind[[ord(c) for c in SYMBOLS]] = 3
    kind[ord("!")], kind[ord("|")] = 4, 5
    kind[[0x20, *range(0x09, 0x0E)]] = 8
    kind[0x0A] = 9
    return kind


KIND = _kind_table()
STATS = [
    "log_words", "log_bytes", "word_bytes", "upper", "digits", "symbols", "exclamations", "bars", "signs", "high",
    "stops", "same_as_last", "distinct_words", "distinct_pairs", "capitalised", "all_upper", "longest", "line_feeds", "ends_in_stop", "symbol_ends",
]


def distinct_in_rows(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each row."""
    keys = w.mixed(hashes ^ (rows.astype(np.uint64) * w.MIX_1))
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = np.diff(keys[order]) != 0
    return np.bincount(rows[order[new]], minlength=n)


def text_stats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATS for each text; all zero but for sizes where there are no words."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    starts, ends, first, hashes = w.words(data, offsets)
    counts = np.diff(first)
    rows = np.repeat(np.arange(n), counts)
    kinds = np.bincount(np.repeat(np.arange(n) * _KINDS, sizes) + KIND[data], minlength=n * _KINDS).reshape(n, _KINDS)
    per_word, per_byte = np.maximum(counts, 1), np.maximum(sizes, 1)
    add = lambda flags: np.bincount(rows[flags], minlength=n) / per_word
    out = np.zeros((n, len(STATS)), np.float32)
    letters = np.maximum(kinds[:, 0] + kinds[:, 1], 1)
    out[:, 0], out[:, 1] = np.log1p(counts), np.log1p(sizes)
    out[:, 2] = (sizes - kinds[:, 8] - kinds[:, 9]) / per_word
    out[:, 3], out[:, 4] = kinds[:, 0] / letters, kinds[:, 2] / per_byte
    out[:, 5], out[:, 6], out[:, 7] = (kinds[:, 3] + kinds[:, 5]) / per_word, kinds[:, 4] / per_word, kinds[:, 5] / per_word
    out[:, 8], out[:, 9] = kinds[:, 6] / per_word, kinds[:, 7] / per_byte
    out[:, 17] = kinds[:, 9] / per_word
    if len(starts):
        final, head = data[ends - 1], data[starts]
        stop = (final == 0x2E) | (final == 0x2C)
        out[:, 10] = add(stop)
        again = np.zeros(len(starts), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
        out[:, 11] = add(again)
        out[:, 12] = distinct_in_rows(hashes, rows, n) / per_word
        joined = rows[1:] == rows[:-1]
        out[:, 13] = distinct_in_rows(w.pairs_of(hashes)[joined], rows[1:][joined], n) / np.maximum(counts - 1, 1)
        capital = (head >= 65) & (head <= 90)
        out[:, 14] = add(capital)
        lower = np.concatenate([[0], np.cumsum(KIND[data] == 1)])
        out[:, 15] = add(capital & (lower[ends] == lower[starts]))
        longest = np.zeros(n)
        np.maximum.at(longest, rows, ends - starts)
        out[:, 16] = np.log1p(longest)
        has = counts > 0
        out[has, 18] = stop[first[1:][has] - 1]
        out[:, 19] = add((KIND[final] >= 3) & (KIND[final] <= 5))
    return out


class Levels:
    """Figures as shares of a sample below them, with hinges for the highest and lowest shares."""

    HINGES = (0.02, 0.05, 0.1, 0.2, 0.4)
    FORMS = 1 + 2 * len(HINGES)

    def __init__(self, sample: np.ndarray):
        marks = np.linspace(0, 1, 201)
        self.marks = marks
        self.values = np.quantile(sample, marks, axis=0) if len(sample) else np.zeros((201, sample.shape[1]))
        # middle of the range of equal values, so that a figure that is mostly 0 gives one level there
        self.low = [np.searchsorted(v, v, "left") for v in self.values.T]
        self.high = [np.searchsorted(v, v, "right") - 1 for v in self.values.T]

    @property
    def width(self) -> int:
        return self.values.shape[1] * self.FORMS

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        out = []
        for j, v in enumerate(self.values.T):
            level = np.interp(stats[:, j], *self._knots(j))
            out.append(2 * level - 1)
            for h in self.HINGES:
                out.append(np.maximum(0, (level - 1 + h) / h))
                out.append(np.maximum(0, (h - level) / h))
        return np.stack(out, axis=1).astype(np.float32) if out else np.zeros((len(stats), 0), np.float32)

    def _knots(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        v, first = np.unique(self.values[:, j], return_index=True)
        return v, (self.marks[self.low[j][first]] + self.marks[self.high[j][first]]) / 2


class Adam:
    """Gradient steps with running moments."""

    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, values: dict[str, np.ndarray], slopes: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in slopes.items():
            m = self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * g
            v = self.v[k] = 0.999 * self.v.get(k, 0) + 0.001 * g * g
            values[k] -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)
