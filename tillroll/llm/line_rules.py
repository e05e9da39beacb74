"""Quality rules by labelling lines: a linear-chain conditional random field and Viterbi decoding.

Lines with a word are the positions of a chain with two labels, content and boilerplate. A line's
features are its surface figures as levels; weights and transitions maximise the likelihood of a
bounded sample whose lines take the quality label of their document, as no line labels exist. A
document stays if content lines hold at least half of its words; the base rules (too few words, too
many words in repeated windows) come first and are exact.

Null and blank texts have no words and fail the base rules. Equal lines count from their second
occurrence on, their text compared whole. Without both labels in the sample, every line is content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tillroll.llm import words as w
from tillroll.llm.shared import records, text_of, text_parts
from tillroll.llm.stats import KIND, STATS, SYMBOLS, Adam, Levels, distinct_in_rows, text_stats
from tillroll.llm.training import labelled

MOD, REST = 5, 0  # rows that nothing is learnt from, as for the quality classifier
SAMPLE = {0: 2500, 1: 2500}  # labelled rows of either class
STEPS = 60
DECAY = 1e-3
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30
CONTENT_SHARE = 0.5
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, row) of every line, empty ones included; lines end at a line feed or a text's end."""
    feeds = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    end = np.sort(np.concatenate([feeds, offsets[1:]]))
    # a feed that ends a text opens one more, empty line there, which sorts as that text's own
    counts = 1 + np.searchsorted(feeds, offsets[1:]) - np.searchsorted(feeds, offsets[:-1])
    return begin, end, np.repeat(np.arange(len(offsets) - 1), counts)


def repeated_words(hashes: np.ndarray, first: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Words of each row that lie in a window of ``size`` words found twice or more in the row."""
    n = len(first) - 1
    out = np.zeros(n, np.int64)
    if len(hashes) < size:
        return out
    rows = w.rows_of(first)
    span = len(hashes) - size + 1
    window = np.zeros(span, np.uint64)
    for k in range(size):
        window = window * w.BASE + w.mixed(hashes[k : k + span])
    inside = np.flatnonzero(rows[:span] == rows[size - 1 :])
    key = w.mixed(window[inside] ^ (rows[inside].astype(np.uint64) * w.MIX_1))
    order = np.argsort(key)
    same = np.diff(key[order]) == 0
    twice = np.zeros(len(key), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    edge = np.zeros(len(hashes) + 1, np.int64)
    hit = inside[twice]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    return np.bincount(rows[np.cumsum(edge[:-1]) > 0], minlength=n)


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    rows_of_bytes = np.repeat(np.arange(n), np.diff(offsets))
    _, _, first, hashes = w.words(data, offsets)
    begins = (data & 0xC0) != 0x80  # first bytes of code points
    in_word = KIND[data] < 8
    begin, end, line_row = line_spans(data, offsets)
    words_before = np.concatenate([[0], np.cumsum(in_word)])
    full = words_before[end] > words_before[begin]
    text = w.Sums(data).of(begin[full], end[full])
    lines = np.bincount(line_row[full], minlength=n)
    return {
        "n_words": np.diff(first),
        "word_chars": np.bincount(rows_of_bytes[in_word & begins], minlength=n),
        "n_symbols": np.bincount(rows_of_bytes[IS_SYMBOL[data]], minlength=n),
        "n_dup_lines": lines - distinct_in_rows(text, line_row[full], n),
        "n_repeat_words": repeated_words(hashes, first),
    }


def line_stats(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Figures of each line with a word, its row and its words."""
    begin, end, row = line_spans(data, offsets)
    inner = np.concatenate([begin, offsets[-1:]])  # a line's own feed is white space at its end
    counts = np.diff(w.words(data, inner)[2])
    stats = text_stats(data, inner)
    return stats[counts > 0], row[counts > 0], counts[counts > 0]


class Chains:
    """Sequences laid out so that one step handles the t-th position of all that have one."""

    def __init__(self, rows: np.ndarray):
        _, self.first, self.sizes = np.unique(rows, return_index=True, return_counts=True)
        order = np.argsort(-self.sizes, kind="stable")
        self.first, self.sizes = self.first[order], self.sizes[order]
        self.longest = int(self.sizes[0]) if len(rows) else 0
        self.alive = np.searchsorted(-self.sizes, -np.arange(1, self.longest + 1), "right")

    def at(self, t: int) -> np.ndarray:
        return self.first[: self.alive[t]] + t


class LineField:
    """Two labels: 0 boilerplate, 1 content."""

    def __init__(self, stats: np.ndarray, rows: np.ndarray, labels: np.ndarray, steps: int = STEPS):
        self.levels = Levels(stats)
        self.values = {"w": np.zeros(self.levels.width), "b": np.zeros(1), "step": np.zeros((2, 2)), "start": np.zeros(2)}
        self.fitted = len(np.unique(labels)) == 2
        if self.fitted:
            self._fit(self.levels(stats), rows, labels.astype(int), steps)

    def _emissions(self, x: np.ndarray) -> np.ndarray:
        score = x @ self.values["w"].astype(np.float32) + self.values["b"][0]
        return np.stack([-score / 2, score / 2], axis=1).astype(np.float64)

    def _fit(self, x, rows, labels, steps) -> None:
        chains, adam = Chains(rows), Adam(0.05)
        n = len(chains.sizes)
        weight = np.zeros(len(rows))  # a chain counts once however long it is
        size_of = np.repeat(0, len(rows))
        for t in range(chains.longest):
            size_of[chains.at(t)] = chains.sizes[: chains.alive[t]]
        weight = 1.0 / (n * size_of)
        for _ in range(steps):
            one, two, head = self._marginals(self._emissions(x), chains, labels, weight)
            g = weight * (one - labels)
            slopes = {"w": x.T @ g.astype(np.float32) + DECAY * self.values["w"], "b": np.array([g.sum()]), "step": two + DECAY * self.values["step"], "start": head}
            adam.step(self.values, slopes)

    def _marginals(self, emit, chains, labels, weight):
        """Probability of content at each line, and slopes of transitions and start."""
        step, start = self.values["step"], self.values["start"]
        forward = np.zeros_like(emit)
        scale = np.zeros(len(emit))

        def norm(at, a):
            m = a.max(axis=1, keepdims=True)
            z = m + np.log(np.exp(a - m).sum(axis=1, keepdims=True))
            forward[at], scale[at] = a - z, z[:, 0]

        norm(chains.at(0), emit[chains.at(0)] + start)
        for t in range(1, chains.longest):
            at = chains.at(t)
            norm(at, np.logaddexp(forward[at - 1][:, :1] + step[0], forward[at - 1][:, 1:] + step[1]) + emit[at])
        back = np.zeros_like(emit)
        two = np.zeros((2, 2))
        for t in range(chains.longest - 1, 0, -1):
            at = chains.at(t)
            ahead = emit[at] + back[at] - scale[at, None]
            back[at - 1] = np.logaddexp(step[:, 0] + ahead[:, :1], step[:, 1] + ahead[:, 1:])
            joint = np.exp(forward[at - 1][:, :, None] + step[None] + ahead[:, None, :])
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            two += (joint * weight[at][:, None, None]).sum(axis=0)
            np.add.at(two, (labels[at - 1], labels[at]), -weight[at])
        one = np.exp(forward + back)
        one /= one.sum(axis=1, keepdims=True)
        at = chains.at(0)
        head = (one[at] * weight[at][:, None]).sum(axis=0)
        np.add.at(head, labels[at], -weight[at])
        return one[:, 1], two, head

    def decode(self, stats: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The most probable labels of all lines (Viterbi); ties go to content."""
        if not self.fitted or not len(rows):
            return np.ones(len(rows), int)
        emit, chains = self._emissions(self.levels(stats)), Chains(rows)
        step = self.values["step"]
        best, came = emit.copy(), np.zeros((len(rows), 2), np.int8)
        best[chains.at(0)] += self.values["start"]
        for t in range(1, chains.longest):
            at = chains.at(t)
            from_0, from_1 = best[at - 1][:, :1] + step[0], best[at - 1][:, 1:] + step[1]
            came[at] = from_1 >= from_0
            best[at] += np.maximum(from_0, from_1)
        out = np.zeros(len(rows), int)
        for t in range(chains.longest - 1, -1, -1):
            at = chains.at(t)
            ends = chains.sizes[: len(at)] == t + 1
            out[at[ends]] = best[at[ends], 1] >= best[at[ends], 0]
            if not ends.all():
                more = at[~ends]
                out[more] = came[more + 1, out[more + 1]]
        return out


def sample_lines(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Figures, chain numbers and labels of the lines of a bounded sample, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch["label"].to_numpy(zero_copy_only=False)
            rows, own = [], []
            for start, data, offsets in text_parts(batch["text"]):
                stats, row, _ = line_stats(data, offsets)
                for r in np.unique(row):
                    rows.append(stats[row == r].astype("<f4").tobytes())
                    own.append(int(labels[start + r]))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(rows, pa.binary())], ["label", "lines"])

    got = sample.mapInArrow(run, "label int, lines binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r["label"], r["lines"]))
    parts = [np.frombuffer(r["lines"], "<f4").reshape(-1, len(STATS)) for r in got]
    sizes = [len(p) for p in parts]
    stats = np.concatenate(parts) if parts else np.zeros((0, len(STATS)), np.float32)
    return stats, np.repeat(np.arange(len(parts)), sizes), np.repeat([r["label"] for r in got], sizes)


def fit(docs: DataFrame, labels: DataFrame) -> LineField:
    return LineField(*sample_lines(labelled(docs, labels, "quality", MOD, REST, SAMPLE)))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words"]


def judge(data: np.ndarray, offsets: np.ndarray, model: LineField) -> dict[str, np.ndarray]:
    out = base_counts(data, offsets)
    stats, row, counts = line_stats(data, offsets)
    labels = model.decode(stats, row)
    out["content_words"] = np.bincount(row, weights=counts * labels, minlength=len(offsets) - 1).astype(np.int64)
    return out


def judged(docs: DataFrame, model: LineField) -> DataFrame:
    """(record, counts, base_failed, kept) for rows of (record, text) or of record alone."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(data, offsets, spread.value) for _, data, offsets in text_parts(text_of(batch))]
            columns = [pa.array(np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64), pa.int64()) for c in COLUMNS]
            yield pa.RecordBatch.from_arrays([batch["record"], *columns], ["record", *COLUMNS])

    schema = T.StructType([docs.schema["record"], *[T.StructField(c, T.LongType()) for c in COLUMNS]])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    enough = F.col("content_words") >= CONTENT_SHARE * F.col("n_words")
    return docs.mapInArrow(run, schema).withColumn("base_failed", failed).withColumn("kept", ~failed & enough)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, the base counts, base_failed, kept, content_words), one row per row."""
    slim = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id")).alias("record"), F.col("text").cast("string").alias("text"))
    return judged(slim, fit(docs, labels)).select("record.doc_id", *COLUMNS[:-1], "base_failed", "kept", "content_words")


def accepted(docs: DataFrame, model: LineField) -> DataFrame:
    """The documents that pass base rules and content share; columns as they came."""
    return judged(records(docs), model).filter("kept").select("record.*")
