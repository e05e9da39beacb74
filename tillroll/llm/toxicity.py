"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words are runs of letters in lower case. A word's vector is the sum of hashed embeddings of the word
and of its beginnings, so that an unseen form of a known stem is near it. Filters of several widths
run over the vectors of a whole text; the maximum of each filter goes into a logistic layer. Training
takes a bounded sample of labelled rows outside the held-out part. A threshold is set for each
language, which is guessed from function words in the text, from a histogram of the scores of all
labelled rows that are not held out, at the true shares of the labels; rows of the sample are scored
by models that were fitted without them. A language starts from all languages' rows, scaled to ENOUGH
toxic ones, so few rows of its own move its threshold little.
Scores are shifted so that every language's threshold lies at THRESHOLD.

Null texts and texts without letters get the score of an empty text. Without both labels in the
sample every score is 0. Long texts are read whole; repeated rows get equal scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm import words as w
from tillroll.llm.shared import kept, text_parts
from tillroll.llm.training import chosen, held_out, labelled

MOD, REST = 3, 1  # held-out rows
THRESHOLD = 0.7
SAMPLE = {0: 3000, 1: 2000}  # labelled rows of either class
BEGINNINGS = (4, 5, 6)  # bytes
ROWS, SIZE = 1 << 15, 12  # embedding table
WIDTHS, FILTERS = (1, 2, 3), 12
EPOCHS, BATCH = 6, 50
FOLDS = 5  # models that score sample rows they were not fitted on
ENOUGH = 10  # toxic rows of all languages that a language's own ones are added to
MOST, CELLS = 40, 64  # the histogram goes to this logit, with so many cells for 1

# Common function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are with as by be this have from or".split(),
    "de": "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch".split(),
    "fr": "le les des et un une du en est que pour dans qui sur au pas avec ce il par".split(),
    "es": "el los las que y en un una del se por con para es su al lo como más pero".split(),
}


def _function_hashes() -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes and their languages; words of two languages are left out."""
    known: dict[int, set[int]] = {}
    for language, group in enumerate(FUNCTION_WORDS.values()):
        for word in group:
            data = np.frombuffer(word.encode(), np.uint8)
            h = int(w.Sums(data).of(np.array([0]), np.array([len(data)]))[0])
            known.setdefault(h, set()).add(language)
    single = sorted((h, next(iter(ls))) for h, ls in known.items() if len(ls) == 1)
    return np.array([h for h, _ in single], np.uint64), np.array([x for _, x in single])


FUNCTION_HASHES, FUNCTION_LANGUAGES = _function_hashes()
OTHER = len(FUNCTION_WORDS)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embedding places of each word, first word of each row and the count, language of each row)."""
    low = w.LOWER[data]
    starts, ends, first = w.spans(w.IS_LETTER[data], offsets)
    sums = w.Sums(low)
    whole = sums.of(starts, ends)
    places = [whole % np.uint64(ROWS)]
    for k in BEGINNINGS:
        h = sums.of(starts, np.minimum(starts + k, ends))
        places.append(w.mixed(h + np.uint64(k)) % np.uint64(ROWS))
    at = np.minimum(np.searchsorted(FUNCTION_HASHES, whole), len(FUNCTION_HASHES) - 1)
    hit = FUNCTION_HASHES[at] == whole
    n = len(offsets) - 1
    rows = w.rows_of(first)
    votes = np.bincount(rows[hit] * OTHER + FUNCTION_LANGUAGES[at[hit]], minlength=n * OTHER).reshape(n, OTHER)
    language = np.where(votes.sum(axis=1) > 0, votes.argmax(axis=1), OTHER)
    return np.stack(places, axis=1).astype(np.int32), first, language


class Convolutions:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.1, (ROWS, SIZE)).astype(np.float32)
        self.filters = {k: rng.normal(0, 0.3, (k * SIZE, FILTERS)).astype(np.float32) for k in WIDTHS}
        self.shift = {k: np.zeros(FILTERS, np.float32) for k in WIDTHS}
        self.out = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)
        self.fitted = False
        self._squares: dict[str, np.ndarray] = {}

    def vectors(self, places: np.ndarray) -> np.ndarray:
        out = self.table[places[:, 0]]
        for j in range(1, places.shape[1]):
            out += self.table[places[:, j]]
        return out

    @staticmethod
    def _windows(x: np.ndarray, k: int) -> np.ndarray:
        """The k vectors from each word on, side by side."""
        return x if k == 1 else np.concatenate([x[j : len(x) - k + 1 + j] for j in range(k)], axis=1)

    def pooled(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Maxima of all filters over each row, 0 where a row has too few words."""
        n = len(first) - 1
        out = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        for i, k in enumerate(WIDTHS):
            fits = np.flatnonzero(np.diff(first) >= k)
            if len(fits):
                found = self._windows(x, k) @ self.filters[k]
                edges = np.stack([first[fits], first[fits + 1] - k + 1], axis=1).ravel()
                padded = np.concatenate([found, np.full((1, FILTERS), -np.inf, np.float32)])
                top = np.maximum.reduceat(padded, edges, axis=0)[::2] + self.shift[k]
                out[fits, i * FILTERS : (i + 1) * FILTERS] = np.maximum(top, 0)
        return out

    def logits(self, places: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(self.vectors(places), first) @ self.out + self.bias[0]

    def _adagrad(self, name: str, value: np.ndarray, slope: np.ndarray, rate: float) -> None:
        total = self._squares.setdefault(name, np.full_like(value, 1e-6))
        total += slope * slope
        value -= rate * slope / np.sqrt(total)

    def learn(self, docs: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, rate: float) -> None:
        """One step on a batch of texts."""
        sizes = np.array([len(d) for d in docs])
        first = np.concatenate([[0], np.cumsum(sizes)])
        places = np.concatenate(docs)
        x = self.vectors(places)
        top = np.zeros((len(docs), len(WIDTHS) * FILTERS), np.float32)
        where = np.zeros((len(docs), len(WIDTHS) * FILTERS), np.int64)
        for i, k in enumerate(WIDTHS):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            if len(x) < k:
                continue
            found = self._windows(x, k) @ self.filters[k]
            for d in np.flatnonzero(sizes >= k):
                part = found[first[d] : first[d + 1] - k + 1]
                where[d, own] = part.argmax(axis=0) + first[d]
                top[d, own] = part[where[d, own] - first[d], np.arange(FILTERS)] + self.shift[k]
        pooled = np.maximum(top, 0)
        logit = pooled @ self.out + self.bias[0]
        g = (weights * (1 / (1 + np.exp(-logit)) - labels) / len(docs)).astype(np.float32)
        back = g[:, None] * self.out[None, :] * (top > 0)
        self._adagrad("out", self.out, pooled.T @ g + 1e-5 * self.out, rate)
        self._adagrad("bias", self.bias, g.sum(keepdims=True), rate)
        for i, k in enumerate(WIDTHS):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            d, f = np.nonzero(back[:, own])
            if not len(d):
                continue
            at, slope = where[:, own][d, f], back[:, own][d, f]
            seen = x[at[:, None] + np.arange(k)].reshape(len(d), k * SIZE)
            change = np.zeros_like(self.filters[k])
            np.add.at(change.T, f, slope[:, None] * seen)
            to_words = (slope[:, None] * self.filters[k].T[f]).reshape(len(d) * k, SIZE)
            self._adagrad(f"filters{k}", self.filters[k], change, rate)
            self._adagrad(f"shift{k}", self.shift[k], np.bincount(f, slope, FILTERS).astype(np.float32), rate)
            touched = places[(at[:, None] + np.arange(k)).ravel()]
            cells, inverse = np.unique(touched.ravel(), return_inverse=True)
            total = np.zeros((len(cells), SIZE), np.float32)
            np.add.at(total, inverse, np.repeat(to_words, touched.shape[1], axis=0))
            squares = self._squares.setdefault("table", np.full_like(self.table, 1e-6))
            squares[cells] += total * total
            self.table[cells] -= rate * total / np.sqrt(squares[cells])

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> None:
        if len(np.unique(labels)) < 2:
            return
        rng = np.random.default_rng(seed)
        for epoch in range(EPOCHS):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                self.learn([docs[i] for i in some], labels[some], np.ones(len(some)), 0.1 if epoch < EPOCHS - 2 else 0.04)
        self._squares = {}
        self.fitted = True


def cell(logit: np.ndarray) -> np.ndarray:
    return np.floor((np.clip(logit, -MOST, MOST) + MOST) * CELLS).astype(np.int64)


def best_mark(rows: np.ndarray) -> float:
    """The threshold with the best F1 for label 1, in the middle of the gap it lies in; ``rows`` by label and cell."""
    cells = np.flatnonzero(rows.sum(axis=0) > 0)[::-1]
    hits = np.cumsum(rows[1, cells])
    f1 = 2 * hits / (np.cumsum(rows[:, cells].sum(axis=0)) + max(hits[-1], 1e-9))
    last = int(f1.round(12).argmax())  # the same cell at any scale of the rows
    lower = cells[last + 1] + 1 if last + 1 < len(cells) else cells[last] - CELLS
    return float((cells[last] + lower) / 2 / CELLS - MOST)


def cross_fitted(docs: list[np.ndarray], labels: np.ndarray, model: Convolutions) -> np.ndarray:
    """Logits of the sample by models fitted without them; by ``model`` where a label is missing without them."""
    fold = np.array([zlib.crc32(d.tobytes()) % FOLDS for d in docs])  # copies stay together
    out = np.zeros(len(docs))
    for k in range(FOLDS):
        own, others = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        one = Convolutions()
        one.fit([docs[i] for i in others], labels[others])
        for i in own:
            out[i] = (one if one.fitted else model).logits(docs[i], np.array([0, len(docs[i])]))[0]
    return out


def marks(outside: np.ndarray, inside: np.ndarray, sample: tuple[list[np.ndarray], np.ndarray, np.ndarray], model: Convolutions) -> np.ndarray:
    """The threshold of each language, as logit.

    ``outside`` has the labelled rows that are not in the sample, by language, label and cell, and
    ``inside`` the count of those in the sample by label. The sample's rows always count too, so the rule is
    the same for tables of any size. Every language starts from all languages' rows, scaled to ENOUGH toxic
    ones, so its own rows take over gradually.
    """
    rows = outside.astype(float)
    docs, labels, languages = sample
    if len(docs):
        np.add.at(rows, (languages, labels, cell(cross_fitted(docs, labels, model))), 1)
    shares = (outside.sum(axis=(0, 2)) + inside) / np.maximum(rows.sum(axis=(0, 2)), 1)  # 1 if no row is missing
    weighed = rows * shares[None, :, None]
    every = weighed.sum(axis=0)
    start = every * ENOUGH / max(every[1].sum(), 1)
    return np.array([best_mark(w_ + start) for w_ in weighed])


def sample_tokens(sample: DataFrame) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Embedding places, labels and languages of a bounded sample, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, languages = [], []
            for _, data, offsets in text_parts(batch["text"]):
                found, first, language = tokens(data, offsets)
                places += [found[a:b].astype("<u2").tobytes() for a, b in zip(first[:-1], first[1:])]
                languages += language.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch["label"].cast(pa.int32()), pa.array(languages, pa.int32()), pa.array(places, pa.binary())], ["label", "language", "places"]
            )

    got = sample.mapInArrow(run, "label int, language int, places binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r["label"], r["places"]))  # the fit does not depend on arrival
    docs = [np.frombuffer(r["places"], "<u2").astype(np.int32).reshape(-1, 1 + len(BEGINNINGS)) for r in got]
    return docs, np.array([r["label"] for r in got], int), np.array([r["language"] for r in got], int)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Convolutions, tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """The model and the sample it was fitted on."""
    model = Convolutions()
    sample = sample_tokens(labelled(docs, labels, "toxic", MOD, REST, SAMPLE))
    model.fit(*sample[:2])
    return model, sample


def logits(docs: DataFrame, model: Convolutions) -> DataFrame:
    """(doc_id, language, logit) for rows with doc_id and text; languages as numbers."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, language = [np.zeros(0)], [np.zeros(0, np.int64)]
            for _, data, offsets in text_parts(batch["text"]):
                places, first, own = tokens(data, offsets)
                found.append(spread.value.logits(places, first))
                language.append(own)
            columns = [batch["doc_id"], pa.array(np.concatenate(language), pa.int32()), pa.array(np.concatenate(found), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "language", "logit"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, language int, logit double")


def histogram(found: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Labelled rows that are not held out: those outside the sample by language, label and cell, those in it by label."""
    own, wanted = chosen(labels, "toxic", MOD, REST, SAMPLE)
    place = F.floor((F.greatest(F.least("logit", F.lit(float(MOST))), F.lit(-float(MOST))) + MOST) * CELLS).alias("cell")
    by_id = found.filter(~held_out(MOD, REST)).groupBy("doc_id", "language", place).count()
    joined = by_id.join(own.filter(F.col("label").isin(0, 1)).withColumn("inside", wanted), "doc_id")
    # at most a row for each language, label, cell and side
    rows = joined.groupBy("language", "label", "cell", "inside").agg(F.sum("count").alias("n")).collect()
    outside, inside = np.zeros((OTHER + 1, 2, 2 * MOST * CELLS + 1)), np.zeros(2)
    for r in rows:
        if r["inside"]:
            inside[r["label"]] += r["n"]
        else:
            outside[r["language"], r["label"], r["cell"]] += r["n"]
    return outside, inside


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row."""
    model, sample = fit(docs, labels)
    if model.fitted:
        found = kept(logits(docs, model), "logits")
        own = F.array(*[F.lit(float(m)) for m in marks(*histogram(found, labels), sample, model)])
        at = float(np.log(THRESHOLD / (1 - THRESHOLD)))
        shifted = F.col("logit") - F.get(own, F.col("language")) + at
        score = 1 / (1 + F.exp(-F.greatest(F.least(shifted, F.lit(40.0)), F.lit(-40.0))))
    else:
        found, score = docs.select(F.col("doc_id").cast("long")), F.lit(0.0)
    return found.select("doc_id", held_out(MOD, REST).alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))
