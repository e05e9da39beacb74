"""Importance resampling towards a target: documents whose hashed words look like the target's are drawn.

A dictionary of the distinct words of some megabytes of text becomes an Aho-Corasick automaton over
words with a delimiter on both sides, so only whole words match; each carries its crc32 and length. A scan
of a text emits these payloads in order. Runs of several words get their crc32 from the payloads of
neighbours by composition, without touching the text again, and crc32 modulo the number of buckets is
the feature. Dictionaries are made and dropped batch by batch, so memory follows the batch, not the corpus.

One scan stores each document's buckets and one grouping counts them (at most as many rows as buckets).
A bucket's gain is the log ratio of its smoothed shares in target and corpus; a document's weight is the
sum of gains, and with hashed Gumbel noise the highest scores are a draw without replacement.
Rows are ranked inside ranges of the order and by the ranges' sizes, so nothing is sorted in one task.

Words are runs of digits, letters and non-ASCII characters, A-Z in lower case. Null or blank texts have
no features and weight 0. Repeated rows are ranked one by one. A row without doc_id has no noise: its
score is null and it is not drawn, but its words count. No target: all shares come from smoothing. Very
long texts are read whole, their dictionaries segment by segment. No documents: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.shared import kept, with_offsets

BUCKETS = 10_000
LOW, HIGH = 1, 1  # words in a run
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
SEGMENT = 8 << 20  # bytes of text that share a dictionary

# Bytes that belong to words in lower case, all others as the delimiter.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

_COUNTED = "row_no long, doc_id long, n_words long, n_features long, buckets binary"


class Crc:
    """crc32 of concatenations from the crc32 and length of the parts, for arrays."""

    POLYNOMIAL = 0xEDB88320

    def __init__(self):
        step = np.zeros(32, np.uint32)  # one zero bit: column per bit
        step[0], step[1:] = self.POLYNOMIAL, 1 << np.arange(31, dtype=np.uint32)
        for _ in range(3):
            step = self._times(step, step)
        self.powers = [step]  # 2**k zero bytes

    @staticmethod
    def _times(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), np.uint32)
        for bit in range(32):
            out ^= np.where(values >> np.uint32(bit) & np.uint32(1), columns[bit], np.uint32(0))
        return out

    def join(self, left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
        moved, k = left.astype(np.uint32), 0
        while (right_bytes >> k).any():
            if k == len(self.powers):
                self.powers.append(self._times(self.powers[-1], self.powers[-1]))
            on = (right_bytes >> k & 1).astype(bool)
            moved[on] = self._times(self.powers[k], moved[on])
            k += 1
        return moved ^ right.astype(np.uint32)


def automaton_of(words: set[str]) -> ahocorasick.Automaton:
    """Words between delimiters; the payload is length * 2**32 + crc32 of the UTF-8 bytes."""
    from zlib import crc32

    found = ahocorasick.Automaton()
    for word in words:
        raw = word.encode()
        found.add_word(f" {word} ", len(raw) << 32 | crc32(raw))
    found.make_automaton()
    return found


def segments(raw: bytes, most: int) -> Iterator[bytes]:
    """Parts of a folded text of about ``most`` bytes, cut at a delimiter."""
    at = 0
    while len(raw) - at > most:
        cut = raw.rfind(b" ", at + 1, at + most)
        if cut < 0:
            cut = raw.find(b" ", at + most)
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut
    yield raw[at:] if at else raw


def payloads(texts: list[str | None], most: int = SEGMENT) -> Iterator[np.ndarray]:
    """For each text the payloads of its words in order."""
    waiting: list[tuple[int, str]] = []  # (text, folded segment)
    size, done, last = 0, 0, len(texts)
    parts: dict[int, list[np.ndarray]] = {}

    def scan():
        words: set[str] = set()
        for _, text in waiting:
            words.update(text.split(" "))
        words.discard("")
        if words:
            automaton = automaton_of(words)
            for i, text in waiting:
                found = np.fromiter((v for _, v in automaton.iter(f" {text} ")), np.int64)
                parts.setdefault(i, []).append(found)
        waiting.clear()

    def ready(upto: int):
        nonlocal done
        while done < upto:
            own = parts.pop(done, [])
            yield own[0] if len(own) == 1 else np.concatenate([np.zeros(0, np.int64), *own])
            done += 1

    for i, text in enumerate(texts):
        for part in segments((text or "").encode().translate(_FOLD), most):
            waiting.append((i, part.decode()))
            size += len(part)
            if size >= most:
                scan()
                size = 0
                yield from ready(i)
    scan()
    yield from ready(last)


_crc: list[Crc] = []


def features(found: np.ndarray, low: int, high: int) -> np.ndarray:
    """Unsigned crc32 of all runs of ``low`` to ``high`` neighbouring words joined by a space."""
    own, sizes = (found & 0xFFFFFFFF).astype(np.uint32), found >> 32
    runs, out = own, [own] if low == 1 else []
    for width in range(2, high + 1):
        if not _crc:
            _crc.append(Crc())
        n = len(own) - width + 1
        if n <= 0:
            break
        if width == 2:
            from zlib import crc32

            spaced = _crc[0].join(np.full(len(own), crc32(b" "), np.uint32), own, sizes)
        runs = _crc[0].join(runs[:n], spaced[width - 1 :], sizes[width - 1 :] + 1)
        if width >= low:
            out.append(runs)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def counted(texts: DataFrame, low: int, high: int, buckets: int) -> DataFrame:
    """(row_no, doc_id, n_words, n_features, buckets) of (doc_id, text); buckets are sorted 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_no = TaskContext.get().partitionId() << 40
        for batch in batches:
            words, sizes, stored = [], [], []
            for found in payloads(batch["text"].to_pylist()):
                own = np.sort(features(found, low, high) % np.uint32(buckets))
                words.append(len(found))
                sizes.append(len(own))
                stored.append(own.astype("<u4").tobytes())
            numbers = np.arange(row_no, row_no + len(words))
            row_no += len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), batch["doc_id"], pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(stored, pa.binary())],
                ["row_no", "doc_id", "n_words", "n_features", "buckets"],
            )

    return texts.mapInArrow(run, _COUNTED)


def bucket_counts(stored: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs: summed up in the tasks, then one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch["buckets"]:
                total += np.bincount(np.frombuffer(raw.as_buffer(), "<u4"), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "rows"])

    sums = stored.select("buckets").mapInArrow(run, "bucket long, rows long").groupBy("bucket").agg(F.sum("rows").alias("rows"))
    out = np.zeros(buckets, np.int64)
    for r in sums.toLocalIterator():  # at most ``buckets`` rows
        out[r["bucket"]] = r["rows"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares."""
    n = len(corpus)
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighted(stored: DataFrame, gain: np.ndarray) -> DataFrame:
    """(row_no, doc_id, n_words, n_features, weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(gain[np.frombuffer(raw.as_buffer(), "<u4")].sum()) for raw in batch["buckets"]]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(weights, pa.int64())], [*names, "weight"])

    names = ["row_no", "doc_id", "n_words", "n_features"]
    return stored.mapInArrow(run, "row_no long, doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) from the id's hash."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(
    documents: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    low: int = LOW,
    high: int = HIGH,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Every document (doc_id, n_words, n_features, weight, score, rank); rank is null for those not drawn."""
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    stored = kept(counted(texts, low, high, buckets), "buckets")
    wanted = counted(target.select(F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), low, high, buckets)
    gain = gains(bucket_counts(stored, buckets), bucket_counts(wanted, buckets))
    scored = weighted(stored, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    can = F.coalesce((F.col("n_words") >= least_words) & F.col("score").isNotNull(), F.lit(False))
    scored = kept(scored.withColumn("can", can), "weighted")

    order = [F.col("can").desc(), F.col("score").desc(), F.col("doc_id"), F.col("row_no")]
    ranged = kept(scored.repartitionByRange(*order).withColumn("part", F.spark_partition_id().cast("long")), "ranged")
    sizes = with_offsets(ranged.groupBy("part").agg(F.count_if("can").alias("rows")), "part", "rows", "before").select("part", "before")
    total = ranged.agg(F.expr(f"count_if(can) * {int(percent)} div 100").alias("draws"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("before")
    drawn = F.when(F.col("can") & (F.col("_place") <= total.scalar()), F.col("_place"))
    placed = ranged.join(F.broadcast(sizes), "part").withColumn("_place", place.cast("long"))  # a row per partition
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", drawn.alias("rank"))


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resampled(documents, benchmark).select("doc_id", "n_features", "weight", F.col("score").cast("long").alias("score"), "rank")


_WORDS = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
_HEX = "(instr('0123456789abcdef', substr({h}, {i}, 1)) - 1)"

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END)) AS t
),
dw AS (SELECT r, unnest(w) AS word FROM d),
bw AS (SELECT unnest(w) AS word FROM b),
vocabulary AS (SELECT word, lower(hex(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
coded AS (
  SELECT word, list_transform(range(1, length(h), 2), lambda i: CAST(16 * {_HEX.format(h="h", i="i")} + {_HEX.format(h="h", i="i + 1")} AS BIGINT)) AS bytes
  FROM vocabulary
),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 10000 AS bucket
  FROM coded, tab
),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (coalesce((SELECT sum(s) FROM s), 0) + 10000)
           / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * (coalesce((SELECT sum(t) FROM t), 0) + 10000)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)
),
weights AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
noise AS (
  SELECT r, list_reduce(list_transform(range(1, 9), lambda i: CAST({_HEX.format(h="h", i="i")} AS BIGINT)), lambda a, x: 16 * a + x) AS h
  FROM (SELECT r, sha256('2024:' || CAST(doc_id AS VARCHAR)) AS h FROM d WHERE doc_id IS NOT NULL)
),
scored AS (
  SELECT d.r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (r) LEFT JOIN noise USING (r)
),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, r) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20 AND score IS NOT NULL
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= floor(10 * n / 100) THEN place END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
