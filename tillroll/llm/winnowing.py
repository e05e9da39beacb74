"""Benchmark decontamination by winnowing: shared word windows between documents and test items.

A window is WINDOW consecutive words. Its fingerprint is the least hash of the GRAM-word runs in it, so
neighbouring windows share fingerprints and every shared span of WINDOW words shares at least one. Items
of fewer words are one window each, with the hash of the whole as fingerprint; documents are then
winnowed with windows of that length too. A bit table of the items' fingerprints (at most 2**MOST_BITS
bits; fuller tables only let more through) thins the documents' fingerprints while they are scanned.
What is left is joined with the items on the fingerprint, and a hit is extended to every window that
holds it and checked word by word; overlapping windows make one span.

Every distinct window stands once on the items' side, with the class of items that hold it, so copies of
items or passages never multiply. The documents' side is salted, as one passage may be in a third of them.

Words are runs of digits, letters and non-ASCII characters, A-Z in lower case. Null or blank texts have
no words and no hits. Rows with null or equal doc_id are documents of their own. Equal item_ids count
once; an item without id makes hits, but is not counted or listed. No items: no hits. No documents: no rows.
Very long texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm import words as w
from tillroll.llm.shared import kept, text_parts

WINDOW = 10
GRAM = 5
LEAST_BITS, MOST_BITS = 20, 26
SALTS = 16

IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_WINDOWS = "row_no long, id long, n_words long, start int, size int, print long, words string"


def fingerprints(hashes: np.ndarray, first: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, fingerprint) of every window of ``size`` words that lies in one text."""
    gram = min(gram, size)
    n = len(hashes) - gram + 1
    lengths = np.diff(first)
    counts = np.maximum(lengths - size + 1, 0)
    if n <= 0 or not counts.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(n, np.uint64)
    for k in range(gram):
        grams = grams * w.BASE + hashes[k : k + n]
    grams = w.mixed(grams ^ w.powers(gram + 1)[gram])
    ends = np.cumsum(counts)
    starts = np.repeat(first[:-1] - (ends - counts), counts) + np.arange(ends[-1])
    least = grams[: n - size + gram].copy()
    for k in range(1, size - gram + 1):
        np.minimum(least, grams[k : k + len(least)], out=least)
    return starts, least[starts]


def slots(prints: np.ndarray, bits: int) -> np.ndarray:
    return w.mixed(prints ^ w.STEP) >> np.uint64(64 - bits)


def _scan(sizes: list[int], gram: int, whole_below: int, keep: np.ndarray | None, bits: int):
    """Windows of each text; with ``whole_below``, shorter texts are one window.

    With a bit table only windows that it lets through, and a row for each text besides (null start).
    """

    def of_part(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list]:
        starts, ends, first = w.spans(IS_WORD[data], offsets)
        low = w.LOWER[data]
        hashes = w.Sums(low).of(starts, ends)
        found = []
        for size in sizes:
            chosen, prints = fingerprints(hashes, first, size, gram)
            if size < whole_below:  # only texts of just this length
                row = np.searchsorted(first, chosen, "right") - 1
                exact = np.diff(first)[row] == size
                chosen, prints = chosen[exact], prints[exact]
            if keep is not None and len(chosen):
                slot = slots(prints, bits)
                through = (keep[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
                chosen, prints = chosen[through], prints[through]
            rows = np.searchsorted(first, chosen, "right") - 1
            for at, row, print_ in zip(chosen.tolist(), rows.tolist(), prints.view(np.int64).tolist()):
                text = b" ".join(low[a:b].tobytes() for a, b in zip(starts[at : at + size].tolist(), ends[at : at + size].tolist()))
                found.append((row, at - int(first[row]), size, print_, text.decode()))
        return np.diff(first), found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_no = TaskContext.get().partitionId() << 40
        for batch in batches:
            for top, data, offsets in text_parts(batch["text"]):
                counts, found = of_part(data, offsets)
                n = len(counts)
                ids = batch["id"].slice(top, n).to_pylist()
                rows = [(row_no + i, ids[i], int(counts[i]), None, None, None, None) for i in range(n)] if keep is not None else []
                rows += [(row_no + r, ids[r], int(counts[r]), *rest) for r, *rest in found]
                row_no += n
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
                columns = list(zip(*rows)) or [()] * len(kinds)
                names = [c.strip().split(" ")[0] for c in _WINDOWS.split(",")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _texts(df: DataFrame, id_: str) -> DataFrame:
    return df.select(F.col(id_).cast("long").alias("id"), F.col("text").cast("string").alias("text"))


def _bit_table(items: DataFrame) -> tuple[np.ndarray, int]:
    """One bit for each fingerprint; the table's size follows their number up to a bound."""
    n = items.select("print").distinct().count()
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(32 * n + 1))))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = slots(batch["print"].to_numpy().view(np.uint64), bits)
            bit = (np.uint64(1) << (slot & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(bit)], ["cell", "bit"])

    cells = items.select("print").mapInArrow(places, "cell long, bit long").groupBy("cell").agg(F.bit_or("bit").alias("bit"))
    table = np.zeros(1 << (bits - 6), np.uint64)
    found = cells.toPandas()  # at most 2**(MOST_BITS - 6) rows
    table[found["cell"].to_numpy(np.int64)] = found["bit"].to_numpy(np.int64).view(np.uint64)
    return table, bits


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a right side of one row per key; a hot key of the left side goes to SALTS tasks."""
    left = left.withColumn("_salt", F.pmod(F.xxhash64("row_no"), F.lit(SALTS)))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


@dataclass
class Hits:
    """documents: (row_no, id, n_words); matches: (row_no, start, size, class), a window in a document each;
    items: (class, id), the items that hold a window of the class."""

    documents: DataFrame
    matches: DataFrame
    items: DataFrame

    def spans(self) -> DataFrame:
        """(row_no, start, n_words): the words of a document that are hit; windows that overlap or touch are one."""
        end = F.col("start") + F.col("size")
        order = Window.partitionBy("row_no").orderBy("start", "size")
        before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
        opened = F.when(F.col("start") > before, 1).otherwise(0)
        places = self.matches.select("row_no", "start", "size").distinct().withColumn("_new", opened)
        places = places.withColumn("_span", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        return places.groupBy("row_no", "_span").agg(F.min("start").alias("start"), (F.max(end) - F.min("start")).cast("long").alias("n_words")).drop("_span")

    def item_lists(self) -> DataFrame:
        """(row_no, n_items, item_ids): the items with a window in each document that has hits, sorted as text.

        Documents with the same classes share one list.
        """
        own = self.matches.select("row_no", "class").distinct().groupBy("row_no").agg(F.array_sort(F.collect_list("class")).alias("classes"))
        own = own.withColumn("list", F.sha2(F.concat_ws(",", "classes"), 256))
        lists = own.groupBy("list").agg(F.first("classes").alias("classes")).select("list", F.explode("classes").alias("class"))
        lists = lists.join(self.items, "class").select("list", F.col("id").cast("string").alias("id")).distinct()
        lists = lists.groupBy("list").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("id")).alias("item_ids"))
        found = salted_join(own.select("row_no", "list"), lists, ["list"], "left")
        return found.select("row_no", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def find(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> Hits:
    """All occurrences of windows of ``benchmark`` (item_id, text) in ``documents`` (doc_id, text)."""
    sizes = list(range(1, window + 1))
    items = kept(_texts(benchmark, "item_id").mapInArrow(_scan(sizes, gram, window, None, 0), _WINDOWS), "items")
    present = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most ``window`` rows
    table, bits = _bit_table(items)
    scan = _scan(present, gram, 0, table, bits)
    scanned = kept(_texts(documents, "doc_id").mapInArrow(scan, _WINDOWS), "winnowed")

    windows = items.groupBy("print", "words").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    windows = windows.withColumn("class", F.sha2(F.concat_ws(",", "ids"), 256))
    held = windows.groupBy("class").agg(F.first("ids").alias("ids")).select("class", F.explode("ids").alias("id"))
    matches = salted_join(scanned.filter("start is not null"), windows.drop("ids"), ["print", "words"])
    return Hits(
        scanned.filter("start is null").select("row_no", "id", "n_words"),
        kept(matches.select("row_no", "start", "size", "class"), "matches"),
        held,
    )


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What is hit in each document, and by which items."""
    hits = find(documents, benchmark)
    words = hits.spans().groupBy("row_no").agg(F.sum("n_words").alias("n_hit"))
    lists = hits.item_lists().select("row_no", "n_items", _sha256(F.concat_ws(",", "item_ids")).alias("items_sha256"))
    zero = F.lit(0).cast("long")
    return (
        hits.documents.join(words, "row_no", "left")
        .join(lists, "row_no", "left")
        .select(
            F.col("id").alias("doc_id"),
            "n_words",
            F.coalesce("n_hit", zero).alias("n_hit"),
            F.coalesce("n_items", zero).alias("n_items"),
            F.coalesce("items_sha256", _sha256(F.lit(""))).alias("items_sha256"),
            (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
        )
    )


_WORDS = r"""regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents
), i AS (
  SELECT item_id, {_WORDS.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL
), iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[place : place + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS place FROM i WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM iw
), dw AS (
  SELECT r, size, place, array_to_string(w[place : place + size - 1], ' ') AS words
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS place FROM d JOIN sizes ON size <= len(w))
), m AS (
  SELECT r, place, dw.size AS size, item_id FROM dw JOIN iw ON dw.words = iw.words AND dw.size = iw.size
), spans AS (
  SELECT r, place + size - greatest(place, coalesce(max(place + size) OVER (PARTITION BY r ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS fresh
  FROM (SELECT DISTINCT r, place, size FROM m)
), hit AS (
  SELECT r, CAST(sum(greatest(fresh, 0)) AS BIGINT) AS n_hit FROM spans GROUP BY r
), lists AS (
  SELECT r, count(item_id) AS n_items, sha256(coalesce(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)), '')) AS items_sha256
  FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN lists USING (r)
"""
