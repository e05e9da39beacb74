"""Sum-of-squares packing of tokenized documents into sequences of fixed length.

A document is its ids and the end id; only one that is longer than a sequence is cut, into full
pieces and a rest. Each piece goes where the sum over residual gaps of the squared count of open
sequences with that gap becomes smallest, a new sequence being one of the choices; ties go to the
smallest gap, then to an open sequence. Rows stream through their partitions, so a task holds the
open sequences only. What stays open in any partition is then put together: a plan is made on the
number of units of each size, largest first into the tightest gap, and every unit finds its place in
the plan by its number within its size, so no task holds more than a group. An open sequence with at
most length // SLACK places left is one unit; one with more is taken apart and each of its pieces is a unit.

Null and empty texts are documents of the end id alone. Rows with equal or null ids are packed like
any others. An empty table gives no rows. Sequence numbers are unique, not consecutive.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tillroll.llm.encode import batches, encoder
from tillroll.llm.shared import kept, with_offsets

LENGTH = 2048
END_ID = 0
WINDOW = 1 << 16  # pieces that are placed largest first among themselves
SLACK = 16  # a sequence that ends with more than length // SLACK places left is taken apart
GROUP_ROWS = 1 << 16  # units that are numbered together
FIRST_MERGED = 1 << 61  # numbers of sequences put together start here, above those of all partitions

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class SumOfSquares:
    """Open sequences by gap; ``place`` answers (sequence, offset) for one piece."""

    def __init__(self, length: int, first: int = 0):
        self.length, self.next = length, first
        self.count = np.zeros(length, np.int64)  # open sequences by gap; gap 0 is closed and stays 0
        self.open: dict[int, list[int]] = {}

    def place(self, size: int) -> tuple[int, int]:
        length, count = self.length, self.count
        if size >= length:
            self.next += 1
            return self.next - 1, 0
        have = count[size:]
        change = 2 * (count[: length - size] - have) + 2
        change[0] -= 1  # a closed sequence leaves no gap behind
        change[have == 0] = np.iinfo(np.int64).max
        gap = int(change.argmin()) + size
        if change[gap - size] <= 2 * count[length - size] + 1:
            number = self.open[gap].pop()
            count[gap] -= 1
            left, offset = gap - size, length - gap
        else:
            number, self.next = self.next, self.next + 1
            left, offset = length - size, 0
        if left:
            count[left] += 1
            self.open.setdefault(left, []).append(number)
        return number, offset

    def left_open(self) -> list[tuple[int, int]]:
        """(sequence, ids in it) of those with room."""
        return [(number, self.length - gap) for gap, numbers in self.open.items() for number in numbers]


def _pack_part(tokenizer: str, length: int):
    end = np.array([END_ID], "<u4")

    def pieces(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encode = encoder(tokenizer)
        for batch in rows:
            docs = batch["doc_id"].to_pylist()
            for at, some in batches(batch["text"]):
                for i, found in enumerate(encode(some)):
                    ids = np.concatenate([np.frombuffer(found, "<u2").astype("<u4"), end])
                    for piece, start in enumerate(range(0, len(ids), length)):
                        own = ids[start : start + length]
                        yield docs[at + i], piece, start, len(own), zlib.crc32(own.tobytes())

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SumOfSquares(length, TaskContext.get().partitionId() << 32)
        window: list[tuple] = []

        def flush():
            window.sort(key=lambda p: -p[3])
            placed = [(*p, *packer.place(p[3])) for p in window]
            window.clear()
            columns = list(zip(*placed))
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.strip().split(" ")[0] for c in _PIECES.split(",")])

        for p in pieces(rows):
            window.append(p)
            if len(window) >= WINDOW:
                yield flush()
        if window:
            yield flush()

    return run


@dataclass
class Bins:
    """``count`` new sequences alike: the t-th holds unit ``first + t`` of each member's size."""

    count: int
    gap: int
    members: list[tuple[int, int, int]]  # (size, first, offset)

    def split(self, n: int) -> "Bins":
        """Take the first ``n`` of them away."""
        taken = Bins(n, self.gap, list(self.members))
        self.members = [(size, first + n, offset) for size, first, offset in self.members]
        self.count -= n
        return taken


def recipe(counts: dict[int, int], length: int) -> list[Bins]:
    """How units, counted by size, are put together: largest first, each where the gap is tightest.

    Sizes are handled as a whole, so the work and the recipe depend on ``length``, not on the counts.
    """
    by_gap: dict[int, list[Bins]] = {}
    done: list[Bins] = []

    def keep(bins: Bins) -> None:
        (by_gap.setdefault(bins.gap, []) if bins.gap else done).append(bins)

    for size in sorted(counts, reverse=True):
        first, left = 0, counts[size]
        while left:
            gap = min((g for g in by_gap if g >= size), default=None)
            if gap is None:
                break
            group = by_gap[gap][-1]
            if group.count > left:
                taken = group.split(left)
            else:
                taken = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap]
            taken.members.append((size, first, length - gap))
            taken.gap -= size
            keep(taken)
            first, left = first + taken.count, left - taken.count
        each = length // size
        for n, held in ((left // each, each), (1, left % each)):
            if n and held:
                keep(Bins(n, length - held * size, [(size, first + n * j, size * j) for j in range(held)]))
                first += n * held
    return [*done, *(g for groups in by_gap.values() for g in groups)]


def merged(units: DataFrame, length: int) -> DataFrame:
    """(sequence_id, at, into, shift) for the units (sequence_id, at, filled): new numbers and where they start.

    The plan is made on how many units there are of each size, at most ``length`` numbers. Rows are
    numbered within their size in groups of about GROUP_ROWS and find their place by number.
    """
    units = kept(units, "units")
    counts = {r["filled"]: r["n"] for r in units.groupBy("filled").agg(F.count("*").alias("n")).collect()}
    starts, total = {}, 0
    for size in sorted(counts):
        starts[size], total = total, total + counts[size]
    keys, numbers, offsets, base = [], [], [], FIRST_MERGED
    for bins in recipe(counts, length):
        for size, first, offset in bins.members:
            keys.append(starts[size] + first)
            numbers.append(base)
            offsets.append(offset)
        base += bins.count
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    keys, numbers, offsets = (np.array(x, np.int64)[order] for x in (keys, numbers, offsets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch["number"].to_numpy()
            at = np.searchsorted(keys, number, "right") - 1
            yield pa.RecordBatch.from_arrays([batch["sequence_id"], batch["at"], pa.array(numbers[at] + number - keys[at]), pa.array(offsets[at])], ["sequence_id", "at", "into", "shift"])

    parts = max(1, -(-total // GROUP_ROWS))
    grouped = units.withColumn("group", F.col("filled") * parts + F.pmod(F.xxhash64("sequence_id", "at"), F.lit(parts)))
    before = with_offsets(grouped.groupBy("group").agg(F.count("*").alias("rows")), "group", "rows", "before").select("group", "before")
    within = F.row_number().over(Window.partitionBy("group").orderBy("sequence_id", "at"))
    numbered = grouped.withColumn("within", within).join(before, "group")
    return numbered.select("sequence_id", "at", (F.col("before") + F.col("within") - 1).cast("long").alias("number")).mapInArrow(run, "sequence_id long, at long, into long, shift long")


def pack(documents: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """One row per piece: where it was cut and where it was put."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    placed = kept(rows.mapInArrow(_pack_part(tokenizer, length), _PIECES), "packed")
    filled = placed.groupBy("sequence_id").agg(F.sum("length").alias("filled"))
    apart = F.when(F.col("filled") < length - length // SLACK, F.col("offset")).otherwise(-1)
    tagged = placed.join(filled, "sequence_id").withColumn("at", apart)
    units = tagged.filter(F.col("filled") < length).groupBy("sequence_id", "at").agg(F.sum("length").alias("filled"))
    return tagged.join(merged(units, length), ["sequence_id", "at"], "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("into", "sequence_id").alias("sequence_id"),
        F.when(F.col("into").isNull(), F.col("offset")).otherwise(F.col("shift") + F.when(F.col("at") < 0, F.col("offset")).otherwise(0)).alias("offset"),
    )
